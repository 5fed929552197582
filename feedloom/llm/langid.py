"""Language identification by compression.

Each language has a zstandard raw-content dictionary made of training texts.  A
text's letters are compressed once with every dictionary; the language with the
smallest result wins.  A text whose two best results lie close is rejected.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from feedloom.llm.common import filtered, long_rows, need_columns

UNKNOWN = "und"
FOLDS = 4
HELD_OUT = 2
# The bounded sample of labelled rows: so many documents of each language, by a
# hash of their id, and so many characters from the middle of each.
SAMPLE_DOCUMENTS = 64
SAMPLE_CHARS = 2000
# Texts are compressed in chunks, so the dictionary counts in all of a long one.
# A compressible start keeps short texts from being stored as they are.
CHUNK = 1024
START = b" " * 64
# Matches of three bytes: parts of words count.
LEVEL, MIN_MATCH = 6, 3
# A margin below this share of the second best size is narrow.
NARROW = 0.005
NOT_LETTERS = re.compile(r"[\W\d_]+")


def fold(doc_id: Column) -> Column:
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(FOLDS))


def letters(text: str) -> str:
    """Lower-cased words of letters, one space between them."""
    return NOT_LETTERS.sub(" ", text.lower()).strip()


def train(documents: DataFrame) -> dict[str, bytes]:
    """Per language a dictionary: letters of a bounded sample of its training rows.

    Held-out rows and rows without an id, text or language are no part of it.
    """
    need_columns(documents, "doc_id", "text", "lang")
    long_rows(documents)
    rows = documents.where("doc_id IS NOT NULL AND text IS NOT NULL AND lang IS NOT NULL")
    rows = rows.where(fold(F.col("doc_id")) != HELD_OUT)
    order = W.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    chosen = rows.select("doc_id", "lang").withColumn("rank", F.row_number().over(order))
    chosen = chosen.where(F.col("rank") <= SAMPLE_DOCUMENTS).toPandas()
    ids = [int(i) for i in chosen["doc_id"].unique()]
    if not ids:
        return {}
    half = F.greatest(F.lit(1), F.expr(f"(length(text) - {SAMPLE_CHARS}) div 2 + 1").cast("int"))
    cut = F.substring(F.col("text"), half, F.lit(SAMPLE_CHARS)).alias("cut")
    sample = rows.where(F.col("doc_id").isin(ids)).select("doc_id", "lang", cut)
    parts: dict[str, list[str]] = {}
    for _, lang, text in sorted(tuple(r) for r in sample.collect()):
        parts.setdefault(lang, []).append(letters(text))
    # Texts that end the sample lie nearest; order does not matter for the rest.
    return {lang: " ".join(x).encode() for lang, x in sorted(parts.items())}


class Compressors:
    """One compressor per language, with its dictionary prepared once."""

    def __init__(self, dictionaries: dict[str, bytes]) -> None:
        import zstandard

        self.names, self.ways = sorted(dictionaries), []
        for name in self.names:
            how = zstandard.ZstdCompressionParameters(
                compression_level=LEVEL,
                min_match=MIN_MATCH,
                strategy=zstandard.STRATEGY_BTOPT,
                write_content_size=False,
                write_dict_id=False,
            )
            own = zstandard.ZstdCompressionDict(
                dictionaries[name] or b" ", dict_type=zstandard.DICT_TYPE_RAWCONTENT
            )
            own.precompute_compress(compression_params=how)
            self.ways.append(zstandard.ZstdCompressor(compression_params=how, dict_data=own))

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        """Language, score and whether it is rejected.

        The score is the margin as a share of the second best size; a text that
        is null or has no letter is ``und`` with score 0.
        """
        kept = letters(text or "")
        if not kept or not self.ways:
            return UNKNOWN, 0.0, True
        data = kept.encode()
        sizes = np.zeros(len(self.ways))
        for at in range(0, len(data), CHUNK):
            part = START + data[at : at + CHUNK]
            sizes += [len(way.compress(part)) for way in self.ways]
        if len(sizes) == 1:
            return self.names[0], 1.0, False
        best, second = np.argsort(sizes, kind="stable")[:2]
        margin = float((sizes[second] - sizes[best]) / sizes[second])
        return self.names[best], margin, margin < NARROW


def _predict(dictionaries):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ways = Compressors(dictionaries.value)
        for batch in batches:
            rows = [ways.predict(t.as_py()) for t in batch.column("text")]
            lang, score, rejected = zip(*rows, strict=True) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(lang, pa.string()),
                    pa.array(score, pa.float64()),
                    pa.array(rejected, pa.bool_()),
                ],
                ["doc_id", "lang_pred", "score", "rejected"],
            )

    return run


def _keep(dictionaries):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ways = Compressors(dictionaries.value)
        for batch in batches:
            rejected = [ways.predict(t.as_py())[2] for t in batch.column("text")]
            yield batch.filter(pa.array([not r for r in rejected], pa.bool_()))

    return run


def identify_language(documents: DataFrame) -> DataFrame:
    """Per row: doc_id, held_out, lang_pred, score, rejected.

    A null or letterless text is ``und``.  A null doc_id is not held out and
    does not train.  With one known language every text with a letter is that.
    Long texts are compressed whole, in chunks.  Of equal sizes the first language
    by name wins, with score 0 and rejected.  Rows that repeat fare alike, and train
    as often as they come.  Other columns are ignored; no rows give no rows.
    """
    dictionaries = documents.sparkSession.sparkContext.broadcast(train(documents))
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    found = docs.mapInArrow(
        _predict(dictionaries), "doc_id long, lang_pred string, score double, rejected boolean"
    )
    held = F.coalesce(fold(F.col("doc_id")) == HELD_OUT, F.lit(False))
    return found.select("doc_id", held.alias("held_out"), "lang_pred", "score", "rejected")


def keep_identified(documents: DataFrame) -> DataFrame:
    """The rows of ``documents`` whose language is not rejected, all columns."""
    dictionaries = documents.sparkSession.sparkContext.broadcast(train(documents))
    return filtered(documents, _keep(dictionaries))
