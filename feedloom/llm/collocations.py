"""Phrase collocations: cohesive runs of words per language.

Texts are cut into pieces and words.  Every word starts one window: lead columns
hold the word and its followers, padded with nulls where the piece ends.  Only
these longest windows are counted; Spark's ROLLUP over the lead columns then sums
them to the counts of all shorter prefixes, that is of all phrases, and to the
number of words of a language.

No phrase with a rare part can be frequent, so a window is also padded where its
words so far are rare.  Rare is what a count-min sketch of all phrases keeps below
the floor; the sketch overestimates, so no frequent phrase is lost.  It has a fixed
size (``BITS`` cells).  What is left to count is frequent phrases, of which a task
has few, and it adds up its own before they are shuffled.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from feedloom.llm.common import mix, need_columns, stored
from feedloom.llm.sketch import CHUNKS, CountSketch, merged

LONGEST = 5
FLOOR = 100
TOP = 2000
BITS = 26
NO_LANGUAGE = "und"
# A-Z lower-cased, every piece end a full stop, a tab a blank.
_FROM = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ,;:!?\n\x0b\x0c\r\t"
_CODES = bytes.maketrans(_FROM, b"abcdefghijklmnopqrstuvwxyz" + b"." * 9 + b" ")
BLOCK = 1 << 20
# Tasks for each core of the cluster: a task sends a whole sketch, and a row for each
# frequent phrase that it has, so more tasks than keep the cores busy send these again.
TASKS_PER_CORE = 2
# Words, and distinct words, that a task holds before it counts them.
HELD = 1 << 20
DISTINCT = 1 << 20


class Vocabulary(dict):
    """Numbers for the words of one language, from 1; 0 is the end of a piece."""

    def __init__(self, lang: str) -> None:
        super().__init__({b".": 0})
        self.salt = hashlib.blake2b(lang.encode(), digest_size=8).digest()
        self.words: list[bytes] = [b"."]
        self.known: list[np.ndarray] = [np.zeros(1, np.uint64)]
        self.hashed = 1

    def __missing__(self, word: bytes) -> int:
        self.words.append(word)
        self[word] = len(self.words) - 1
        return len(self.words) - 1

    def numbers(self, data: bytes) -> np.ndarray:
        """The words of a text, in blocks, as numbers; a piece ends after the text."""
        parts, at = [], 0
        while at < len(data):
            end = at + BLOCK
            while end < len(data) and data[end] not in b" \t.,;:!?\n\x0b\x0c\r":
                end += 1
            words = data[at:end].translate(_CODES).replace(b".", b" . ").split()
            parts.append(np.fromiter(map(self.__getitem__, words), np.int32, len(words)))
            at = end
        return np.concatenate([*parts, np.zeros(1, np.int32)])

    def hashes(self) -> np.ndarray:
        """64-bit hashes by number."""
        if self.hashed < len(self.words):
            new = b"".join(
                hashlib.blake2b(w, digest_size=8, salt=self.salt).digest() for w in self.words[self.hashed :]
            )
            self.known = [np.concatenate([*self.known, np.frombuffer(new, np.uint64)])]
            self.hashed = len(self.words)
        return self.known[0]


def longer(prefix: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Hashes of phrases, by those without the last word and that of the last word."""
    return mix(prefix * np.uint64(0xFF51AFD7ED558CCD) + word)


def prefixes(numbers: np.ndarray, word: np.ndarray, longest: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Per length: the places where a phrase of that length begins, and its hash.

    The caller may send back which of them to go on with.
    """
    at = np.flatnonzero(numbers)
    h = word[numbers[at]]
    for k in range(1, longest + 1):
        going = yield at, h
        if going is not None:
            at, h = at[going], h[going]
            yield at, h
        if k == longest:
            return
        inside = at + k < len(numbers)
        inside[inside] = numbers[at[inside] + k] > 0
        at, h = at[inside], h[inside]
        h = longer(h, word[numbers[at + k]])


def _by_language(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, Vocabulary, np.ndarray]]:
    """The numbered words of a task, in stretches of one language of about ``HELD`` words."""
    held: dict[str, tuple[Vocabulary, list[np.ndarray]]] = {}
    sizes: dict[str, int] = {}
    for batch in batches:
        langs = batch.column("lang").to_pylist()
        for at in range(0, batch.num_rows, 256):
            texts = batch.column("text").slice(at, 256).cast(pa.large_binary())
            for lang, text in zip(langs[at : at + 256], texts, strict=True):
                if lang not in held:
                    held[lang], sizes[lang] = (Vocabulary(lang), []), 0
                words, parts = held[lang]
                parts.append(words.numbers(text.as_py() or b""))
                sizes[lang] += len(parts[-1])
                if sizes[lang] > HELD or len(words.words) > DISTINCT:
                    yield lang, words, np.concatenate(parts)
                    held[lang] = (Vocabulary(lang) if len(words.words) > DISTINCT else words, [])
                    sizes[lang] = 0
        # However many languages there are, no more words are held.
        if sum(sizes.values()) > 4 * HELD or sum(len(w.words) for w, _ in held.values()) > 2 * DISTINCT:
            for lang, (words, parts) in held.items():
                if parts:
                    yield lang, words, np.concatenate(parts)
            held, sizes = {}, {}
    for lang, (words, parts) in held.items():
        if parts:
            yield lang, words, np.concatenate(parts)


def _count(bits: int, longest: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch = CountSketch(bits, 1)
        for _, words, numbers in _by_language(batches):
            for _, h in prefixes(numbers, words.hashes(), longest):
                sketch.add(h)
        yield from sketch.chunks()

    return run


def lead_windows(numbers: np.ndarray, word: np.ndarray, longest: int, frequent) -> np.ndarray:
    """Per word its window as a row of ``longest`` numbers, padded with 0.

    ``frequent`` says of hashes which phrases may be; a window ends before the
    first word that makes it rare, and a rare word has a row of zeros.
    """
    rows = np.zeros((len(numbers), longest), np.int32)
    steps = prefixes(numbers, word, longest)
    at, h = next(steps)
    for k in range(longest):
        at, _ = steps.send(frequent(h))
        rows[at, k] = numbers[at + k]
        if k + 1 < longest:
            at, h = next(steps)
    return rows[numbers > 0]


def counted_rows(rows: np.ndarray, times: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct rows and how often each occurs; ``times`` weighs the rows."""
    key = rows[:, 0].astype(np.int64)
    kinds = np.zeros(len(rows), np.int64)
    for k in range(1, rows.shape[1]):
        many = np.flatnonzero(rows[:, k])
        if not len(many):
            break
        # Only rows that go on are numbered anew; a row's number stays unique.
        pairs = key[many] << 32 | rows[many, k]
        _, number = np.unique(pairs, return_inverse=True)
        key[many], kinds[many] = number, k
    _, first, number = np.unique(kinds << 32 | key, return_index=True, return_inverse=True)
    count = np.bincount(number, times, len(first)) if len(first) else np.zeros(0)
    return rows[first], count.astype(np.int64)


def _windows(longest: int, floor_bits: Broadcast):
    names = ["lang", *(f"w{k}" for k in range(1, longest + 1)), "n"]

    def batch(lang: str, words: Vocabulary, rows: np.ndarray, count: np.ndarray) -> pa.RecordBatch:
        used, place = np.unique(rows, return_inverse=True)
        texts = pa.array([words.words[u] for u in used.tolist()], pa.binary()).cast(pa.string())
        place = place.reshape(rows.shape)
        columns = [texts.take(pa.array(place[:, k], mask=rows[:, k] == 0)) for k in range(longest)]
        langs = pa.array([lang], pa.string()).take(pa.array(np.zeros(len(count), np.int32)))
        return pa.RecordBatch.from_arrays([langs, *columns, pa.array(count)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = floor_bits.value
        own: dict[str, tuple[Vocabulary, np.ndarray, np.ndarray]] = {}
        for lang, words, numbers in _by_language(batches):
            rows, count = counted_rows(lead_windows(numbers, words.hashes(), longest, bits.may_reach))
            if lang in own:
                known, more, times = own.pop(lang)
                if known is words:
                    rows, count = counted_rows(np.concatenate([more, rows]), np.concatenate([times, count]))
                else:
                    yield batch(lang, known, more, times)
            own[lang] = (words, rows, count)
            if sum(len(r) for _, r, _ in own.values()) > HELD:
                yield from (batch(g, *held) for g, held in own.items())
                own = {}
        yield from (batch(g, *held) for g, held in own.items())

    return run


def phrase_counts(
    documents: DataFrame,
    longest: int = LONGEST,
    floor: int = FLOOR,
    bits: int = BITS,
    tasks: int | None = None,
) -> DataFrame:
    """Rows (lang, k, words, phrase, f): phrases of 1 to ``longest`` words with f >= floor.

    k = 0 (no words) has the number of all words of the language, however few.  Texts
    are read in at most ``tasks`` tasks, by default ``TASKS_PER_CORE`` for each core that
    the session has now (name them where executors are added only under load).  A
    task's memory does not grow with the texts that it reads.
    """
    if not 1 <= floor <= 255:
        raise ValueError("the floor must be 1 to 255, as far as a sketch counts")
    need_columns(documents, "text", "lang")
    tasks = tasks or TASKS_PER_CORE * documents.sparkSession.sparkContext.defaultParallelism
    rows = documents.select(F.coalesce(F.col("lang").cast("string"), F.lit(NO_LANGUAGE)).alias("lang"), "text")
    rows = rows.coalesce(tasks)
    reached = merged(rows.mapInArrow(_count(bits, longest), CHUNKS), floor, bits, 1)
    kept = rows.sparkSession.sparkContext.broadcast(reached)
    lead = [f"w{k}" for k in range(1, longest + 1)]
    schema = "lang string, " + ", ".join(f"{c} string" for c in lead) + ", n long"
    windows = rows.mapInArrow(_windows(longest, kept), schema)
    windows = windows.groupBy("lang", *lead).agg(F.sum("n").alias("n"))
    summed = windows.rollup("lang", *lead).agg(F.sum("n").alias("f"), F.grouping_id().alias("level"))
    # The level has a one bit for each column that is summed over, the last ones.
    k = sum((F.col("level") < (1 << i)).cast("int") for i in range(longest))
    words = F.array_compact(F.array(*lead))
    summed = summed.where("lang IS NOT NULL").select("lang", k.alias("k"), words.alias("words"), "f")
    # Fewer words than the level has columns: padding, which is no phrase.
    summed = summed.where((F.size("words") == F.col("k")) & ((F.col("k") == 0) | (F.col("f") >= floor)))
    return summed.select("lang", "k", "words", F.array_join("words", " ").alias("phrase"), "f")


def collocations(
    documents: DataFrame,
    longest: int = LONGEST,
    floor: int = FLOOR,
    top: int = TOP,
    bits: int = BITS,
    tasks: int | None = None,
) -> DataFrame:
    """The first ``top`` phrases of 2 to ``longest`` words per language.

    Columns lang, rank, phrase, a, l, r, n, score.  The score is the least, over
    all cuts in two, of floor(1000 * a * n / (l * r)).  A phrase goes if a longer
    one around it is as frequent.  A null lang is ``und``; null and empty texts
    have no words; every row counts, whatever its doc_id, which is not read.  Equal
    scores are ordered by a, then by phrase, so there are no ties.  Other columns
    are ignored.
    """
    counts = stored(phrase_counts(documents, longest, floor, bits, tasks))
    total = counts.where("k = 0").select("lang", F.col("f").alias("n"))
    phrases = counts.where("k >= 2").select("lang", "phrase", "words", "k", F.col("f").alias("a"))
    cut = F.explode(F.sequence(F.lit(1), F.col("k") - 1)).alias("cut")
    cuts = phrases.select("lang", "phrase", "words", "k", "a", cut).select(
        "lang",
        "phrase",
        "a",
        "cut",
        F.expr("array_join(slice(words, 1, cut), ' ')").alias("head"),
        F.expr("array_join(slice(words, cut + 1, k - cut), ' ')").alias("tail"),
    )
    cuts = cuts.join(counts.select("lang", F.col("phrase").alias("head"), F.col("f").alias("l")), ["lang", "head"])
    cuts = cuts.join(counts.select("lang", F.col("phrase").alias("tail"), F.col("f").alias("r")), ["lang", "tail"])
    wide = "cast({} as decimal(38, 0))".format
    score = F.expr(f"({wide(1000)} * a * n) div ({wide('l')} * r)")
    cuts = cuts.join(total, "lang").select("lang", "phrase", "a", "n", F.struct(score.alias("score"), "cut", "l", "r").alias("c"))
    scored = cuts.groupBy("lang", "phrase", "a", "n").agg(F.min("c").alias("c"))
    # Every shorter phrase inside a longer one, with the longer one's count.
    inner = F.expr(
        "explode(flatten(transform(sequence(2, k - 1), m ->"
        " transform(sequence(1, k - m + 1), s -> array_join(slice(words, s, m), ' ')))))"
    )
    inside = phrases.where("k >= 3").select("lang", inner.alias("phrase"), "a")
    inside = inside.groupBy("lang", "phrase").agg(F.max("a").alias("around"))
    left = scored.join(inside, ["lang", "phrase"], "left").where("around IS NULL OR 100 * around < 100 * a")
    order = W.partitionBy("lang").orderBy(F.desc("c.score"), F.desc("a"), "phrase")
    left = left.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return left.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "c.l", "c.r", "n", "c.score")
