"""The corpus pipeline: language, quality, near duplicates, mixing, packing.

Each stage reads what the stage before it wrote; all but the last return the
columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from feedloom.llm import langid, mixing, ngram_join, packing, quality
from feedloom.llm.common import stored

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

# Near duplicates of the corpus; op 1 as a query has its own, 3 words and 90 percent.
NEAR_WORDS = 5
NEAR_PERCENT = 80


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is identified; rejected ones go (op 9).

    Null, empty and letterless texts have no language and go; long ones are read
    whole; of equal scores the first language by name wins, which is a narrow
    margin, so such texts go.  Repeated rows fare alike; no rows give no rows.
    """
    return langid.keep_identified(docs)


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the quality classifier keeps (op 7).

    Null and empty texts count as texts without words; a score at the threshold
    is kept.  Repeated rows fare alike; without labels all stay; no rows give none.
    """
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that n-gram Jaccard links connect (op 1).

    Documents link from a Jaccard similarity of 0.8 of their runs of five words.
    The smallest doc_id stays; of rows that repeat it, the smallest text, and of
    those one.  Null and empty texts link with nothing.  Rows with a null doc_id
    link with nothing and stay.  No rows give no rows.
    """
    groups = ngram_join.jaccard_components(docs, NEAR_WORDS, NEAR_PERCENT)
    kept = groups.where("doc_id = component_id").select("doc_id").distinct()
    # The row travels as one column, so no name of its own can clash.
    rows = docs.select("doc_id", "text", F.struct(*_all(docs)).alias("row")).join(kept, "doc_id", "left_semi")
    order = W.partitionBy("doc_id").orderBy("text", F.xxhash64("row"))
    rows = rows.withColumn("copy", F.row_number().over(order)).where("copy = 1").select("row.*")
    return rows.unionByName(docs.where("doc_id IS NULL")).select(*_all(docs))


def _all(docs: DataFrame) -> list[Column]:
    return [F.col(f"`{c}`") for c in docs.columns]


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix as documents (op 2): a row per document and pass, with the words taken.

    Every row is a document of its own, whatever its doc_id: rows are numbered and
    stored before the mix.  A document taken whole keeps its text as it is; of one
    taken in part, the words taken are joined by single spaces.  Documents the mix
    leaves out go, as do null, empty and blank texts, which have no words.  Null
    sources are one source.  No rows give no rows.
    """
    number = F.monotonically_increasing_id().alias("number")
    rows = stored(docs.select(number, F.struct(*_all(docs)).alias("row")))
    sizes = rows.select(F.col("number").alias("doc_id"), "row.text", "row.source")
    sizes = stored(mixing.document_sizes(sizes))
    targets = stored(mixing.weighted_targets(sizes))
    ranked = sizes.join(targets, sizes.source.eqNullSafe(targets.source))
    ranked = ranked.select("doc_id", "rank", "size")
    mix = mixing.mixture(ranked, targets)
    cuts = mix.groupBy("doc_id", "pass").agg(
        F.sort_array(F.collect_list(F.struct("first_word", "words"))).alias("cuts"),
        F.sum("words").alias("taken"),
    )
    cuts = cuts.join(ranked.select("doc_id", "size"), "doc_id")
    cuts = cuts.select(
        F.col("doc_id").alias("number"), F.when(F.col("taken") < F.col("size"), F.col("cuts")).alias("cuts")
    )
    rows = rows.join(cuts, "number")
    words = F.expr(rf"regexp_extract_all(row.text, r'{mixing.WORD}', 0)")
    rows = rows.withColumn("words", F.when(F.col("cuts").isNotNull(), words))
    part = F.transform("cuts", lambda c: F.slice("words", (c["first_word"] + 1).cast("int"), c["words"].cast("int")))
    text = F.when(F.col("cuts").isNull(), F.col("row.text")).otherwise(F.array_join(F.flatten(part), " "))
    rows = rows.select("row", text.alias("text"))
    new = {"text": F.col("text"), "n_chars": F.length("text").cast(docs.schema["n_chars"].dataType)}
    return rows.select(*[new.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences (op 8).

    A null text is empty and gives its end mark; repeated rows and null ids are
    documents of their own; long texts are cut.  No rows give no rows.
    """
    return packing.pack_documents(docs)


STAGES: list[tuple[str, Stage]] = [
    ("language", language),
    ("quality", good_quality),
    ("near_duplicates", near_duplicates),
    ("mixing", mixed),
    ("packing", packed),
]

# Compression, discriminants and packing have no SQL form; see tests/llm.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each reads what the one before it stored.

    Odd rows fare as each stage says.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = stored(docs)
    return docs
