"""Inverted text index with word stems, and all-terms search."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.functions.stems import stem_words

# English stop words of the full-text configuration.
STOP_WORDS = tuple(
    """
    i me my myself we our ours ourselves you your yours yourself yourselves he him
    his himself she her hers herself it its itself they them their theirs themselves
    what which who whom this that these those am is are was were be been being have
    has had having do does did doing a an the and but if or because as until while of
    at by for with about against between into through during before after above below
    to from up down in out on off over under again further then once here there when
    where why how all any both each few more most other some such no nor not only own
    same so than too very s t can will just don should now
    """.split()
)
BUCKETS = 256


def words_of(text: Column) -> Column:
    """Distinct lower-case words of a text; '' may be one.

    Plain ASCII is cut by a class of characters that is cheap to test.
    """
    ascii_only = F.octet_length(text) == F.length(text)
    plain = F.split(F.lower(text), "[^a-z0-9_]+", -1)
    words = F.when(ascii_only, plain).otherwise(F.split(F.lower(text), r"(?U)\W+", -1))
    return F.array_distinct(words)


def terms_of(text: Column) -> Column:
    """Distinct lower-case words of a text without stop words."""
    return F.array_except(words_of(text), F.array(F.lit(""), *map(F.lit, STOP_WORDS)))


def build_text_index(tweets: DataFrame, text: str = "text") -> DataFrame:
    """Postings ``(term, id)``, one row per word and post.

    Rows instead of one list per word: a common word never has to fit one
    group, and the build needs no shuffle.
    """
    return tweets.select("id", F.explode(terms_of(F.col(text))).alias("term")).select(
        _bucket("term").alias("term_bucket"), "term", "id"
    )


def write_text_index(index: DataFrame, path: str) -> None:
    """Store postings by word bucket, sorted, so a search reads few row groups.

    Rebalancing gathers a bucket into few files, but splits a bucket that is
    too big for one task, as that of a very common word may be.
    """
    (
        index.hint("rebalance", "term_bucket")
        .sortWithinPartitions("term_bucket", "term", "id")
        .write.mode("overwrite")
        .partitionBy("term_bucket")
        .parquet(path)
    )


def query_terms(spark: SparkSession, query: str) -> DataFrame:
    """Terms of a query string, cut exactly as the index cuts texts, and their stems."""
    one = spark.range(1).select(F.explode(terms_of(F.lit(query))).alias("term"))
    return stem_words(one)


def _bucket(column: str) -> Column:
    return F.pmod(F.xxhash64(column), F.lit(BUCKETS))


def search(index: DataFrame, query: str) -> DataFrame:
    """Ids of posts holding every term of ``query`` as written; none for an empty query.

    Both filters are constants: they prune bucket folders and reach the scan.
    """
    rows = query_terms(index.sparkSession, query).select(_bucket("term").alias("b"), "term").collect()
    hits = index.where(F.col("term_bucket").isin(sorted({r.b for r in rows})) & F.col("term").isin([r.term for r in rows]))
    return hits.groupBy("id").agg(F.count("*").alias("_n")).where(F.col("_n") == len(rows)).select("id")


class TextIndex:
    """A stored index in segments, one per batch of posts.

    Layout::

        <path>/postings/segment=<n>/term_bucket=<b>/  # words as written, and ids
        <path>/lexicon/segment=<n>/stem_bucket=<b>/   # stems, and their words
        <path>/posts/segment=<n>/                     # ids the segment has
        <path>/segments/segment=<n>/                  # written last: the segment exists

    Only the distinct words of a segment are stemmed; postings keep words as
    written, so no posting is ever joined to a stem.  A post that a later segment
    has again is found by its new words only.
    """

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark = spark
        self.path = path.rstrip("/")

    def _folder(self, kind: str, segment: int) -> str:
        return f"{self.path}/{kind}/segment={segment}"

    def segments(self) -> list[int]:
        try:
            rows = self.spark.read.schema("size LONG, segment INT").json(f"{self.path}/segments")
        except AnalysisException as error:
            if error.getCondition() == "PATH_NOT_FOUND":
                return []
            raise
        return sorted(r.segment for r in rows.select("segment").distinct().collect())

    def append(self, segment: int, posts: DataFrame, text: str = "text") -> bool:
        """Index ``posts`` (id, text); False if the segment exists.  Ids are unique in it."""
        known = self.segments()
        if known and known[-1] >= segment:
            return False
        write_text_index(build_text_index(posts, text), self._folder("postings", segment))
        words = self.spark.read.schema("term STRING, id LONG, term_bucket INT")
        words = words.parquet(self._folder("postings", segment)).select("term").distinct()
        lexicon = stem_words(words).withColumn("stem_bucket", _bucket("stem"))
        lexicon = lexicon.hint("rebalance", "stem_bucket").sortWithinPartitions("stem_bucket", "stem")
        lexicon.write.mode("overwrite").partitionBy("stem_bucket").parquet(self._folder("lexicon", segment))
        ids = posts.select("id").repartitionByRange("id").sortWithinPartitions("id")
        ids.write.mode("overwrite").parquet(self._folder("posts", segment))
        size = self.spark.read.schema("id LONG").parquet(self._folder("posts", segment)).count()
        self.spark.createDataFrame([(size,)], "size LONG").coalesce(1).write.mode("overwrite").json(
            self._folder("segments", segment)
        )
        return True

    def _read(self, kind: str, schema: str) -> DataFrame:
        segments = self.segments()
        rows = self.spark.read.schema(f"{schema}, segment INT").parquet(f"{self.path}/{kind}")
        return rows.where(F.col("segment").isin(segments))

    def words(self, query: str) -> dict[str, str]:
        """The indexed words that share a stem with the query's, with that stem.

        Only the folders of those stems are read; a stem has few words.
        """
        asked = query_terms(self.spark, query).select("stem", _bucket("stem").alias("b")).distinct().collect()
        if not asked:
            return {}
        lexicon = self._read("lexicon", "term STRING, stem STRING, stem_bucket INT")
        own = F.col("stem_bucket").isin(sorted({r.b for r in asked})) & F.col("stem").isin([r.stem for r in asked])
        found = {r.term: r.stem for r in lexicon.where(own).select("term", "stem").distinct().collect()}
        return found if set(found.values()) == {r.stem for r in asked} else {}

    def search(self, query: str) -> DataFrame:
        """Ids of posts whose newest text has, for every term, a word of its stem."""
        stems = self.words(query)
        if not stems:
            return self.spark.createDataFrame([], "id LONG")
        buckets = self.spark.createDataFrame([(t,) for t in stems], "term STRING").select(_bucket("term").alias("b"))
        hits = self._read("postings", "term STRING, id LONG, term_bucket INT")
        hits = hits.where(F.col("term_bucket").isin(sorted({r.b for r in buckets.collect()})))
        hits = hits.where(F.col("term").isin(list(stems)))
        stem = F.create_map(*[F.lit(x) for item in stems.items() for x in item])[F.col("term")]
        hits = hits.groupBy("id", "segment").agg(F.count_distinct(stem).alias("_n"))
        hits = hits.where(F.col("_n") == len(set(stems.values()))).select("id", "segment")
        newest = self._read("posts", "id LONG").join(hits.select("id"), "id", "left_semi")
        newest = newest.groupBy("id").agg(F.max("segment").alias("segment"))
        return hits.join(newest, ["id", "segment"]).select("id")
