"""Stages in the shared folder, word hashes and connected components."""

from __future__ import annotations

import tempfile
import uuid

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"


def shared_folder(spark: SparkSession) -> str:
    """A fresh path below the folder all executors share (``spark.checkpoint.dir``).

    A local master without that setting gets a temporary folder; any other
    master must name one.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base is None:
        if not spark.conf.get("spark.master", "").split("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="feedloom-llm-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/llm-{uuid.uuid4().hex}"


def stored(df: DataFrame) -> DataFrame:
    """Write a step once and go on from its files, without its lineage."""
    path = shared_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# Rows of whole texts that one Arrow batch may carry to a Python worker.
TEXT_ROWS = 256


def long_rows(df: DataFrame) -> DataFrame:
    """``df``, with the session's Arrow batches kept small enough for rows of long texts."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(df.sparkSession.conf.get(key)) <= TEXT_ROWS:
        df.sparkSession.conf.set(key, str(TEXT_ROWS))
    return df


def filtered(documents: DataFrame, keep) -> DataFrame:
    """The rows that ``keep``, a function of Arrow batches that reads ``text``, gives back.

    Other columns may have any name, dots included.
    """
    plain = documents.toDF(*[c if c == "text" else f"c{i}" for i, c in enumerate(documents.columns)])
    return plain.mapInArrow(keep, plain.schema).toDF(*documents.columns)


def need_columns(df: DataFrame, *names: str) -> None:
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"missing columns {missing}")


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values (xor-shift and multiply)."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x9E6C63D0876A9A35)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0xC2B2AE3D27D4EB4F)
    return x ^ (x >> np.uint64(32))


class WordHasher:
    """64-bit hashes of the ``WORD`` words of UTF-8 bytes, A-Z lower-cased.

    A word's hash is a polynomial of a random value per byte, found for all
    words at once; texts are taken in blocks cut at white space, so memory
    follows the block (or the longest word), not the text.
    """

    BLOCK = 1 << 20
    BASE = 0xD6E8FEB86659FD93  # odd, so it has an inverse modulo 2**64

    def __init__(self) -> None:
        code = np.arange(256)
        self.gap = (code == 32) | ((code >= 9) & (code <= 13))
        lower = np.where((code >= 65) & (code <= 90), code + 32, code).astype(np.uint64)
        self.value = mix(lower + np.uint64(0x632BE59BD9B4E019))
        self.value[self.gap] = 0
        self.power = self.inverse = np.ones(1, np.uint64)

    def _reach(self, n: int) -> None:
        if len(self.power) < n:
            n = max(n, 2 * len(self.power))
            back = np.full(n, pow(self.BASE, -1, 1 << 64), np.uint64)
            ahead = np.full(n, self.BASE, np.uint64)
            back[0] = ahead[0] = 1
            self.power, self.inverse = np.cumprod(ahead), np.cumprod(back)

    def _block(self, data: bytes) -> np.ndarray:
        raw = np.frombuffer(data, np.uint8)
        gap = np.ones(len(raw) + 2, bool)
        gap[1:-1] = self.gap[raw]
        edges = np.flatnonzero(gap[1:] != gap[:-1])
        starts, ends = edges[::2], edges[1::2]
        if not len(starts):
            return np.zeros(0, np.uint64)
        self._reach(len(raw))
        sums = np.add.reduceat(self.value[raw] * self.power[: len(raw)], starts)
        return mix(sums * self.inverse[starts] + (ends - starts).astype(np.uint64))

    def words(self, data: bytes) -> np.ndarray:
        if len(data) <= self.BLOCK:
            return self._block(data)
        parts, at = [], 0
        while at < len(data):
            end = at + self.BLOCK
            while end < len(data) and not self.gap[data[end]]:
                end += 1
            parts.append(self._block(data[at:end]))
            at = end
        return np.concatenate(parts)


def shingles(words: np.ndarray, size: int) -> np.ndarray:
    """Sorted distinct hashes of runs of ``size`` words (a shorter text is one run)."""
    if not len(words):
        return words
    size = min(size, len(words))
    total = np.full(len(words) - size + 1, size, np.uint64)
    for i in range(size):
        total = mix(total * np.uint64(0xFF51AFD7ED558CCD) + words[i : len(words) - size + 1 + i])
    return np.unique(total)


def components(edges: DataFrame) -> DataFrame:
    """Connected components of ``edges`` (a, b): rows (id, component).

    ``component`` is the smallest id reachable; ids without an edge are left
    out.  Alternates two star steps (link every larger neighbour, then every
    smaller one, to the smallest) until only stars are left.  Each round is one
    written stage; a hub is met only in partial minima and in joins that Spark
    can split.
    """
    pairs = edges.where("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    )
    pairs = stored(pairs.distinct())
    while True:
        node = pairs.select(F.col("a").alias("id"), F.lit(1).alias("tail"), F.lit(0).alias("head"))
        node = node.union(pairs.select("b", F.lit(0), F.lit(1)))
        node = node.groupBy("id").agg(F.sum("tail").alias("tail"), F.max("head").alias("head"))
        if node.where("tail > 1 OR (tail = 1 AND head = 1)").isEmpty():
            return pairs.select(F.col("a").alias("id"), F.col("b").alias("component"))
        both = pairs.union(pairs.select("b", "a")).toDF("u", "v")
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        least = least.select("u", F.least("m", "u").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("a"), "m")
        large = large.distinct()
        low = large.groupBy("a").agg(F.min("m").alias("b"))
        small = large.join(low, "a").where("m <> b").select(F.col("m").alias("a"), "b")
        pairs = stored(small.union(low).distinct())
