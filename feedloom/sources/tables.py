"""Versioned tables on plain Parquet folders.

Every version appends the rows its batch changed; nothing older is rewritten.
Layout::

    <path>/data/part=<part>/day=<date>/*.parquet      # rows, by day they were stored
    <path>/keys/part=<part>/id_range=<n>/*.parquet    # each id once: what it keeps for good
    <path>/manifest/v=<version>/g=<generation>/*.json # the parts that make the table

A part is ``b<version>`` (a batch) or ``c<version>`` (all parts up to a version,
compacted).  A version exists once its manifest does, so readers see all of a
batch or none of it, and a replayed batch finds its own version and does
nothing.  One writer at a time.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Post ids grow with time: one range is about 19 hours of posts, and a signed
# 64-bit id has at most 65,536 ranges, the bound of what a commit collects.
RANGE_BITS = 48
MAX_RANGES = 65_536

MANIFEST = "part STRING, stamp STRING"
STAMP_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"
# What a version records beside its rows.
CHANGES = "change_type STRING, batch_rows BIGINT, first_run STRING, first_operation STRING"


class Manifest(NamedTuple):
    version: int | None = None
    generation: int = 0
    parts: tuple[str, ...] = ()
    stamp: str | None = None  # latest time any row was stored


def _read_or_none(read: Callable[[], DataFrame]) -> DataFrame | None:
    try:
        return read()
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


class VersionedTable:
    """A table keyed by ``id`` with numbered, atomic versions.

    ``sticky`` columns keep the value an id was first stored with; ``stamp`` is
    the time a row was stored and never falls from one version to the next, so
    the latest row of an id lies in its latest day.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        schema: T.StructType,
        range_bits: int = RANGE_BITS,
        sticky: tuple[str, ...] = ("created_at", "source_operation"),
        stamp: str = "scraped_at",
    ) -> None:
        self.spark = spark
        self.path = path.rstrip("/")
        self.schema = schema
        self.range_bits = range_bits
        self.sticky = sticky
        self.stamp_column = stamp

    def id_range(self) -> Column:
        return F.shiftright(F.col("id"), self.range_bits)

    def manifest(self, before: int | None = None) -> Manifest:
        """The latest version (below ``before``).  Of all manifests one is read."""
        root = f"{self.path}/manifest"
        table = _read_or_none(lambda: self.spark.read.schema(MANIFEST).json(root))
        names = [] if table is None else table.inputFiles()
        found = {tuple(map(int, re.search(r"/v=(\d+)/g=(\d+)/", n).groups())) for n in names}
        found = {f for f in found if before is None or f[0] < before}
        if not found:
            return Manifest()
        version, generation = max(found)
        rows = self.spark.read.schema(MANIFEST).json(f"{root}/v={version}/g={generation}").collect()
        # A version without parts still carries one marker row.
        parts = tuple(r.part for r in rows if r.part is not None)
        return Manifest(version, generation, parts, max((r.stamp for r in rows if r.stamp), default=None))

    def _publish(self, new: Manifest) -> None:
        rows = [(p, new.stamp) for p in new.parts] or [(None, new.stamp)]
        self.spark.createDataFrame(rows, MANIFEST).coalesce(1).write.mode("overwrite").option(
            "ignoreNullFields", "false"
        ).json(f"{self.path}/manifest/v={new.version}/g={new.generation}")

    def version(self) -> int | None:
        return self.manifest().version

    def _parts(self, kind: str, parts: tuple[str, ...], schema: T.StructType) -> DataFrame:
        if not parts:
            return self.spark.createDataFrame([], schema)
        folders = [f"{self.path}/{kind}/part={p}" for p in parts]
        return self.spark.read.schema(schema).option("basePath", f"{self.path}/{kind}").parquet(*folders)

    def _row_schema(self) -> T.StructType:
        extra = T.StructType.fromDDL(f"{CHANGES}, version BIGINT, part STRING, day DATE")
        return T.StructType(self.schema.fields + extra.fields)

    def _keys(self, parts: tuple[str, ...]) -> DataFrame:
        fields = [self.schema[c] for c in ("id", *self.sticky)]
        extra = T.StructType.fromDDL("part STRING, id_range BIGINT")
        return self._parts("keys", parts, T.StructType(fields + extra.fields)).drop("part")

    def _latest(self, parts: tuple[str, ...], since: Column | None = None) -> DataFrame:
        """The newest row of every id, with the version that stored it."""
        rows = self._parts("data", parts, self._row_schema())
        if since is not None:
            rows = rows.where(F.col("day") >= F.to_date(since))
        columns = [*self.schema.fieldNames(), "version"]
        if len(parts) > 1:  # a part holds an id once
            rest = [c for c in columns if c != "id"]
            rows = rows.groupBy("id").agg(F.max_by(F.struct(*rest), "version").alias("_row"))
            rows = rows.select("id", "_row.*")
        rows = rows if since is None else rows.where(F.col(self.stamp_column) > since)
        return rows.select(*columns)

    def read(self, since: Column | None = None) -> DataFrame:
        """Rows of the latest version; with ``since`` those stored later than it.

        Only the folders of the days from ``since`` on are read then: a row in
        an earlier day is not the latest of its id, or was stored earlier.
        """
        return self._latest(self.manifest().parts, since).drop("version")

    def changes(self, *versions: int) -> DataFrame:
        """``id`` and what the versions recorded for each id they stored."""
        columns = ["id", *T.StructType.fromDDL(CHANGES).fieldNames()]
        found = self._parts("data", (), self._row_schema())
        for version in versions:
            part = _read_or_none(lambda v=version: self._parts("data", (f"b{v}",), self._row_schema()))
            found = found if part is None else found.unionByName(part)
        return found.select(*columns)

    def commit(
        self, version: int, batch: DataFrame, merge: Callable[[DataFrame, DataFrame], DataFrame]
    ) -> bool:
        """Append ``merge(keys, batch)`` as ``version``; False if it exists.

        ``keys`` holds the stored ids of the ranges the batch touches, with
        their sticky columns; ``merge`` returns one row per id of the batch,
        with ``change_type``.  ``batch`` should be cheap to read twice (a stored
        table).
        """
        known = self.manifest()
        if known.version is not None and known.version >= version:
            return False
        part = f"b{version}"
        ranges = batch.select(self.id_range().alias("r")).where("r IS NOT NULL").distinct()
        touched = [row.r for row in ranges.limit(MAX_RANGES + 1).collect()]
        if len(touched) > MAX_RANGES:
            raise ValueError(f"more than {MAX_RANGES} id ranges: range_bits={self.range_bits} is too small")
        if not touched:
            self._publish(Manifest(version, 0, known.parts, known.stamp))
            return True
        keys = self._keys(known.parts).where(F.col("id_range").isin(touched)).drop("id_range")
        rows = merge(keys, batch)
        for field in T.StructType.fromDDL(CHANGES).fields:
            if field.name not in rows.columns:
                rows = rows.withColumn(field.name, F.lit(None).cast(field.dataType))
        rows = rows.withColumn("version", F.lit(version).cast("long"))
        self._write("data", part, rows.withColumn("day", F.to_date(self.stamp_column)), "day")
        stored = self._parts("data", (part,), self._row_schema())
        stamp = F.col(self.stamp_column)
        low, high = stored.agg(
            *[F.date_format(f(stamp), STAMP_FORMAT) for f in (F.min, F.max)]
        ).first()
        if known.stamp is not None and low < known.stamp:
            raise ValueError(f"{self.stamp_column} {low} of version {version} is before {known.stamp}")
        new = stored.where("change_type = 'new'").select("id", *self.sticky)
        self._write("keys", part, new.withColumn("id_range", self.id_range()), "id_range")
        self._publish(Manifest(version, 0, (*known.parts, part), high))
        return True

    def _write(self, kind: str, part: str, rows: DataFrame, by: str) -> None:
        # Rebalancing joins small files and splits partitions that are too big.
        rows = rows.hint("rebalance", by).sortWithinPartitions(by, "id")
        rows.write.mode("overwrite").partitionBy(by).parquet(f"{self.path}/{kind}/part={part}")

    def compact(self) -> bool:
        """Rewrite the latest version as one part, so that reads resolve nothing.

        A maintenance job of its own: batches never rewrite old rows.  Folders
        of parts that no manifest in use names may then be removed.
        """
        known = self.manifest()
        if len(known.parts) < 2:
            return False
        part = f"c{known.version}"
        rows = self._latest(known.parts).withColumn("day", F.to_date(self.stamp_column))
        self._write("data", part, rows, "day")
        self._write("keys", part, self._keys(known.parts), "id_range")
        self._publish(Manifest(known.version, known.generation + 1, (part,), known.stamp))
        return True
