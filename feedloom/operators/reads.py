"""Incremental read for downstream consumers."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.operators.parse import timestamp_literal
from feedloom.sources.tables import VersionedTable


def read_unprocessed(
    tweets: DataFrame | VersionedTable, now: datetime | str | Column, hours: int = 24, limit: int = 100
) -> DataFrame:
    """Posts stored in the last ``hours``, oldest first, at most ``limit``.

    The bound is strict and a constant, so it reaches the Parquet scan; order
    and limit become one top-k, not a full sort.  Of a stored table only the days
    since that bound are read.
    """
    bound = timestamp_literal(now) - F.expr(f"INTERVAL {int(hours)} HOURS")
    if isinstance(tweets, VersionedTable):
        tweets = tweets.read(since=bound)
    return tweets.where(F.col("scraped_at") > bound).orderBy("scraped_at", "id").limit(limit)
