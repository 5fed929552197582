"""Merging a batch of posts (or users) into the current table."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.operators.feed import FEED
from feedloom.operators.parse import timestamp_literal
from feedloom.schemas import TWEETS, USERS

# Columns that keep the value of the first time an id was stored.
STICKY = ("created_at", "source_operation")
COLUMNS = tuple(TWEETS.fieldNames())
REFRESHED = tuple(c for c in COLUMNS if c not in ("id", "scraped_at", *STICKY))

USER_COLUMNS = tuple(USERS.fieldNames())
USER_REFRESHED = tuple(
    c for c in USER_COLUMNS if c not in ("id", "created_at", "last_scraped_at")
)


def fold_batch(batch: DataFrame, order: Column) -> DataFrame:
    """The batch with one row per id: first sticky values, last other values.

    ``min_by``/``max_by`` are combined inside each task before the shuffle, so a
    much repeated id does not load one reducer.
    """
    feed = [F.col(c) if c in batch.columns else F.lit(None).cast("string").alias(c) for c in FEED]
    return batch.groupBy("id").agg(
        F.min_by(F.struct(*STICKY, *feed), order).alias("_first"),
        F.max_by(F.struct(*REFRESHED), order).alias("_last"),
        F.count("*").alias("batch_rows"),
    )


def merge_tweets(
    current: DataFrame, batch: DataFrame, ingest_ts: datetime | str | Column, order: Column | str = "seq"
) -> DataFrame:
    """The table after the batch, plus ``change_type`` and ``batch_rows``.

    An existing id keeps ``created_at`` and ``source_operation``; every other
    column takes the last batch value, nulls included.  ``change_type`` is
    ``new``, ``updated`` or ``unchanged``.  Both sides of the join are unique on
    ``id``, so no key is skewed; Spark chooses the join from measured sizes.
    """
    order = F.col(order) if isinstance(order, str) else order
    stamp = timestamp_literal(ingest_ts)
    cur = current.select("id", F.struct(*[c for c in COLUMNS if c != "id"]).alias("_cur"))
    joined = cur.join(fold_batch(batch, order), "id", "full_outer")
    touched, known = F.col("batch_rows").isNotNull(), F.col("_cur").isNotNull()

    def column(name: str) -> Column:
        if name == "id":
            return F.col("id")
        old = F.col(f"_cur.{name}")
        if name == "scraped_at":
            return F.when(touched, stamp).otherwise(old)
        if name in STICKY:
            return F.when(known, old).otherwise(F.col(f"_first.{name}"))
        return F.when(touched, F.col(f"_last.{name}")).otherwise(old)

    change = F.when(~touched, "unchanged").when(known, "updated").otherwise("new")
    return joined.select(
        *[column(c).alias(c) for c in COLUMNS],
        change.alias("change_type"),
        F.coalesce("batch_rows", F.lit(0)).alias("batch_rows"),
    )


def delta_tweets(
    keys: DataFrame, batch: DataFrame, ingest_ts: datetime | str | Column, order: Column | str = "seq"
) -> DataFrame:
    """The rows of ``merge_tweets`` that the batch changes.

    ``keys`` needs only the stored ids and their sticky columns, as every other
    column comes from the batch.  ``first_run`` and ``first_operation`` name the
    feed that brought a new id.
    """
    order = F.col(order) if isinstance(order, str) else order
    known = F.col("_key").isNotNull()
    stored = keys.select("id", F.struct(*STICKY).alias("_key"))
    rows = fold_batch(batch, order).join(stored, "id", "left")

    def column(name: str) -> Column:
        if name == "id":
            return F.col("id")
        if name == "scraped_at":
            return timestamp_literal(ingest_ts)
        if name in STICKY:
            return F.when(known, F.col(f"_key.{name}")).otherwise(F.col(f"_first.{name}"))
        return F.col(f"_last.{name}")

    run, operation = FEED
    return rows.select(
        *[column(c).alias(c) for c in COLUMNS],
        F.when(known, "updated").otherwise("new").alias("change_type"),
        "batch_rows",
        F.when(~known, F.col(f"_first.{run}")).alias("first_run"),
        F.when(~known, F.col(f"_first.{operation}")).alias("first_operation"),
    )


def merge_counts(merged: DataFrame, by: list[str] | None = None) -> DataFrame:
    """``new_count`` and ``updated_count`` of a merge.

    Repeats of an id that was new count as updates.
    """
    new = F.count_if(F.col("change_type") == "new")
    rows = F.coalesce(F.sum("batch_rows"), F.lit(0))
    return merged.groupBy(*(by or [])).agg(
        new.alias("new_count"), (rows - new).alias("updated_count")
    )


def change_types(current: DataFrame, batch: DataFrame) -> DataFrame:
    """``(id, change_type)`` of every batch id, without building the table."""
    ids = batch.select("id").distinct()
    known = current.select("id", F.lit(True).alias("_known"))
    return ids.join(known, "id", "left").select(
        "id", F.when(F.col("_known"), "updated").otherwise("new").alias("change_type")
    )


def upsert_users(
    current: DataFrame, profiles: DataFrame, ingest_ts: datetime | str | Column, order: str = "seq"
) -> DataFrame:
    """Latest profile per id; ``created_at`` is the time it was first seen."""
    stamp = timestamp_literal(ingest_ts)
    last = (
        profiles.where("drop_reason IS NULL")
        .groupBy("id")
        .agg(F.max_by(F.struct(*USER_REFRESHED), F.col(order)).alias("_last"))
    )
    cur = current.select("id", F.struct(*[c for c in USER_COLUMNS if c != "id"]).alias("_cur"))
    joined = cur.join(last, "id", "full_outer")
    touched = F.col("_last").isNotNull()
    refreshed = [
        F.when(touched, F.col(f"_last.{c}")).otherwise(F.col(f"_cur.{c}")).alias(c)
        for c in USER_REFRESHED
    ]
    return joined.select(
        "id",
        *refreshed,
        F.when(touched, stamp).otherwise(F.col("_cur.last_scraped_at")).alias("last_scraped_at"),
        F.coalesce(F.col("_cur.created_at"), stamp).alias("created_at"),
    )


def delta_users(
    keys: DataFrame, profiles: DataFrame, ingest_ts: datetime | str | Column, order: str = "seq"
) -> DataFrame:
    """The rows of ``upsert_users`` that the profiles change; ``keys`` as in ``delta_tweets``."""
    stamp = timestamp_literal(ingest_ts)
    last = (
        profiles.where("drop_reason IS NULL")
        .groupBy("id")
        .agg(
            F.max_by(F.struct(*USER_REFRESHED), F.col(order)).alias("_last"),
            F.count("*").alias("batch_rows"),
        )
    )
    rows = last.join(keys.select("id", F.col("created_at").alias("_since")), "id", "left")
    return rows.select(
        "id",
        "_last.*",
        stamp.alias("last_scraped_at"),
        F.coalesce("_since", stamp).alias("created_at"),
        F.when(F.col("_since").isNull(), "new").otherwise("updated").alias("change_type"),
        "batch_rows",
    )
