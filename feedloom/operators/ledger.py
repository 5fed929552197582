"""Run ledger: one row per run and feed."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.operators.feed import FEED, PAGE, chain_pages, feed_changes, known_operation
from feedloom.operators.parse import timestamp_literal
from feedloom.operators.stats import COUNTERS, counter_columns, drop_rate
from feedloom.schemas import RUNS

# Error codes of the ledger.
PAGE_ERROR = "SCRAPE_ERROR"
STORE_ERROR = "DB_ERROR"
NAME_ERROR = "UNKNOWN_OPERATION"


def open_runs(
    requests: DataFrame, started_at: datetime | str | Column, metadata: dict[str, str] | None = None
) -> DataFrame:
    """Ledger rows with status ``running`` for ``(run_id, operation)`` requests.

    An operation that names no feed is noted as an error from the start.
    """
    unknown = F.struct(F.lit(NAME_ERROR).alias("code"), F.col("operation").alias("message"))
    errors = F.array_compact(F.array(F.when(~known_operation(F.col("operation")), unknown)))
    pairs = [F.lit(x) for item in (metadata or {}).items() for x in item]
    filled = {
        "id": F.col("run_id"),
        "started_at": timestamp_literal(started_at),
        "status": F.lit("running"),
        "operation": F.col("operation"),
        "tweets_fetched": F.lit(0),
        "tweets_new": F.lit(0),
        "tweets_updated": F.lit(0),
        "errors": errors,
        "metadata": F.create_map(*pairs),
    }
    return requests.select(
        *[
            filled.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name)
            for f in RUNS.fields
        ]
    )


def fail_runs(opened: DataFrame, message: str, completed_at: datetime | str | Column) -> DataFrame:
    """Ledger rows of runs whose work broke off."""
    error = F.array(F.struct(F.lit(STORE_ERROR).alias("code"), F.lit(message).alias("message")))
    return opened.withColumns(
        {"status": F.lit("failed"), "completed_at": timestamp_literal(completed_at), "errors": error}
    )


def latest_runs(opened: DataFrame, closed: DataFrame) -> DataFrame:
    """One row per run and feed out of all that were written, by version ``v``.

    Of equal versions the closed row counts; ``started_at`` is the first one.
    """
    columns = list(RUNS.fieldNames())
    rows = opened.withColumn("_step", F.lit(0)).unionByName(closed.withColumn("_step", F.lit(1)))
    rest = [c for c in columns if c not in ("id", "operation", "started_at")]
    last = rows.groupBy("id", "operation").agg(
        F.max_by(F.struct(*rest), F.struct("v", "_step")).alias("_row"),
        F.min("started_at").alias("started_at"),
    )
    return last.select("id", "operation", "started_at", "_row.*").select(*columns)


def run_totals(feed: DataFrame, changes: DataFrame) -> DataFrame:
    """Fetched, new and updated posts per feed.

    ``changes`` holds ``(id, change_type)``; feeds follow ``merge_order``.
    """
    new = F.count_if(F.col("change_type") == "new")
    return feed_changes(feed, changes).groupBy(*FEED).agg(
        F.count("*").alias("tweets_fetched"),
        new.alias("tweets_new"),
        (F.count("*") - new).alias("tweets_updated"),
    )


def page_counters(parsed: DataFrame) -> DataFrame:
    """Counters of every page that held anything to parse; they add up to a feed's."""
    return parsed.groupBy(*PAGE).agg(*counter_columns())


def close_runs(
    opened: DataFrame,
    pages: DataFrame,
    parsed: DataFrame,
    feed: DataFrame,
    changes: DataFrame,
    count: int | None,
    completed_at: datetime | str | Column,
) -> DataFrame:
    """Finished ledger rows.

    A run fails on the first page of its chain that is not ``ok`` (which also
    ends the chain); ``cursor_resume`` is the last kept next cursor, and
    ``parse_stats`` covers the kept pages.
    """
    kept = chain_pages(pages, count, parsed)
    counters = page_counters(parsed.join(kept.select(*PAGE), list(PAGE), "left_semi"))
    return close_feeds(opened, kept, counters, run_totals(feed, changes), completed_at)


def close_feeds(
    opened: DataFrame,
    kept: DataFrame,
    counters: DataFrame,
    totals: DataFrame,
    completed_at: datetime | str | Column,
) -> DataFrame:
    """``close_runs`` from the kept pages, their counters and the feeds' totals.

    A feed whose operation is unknown fails with that code, whatever its pages are.
    """
    bad = F.col("status") != "ok"
    error = F.struct(
        F.lit(PAGE_ERROR).alias("code"), F.col("error_message").alias("message")
    )
    chains = kept.groupBy(*FEED).agg(
        F.min_by(F.when(bad, error), F.when(bad, F.col("page_no"))).alias("_error"),
        F.max_by("next_cursor", F.when(F.col("next_cursor") != "", F.col("page_no"))).alias(
            "_cursor"
        ),
    )
    counted = counters.groupBy(*FEED).agg(*[F.sum(c).alias(c) for c in COUNTERS])
    stats = counted.select(*FEED, F.struct(*COUNTERS, F.round(drop_rate(), 1).alias("drop_rate_percent")).alias("_stats"))
    rows = opened.withColumnRenamed("id", "run_id").select(
        "run_id", "started_at", "operation", "metadata", F.col("errors").alias("_opened")
    )
    for part in (chains, totals, stats):
        rows = rows.join(part, list(FEED), "left")
    errors = F.when(F.size("_opened") > 0, F.col("_opened")).when(
        F.col("_error").isNotNull(), F.array("_error")
    )
    errors = F.coalesce(errors, F.array())
    filled = {
        "id": F.col("run_id"),
        "started_at": F.col("started_at"),
        "completed_at": timestamp_literal(completed_at),
        "status": F.when(F.size(errors) > 0, "failed").otherwise("completed"),
        "operation": F.col("operation"),
        "tweets_fetched": F.coalesce("tweets_fetched", F.lit(0)),
        "tweets_new": F.coalesce("tweets_new", F.lit(0)),
        "tweets_updated": F.coalesce("tweets_updated", F.lit(0)),
        "errors": errors,
        "cursor_resume": F.col("_cursor"),
        "metadata": F.col("metadata"),
        "parse_stats": F.col("_stats"),
    }
    return rows.select(*[filled[f.name].cast(f.dataType).alias(f.name) for f in RUNS.fields])
