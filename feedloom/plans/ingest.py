"""The whole pipeline for one batch of captured pages."""

from __future__ import annotations

import tempfile
import uuid
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedloom.operators.digest import digest_tasks, render_digest, write_digest
from feedloom.operators.feed import (
    ARRIVAL,
    FEED,
    PAGE,
    canonical_operation,
    cap_feed,
    chain_pages,
    feed_changes,
    known_operation,
    merge_order,
    seen_on_chain,
)
from feedloom.operators.flatten import flatten_timeline, page_summary
from feedloom.operators.ledger import close_feeds, fail_runs, latest_runs, open_runs, page_counters
from feedloom.operators.maintenance import split_valid, validate_tweets
from feedloom.operators.merge import delta_tweets, delta_users
from feedloom.operators.parse import parse_tweets
from feedloom.operators.profiles import parse_profiles
from feedloom.operators.stats import COUNTERS, alert, counter_columns, drop_rate
from feedloom.schemas import RUNS, TWEETS, USERS
from feedloom.session import configure
from feedloom.sources.payloads import ingest_payloads
from feedloom.sources.tables import RANGE_BITS, STAMP_FORMAT, VersionedTable


def stored(df: DataFrame, path: str) -> DataFrame:
    """Write a step once and go on from the files: no recomputation, no lineage."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stored_pages(captured: DataFrame, path: str) -> tuple[DataFrame, DataFrame]:
    """Captured pages stored as text in one pass: their payloads, and their summary.

    Payloads are parsed from the text again where they are read, which costs less
    than writing and reading them as variants; a summary reads no text.
    """
    rows = stored(page_summary(ingest_payloads(captured), text=True), path)
    parsed = F.when(F.col("status") == "ok", F.try_parse_json("value"))
    return rows.withColumn("v", parsed).drop("next_cursor"), rows.drop("value")


def shared_dir(spark: SparkSession) -> str:
    """A fresh folder below the checkpoint folder that all executors reach.

    Where no such folder is configured, a local master (tests) gets a temporary
    one; any other master must name one.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base is None:
        if not spark.conf.get("spark.master", "").startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        return tempfile.mkdtemp(prefix="feedloom-")
    return f"{base.rstrip('/')}/feedloom-{uuid.uuid4().hex}"


def parse_pages(pages: DataFrame, ingest_ts: datetime | str) -> DataFrame:
    """Captured pages to parsed candidates in one shuffle-free stage."""
    return parse_tweets(flatten_timeline(ingest_payloads(pages)), ingest_ts)


def tweet_table(spark: SparkSession, path: str, range_bits: int = RANGE_BITS) -> VersionedTable:
    return VersionedTable(spark, f"{path}/tweets", TWEETS, range_bits)


def user_table(spark: SparkSession, path: str, range_bits: int = RANGE_BITS) -> VersionedTable:
    return VersionedTable(
        spark, f"{path}/users", USERS, range_bits, sticky=("created_at",), stamp="last_scraped_at"
    )


def run_ledger_table(spark: SparkSession, path: str) -> DataFrame:
    """The latest ledger row of every run and feed."""
    schema = T.StructType([*RUNS.fields, T.StructField("v", T.LongType())])
    opened, closed = (spark.read.schema(schema).parquet(f"{path}/{d}") for d in ("runs_open", "runs"))
    return latest_runs(opened, closed)


# State of runs lies in folders by hash of the run, at most so many.
STATE_BUCKETS = 64
# Where a post was first seen, and whether the table had it before.
SEEN = "id BIGINT, page_no INT, instr_pos INT, entry_pos INT, item_pos INT, is_new BOOLEAN"


def _bucket() -> Column:
    return F.pmod(F.xxhash64("run_id"), F.lit(STATE_BUCKETS)).cast("int")


def _write_state(rows: DataFrame, path: str, version: int) -> None:
    rows = rows.withColumn("run_bucket", _bucket()).hint("rebalance", "run_bucket")
    rows.write.mode("overwrite").partitionBy("run_bucket").parquet(f"{path}/v={version}")


def _read_state(schema: T.StructType, path: str, version: int, runs: DataFrame, buckets: list[int]) -> DataFrame:
    """What the versions before ``version`` stored of ``runs``; only their folders are read."""
    extra = T.StructType.fromDDL("v BIGINT, run_bucket INT").fields
    rows = runs.sparkSession.read.schema(T.StructType([*schema.fields, *extra])).parquet(path)
    rows = rows.where((F.col("v") < version) & F.col("run_bucket").isin(buckets))
    return rows.join(runs, "run_id", "left_semi").select(*schema.fieldNames())


def _ingest_time(bronze: DataFrame, table: VersionedTable, version: int) -> str | None:
    """Latest capture time of a batch, but not before what earlier versions stored."""
    latest = bronze.agg(F.date_format(F.max("captured_at"), STAMP_FORMAT)).first()[0]
    return latest and max(latest, table.manifest(before=version).stamp or latest)


def ingest_batch(
    pages: DataFrame,
    path: str,
    version: int,
    ingest_ts: datetime | str | None = None,
    count: int | None = None,
    range_bits: int = RANGE_BITS,
    on_violation: str = "quarantine",
) -> bool:
    """Bronze -> parse -> feed -> merge -> ledger -> digest under ``path``.

    ``pages`` has ``run_id, operation, page_no, request_cursor, captured_at,
    value`` and optionally ``http_status``; an operation may be any name of one
    feed.  The pages of a run may come in several batches.  A batch parses its own
    pages only; of earlier ones it reads a row per page and a row per id, from
    which feed places and ledger rows are made.  Its digest has the posts it
    brought.  ``ingest_ts`` defaults
    to the latest capture time (never earlier than a former batch's), so a
    replayed batch gives the same rows; a version that was stored is left as it
    is.  Every captured post is kept; ``count`` limits each feed as a crawler
    would (at most 500 posts, and the pages that many need).
    Posts that break a constraint of the table are kept aside under
    ``quarantine``, or with ``on_violation="fail"`` stop the whole batch.
    A run is ``running`` in the ledger until its batch is done, and ``failed``
    if the batch breaks off.
    """
    spark = configure(pages.sparkSession)
    posts = tweet_table(spark, path, range_bits)
    named = pages.withColumn("operation", canonical_operation(F.col("operation")))
    bronze, summary = stored_pages(named, f"{path}/bronze/v={version}")
    if ingest_ts is None:
        ingest_ts = _ingest_time(bronze, posts, version)
        if ingest_ts is None:
            return False
    limits = {"count": "all" if count is None else str(count)}
    opened = stored(
        open_runs(bronze.select(*FEED).distinct(), ingest_ts, limits), f"{path}/runs_open/v={version}"
    )
    try:
        return _ingest(bronze, summary, opened, posts, path, version, ingest_ts, count, on_violation)
    except Exception as error:
        failed = fail_runs(opened, str(error)[:500], ingest_ts)
        failed.write.mode("overwrite").parquet(f"{path}/runs/v={version}")
        raise


def _ingest(
    bronze: DataFrame,
    summary: DataFrame,
    opened: DataFrame,
    posts: VersionedTable,
    path: str,
    version: int,
    ingest_ts: datetime | str,
    count: int | None,
    on_violation: str,
) -> bool:
    """Own pages plus narrow state: page rows with counters, and where ids were first seen."""
    spark = opened.sparkSession
    known = bronze.where(known_operation(F.col("operation")))
    candidates = parse_tweets(flatten_timeline(known), ingest_ts)
    observed = Observation("parsed")
    parsed = stored(candidates.observe(observed, *counter_columns()), f"{path}/parsed/v={version}")
    _write_stats(spark, observed.get, f"{path}/batch_stats/v={version}")
    own_pages = summary.where(known_operation(F.col("operation"))).join(page_counters(parsed), list(PAGE), "left")
    own_pages = stored(own_pages, f"{path}/pages/v={version}")

    runs = opened.select(F.col("id").alias("run_id")).distinct()
    buckets = [r[0] for r in runs.select(_bucket()).distinct().collect()]  # at most STATE_BUCKETS
    pages_state, seen_state = f"{path}/state_pages", f"{path}/state_seen"
    _write_state(own_pages, pages_state, version)
    pages = _read_state(own_pages.schema, pages_state, version, runs, buckets).unionByName(own_pages)
    seen_schema = T.StructType([*[parsed.schema[c] for c in FEED], *T.StructType.fromDDL(SEEN).fields])
    before = _seen_before(spark, seen_schema, seen_state, version, runs, buckets)
    before = before.withColumn("drop_reason", F.lit(None).cast("string"))

    # Ids of the batch beside those the runs had: who is first, and in which place.
    keys = [*FEED, *ARRIVAL, "id", "drop_reason"]
    own = parsed.select(*keys, F.lit(True).alias("own"))
    all_seen = own.unionByName(before.select(*keys, F.lit(False).alias("own")))
    # Numbering reads them twice, once for the sizes of pages.
    seen = stored(seen_on_chain(all_seen, pages, count), f"{path}/seen/v={version}")
    places = stored(cap_feed(seen, count), f"{path}/places/v={version}")
    fresh = places.where("own").select(*FEED, *ARRIVAL, "id", "feed_pos")
    feed = parsed.where("drop_reason IS NULL").drop("drop_reason").join(fresh, [*FEED, *ARRIVAL, "id"])
    checked = stored(validate_tweets(feed, unique=False), f"{path}/checked/v={version}")
    valid, broken = split_valid(checked, on_violation)
    feed = stored(merge_order(valid), f"{path}/feeds/v={version}")
    broken.write.mode("overwrite").parquet(f"{path}/quarantine/v={version}")
    order = F.struct("feed_order", "feed_pos")
    committed = posts.commit(version, feed, lambda table, new: delta_tweets(table, new, ingest_ts, order))
    changes = posts.changes(version)

    is_new = (F.col("change_type") == "new").alias("is_new")
    told = feed_changes(feed, changes).select(*[c for c in seen_schema.fieldNames() if c != "is_new"], is_new)
    _write_state(told, seen_state, version)
    totals = _feed_totals(places, told, before)
    kept = chain_pages(pages, count, all_seen)
    counters = kept.select(*PAGE, *[F.coalesce(c, F.lit(0)).alias(c) for c in COUNTERS])
    closed = stored(close_feeds(opened, kept, counters, totals, ingest_ts), f"{path}/runs/v={version}")
    digest = render_digest(feed, changes, closed)
    write_digest(digest, f"{path}/digest/v={version}", digest_tasks(closed.count(), feed.count()))
    return committed


def _seen_before(
    spark: SparkSession, schema: T.StructType, path: str, version: int, runs: DataFrame, buckets: list[int]
) -> DataFrame:
    """First places of ids in earlier batches; a batch may have brought an earlier page later."""
    try:
        return _read_state(schema, path, version, runs, buckets)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], schema)
        raise


def _feed_totals(places: DataFrame, told: DataFrame, before: DataFrame) -> DataFrame:
    """Fetched, new and updated posts of each feed over all its batches.

    An id counts where it is first seen on the kept pages; it is new if the batch
    that first brought it to this feed was also the first to store it.
    """
    key = [*FEED, "id"]
    stored_by = told.select(*key, "is_new").unionByName(before.select(*key, "is_new"))
    stored_by = stored_by.groupBy(*key).agg(F.max("is_new").alias("is_new"))
    rows = places.select(*key).join(stored_by, key)  # what broke a constraint was not stored
    return rows.groupBy(*FEED).agg(
        F.count("*").alias("tweets_fetched"),
        F.count_if("is_new").alias("tweets_new"),
        F.count_if(~F.col("is_new")).alias("tweets_updated"),
    )


def _write_stats(spark: SparkSession, counters: dict, path: str) -> None:
    """Counters of a batch, gathered while it was written, with the drop alert."""
    row = spark.createDataFrame([tuple(int(counters.get(c) or 0) for c in COUNTERS)], [*COUNTERS])
    row.select(*COUNTERS, drop_rate().alias("drop_rate_percent"), alert().alias("alert")).coalesce(1).write.mode(
        "overwrite"
    ).json(path)


def ingest_profiles(
    pages: DataFrame, path: str, version: int, ingest_ts: datetime | str | None = None
) -> bool:
    """Merge the profiles of captured payloads into the users table under ``path``.

    Of several payloads with one user the one captured last counts.
    """
    spark = configure(pages.sparkSession)
    users = user_table(spark, path)
    ordered = pages.withColumn("seq", F.struct("captured_at", F.xxhash64("value")))
    bronze = stored(ingest_payloads(ordered), f"{path}/profile_bronze/v={version}")
    if ingest_ts is None:
        ingest_ts = _ingest_time(bronze, users, version)
        if ingest_ts is None:
            return False
    parsed = stored(parse_profiles(bronze), f"{path}/profiles/v={version}")
    kept = parsed.where("drop_reason IS NULL")
    return users.commit(version, kept, lambda keys, new: delta_users(keys, new, ingest_ts))
