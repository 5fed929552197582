from __future__ import annotations

import math
import random
import re

import pytest
import shapes as s
from pyspark.sql import functions as F

from feedloom.operators.digest import WHOLE, render_digest, whole_reports, write_digest
from feedloom.operators.feed import (
    assemble_feed,
    canonical_operation,
    chain_pages,
    feed_changes,
    known_operation,
    max_pages,
    resolve_operations,
)
from feedloom.operators.flatten import flatten_timeline, page_summary
from feedloom.operators.ledger import close_runs, open_runs, run_totals
from feedloom.operators.merge import change_types
from feedloom.operators.parse import parse_tweets
from feedloom.operators.stats import parse_stats
from feedloom.sources.payloads import ingest_payloads

PARSED = (
    "run_id string, operation string, page_no int, instr_pos int, entry_pos int, item_pos int, "
    "drop_reason string, id bigint"
)
PAGES = "run_id string, operation string, page_no int, request_cursor string, next_cursor string"


def test_aliases(spark):
    names = [" Scheduled ", "both", "ALL", "home", "for-you", "foryou", "following", " Other "]
    frame = spark.createDataFrame([(n, n) for n in names], "asked string, operation string")
    got = {}
    for row in resolve_operations(frame).orderBy("asked", "feed_seq").collect():
        got.setdefault(row.asked, []).append(row.operation)
    pair = ["home", "following"]
    assert got == {
        " Scheduled ": pair, "both": pair, "ALL": pair, "home": ["home"], "for-you": ["home"],
        "foryou": ["home"], "following": ["following"], " Other ": ["other"],
    }


def crawl(pages, posts, count):
    """A feed page by page: the loop a crawler would run."""
    count = min(count, 500)
    if count <= 0:
        return [], []
    seen, feed, used, cursor = set(), [], [], None
    for page in pages[: math.ceil(count / 20) + 2]:
        used.append(page[2])
        for row in posts:
            if row[2] == page[2] and row[6] is None and row[7] and row[7] not in seen:
                seen.add(row[7])
                feed.append(row[7])
        cursor = page[3]
        if not page[4] or page[4] == cursor:
            break
    return feed[:count], used


@pytest.mark.parametrize("count", [0, 1, 7, 30, 10_000])
def test_feed_equals_crawl(spark, count):
    rng = random.Random(count)
    pages, posts, expected, chains = [], [], {}, {}
    for run in range(12):
        feed_pages, feed_posts = [], []
        for n in range(rng.randint(0, 35)):
            request = f"c{n}" if n else None
            following = rng.choices([f"c{n + 1}", request, None, ""], [40, 1, 1, 1])[0]
            feed_pages.append((f"r{run}", "home", n, request, following))
            for entry in range(rng.randint(0, 4)):
                reason = rng.choice([None, None, None, "dropped_tombstone"])
                feed_posts.append((f"r{run}", "home", n, 0, entry, 0, reason, rng.randint(0, 60)))
        expected[f"r{run}"], chains[f"r{run}"] = crawl(feed_pages, feed_posts, count)
        pages += feed_pages
        posts += feed_posts
    rng.shuffle(pages)
    rng.shuffle(posts)
    parsed = spark.createDataFrame(posts, PARSED)
    page_frame = spark.createDataFrame(pages, PAGES)
    got = {run: [] for run in expected}
    for row in assemble_feed(parsed, page_frame, count).orderBy("run_id", "feed_pos").collect():
        got[row.run_id].append(row.id)
    assert got == expected
    if count:
        kept = {run: [] for run in expected}
        for row in chain_pages(page_frame, count).orderBy("run_id", "page_no").collect():
            kept[row.run_id].append(row.page_no)
        assert kept == chains
    assert max_pages(500) == 27


def test_page_limit_is_applied_before_the_shuffle(spark):
    pages = spark.createDataFrame([("r", "home", 0, None, "c")], PAGES)
    plan = chain_pages(pages, 30)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_stats(spark):
    reasons = [None] * 2 + ["dropped_tombstone"] * 9 + ["dropped_promoted"]
    rows = [("a", r) for r in reasons] + [("b", "dropped_exception")] * 5 + [("c", None)]
    frame = spark.createDataFrame(rows, "source string, drop_reason string")
    got = {r.source: r for r in parse_stats(frame, ["source"]).collect()}
    a = got["a"]
    assert (a.raw, a.parsed, a.dropped_tombstone, a.dropped_promoted, a.dropped_no_result) == (12, 2, 9, 1, 0)
    assert a.drop_rate_percent == pytest.approx(10 / 12 * 100) and a.alert
    assert (got["b"].drop_rate_percent, got["b"].alert) == (100.0, False)
    assert (got["c"].drop_rate_percent, got["c"].alert) == (0.0, False)


def capture(spark, rows):
    return spark.createDataFrame(
        rows, "run_id string, operation string, page_no int, request_cursor string, value string"
    )


def test_ledger_and_digest(spark):
    import json

    long_reply = s.post(
        3,
        "cy",
        "third",
        {"in_reply_to_status_id_str": "2", "entities": {"urls": [{"expanded_url": "u1"}, {"expanded_url": "u2"}]}},
        quoted_status_result={"result": s.post(9, "", "quoted")},
    )
    photo = {"extended_entities": {"media": [{"type": "photo", "media_url_https": "p1"}, {"type": "photo"}]}}
    first = s.home(s.single(s.post(1, text="one", legacy=photo)), s.module(s.post(2, "bo", "two"), long_reply), s.cursor("n1"))
    second = s.home(s.single(s.post(1, text="again")), s.single({"__typename": "TweetTombstone"}), s.cursor("n2"))
    rows = [
        ("r1", "home", 0, None, json.dumps(first)),
        ("r1", "home", 1, "n1", json.dumps(second)),
        ("r1", "home", 2, "n2", '{"errors":[{"code":88,"message":"slow"}]}'),
        ("r1", "home", 3, "n3", json.dumps(s.home(s.single(s.post(50))))),
        ("r2", "following", 0, None, json.dumps(s.home(s.single(s.post(2, "bo", "two"))))),
        ("r3", "home", 0, None, "{"),
    ]
    payloads = ingest_payloads(capture(spark, rows)).persist()
    pages = page_summary(payloads).persist()
    parsed = parse_tweets(flatten_timeline(payloads), s.STAMP).persist()
    feed = assemble_feed(parsed, pages, 30).persist()
    current = spark.createDataFrame([(3,)], "id bigint")
    changes = change_types(current, feed)
    opened = open_runs(pages.select("run_id", "operation").distinct(), "2026-01-01", {"count": "30"})
    assert {r.status for r in opened.collect()} == {"running"}
    runs = close_runs(opened, pages, parsed, feed, changes, 30, "2026-01-02 03:04:05").persist()
    got = {r.id: r for r in runs.collect()}
    one = got["r1"]
    assert (one.status, one.tweets_fetched, one.tweets_new, one.tweets_updated) == ("failed", 3, 2, 1)
    assert [tuple(e) for e in one.errors] == [("SCRAPE_ERROR", "slow")]
    assert one.cursor_resume == "n2" and one.metadata == {"count": "30"}
    assert (one.parse_stats.raw, one.parse_stats.parsed, one.parse_stats.drop_rate_percent) == (5, 4, 20.0)
    two = got["r2"]
    assert (two.status, two.tweets_fetched, two.tweets_new, two.tweets_updated) == ("completed", 1, 0, 1)
    three = got["r3"]
    assert (three.status, three.tweets_fetched, three.errors[0].message) == ("failed", 0, "invalid JSON")

    report = render_digest(feed, changes, runs).persist()
    texts = {}
    for row in report.orderBy("run_id", "section", "feed_pos").collect():
        texts.setdefault(row.run_id, []).append(row.markdown)
    texts = {run: "\n".join(parts) for run, parts in texts.items()}
    head = [
        "# Scrape Report", "", "| Field | Value |", "|-------|-------|",
        "| **Timestamp** | 2026-01-02T03:04:05+00:00 |", "| **Operation** | home |",
    ]
    assert texts["r1"].split("\n") == head + [
        "| **Status** | failed |", "| **Tweets fetched** | 3 |", "| **New** | 2 |", "| **Updated** | 1 |",
        '| **Errors** | [{"code":"SCRAPE_ERROR","message":"slow"}] |', "",
        "---", "", "## New Tweets (2)", "",
        "### [1] @ann (2026-05-08 10:20 UTC)", "", "> one", "", "", "Media: p1", "",
        "### [2] @bo (2026-05-08 10:20 UTC)", "", "> two", "", "",
        "---", "", "## Updated Tweets (1)", "_These tweets were already in the table._", "",
        "### [3] @cy (2026-05-08 10:20 UTC)", "", "> third", "", "> Quoting quoted tweet: quoted", "",
        "> Replying to @bo: two", "", "", "URLs: u1, u2", "",
    ]
    assert texts["r3"].endswith("| **Updated** | 0 |\n| **Errors** | [{\"code\":\"SCRAPE_ERROR\",\"message\":\"invalid JSON\"}] |\n")


def test_long_report_is_written_in_order(spark):
    """A report that several tasks write reads as one text, and no step gathers it."""
    import datetime as dt
    import glob
    import os
    import tempfile

    n = 5000
    posts = spark.range(1, n + 1).select(
        F.lit("r").alias("run_id"), F.lit("home").alias("operation"), "id", F.col("id").alias("feed_pos"),
        F.lit("h").alias("author_handle"), F.lit("x").alias("text"), F.lit(dt.datetime(2026, 1, 1)).alias("created_at"),
        *[F.lit(None).cast("string").alias(c) for c in ("quoted_author_handle", "quoted_text", "reply_to_author_handle", "reply_to_text")],
        F.array().cast("array<string>").alias("urls"), F.array().cast("array<struct<url:string>>").alias("media_urls"),
    )
    changes = posts.select("id", F.when(F.col("id") % 2 == 0, "new").otherwise("updated").alias("change_type"))
    ledger = spark.sql(
        "SELECT 'r' AS id, 'home' AS operation, timestamp'2026-01-01' AS completed_at, 'completed' AS status,"
        f" {n} AS tweets_fetched, {n // 2} AS tweets_new, {n // 2} AS tweets_updated, array() AS errors"
    )
    report = render_digest(posts.repartition(7), changes, ledger)
    plan = report._jdf.queryExecution().executedPlan().toString()
    assert "collect_list" not in plan and "Window" not in plan
    path = tempfile.mkdtemp(prefix="feedloom-test-")
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        write_digest(report, path)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    (folder,) = glob.glob(f"{path}/run_id=r/operation=home/name=*")
    files = sorted(glob.glob(f"{folder}/*.txt"))
    text = "".join(open(f, encoding="utf-8").read() for f in files)
    numbers = [int(line[5 : line.index("]")]) for line in text.split("\n") if line.startswith("### [")]
    assert numbers == [*range(2, n + 1, 2), *range(1, n + 1, 2)] and len(files) > 1
    assert text.startswith("# Scrape Report\n") and os.path.basename(folder) == "name=scrape_home_20260101_000000"


def test_whole_reports_join_the_parts_in_order(spark):
    """Every report is also one text; a run without posts has its header only."""
    rows = [
        ("b", 2, 3, "three"), ("b", 1, 10, "ten"), ("b", 0, 0, "head"), ("b", 2, 0, "known"),
        ("b", 1, 0, "new"), ("b", 1, 2, "two"), ("a", 0, 0, "alone"),
    ]
    parts = spark.createDataFrame(rows, "run_id string, section int, feed_pos long, markdown string")
    parts = parts.withColumns({"operation": F.lit("home"), "name": F.concat(F.lit("n"), F.col("run_id"))})
    whole = whole_reports(parts.repartition(5))
    assert whole.columns == ["run_id", "operation", "name", "section", "feed_pos", "markdown"]
    assert sorted(tuple(r) for r in whole.collect()) == [
        ("a", "home", "na", WHOLE, 0, "alone"),
        ("b", "home", "nb", WHOLE, 0, "head\nnew\ntwo\nten\nknown\nthree"),
    ]


def test_uncapped_feed_has_no_window_over_a_feed(spark):
    rng = random.Random(2)
    pages = [("r", "home", n, f"c{n}" if n else None, f"c{n + 1}") for n in range(3000)]
    posts = [("r", "home", n, i, e, 0, None, rng.randint(1, 4000)) for n in range(3000) for i in range(2) for e in range(rng.randint(0, 2))]
    feed = assemble_feed(spark.createDataFrame(posts, PARSED), spark.createDataFrame(pages, PAGES))
    seen = {}
    for row in posts:
        seen.setdefault(row[7], len(seen) + 1)
    assert {r.id: r.feed_pos for r in feed.collect()} == seen
    plan = feed._jdf.queryExecution().executedPlan().toString()
    over = re.findall(r"Window \[row_number\(\) windowspecdefinition\(([^)]*?) ASC", plan)
    assert over and all("page_no" in keys or "id#" in keys for keys in over)


def test_names_of_feeds(spark):
    frame = spark.createDataFrame([(n,) for n in (" For-You ", "FORYOU", "home", "both", "x ", None)], "n string")
    got = [tuple(r) for r in frame.select(canonical_operation(F.col("n")), known_operation(canonical_operation(F.col("n")))).collect()]
    assert got == [("home", True), ("home", True), ("home", True), ("both", False), ("x", False), (None, False)]
    opened = {r.operation: r.errors for r in open_runs(frame.select(F.lit("r").alias("run_id"), canonical_operation(F.col("n")).alias("operation")), "2026-01-01").collect()}
    assert opened["home"] == [] and [tuple(e) for e in opened["x"]] == [("UNKNOWN_OPERATION", "x")]


def test_feeds_of_a_run_share_an_order(spark):
    """An id in both feeds is new in home; runs go by capture time, not by name."""
    rows = [
        ("z", "following", 1, 1, "2026-01-01 00:00:00"), ("z", "following", 3, 2, "2026-01-01 00:00:00"),
        ("z", "home", 1, 1, "2026-01-01 00:05:00"), ("z", "home", 2, 2, "2026-01-01 00:05:00"),
        ("a", "home", 3, 1, "2026-01-02 00:00:00"), ("a", "home", 4, 2, "2026-01-02 00:00:00"),
    ]
    feed = spark.createDataFrame(rows, "run_id string, operation string, id long, feed_pos int, captured string")
    feed = feed.withColumn("captured_at", F.col("captured").cast("timestamp"))
    changes = change_types(spark.createDataFrame([], "id bigint"), feed)
    got = {(r.run_id, r.operation): (r.tweets_new, r.tweets_updated) for r in run_totals(feed, changes).collect()}
    assert got == {("z", "home"): (2, 0), ("z", "following"): (1, 1), ("a", "home"): (1, 1)}
    new = {(r.run_id, r.operation, r.id) for r in feed_changes(feed, changes).where("change_type = 'new'").collect()}
    assert new == {("z", "home", 1), ("z", "home", 2), ("z", "following", 3), ("a", "home", 4)}


def test_no_count_keeps_everything(spark):
    pages = spark.createDataFrame([("r", "home", n, f"c{n}" if n else None, f"c{n + 1}") for n in range(40)], PAGES)
    posts = [("r", "home", n, 0, e, 0, None, n * 20 + e + 1) for n in range(40) for e in range(20)]
    parsed = spark.createDataFrame(posts, PARSED)
    assert assemble_feed(parsed, pages).count() == 800
    assert assemble_feed(parsed, pages, 10_000).count() == 500


def test_chain_stops_at_count(spark):
    pages = spark.createDataFrame([("r", "home", n, f"c{n}" if n else None, f"c{n + 1}") for n in range(5)], PAGES)
    posts = [("r", "home", n, 0, e, 0, None, i) for n, ids in enumerate(((1, 2), (2, 3), (4,))) for e, i in enumerate(ids)]
    parsed = spark.createDataFrame(posts, PARSED)
    kept = [r.page_no for r in chain_pages(pages, 3, parsed).orderBy("page_no").collect()]
    assert kept == [0, 1]
