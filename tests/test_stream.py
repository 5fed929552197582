from __future__ import annotations

import datetime as dt
import glob
import json
import os
import tempfile

import pytest
import shapes as s

from feedloom.operators.digest import digest_tasks
from feedloom.plans.ingest import ingest_batch, ingest_profiles, run_ledger_table, tweet_table, user_table
from feedloom.streaming.ingest import CAPTURE, stream_ingest


def write_page(folder, name, run, operation, page_no, body, minute, request=None):
    row = {
        "run_id": run,
        "operation": operation,
        "page_no": page_no,
        "request_cursor": request,
        "captured_at": f"2026-01-01T00:{minute:02d}:00Z",
        "value": body if isinstance(body, str) else json.dumps(body),
    }
    with open(os.path.join(folder, name), "a", encoding="utf-8") as out:
        out.write(json.dumps(row) + "\n")


def table_rows(table):
    return sorted((r.id, r.text, r.source_operation, r.scraped_at) for r in table.read().collect())


def test_stream_and_replay(spark):
    base = tempfile.mkdtemp(prefix="feedloom-test-")
    inbox, out = f"{base}/in", f"{base}/out"
    os.makedirs(inbox)
    write_page(inbox, "a.json", "r1", "home", 0, s.home(s.single(s.post(1, text="one")), s.module(s.post(2, text="two"))), 1)
    write_page(inbox, "a.json", "r2", "following", 0, s.home(s.single(s.post(2, text="two b")), s.single(s.post(3))), 2)

    def run():
        query = stream_ingest(spark, inbox, out, f"{base}/checkpoint", range_bits=4)
        query.awaitTermination()
        assert query.exception() is None

    run()
    table = tweet_table(spark, out, 4)
    first = dt.datetime(2026, 1, 1, 0, 2)
    assert table_rows(table) == [
        (1, "one", "home", first), (2, "two b", "home", first), (3, "hello", "following", first),
    ]
    runs = {r.id: r for r in spark.read.parquet(f"{out}/runs/v=0").collect()}
    assert (runs["r1"].tweets_new, runs["r1"].tweets_updated) == (2, 0)
    assert (runs["r2"].tweets_new, runs["r2"].tweets_updated) == (1, 1)
    assert "## New Tweets (2)" in "\n".join(r.value for r in spark.read.text(f"{out}/digest/v=0/run_id=r1").collect())

    write_page(inbox, "b.json", "r3", "home", 0, s.home(s.single(s.post(1, text="one again"))), 9)
    write_page(inbox, "b.json", "r4", "home", 0, "not json", 9)
    run()
    second = dt.datetime(2026, 1, 1, 0, 9)
    stored = table_rows(table)
    assert stored[0] == (1, "one again", "home", second) and len(stored) == 3
    assert {r.id: r.status for r in spark.read.parquet(f"{out}/runs/v=1").collect()} == {"r3": "completed", "r4": "failed"}

    # A batch replayed after its commit changes neither the table nor its counts.
    pages = spark.read.schema(CAPTURE).json(f"{inbox}/b.json")
    assert not ingest_batch(pages, out, 1, range_bits=4)
    assert table_rows(table) == stored
    again = {r.id: r for r in spark.read.parquet(f"{out}/runs/v=1").collect()}
    assert (again["r3"].tweets_new, again["r3"].tweets_updated) == (0, 1)


def test_batch_equals_stream(spark):
    base = tempfile.mkdtemp(prefix="feedloom-test-")
    inbox = f"{base}/in"
    os.makedirs(inbox)
    for n in range(5):
        request = f"c{n}" if n else None
        body = s.home(*[s.single(s.post(n * 3 + i + 1, text=f"p{n}")) for i in range(6)], s.cursor(f"c{n + 1}"))
        write_page(inbox, "a.json", "r", "home", n, body, n, request)
    stream_ingest(spark, inbox, f"{base}/stream", f"{base}/checkpoint", count=12).awaitTermination()
    ingest_batch(spark.read.schema(CAPTURE).json(inbox), f"{base}/batch", 0, count=12)
    streamed, batched = (table_rows(tweet_table(spark, f"{base}/{k}")) for k in ("stream", "batch"))
    assert streamed == batched and len(streamed) == 12


def ledger(spark, path):
    rows = run_ledger_table(spark, path).collect()
    return {
        (r.id, r.operation): (r.status, r.tweets_fetched, r.tweets_new, r.tweets_updated, r.cursor_resume, r.parse_stats.raw)
        for r in rows
    }


@pytest.mark.parametrize("count", [None, 3])
def test_run_over_several_batches(spark, count):
    """One page per batch gives the posts and ledger of one batch."""
    base = tempfile.mkdtemp(prefix="feedloom-test-")
    inbox = f"{base}/in"
    os.makedirs(inbox)
    bodies = [
        ("r1", "home", 0, s.home(s.single(s.post(1)), s.single(s.post(2)), s.cursor("a")), None),
        ("r1", "following", 0, s.home(s.single(s.post(1)), s.single(s.post(9))), None),
        ("r1", "home", 1, s.home(s.single(s.post(2, text="late")), s.single(s.post(3)), s.cursor("b")), "a"),
        ("r2", "home", 0, s.home(s.single(s.post(3, text="r2"))), None),
        ("r1", "home", 2, "not json", "b"),
    ]
    pages = []
    for i, (run, operation, no, body, request) in enumerate(bodies):
        write_page(inbox, f"{i}.json", run, operation, no, body, i, request)
        os.utime(f"{inbox}/{i}.json", (i + 1, i + 1))
        pages.append(spark.read.schema(CAPTURE).json(f"{inbox}/{i}.json"))
    # Runs are merged one after the other, so r2 comes last in the single batch too.
    stream_ingest(spark, inbox, f"{base}/stream", f"{base}/checkpoint", count, 1).awaitTermination()
    ingest_batch(spark.read.schema(CAPTURE).json(inbox), f"{base}/batch", 0, count=count)
    streamed, batched = ({r[:3] for r in table_rows(tweet_table(spark, f"{base}/{k}"))} for k in ("stream", "batch"))
    assert streamed == batched and len(streamed) == 4
    expected = ledger(spark, f"{base}/batch")
    assert ledger(spark, f"{base}/stream") == expected
    assert expected["r1", "home"][:4] == ("completed" if count else "failed", 3, 3, 0)
    assert expected["r1", "following"][:4] == ("completed", 2, 1, 1)
    # A replayed batch changes nothing.
    assert not ingest_batch(pages[2], f"{base}/stream", 2, count=count)
    assert ledger(spark, f"{base}/stream") == expected


def test_broken_batch_in_ledger(spark):
    base = tempfile.mkdtemp(prefix="feedloom-test-")
    os.makedirs(f"{base}/in")
    write_page(f"{base}/in", "a.json", "r", "home", 0, s.home(s.single(s.post(2, handle="h" * 51))), 1)
    pages = spark.read.schema(CAPTURE).json(f"{base}/in")
    with pytest.raises(Exception, match="constraint broken"):
        ingest_batch(pages, f"{base}/out", 0, on_violation="fail")
    row = run_ledger_table(spark, f"{base}/out").first()
    assert (row.status, row.errors[0].code) == ("failed", "DB_ERROR") and "constraint" in row.errors[0].message
    assert [r.status for r in spark.read.parquet(f"{base}/out/runs_open").collect()] == ["running"]
    ingest_batch(pages, f"{base}/out", 0)
    assert [r.status for r in run_ledger_table(spark, f"{base}/out").collect()] == ["completed"]


def test_stored_users(spark):
    base = tempfile.mkdtemp(prefix="feedloom-test-")
    os.makedirs(f"{base}/in")
    for version, (name, minute) in enumerate([("old", 1), ("new", 9)]):
        user = {"data": {"user": {"result": {"rest_id": "5", "legacy": {"screen_name": "s", "name": name}}}}}
        write_page(f"{base}/in", f"{version}.json", "r", "profile", 0, user, minute)
        assert ingest_profiles(spark.read.schema(CAPTURE).json(f"{base}/in/{version}.json"), f"{base}/out", version)
    users = user_table(spark, f"{base}/out").read().collect()
    stamps = [dt.datetime(2026, 1, 1, 0, 1), dt.datetime(2026, 1, 1, 0, 9)]
    assert [(r.id, r.name, r.created_at, r.last_scraped_at) for r in users] == [(5, "new", *stamps)]
    assert not ingest_profiles(spark.read.schema(CAPTURE).json(f"{base}/in/1.json"), f"{base}/out", 1)


def test_broken_constraints(spark):
    base = tempfile.mkdtemp(prefix="feedloom-test-")
    os.makedirs(f"{base}/in")
    body = s.home(s.single(s.post(1)), s.single(s.post(2, handle="h" * 51)))
    write_page(f"{base}/in", "a.json", "r", "home", 0, body, 1)
    pages = spark.read.schema(CAPTURE).json(f"{base}/in")
    with pytest.raises(Exception, match="constraint broken by id 2"):
        ingest_batch(pages, f"{base}/out", 0, on_violation="fail")
    assert tweet_table(spark, f"{base}/out").version() is None
    assert ingest_batch(pages, f"{base}/out", 0)
    assert [r.id for r in tweet_table(spark, f"{base}/out").read().collect()] == [1]
    kept = spark.read.parquet(f"{base}/out/quarantine/v=0").collect()
    assert [(r.id, r.violations) for r in kept] == [(2, ["author_handle_longer_than_50"])]


def test_many_short_reports_are_shared_among_tasks(spark):
    """A report is a folder; bytes alone would put all of them into one task."""
    base = tempfile.mkdtemp(prefix="feedloom-test-")
    os.makedirs(f"{base}/in")
    runs = [f"r{i:03d}" for i in range(130)]
    for i, run in enumerate(runs):
        write_page(f"{base}/in", "a.json", run, "home", 0, s.home(s.single(s.post(i + 1)), s.single(s.post(i + 2))), 1)
    ingest_batch(spark.read.schema(CAPTURE).json(f"{base}/in"), f"{base}/out", 0)
    files = glob.glob(f"{base}/out/digest/v=0/run_id=*/operation=home/name=*/part-*")
    assert len({os.path.basename(f).split("-")[1] for f in files}) >= 3
    lines = spark.read.text(f"{base}/out/digest/v=0").where("startswith(value, '### [')")
    assert {(r.run_id, r["count"]) for r in lines.groupBy("run_id").count().collect()} == {(r, 2) for r in runs}
    # Places are numbered from stored rows, not worked out for every use.
    seen = spark.read.parquet(f"{base}/out/seen/v=0").select("run_id", "id").collect()
    assert len(seen) == len(set(seen)) == 2 * len(runs)


def test_digest_tasks():
    assert [digest_tasks(*n) for n in ((0, 0), (64, 20_000), (65, 0), (1, 20_001), (36_000, 0))] == [1, 1, 2, 2, 563]
