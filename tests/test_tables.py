from __future__ import annotations

import datetime as dt
import json
import random
import re
import tempfile

import pytest
import shapes as s
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedloom.functions.stems import stem_words
from feedloom.operators.articles import articles_to_markdown
from feedloom.operators.maintenance import (
    OBSOLETE_TWEET_COLUMNS,
    conform_legacy,
    conform_legacy_users,
    split_valid,
    validate_tweets,
    validate_users,
    with_defaults,
    with_user_defaults,
)
from feedloom.operators.merge import COLUMNS, delta_tweets, merge_counts, merge_tweets, upsert_users
from feedloom.operators.profiles import parse_profiles
from feedloom.operators.reads import read_unprocessed
from feedloom.operators.search import TextIndex, build_text_index, search, write_text_index
from feedloom.schemas import RUNS, TWEETS, USERS
from feedloom.sources.payloads import ingest_payloads
from feedloom.sources.tables import VersionedTable

NOW = dt.datetime(2026, 2, 1)


def tweet(tweet_id, **values):
    base = {
        "id": tweet_id, "author_id": 1, "author_handle": "h", "author_name": "n",
        "created_at": dt.datetime(2026, 1, 1), "text": "t", "urls": [], "media_urls": [],
        "source_operation": "home", "scraped_at": dt.datetime(2026, 1, 1),
    }
    base.update(values)
    return tuple(base.get(c) for c in COLUMNS)


def frame(spark, rows):
    return spark.createDataFrame(rows, TWEETS)


def batch_frame(spark, rows):
    schema = T.StructType([*TWEETS.fields, T.StructField("seq", T.LongType())])
    return spark.createDataFrame([r + (i,) for i, r in enumerate(rows)], schema)


def replay(current, batch):
    """Row by row: insert, or on a known id overwrite all but the sticky columns."""
    table = {r[0]: dict(zip(COLUMNS, r, strict=True)) for r in current}
    new = updated = 0
    for row in batch:
        values = dict(zip(COLUMNS, row, strict=True)) | {"scraped_at": NOW}
        if row[0] in table:
            kept = {c: table[row[0]][c] for c in ("created_at", "source_operation")}
            table[row[0]] = values | kept
            updated += 1
        else:
            table[row[0]] = values
            new += 1
    return sorted(tuple(v.values()) for v in table.values()), new, updated


@pytest.mark.parametrize("seed", range(3))
def test_merge_equals_row_by_row(spark, seed):
    rng = random.Random(seed)

    def any_tweet(i):
        return tweet(
            rng.randint(1, 25),
            text=f"t{seed}-{i}",
            created_at=dt.datetime(2025, 1, 1) + dt.timedelta(days=i),
            source_operation=rng.choice(["home", "following"]),
            reply_to_text=rng.choice([None, "r"]),
            quoted_tweet_id=rng.choice([None, 5]),
        )

    current = list({r[0]: r for r in (any_tweet(i) for i in range(12))}.values())
    batch = [any_tweet(100 + i) for i in range(30 * (seed > 0))]
    merged = merge_tweets(frame(spark, current), batch_frame(spark, batch), NOW).persist()
    rows, new, updated = replay(current, batch)
    assert sorted(tuple(r) for r in merged.select(*COLUMNS).collect()) == rows
    assert tuple(merge_counts(merged).first()) == (new, updated)


def test_versioned_table_and_replay(spark):
    path = tempfile.mkdtemp(prefix="feedloom-test-")
    table = VersionedTable(spark, path, TWEETS, range_bits=3)
    assert table.version() is None and table.read().count() == 0

    def commit(version, rows):
        batch = batch_frame(spark, rows)
        return table.commit(version, batch, lambda keys, new: delta_tweets(keys, new, NOW))

    first, second = [tweet(1), tweet(9), tweet(20)], [tweet(9, text="x"), tweet(10), tweet(-5), tweet(9, text="y")]
    assert commit(0, first) and commit(1, []) and commit(2, second)
    rows, _, _ = replay([], first + second)
    stored = sorted(tuple(r) for r in table.read().select(*COLUMNS).collect())
    assert stored == rows
    assert {(r.id, r.change_type, r.batch_rows) for r in table.changes(2).collect()} == {
        (9, "updated", 2), (10, "new", 1), (-5, "new", 1),
    }
    # A batch without rows adds no part.
    assert table.manifest().parts == ("b0", "b2")
    # Replaying a stored version changes nothing.
    assert not commit(2, second) and not commit(0, first)
    assert sorted(tuple(r) for r in table.read().select(*COLUMNS).collect()) == stored
    # A batch that died before its manifest leaves the old version readable.
    frame(spark, [tweet(1, text="half")]).write.parquet(f"{path}/data/part=b3/day=2026-01-02")
    assert sorted(tuple(r) for r in table.read().select(*COLUMNS).collect()) == stored
    assert commit(3, [tweet(1, text="whole")])
    assert {r.text for r in table.read().where("id = 1").collect()} == {"whole"}
    stored = sorted(tuple(r) for r in table.read().select(*COLUMNS).collect())
    assert table.compact() and table.manifest().parts == ("c3",) and not table.compact()
    assert sorted(tuple(r) for r in table.read().select(*COLUMNS).collect()) == stored
    assert not commit(3, [tweet(1)]) and commit(4, [tweet(10, text="z")])
    assert {(r.id, r.change_type) for r in table.changes(4).collect()} == {(10, "updated")}
    assert {r.text for r in table.read().where("id = 10").collect()} == {"z"}


def test_stored_rows_are_read_by_day(spark):
    table = VersionedTable(spark, tempfile.mkdtemp(prefix="feedloom-test-"), TWEETS)
    rows = {0: [tweet(i) for i in range(6)], 1: [tweet(2, text="b"), tweet(7)], 2: [tweet(2, text="c")]}
    days = {0: NOW - dt.timedelta(days=9), 1: NOW - dt.timedelta(hours=5), 2: NOW}
    for v, batch in rows.items():
        table.commit(v, batch_frame(spark, batch), lambda keys, new, v=v: delta_tweets(keys, new, days[v]))
    recent = read_unprocessed(table, NOW)
    assert [(r.id, r.text) for r in recent.collect()] == [(7, "t"), (2, "c")]
    scans = [n for n in recent._jdf.queryExecution().executedPlan().toString().split("\n") if "FileScan" in n]
    assert scans and all("day#" in n.split("PartitionFilters:")[1] for n in scans)
    with pytest.raises(ValueError, match="is before"):
        table.commit(3, batch_frame(spark, rows[0]), lambda keys, new: delta_tweets(keys, new, days[0]))
    few = VersionedTable(spark, tempfile.mkdtemp(prefix="feedloom-test-"), TWEETS, range_bits=0)
    many = batch_frame(spark, [tweet(0)]).crossJoin(spark.range(70_000).withColumnRenamed("id", "n")).withColumn("id", F.col("n"))
    with pytest.raises(ValueError, match="range_bits"):
        few.commit(0, many, lambda keys, new: delta_tweets(keys, new, NOW))


def test_users(spark):
    def user(**legacy):
        return {"data": {"user": {"result": {"rest_id": "5", "legacy": legacy}}}}

    bodies = {
        "full": {
            "data": {
                "user": {
                    "result": {
                        "rest_id": "4611686018427387905",
                        "is_blue_verified": True,
                        "legacy": {
                            "screen_name": "s", "name": "n", "description": "d", "followers_count": 3,
                            "friends_count": "4", "statuses_count": "1,234", "profile_image_url_https": "p",
                        },
                    }
                }
            }
        },
        "asked": user(name="n"),
        "verified": user(screen_name="v", verified=1),
        "none": {"data": {"user": {"result": {}}}},
        "bad id": {"data": {"user": {"result": {"rest_id": "x"}}}},
        "null id": {"data": {"user": {"result": {"rest_id": None, "a": 1}}}},
        "no id": {"data": {"user": {"result": {"legacy": {"screen_name": "z"}}}}},
        "null name": user(screen_name="v", name=None),
        "text legacy": {"data": {"user": {"result": {"rest_id": "6", "legacy": "x"}}}},
        "text user": {"data": {"user": {"result": "x"}}},
    }
    rows = [(k, f"@{k}", json.dumps(v)) for k, v in bodies.items()]
    pages = spark.createDataFrame(rows, "seq string, requested_name string, value string")
    parsed = parse_profiles(ingest_payloads(pages)).persist()
    got = {r.seq: r for r in parsed.collect()}
    assert {k: r.drop_reason for k, r in got.items()} == {
        "full": None, "asked": None, "verified": None, "no id": None, "bad id": "dropped_schema_fail",
        "null id": "dropped_schema_fail", "null name": "dropped_schema_fail",
        "text legacy": "dropped_exception", "text user": "dropped_exception",
    }
    full = got["full"]
    assert (full.id, full.screen_name, full.bio) == (4611686018427387905, "s", "d")
    assert (full.followers_count, full.following_count, full.tweets_count, full.verified) == (3, 4, 0, True)
    assert got["asked"].screen_name == "@asked" and not got["asked"].verified
    assert got["verified"].verified and got["no id"].id == 0
    empty = spark.createDataFrame([], USERS)
    users = upsert_users(empty, parsed, "2026-01-01")
    assert users.columns == USERS.fieldNames()
    assert {r.id: r.screen_name for r in users.collect()} == {0: "z", 5: "v", full.id: "s"}
    later = upsert_users(users, parsed.where("seq = 'full'"), "2026-03-01").where(F.col("id") == full.id).first()
    assert (later.created_at, later.last_scraped_at) == (dt.datetime(2026, 1, 1), dt.datetime(2026, 3, 1))


@pytest.mark.parametrize("columns", [("text_raw", "text_normalized"), ("text_raw",), ("text_normalized",), ()])
def test_conform_legacy(spark, columns):
    rows = [
        (text, raw, norm)
        for text in ("own", "", None)
        for raw in ("raw", "", None)
        for norm in ("norm", "", None)
    ]
    old = spark.createDataFrame(rows, "text string, text_raw string, text_normalized string")
    keep = ["text", *columns]
    old = old.select(*keep, F.lit(1).alias("id"), F.lit(None).cast("bigint").alias("author_id"), F.lit(3).alias("likes"))

    def filled(row):
        text, raw, norm = row
        if text:
            return text
        return ("text_normalized" in columns and norm) or ("text_raw" in columns and raw) or text

    got = conform_legacy(old)
    assert got.columns == list(COLUMNS)
    assert not set(got.columns) & set(OBSOLETE_TWEET_COLUMNS)
    key = lambda v: (v is None, v or "")
    assert sorted((r.text for r in got.collect()), key=key) == sorted(map(filled, rows), key=key)
    assert {r.author_id for r in got.collect()} == {0}


def test_kept_and_dropped_columns():
    assert not set(TWEETS.fieldNames()) & set(OBSOLETE_TWEET_COLUMNS)
    assert {"author_id", "reply_to_tweet_id", "quoted_tweet_id", "text", "scraped_at"} <= set(TWEETS.fieldNames())
    assert len(OBSOLETE_TWEET_COLUMNS) == 19
    assert RUNS["status"].dataType.simpleString() == "string"


def test_validate_and_split(spark):
    columns = [T.StructField(f.name, f.dataType) for f in TWEETS.fields]
    nullable = spark.createDataFrame(
        [
            tweet(1), tweet(2), tweet(2, author_handle="x" * 51), tweet(3, text=None),
            tweet(None), tweet(None), tweet(4, author_name=None, quoted_author_handle="q" * 50),
        ],
        T.StructType(columns),
    )
    checked = validate_tweets(nullable)
    got = sorted((r.id or 0, r.violations) for r in checked.collect())
    assert got == [
        (0, ["id_null"]), (0, ["id_null"]), (1, []),
        (2, ["author_handle_longer_than_50", "id_repeated"]), (2, ["id_repeated"]),
        (3, ["text_null"]), (4, []),
    ]
    valid, quarantine = split_valid(checked)
    assert sorted(r.id for r in valid.collect()) == [1, 4] and quarantine.count() == 5
    with pytest.raises(Exception, match="constraint broken"):
        split_valid(checked, "fail")[0].collect()
    fine = validate_tweets(nullable.where("id in (1, 4)"))
    assert split_valid(fine, "fail")[0].count() == 2
    assert with_defaults(nullable.where("id = 4")).first().author_name == ""


def test_users_layout(spark):
    old = spark.createDataFrame(
        [(1, "s", None)], "id bigint, screen_name string, followers_count int"
    ).select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in USERS.fields[2:] if f.name != "followers_count"], F.lit("j").alias("raw_json"))
    users = with_user_defaults(conform_legacy_users(old))
    row = users.first()
    assert users.columns == USERS.fieldNames() and (row.followers_count, row.verified) == (0, False)
    assert validate_users(users).first().violations == ["last_scraped_at_null", "created_at_null"]


def test_read_unprocessed(spark):
    rows = [tweet(i, scraped_at=NOW - dt.timedelta(hours=h)) for i, h in [(1, 24), (2, 23), (3, 23), (4, 1), (5, 30)]]
    table = frame(spark, rows)
    assert [r.id for r in read_unprocessed(table, NOW).collect()] == [2, 3, 4]
    assert [r.id for r in read_unprocessed(table, NOW, hours=48, limit=2).collect()] == [5, 1]
    plan = read_unprocessed(table, NOW)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan


def test_search(spark):
    texts = {1: "The quick brown Fox", 2: "quick, quick! fox-trot", 3: "Élan brown", 4: "of the and", 5: None}
    docs = spark.createDataFrame(list(texts.items()), "id bigint, text string")
    index = build_text_index(docs)
    path = tempfile.mkdtemp(prefix="feedloom-test-") + "/index"
    write_text_index(index, path)
    for table in (index, spark.read.parquet(path)):
        found = {q: sorted(r.id for r in search(table, q).collect()) for q in ("the FOX", "fox quick", "élan", "none", "the")}
        assert found == {"the FOX": [1, 2], "fox quick": [1, 2], "élan": [3], "none": [], "the": []}
    plan = search(spark.read.parquet(path), "fox")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(term_bucket" in plan and "PushedFilters" in plan


def test_stems(spark):
    expected = dict(
        pair.split(":")
        for pair in """
        consign:consign consistency:consist consistent:consist knightly:knight generous:generous generate:generat
        hopping:hop hoped:hope hop:hop relational:relat rational:ration skies:sky dying:die happy:happi says:say
        ponies:poni cries:cri ties:tie agreed:agre feed:feed enjoying:enjoy boy:boy luxuriating:luxuri gas:gas this:this
        kiwis:kiwi caresses:caress sensational:sensat conditional:condit fluently:fluentli vileness:vile adoption:adopt
        adjustment:adjust controlling:control rolled:roll bed:bed shed:shed shredded:shred news:news inning:inning
        innings:inning proceed:proceed proceeds:proceed by:by sky:sky only:onli archaeology:archaeolog run:run runs:run
        running:run sized:size fitted:fit bowed:bow boxed:box yellow:yellow youth:youth sayings:say probate:probat
        communism:communism commune:commune arsenal:arsenal cosmos:cosmos w2s:w2s a_s:a_s
        """.split()
    )
    rows = stem_words(spark.createDataFrame([(w,) for w in [*expected, None]], "term string")).collect()
    assert {r.term: r.stem for r in rows} == expected | {None: None}


def test_stored_index(spark):
    texts = {1: "The quick brown Fox runs", 2: "quick foxes ran", 3: "running élan", 4: "of the and", 5: None}
    path = tempfile.mkdtemp(prefix="feedloom-test-") + "/index"
    index = TextIndex(spark, path)

    def found(query):
        return sorted(r.id for r in index.search(query).collect())

    assert index.segments() == [] and found("") == []
    docs = spark.createDataFrame(list(texts.items()), "id bigint, text string")
    assert index.append(0, docs) and not index.append(0, docs)
    assert (found("fox"), found("Run"), found("foxes quickly"), found("élan run"), found("none"), found("the")) == (
        [1, 2], [1, 3], [1, 2], [3], [], []
    )
    # A later segment replaces the words of a post and leaves the others.
    assert index.append(3, spark.createDataFrame([(1, "brown bears"), (9, "fox run")], docs.schema))
    assert (found("fox"), found("run"), found("bear"), found("brown")) == ([2, 9], [3, 9], [1], [1])
    plan = index.search("run bears")._jdf.queryExecution().executedPlan().toString()
    buckets = spark.createDataFrame([(t,) for t in index.words("run bears")], "term string")
    buckets = {r[0] for r in buckets.select(F.pmod(F.xxhash64("term"), F.lit(256))).collect()}
    (listed,) = set(re.findall(r"term_bucket#\d+L? (?:IN \(([^)]*)\)|= \d+)", plan))
    assert {int(b) for b in listed.split(",")} == buckets


def test_articles(spark):
    def article(blocks, title="T"):
        return {"article": {"article_results": {"result": {"title": title, "content_state": {"blocks": blocks}}}}}

    def block(kind, text):
        return {"type": kind, "text": text}

    numbered = "ordered-list-item"
    full = [
        block("header-one", "a"), block("header-two", "b"), block("header-three", "c"), {"text": "plain"},
        block("blockquote", "q"), block("unordered-list-item", "u"), block(numbered, "1st"),
        block("atomic", "skip"), block("unstyled", ""), block(numbered, "2nd"), block("unstyled", "p"),
        block(numbered, "again"), block("code-block", "x = 1"), block("unknown", "z"),
    ]
    nodes = {
        "full": article(full),
        "none": {"legacy": {}},
        "no blocks": article([]),
        "null title": article([block("unstyled", "x")], None),
        "broken block": article([block("unstyled", "x"), "text"]),
    }
    rows = [(k, json.dumps(v)) for k, v in nodes.items()]
    posts = spark.createDataFrame(rows, "k string, value string").select("k", F.parse_json("value").alias("v"))
    got = {r.k: (r.title, r.text) for r in articles_to_markdown(posts).collect()}
    assert got == {
        "full": ("T", "\n\n".join(
            ["# a", "## b", "### c", "plain", "> q", "- u", "1. 1st", "2. 2nd", "p", "1. again", "```\nx = 1\n```", "z"]
        )),
        "none": ("", ""),
        "no blocks": ("T", ""),
        "null title": ("", "x"),
        "broken block": ("T", ""),
    }
