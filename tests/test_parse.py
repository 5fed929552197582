from __future__ import annotations

import datetime as dt

import pytest
import shapes as s

from feedloom.operators.flatten import flatten_timeline, page_summary
from feedloom.operators.parse import parse_tweets
from feedloom.sources.payloads import ingest_payloads

PHOTO = {"type": "photo", "media_url_https": "p", "original_info": {"width": 4, "height": 3}}


def video(variants, **more):
    return {"type": "video", "media_url_https": "own", "video_info": {"variants": variants}, **more}


def mp4(url, bitrate=None):
    node = {"content_type": "video/mp4", "url": url}
    return node if bitrate is None else {**node, "bitrate": bitrate}


def media(*items):
    return {"extended_entities": {"media": list(items)}}


def visible(node):
    return {"__typename": "TweetWithVisibilityResults", "tweet": node}


def repost(node):
    return {"retweeted_status_result": {"result": node}}


def quote(node):
    return {"quoted_status_result": {"result": node}}


def card(node):
    return {"card": {"legacy": node}}


NO_USER = {"user_results": {}}

# one candidate each: payload entry -> drop reason (None = parsed)
OUTCOMES = {
    "plain": (s.single(s.post(1)), None),
    "camel result": (
        {"content": {"entryType": s.ITEM, "itemContent": {"tweetResult": {"result": s.post(1)}}}},
        None,
    ),
    "nested result": (
        {
            "content": {
                "entryType": s.ITEM,
                "items": [{"item": {}}, {"item": {"itemContent": {"tweet_results": {"result": s.post(1)}}}}],
            }
        },
        None,
    ),
    "empty content": ({"content": {"entryType": s.ITEM}}, "dropped_no_result"),
    "item content is text": (
        {"content": {"entryType": s.ITEM, "itemContent": "bad"}},
        "dropped_no_result",
    ),
    "empty result": (s.single({}), "dropped_no_result"),
    "false result": (s.single(False), "dropped_no_result"),
    "zero result": (s.single(0.0), "dropped_no_result"),
    "empty list result": (s.single([]), "dropped_no_result"),
    "text result": (s.single("x"), "dropped_exception"),
    "number result": (s.single(3), "dropped_exception"),
    "list result": (s.single([1]), "dropped_exception"),
    "odd record": (s.single({"odd": 1}), "dropped_no_legacy"),
    "items null": ({"content": {"entryType": s.ITEM, "items": None}}, "dropped_exception"),
    "items text": ({"content": {"entryType": s.ITEM, "items": "ab"}}, "dropped_no_result"),
    "items number": ({"content": {"entryType": s.ITEM, "items": 4}}, "dropped_exception"),
    "content is text": ({"content": "bad"}, "dropped_exception"),
    "content is null": ({"content": None}, "dropped_exception"),
    "entry is text": ("bad", "dropped_exception"),
    "entry is null": (None, "dropped_exception"),
    "module items null": ({"content": {"entryType": s.MODULE, "items": None}}, "dropped_exception"),
    "module element text": ({"content": {"entryType": s.MODULE, "items": ["x"]}}, "dropped_exception"),
    "module item null": (
        {"content": {"entryType": s.MODULE, "items": [{"item": None}]}},
        "dropped_exception",
    ),
    "module bare element": (
        {
            "content": {
                "entryType": s.MODULE,
                "items": [{"itemContent": {"tweet_results": {"result": s.post(1)}}}],
            }
        },
        None,
    ),
    "tombstone": (s.single({"__typename": "TweetTombstone"}), "dropped_tombstone"),
    "unavailable": (s.single(visible({"__typename": "TweetUnavailable"})), "dropped_tombstone"),
    "wrapped": (s.single(visible(s.post(1))), None),
    "wrapped text": (s.single(visible("x")), "dropped_exception"),
    "wrapped nothing": (s.single(visible({})), "dropped_no_legacy"),
    "no legacy": (s.single(s.without(s.post(1), "legacy")), "dropped_no_legacy"),
    "legacy text": (s.single(s.post(1) | {"legacy": "x"}), "dropped_no_legacy"),
    "legacy empty": (s.single(s.post(1) | {"legacy": {}}), None),
    "no core": (s.single(s.without(s.post(1), "core")), "dropped_no_legacy"),
    "core list": (s.single(s.post(1, core=[])), "dropped_no_legacy"),
    "advertiser": (s.single(s.post(1, source="<a>For ADVERTISERS</a>")), "dropped_promoted"),
    "promoted legacy": (s.single(s.post(1, legacy={"source": "Promoted"})), "dropped_promoted"),
    "promoted before core": (
        s.single(s.without(s.post(1, source="promoted"), "core")),
        "dropped_promoted",
    ),
    "promoted card": (s.single(s.post(1, **card({"name": "x_PROMOTED_y"}))), "dropped_promoted"),
    "plain card": (s.single(s.post(1, **card({"name": "summary"}))), None),
    "card legacy text": (s.single(s.post(1, **card("x"))), "dropped_exception"),
    "card legacy null": (s.single(s.post(1, **card(None))), "dropped_exception"),
    "card without legacy": (s.single(s.post(1, card={})), None),
    "card text": (s.single(s.post(1, card="x")), None),
    "promoted original": (s.single(s.post(1, legacy=repost(s.post(2, source="promoted")))), None),
    "repost": (s.single(s.post(1, legacy=repost(s.post(2)))), None),
    "repost wrapped": (s.single(s.post(1, legacy=repost(visible(s.post(2))))), None),
    "repost wrapped text": (s.single(s.post(1, legacy=repost(visible("x")))), "dropped_exception"),
    "repost not record": (s.single(s.post(1, legacy=repost("x"))), None),
    "repost empty": (s.single(s.post(1, legacy=repost({}))), "dropped_rt_unparseable"),
    "repost no core": (
        s.single(s.post(1, legacy=repost(s.without(s.post(2), "core")))),
        "dropped_rt_unparseable",
    ),
    "text number": (s.single(s.post(1, text=5)), "dropped_schema_fail"),
    "text null": (s.single(s.post(1, text=None)), None),
    "text zero": (s.single(s.post(1, text=0)), None),
    "note number": (
        s.single(s.post(1, note_tweet={"note_tweet_results": {"result": {"text": 7}}})),
        "dropped_schema_fail",
    ),
    "id infinite": (s.single(s.post("Infinity")), "dropped_schema_fail"),
    "id missing": (s.single(s.without(s.post(1), "rest_id")), None),
    "author id infinite": (
        s.single(s.post(1, core={"user_results": {"result": {"rest_id": "-inf"}}})),
        "dropped_exception",
    ),
    "user core text": (
        s.single(s.post(1, core={"user_results": {"result": {"core": "x"}}})),
        "dropped_exception",
    ),
    "user legacy null": (
        s.single(s.post(1, core={"user_results": {"result": {"core": {"name": "n"}, "legacy": None}}})),
        "dropped_exception",
    ),
    "user legacy unused": (
        s.single(
            s.post(
                1,
                core={
                    "user_results": {
                        "result": {"core": {"name": "n", "screen_name": "h"}, "legacy": None}
                    }
                },
            )
        ),
        None,
    ),
    "handle number": (
        s.single(s.post(1, core={"user_results": {"result": {"core": {"screen_name": 5}}}})),
        "dropped_schema_fail",
    ),
    "flat handle null": (
        s.single(s.post(1, core=NO_USER, legacy={"user": {"screen_name": None}})),
        "dropped_schema_fail",
    ),
    "reply infinite": (
        s.single(s.post(1, legacy={"in_reply_to_status_id_str": "inf"})),
        "dropped_exception",
    ),
    "reply handle number": (
        s.single(s.post(1, legacy={"in_reply_to_screen_name": 9})),
        "dropped_schema_fail",
    ),
    "quote text": (s.single(s.post(1, **quote("x"))), None),
    "quote wrapped text": (s.single(s.post(1, **quote(visible("x")))), "dropped_exception"),
    "quote odd text": (s.single(s.post(1, **quote(s.post(2, text=4)))), "dropped_exception"),
    "quote id infinite": (s.single(s.post(1, **quote(s.post("inf")))), "dropped_exception"),
    "quote handle number": (
        s.single(
            s.post(
                1, **quote(s.post(2, core={"user_results": {"result": {"core": {"screen_name": 5}}}}))
            )
        ),
        "dropped_schema_fail",
    ),
    "media text": (s.single(s.post(1, legacy={"extended_entities": {"media": "ab"}})), "dropped_exception"),
    "media empty text": (s.single(s.post(1, legacy={"extended_entities": {"media": ""}})), None),
    "media element text": (s.single(s.post(1, legacy=media("x"))), "dropped_exception"),
    "media type list": (s.single(s.post(1, legacy=media({"type": []}))), "dropped_exception"),
    "photo url null": (
        s.single(s.post(1, legacy=media({"type": "photo", "media_url_https": None}))),
        "dropped_exception",
    ),
    "photo width text": (
        s.single(s.post(1, legacy=media(PHOTO | {"original_info": {"width": "wide"}}))),
        "dropped_exception",
    ),
    "photo width fraction": (
        s.single(s.post(1, legacy=media(PHOTO | {"original_info": {"width": 1.5}}))),
        "dropped_exception",
    ),
    "video info null": (
        s.single(s.post(1, legacy=media({"type": "video", "video_info": None}))),
        "dropped_exception",
    ),
    "video variants null": (s.single(s.post(1, legacy=media(video(None)))), "dropped_exception"),
    "video variant text": (s.single(s.post(1, legacy=media(video(["x"])))), "dropped_exception"),
    "mp4 without url": (
        s.single(s.post(1, legacy=media(video([{"content_type": "video/mp4"}])))),
        "dropped_exception",
    ),
    "mp4 null rates": (
        s.single(
            s.post(
                1,
                legacy=media(
                    video([mp4("a") | {"bitrate": None}, mp4("b", 1)])
                ),
            )
        ),
        "dropped_exception",
    ),
    "mp4 one null rate": (s.single(s.post(1, legacy=media(video([mp4("a") | {"bitrate": None}])))), None),
    "links text": (s.single(s.post(1, legacy={"entities": {"urls": "ab"}})), "dropped_exception"),
    "link element text": (s.single(s.post(1, legacy={"entities": {"urls": ["x"]}})), "dropped_exception"),
    "link number": (
        s.single(s.post(1, legacy={"entities": {"urls": [{"expanded_url": 5}]}})),
        "dropped_schema_fail",
    ),
}
# A variant that is named MP4 must say where it is.


@pytest.fixture(scope="module")
def outcomes(spark):
    frame = s.pages_frame(spark, {k: s.home(e) for k, (e, _) in OUTCOMES.items()})
    parsed = parse_tweets(flatten_timeline(ingest_payloads(frame)), s.STAMP)
    rows = {}
    for row in parsed.collect():
        rows.setdefault(row.run_id, []).append(row)
    return rows


@pytest.mark.parametrize("case", OUTCOMES)
def test_outcome(outcomes, case):
    assert [row.drop_reason for row in outcomes.get(case, [])] == [OUTCOMES[case][1]]


def test_dropped_rows_have_no_columns(outcomes):
    dropped = [row for rows in outcomes.values() for row in rows if row.drop_reason]
    assert all(row.id is None and row.text is None and row.urls is None for row in dropped)


def test_repost_takes_the_original(outcomes):
    assert outcomes["repost"][0].id == 2
    assert outcomes["repost wrapped"][0].id == 2
    assert outcomes["repost not record"][0].id == 1


IGNORED = {
    "no entries": {"data": {"home": {"home_timeline_urt": {"instructions": [{}]}}}},
    "null entries": {"data": {"home": {"home_timeline_urt": {"instructions": [{"entries": None}]}}}},
    "no content": s.home({}),
    "unknown type": s.home({"content": {"entryType": "Other", "itemContent": {}}}),
    "module without items": s.home({"content": {"entryType": s.MODULE}}),
    "empty module": s.home({"content": {"entryType": s.MODULE, "items": []}}),
    "top cursor": s.home(s.cursor("t", "Top")),
    "empty page": {},
    "list page": [],
    "null page": "null",
    "text in first place": {
        "data": {
            "home": {"home_timeline_urt": {"instructions": "x"}},
            "list": {"tweets_timeline": {"timeline": {"instructions": [{"entries": [s.single(s.post(1))]}]}}},
        }
    },
}
COUNTED = {
    "text instruction": {"data": {"home": {"home_timeline_urt": {"instructions": ["x"]}}}},
    "text entries": {"data": {"home": {"home_timeline_urt": {"instructions": [{"entries": "ab"}]}}}},
}


def test_ignored_and_counted_pages(spark):
    frame = s.pages_frame(spark, IGNORED | COUNTED)
    payloads = ingest_payloads(frame)
    assert {r.status for r in payloads.select("status").collect()} == {"ok"}
    rows = parse_tweets(flatten_timeline(payloads), s.STAMP).collect()
    assert sorted((r.run_id, r.drop_reason) for r in rows) == [
        ("text entries", "dropped_exception"),
        ("text instruction", "dropped_exception"),
    ]
    assert all(r.next_cursor is None for r in page_summary(payloads).collect())


def test_columns_of_a_full_post(spark):
    legacy = {
        "full_text": "short",
        "in_reply_to_status_id_str": "1,234",
        "in_reply_to_screen_name": "bob",
        **media(
            PHOTO,
            video([mp4("low", 1), mp4("high", 9), mp4("also high", 9), {"content_type": "x", "bitrate": 99}]),
            {"type": "animated_gif", "media_url_https": "gif", "video_info": {}},
            {"type": "poll"},
        ),
        "entities": {"urls": [{"expanded_url": "u"}, {}, {"expanded_url": ""}, {"expanded_url": "u"}]},
    }
    node = s.post(
        4611686018427387905,
        legacy=legacy,
        note_tweet={"note_tweet_results": {"result": {"text": "Smart—quote… text https://t.co/abc123"}}},
        **quote(visible(s.post(30, "dan", "quoted &amp; text"))),
    )
    frame = s.pages_frame(spark, {"r": s.home(s.single(node), s.cursor("one"), s.cursor("two"))})
    payloads = ingest_payloads(frame)
    (row,) = parse_tweets(flatten_timeline(payloads), s.STAMP).collect()
    assert row.id == 4611686018427387905
    assert (row.author_id, row.author_handle, row.author_name) == (77, "ann", "Ann")
    assert row.created_at == dt.datetime(2026, 5, 8, 10, 20, 30)
    assert row.text == "Smart--quote... text"
    assert (row.reply_to_tweet_id, row.reply_to_author_handle, row.reply_to_text) == (1234, "bob", None)
    assert (row.quoted_tweet_id, row.quoted_author_handle, row.quoted_text) == (30, "dan", "quoted & text")
    assert row.urls == ["u", "u"]
    assert [tuple(m) for m in row.media_urls] == [
        ("photo", "p", 4, 3),
        ("video", "high", None, None),
        ("animated_gif", "gif", None, None),
    ]
    assert row.source_operation == "home"
    assert [r.next_cursor for r in page_summary(payloads).collect()] == ["two"]


def test_author_fallbacks(spark):
    flat = {"user": {"id_str": "9", "screen_name": "flat", "name": "Flat"}}
    nameless = {"user_results": {"result": {"rest_id": "5"}}}
    both = {"user_results": {"result": {"core": {"screen_name": "new"}, "legacy": {"screen_name": "old", "name": "Old"}}}}
    payloads = {
        "flat": s.home(s.single(s.post(1, core=NO_USER, legacy=flat))),
        "none": s.home(s.single(s.post(1, core=NO_USER))),
        "both": s.home(s.single(s.post(1, core=both))),
        "wrapper": s.home(s.single(s.post(1, "me", legacy=repost(s.post(2, core=nameless))))),
    }
    frame = s.pages_frame(spark, payloads)
    rows = parse_tweets(flatten_timeline(ingest_payloads(frame)), s.STAMP).collect()
    assert {r.run_id: (r.author_id, r.author_handle, r.author_name) for r in rows} == {
        "flat": (9, "flat", "Flat"),
        "none": (0, "", ""),
        "both": (0, "new", "Old"),
        "wrapper": (77, "me", "Me"),
    }


def reply(post_id, to, text="re", **legacy):
    return s.post(post_id, f"h{post_id}", text, {"in_reply_to_status_id_str": str(to), **legacy})


def test_reply_context(spark):
    payloads = {
        "thread": s.home(s.module(s.post(900, "par", "parent &lt;idea&gt;"), reply(901, 900), reply(902, 901))),
        "own handle": s.home(
            s.module(s.post(900, "par", "p"), reply(901, 900, in_reply_to_screen_name="given"))
        ),
        "last parent": s.home(s.module(s.post(900, "a", "one"), reply(901, 900), s.post(900, "b", "two"))),
        "blank parent": s.home(
            s.module(s.post(900, "a", "kept"), s.post(900, "b", "&#8203; https://t.co/x"), reply(901, 900))
        ),
        "promoted parent": s.home(s.module(s.post(900, "ad", "buy", source="promoted"), reply(901, 900))),
        "other module": s.home(s.module(s.post(900)), s.module(reply(901, 900), reply(902, 5))),
        "plain items": s.home(s.single(s.post(900)), s.single(reply(901, 900))),
        "reposted reply": s.home(s.module(s.post(900, "par", "p"), s.post(5, legacy=repost(reply(901, 900))))),
        "broken sibling": s.home(s.module(s.post(900, "par", "p"), reply(901, 900), "x", {"rest_id": "1"})),
    }
    frame = s.pages_frame(spark, payloads)
    rows = parse_tweets(flatten_timeline(ingest_payloads(frame)), s.STAMP).collect()
    got = {
        (r.run_id, r.id): (r.reply_to_author_handle, r.reply_to_text)
        for r in rows
        if r.reply_to_tweet_id
    }
    assert got == {
        ("thread", 901): ("par", "parent <idea>"),
        ("thread", 902): ("h901", "re"),
        ("own handle", 901): ("given", "p"),
        ("last parent", 901): ("b", "two"),
        ("blank parent", 901): ("a", "kept"),
        ("promoted parent", 901): ("ad", "buy"),
        ("other module", 901): (None, None),
        ("other module", 902): (None, None),
        ("plain items", 901): (None, None),
        ("reposted reply", 901): ("par", "p"),
        ("broken sibling", 901): ("par", "p"),
    }


def test_order_and_positions(spark):
    body = {
        "data": {
            "home": {
                "home_timeline_urt": {
                    "instructions": [
                        {"type": "clear"},
                        {"entries": [s.cursor("c"), s.module(s.post(1), s.post(2)), s.single(s.post(3))]},
                        {"entries": [s.single(s.post(4))]},
                    ]
                }
            }
        }
    }
    rows = flatten_timeline(ingest_payloads(s.pages_frame(spark, {"r": body}))).collect()
    got = [(r.instr_pos, r.entry_pos, r.item_pos) for r in rows]
    assert got == [(1, 1, 0), (1, 1, 1), (1, 2, 0), (2, 0, 0)]


def test_wire_dates(spark):
    dates = {
        "good": "Sat Mar 08 12:00:00 +0000 2026",
        "zone": "Sat Mar 08 12:00:00 -0330 2026",
        "no weekday": "Mar 08 12:00:00 +0000 2026",
        "bad weekday": "Xyz Mar 08 12:00:00 +0000 2026",
        "bad day": "Sat Feb 30 12:00:00 +0000 2026",
        "empty": "",
        "number": 7,
    }
    frame = s.pages_frame(
        spark, {k: s.home(s.single(s.post(1, legacy={"created_at": v}))) for k, v in dates.items()}
    )
    rows = parse_tweets(flatten_timeline(ingest_payloads(frame)), s.STAMP).collect()
    fallback = dt.datetime(2026, 6, 1)
    assert {r.run_id: r.created_at for r in rows} == {
        "good": dt.datetime(2026, 3, 8, 12),
        "zone": dt.datetime(2026, 3, 8, 15, 30),
        "no weekday": fallback,
        "bad weekday": fallback,
        "bad day": fallback,
        "empty": fallback,
        "number": fallback,
    }


def test_payload_status(spark):
    bodies = {
        "good": ({}, None, "ok", None),
        "cut": ('{"a":', None, "invalid_json", "invalid JSON"),
        "limit": ({"errors": [{"code": 88, "message": "m"}], "data": {}}, None, "rate_limited", "m"),
        "text code": ({"errors": [{"code": "88", "message": "m"}]}, None, "api_error", "m"),
        "no message": ({"errors": [{}]}, 200, "api_error", "Unknown error"),
        "odd errors": ({"errors": {"a": 1}}, None, "api_error", "Unknown error"),
        "empty errors": ({"errors": []}, None, "ok", None),
        "http limit": ({}, 429, "rate_limited", "HTTP status 429"),
        "http error": ('{"a":', 500, "api_error", "HTTP status 500"),
        "repeated key": ('{"errors": [{}], "errors": []}', None, "ok", None),
    }
    frame = s.pages_frame(spark, {k: v[0] for k, v in bodies.items()})
    codes = spark.createDataFrame(
        [(k, v[1]) for k, v in bodies.items()], "run_id string, http_status int"
    )
    rows = ingest_payloads(frame.join(codes, "run_id")).collect()
    assert {r.run_id: (r.status, r.error_message) for r in rows} == {
        k: v[2:] for k, v in bodies.items()
    }


def test_replies_in_a_large_module(spark):
    count = 20_000
    posts = [
        s.post(i + 1, f"h{i}", f"t{i}", legacy={"in_reply_to_status_id_str": str((i * 7919) % count + 1)})
        for i in range(count)
    ]
    frame = s.pages_frame(spark, {"r": s.home(s.module(*posts))})
    rows = parse_tweets(flatten_timeline(ingest_payloads(frame)), s.STAMP)
    rows = rows.select("id", "reply_to_author_handle", "reply_to_text").collect()
    assert len(rows) == count
    for row in rows:
        at = (row.id - 1) * 7919 % count
        assert (row.reply_to_author_handle, row.reply_to_text) == (f"h{at}", f"t{at}")
