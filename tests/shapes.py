"""Hand-made payload nodes."""

from __future__ import annotations

import json

ITEM = "TimelineTimelineItem"
MODULE = "TimelineTimelineModule"
CURSOR = "TimelineTimelineCursor"
STAMP = "2026-06-01 00:00:00"


def post(post_id, handle="ann", text="hello", legacy=None, **outer):
    node = {
        "__typename": "Tweet",
        "rest_id": str(post_id),
        "legacy": {"created_at": "Fri May 08 10:20:30 +0000 2026", "full_text": text},
        "core": {
            "user_results": {
                "result": {"rest_id": "77", "legacy": {"screen_name": handle, "name": handle.title()}}
            }
        },
    }
    node["legacy"].update(legacy or {})
    node.update(outer)
    return node


def without(node, *keys):
    return {k: v for k, v in node.items() if k not in keys}


def single(result):
    return {"content": {"entryType": ITEM, "itemContent": {"tweet_results": {"result": result}}}}


def module(*results):
    items = [{"item": {"itemContent": {"tweet_results": {"result": r}}}} for r in results]
    return {"content": {"entryType": MODULE, "items": items}}


def cursor(value, kind="Bottom"):
    return {"content": {"entryType": CURSOR, "cursorType": kind, "value": value}}


def home(*entries):
    return {"data": {"home": {"home_timeline_urt": {"instructions": [{"entries": list(entries)}]}}}}


def pages_frame(spark, payloads, operation="home"):
    """One page per payload, ``run_id`` = its key."""
    rows = [
        (str(key), operation, 0, value if isinstance(value, str) else json.dumps(value))
        for key, value in payloads.items()
    ]
    return spark.createDataFrame(rows, "run_id string, operation string, page_no int, value string")
