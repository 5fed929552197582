"""Page payloads written from plain tables, for queries over given data.

Builders work per row or group the rows of one page or conversation, so pages can
be built from tables of any size.  Nodes are JSON text columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PAGE_SIZE = 40
WIRE_TIME = "EEE MMM dd HH:mm:ss '+0000' yyyy"

HOME = '{"data":{"home":{"home_timeline_urt":{"instructions":%s}}}}'
SEARCH = '{"data":{"search_by_raw_query":{"search_timeline":{"timeline":{"instructions":%s}}}}}'
USER = '{"data":{"user":{"result":{"timeline_v2":{"timeline":{"instructions":%s}}}}}}'
LIST = '{"data":{"list":{"tweets_timeline":{"timeline":{"instructions":%s}}}}}'


def template(pattern: str, *parts: Column) -> Column:
    """``pattern`` with each ``%s`` replaced by the next part; null is null."""
    pieces = pattern.split("%s")
    out = [F.lit(pieces[0])]
    for part, piece in zip(parts, pieces[1:], strict=True):
        out += [part.cast("string"), F.lit(piece)]
    return F.concat(*out)


def quoted(text: Column) -> Column:
    """JSON text literal of a text column."""
    record = F.to_json(F.struct(text.alias("t")))
    return F.substring(record, F.lit(len('{"t":') + 1), F.length(record) - len('{"t":}'))


def wire_time(moment: Column) -> Column:
    return F.date_format(moment, WIRE_TIME)


def user_node(user_id: Column, handle: Column) -> Column:
    return template(
        '{"user_results":{"result":{"rest_id":"%s","core":{"screen_name":%s,"name":%s}}}}',
        user_id,
        quoted(handle),
        quoted(handle),
    )


def post_node(
    post_id: Column,
    author_id: Column,
    handle: Column,
    text: Column,
    legacy: Column | None = None,
    outer: Column | None = None,
) -> Column:
    """A post record; ``legacy``/``outer`` are extra ``,"key":value`` members."""
    none = F.lit("")
    return template(
        '{"__typename":"Tweet","rest_id":"%s","core":%s,"legacy":{"full_text":%s%s}%s}',
        post_id,
        user_node(author_id, handle),
        quoted(text),
        none if legacy is None else F.coalesce(legacy, none),
        none if outer is None else F.coalesce(outer, none),
    )


def member(name: str, value: Column) -> Column:
    """``,"name":value`` or null."""
    return template(f',"{name}":%s', value)


def item_content(node: Column) -> Column:
    return template('{"itemContent":{"tweet_results":{"result":%s}}}', node)


def single_entry(node: Column) -> Column:
    return template(
        '{"content":{"entryType":"TimelineTimelineItem","itemContent":{"tweet_results":{"result":%s}}}}',
        node,
    )


def module_entry(nodes: Column) -> Column:
    items = F.transform(nodes, lambda n: template('{"item":%s}', item_content(n)))
    return template(
        '{"content":{"entryType":"TimelineTimelineModule","items":[%s]}}', F.array_join(items, ",")
    )


def cursor_entry(value: Column) -> Column:
    return template(
        '{"content":{"entryType":"TimelineTimelineCursor","cursorType":"Bottom","value":%s}}',
        quoted(value),
    )


def instructions(entries: Column) -> Column:
    return template('[{"entries":[%s]}]', F.array_join(entries, ","))


def page(entries: Column, shape: str = HOME) -> Column:
    return template(shape, instructions(entries))


def thread_pages(conversations: DataFrame) -> DataFrame:
    """One page per conversation: a single module.

    Each turn replies to the one before it.
    """
    turn_id = F.col("conv_id") * 1000 + F.col("turn") + 1
    reply = F.when(
        F.col("turn") > 0, member("in_reply_to_status_id_str", template('"%s"', turn_id - 1))
    )
    node = post_node(turn_id, F.col("conv_id") + 1, F.col("role"), F.col("text"), reply)
    grouped = (
        conversations.select("conv_id", F.struct("turn", node.alias("n")).alias("p"))
        .groupBy("conv_id")
        .agg(F.array_sort(F.collect_list("p")).alias("ps"))
    )
    module = module_entry(F.transform("ps", lambda p: p["n"]))
    return grouped.select(
        F.concat(F.lit("conv-"), F.col("conv_id")).alias("run_id"),
        F.lit("home").alias("operation"),
        F.lit(0).alias("page_no"),
        page(F.array(module)).alias("value"),
    )


PAGES_PER_RUN = 50


def event_pages(events: DataFrame, operation: str = "home") -> DataFrame:
    """Events as feeds of one operation: pages of ``PAGE_SIZE`` posts, ``PAGES_PER_RUN`` per run.

    The post id is the event's user, so ids repeat and user 0 has no id.  Some
    pages do not advance their cursor, some have none, some report an error.
    """
    slot = F.floor(F.col("event_id") / PAGE_SIZE)
    run = F.floor(slot / PAGES_PER_RUN)
    node = post_node(
        F.col("user_id"),
        F.col("user_id") + 5000,
        F.col("event_type"),
        F.concat(F.lit("event "), F.col("event_id")),
        member("created_at", template('"%s"', wire_time(F.col("ts")))),
    )
    grouped = (
        events.select(
            run.alias("run"),
            (slot % PAGES_PER_RUN).cast("int").alias("page_no"),
            F.struct("event_id", single_entry(node).alias("e")).alias("p"),
        )
        .groupBy("run", "page_no")
        .agg(F.array_sort(F.collect_list("p")).alias("ps"))
    )
    mark = F.col("page_no") * 7 + F.col("run") * 3
    request = F.concat(F.lit("c"), F.col("page_no"))
    following = (
        F.when(mark % 29 == 23, F.lit(""))
        .when(mark % 31 == 19, request)
        .otherwise(F.concat(F.lit("c"), F.col("page_no") + 1))
    )
    entries = F.concat(F.transform("ps", lambda p: p["e"]), F.array(cursor_entry(following)))
    error = F.lit('{"errors":[{"code":130,"message":"over capacity"}]}')
    return grouped.select(
        F.concat(F.lit("run-"), F.col("run")).alias("run_id"),
        F.lit(operation).alias("operation"),
        "page_no",
        F.when(F.col("page_no") > 0, request).alias("request_cursor"),
        F.when(mark % 37 == 29, error).otherwise(page(entries)).alias("value"),
    )


# Faults by row, one per drop reason and way to reach it.
FAULTS = 14


def faulty_pages(documents: DataFrame, fault: Column) -> DataFrame:
    """One page per document whose single entry has fault number ``fault``.

    0: none; 1: no result; 2: tombstone; 3: no legacy; 4: no core; 5: broken
    repost; 6: advertiser source; 7: promoted card; 8: text is a number; 9:
    result is text; 10: content is text; 11: empty result; 12: link is a
    number; 13: media url is null.
    """
    doc, handle, text = F.col("doc_id") + 1, F.col("source"), F.col("text")
    core = member("core", user_node(doc, handle))
    legacy = template('"legacy":{"full_text":%s}', quoted(text))

    def node(legacy_extra: str = "", outer: str = "") -> Column:
        return post_node(doc, doc, handle, text, F.lit(legacy_extra), F.lit(outer))

    nodes = {
        0: node(),
        2: template('{"__typename":"TweetTombstone","rest_id":"%s"}', doc),
        3: template('{"__typename":"Tweet","rest_id":"%s"%s}', doc, core),
        4: template('{"__typename":"Tweet","rest_id":"%s",%s}', doc, legacy),
        5: node(legacy_extra=',"retweeted_status_result":{"result":{"rest_id":"7"}}'),
        6: node(outer=',"source":"Posted for Advertisers"'),
        7: node(outer=',"card":{"legacy":{"name":"PROMOTED_website"}}'),
        8: template(
            '{"__typename":"Tweet","rest_id":"%s","legacy":{"full_text":12}%s}', doc, core
        ),
        9: quoted(text),
        11: F.lit("{}"),
        12: node(legacy_extra=',"entities":{"urls":[{"expanded_url":5}]}'),
        13: node(
            legacy_extra=',"extended_entities":{"media":[{"type":"photo","media_url_https":null}]}'
        ),
    }
    entry = F.when(
        fault == 1, F.lit('{"content":{"entryType":"TimelineTimelineItem","itemContent":{}}}')
    ).when(fault == 10, template('{"content":%s}', quoted(text)))
    for number, made in nodes.items():
        entry = entry.when(fault == number, single_entry(made))
    return documents.select(
        F.concat(F.lit("doc-"), F.col("doc_id")).alias("run_id"),
        F.lit("home").alias("operation"),
        F.lit(0).alias("page_no"),
        "source",
        page(F.array(entry)).alias("value"),
    )
