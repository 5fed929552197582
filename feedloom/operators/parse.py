"""Candidate -> post columns, or exactly one drop reason."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.functions.posts import (
    CONTENT,
    POST,
    TOMBSTONES,
    author,
    chosen_text,
    find_result,
    is_record,
    plain_media,
    read_links,
    read_media,
    unwrap,
)
from feedloom.functions.reuse import reused
from feedloom.functions.scalars import blank_to_null, is_infinite, safe_int, wire_date
from feedloom.functions.text import normalize_text
from feedloom.functions.variants import is_text, take, text_of, text_or_empty

DROP_REASONS = (
    "dropped_no_result",
    "dropped_no_legacy",
    "dropped_schema_fail",
    "dropped_tombstone",
    "dropped_exception",
    "dropped_rt_unparseable",
    "dropped_promoted",
)


def timestamp_literal(moment: datetime | str | Column) -> Column:
    """A run time given as datetime (naive = UTC), text or column."""
    if isinstance(moment, Column):
        return moment
    return F.lit(moment if isinstance(moment, str) else moment.isoformat()).cast("timestamp")


@reused
def _result(content: str) -> Column:
    return find_result(F.col(content))


@reused
def _post(node: str) -> Column:
    return take(unwrap(F.col(node)), POST)


@reused
def _author(post: str) -> Column:
    return author(F.col(post))


@reused
def _media(post: str) -> Column:
    return read_media(F.col(f"{post}.legacy.extended_entities.media"))


@reused
def _links(post: str) -> Column:
    return read_links(F.col(f"{post}.legacy.entities.urls"))


@reused
def _text(post: str) -> Column:
    return chosen_text(F.col(post))


def _is(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False))


def _promoted_source(post: Column) -> Column:
    both = F.concat_ws(" ", post["source"], post["legacy"]["source"])
    return (both != "") & _is(F.lower(both).rlike("advertiser|promoted"))


@reused
def _column(name: str) -> Column:
    """Post columns that depend on nothing but the parsed record."""
    kept = F.col("drop_reason").isNull()
    reply_id = F.nullif(
        safe_int(F.col("_actual.legacy.in_reply_to_status_id_str")), F.lit(0)
    )
    if name == "id":
        return safe_int(F.col("_actual.rest_id"))
    if name == "text":
        return normalize_text(F.when(kept, F.col("_text")), fenced=True)
    if name == "reply_to_tweet_id":
        return reply_id
    if name == "reply_to_author_handle":
        own = blank_to_null(F.col("_reply_handle"))
        return F.coalesce(own, F.when(reply_id.isNotNull(), F.col("parent.handle")))
    if name == "reply_to_text":
        return F.when(reply_id.isNotNull(), F.col("parent.text"))
    if name == "quoted_tweet_id":
        return F.nullif(safe_int(F.col("_quote_id")), F.lit(0))
    if name == "quoted_text":
        return blank_to_null(normalize_text(F.when(kept, F.col("_quoted_text")), fenced=True))
    if name == "urls":
        return F.coalesce(F.col("_links.items"), F.array().cast("array<string>"))
    if name == "media_urls":
        none = F.array().cast("array<struct<type:string,url:string,width:int,height:int>>")
        return F.coalesce(plain_media(F.col("_media.items")), none)
    raise ValueError(name)


def parse_tweets(candidates: DataFrame, ingest_ts: datetime | str | Column) -> DataFrame:
    """Parse every candidate; dropped ones keep their keys and a ``drop_reason``.

    ``ingest_ts`` stands in for unreadable post dates, so a rerun with the same
    value gives the same rows.  Text leaves the JVM only for posts that are
    kept and only where Unicode composition or entities can change it.
    """
    keys = [c for c in candidates.columns if c not in ("content", "parent")]
    rows = candidates.withColumn("_content", take(F.col("content"), CONTENT))
    rows = rows.withColumn("_node", _result("_content"))
    rows = rows.withColumn("_post", _post("_node"))
    repost_node = "_post.legacy.retweeted_status_result.result"
    rows = rows.withColumns(
        {"_is_repost": is_record(F.col(repost_node)), "_repost": _post(repost_node)}
    )
    rows = rows.withColumn(
        "_actual", F.when(F.col("_is_repost"), F.col("_repost")).otherwise(F.col("_post"))
    )
    quote_node = "_actual.quoted_status_result.result"
    rows = rows.withColumns(
        {"_is_quote": is_record(F.col(quote_node)), "_quote_any": _post(quote_node)}
    )
    quote = F.col("_quote_any")
    usable = quote["legacy"].isNotNull() & quote["core"].isNotNull()
    actual = F.col("_actual")
    rows = rows.withColumns(
        {
            "_own": _author("_actual"),
            "_media": _media("_actual"),
            "_links": _links("_actual"),
            "_text": _text("_actual"),
            "_reply_handle": text_or_empty(actual["legacy"]["in_reply_to_screen_name"]),
            "_quote_id": F.when(usable, quote["rest_id"]),
            "_quoted": F.when(usable, _author("_quote_any")),
            "_quoted_text": F.when(usable, _text("_quote_any")),
        }
    )
    use_wrapper = F.col("_is_repost") & (F.col("_own.handle") == "")
    rows = rows.withColumn("_wrapper", F.when(use_wrapper, _author("_post")))
    rows = rows.withColumn("_author", F.coalesce("_wrapper", "_own"))
    rows = rows.withColumn("drop_reason", _drop_reason())
    kept = F.col("drop_reason").isNull()

    stamp = timestamp_literal(ingest_ts)
    operation = F.col("operation") if "operation" in keys else F.lit("")
    columns = {
        "id": _column("id"),
        "author_id": F.col("_author.id"),
        "author_handle": F.col("_author.handle"),
        "author_name": F.col("_author.name"),
        "created_at": wire_date(F.col("_actual.legacy.created_at"), stamp),
        "text": _column("text"),
        "reply_to_tweet_id": _column("reply_to_tweet_id"),
        "reply_to_author_handle": _column("reply_to_author_handle"),
        "reply_to_text": _column("reply_to_text"),
        "quoted_tweet_id": _column("quoted_tweet_id"),
        "quoted_author_handle": blank_to_null(F.col("_quoted.handle")),
        "quoted_text": _column("quoted_text"),
        "urls": _column("urls"),
        "media_urls": _column("media_urls"),
        "source_operation": F.coalesce(operation, F.lit("")),
        "scraped_at": stamp,
    }
    return rows.select(
        *keys,
        "drop_reason",
        *[F.when(kept, expr).alias(name) for name, expr in columns.items()],
    )


@reused
def _drop_reason() -> Column:
    """First matching reason, in the order in which the checks are made."""
    content, node, post = F.col("_content"), F.col("_node"), F.col("_post")
    repost, actual, quoted = F.col("_repost"), F.col("_actual"), F.col("_quoted")
    is_repost = F.col("_is_repost")

    # ``items`` of a plain candidate may be anything that can be iterated.
    items_text = text_of(content["items"])
    items_unusable = content["items"].isNotNull() & (
        items_text.isNull()
        | ~(is_text(content["items"]) | items_text.rlike(r"^[\[{]"))
    )
    card = take(post["card"]["legacy"], "struct<name:string>")
    card_broken = post["card"]["legacy"].isNotNull() & card.isNull()

    unreadable = (
        F.col("_own.broken")
        | _is(F.col("_wrapper.broken"))
        | is_infinite(actual["legacy"]["in_reply_to_status_id_str"])
        | (F.col("_is_quote") & F.col("_quote_any").isNull())
        | _is(quoted["broken"])
        | is_infinite(F.col("_quote_id"))
        | (quoted.isNotNull() & F.col("_quoted_text").isNull())
        | F.col("_media.broken")
        | F.exists(F.col("_media.items"), lambda m: m["broken"])
        | F.col("_links.broken")
    )
    invalid = (
        F.col("_text").isNull()
        | is_infinite(actual["rest_id"])
        | F.col("_author.handle").isNull()
        | F.col("_author.name").isNull()
        | F.col("_reply_handle").isNull()
        | (quoted.isNotNull() & quoted["handle"].isNull())
        | F.col("_links.odd")
    )
    return (
        F.when(content.isNull(), "dropped_exception")
        .when(node.isNull() & items_unusable, "dropped_exception")
        .when(node.isNull(), "dropped_no_result")
        .when(post.isNull(), "dropped_exception")
        .when(post["__typename"].isin(*TOMBSTONES), "dropped_tombstone")
        .when(post["legacy"].isNull(), "dropped_no_legacy")
        .when(_promoted_source(post), "dropped_promoted")
        .when(_is(card_broken), "dropped_exception")
        .when(_is(F.lower(card["name"]).contains("promoted")), "dropped_promoted")
        .when(post["core"].isNull(), "dropped_no_legacy")
        .when(is_repost & repost.isNull(), "dropped_exception")
        .when(
            is_repost & (repost["legacy"].isNull() | repost["core"].isNull()),
            "dropped_rt_unparseable",
        )
        .when(_is(unreadable), "dropped_exception")
        .when(_is(invalid), "dropped_schema_fail")
    )
