"""Column expressions over one post record, shared by context and parsing.

Every function takes a column already cast to ``POST`` (or a raw node where
said so) and works both in a projection and inside an array lambda.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from feedloom.functions.scalars import is_infinite, safe_int
from feedloom.functions.variants import (
    is_container,
    is_text,
    present,
    take,
    text_of,
    text_or_empty,
    truthy,
    truthy_record,
)

VISIBILITY_WRAPPER = "TweetWithVisibilityResults"
TOMBSTONES = ("TweetTombstone", "TweetUnavailable")

ITEM = (
    "struct<tweet_results:struct<result:variant>,tweetResult:struct<result:variant>>"
)
CONTENT = f"struct<itemContent:{ITEM},items:variant>"
NESTED_ITEMS = f"array<struct<item:struct<itemContent:{ITEM}>>>"
NAMES = "struct<screen_name:variant,name:variant>"

POST = (
    "struct<__typename:string,rest_id:string,source:string,"
    "card:struct<legacy:variant>,"
    "note_tweet:struct<note_tweet_results:struct<result:struct<text:variant>>>,"
    "core:struct<user_results:struct<result:"
    "struct<rest_id:string,core:variant,legacy:variant>>>,"
    "quoted_status_result:struct<result:variant>,"
    "legacy:struct<source:string,full_text:variant,created_at:string,"
    "in_reply_to_status_id_str:string,in_reply_to_screen_name:variant,"
    "retweeted_status_result:struct<result:variant>,user:variant,"
    "entities:struct<urls:variant>,extended_entities:struct<media:variant>>>"
)
# The part of a post that reply context needs.
CONTEXT_POST = (
    "struct<rest_id:string,"
    "note_tweet:struct<note_tweet_results:struct<result:struct<text:variant>>>,"
    "core:struct<user_results:struct<result:"
    "struct<rest_id:string,core:variant,legacy:variant>>>,"
    "legacy:struct<full_text:variant,in_reply_to_status_id_str:string,"
    "retweeted_status_result:struct<result:variant>,user:variant>>"
)


def _first_result(item: Column) -> Column:
    one = item["tweet_results"]["result"]
    two = item["tweetResult"]["result"]
    return F.when(truthy_record(one), one).when(truthy_record(two), two)


def find_result(content: Column) -> Column:
    """The post node of a candidate: its own, else the first nested one.

    ``content`` is the candidate cast to ``CONTENT``.
    """
    nested = take(content["items"], NESTED_ITEMS)
    from_nested = F.try_element_at(
        F.filter(
            F.transform(nested, lambda n: _first_result(n["item"]["itemContent"])),
            lambda r: r.isNotNull(),
        ),
        F.lit(1),
    )
    return F.coalesce(
        _first_result(content["itemContent"]),
        F.when(content["items"].isNotNull(), from_nested),
    )


def unwrap(node: Column) -> Column:
    """The post node inside a visibility wrapper (one level), else the node."""
    inner = take(node, "variant", "$.tweet")
    wrapped = (take(node, "string", "$.__typename") == VISIBILITY_WRAPPER) & truthy_record(inner)
    return F.when(wrapped, inner).otherwise(node)


def is_record(node: Column) -> Column:
    return take(node, "struct<__typename:string>").isNotNull()


def chosen_text(post: Column) -> Column:
    """Long-form note if there is one, else the short text; null if not text."""
    note = post["note_tweet"]["note_tweet_results"]["result"]["text"]
    return F.when(truthy(note), F.when(is_text(note), text_of(note))).otherwise(
        text_or_empty(post["legacy"]["full_text"])
    )


def _author_nodes(post: Column) -> Column:
    """Where a post may keep its author: a user record's two places, or the post."""
    user = post["core"]["user_results"]["result"]
    return F.struct(
        user.alias("user"),
        take(user["core"], NAMES).alias("new"),
        take(user["legacy"], NAMES).alias("old"),
        take(post["legacy"]["user"], "struct<id_str:string,screen_name:variant,name:variant>").alias("flat"),
    )


def _author_texts(nodes: Column) -> Column:
    """The same with every name read once."""

    def names(place: str) -> Column:
        return F.struct(*[text_or_empty(nodes[place][f]).alias(f) for f in ("screen_name", "name")])

    return F.struct(nodes.alias("nodes"), names("new").alias("new"), names("old").alias("old"))


def _author_of(texts: Column) -> Column:
    nodes, new, old = texts["nodes"], texts["new"], texts["old"]
    user, flat = nodes["user"], nodes["flat"]

    def pick(field: str) -> Column:
        return F.coalesce(F.when(new[field] == "", old[field]), F.when(new[field] != "", new[field]))

    def flat_pick(field: str) -> Column:
        return F.when(flat[field].isNull(), F.lit("")).when(
            is_text(flat[field]), text_of(flat[field])
        )

    needs_old = (new["screen_name"] == "") | (new["name"] == "")
    user_broken = (
        is_infinite(user["rest_id"])
        | (present(user["core"]) & nodes["new"].isNull())
        | (present(user["legacy"]) & nodes["old"].isNull() & needs_old)
    )

    def made(node_id: Column, handle: Column, name: Column, broken: Column) -> Column:
        return F.struct(
            node_id.alias("id"), handle.alias("handle"), name.alias("name"), broken.alias("broken")
        )

    return (
        F.when(
            user.isNotNull(),
            made(safe_int(user["rest_id"]), pick("screen_name"), pick("name"), user_broken),
        )
        .when(
            flat.isNotNull(),
            made(
                safe_int(flat["id_str"]),
                flat_pick("screen_name"),
                flat_pick("name"),
                is_infinite(flat["id_str"]),
            ),
        )
        .otherwise(made(F.lit(0).cast("bigint"), F.lit(""), F.lit(""), F.lit(False)))
    )


def author(post: Column) -> Column:
    """``struct<id, handle, name, broken>`` of a post's author.

    ``handle``/``name`` are null when they hold something other than text, and
    ``broken`` marks records that cannot be read at all.  Each ``transform`` names
    one step, so that no node is read twice.
    """
    nodes = F.array(_author_nodes(post))
    return F.get(F.transform(F.transform(nodes, _author_texts), _author_of), F.lit(0))


# ── media and links ──────────────────────────────────────────────────────

MEDIA_ITEM = (
    "struct<type:variant,media_url_https:variant,"
    "original_info:struct<width:variant,height:variant>,video_info:variant>"
)
VARIANTS = "array<struct<content_type:string,bitrate:variant,url:variant>>"
MP4 = "video/mp4"


def _size(node: Column) -> Column:
    return F.coalesce(take(node, "int"), text_of(node).try_cast("int"))


def _size_broken(node: Column) -> Column:
    number = F.coalesce(take(node, "double"), text_of(node).try_cast("double"))
    return text_of(node).isNotNull() & (
        is_container(node) | number.isNull() | (number != F.coalesce(_size(node), F.lit(0)))
    )


def _with_mp4(item: Column) -> Column:
    info = take(item["video_info"], "struct<variants:variant>")
    return F.struct(
        text_of(item["type"]).alias("type"),
        item["media_url_https"].alias("own"),
        item["original_info"].alias("size"),
        (present(item["video_info"]) & info.isNull()).alias("broken_info"),
        info["variants"].alias("variants"),
        take(info["variants"], VARIANTS).alias("listed"),
        F.filter(take(info["variants"], VARIANTS), lambda v: v["content_type"] == MP4).alias("mp4"),
    )


def _with_best(item: Column) -> Column:
    """Highest bitrate, missing = 0, the first one on ties."""
    ranked = F.transform(
        item["mp4"],
        lambda v, i: F.struct(
            (-F.coalesce(take(v["bitrate"], "double"), F.lit(0.0))).alias("low"), i.alias("at")
        ),
    )
    variants = text_of(item["variants"])
    odd_rate = F.exists(
        item["mp4"],
        lambda v: present(v["bitrate"])
        & (is_text(v["bitrate"]) | take(v["bitrate"], "double").isNull()),
    )
    broken = (
        item["broken_info"]
        | (
            present(item["variants"])
            & item["listed"].isNull()
            & ~F.coalesce(variants, F.lit("null")).isin("{}", "")
        )
        | F.exists(item["listed"], lambda v: v.isNull())
        | ((F.size(item["mp4"]) > 1) & odd_rate)
    )
    video = item["type"] != "photo"
    return F.struct(
        item["type"].alias("type"),
        F.when(video & (F.size(item["mp4"]) > 0), F.get(item["mp4"], F.array_min(ranked)["at"])["url"])
        .when(present(item["own"]), item["own"])
        .otherwise(F.parse_json(F.lit('""')))
        .alias("url"),
        item["size"].alias("size"),
        (video & F.coalesce(broken, F.lit(False))).alias("broken"),
    )


def _as_media(item: Column) -> Column:
    width, height = item["size"]["width"], item["size"]["height"]
    return F.struct(
        item["type"].alias("type"),
        F.when(is_text(item["url"]), text_of(item["url"])).alias("url"),
        _size(width).alias("width"),
        _size(height).alias("height"),
        (
            item["broken"] | ~is_text(item["url"]) | _size_broken(width) | _size_broken(height)
        ).alias("broken"),
    )


def read_media(node: Column) -> Column:
    """``struct<items, broken>`` of the attached media list.

    The chained ``transform`` calls name intermediate results, so that nothing
    is worked out twice.
    """
    listed = take(node, f"array<{MEDIA_ITEM}>")
    known = F.filter(
        listed,
        lambda m: is_text(m["type"]) & text_of(m["type"]).isin("photo", "video", "animated_gif"),
    )
    unreadable = (listed.isNull() & truthy(node)) | F.exists(
        listed, lambda m: m.isNull() | is_container(m["type"])
    )
    return F.struct(
        F.transform(F.transform(F.transform(known, _with_mp4), _with_best), _as_media).alias("items"),
        F.coalesce(unreadable, F.lit(False)).alias("broken"),
    )


def plain_media(items: Column) -> Column:
    return F.transform(
        items,
        lambda m: F.struct(*[m[f].alias(f) for f in ("type", "url", "width", "height")]),
    )


def read_links(node: Column) -> Column:
    """``struct<items array<string>, broken, odd>`` of expanded links.

    ``odd``: a link holds something other than text.
    """
    listed = take(node, "array<struct<expanded_url:variant>>")
    kept = F.filter(listed, lambda u: truthy(u["expanded_url"]))
    broken = (listed.isNull() & truthy(node)) | F.coalesce(
        F.exists(listed, lambda u: u.isNull()), F.lit(False)
    )
    odd = F.coalesce(F.exists(kept, lambda u: ~is_text(u["expanded_url"])), F.lit(False))
    return F.struct(
        F.transform(kept, lambda u: text_of(u["expanded_url"])).alias("items"),
        broken.alias("broken"),
        odd.alias("odd"),
    )
