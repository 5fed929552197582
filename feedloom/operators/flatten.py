"""Page payload -> one row per candidate entry, in page order."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.functions.posts import (
    CONTENT,
    CONTEXT_POST,
    author,
    chosen_text,
    find_result,
    unwrap,
)
from feedloom.functions.reuse import reused
from feedloom.functions.scalars import safe_int
from feedloom.functions.text import normalize_texts
from feedloom.functions.variants import present, take, text_of, truthy
from feedloom.sources.payloads import RAW_COLUMNS, STATUS_COLUMNS

# Where a page keeps its instructions, tried in this order.
INSTRUCTION_PATHS = (
    "$.data.home.home_timeline_urt.instructions",
    "$.data.search_by_raw_query.search_timeline.timeline.instructions",
    "$.data.user.result.timeline_v2.timeline.instructions",
    "$.data.list.tweets_timeline.timeline.instructions",
)
SINGLE = "TimelineTimelineItem"
MODULE = "TimelineTimelineModule"
CURSOR = "TimelineTimelineCursor"

POSITION = ("instr_pos", "entry_pos", "item_pos")
ENTRY = "struct<entryType:string,cursorType:string,value:string,items:variant>"
ENTRIES = "array<struct<content:variant>>"
CURSOR_ENTRIES = "array<struct<content:struct<entryType:string,cursorType:string,value:string>>>"
PARENT = "struct<handle:string,text:string>"


def instructions_of(payload: Column, entries: str = "variant") -> Column:
    """Instructions of a page; a non-list in the first used place gives none.

    ``entries`` is the shape in which their entries are read.
    """
    listed = F.array(
        *[take(payload, f"array<struct<entries:{entries}>>", path) for path in INSTRUCTION_PATHS]
    )
    paths = F.array(*[F.lit(path) for path in INSTRUCTION_PATHS])
    judged = F.transform(
        listed,
        lambda found, i: F.struct(
            found.alias("found"),
            (found.isNull() & truthy(F.try_variant_get(payload, F.get(paths, i), "variant"))).alias("odd"),
        ),
    )
    used = F.filter(judged, lambda j: (F.size(j["found"]) > 0) | j["odd"])
    return F.try_element_at(used, F.lit(1))["found"]


def _entries_of(instruction: Column) -> Column:
    """Entries of one instruction; something unreadable becomes one null entry."""
    unreadable = F.array(F.lit(None).cast("struct<content:variant>"))
    node = instruction["entries"]
    return F.coalesce(
        take(node, "array<struct<content:variant>>"),
        F.when(instruction.isNull() | truthy(node), unreadable),
    )


def next_cursor_of(payload: Column) -> Column:
    """Value of the last bottom cursor on the page.

    Entries are read as plain fields: no content is copied, and what cannot be
    read holds no cursor.
    """
    none = F.array().cast(CURSOR_ENTRIES)
    contents = F.flatten(
        F.transform(
            instructions_of(payload, CURSOR_ENTRIES),
            lambda i: F.transform(F.coalesce(i["entries"], none), lambda e: e["content"]),
        )
    )
    bottoms = F.filter(
        contents, lambda c: (c["entryType"] == CURSOR) & (c["cursorType"] == "Bottom")
    )
    return F.try_element_at(bottoms, F.lit(-1))["value"]


def page_summary(payloads: DataFrame, text: bool = False) -> DataFrame:
    """Payload columns without the payload, plus ``next_cursor``; narrow.

    With ``text`` the payload's text stays, for pages that are stored.
    """
    keep = [c for c in payloads.columns if c != "v" and (text or c != "value")]
    cursor = F.when(F.col("status") == "ok", _cursor("v"))
    return payloads.select(*keep, cursor.alias("next_cursor"))


def _module_contents(entry: Column) -> Column:
    """Candidate contents of a module; something unreadable becomes one null."""
    unreadable = F.array(F.lit(None).cast("variant"))
    items = take(entry["items"], "array<variant>")

    def content(element: Column) -> Column:
        inner = take(element, "variant", "$.item")
        return F.when(present(inner), inner).otherwise(element)

    odd = present(entry["items"]) & ~F.coalesce(text_of(entry["items"]), F.lit("null")).isin("{}", "")
    return F.coalesce(F.transform(items, content), F.when(odd, unreadable))


def _with_author(post: Column) -> Column:
    repost = post["legacy"]["retweeted_status_result"]["result"]
    return F.struct(
        post.alias("post"),
        author(post).alias("author"),
        take(unwrap(repost), CONTEXT_POST).alias("repost"),
    )


def _context_facts(item: Column) -> Column:
    """What one module item offers as a parent and asks for as a reply."""
    post, who = item["post"], item["author"]
    usable = post["legacy"].isNotNull() & post["core"].isNotNull() & ~who["broken"]
    reply_to = F.coalesce(item["repost"]["legacy"], post["legacy"])
    return F.struct(
        F.when(usable, F.nullif(safe_int(post["rest_id"]), F.lit(0))).alias("id"),
        F.nullif(who["handle"], F.lit("")).alias("handle"),
        F.nullif(chosen_text(post), F.lit("")).alias("text"),
        F.nullif(safe_int(reply_to["in_reply_to_status_id_str"]), F.lit(0)).alias("reply_to"),
    )


def _module_facts(contents: Column) -> Column:
    """``_context_facts`` per item; each ``transform`` names one step."""
    nodes = F.transform(F.transform(contents, lambda c: take(c, CONTENT)), find_result)
    posts = F.transform(nodes, lambda n: take(unwrap(n), CONTEXT_POST))
    return F.transform(F.transform(posts, _with_author), _context_facts)


@reused
def _instructions(payload: str) -> Column:
    """Entries of every instruction; only odd pages take the second reading, which copies more."""
    strict = instructions_of(F.col(payload), ENTRIES)
    return _once(
        strict,
        lambda found: F.when(
            F.exists(found, lambda i: i["entries"].isNull()),
            F.transform(instructions_of(F.col(payload)), _entries_of),
        ).otherwise(F.transform(found, lambda i: i["entries"])),
    )


@reused
def _cursor(payload: str) -> Column:
    return next_cursor_of(F.col(payload))


@reused
def _contents(entry: str, read: str) -> Column:
    """Candidate contents of an entry; null for entries that hold none."""
    content = F.col(f"{entry}.content")
    unreadable = F.col(entry).isNull() | (present(content) & F.col(read).isNull())
    kind = F.col(f"{read}.entryType")
    return (
        F.when(unreadable, F.array(F.lit(None).cast("variant")))
        .when(kind == SINGLE, F.array(content))
        .when(kind == MODULE, _module_contents(F.col(read)))
    )


@reused
def _facts(contents: str) -> Column:
    return _module_facts(F.col(contents))


@reused
def _offered(facts: str) -> Column:
    """Parents a module offers: those with an id, a handle and a text."""
    texts = normalize_texts(
        F.transform(facts, lambda f: F.when(f["id"].isNotNull(), f["text"]))
    )
    return F.filter(
        F.zip_with(
            facts,
            texts,
            lambda f, t: F.struct(f["id"].alias("id"), f["handle"].alias("handle"), t.alias("text")),
        ),
        lambda p: p["id"].isNotNull() & p["handle"].isNotNull() & (p["text"] != ""),
    )


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` as a lambda variable.

    A column named inside a lambda may be inlined there and computed for every
    element; a variable is computed once.
    """
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _place(post_id: Column, buckets: Column) -> Column:
    return F.pmod(F.xxhash64(post_id), buckets).cast("int")


def _bucketed(offered: Column) -> Column:
    """Parents by hash of their id, in about the square root of their number of buckets."""
    wanted = F.greatest(F.lit(1), F.ceil(F.sqrt(F.size(offered))).cast("int"))

    def spread(n: Column) -> Column:
        placed = F.transform(offered, lambda p: p.withField("place", _place(p["id"], n)))
        return _once(
            placed,
            lambda all_of: F.transform(
                F.sequence(F.lit(0), n - 1), lambda k: F.filter(all_of, lambda p: p["place"] == k)
            ),
        )

    return _once(wanted, spread)


@reused
def _parents(facts: str, offered: str) -> Column:
    """Per item the offered post it replies to; a reply searches one bucket."""

    def parent(buckets: Column, reply_to: Column) -> Column:
        bucket = F.get(buckets, _place(reply_to, F.size(buckets)))
        return F.try_element_at(F.filter(bucket, lambda p: p["id"] == reply_to), F.lit(-1))

    def search(buckets: Column) -> Column:
        return F.transform(
            facts, lambda f: F.when(f["reply_to"].isNotNull(), parent(buckets, f["reply_to"]))
        )

    return F.when(F.col(offered).isNotNull(), _once(_once(F.col(offered), _bucketed), search))


def flatten_timeline(payloads: DataFrame) -> DataFrame:
    """One row per candidate of every ``ok`` page.

    Adds ``instr_pos, entry_pos, item_pos`` (page order), ``content`` (the
    candidate; null when it could not be read) and ``parent`` (handle and text
    of the post it replies to, when that post sits in the same module).

    Empty pages and entries leave through filters on the exploded positions:
    filtering (or inner-exploding) before would make Catalyst repeat the parsing
    expressions inside the filter.  No shuffle: a page is taken apart in the
    task that holds it.  Parents are looked up inside the module before it is
    exploded, so a module's context is never copied to its rows.
    """
    keys = [c for c in payloads.columns if c not in RAW_COLUMNS + STATUS_COLUMNS]
    readable = F.when(F.col("status") == "ok", F.col("v"))
    instructions = payloads.select(*keys, readable.alias("_v")).select(
        *keys, F.posexplode_outer(_instructions("_v")).alias("instr_pos", "_entries")
    )
    entries = (
        instructions.where(F.col("instr_pos").isNotNull())
        .select(
            *keys,
            "instr_pos",
            F.posexplode_outer("_entries").alias("entry_pos", "_entry"),
        )
        .where(F.col("entry_pos").isNotNull())
    )
    read = take(F.col("_entry.content"), ENTRY)
    entries = entries.withColumn("_read", read).select(
        *keys,
        "instr_pos",
        "entry_pos",
        _contents("_entry", "_read").alias("_contents"),
        (F.col("_read.entryType") == MODULE).alias("_module"),
    )
    # A thread: some item replies to another item of the module.
    facts = F.when(
        F.col("_module") & (F.size("_contents") > 1),
        _facts("_contents"),
    )
    entries = entries.withColumn("_facts", facts)
    thread = F.arrays_overlap(
        F.transform("_facts", lambda f: f["id"]), F.transform("_facts", lambda f: f["reply_to"])
    )
    entries = entries.withColumn("_facts", F.when(thread, F.col("_facts")))
    entries = entries.withColumn("_offered", _offered("_facts"))
    none = F.array().cast("array<struct<id:bigint,handle:string,text:string,place:int>>")
    found = F.coalesce(_parents("_facts", "_offered"), none)
    entries = entries.withColumn("_found", found).withColumn(
        "_items",
        F.zip_with(
            "_contents", "_found", lambda c, f: F.struct(c.alias("content"), f.alias("found"))
        ),
    )
    item = F.col("_item")
    items = entries.select(
        *keys, "instr_pos", "entry_pos", F.posexplode_outer("_items").alias("item_pos", "_item")
    )
    return items.where(F.col("item_pos").isNotNull()).select(
        *keys,
        *POSITION,
        item["content"].alias("content"),
        F.when(
            item["found"].isNotNull(),
            F.struct(item["found"]["handle"].alias("handle"), item["found"]["text"].alias("text")),
        ).alias("parent"),
    )
