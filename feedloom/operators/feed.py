"""Feeds: page-chain cut-off, first-seen dedup and the cap."""

from __future__ import annotations

import math
from itertools import chain

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Hard cap of a feed, posts assumed per page, spare pages.
MAX_COUNT = 500
POSTS_PER_PAGE = 20
SPARE_PAGES = 2

FEED = ("run_id", "operation")
PAGE = (*FEED, "page_no")
ARRIVAL = ("page_no", "instr_pos", "entry_pos", "item_pos")

# Names under which feeds may be asked for.
OPERATION_ALIASES = {
    "scheduled": ("home", "following"),
    "both": ("home", "following"),
    "all": ("home", "following"),
    "home": ("home",),
    "for-you": ("home",),
    "foryou": ("home",),
    "following": ("following",),
}


def resolve_operations(requests: DataFrame, column: str = "operation") -> DataFrame:
    """Expand requested names to feeds: one row per feed, with ``feed_seq``.

    Unknown names stand for themselves.
    """
    name = F.lower(F.trim(F.col(column)))
    table = F.create_map(
        *chain.from_iterable(
            (F.lit(alias), F.array(*map(F.lit, feeds))) for alias, feeds in OPERATION_ALIASES.items()
        )
    )
    feeds = F.coalesce(F.try_element_at(table, name), F.array(name))
    others = [c for c in requests.columns if c != column]
    return requests.select(*others, F.posexplode(feeds).alias("feed_seq", column))


def known_operation(name: Column) -> Column:
    """Whether a (resolved) name is a feed; null is none."""
    feeds = sorted({feed for feeds in OPERATION_ALIASES.values() for feed in feeds})
    return F.coalesce(name.isin(feeds), F.lit(False))


def canonical_operation(name: Column) -> Column:
    """The feed a captured page belongs to: a name that stands for one feed only.

    Names of several feeds and unknown ones stay, lower-cased and trimmed.
    """
    name = F.lower(F.trim(name))
    single = {alias: feeds[0] for alias, feeds in OPERATION_ALIASES.items() if len(feeds) == 1}
    table = F.create_map(*[F.lit(x) for item in single.items() for x in item])
    return F.coalesce(F.try_element_at(table, name), name)


def effective_count(count: int, hard_cap: int = MAX_COUNT) -> int:
    return max(0, min(count, hard_cap))


def max_pages(count: int) -> int:
    return math.ceil(effective_count(count) / POSTS_PER_PAGE) + SPARE_PAGES


def chain_pages(
    pages: DataFrame, count: int | None = None, parsed: DataFrame | None = None
) -> DataFrame:
    """Pages each feed keeps.

    A feed ends after a page without a next cursor, or whose next cursor is the
    one that requested it.  Without ``count`` nothing else ends it: the first
    such page is found by partial minima.  With ``count`` a feed has at most
    ``max_pages(count)`` pages, and with ``parsed`` it also ends at the page
    that brings its first-seen posts to ``count``.  The page bound is applied
    first: Spark limits each feed before the shuffle, so the windows see at most
    that many rows per feed and input task.
    """
    cursor = F.col("next_cursor")
    stops = F.coalesce(cursor, F.lit("")).eqNullSafe("") | cursor.eqNullSafe(F.col("request_cursor"))
    if count is None:
        last = pages.where(stops).groupBy(*FEED).agg(F.min("page_no").alias("_last"))
        kept = pages.join(last, list(FEED), "left")
        return kept.where("_last IS NULL OR page_no <= _last").select(*pages.columns)
    ordered = Window.partitionBy(*FEED).orderBy("page_no")
    first = pages.withColumn("_no", F.row_number().over(ordered)).where(
        F.col("_no") <= max_pages(count)
    )
    if parsed is not None:
        # What comes after the last of these pages is first seen on none of them.
        ends = first.groupBy(*FEED).agg(F.max("page_no").alias("_end"))
        within = F.coalesce(F.col("page_no") <= F.col("_end"), F.lit(True))
        early = parsed.join(ends, list(FEED)).where(within).drop("_end")
        fresh = first_seen(early).groupBy(*PAGE).agg(F.count("*").alias("_fresh"))
        first = first.join(fresh, list(PAGE), "left")
        so_far = F.sum(F.coalesce("_fresh", F.lit(0))).over(
            ordered.rowsBetween(Window.unboundedPreceding, 0)
        )
        first = first.withColumn("_full", so_far >= effective_count(count))
        stops = stops | F.col("_full")
    before = ordered.rowsBetween(Window.unboundedPreceding, -1)
    ended = first.withColumn("_ended", F.coalesce(F.max(stops).over(before), F.lit(False)))
    return ended.where("NOT _ended").select(*pages.columns)


def first_seen(parsed: DataFrame) -> DataFrame:
    """Kept posts, each id once per feed: its first arrival.  Id 0 is no id.

    ``row_number() = 1`` is limited per input task before the shuffle, so even
    an id holding a large share of all rows moves one row per task.
    """
    arrival = Window.partitionBy(*FEED, "id").orderBy(*ARRIVAL)
    posts = parsed.where(F.col("drop_reason").isNull() & (F.col("id") != 0))
    return posts.withColumn("_seen", F.row_number().over(arrival)).where("_seen = 1").drop("_seen")


# Pages of a feed that are numbered together.
PAGE_BLOCK = 1024


def _posts_before(sizes: DataFrame) -> DataFrame:
    """``_before``: how many posts the pages before each page of a feed hold.

    Running sums over blocks of pages, then over the pages of a block, so that
    no window sees more than a block's pages or a feed's blocks.
    """
    block = F.floor(F.col("page_no") / PAGE_BLOCK)
    sizes = sizes.withColumn("_block", block)
    earlier = (Window.unboundedPreceding, -1)
    by_block = Window.partitionBy(*FEED).orderBy("_block").rowsBetween(*earlier)
    by_page = Window.partitionBy(*FEED, "_block").orderBy("page_no").rowsBetween(*earlier)
    blocks = sizes.groupBy(*FEED, "_block").agg(F.sum("_size").alias("_size"))
    blocks = blocks.select(*FEED, "_block", F.coalesce(F.sum("_size").over(by_block), F.lit(0)).alias("_blocks"))
    pages = sizes.withColumn("_pages", F.coalesce(F.sum("_size").over(by_page), F.lit(0)))
    return pages.join(blocks, [*FEED, "_block"]).select(*PAGE, (F.col("_blocks") + F.col("_pages")).alias("_before"))


def cap_feed(posts: DataFrame, count: int | None = None, hard_cap: int = MAX_COUNT) -> DataFrame:
    """Posts of every feed in arrival order, numbered as ``feed_pos``.

    With ``count`` only the first ``min(count, hard_cap)`` stay: a rank with a
    bound.  Without it posts are numbered inside their page, after the posts of
    all pages before it, so a feed of any length is spread over its pages.
    """
    if count is not None:
        arrival = Window.partitionBy(*FEED).orderBy(*ARRIVAL)
        posts = posts.withColumn("feed_pos", F.row_number().over(arrival).cast("long"))
        return posts.where(F.col("feed_pos") <= effective_count(count, hard_cap))
    in_page = Window.partitionBy(*PAGE).orderBy(*[c for c in ARRIVAL if c not in PAGE])
    before = _posts_before(posts.groupBy(*PAGE).agg(F.count("*").alias("_size")))
    numbered = posts.withColumn("_no", F.row_number().over(in_page)).join(before, list(PAGE))
    return numbered.withColumn("feed_pos", F.col("_before") + F.col("_no")).drop("_before", "_no")


def seen_on_chain(parsed: DataFrame, pages: DataFrame, count: int | None = None) -> DataFrame:
    """First-seen posts of the kept pages of each feed.

    Kept pages are a prefix of the chain, so cutting first and then removing
    repeats gives the same feed as doing both page by page.
    """
    kept = chain_pages(pages, count, parsed).select(*PAGE)
    return first_seen(parsed.join(kept, list(PAGE), "left_semi")).drop("drop_reason")


def assemble_feed(parsed: DataFrame, pages: DataFrame, count: int | None = None) -> DataFrame:
    """Posts of each feed: kept pages only, first seen, capped by ``count``, in order."""
    return cap_feed(seen_on_chain(parsed, pages, count), count)


def merge_order(feed: DataFrame) -> DataFrame:
    """Adds ``feed_order``, the order in which feeds reach the table.

    Runs go by their earliest capture time, then by id; in a run home goes
    before following.  Merge, ledger and digest all use this order.
    """
    if "feed_order" in feed.columns:
        return feed
    places = {name: i for i, name in enumerate(OPERATION_ALIASES["all"])}
    seq = F.lit(len(places))
    for name, i in places.items():
        seq = F.when(F.col("operation") == name, i).otherwise(seq)
    started = F.lit(None).cast("timestamp")
    if "captured_at" in feed.columns:
        runs = feed.groupBy("run_id").agg(F.min("captured_at").alias("_started"))
        feed, started = feed.join(runs, "run_id"), F.col("_started")
    order = F.struct(started.alias("started"), "run_id", seq.alias("feed_seq"), "operation")
    return feed.withColumn("feed_order", order).drop("_started")


def feed_changes(feed: DataFrame, changes: DataFrame) -> DataFrame:
    """Posts of each feed with their ``change_type`` there.

    An id new to the table is new in the first feed that has it and updated in
    later ones.  ``changes`` may name that feed (``first_run``,
    ``first_operation``); otherwise it is the first in ``merge_order``.
    """
    new = changes.where("change_type = 'new'")
    if "first_run" in changes.columns:
        rows = feed.join(new.select("id", "first_run", "first_operation"), "id", "left")
        there = (F.col("run_id") == F.col("first_run")) & (
            F.col("operation") == F.col("first_operation")
        )
        change = F.when(there, "new").otherwise("updated")
        return rows.withColumn("change_type", change).drop("first_run", "first_operation")
    rows = merge_order(feed)
    first = rows.groupBy("id").agg(F.min("feed_order").alias("_first"))
    rows = rows.join(new.select("id").join(first, "id"), "id", "left")
    change = F.when(F.col("feed_order") == F.col("_first"), "new").otherwise("updated")
    return rows.withColumn("change_type", change).drop("_first")
