"""Markdown report per run and feed."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.operators.feed import FEED, feed_changes


def _lines(*parts: Column | str) -> Column:
    return F.concat_ws("\n", *[F.lit(p) if isinstance(p, str) else p for p in parts])


def post_markdown(position: Column) -> Column:
    """Markdown of one post row; null parts of ``concat_ws`` vanish."""

    def context(label: str, handle: str, text: str, unnamed: str) -> Column:
        who = F.when(F.coalesce(handle, F.lit("")) != "", F.concat(F.lit("@"), F.col(handle)))
        line = F.concat(F.lit(label), F.coalesce(who, F.lit(unnamed)), F.lit(": "), F.col(text))
        return F.when(F.coalesce(text, F.lit("")) != "", F.concat(F.lit("\n"), line))

    media = F.filter(
        F.transform("media_urls", lambda m: m["url"]), lambda u: F.coalesce(u, F.lit("")) != ""
    )
    head = F.concat(
        F.lit("### ["),
        position.cast("string"),
        F.lit("] @"),
        F.col("author_handle"),
        F.lit(" ("),
        F.date_format("created_at", "yyyy-MM-dd HH:mm"),
        F.lit(" UTC)"),
    )
    return _lines(
        head,
        "",
        F.concat(F.lit("> "), F.col("text")),
        context("> Quoting ", "quoted_author_handle", "quoted_text", "quoted tweet"),
        context("> Replying to ", "reply_to_author_handle", "reply_to_text", "parent tweet"),
        "",
        F.when(F.size("urls") > 0, F.concat(F.lit("\nURLs: "), F.array_join("urls", ", "))),
        F.when(F.size("media_urls") > 0, F.concat(F.lit("\nMedia: "), F.array_join(media, ", "))),
        "",
    )


# Parts of a report, in order, and the report as a whole.
HEADER, NEW, UPDATED, WHOLE = range(4)


def _heading(title: str, count: str, *notes: str) -> Column:
    line = F.concat(F.lit(f"## {title} ("), F.col(count).cast("string"), F.lit(")"))
    return _lines("---", "", line, *notes, "")


def render_digest(feed: DataFrame, changes: DataFrame, ledger: DataFrame) -> DataFrame:
    """The report of every closed run of ``ledger``, a row per part of it.

    Rows ``(run_id, operation, name, section, feed_pos, markdown)``: the header,
    then per section its heading (``feed_pos`` 0) and its posts, which are new, or
    updated, in that feed.  ``feed`` carries ``feed_pos``.  In the order of
    ``section`` and ``feed_pos`` the rows are the report; no step gathers a feed.
    """
    ledger = ledger.withColumnRenamed("id", "run_id")
    name = F.concat(
        F.lit("scrape_"), F.col("operation"), F.lit("_"), F.date_format("completed_at", "yyyyMMdd_HHmmss")
    ).alias("name")

    def field(name: str, value: Column) -> Column:
        return F.concat(F.lit(f"| **{name}** | "), value.cast("string"), F.lit(" |"))

    errors = F.when(F.size("errors") > 0, field("Errors", F.to_json("errors")))
    stamp = F.concat(F.date_format("completed_at", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+00:00"))
    header = _lines(
        "# Scrape Report",
        "",
        "| Field | Value |",
        "|-------|-------|",
        field("Timestamp", stamp),
        field("Operation", F.col("operation")),
        field("Status", F.col("status")),
        field("Tweets fetched", F.col("tweets_fetched")),
        field("New", F.col("tweets_new")),
        field("Updated", F.col("tweets_updated")),
        errors,
        "",
    )
    fresh = _heading("New Tweets", "tweets_new")
    known = _heading("Updated Tweets", "tweets_updated", "_These tweets were already in the table._")
    parts = F.array(
        F.struct(F.lit(HEADER).alias("section"), header.alias("markdown")),
        F.struct(F.lit(NEW).alias("section"), F.when(F.col("tweets_new") > 0, fresh).alias("markdown")),
        F.struct(F.lit(UPDATED).alias("section"), F.when(F.col("tweets_updated") > 0, known).alias("markdown")),
    )
    heads = ledger.select(*FEED, name, F.explode(parts).alias("_part")).where("_part.markdown IS NOT NULL")
    heads = heads.select(*FEED, "name", "_part.section", F.lit(0).cast("long").alias("feed_pos"), "_part.markdown")
    posts = feed_changes(feed, changes).select(
        *FEED,
        F.when(F.col("change_type") == "new", NEW).otherwise(UPDATED).alias("section"),
        F.col("feed_pos").cast("long").alias("feed_pos"),
        post_markdown(F.col("feed_pos")).alias("markdown"),
    )
    posts = posts.join(ledger.select(*FEED, name), list(FEED))
    return heads.unionByName(posts)


def whole_reports(digest: DataFrame) -> DataFrame:
    """The rows of ``render_digest`` joined to one text per report, as section ``WHOLE``.

    For feeds with a count, which bounds a report; ``write_digest`` writes reports
    of any length.
    """
    parts = F.array_sort(F.collect_list(F.struct("section", "feed_pos", "markdown")))
    text = F.array_join(F.transform(parts, lambda p: p["markdown"]), "\n")
    return digest.groupBy(*FEED, "name").agg(text.alias("markdown")).select(
        *FEED,
        "name",
        F.lit(WHOLE).alias("section"),
        F.lit(0).cast("long").alias("feed_pos"),
        "markdown",
    )


# Reports and posts that one task writes.  A report is a folder of its own, which takes
# far longer to make than its text takes to write, so bytes alone do not tell the work.
TASK_REPORTS = 64
TASK_POSTS = 20_000


def digest_tasks(reports: int, posts: int) -> int:
    """Tasks for so many reports with so many posts in all."""
    return max(1, math.ceil(reports / TASK_REPORTS), math.ceil(posts / TASK_POSTS))


def write_digest(digest: DataFrame, path: str, tasks: int | None = None) -> None:
    """Reports as text under ``run_id=/operation=/name=``, in sorted parts.

    Rows are dealt by range, so a long report is written by several tasks; its
    part files, read by name, follow each other.  Without ``tasks`` their number
    is Spark's choice, which goes by bytes.
    """
    folder = (*FEED, "name")
    # Not null, so that the writer sees that rows are sorted by folder already.
    keys = [F.coalesce(F.col(c), F.lit("")).alias(c) for c in folder]
    order = (*folder, "section", "feed_pos")
    rows = digest.select(*keys, "section", "feed_pos", "markdown")
    dealt = order if tasks is None else (tasks, *order)
    rows = rows.repartitionByRange(*dealt).sortWithinPartitions(*order)
    rows.select(*folder, "markdown").write.mode("overwrite").option("lineSep", "\n").partitionBy(
        *folder
    ).text(path)
