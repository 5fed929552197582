"""Temporal URL lists: an as-of join of captures with dated list entries.

Entries (list, pattern, day, seq, listed) switch a pattern on or off from a
day.  They become validity intervals; intervals are cut at month ends, so a
capture is joined by (pattern, month) with at most the changes of one month,
however long a pattern's history is.  DataFrame functions only.

A pattern is a host (``a.b.example.com``), any parent domain of it, or a host
with leading path segments (``a.b.example.com/en``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from feedloom.llm.common import need_columns

OPEN_END = "9999-12-31"
PARTS = r"(?i)^https?://(?:[^/?#@]*@)?([^/?#:]+)(?::[0-9]*)?([^?#]*)"


def validity_intervals(entries: DataFrame) -> DataFrame:
    """list, pattern, valid_from, valid_to (exclusive) of every time a pattern was listed.

    Of several entries on a day the last (by seq) counts.  Entries that repeat
    a state change nothing; entries with a null list, pattern, day or state are
    void.
    """
    need_columns(entries, "list", "pattern", "day", "seq", "listed")
    daily = (
        entries.where("list IS NOT NULL AND pattern IS NOT NULL AND day IS NOT NULL AND listed IS NOT NULL")
        .groupBy("list", "pattern", "day")
        .agg(F.max(F.struct(F.coalesce("seq", F.lit(-1)).alias("seq"), "listed"))["listed"].alias("listed"))
    )
    # A month is the unit that keeps a hot pattern's history in bounded windows.
    order = W.partitionBy("list", "pattern").orderBy("day")
    steps = daily.withColumn("next", F.lead("day").over(order))
    end = F.coalesce("next", F.lit(OPEN_END).cast("date"))
    return steps.where("listed").select("list", "pattern", F.col("day").alias("valid_from"), end.alias("valid_to"))


def url_patterns(url: Column, segments: int) -> Column:
    """All patterns that can list a URL: host, parent domains of two labels or more, paths.

    Paths have up to ``segments`` leading segments.
    """
    host = F.lower(F.regexp_extract(url, PARTS, 1))
    labels = F.split(host, r"\.")
    tails = F.sequence(F.lit(1), F.greatest(F.lit(1), F.size(labels) - 1))
    domains = F.transform(tails, lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    steps = F.filter(F.split(F.regexp_extract(url, PARTS, 2), "/"), lambda s: s != "")
    deepest = F.least(F.lit(segments), F.size(steps))
    depths = F.when(deepest > 0, F.sequence(F.lit(1), deepest))
    depths = F.coalesce(depths, F.array().cast("array<int>"))
    paths = F.transform(depths, lambda i: F.concat(host, F.lit("/"), F.array_join(F.slice(steps, 1, i), "/")))
    return F.when(host != "", F.array_distinct(F.concat(domains, paths))).otherwise(F.array().cast("array<string>"))


def _month(day: Column) -> Column:
    return F.year(day) * 12 + F.month(day)


def evaluate_captures(captures: DataFrame, entries: DataFrame) -> DataFrame:
    """Per capture: capture_id, fetched, n_active, blocked, matched.

    ``n_active`` counts the (list, pattern) entries active at ``fetched``;
    ``matched`` is the longest such pattern (ties by text).  Captures whose url
    or date is null, or whose url has no host, match nothing.  Rows that repeat
    a capture id and date are one capture.  How deep paths are looked up and how
    far intervals are laid out follow from the entries and captures at hand, so
    entries of any depth and captures of any day can match.  Other columns are
    ignored.
    """
    need_columns(captures, "capture_id", "url", "fetched")
    spans = validity_intervals(entries)
    slashes = F.length("pattern") - F.length(F.replace("pattern", F.lit("/")))
    depth = entries.agg(F.coalesce(F.max(slashes), F.lit(0))).first()[0]
    first, last = captures.agg(F.min("fetched"), F.max("fetched")).first()
    # Only the months of captures are laid out.
    start = F.greatest("valid_from", F.lit(first).cast("date"))
    end = F.least(F.date_sub("valid_to", 1), F.lit(last).cast("date"))
    spans = spans.withColumn("start", start).withColumn("end", end).where("start <= end")
    months = F.sequence(_month(F.col("start")), _month(F.col("end")))
    spans = spans.select("list", "pattern", "valid_from", "valid_to", F.explode(months).alias("month"))
    rows = captures.select("capture_id", "fetched", F.explode(url_patterns(F.col("url"), depth)).alias("pattern"))
    rows = rows.where("fetched IS NOT NULL").withColumn("month", _month(F.col("fetched"))).distinct()
    hits = rows.join(spans, ["pattern", "month"]).where("valid_from <= fetched AND fetched < valid_to")
    best = F.max(F.struct(F.length("pattern").alias("size"), "pattern"))["pattern"]
    active = hits.groupBy("capture_id", "fetched").agg(F.count("*").alias("n_active"), best.alias("matched"))
    ids = captures.select("capture_id", "fetched").distinct()
    out = ids.alias("c").join(
        active.alias("a"), F.expr("c.capture_id <=> a.capture_id AND c.fetched <=> a.fetched"), "left"
    )
    return out.select(
        "c.capture_id",
        "c.fetched",
        F.coalesce("n_active", F.lit(0)).alias("n_active"),
        F.col("n_active").isNotNull().alias("blocked"),
        "matched",
    )
