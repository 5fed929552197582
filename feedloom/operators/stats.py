"""Parse counters, drop rate and the high-drop alert."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.operators.parse import DROP_REASONS

# The alert fires above this rate, and only above this many rows.
ALERT_RATE = 80
ALERT_ROWS = 5

COUNTERS = ("raw", "parsed", *DROP_REASONS)


def counter_columns() -> list[Column]:
    """The counters as aggregates; all are combined before the shuffle."""
    return [
        F.count("*").alias("raw"),
        F.count_if(F.col("drop_reason").isNull()).alias("parsed"),
        *[F.count_if(F.col("drop_reason") == reason).alias(reason) for reason in DROP_REASONS],
    ]


def drop_rate() -> Column:
    """Dropped share in percent; 0 where there was nothing to parse."""
    dropped = F.col("raw") - F.col("parsed")
    return F.when(F.col("raw") > 0, dropped / F.col("raw") * 100).otherwise(F.lit(0.0))


def alert() -> Column:
    """Too much was dropped, of enough rows to tell."""
    return (drop_rate() > ALERT_RATE) & (F.col("raw") > ALERT_ROWS)


def parse_stats(parsed: DataFrame, by: list[str]) -> DataFrame:
    """One row of counters per group, with ``drop_rate_percent`` and ``alert``.

    The rate is left unrounded; reports round it to one decimal.
    """
    counted = parsed.groupBy(*by).agg(*counter_columns())
    return counted.withColumns({"drop_rate_percent": drop_rate(), "alert": alert()})
