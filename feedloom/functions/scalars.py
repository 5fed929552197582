"""Scalar conversions: tolerant integers and wire-format dates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Wire format of post timestamps, "Sat Mar 08 12:00:00 +0000 2026".
# Spark does not parse weekday names, so the pattern covers what follows them.
WEEKDAY_PREFIX = r"(?i)^(?:mon|tue|wed|thu|fri|sat|sun)\s+(\S.*)$"
WIRE_DATE_FORMAT = "MMM d HH:mm:ss Z yyyy"


# What can be a number at all.  Testing first keeps casts from failing, as a
# failed cast costs far more than a match.
INTEGER = r"^\s*[+-]?[0-9]+\s*$"
PLAIN = r"^\s*[+-]?(?:[0-9]+\.[0-9]*|\.[0-9]+)\s*$"
NUMBER = r"^\s*[+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?\s*$"


def safe_int(text: Column, default: int | None = 0) -> Column:
    """Commas dropped, decimals truncated toward zero, anything else ``default``."""
    clean = F.replace(text, F.lit(","), F.lit(""))
    # A fraction is cut from the text: a cast to decimals would round it.
    whole = F.substring_index(F.trim(clean), ".", 1)
    whole = F.when(whole.isin("", "+", "-"), "0").otherwise(whole)
    number = (
        F.when(clean.rlike(INTEGER), clean.try_cast("bigint"))
        .when(clean.rlike(PLAIN), whole.try_cast("bigint"))
        .when(clean.rlike(NUMBER), clean.try_cast("decimal(38,18)").try_cast("bigint"))
    )
    return F.coalesce(number, F.lit(default).cast("bigint"))


def is_infinite(text: Column) -> Column:
    """Infinity spellings, which have no integer value at all."""
    clean = F.trim(F.replace(text, F.lit(","), F.lit("")))
    return F.coalesce(clean.rlike(r"(?i)^[+-]?inf(inity)?$"), F.lit(False))


def strict_int(text: Column, default: int | None = 0) -> Column:
    """A plain integer or ``default``."""
    return F.coalesce(
        F.when(text.rlike(INTEGER), text.try_cast("bigint")), F.lit(default).cast("bigint")
    )


def wire_date(text: Column, fallback: Column) -> Column:
    """Parse a wire-format date; missing or malformed text gives ``fallback``."""
    rest = F.regexp_extract(text, WEEKDAY_PREFIX, 1)
    return F.coalesce(F.try_to_timestamp(rest, F.lit(WIRE_DATE_FORMAT)), fallback)


def blank_to_null(text: Column) -> Column:
    return F.nullif(text, F.lit(""))
