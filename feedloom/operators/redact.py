"""Redaction of whole tables, and a report of what was found."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedloom.functions.redaction import (
    redact_array,
    redact_map,
    redact_text,
    secret_words,
    sensitive_keys,
)


def redact_table(table: DataFrame, columns: list[str], mode: str = "strict") -> DataFrame:
    """Mask secrets in the named text, map<string,string> and array<string> columns."""
    masked = {}
    for name in columns:
        kind = table.schema[name].dataType
        if isinstance(kind, T.StringType):
            masked[name] = redact_text(F.col(name), mode)
        elif isinstance(kind, T.MapType):
            masked[name] = redact_map(F.col(name))
        elif isinstance(kind, T.ArrayType):
            masked[name] = redact_array(F.col(name))
        else:
            raise TypeError(f"cannot redact column {name} of type {kind.simpleString()}")
    return table.withColumns(masked)


def secret_report(table: DataFrame, column: str, mode: str = "strict") -> DataFrame:
    """Findings in a text column: ``kind, finding, n``.

    ``key`` rows count each sensitive key that is given a value, ``token`` is
    the number of blank-separated words that look like a secret.  Only hits are
    exploded, never the words themselves.
    """
    text = F.col(column)
    keys = F.transform(
        sensitive_keys(text, mode),
        lambda k: F.struct(F.lit("key").alias("kind"), F.lower(k).alias("finding")),
    )
    tokens = F.transform(
        secret_words(text),
        lambda t: F.struct(F.lit("token").alias("kind"), F.lit("token").alias("finding")),
    )
    found = table.select(F.explode_outer(F.concat(keys, tokens)).alias("hit"))
    return (
        found.where("hit IS NOT NULL")
        .groupBy(F.col("hit.kind").alias("kind"), F.col("hit.finding").alias("finding"))
        .agg(F.count("*").alias("n"))
    )
