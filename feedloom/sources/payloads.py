"""Captured pages: raw text in, parsed payload and status out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.functions.variants import is_text, take, text_of, truthy

# Fixed value: error code by which a payload reports a rate limit.
RATE_LIMIT_CODE = 88

RAW_COLUMNS = ("value", "v", "http_status")
STATUS_COLUMNS = ("status", "error_message")


def read_payload_lines(spark: SparkSession, path: str) -> DataFrame:
    """One payload per line of text."""
    return spark.read.text(path)


def stream_payload_lines(spark: SparkSession, path: str) -> DataFrame:
    """The same as a stream over arriving files."""
    return spark.readStream.text(path)


def _reported_error(payload: Column) -> Column:
    """The first reported error, null when the payload reports none."""
    errors = take(payload, "variant", "$.errors")
    first = take(
        payload, "struct<code:variant,message:variant>", "$.errors[0]"
    )
    blank = F.struct(
        F.lit(None).cast("variant").alias("code"), F.lit(None).cast("variant").alias("message")
    )
    return F.when(truthy(errors), F.coalesce(first, blank))


def ingest_payloads(pages: DataFrame) -> DataFrame:
    """Parse ``value`` into ``v`` and classify each page.

    ``status`` is ``ok``, ``invalid_json``, ``rate_limited`` or ``api_error``.
    An HTTP error is reported before the body is looked at, and a reported
    error wins over any data beside it.
    """
    columns = pages.columns
    http = F.col("http_status") if "http_status" in columns else F.lit(None).cast("int")
    parsed = pages.withColumn("v", F.try_parse_json("value")).withColumn(
        "_error", _reported_error(F.col("v"))
    )
    code = F.col("_error.code")
    message = F.col("_error.message")
    limited = (~is_text(code)) & (take(code, "double") == RATE_LIMIT_CODE)
    status = (
        F.when(http == 429, "rate_limited")
        .when(http >= 400, "api_error")
        .when(F.col("v").isNull(), "invalid_json")
        .when(F.col("_error").isNull(), "ok")
        .when(limited, "rate_limited")
        .otherwise("api_error")
    )
    explained = (
        F.when(http >= 400, F.concat(F.lit("HTTP status "), http.cast("string")))
        .when(F.col("v").isNull(), "invalid JSON")
        .when(F.col("_error").isNotNull(), F.coalesce(text_of(message), F.lit("Unknown error")))
    )
    return parsed.withColumn("status", status).withColumn("error_message", explained).drop("_error")
