"""Old table layouts to the current one, and constraint checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedloom.functions.scalars import blank_to_null
from feedloom.schemas import (
    MEDIA,
    TWEET_LENGTHS,
    TWEET_REQUIRED,
    TWEETS,
    USER_LENGTHS,
    USER_REQUIRED,
    USERS,
)

# Columns of old layouts that the current tables no longer have.
OBSOLETE_TWEET_COLUMNS = (
    "lang",
    "text_raw",
    "text_normalized",
    "tweet_type",
    "is_retweet",
    "is_reply",
    "is_quote",
    "parent_tweet_id",
    "conversation_id",
    "likes",
    "retweets",
    "replies",
    "quotes",
    "views",
    "bookmarks",
    "hashtags",
    "cashtags",
    "pinned",
    "raw_json",
)
OBSOLETE_USER_COLUMNS = ("pinned_tweet_id", "raw_json")

TEXT_SOURCES = ("text_normalized", "text_raw")

def _backfilled_text(columns: list[str]) -> Column:
    own = F.col("text") if "text" in columns else F.lit(None).cast("string")
    sources = [blank_to_null(F.col(c)) for c in TEXT_SOURCES if c in columns]
    return F.when(F.coalesce(own, F.lit("")) == "", F.coalesce(*sources, own)).otherwise(own)


def conform_legacy(table: DataFrame) -> DataFrame:
    """Any older layout of the posts table in the current one.

    Empty text is filled from the older text columns (the normalised one
    first), a missing author becomes 0, missing columns are added empty and
    obsolete ones go.  One projection; unused columns are never read.
    """
    columns = table.columns
    filled = {
        "text": _backfilled_text(columns),
        "author_id": F.coalesce(F.col("author_id"), F.lit(0)) if "author_id" in columns else F.lit(0),
    }
    out = []
    for field in TWEETS.fields:
        value = filled.get(field.name)
        if value is None:
            value = F.col(field.name) if field.name in columns else F.lit(None)
        out.append(value.cast(field.dataType).alias(field.name))
    return table.select(*out)


def conform_legacy_users(table: DataFrame) -> DataFrame:
    """The users table without its obsolete columns."""
    return table.drop(*OBSOLETE_USER_COLUMNS)


def _violations(required: tuple[str, ...], lengths: dict[str, int]) -> Column:
    checks = [F.when(F.col(c).isNull(), F.lit(f"{c}_null")) for c in required]
    checks += [
        F.when(F.length(c) > size, F.lit(f"{c}_longer_than_{size}")) for c, size in lengths.items()
    ]
    return F.array_compact(F.array(*checks))


def _with_violations(
    table: DataFrame, required: tuple[str, ...], lengths: dict[str, int], unique: bool
) -> DataFrame:
    """``violations`` per row; ``id_repeated`` marks rows sharing their key.

    Repeated keys are found by a pre-aggregated count and joined back, so the
    side that meets a hot key has one row for it and Spark may split the other.
    """
    if not unique:
        return table.withColumn("violations", _violations(required, lengths))
    repeated = (
        table.where("id IS NOT NULL")
        .groupBy("id")
        .agg(F.count("*").alias("_n"))
        .where("_n > 1")
        .select("id", F.lit("id_repeated").alias("_repeated"))
    )
    joined = table.join(repeated, "id", "left")
    found = F.concat(_violations(required, lengths), F.array_compact(F.array("_repeated")))
    return joined.withColumn("violations", found).select(*table.columns, "violations")


def validate_tweets(table: DataFrame, unique: bool = True) -> DataFrame:
    """The posts with an array of the constraints each row breaks.

    A batch to be merged may repeat ids: ``unique=False``, which needs no shuffle.
    """
    return _with_violations(table, TWEET_REQUIRED, TWEET_LENGTHS, unique)


def validate_users(table: DataFrame, unique: bool = True) -> DataFrame:
    return _with_violations(table, USER_REQUIRED, USER_LENGTHS, unique)


def split_valid(validated: DataFrame, mode: str = "quarantine") -> tuple[DataFrame, DataFrame]:
    """``(valid, quarantine)`` rows.

    With ``mode="fail"`` the valid side raises on the first broken row when it
    is used, so a batch is stored whole or not at all.
    """
    if mode not in ("fail", "quarantine"):
        raise ValueError(f"unknown mode {mode}")
    broken = F.size("violations") > 0
    quarantine = validated.where(broken)
    if mode == "fail":
        text = F.concat(
            F.lit("constraint broken by id "),
            F.coalesce(F.col("id").cast("string"), F.lit("null")),
            F.lit(": "),
            F.array_join("violations", ", "),
        )
        checked = validated.where(
            F.when(broken, F.raise_error(text).cast("boolean")).otherwise(F.lit(True))
        )
        return checked.drop("violations"), quarantine
    return validated.where(~broken).drop("violations"), quarantine


def side_counts(validated: DataFrame) -> DataFrame:
    """Rows on each ``side`` (``valid``, ``quarantine``), counted in one pass."""
    side = F.when(F.size("violations") > 0, "quarantine").otherwise("valid")
    return validated.groupBy(side.alias("side")).agg(F.count("*").alias("n"))


def with_defaults(table: DataFrame) -> DataFrame:
    """Column defaults of the posts table where a value is missing."""
    defaults = {
        "author_name": F.lit(""),
        "urls": F.array().cast(T.ArrayType(T.StringType())),
        "media_urls": F.array().cast(T.ArrayType(MEDIA)),
        "source_operation": F.lit(""),
    }
    return table.withColumns({c: F.coalesce(F.col(c), d) for c, d in defaults.items()})


def with_user_defaults(table: DataFrame) -> DataFrame:
    """Column defaults of the users table where a value is missing."""
    counts = ("followers_count", "following_count", "tweets_count")
    defaults = {c: F.lit(0) for c in counts} | {"verified": F.lit(False)}
    return table.withColumns({c: F.coalesce(F.col(c), d) for c, d in defaults.items()}).select(
        *USERS.fieldNames()
    )
