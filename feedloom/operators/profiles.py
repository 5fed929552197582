"""User payloads -> profile rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.functions.scalars import strict_int
from feedloom.functions.variants import is_text, present, take, text_of, truthy
from feedloom.sources.payloads import RAW_COLUMNS, STATUS_COLUMNS

USER_PATH = "$.data.user.result"
USER = (
    "struct<rest_id:variant,is_blue_verified:variant,legacy:variant>"
)
LEGACY = (
    "struct<screen_name:variant,name:variant,description:variant,followers_count:string,"
    "friends_count:string,statuses_count:string,verified:variant,"
    "profile_image_url_https:variant>"
)


def _count(text: Column) -> Column:
    """Plain integers, and JSON numbers cut to their integer part."""
    return F.coalesce(strict_int(text, None), F.lit(0)).try_cast("int")


def parse_profiles(payloads: DataFrame) -> DataFrame:
    """One profile per ``ok`` payload that holds a user.

    ``requested_name`` (if the payloads have it) is the fallback for a missing
    screen name.  Users that cannot be read keep their keys and a
    ``drop_reason``.  The profile is exploded from an array of at most one, so a
    filter on its columns stays above it and the payload is parsed once.
    """
    keys = [c for c in payloads.columns if c not in RAW_COLUMNS + STATUS_COLUMNS]
    asked = F.col("requested_name") if "requested_name" in keys else F.lit("")
    readable = F.when(F.col("status") == "ok", F.col("v"))
    nodes = F.filter(F.array(take(readable, "variant", USER_PATH)), truthy)
    users = F.transform(nodes, lambda n: take(n, USER))
    read = F.transform(
        users, lambda u: F.struct(u.alias("user"), take(u["legacy"], LEGACY).alias("legacy"))
    )
    profiles = F.transform(F.transform(read, lambda r: _profile(r["user"], r["legacy"], asked)), _judged)
    rows = payloads.select(*keys, F.posexplode_outer(profiles).alias("_at", "_profile"))
    return rows.where("_at IS NOT NULL").select(*keys, "_profile.*")


TEXTS = ("screen_name", "name", "bio", "profile_image_url")


def _profile(user: Column, legacy: Column, asked: Column) -> Column:
    """The columns of a profile, and ``_bad`` for a user that cannot be read."""

    def text(field: str, missing: Column) -> Column:
        node = legacy[field]
        return F.when(node.isNull(), missing).when(is_text(node), text_of(node))

    columns = {
        "id": F.when(user["rest_id"].isNull(), F.lit(0)).otherwise(
            strict_int(text_of(user["rest_id"]), None)
        ),
        "screen_name": text("screen_name", asked),
        "name": text("name", F.lit("")),
        "bio": text("description", F.lit("")),
        "location": F.lit(None).cast("string"),
        "url": F.lit(None).cast("string"),
        "followers_count": _count(legacy["followers_count"]),
        "following_count": _count(legacy["friends_count"]),
        "tweets_count": _count(legacy["statuses_count"]),
        "verified": truthy(user["is_blue_verified"]) | truthy(legacy["verified"]),
        "profile_image_url": text("profile_image_url_https", F.lit("")),
    }
    unreadable = user.isNull() | (present(user["legacy"]) & legacy.isNull())
    return F.struct(unreadable.alias("_bad"), *[c.alias(n) for n, c in columns.items()])


def _judged(profile: Column) -> Column:
    """The profile with its ``drop_reason`` instead of ``_bad``."""
    invalid = profile["id"].isNull()
    for name in TEXTS:
        invalid = invalid | profile[name].isNull()
    reason = F.when(profile["_bad"], "dropped_exception").when(invalid, "dropped_schema_fail")
    return profile.withField("drop_reason", reason).dropFields("_bad")
