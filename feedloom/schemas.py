"""Fixed table schemas."""

from __future__ import annotations

from pyspark.sql import types as T

MEDIA = T.StructType(
    [
        T.StructField("type", T.StringType()),
        T.StructField("url", T.StringType()),
        T.StructField("width", T.IntegerType()),
        T.StructField("height", T.IntegerType()),
    ]
)

TWEETS = T.StructType(
    [
        T.StructField("id", T.LongType(), False),
        T.StructField("author_id", T.LongType(), False),
        T.StructField("author_handle", T.StringType(), False),
        T.StructField("author_name", T.StringType()),
        T.StructField("created_at", T.TimestampType(), False),
        T.StructField("text", T.StringType(), False),
        T.StructField("reply_to_tweet_id", T.LongType()),
        T.StructField("reply_to_author_handle", T.StringType()),
        T.StructField("reply_to_text", T.StringType()),
        T.StructField("quoted_tweet_id", T.LongType()),
        T.StructField("quoted_author_handle", T.StringType()),
        T.StructField("quoted_text", T.StringType()),
        T.StructField("urls", T.ArrayType(T.StringType())),
        T.StructField("media_urls", T.ArrayType(MEDIA)),
        T.StructField("source_operation", T.StringType(), False),
        T.StructField("scraped_at", T.TimestampType(), False),
    ]
)

USERS = T.StructType(
    [
        T.StructField("id", T.LongType(), False),
        T.StructField("screen_name", T.StringType(), False),
        T.StructField("name", T.StringType()),
        T.StructField("bio", T.StringType()),
        T.StructField("location", T.StringType()),
        T.StructField("url", T.StringType()),
        T.StructField("followers_count", T.IntegerType()),
        T.StructField("following_count", T.IntegerType()),
        T.StructField("tweets_count", T.IntegerType()),
        T.StructField("verified", T.BooleanType()),
        T.StructField("profile_image_url", T.StringType()),
        T.StructField("last_scraped_at", T.TimestampType(), False),
        T.StructField("created_at", T.TimestampType(), False),
    ]
)

RUN_ERROR = T.StructType(
    [T.StructField("code", T.StringType()), T.StructField("message", T.StringType())]
)

PARSE_STATS = T.StructType(
    [
        T.StructField("raw", T.LongType()),
        T.StructField("parsed", T.LongType()),
        T.StructField("dropped_no_result", T.LongType()),
        T.StructField("dropped_no_legacy", T.LongType()),
        T.StructField("dropped_schema_fail", T.LongType()),
        T.StructField("dropped_tombstone", T.LongType()),
        T.StructField("dropped_exception", T.LongType()),
        T.StructField("dropped_rt_unparseable", T.LongType()),
        T.StructField("dropped_promoted", T.LongType()),
        T.StructField("drop_rate_percent", T.DoubleType()),
    ]
)

RUNS = T.StructType(
    [
        T.StructField("id", T.StringType(), False),
        T.StructField("started_at", T.TimestampType(), False),
        T.StructField("completed_at", T.TimestampType()),
        T.StructField("status", T.StringType(), False),
        T.StructField("operation", T.StringType(), False),
        T.StructField("tweets_fetched", T.LongType()),
        T.StructField("tweets_new", T.LongType()),
        T.StructField("tweets_updated", T.LongType()),
        T.StructField("errors", T.ArrayType(RUN_ERROR)),
        T.StructField("cursor_resume", T.StringType()),
        T.StructField("metadata", T.MapType(T.StringType(), T.StringType())),
        T.StructField("parse_stats", PARSE_STATS),
    ]
)

# Longest value each bounded column may hold.
TWEET_LENGTHS = {
    "author_handle": 50,
    "author_name": 200,
    "reply_to_author_handle": 50,
    "quoted_author_handle": 50,
    "source_operation": 50,
}
USER_LENGTHS = {"screen_name": 50, "name": 200, "location": 300}

TWEET_REQUIRED = tuple(f.name for f in TWEETS.fields if not f.nullable)
USER_REQUIRED = tuple(f.name for f in USERS.fields if not f.nullable)
