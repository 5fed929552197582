"""Continuous ingestion: the batch pipeline over a folder of arriving files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from feedloom.operators.flatten import flatten_timeline
from feedloom.operators.parse import parse_tweets
from feedloom.plans.ingest import RANGE_BITS, ingest_batch
from feedloom.session import configure
from feedloom.sources.payloads import ingest_payloads

CAPTURE = T.StructType(
    [
        T.StructField("run_id", T.StringType()),
        T.StructField("operation", T.StringType()),
        T.StructField("page_no", T.IntegerType()),
        T.StructField("request_cursor", T.StringType()),
        T.StructField("captured_at", T.TimestampType()),
        T.StructField("http_status", T.IntegerType()),
        T.StructField("value", T.StringType()),
    ]
)


def read_capture_stream(
    spark: SparkSession, in_dir: str, max_files: int | None = None
) -> DataFrame:
    """Stream of captured pages, one JSON line each; ``value`` is the raw body."""
    reader = spark.readStream.schema(CAPTURE)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.json(in_dir)


def stream_parse(pages: DataFrame) -> DataFrame:
    """Stateless part: parsed candidates of a page stream."""
    return parse_tweets(flatten_timeline(ingest_payloads(pages)), F.col("captured_at"))


def stream_ingest(
    spark: SparkSession,
    in_dir: str,
    table: str,
    checkpoint: str,
    count: int | None = None,
    max_files: int | None = None,
    range_bits: int = RANGE_BITS,
    on_violation: str = "quarantine",
) -> StreamingQuery:
    """Merge every arriving file into the tables under ``table``, then stop.

    The batch id is the table version, so a replayed batch changes nothing.
    The table itself is the dedup state; no watermark is needed.
    """
    configure(spark)

    def run(pages: DataFrame, batch_id: int) -> None:
        ingest_batch(
            pages, table, batch_id, count=count, range_bits=range_bits, on_violation=on_violation
        )

    return (
        read_capture_stream(spark, in_dir, max_files)
        .writeStream.foreachBatch(run)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
