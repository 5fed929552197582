"""Session settings the package relies on."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Result-relevant settings.  Everything else (shuffle partitions, AQE
# thresholds, memory) is the cluster's choice and is left alone.
RESULT_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    # JSON readers commonly let the last duplicate key win; Spark's default
    # turns such a document into null.
    "spark.sql.variant.allowDuplicateKeys": "true",
}

# Rows that one Arrow batch may carry to a Python worker.  Texts are long, so a
# worker's memory follows the batch; a smaller setting is kept.
ARROW_ROWS = 256


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings that change results, and the batch bound; safe to call repeatedly."""
    for key, value in RESULT_SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= ARROW_ROWS:
        spark.conf.set(key, str(ARROW_ROWS))
    return spark


def local_session(cores: str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A local session for tests and the benchmark (not used on a cluster)."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("feedloom")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        # Small local inputs still deserve all cores.
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "128KB")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)
