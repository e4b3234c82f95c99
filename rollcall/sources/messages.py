"""Message topics as streaming DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rollcall.schemas import MESSAGE

# Bounds of a micro-batch. A job holds one batch at a time, so without them the first batch after a start
# from the earliest offset would be the whole topic.
MAX_OFFSETS = 50_000_000
MAX_FILES = 1_000
# Offsets that one task reads at most, so that a topic of one partition is still read by many.
MAX_RECORDS_PER_TASK = 1_000_000


def kafka_messages(
    spark: SparkSession,
    servers: str,
    topic: str,
    *,
    starting_offsets: str = "earliest",
    max_per_trigger: int = MAX_OFFSETS,
    **options,
) -> DataFrame:
    """A Kafka topic from its earliest offset. Needs the spark-sql-kafka package of the running Spark.

    ``options`` are the source's own (security, ``minPartitions``) and win over the settings made here.
    """
    settings = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting_offsets,
        "maxOffsetsPerTrigger": str(max_per_trigger),
        "maxRecordsPerPartition": str(MAX_RECORDS_PER_TASK),
        **options,
    }
    return spark.readStream.format("kafka").options(**settings).load()


def file_messages(spark: SparkSession, path: str, *, max_per_trigger: int = MAX_FILES) -> DataFrame:
    """A topic kept as Parquet files with the columns of the Kafka source."""
    return spark.readStream.schema(MESSAGE).option("maxFilesPerTrigger", max_per_trigger).parquet(path)
