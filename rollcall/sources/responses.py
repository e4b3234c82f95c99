"""API responses that a fetcher has landed: their text, a stable id, and the order they arrived in."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollcall.functions import position_id, stable_id

# Bound of a micro-batch in bytes: landed files may hold one response or a million.
MAX_BYTES = 1 << 30


def _bounded(streaming: bool, max_files: int | None, max_bytes: int, options: dict) -> dict:
    if not streaming:
        return options
    bound = {"maxFilesPerTrigger": str(max_files)} if max_files else {"maxBytesPerTrigger": str(max_bytes)}
    return bound | options


def responses_from_files(
    spark: SparkSession,
    path: str,
    *,
    streaming: bool = False,
    max_per_trigger: int | None = None,
    max_bytes: int = MAX_BYTES,
    **options,
) -> DataFrame:
    """One response per file, ordered by (modification time, file). A stream's batches are bounded by bytes, or by files."""
    options = _bounded(streaming, max_per_trigger, max_bytes, options)
    reader = spark.readStream if streaming else spark.read
    files = reader.format("text").options(wholetext="true", **options).load(path)
    file = F.col("_metadata.file_path")
    arrival = F.struct(F.col("_metadata.file_modification_time").alias("timestamp"), file.alias("file"))
    return files.select(stable_id(file).alias("id"), F.col("value").alias("response"), arrival.alias("arrival"))


def responses_from_table(
    spark: SparkSession,
    path: str,
    *,
    streaming: bool = False,
    max_per_trigger: int | None = None,
    max_bytes: int = MAX_BYTES,
    **options,
) -> DataFrame:
    """Many responses per Parquet file, in a ``response`` column, ordered by (modification time, file, row).

    A stream's batches are bounded by bytes, or by files.
    """
    options = _bounded(streaming, max_per_trigger, max_bytes, options)
    reader = spark.readStream.schema("response string") if streaming else spark.read.schema("response string")
    files = reader.options(**options).parquet(path)
    file, row = F.col("_metadata.file_path"), F.col("_metadata.row_index")
    arrival = F.struct(
        F.col("_metadata.file_modification_time").alias("timestamp"), file.alias("file"), row.alias("row")
    )
    return files.select(stable_id(file, row).alias("id"), "response", arrival.alias("arrival"))


def responses_from_messages(messages: DataFrame) -> DataFrame:
    """Responses a fetcher published as messages."""
    return messages.select(
        position_id().alias("id"),
        F.col("value").cast("string").alias("response"),
        F.struct("timestamp", "topic", "partition", "offset").alias("arrival"),
    )
