"""Stored users and other tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rollcall.sinks.batches import Slices
from rollcall.sources.messages import MAX_FILES


def load_users(spark: SparkSession, source_format: str = "parquet", **options) -> DataFrame:
    """The stored users from any batch source: a file format, or a connector such as Cassandra or JDBC.

    Lazy, so the columns a count does not use never leave the store. A folder that a `BatchTable` keeps is read as its log
    says.
    """
    if source_format == "parquet" and "path" in options:
        slices = Slices(spark, options["path"])
        if live := slices.live():
            others = {name: value for name, value in options.items() if name != "path"}
            return spark.read.options(**others).parquet(*map(slices.place, live))
    return spark.read.format(source_format).options(**options).load()


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def table_stream(spark: SparkSession, folder: str, name: str, max_per_trigger: int | None = MAX_FILES) -> DataFrame:
    """The table as a stream. The braces make a glob, which takes a file as well as a folder of files."""
    reader = spark.readStream.schema(table(spark, folder, name).schema)
    if max_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_per_trigger)
    return reader.parquet(f"{folder}/{{{name}}}.parquet")
