"""Namespace and table, created where absent."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import types as T


def create_if_absent(spark: SparkSession, namespace: str, name: str, schema: T.StructType, location: str, *, batches: str | None = None) -> str:
    """Idempotent. Spark's Parquet tables know no keys: uniqueness is the operators' business.

    The table lies at ``<location>/<name>``, or it is that of the `BatchTable` at ``batches``, which registers a partition per
    batch. The namespace has a folder of its own, as dropping it removes that folder.
    """
    place = batches or f"{location}/{name}"
    columns = ", ".join(f"`{field.name}` {field.dataType.simpleString()}" for field in schema)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{namespace}` LOCATION '{location}'")
    parts = ("batch_id BIGINT", "PARTITIONED BY (batch_id)") if batches else ("", "")
    columns = ", ".join(filter(None, (columns, parts[0])))
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS `{namespace}`.`{name}` ({columns}) USING parquet {parts[1]} LOCATION '{place}'"
    )
    return f"`{namespace}`.`{name}`"
