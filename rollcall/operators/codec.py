"""Events to message bytes and back, with a quarantine for what cannot be read."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollcall.schemas import DECODED, EVENT_FIELDS

_CORRUPT = "_corrupt"
SOURCE_FIELDS = ("topic", "partition", "offset", "timestamp")


def json_bytes(fields: tuple[str, ...] = EVENT_FIELDS) -> Column:
    """The record as UTF-8 JSON. NULL fields are written as null, not left out."""
    return F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}).cast("binary")


def encode(events: DataFrame, keep: tuple[str, ...] = (), fields: tuple[str, ...] = EVENT_FIELDS) -> DataFrame:
    return events.select(*keep, json_bytes(fields).alias("value"))


def parse_messages(
    messages: DataFrame, schema: T.StructType = DECODED, keep: tuple[str, ...] = SOURCE_FIELDS
) -> DataFrame:
    """Add ``record`` (the JSON under ``schema`` plus ``_corrupt``) and ``reason`` (NULL when readable).

    ``value`` stays with the unreadable messages only; elsewhere the record says it all.

    Parsing is permissive, as a stream must be: one bad message never ends the job. Missing fields are
    NULL, unknown ones are ignored, and text after the closing brace is ignored.
    """
    text = F.col("value").cast("string")
    with_corrupt = T.StructType([*schema.fields, T.StructField(_CORRUPT, T.StringType())])
    parsed = messages.select(
        *keep,
        "value",
        F.from_json(text, with_corrupt, {"columnNameOfCorruptRecord": _CORRUPT}).alias("record"),
    )
    record = F.col("record")
    reason = (
        F.when(F.col("value").isNull(), "null_value")
        .when(F.length("value") == 0, "empty_value")
        .when(~F.is_valid_utf8(text), "invalid_utf8")
        .when(record.isNull() | record[_CORRUPT].isNotNull(), "malformed_json")
    )
    raw = F.when(F.col("reason").isNotNull(), F.col("value"))
    return parsed.withColumn("reason", reason).withColumn("value", raw)


def records(parsed: DataFrame, keep: tuple[str, ...] = SOURCE_FIELDS, include_unreadable: bool = False) -> DataFrame:
    """The readable records as columns.

    ``include_unreadable`` keeps every message; an unreadable one is then a row of NULLs, which is how
    a pipeline without quarantine stores it.

    Readable rows leave through a generator rather than a filter: Catalyst would push a filter on the
    parse result below the projection and parse every message twice.
    """
    if include_unreadable:
        return parsed.select(*keep, "record.*").drop(_CORRUPT)
    return parsed.select(*keep, F.inline(F.when(F.col("reason").isNull(), F.array("record")))).drop(_CORRUPT)


def quarantine(parsed: DataFrame, keep: tuple[str, ...] = SOURCE_FIELDS) -> DataFrame:
    """The unreadable messages: position, untouched bytes and reason."""
    reason = F.explode(F.when(F.col("reason").isNotNull(), F.array("reason")))
    return parsed.select(*keep, "value", reason.alias("reason"))
