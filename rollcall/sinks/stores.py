"""External stores and topics, reached through whichever connector the session has."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from rollcall.operators.codec import encode
from rollcall.sinks.log import Log

BatchWriter = Callable[[DataFrame, int], None]


def keyed_store(store_format: str, **options) -> BatchWriter:
    """Append to a store that upserts by key (Cassandra does). Stable ids make a replay harmless."""

    def write(rows: DataFrame, batch_id: int) -> None:
        rows.write.format(store_format).options(**options).mode("append").save()

    return write


def once_store(spark: SparkSession, store_format: str, ledger: str, *, key: str = "id", **options) -> BatchWriter:
    """Append to a store without keys, each row once.

    A ledger beside the store notes that a batch has begun, and that it is done. A batch that is done isn't written again.
    One that had begun is a replay after a crash, which may have left any part of its rows in the store: their keys are
    read back, and only the missing rows are written. So a replay costs a read of the keys, other batches nothing. Keys must
    be unique, and the same on a replay, as stable ids are.
    """
    log = Log(spark, ledger)

    def write(rows: DataFrame, batch_id: int) -> None:
        state = log.read() or {"begun": -1, "done": -1}
        if batch_id <= state["done"]:
            return
        if state["begun"] == batch_id:
            there = _stored(spark, store_format, options)
            rows = rows if there is None else rows.join(there.select(key), key, "left_anti").select(rows.columns)
        else:
            log.commit(lambda old, number: {**(old or state), "begun": batch_id})
        rows.write.format(store_format).options(**options).mode("append").save()
        log.commit(lambda old, number: {"begun": batch_id, "done": batch_id})

    return write


def _stored(spark: SparkSession, store_format: str, options: dict) -> DataFrame | None:
    try:
        return spark.read.format(store_format).options(**options).load()
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None  # a file format before its first row
        raise


def topic(sink_format: str = "kafka", **options) -> BatchWriter:
    """Publish events as keyless JSON messages, at least once."""

    def write(events: DataFrame, batch_id: int) -> None:
        encode(events).write.format(sink_format).options(**options).mode("append").save()

    return write


def both(first: BatchWriter, second: BatchWriter) -> BatchWriter:
    """Each batch to one writer, then to the other."""

    def write(rows: DataFrame, batch_id: int) -> None:
        first(rows, batch_id)
        second(rows, batch_id)

    return write
