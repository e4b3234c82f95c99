"""Ends of streams: a time after which a query stops between two batches."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery


class TimeIsOver(RuntimeError):
    """A batch was to begin after the query's time; it has not begun, and the next run takes it."""


def until(write: Callable[[DataFrame, int], None], limit: float) -> Callable[[DataFrame, int], None]:
    """The writer, which refuses batches once the limit (in seconds) has passed. A batch that has begun is finished."""
    deadline = time.monotonic() + limit

    def gated(rows: DataFrame, batch_id: int) -> None:
        if time.monotonic() > deadline:
            raise TimeIsOver(f"batch {batch_id}")
        write(rows, batch_id)

    return gated


def seconds(spark: SparkSession, interval: str) -> float:
    """An interval as Spark reads it, such as '60 seconds' or '1 hour'."""
    moved = spark.range(1).selectExpr(f"unix_micros(timestamp_seconds(0) + interval {interval}) as micros").first()
    return moved.micros / 1e6


def run_for(query: StreamingQuery, limit: float, poll: float = 0.2) -> bool:
    """Wait until a query whose writer ends by `until` is over: by itself, or by the limit (in seconds), which gives True.

    A query without new data has no batch to refuse and is stopped while it waits.
    """
    try:
        if query.awaitTermination(limit):
            return False
        while query.isActive:
            if not query.status["isTriggerActive"]:
                query.stop()
            query.awaitTermination(poll)
    except StreamingQueryException as error:
        if TimeIsOver.__name__ not in str(error):
            raise
    return True
