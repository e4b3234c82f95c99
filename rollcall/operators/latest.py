"""Keyed upsert: the newest row per key stands."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_per_key(rows: DataFrame, key: str, order: str) -> DataFrame:
    """One row per key, the one with the highest ``order``.

    Of rows with equal ``order`` the greater one by its other columns stands, so that a replay decides alike.
    An aggregate instead of a window: each task keeps one candidate per key before the shuffle, so a key
    with a third of all rows sends one row per task.
    """
    others = [name for name in rows.columns if name not in (key, order)]
    newest = rows.groupBy(key).agg(F.max(F.struct(order, *others)).alias("_row"))
    return newest.select(
        *(F.col(name) if name == key else F.col("_row")[name].alias(name) for name in rows.columns)
    )


def upsert(current: DataFrame, changes: DataFrame, key: str, order: str) -> DataFrame:
    """``current`` after ``changes`` were written over it by key."""
    return latest_per_key(current.unionByName(changes), key, order)
