"""Records a producer sent again.

A record is a copy if one with the same keys came at most ``within`` before it, kept or not. Time is cut into slots as
long as ``within``: copies in one slot are then always within reach of each other, so each slot is summed up by its
first record and its first and last time, and only neighbouring slots have to be compared.
"""

from __future__ import annotations

from datetime import timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def seen_schema(records: T.StructType, keys: list[str]) -> T.StructType:
    times = [T.StructField(name, T.TimestampType()) for name in ("first", "last")]
    return T.StructType([*(records[key] for key in keys), T.StructField("slot", T.LongType()), *times])


def copies_per_slot(records: DataFrame, keys: list[str], time: str, within: timedelta) -> DataFrame:
    """One row per keys and slot: the slot's first record, and its ``first`` and ``last`` time."""
    length = F.lit(within // timedelta(microseconds=1))
    micros = F.unix_micros(time)
    slot = F.call_function("div", micros - F.pmod(micros, length), length).alias("slot")
    others = [name for name in records.columns if name not in keys and name != time]
    # Times alone are summed up in a hash table; a whole record has to be sorted.
    record = [F.min(F.struct(time, *others)).alias("_record")] if others else []
    grouped = records.groupBy(*keys, slot).agg(*record, F.min(time).alias("first"), F.max(time).alias("last"))
    fields = (F.col("_record")[name].alias(name) for name in others)
    return grouped.select(*keys, "slot", "first", "last", F.col("first").alias(time), *fields)


def first_copies(spans: DataFrame, seen: DataFrame, keys: list[str], within: timedelta) -> DataFrame:
    """The records of ``spans`` that no earlier copy precedes, neither in ``spans`` nor in what was ``seen`` before."""
    reach = F.lit(within)
    summary = [F.col(name).alias(f"_{name}") for name in (*keys, "first", "last")]
    # A slot of this batch can only reach into the next one; one seen earlier may also meet a late record before it.
    next_slot = spans.select(*summary, (F.col("slot") + 1).alias("_slot"))
    around = F.explode(F.array(*(F.col("slot") + step for step in (-1, 0, 1)))).alias("_slot")
    neighbours = next_slot.unionByName(seen.select(*summary, around))
    same = reduce(Column.__and__, (F.col(key).eqNullSafe(F.col(f"_{key}")) for key in keys))
    near = F.col("first").between(F.col("_first") - reach, F.col("_last") + reach)
    return spans.join(neighbours, same & (F.col("slot") == F.col("_slot")) & near, "left_anti")
