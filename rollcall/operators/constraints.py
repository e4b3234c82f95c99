"""The checks a relational table would make, as DataFrame operators."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollcall.functions import naive_timestamp
from rollcall.operators.uniqueness import winners
from rollcall.schemas import DATE_FIELDS, EVENT_FIELDS


def violation(fields: tuple[str, ...] = EVENT_FIELDS, dates: tuple[str, ...] = DATE_FIELDS) -> Column:
    """Why a row cannot be stored: ``null:<fields>``, ``date:<fields>``, or NULL if it can."""
    nulls = F.concat_ws(",", *(F.when(F.col(name).isNull(), F.lit(name)) for name in fields))
    unreadable = F.concat_ws(",", *(F.when(naive_timestamp(name).isNull(), F.lit(name)) for name in dates))
    any_null = reduce(or_, (F.col(name).isNull() for name in fields))
    return F.when(any_null, F.concat(F.lit("null:"), nulls)).when(
        unreadable != "", F.concat(F.lit("date:"), unreadable)
    )


def check_rows(events: DataFrame, fields: tuple[str, ...] = EVENT_FIELDS, dates: tuple[str, ...] = DATE_FIELDS) -> DataFrame:
    """Add ``violation`` to every row; nothing is dropped."""
    return events.withColumn("violation", violation(fields, dates))


def storable(checked: DataFrame, dates: tuple[str, ...] = DATE_FIELDS) -> DataFrame:
    """The rows without violation, their dates cast to timestamps without time zone."""
    casts = {name: naive_timestamp(name) for name in dates}
    return checked.filter(F.col("violation").isNull()).drop("violation").withColumns(casts)


def violators(checked: DataFrame) -> DataFrame:
    return checked.filter(F.col("violation").isNotNull())


def check_table(
    events: DataFrame,
    order: str,
    workdir: str,
    *,
    taken: DataFrame | None = None,
    write_checked: bool = True,
    **options,
) -> DataFrame:
    """Every row with its ``violation`` under NOT NULL, the date types and both UNIQUE keys.

    The first row in ``order`` wins. Rows that fail another check reserve no key. ``taken`` holds the rows
    the table already has. The checked rows are read twice, so they are written to ``workdir`` first, unless
    ``events`` are held already.
    """
    checked = check_rows(events)
    if write_checked:
        checked.write.mode("overwrite").parquet(f"{workdir}/checked")
        checked = events.sparkSession.read.schema(checked.schema).parquet(f"{workdir}/checked")
    won = winners(checked.filter(F.col("violation").isNull()), "email", "username", order, workdir, taken=taken, **options)
    verdict = F.coalesce("violation", F.when(F.col("_won").isNull(), "unique:email,username"))
    return checked.join(won.withColumn("_won", F.lit(True)), order, "left").select(
        *events.columns, verdict.alias("violation")
    )
