"""Counts over the stored users. Every stored row counts, and NULL is a group of its own."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.functions import registration_year

DIMENSIONS = ("country", "gender", "registration_year")


def with_registration_year(users: DataFrame) -> DataFrame:
    return users.withColumn("registration_year", registration_year("registered_date"))


def count_by(users: DataFrame, *columns: str) -> DataFrame:
    return users.groupBy(*columns).agg(F.count("*").alias("total"))


def count_by_country(users: DataFrame) -> DataFrame:
    return count_by(users, "country")


def count_by_gender(users: DataFrame) -> DataFrame:
    return count_by(users, "gender")


def count_by_year(users: DataFrame) -> DataFrame:
    """Users per registration year, ascending; rows without a readable date come last."""
    return count_by(with_registration_year(users), "registration_year").orderBy(F.asc_nulls_last("registration_year"))


def joint_counts(users: DataFrame) -> DataFrame:
    """Users per (country, gender, registration year): one pass from which every total follows."""
    return count_by(with_registration_year(users), *DIMENSIONS)


def totals_from_joint(joint: DataFrame) -> DataFrame:
    """(dim, k, total) for each dimension. `grouping` keeps a NULL key apart from "not grouped by"."""
    sets = [[F.col(name)] for name in DIMENSIONS]
    grouped = joint.groupingSets(sets, *DIMENSIONS).agg(
        F.sum("total").alias("total"), *(F.grouping(name).alias(f"no_{name}") for name in DIMENSIONS)
    )
    dim = F.coalesce(*(F.when(F.col(f"no_{name}") == 0, F.lit(name)) for name in DIMENSIONS))
    key = F.coalesce(*(F.col(name).cast("string") for name in DIMENSIONS))
    return grouped.select(dim.alias("dim"), key.alias("k"), "total")


def chart_totals(users: DataFrame) -> DataFrame:
    """All three counts in one scan of the users.

    Grouping sets directly over the users would triple every row before the aggregate. Counting the
    combinations first keeps one hash update per row; only the few combinations are expanded.
    """
    return totals_from_joint(joint_counts(users))
