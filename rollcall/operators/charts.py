"""The data sets behind the dashboard's figures."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.operators.counts import count_by_country


def share_by_country(users: DataFrame) -> DataFrame:
    """(country, total, share of all users).

    The grand total is a scalar subquery over the same counts: no window over all groups, no cross join,
    and Spark runs the shared exchange once.
    """
    return with_share(count_by_country(users))


def with_share(totals: DataFrame) -> DataFrame:
    grand_total = totals.agg(F.sum("total")).scalar()
    return totals.withColumn("share", F.round(F.col("total") / grand_total, 6))


def distinct_countries(users: DataFrame) -> DataFrame:
    """The countries a map can show; users without one cannot be placed."""
    return users.select("country").filter(F.col("country").isNotNull()).distinct()


def match_countries(users: DataFrame, known: DataFrame) -> DataFrame:
    """(country, total, matched): which totals a map that knows the ``known`` countries can place.

    Counts come first, so the join sees one row per country. Spark broadcasts ``known`` if its size is
    under the session's threshold and sorts and merges otherwise.
    """
    return with_match(count_by_country(users), known)


def with_match(totals: DataFrame, known: DataFrame) -> DataFrame:
    names = known.select(F.col("country").alias("_known")).distinct()
    return totals.join(names, totals["country"] == names["_known"], "left").select(
        "country", "total", F.col("_known").isNotNull().alias("matched")
    )


def top_countries(users: DataFrame, k: int) -> DataFrame:
    """The k largest countries; ties go to the alphabetically first."""
    return count_by_country(users).orderBy(F.desc("total"), F.asc_nulls_last("country")).limit(k)
