"""Everything a dashboard shows, from one scan of the stored users."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.operators import charts
from rollcall.operators.counts import joint_counts


def dashboard(users: DataFrame, workdir: str, known: DataFrame | None = None, top: int | None = None) -> dict[str, DataFrame]:
    """The data set of each figure. Adding up counts gives the same totals as counting the users again.

    The users are counted once per (country, gender, year) into a small table; each figure adds that up.
    """
    joint_counts(users).write.mode("overwrite").parquet(workdir)
    return figures(users.sparkSession.read.parquet(workdir), known, top)


def figures(joint: DataFrame, known: DataFrame | None = None, top: int | None = None) -> dict[str, DataFrame]:
    """The data sets from counts per (country, gender, year), in one table or in parts, as a stream writes them with every
    batch: no user is read."""
    by_country = _add_up(joint, "country")
    frames = {
        "count_by_country": by_country,
        "count_by_gender": _add_up(joint, "gender"),
        "count_by_year": _add_up(joint, "registration_year").orderBy(F.asc_nulls_last("registration_year")),
        "share_by_country": charts.with_share(by_country),
        "countries": charts.distinct_countries(joint),
    }
    if known is not None:
        frames["country_match"] = charts.with_match(by_country, known)
    if top:
        frames["top_countries"] = by_country.orderBy(F.desc("total"), F.asc_nulls_last("country")).limit(top)
    return frames


def _add_up(joint: DataFrame, column: str) -> DataFrame:
    return joint.groupBy(column).agg(F.sum("total").alias("total"))
