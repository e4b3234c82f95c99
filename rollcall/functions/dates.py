"""Dates that arrive as text. Unreadable text gives NULL in ANSI mode and outside it."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def naive_timestamp(text: Column | str) -> Column:
    """ISO text as a timestamp without time zone: the wall clock stands, an offset is ignored."""
    return _column(text).try_cast("timestamp_ntz")


def registration_year(text: Column | str) -> Column:
    """Year of the text's date part. No zone shift: late on 31 December stays in the old year."""
    return F.year(_column(text).try_cast("date"))


def _column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value
