from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def street_address(number: Column, name: Column) -> Column:
    """``number name``; NULL if either part is missing, so that the NOT NULL check sees it."""
    return F.concat(number.cast("string"), F.lit(" "), name)
