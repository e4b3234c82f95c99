"""Identifiers that survive a replay."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from rollcall.schemas import POSITION_FIELDS


def stable_id(*parts: str | Column) -> Column:
    """UUID-shaped text made from ``parts``.

    The same parts give the same id on every evaluation, retry and restart, so a keyed store sees a replay
    as the same row. It is a hash laid out 8-4-4-4-12, not an RFC 4122 version 4 value.
    """
    digest = F.md5(F.concat_ws("/", *parts).cast("binary"))
    groups = ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))
    return F.concat_ws("-", *(F.substring(digest, start, length) for start, length in groups))


def position_id() -> Column:
    """The id of a message: a record the producer sent twice has two positions and therefore two ids."""
    return stable_id(*POSITION_FIELDS)
