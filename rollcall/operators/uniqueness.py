"""Two UNIQUE keys, first row wins.

Rows come in an order. A row is accepted if neither of its two keys belongs to a row accepted before it;
a rejected row reserves nothing. So (e1,u1) is accepted, (e1,u2) rejected, and (e2,u2) accepted. Dropping
duplicates key by key gives another answer.

The rule is a greedy matching on the graph whose edges are the rows. It runs in rounds: every row that is
the earliest of both its keys is accepted, the rows that share a key with it leave, and the rest goes into
the next round. Rows whose keys nobody else has are done after one round, and in a mixed order the number of
rounds grows with the logarithm of the rows.

In a chain every row waits for the one before it, and rounds alone would settle one row each. So later rounds also look
at rows with a single earlier rival: such a row is accepted exactly if its rival isn't. Rows of that kind point at their
rivals, and pointers double until they reach a row that is first for both its keys: a chain takes the logarithm
of its length in joins, each between tables of one row per key.
"""

from __future__ import annotations

import logging

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

log = logging.getLogger(__name__)

# A key with this many rows is hot. With more than HOT_ROWS * MAX_HOT_KEYS rows in all, the bound rises to
# rows / MAX_HOT_KEYS, so that there are never more than MAX_HOT_KEYS hot keys.
HOT_ROWS = 1_000_000
MAX_HOT_KEYS = 100_000
# Mixed data is done after few rounds more than this; from then on each round also resolves chains.
CHAINS_AFTER = 4


class RoundLimitError(RuntimeError):
    """The rounds did not finish within ``max_rounds``; there is no partial answer."""


def first_wins(rows: DataFrame, first_key: str, second_key: str, order: str, workdir: str, **options) -> DataFrame:
    """The rows accepted under UNIQUE(first_key) and UNIQUE(second_key); see `winners` for the arguments."""
    won = winners(rows, first_key, second_key, order, workdir, **options)
    return rows.join(won, order, "left_semi")


def winners(
    rows: DataFrame,
    first_key: str,
    second_key: str,
    order: str,
    workdir: str,
    *,
    taken: DataFrame | None = None,
    max_rounds: int | None = None,
    hot_rows: int = HOT_ROWS,
    max_hot_keys: int = MAX_HOT_KEYS,
    chains_after: int | None = CHAINS_AFTER,
) -> DataFrame:
    """The ``order`` values of the accepted rows, as a table in ``workdir``.

    ``order`` must be unique per row. A row with a NULL key is never accepted. ``taken`` holds rows accepted
    earlier under the same two constraints, whose keys are gone. ``workdir`` is a fresh folder every executor
    reaches, needed until the result has been read: each round starts from tables written there, so a lost
    executor costs one round's work at most and the plan never grows.
    """
    narrow = rows.select(first_key, second_key, order).dropna(subset=[first_key, second_key])
    # Of rows with the same two keys only the earliest can win. Copies fold before the shuffle.
    edges = narrow.groupBy(first_key, second_key).agg(F.min(order).alias(order))
    rest = _Remainder(rows.sparkSession, workdir)
    left = rest.replace(edges)

    hot = {}
    if left >= hot_rows:
        bound = max(hot_rows, -(-left // max_hot_keys))
        hot = {key: _hot_keys(rest, key, bound) for key in (first_key, second_key)}
    if taken is not None:
        gone = {key: _taken_keys(rest.rows, taken, key) for key in (first_key, second_key)}
        left = rest.replace(_without_taken(rest.rows, gone, order, hot))

    rest.written(rows.sparkSession.createDataFrame([], edges.schema), "accepted/step=0")
    steps = 0

    def settle(chosen: DataFrame) -> int:
        """Accept the chosen rows; what remains are the rows that share no key with them."""
        nonlocal steps
        steps += 1
        won = rest.written(chosen, f"accepted/step={steps}")
        gone = {key: won.select(key) for key in (first_key, second_key)}
        return rest.replace(_without_taken(rest.rows, gone, order, hot))

    rounds = 0
    while left:
        rounds += 1
        log.info("round %d: %d rows undecided", rounds, left)
        if max_rounds is not None and rounds > max_rounds:
            raise RoundLimitError(f"{left} rows undecided after {max_rounds} rounds")
        chains = chains_after is not None and rounds > chains_after
        choose = _with_chains if chains else _earliest_of_both
        left = settle(choose(rest, first_key, second_key, order))
    return rows.sparkSession.read.schema(edges.schema).parquet(f"{workdir}/accepted").select(order)


class _Remainder:
    """The undecided rows as a table: written to one of two folders in turn, read from the other."""

    def __init__(self, spark: SparkSession, workdir: str):
        self._spark = spark
        self._workdir = workdir
        self._turn = 0

    def replace(self, rows: DataFrame) -> int:
        self._turn += 1
        self.rows = self.written(rows, f"rest-{self._turn % 2}")
        return self.rows.count()

    def written(self, rows: DataFrame, name: str) -> DataFrame:
        path = f"{self._workdir}/{name}"
        rows.write.mode("overwrite").parquet(path)
        return self._spark.read.schema(rows.schema).parquet(path)


def _earliest_of_both(rest: _Remainder, first_key: str, second_key: str, order: str) -> DataFrame:
    """The rows that come first for both their keys. Both sides hold one row per key, so no key is hot."""
    rows = rest.rows
    per_first = rows.groupBy(first_key).agg(F.min(order).alias(order))
    per_second = rows.groupBy(second_key).agg(F.min(order).alias(order))
    return per_first.join(per_second, order).select(first_key, second_key, order)


def _hot_keys(rest: _Remainder, key: str, bound: int) -> DataFrame | None:
    """The keys with at least ``bound`` rows: at most rows / bound of them, hence safe to broadcast."""
    counted = rest.rows.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    hot = rest.written(counted.filter(F.col("n") >= bound).select(key), f"hot-{key}")
    return None if hot.isEmpty() else hot


def _taken_keys(rows: DataFrame, taken: DataFrame, key: str) -> DataFrame:
    """The taken keys that ``rows`` use. ``taken`` is the whole table so far and ``rows`` one batch: when the
    batch's keys are few enough to broadcast, the table is scanned for this column and not shuffled.
    """
    return taken.select(key).join(rows.select(key).distinct(), key, "left_semi")


def _without_taken(rows: DataFrame, taken: dict[str, DataFrame], order: str, hot: dict) -> DataFrame:
    for key, gone in taken.items():
        rows = _without_taken_key(rows, gone, key, order, hot.get(key))
    return rows


def _without_taken_key(rows: DataFrame, taken: DataFrame, key: str, order: str, hot: DataFrame | None) -> DataFrame:
    """The rows whose ``key`` is not taken.

    Rows of hot keys are settled against the broadcast list of hot keys: where the key is taken they
    leave, otherwise they get a salt that spreads them over all tasks and matches nothing. The shuffled
    join then only has to place keys of bounded size.
    """
    if hot is None:
        return rows.join(taken, key, "left_anti")
    hot_taken = taken.join(F.broadcast(hot), key, "left_semi").distinct()
    unsalted = F.lit(0).cast("bigint")
    salt = F.when(F.col("_hot"), F.xxhash64(order)).otherwise(unsalted)

    def place(salt: Column) -> Column:
        # One column: as two, the optimizer folds the constant and shuffles on the key alone.
        return F.struct(F.col(key), salt.alias("salt")).alias("_place")

    spread = (
        rows.join(F.broadcast(hot_taken), key, "left_anti")
        .join(F.broadcast(hot.withColumn("_hot", F.lit(True))), key, "left")
        .select(*rows.columns, place(salt))
    )
    return spread.join(taken.select(place(unsalted)), "_place", "left_anti").select(rows.columns)


def _with_chains(rest: _Remainder, first_key: str, second_key: str, order: str) -> DataFrame:
    """The rows that come first for both their keys, and what follows from them along chains."""
    firsts, pointers = {}, []
    for key in (first_key, second_key):
        earliest = rest.rows.groupBy(key).agg(F.min(order).alias("rival"))
        firsts[key] = rest.written(earliest, f"first-{key}")
        # The second of a key: without its first, found by its unique order and not by the key, which may be hot.
        later = rest.rows.join(firsts[key].select(F.col("rival").alias(order)), order, "left_anti")
        second = later.groupBy(key).agg(F.min(order).alias("row")).join(firsts[key], key)
        pointers.append(second.select("row", "rival"))
    first = {key: firsts[key].select(F.col("rival").alias("row")) for key in firsts}
    roots = rest.written(first[first_key].join(first[second_key], "row"), "roots")
    # Second for one key and first for the other: one earlier rival in all.
    single = pointers[0].join(first[second_key], "row").unionByName(pointers[1].join(first[first_key], "row"))
    known = _resolved(rest, single, roots)
    chosen = roots.unionByName(known.filter(F.col("steps") % 2 == 0).select("row"))
    return rest.rows.join(chosen.select(F.col("row").alias(order)), order, "left_semi")


def _resolved(rest: _Remainder, single: DataFrame, roots: DataFrame) -> DataFrame:
    """The rows whose pointers lead to a root: row, and the number of steps to it. Each join doubles the steps."""
    jumps = rest.written(single.select("row", F.col("rival").alias("at"), F.lit(1).cast("long").alias("steps")), "jumps-0")
    turn = 0
    while True:
        turn += 1
        further = jumps.select(F.col("row").alias("at"), F.col("at").alias("next"), F.col("steps").alias("more"))
        moved = jumps.join(further, "at", "left").select(
            "row",
            F.coalesce("next", "at").alias("at"),
            (F.col("steps") + F.coalesce("more", F.lit(0))).alias("steps"),
            F.col("next").isNotNull().alias("moved"),
        )
        moved = rest.written(moved, f"jumps-{turn % 2}")
        jumps = moved.drop("moved")
        if moved.filter("moved").isEmpty():
            return jumps.join(roots.select(F.col("row").alias("at")), "at", "left_semi")
