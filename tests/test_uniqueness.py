import random

import pytest
from helpers import sequential
from pyspark.sql import functions as F

from rollcall.operators.uniqueness import RoundLimitError, _without_taken_key, first_wins
from rollcall.workspace import new_folder

SCHEMA = "n long, email string, username string"


def _run(spark, rows, taken=None, **options):
    df = spark.createDataFrame(rows, SCHEMA)
    if taken is not None:
        options["taken"] = spark.createDataFrame(taken, "email string, username string")
    won = first_wins(df, "email", "username", "n", new_folder(spark, "test"), **options)
    assert won.columns == df.columns or set(won.columns) == set(df.columns)
    return sorted(row.n for row in won.collect())


def _trials(seed, trials=300):
    """Many random tables in one: each has its own keys, so they do not meet."""
    rnd = random.Random(seed)
    rows = []
    for trial in range(trials):
        size, keys = rnd.randint(1, 14), rnd.randint(1, 6)
        for _ in range(size):
            rows.append((f"{trial}-e{rnd.randint(1, keys)}", f"{trial}-u{rnd.randint(1, keys)}"))
    rnd.shuffle(rows)
    return [(n, first, second) for n, (first, second) in enumerate(rows)]


def _chain(length):
    """e0-u0, e1-u0, e1-u1, e2-u1, ...: each row waits for the one before it."""
    return [(n, f"e{(n + 1) // 2}", f"u{n // 2}") for n in range(length)]


def test_rejected_row_reserves_nothing(spark):
    assert _run(spark, [(1, "e1", "u1"), (2, "e1", "u2"), (3, "e2", "u2")]) == [1, 3]


@pytest.mark.parametrize("seed", range(3))
def test_equals_the_sequential_rule(spark, seed):
    rows = _trials(seed)
    assert _run(spark, rows, chains_after=None) == sequential(rows)
    assert _run(spark, rows, chains_after=0) == sequential(rows)


def test_hot_keys_are_spread_and_the_result_is_the_same(spark):
    rnd = random.Random(7)
    # A third of the rows shares one e-mail, another third one user name.
    rows = []
    for n in range(600):
        hot = n % 3
        email = "hot" if hot == 0 else f"e{rnd.randint(1, 80)}"
        username = "hot" if hot == 1 else f"u{rnd.randint(1, 80)}"
        rows.append((n, email, username))
    assert _run(spark, rows, hot_rows=20) == sequential(rows)
    assert _run(spark, _trials(11), hot_rows=2) == sequential(_trials(11))


def test_keys_taken_earlier(spark):
    rows = _trials(5, trials=60)
    taken = [(first, second) for _, first, second in rows[::9]]
    assert _run(spark, rows, taken=taken) == sequential(rows, taken)
    assert _run(spark, rows, taken=taken, hot_rows=2) == sequential(rows, taken)


@pytest.mark.parametrize("length", [200, 3000])
def test_chains_take_one_round(spark, length):
    rows = _chain(length)
    expected = sequential(rows)
    assert len(expected) == length // 2
    # By rounds alone it takes one for each accepted row.
    assert _run(spark, rows, chains_after=0, max_rounds=1) == expected


def test_chains_with_branches_equal_the_sequential_rule(spark):
    rnd = random.Random(9)
    rows = _chain(120) + [(1000 + n, f"e{rnd.randint(0, 70)}", f"u{rnd.randint(0, 70)}") for n in range(120)]
    order = list(range(len(rows)))
    rnd.shuffle(order)
    for given in (rows, [(n, first, second) for n, (_, first, second) in zip(order, rows)]):
        assert _run(spark, given, chains_after=1) == sequential(given)
        assert _run(spark, given, chains_after=1, hot_rows=3) == sequential(given)


def test_round_limit_raises_instead_of_answering_in_part(spark):
    with pytest.raises(RoundLimitError):
        _run(spark, _chain(40), max_rounds=3, chains_after=None)


def test_empty_and_null_keys(spark):
    assert _run(spark, []) == []
    assert _run(spark, [(1, None, "u"), (2, "e", None), (3, "e", "u")]) == [3]


def test_struct_order(spark):
    given = [(1, 0, "a", "x"), (0, 5, "a", "y"), (0, 6, "b", "x")]
    rows = spark.createDataFrame(given, "p int, o int, email string, username string")
    ordered = rows.selectExpr("struct(p, o) as at", "email", "username")
    won = first_wins(ordered, "email", "username", "at", new_folder(spark, "test"), chains_after=0)
    assert sorted((row.at.p, row.at.o) for row in won.collect()) == [(0, 5), (0, 6)]
    won = first_wins(ordered, "email", "username", "at", new_folder(spark, "test"))
    assert sorted((row.at.p, row.at.o) for row in won.collect()) == [(0, 5), (0, 6)]


def test_rows_of_a_hot_key_are_shuffled_apart(spark):
    """A third of the rows has one key that is not taken: no task of the join may get them all."""
    rows = spark.range(30_000).select(
        F.col("id").alias("n"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("e"), F.col("id"))).alias("email"),
    )
    hot = spark.createDataFrame([("hot",)], "email string")
    taken = spark.createDataFrame([("e1",)], "email string")
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {name: spark.conf.get(name) for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        kept = _without_taken_key(rows, taken, "email", "n", hot)
        sizes = [row["count"] for row in kept.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    assert sum(sizes) == 29_999
    assert len(sizes) == 4 and max(sizes) < 1.2 * min(sizes)
