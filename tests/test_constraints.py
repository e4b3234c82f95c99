import datetime

import pytest
from helpers import event
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollcall.functions import naive_timestamp, registration_year
from rollcall.operators.constraints import check_rows, check_table, storable, violators
from rollcall.operators.latest import latest_per_key, upsert
from rollcall.schemas import EVENT, EVENT_FIELDS
from rollcall.workspace import new_folder


def test_not_null_and_dates(spark):
    rows = [event(), event(phone=None, gender=None), event(dob="soon"), event(dob=None)]
    checked = check_rows(spark.createDataFrame(rows, EVENT))
    assert [row.violation for row in checked.collect()] == [None, "null:gender,phone", "date:dob", "null:dob"]
    assert storable(checked).count() + violators(checked).count() == len(rows)
    row = storable(checked).first()
    assert row.dob == datetime.datetime(1980, 2, 3, 4, 5, 6, 789000)
    assert row.registered_date == datetime.datetime(2007, 12, 31, 23, 30)


@pytest.mark.parametrize("ansi", ["true", "false"])
@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_dates_do_not_depend_on_the_session(spark, ansi, zone):
    cases = {
        "2007-12-31T23:30:00.000-05:00": (2007, datetime.datetime(2007, 12, 31, 23, 30)),
        "2007-12-31T23:30:00.000Z": (2007, datetime.datetime(2007, 12, 31, 23, 30)),
        "2007": (2007, datetime.datetime(2007, 1, 1)),
        "2007-07": (2007, datetime.datetime(2007, 7, 1)),
        " 2007-01-01 ": (2007, datetime.datetime(2007, 1, 1)),
        "07/09/2007": (None, None),
        "garbage": (None, None),
        "": (None, None),
    }
    before = {name: spark.conf.get(name) for name in ("spark.sql.ansi.enabled", "spark.sql.session.timeZone")}
    try:
        spark.conf.set("spark.sql.ansi.enabled", ansi)
        spark.conf.set("spark.sql.session.timeZone", zone)
        texts = spark.createDataFrame([(text,) for text in cases], "text string")
        rows = texts.select("text", registration_year("text").alias("y"), naive_timestamp("text").alias("t")).collect()
        assert {row.text: (row.y, row.t) for row in rows} == cases
        tail = spark.createDataFrame([("2007-01-01 xyz",)], "text string").select(registration_year("text")).first()
        assert tail[0] == 2007
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def test_rejected_rows_reserve_no_key(spark):
    rows = [
        event(email="a", username="1", phone=None),
        event(email="a", username="1", dob="soon"),
        event(email="a", username="1"),
        event(email="a", username="2"),
        event(email="b", username="2"),
        event(email="c", username="1"),
    ]
    numbered = [row | {"n": n} for n, row in enumerate(rows)]
    events = spark.createDataFrame(numbered, T.StructType([*EVENT.fields, T.StructField("n", T.IntegerType())]))
    checked = check_table(events, "n", new_folder(spark, "test"))
    assert {row.n: row.violation for row in checked.collect()} == {
        0: "null:phone",
        1: "date:dob",
        2: None,
        3: "unique:email,username",
        4: None,
        5: "unique:email,username",
    }


def test_latest_per_key(spark):
    rows = spark.createDataFrame([("a", 1, "x"), ("a", 3, "y"), ("a", 2, "z"), ("b", 1, None)], "k string, n int, v string")
    latest = latest_per_key(rows, "k", "n")
    assert latest.columns == ["k", "n", "v"]
    assert sorted(map(tuple, latest.collect())) == [("a", 3, "y"), ("b", 1, None)]
    changes = spark.createDataFrame([("b", 2, "new"), ("c", 1, "first")], "k string, n int, v string")
    assert sorted(map(tuple, upsert(latest, changes, "k", "n").collect())) == [
        ("a", 3, "y"),
        ("b", 2, "new"),
        ("c", 1, "first"),
    ]


def test_latest_combines_before_the_shuffle(spark):
    rows = spark.range(100).select((F.col("id") % 3).alias("k"), F.col("id").alias("n"))
    from helpers import plan

    assert "partial_max" in plan(latest_per_key(rows, "k", "n"))
    assert "Window" not in plan(latest_per_key(rows, "k", "n"))
    assert len(EVENT_FIELDS) == 14
