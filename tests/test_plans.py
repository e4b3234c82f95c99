"""Plans that must hold at scale."""

import re

import pytest
from helpers import plan
from pyspark.sql import functions as F

from rollcall.plans.catalogue import QUERIES
from rollcall.plans.users import users
from rollcall.operators.charts import match_countries, share_by_country
from rollcall.operators.counts import chart_totals, count_by_country, count_by_gender

BATCH = [name for name in QUERIES if not name.startswith("stream_") and name != "ddl_idempotent"]


@pytest.mark.parametrize("name", BATCH)
def test_no_python_no_cross_join_no_window(spark, tables, name):
    text = plan(QUERIES[name](spark, tables))
    assert not re.search("EvalPython|MapIn", text)
    assert "CartesianProduct" not in text
    assert "BroadcastNestedLoopJoin" not in text
    assert "Window" not in text


def test_counts_combine_before_the_shuffle(spark, tables):
    text = plan(count_by_country(users(spark, tables)))
    assert "partial_count" in text
    assert re.search(r"Arguments: hashpartitioning\((country|n_name)#", text)


def test_chart_totals_scan_the_users_once(spark, tables):
    text = plan(chart_totals(users(spark, tables)))
    # One scan per given table: orders, customer, nation, region.
    assert len(set(re.findall(r"\((\d+)\) Scan parquet", text))) == 4
    # Operators are numbered from the leaves: rows are expanded only after they were counted per combination.
    counted = re.search(r"\((\d+)\) HashAggregate[^(]*\n(?:.*\n)*?Functions \[1\]: \[partial_count\(1\)\]", text)
    expanded = re.search(r"\((\d+)\) Expand", text)
    assert int(counted.group(1)) < int(expanded.group(1))


def test_scans_read_only_what_the_count_needs(spark, tables):
    text = plan(count_by_gender(users(spark, tables)))
    schemas = re.findall(r"ReadSchema: struct<(.*)>", text)
    assert any(set(s.split(",")) == {"o_orderkey:bigint", "o_custkey:bigint"} for s in schemas)
    assert not any("c_name" in s for s in schemas)


def test_large_dimensions_are_not_broadcast(spark, tables):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        known = spark.read.parquet(f"{tables}/nation.parquet").selectExpr("n_name as country")
        matched = match_countries(users(spark, tables), known)
        assert "Broadcast" not in plan(matched)
        assert matched.count() == 25
        shares = share_by_country(users(spark, tables))
        assert "Broadcast" not in plan(shares)
        assert abs(sum(row.share for row in shares.collect()) - 1) < 1e-4
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_a_customer_with_a_third_of_the_orders_is_split(spark, tables, tmp_path):
    """The join behind the users at a size where nothing is broadcast: Spark's skew join splits the hot customer."""
    orders = spark.read.parquet(f"{tables}/orders.parquet")
    many = orders.crossJoin(spark.range(100)).select(
        (F.col("o_orderkey") * 100 + F.col("id")).alias("o_orderkey"),
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("o_custkey")).cast("bigint").alias("o_custkey"),
        "o_orderdate",
    )
    for name in ("customer", "nation", "region"):
        spark.read.parquet(f"{tables}/{name}.parquet").write.parquet(f"{tmp_path}/{name}.parquet")
    many.repartition(8).write.parquet(f"{tmp_path}/orders.parquet")
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
    }
    before = {name: spark.conf.get(name) for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        counted = count_by_country(users(spark, str(tmp_path)))
        assert sum(row.total for row in counted.collect()) == orders.count() * 100
        assert "skewed" in plan(counted)
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
