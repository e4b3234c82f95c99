import json
import os

from helpers import event, messages, response

from rollcall.__main__ import main
from rollcall.operators.codec import parse_messages, records
from rollcall.operators.counts import count_by_country
from rollcall.plans.catalogue import QUERIES
from rollcall.plans.dashboard import dashboard
from rollcall.plans.users import users
from rollcall.workspace import new_folder


def test_stream_then_dashboard(spark, tmp_path):
    place = str(tmp_path)
    values = [event(country=f"c{i % 2}", email=str(i)) for i in range(7)] + ["{bad"]
    messages(spark, values).write.parquet(f"{place}/topic")
    main(["stream", "--source", f"{place}/topic", "--out", f"{place}/stream"], spark)
    main(["dashboard", "--option", f"path={place}/stream/users", "--out", f"{place}/figures"], spark)
    counted = spark.read.parquet(f"{place}/figures/count_by_country").collect()
    assert {row.country: row.total for row in counted} == {"c0": 4, "c1": 3}
    assert spark.read.parquet(f"{place}/stream/unreadable").count() == 1


def test_stream_to_a_connector(spark, tmp_path):
    place = str(tmp_path)
    messages(spark, [event()]).write.parquet(f"{place}/topic")
    arguments = ["--format", "json", "--option", f"path={place}/store", "--out", f"{place}/stream"]
    main(["stream", "--source", f"{place}/topic", *arguments], spark)
    assert spark.read.json(f"{place}/store").count() == 1


def test_ingest(spark, tmp_path):
    place = str(tmp_path)
    (tmp_path / "landing").mkdir()
    for i in range(3):
        (tmp_path / "landing" / f"{i}.json").write_text(json.dumps(response(email=f"{i}@example.com")))
    arguments = ["--format", "parquet", "--option", f"path={place}/topic", "--out", f"{place}/ingest"]
    main(["ingest", "--landing", f"{place}/landing", *arguments], spark)
    # One user name, so one row; all three are published.
    assert spark.read.parquet(f"{place}/ingest/users").count() == 1
    published = records(parse_messages(spark.read.parquet(f"{place}/topic"), keep=()), keep=())
    assert published.count() == 3


def test_ingest_in_bounded_batches(spark, tmp_path):
    place = str(tmp_path)
    (tmp_path / "landing").mkdir()
    for i in range(12):
        (tmp_path / "landing" / f"{i}.json").write_text(json.dumps(response(email=f"{i}@example.com", login={"username": str(i)})))
    arguments = ["--format", "parquet", "--option", f"path={place}/topic", "--max-per-trigger", "4"]
    arguments += ["--table-format", "json", "--table-option", f"path={place}/store"]
    main(["ingest", "--landing", f"{place}/landing", "--out", f"{place}/files", *arguments], spark)
    batches = [name for name in os.listdir(f"{place}/files/users") if name.startswith("batch_id=") and name != "batch_id=-1"]
    assert len(batches) == 3
    assert spark.read.parquet(f"{place}/files/users").count() == spark.read.json(f"{place}/store").count() == 12
    # No folder of a batch's work is left.
    assert not [d for d, _, names in os.walk(spark.conf.get("spark.checkpoint.dir")) if "/ingest-" in d and names]
    texts = [(json.dumps(response(email=f"t{i}", login={"username": f"t{i}"})),) for i in range(6)]
    spark.createDataFrame(texts, "response string").repartition(6).write.parquet(f"{place}/rows")
    arguments = ["--format", "parquet", "--option", f"path={place}/topic-2", "--max-per-trigger", "2"]
    files = len([name for name in os.listdir(f"{place}/rows") if name.endswith(".parquet")])
    main(["ingest", "--landing-table", f"{place}/rows", "--out", f"{place}/table", *arguments], spark)
    batches = [name for name in os.listdir(f"{place}/table/users") if name.startswith("batch_id=") and name != "batch_id=-1"]
    assert len(batches) == -(-files // 2)


def test_counts_and_resent(spark, tmp_path):
    place = str(tmp_path)
    messages(spark, [event(country=f"c{i % 2}", email=str(i % 3)) for i in range(7)]).write.parquet(f"{place}/topic")
    main(["counts", "--source", f"{place}/topic", "--out", f"{place}/counts"], spark)
    totals = spark.read.parquet(f"{place}/counts/totals").filter("dim = 'country'").collect()
    assert {row.k: row.total for row in totals} == {"c0": 4, "c1": 3}
    main(["resent", "--source", f"{place}/topic", "--out", f"{place}/resent", "--within", "5"], spark)
    assert spark.read.parquet(f"{place}/resent/kept").count() <= 3


def test_dashboard_with_known_countries_and_a_namespace(spark, tmp_path):
    place = str(tmp_path)
    messages(spark, [event(country=f"c{i % 2}", email=str(i)) for i in range(7)]).write.parquet(f"{place}/topic")
    main(["stream", "--source", f"{place}/topic", "--out", f"{place}/stream", "--namespace", "people"], spark)
    assert spark.table("people.users").count() == 7
    assert sorted(r.email for r in spark.table("people.users").collect()) == [str(i) for i in range(7)]
    spark.sql("drop database people cascade")
    spark.createDataFrame([("c1",)], "country string").write.parquet(f"{place}/known")
    arguments = ["--known", f"{place}/known", "--top", "1"]
    main(["dashboard", "--option", f"path={place}/stream/users", "--out", f"{place}/figures", *arguments], spark)
    assert {r.country: r.matched for r in spark.read.parquet(f"{place}/figures/country_match").collect()} == {"c0": False, "c1": True}
    assert [r.country for r in spark.read.parquet(f"{place}/figures/top_countries").collect()] == ["c0"]


def test_dashboard_equals_the_single_counts(spark, tables):
    everyone = users(spark, tables)
    known = spark.read.parquet(f"{tables}/nation.parquet").selectExpr("n_name as country").limit(3)
    frames = dashboard(everyone, new_folder(spark, "test"), known)
    assert sorted(map(str, frames["count_by_country"].collect())) == sorted(map(str, count_by_country(everyone).collect()))
    for name in ("count_by_gender", "count_by_year", "share_by_country"):
        assert sorted(map(str, frames[name].collect())) == sorted(map(str, QUERIES[name](spark, tables).collect()))
    assert frames["countries"].count() == 25
    assert frames["country_match"].filter("matched").count() == 3
