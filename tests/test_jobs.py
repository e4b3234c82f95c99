"""Counts and metrics per batch, streams bound by time, and fetched responses."""

from __future__ import annotations

import json
import os
import time

import pytest
from helpers import event, messages, response
from pyspark.errors import StreamingQueryException

from rollcall.__main__ import main
from rollcall.operators.counts import chart_totals, totals_from_joint
from rollcall.schemas import STORED
from rollcall.sinks.batches import BatchTable
from rollcall.sources.fetched import Landing, fetched_responses
from rollcall.sources.messages import file_messages
from rollcall.sources.tables import load_users
from rollcall.streaming import jobs
from rollcall.streaming.limits import run_for, seconds
from rollcall.streaming.tables import COUNTS, METRICS, UNREADABLE


def publish(spark, path, values, start=0):
    messages(spark, values, start).coalesce(1).write.mode("append").parquet(path)


def lose_last_commit(checkpoint):
    commits = os.path.join(checkpoint, "commits")
    last = max(int(name) for name in os.listdir(commits) if name.isdigit())
    for name in (str(last), f".{last}.crc"):
        if os.path.exists(path := os.path.join(commits, name)):
            os.unlink(path)


def test_counts_and_metrics_are_those_of_the_tables_after_a_replay(spark, tmp_path):
    place = str(tmp_path)
    for part in range(3):
        values = [event(email=f"{part}-{i}", country=f"c{i % 2}", gender=None if i == part else "f") for i in range(5)]
        publish(spark, f"{place}/topic", [*values, "{bad", event(registered_date="never"), None][: 8 - part], part * 8)
    tables = {name: BatchTable(spark, f"{place}/{name}", schema) for name, schema in (("users", STORED), ("bad", UNREADABLE), ("counts", COUNTS), ("metrics", METRICS))}

    def run():
        stream = file_messages(spark, f"{place}/topic", max_per_trigger=1)
        jobs.store_messages(
            stream, tables["users"].replace, tables["bad"].replace, f"{place}/checkpoint", counts=tables["counts"], metrics=tables["metrics"]
        ).awaitTermination()

    run()
    for _ in range(2):
        by_batch = {r.batch_id: (r.messages, r.unreadable) for r in tables["metrics"].read().collect()}
        bad = {r.batch_id: r["count"] for r in tables["bad"].read().groupBy("batch_id").count().collect()}
        good = {r.batch_id: r["count"] for r in tables["users"].read().groupBy("batch_id").count().collect()}
        assert len(by_batch) == 3
        assert by_batch == {b: (good[b] + bad.get(b, 0), bad.get(b, 0)) for b in good}
        assert sorted(map(str, totals_from_joint(tables["counts"].rows()).collect())) == sorted(map(str, chart_totals(tables["users"].rows()).collect()))
        lose_last_commit(f"{place}/checkpoint")
        run()


def test_a_dashboard_from_counts_opens_no_user_file(spark, tmp_path):
    place = str(tmp_path)
    publish(spark, f"{place}/topic", [event(country=f"c{i % 3}", gender="mf"[i % 2], email=str(i)) for i in range(11)] + ["{bad"])
    main(["stream", "--source", f"{place}/topic", "--out", f"{place}/stream"], spark)
    main(["dashboard", "--option", f"path={place}/stream/users", "--out", f"{place}/full", "--top", "2"], spark)
    os.rename(f"{place}/stream/users", f"{place}/gone")
    main(["dashboard", "--counts", f"{place}/stream/counts", "--out", f"{place}/quick", "--top", "2"], spark)
    names = sorted(os.listdir(f"{place}/full"))
    assert names == sorted(os.listdir(f"{place}/quick")) and len(names) == 6
    for name in names:
        assert sorted(map(str, spark.read.parquet(f"{place}/quick/{name}").collect())) == sorted(map(str, spark.read.parquet(f"{place}/full/{name}").collect()))
    assert load_users(spark, path=f"{place}/stream/metrics").collect()[0].asDict() == {"messages": 12, "unreadable": 1}


# ---- bound by time


@pytest.mark.parametrize(("interval", "expected"), [("60 seconds", 60), ("1 hour 30 minutes", 5400), ("500 milliseconds", 0.5)])
def test_intervals(spark, interval, expected):
    assert seconds(spark, interval) == expected


def test_a_query_stops_between_batches_and_a_second_run_goes_on(spark, tmp_path):
    place = str(tmp_path)
    for part in range(12):
        publish(spark, f"{place}/topic", [event(email=f"{part}-{i}") for i in range(3)], part * 3)
    seen = []

    def slow(rows, batch_id):
        seen.append(("begin", batch_id))
        assert rows.count() == 3
        time.sleep(0.7)
        seen.append(("end", batch_id))

    def start(limit, **trigger):
        stream = file_messages(spark, f"{place}/topic", max_per_trigger=1)
        return run_for(jobs.start(stream, slow, f"{place}/checkpoint", trigger={**trigger, "limit": limit}), limit)

    assert start(2.0, processingTime="0 seconds")
    first = [batch for step, batch in seen if step == "end"]
    assert 0 < len(first) < 12
    assert [batch for step, batch in seen if step == "begin"] == first
    assert start(1.0, availableNow=True)
    assert not start(60, availableNow=True)
    done = [batch for step, batch in seen if step == "end"]
    assert done == [batch for step, batch in seen if step == "begin"] == list(range(12))
    assert start(1.0, processingTime="0 seconds")  # without data it is stopped while it waits


def test_other_errors_are_raised(spark, tmp_path):
    publish(spark, f"{tmp_path}/topic", [event()])

    def broken(rows, batch_id):
        raise ValueError("broken")

    query = jobs.start(file_messages(spark, f"{tmp_path}/topic"), broken, f"{tmp_path}/checkpoint", trigger={"availableNow": True, "limit": 60})
    with pytest.raises(StreamingQueryException, match="broken"):
        run_for(query, 60)


def test_a_bounded_run_of_the_command(spark, tmp_path):
    place = str(tmp_path)
    publish(spark, f"{place}/topic", [event(email=str(i)) for i in range(4)])
    command = ["stream", "--source", f"{place}/topic", "--out", f"{place}/out", "--every", "1 second", "--for", "4 seconds"]
    main(command, spark)
    publish(spark, f"{place}/topic", [event(email="late")], 4)
    main(command, spark)
    assert sorted(r.email for r in load_users(spark, path=f"{place}/out/users").collect()) == ["0", "1", "2", "3", "late"]


# ---- fetched responses


FOLDER = "rollcall.sources.fetched:folder"


def arrive(folder, *numbers):
    os.makedirs(folder, exist_ok=True)
    for n in numbers:
        with open(f"{folder}/{n:03d}.json", "w") as file:
            file.write(json.dumps(response(email=f"{n}@example.com", login={"username": str(n)})))


def test_each_response_is_read_once_whatever_is_lost(spark, tmp_path):
    place = str(tmp_path)
    arrive(f"{place}/api", *range(5))
    table = BatchTable(spark, f"{place}/t", "id string, response string")

    def run():
        stream = fetched_responses(spark, FOLDER, f"{place}/landing", **{"fetch.path": f"{place}/api", "perBatch": "3", "perTask": "2"})
        jobs.start(stream.select("id", "response"), table.replace, f"{place}/checkpoint").awaitTermination()
        rows = table.rows().collect()
        assert len({r.id for r in rows}) == len(rows)
        return sorted(json.loads(r.response)["results"][0]["email"] for r in rows)

    def emails(count):
        return sorted(f"{n}@example.com" for n in range(count))

    found = run()
    while len(found) < 5:  # a run takes what one fetch of three has landed, or more
        found = run()
    assert found == emails(5)
    lose_last_commit(f"{place}/checkpoint")  # killed between the batch and its commit
    assert run() == emails(5)
    arrive(f"{place}/api", 5, 6)
    Landing(f"{place}/landing").land(5, open(f"{place}/api/005.json").read())  # killed between landing and planning
    with open(f"{place}/landing/{6:012d}.json", "w") as torn:  # killed while landing
        torn.write('{"fetched": 1, "resp')
    while len(found) < 7:
        found = run()
    assert found == emails(7)
    assert Landing(f"{place}/landing").count() == 7


def test_fetched_responses_are_ingested(spark, tmp_path):
    place = str(tmp_path)
    arrive(f"{place}/api", *range(4))
    command = ["ingest", "--fetch", FOLDER, "--source-option", f"fetch.path={place}/api", "--format", "parquet", "--option", f"path={place}/topic", "--out", f"{place}/out"]
    main(command, spark)
    main(command, spark)
    stored = load_users(spark, path=f"{place}/out/users").collect()
    assert sorted(r.email for r in stored) == [f"{n}@example.com" for n in range(4)]
    assert spark.read.parquet(f"{place}/topic").count() == 4
    rows = load_users(spark, path=f"{place}/out/metrics").collect()
    assert sum(r.events for r in rows) == 4 and sum(r.unique for r in rows) == 0
