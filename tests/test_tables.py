"""Batch tables under replays, crashes and merges; the index of taken keys; stores without keys."""

from __future__ import annotations

import os
import random
import threading

import pytest
from helpers import event, messages, sequential
from pyspark.sql import functions as F

from rollcall.functions import position_id
from rollcall.operators.codec import parse_messages, records
from rollcall.schemas import CONSTRAINED, EVENT
from rollcall.sinks import batches
from rollcall.sinks.batches import BatchTable
from rollcall.sinks.ddl import create_if_absent
from rollcall.sinks.keys import KeyIndex
from rollcall.sinks.log import Conflict, Log
from rollcall.sinks.stores import once_store
from rollcall.sources.messages import file_messages
from rollcall.sources.tables import load_users
from rollcall.streaming import jobs
from rollcall.streaming.tables import REJECTED


class Crash(RuntimeError):
    pass


def numbers(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "x long").coalesce(1)


def held(table):
    return sorted(r.x for r in table.rows().collect())


# ---- the log


def test_a_torn_version_counts_for_nothing(spark, tmp_path):
    log = Log(spark, str(tmp_path / "log"))
    assert log.read() is None
    log.commit(lambda state, number: {"n": number})
    log.commit(lambda state, number: {"n": number})
    with open(log._file(3), "w") as torn:
        torn.write('{"n": 3')
    assert log.read() == {"n": 2}
    log.commit(lambda state, number: {"n": number, "before": state["n"]})
    assert log.read() == {"n": 4, "before": 2}
    assert log.commit(lambda state, number: None) == {"n": 4, "before": 2}


def test_of_two_writers_one_looks_again(spark, tmp_path):
    log = Log(spark, str(tmp_path / "log"))
    seen = []

    def slow(state, number):
        seen.append(state)
        if len(seen) == 1:
            log.commit(lambda state, number: {"by": ["fast"]})
        return {"by": [*(state or {"by": []})["by"], "slow"]}

    assert log.commit(slow) == {"by": ["fast", "slow"]}
    assert seen == [None, {"by": ["fast"]}]

    def always_late(state, number):
        with open(log._file(number), "w") as other:
            other.write("{}")
        return {}

    with pytest.raises(Conflict):
        log.commit(always_late, attempts=3)


def test_old_versions_go(spark, tmp_path):
    log = Log(spark, str(tmp_path / "log"))
    for _ in range(Log.KEPT + 15):
        log.commit(lambda state, number: {"n": number})
    assert len([name for name in os.listdir(log.path) if name.endswith(".json")]) <= Log.KEPT + 1
    assert log.read() == {"n": Log.KEPT + 15}


# ---- commits of batches


def test_a_reader_beside_replays_sees_each_batch_once(spark, tmp_path):
    table = BatchTable(spark, str(tmp_path / "t"), "x long")
    for batch in range(3):
        table.replace(numbers(spark, batch), batch)
    seen, stop = [], threading.Event()

    def read():
        while not stop.is_set():
            try:
                seen.append(held(table))
            except Exception as error:  # shown by the assertion below
                seen.append(error)

    reader = threading.Thread(target=read)
    reader.start()
    try:
        for _ in range(8):
            table.replace(numbers(spark, 2), 2)
    finally:
        stop.set()
        reader.join()
    assert len(seen) > 3
    assert all(rows == [0, 1, 2] for rows in seen), seen


@pytest.mark.parametrize("step", ["write", "commit", "torn", "clean"])
def test_a_crash_at_any_step_leaves_a_whole_version(spark, tmp_path, monkeypatch, step):
    table = BatchTable(spark, str(tmp_path / "t"), "x long")
    table.replace(numbers(spark, 0), 0)
    table.replace(numbers(spark, 1), 1)

    def crash(*args, **kwargs):
        raise Crash

    rows = numbers(spark, 10, 11)
    with monkeypatch.context() as patch:
        if step == "write":
            rows = numbers(spark, 10, 11).select(F.when(F.col("x") == 11, F.raise_error(F.lit("crash"))).otherwise(F.col("x")).cast("long").alias("x"))
        elif step == "commit":
            patch.setattr("rollcall.sinks.log.create_file", crash)
        elif step == "torn":

            def torn(spark, path, text):
                with open(path, "w") as file:
                    file.write(text[: len(text) // 2])
                raise Crash

            patch.setattr("rollcall.sinks.log.create_file", torn)
        else:
            patch.setattr(batches, "RETAINED", 0)
            patch.setattr("rollcall.sinks.batches.remove_folder", crash)
        with pytest.raises(Exception):
            table.replace(rows, 1)
        assert held(table) == ([0, 10, 11] if step == "clean" else [0, 1])
    table.replace(numbers(spark, 10, 11), 1)
    assert held(table) == [0, 10, 11]
    assert held(BatchTable(spark, table.path, "x long")) == [0, 10, 11]


def test_what_crashes_leave_is_swept(spark, tmp_path, monkeypatch):
    table = BatchTable(spark, str(tmp_path / "t"), "x long")
    table.replace(numbers(spark, 0), 0)
    monkeypatch.setattr("rollcall.sinks.log.create_file", lambda *a: (_ for _ in ()).throw(Crash()))
    with pytest.raises(Crash):
        table.replace(numbers(spark, 5), 1)
    monkeypatch.undo()
    assert table.slices.vacuum() == ["batch_id=1"]
    assert table.slices.vacuum() == []
    assert held(table) == [0]


def test_replaced_folders_go_some_versions_later(spark, tmp_path):
    table = BatchTable(spark, str(tmp_path / "t"), "x long")
    for turn in range(3 * batches.RETAINED):
        table.replace(numbers(spark, turn), 0)
    assert held(table) == [3 * batches.RETAINED - 1]
    kept = [name for name in os.listdir(table.path) if name.startswith("_") and name != "_log"]
    assert len(kept) <= batches.RETAINED + 1


def test_snapshots_keep_the_last_two(spark, tmp_path):
    table = BatchTable(spark, str(tmp_path / "t"), "x long")
    for batch in range(6):
        table.snapshot(numbers(spark, batch), batch)
        assert [r.x for r in table.newest().collect()] == [batch]
    assert held(table) == [4, 5]


# ---- merges


def test_many_batches_leave_few_files(spark, tmp_path):
    table = BatchTable(spark, str(tmp_path / "t"), "x long", merge_every=4)
    for batch in range(200):
        table.replace(numbers(spark, batch), batch)
    live = table.slices.live()
    assert len(live) <= 4 * 4  # under four slices of each of four levels, and the newest
    assert len(table.read().inputFiles()) == len(live)
    assert max(s.level for s in live) == 3
    assert held(table) == list(range(200))
    table.replace(numbers(spark, 1000), 199)
    assert held(table) == [*range(199), 1000]
    assert sorted(r.x for r in table.before(199).collect()) == list(range(199))
    assert len(os.listdir(table.path)) < 60
    with pytest.raises(ValueError, match="merged"):
        table.replace(numbers(spark, 0), 3)
    assert sorted(r.x for r in load_users(spark, path=table.path).collect()) == [*range(199), 1000]


def test_merges_go_on_beside_a_writer(spark, tmp_path):
    """A merge in a thread of its own, as another job would run it; a replay of the newest batch in between."""
    table = BatchTable(spark, str(tmp_path / "t"), "x long", merge_every=None)
    other = BatchTable(spark, table.path, "x long", merge_every=None)
    failed, stop = [], threading.Event()

    def merge():
        while not stop.is_set():
            try:
                other.compact(3)
            except Exception as error:
                failed.append(error)

    for batch in range(4):
        table.replace(numbers(spark, batch), batch)
    merger = threading.Thread(target=merge)
    merger.start()
    try:
        for batch in range(4, 16):
            table.replace(numbers(spark, -1), batch)
            table.replace(numbers(spark, batch), batch)
            assert held(table) == list(range(batch + 1))
    finally:
        stop.set()
        merger.join()
    other.compact(3)
    assert not failed
    assert held(table) == list(range(16))
    assert len(table.slices.live()) < 9


def test_two_merges_of_the_same_slices(spark, tmp_path):
    table = BatchTable(spark, str(tmp_path / "t"), "x long", merge_every=None)
    for batch in range(5):
        table.replace(numbers(spark, batch), batch)

    def combine(sources, target):
        spark.read.schema("x long").parquet(*sources).write.parquet(target)
        table.compact(4)  # faster

    table.slices.merge(combine, 4)
    assert held(table) == list(range(5))
    assert table.slices.vacuum() == []


# ---- the catalog's table


def test_the_catalogs_table_follows(spark, tmp_path):
    place = str(tmp_path)
    table = BatchTable(spark, f"{place}/users", "x long")
    name = create_if_absent(spark, "followed", "users", table.schema, f"{place}/db", batches=table.path)
    table = BatchTable(spark, table.path, "x long", catalog=name, merge_every=3)
    try:
        for batch in range(8):
            table.replace(numbers(spark, batch), batch)
            assert sorted(r.x for r in spark.table(name).collect()) == list(range(batch + 1))
        table.replace(numbers(spark, 70, 71), 7)
        assert sorted(r.x for r in spark.table(name).collect()) == [*range(7), 70, 71]
        assert spark.table(name).where("batch_id = 7").count() == 2
        assert len(table.slices.live()) < 8
    finally:
        spark.sql("drop database followed cascade")
    assert held(table) == [*range(7), 70, 71]


# ---- taken keys


def pairs(spark, rows):
    return spark.createDataFrame(rows, "email string, username string")


def as_pairs(df):
    return set() if df is None else {(r.email, r.username) for r in df.collect()}


@pytest.mark.parametrize("buckets", [1, 8])
def test_taken_keys_are_those_of_earlier_batches(spark, tmp_path, buckets):
    index = KeyIndex(spark, str(tmp_path / "k"), ("email", "username"), buckets=buckets, merge_every=3)
    rng = random.Random(buckets)
    emails, users = set(), set()
    for batch in range(9):
        asked = [(f"e{rng.randrange(60)}" if rng.random() < 0.9 else None, f"u{rng.randrange(60)}") for _ in range(12)]
        expected = {(e, None) for e, _ in asked if e in emails} | {(None, u) for _, u in asked if u in users}
        assert as_pairs(index.taken(pairs(spark, asked), batch)) == expected
        for _ in range(1 + batch % 2):  # some batches are replayed
            index.put(pairs(spark, asked), batch)
            assert as_pairs(index.taken(pairs(spark, asked), batch)) == expected
        emails |= {e for e, _ in asked if e}
        users |= {u for _, u in asked}
    # a value taken in one column is free in the other
    assert as_pairs(index.taken(pairs(spark, [(sorted(users)[0], sorted(emails)[0])]), 99)) == set()


def test_fresh_keys_open_no_more_files_as_the_table_grows(spark, tmp_path):
    index = KeyIndex(spark, str(tmp_path / "k"), ("email", "username"), merge_every=4)
    filters, opened = [], []
    for batch in range(24):
        fresh = spark.range(batch * 100, batch * 100 + 100).selectExpr("concat('e', id) as email", "concat('u', id) as username")
        found = index.taken(fresh, batch)
        opened.append(0 if found is None else len([f for f in found.inputFiles() if "/keys/" in f]))
        filters.append(len(index.slices.live()))
        assert as_pairs(found) == set()
        index.put(fresh, batch)
    assert max(filters) <= 4 * 3 + 1
    # some 200 of 64 files in each slice are asked about; false hits stay rare while the table grows tenfold
    assert max(opened) <= 4
    old = spark.range(1500, 1503).selectExpr("concat('e', id) as email", "concat('u', id) as username")
    found = index.taken(old, 24)
    assert as_pairs(found) == {(f"e{i}", None) for i in range(1500, 1503)} | {(None, f"u{i}") for i in range(1500, 1503)}
    assert len(found.inputFiles()) <= 10


def test_an_index_is_made_for_a_table_that_has_none(spark, tmp_path):
    place = str(tmp_path)
    rng = random.Random(5)
    rows = [(f"e{rng.randint(1, 20)}", f"u{rng.randint(1, 20)}") for _ in range(40)]
    accepted, rejected = BatchTable(spark, f"{place}/users", CONSTRAINED), BatchTable(spark, f"{place}/rejected", REJECTED)

    def send(part):
        values = [event(email=e, username=u) for e, u in rows[part * 20 : part * 20 + 20]]
        messages(spark, values, part * 20).coalesce(1).write.mode("append").parquet(f"{place}/topic")
        stream = file_messages(spark, f"{place}/topic", max_per_trigger=1).withColumn("id", position_id())
        events = records(parse_messages(stream, EVENT, keep=("id", "offset")), keep=("id", "offset"))
        jobs.constrain_events(events, accepted, rejected.replace, f"{place}/checkpoint", f"{place}/rounds", order="offset").awaitTermination()

    send(0)
    os.rename(f"{place}/users/_keys", f"{place}/gone")
    send(1)
    expected = sequential([(n, e, u) for n, (e, u) in enumerate(rows)])
    assert sorted((r.email, r.username) for r in accepted.rows().collect()) == sorted(rows[n] for n in expected)


# ---- stores without keys


@pytest.mark.parametrize("store_format", ["json", "parquet"])
@pytest.mark.parametrize("left", [0, 3, 8])
def test_a_replay_into_a_store_without_keys_leaves_each_row_once(spark, tmp_path, monkeypatch, store_format, left):
    """A crash after any number of a batch's rows were stored, and before the batch was noted as done."""
    path, ledger = str(tmp_path / "store"), str(tmp_path / "ledger")
    rows = lambda batch: spark.range(batch * 8, batch * 8 + 8).selectExpr("cast(id as string) as id", "id * 2 as x")
    write = once_store(spark, store_format, ledger, path=path)
    write(rows(0), 0)

    commit, commits = Log.commit, []

    def crash(self, change, **kwargs):
        commits.append(1)
        if len(commits) == 2:
            raise Crash
        return commit(self, change, **kwargs)

    monkeypatch.setattr(Log, "commit", crash)
    with pytest.raises(Crash):
        write(rows(1).limit(left), 1)
    monkeypatch.undo()
    for _ in range(2):  # the replay, and one more of a batch that is done
        once_store(spark, store_format, ledger, path=path)(rows(1), 1)
    write(rows(2), 2)
    write(rows(1), 1)
    stored = spark.read.format(store_format).load(path).collect()
    assert sorted(int(r.id) for r in stored) == list(range(24))


def test_a_crash_before_the_stores_first_row(spark, tmp_path):
    Log(spark, str(tmp_path / "ledger")).commit(lambda state, number: {"begun": 0, "done": -1})
    once_store(spark, "parquet", str(tmp_path / "ledger"), path=str(tmp_path / "store"))(spark.range(3).selectExpr("cast(id as string) as id"), 0)
    assert spark.read.parquet(str(tmp_path / "store")).count() == 3
