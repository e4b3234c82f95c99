import json
import os
import random
from datetime import datetime, timedelta
from pathlib import Path

import pytest
from helpers import event, messages, plan, response, sequential
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from rollcall.functions import position_id
from rollcall.operators.codec import parse_messages, records
from rollcall.operators.counts import chart_totals, count_by_country
from rollcall.operators.resent import copies_per_slot, seen_schema
from rollcall.plans import users as given
from rollcall.schemas import CONSTRAINED, DECODED, EVENT, EVENT_FIELDS, MESSAGE, STORED
from rollcall.sinks.batches import BatchTable, SlotTable
from rollcall.sinks.stores import keyed_store, topic
from rollcall.sources.messages import file_messages, kafka_messages
from rollcall.sources.responses import responses_from_files, responses_from_messages, responses_from_table
from rollcall.streaming import jobs
from rollcall.streaming.tables import REJECTED, SNAPSHOT, UNREADABLE, UNUSABLE


def _publish(spark, path, values, start=0):
    messages(spark, values, start).coalesce(1).write.mode("append").parquet(path)


def _lose_last_commit(checkpoint):
    """What a crash between the sink's write and the commit leaves behind."""
    commits = os.path.join(checkpoint, "commits")
    last = max(int(name) for name in os.listdir(commits) if name.isdigit())
    for name in (str(last), f".{last}.crc"):
        path = os.path.join(commits, name)
        if os.path.exists(path):
            os.unlink(path)
    return last


class _StoreJob:
    def __init__(self, spark, place):
        self.spark, self.topic, self.checkpoint = spark, f"{place}/topic", f"{place}/checkpoint"
        self.store = BatchTable(spark, f"{place}/users", STORED)
        self.bad = BatchTable(spark, f"{place}/bad", UNREADABLE)

    def run(self, files=1):
        stream = file_messages(self.spark, self.topic, max_per_trigger=files)
        jobs.store_messages(stream, self.store.replace, self.bad.replace, self.checkpoint).awaitTermination()

    def stored(self):
        return sorted(map(tuple, self.store.rows().collect()))


@pytest.fixture()
def job(spark, tmp_path):
    return _StoreJob(spark, str(tmp_path))


def test_stream_equals_batch_over_several_batches(spark, job):
    for part in range(3):
        _publish(spark, job.topic, [event(email=f"{part}-{i}") for i in range(5)] + ["{bad", None], start=part * 7)
    job.run()
    assert job.store.read().filter("batch_id >= 0").select("batch_id").distinct().count() == 3
    topic_rows = spark.read.parquet(job.topic).withColumn("id", position_id())
    batch = records(parse_messages(topic_rows, DECODED, keep=("id",)), keep=("id",))
    assert job.stored() == sorted(map(tuple, batch.collect()))
    assert len(job.stored()) == 15
    assert job.bad.rows().count() == 6


def test_unreadable_messages_can_be_stored_and_counted(spark, job):
    _publish(spark, job.topic, [event(country="c"), "{bad", None])
    stream = file_messages(spark, job.topic)
    jobs.store_messages(
        stream, job.store.replace, job.bad.replace, job.checkpoint, include_unreadable=True
    ).awaitTermination()
    counted = {row.country: row.total for row in count_by_country(job.store.rows()).collect()}
    assert counted == {"c": 1, None: 2}
    assert job.store.rows().filter("id is null").count() == 0
    assert job.bad.rows().count() == 2


def test_a_running_stream_finds_new_files(spark, job):
    _publish(spark, job.topic, [event(email="1")])
    stream = file_messages(spark, job.topic)
    query = jobs.store_messages(
        stream, job.store.replace, job.bad.replace, job.checkpoint, trigger={"processingTime": "1 second"}
    )
    try:
        query.processAllAvailable()
        _publish(spark, job.topic, [event(email="2")], start=1)
        query.processAllAvailable()
    finally:
        query.stop()
    assert len(job.stored()) == 2


def test_a_missing_connector_raises(spark):
    with pytest.raises(AnalysisException, match="kafka"):
        kafka_messages(spark, "localhost:9092", "users")


def test_restart_adds_nothing_and_new_files_are_found(spark, job):
    _publish(spark, job.topic, [event(email=str(i)) for i in range(5)])
    job.run()
    first = job.stored()
    job.run()
    assert job.stored() == first
    _publish(spark, job.topic, [event(email="new")], start=5)
    job.run()
    assert len(job.stored()) == 6
    assert set(first) < set(job.stored())


def test_replay_after_a_lost_commit_adds_nothing(spark, job):
    for part in range(2):
        _publish(spark, job.topic, [event(email=f"{part}-{i}") for i in range(5)], start=part * 5)
    job.run()
    before = job.stored()
    _lose_last_commit(job.checkpoint)
    job.run()
    assert job.stored() == before


def test_keyed_store_gets_the_same_ids_on_a_replay(spark, job, tmp_path):
    _publish(spark, job.topic, [event(email=str(i)) for i in range(5)])
    write = keyed_store("parquet", path=str(tmp_path / "keyed"))
    for _ in range(2):
        stream = file_messages(spark, job.topic)
        jobs.store_messages(stream, write, job.bad.replace, job.checkpoint).awaitTermination()
        _lose_last_commit(job.checkpoint)
    keyed = spark.read.parquet(str(tmp_path / "keyed"))
    # Written twice, yet an upserting store sees five keys.
    assert (keyed.count(), keyed.select("id").distinct().count()) == (10, 5)


def test_counts_follow_the_stream(spark, tmp_path):
    place = str(tmp_path)
    snapshots = BatchTable(spark, f"{place}/totals", SNAPSHOT)

    def run():
        stream = file_messages(spark, f"{place}/topic", max_per_trigger=1)
        users = records(parse_messages(stream, keep=()), keep=())
        jobs.count_users(users, snapshots.replace, f"{place}/checkpoint").awaitTermination()

    for part in range(3):
        values = [event(country=f"c{i % 2}", gender=None if i == part else "f") for i in range(4)]
        _publish(spark, f"{place}/topic", [*values, event(registered_date="never")], start=part * 5)
    run()
    batch = chart_totals(records(parse_messages(spark.read.parquet(f"{place}/topic"), keep=()), keep=()))
    assert sorted(map(str, snapshots.newest().collect())) == sorted(map(str, batch.collect()))
    _publish(spark, f"{place}/topic", [event(country="late")], start=15)
    run()
    assert snapshots.newest().filter("k = 'late'").count() == 1


class _ResentJob:
    def __init__(self, spark, place):
        self.spark, self.topic, self.checkpoint = spark, f"{place}/topic", f"{place}/checkpoint"
        self.kept = BatchTable(spark, f"{place}/kept", "email string, offset long, timestamp timestamp")
        self.seen = SlotTable(spark, f"{place}/seen", seen_schema(self.kept.schema, ["email"]))
        self.sent = 0

    def send(self, *records):
        """Each record is (email, minute of arrival); one call is one micro-batch."""
        values = [event(email=email) for email, _ in records]
        minutes = self.spark.createDataFrame([(self.sent + i, m) for i, (_, m) in enumerate(records)], "offset long, m int")
        stamped = messages(self.spark, values, self.sent).drop("timestamp").join(minutes, "offset")
        stamped = stamped.withColumn("timestamp", F.expr("timestamp'2024-01-01 00:00:00' + make_dt_interval(0, 0, m)"))
        stamped.select(*MESSAGE.names).coalesce(1).write.mode("append").parquet(self.topic)
        self.sent += len(records)

    def run(self):
        keep = ("offset", "timestamp")
        parsed = parse_messages(file_messages(self.spark, self.topic, max_per_trigger=1), keep=keep)
        received = records(parsed, keep=keep).select("email", *keep)
        hour = timedelta(hours=1)
        jobs.drop_resent(received, ["email"], hour, self.kept.replace, self.seen, self.checkpoint).awaitTermination()
        return sorted((row.email, row.offset) for row in self.kept.rows().filter("email is not null").collect())


def test_resent_records_are_dropped(spark, tmp_path):
    job = _ResentJob(spark, str(tmp_path))
    job.send(("a", 0), ("b", 5), ("a", 1))
    assert job.run() == [("a", 0), ("b", 1)]
    # Within an hour of the first copy, then beyond it; a late record with a new key is not lost.
    job.send(("a", 60), ("b", 66), ("c", 0))
    assert job.run() == [("a", 0), ("b", 1), ("b", 4), ("c", 5)]
    _lose_last_commit(job.checkpoint)
    assert job.run() == [("a", 0), ("b", 1), ("b", 4), ("c", 5)]


@pytest.mark.parametrize("batches", [1, 4])
def test_resent_records_do_not_depend_on_the_batches(spark, tmp_path, batches):
    rnd = random.Random(4)
    arrivals = [(f"e{rnd.randint(1, 4)}", minute) for minute in sorted(rnd.randint(0, 900) for _ in range(60))]
    last, expected = {}, []
    for offset, (email, minute) in enumerate(arrivals):
        if email not in last or minute - last[email] > 60:
            expected.append((email, offset))
        last[email] = minute
    job = _ResentJob(spark, str(tmp_path))
    for part in range(batches):
        job.send(*arrivals[part * 60 // batches : (part + 1) * 60 // batches])
    assert 4 < len(expected) < 40
    assert job.run() == sorted(expected)


def test_state_of_resent_records_stays_flat(spark, tmp_path):
    job = _ResentJob(spark, str(tmp_path))
    sizes = []
    for part in range(20):
        job.send(*((f"e{i}", part * 90 + i) for i in range(3)))
        job.run()
        sizes.append(job.seen.before(1000).count())
    assert max(sizes) == sizes[-1] == sizes[5] <= 5 * 3


def test_late_records(spark, tmp_path):
    """What has come in an earlier batch stands; within a batch time decides."""
    job = _ResentJob(spark, f"{tmp_path}/one")
    job.send(("a", 100), ("a", 70), ("a", 30))
    assert job.run() == [("a", 2)]
    job = _ResentJob(spark, f"{tmp_path}/two")
    job.send(("a", 100))
    job.send(("a", 70), ("b", 700))
    job.send(("a", 30), ("c", 701))
    # 70 is within reach of what has come already, 30 is older than all that is remembered.
    assert job.run() == [("a", 0), ("a", 3), ("b", 2), ("c", 4)]


def test_a_replaced_batch_is_written_aside_first(spark, tmp_path):
    table = BatchTable(spark, f"{tmp_path}/t", "x long")
    table.replace(spark.range(10).withColumnRenamed("id", "x"), 0)
    slow = spark.range(20).withColumnRenamed("id", "x")
    before = table.rows().count()
    table.replace(slow, 0)
    assert (before, table.rows().count()) == (10, 20)
    assert [name for name in os.listdir(f"{tmp_path}/t") if name.startswith("_aside")] == []


def test_resent_records_without_key_are_copies_too(spark, tmp_path):
    job = _ResentJob(spark, str(tmp_path))
    job.send((None, 0), (None, 1))
    job.run()
    job.send((None, 2))
    job.run()
    assert job.kept.rows().count() == 1


def _pairs(seed, size=30):
    rnd = random.Random(seed)
    return [(f"e{rnd.randint(1, 15)}", f"u{rnd.randint(1, 15)}") for _ in range(size)]


def test_constrained_table_across_batches_and_a_replay(spark, tmp_path):
    place = str(tmp_path)
    pairs = _pairs(3)
    for part in range(3):
        values = [event(email=e, username=u) for e, u in pairs[part * 10 : part * 10 + 10]]
        _publish(spark, f"{place}/topic", values, start=part * 10)
    accepted = BatchTable(spark, f"{place}/users", CONSTRAINED)
    rejected = BatchTable(spark, f"{place}/rejected", REJECTED)

    def run():
        stream = file_messages(spark, f"{place}/topic", max_per_trigger=1)
        topic_rows = stream.withColumn("id", position_id())
        events = records(parse_messages(topic_rows, EVENT, keep=("id", "offset")), keep=("id", "offset"))
        jobs.constrain_events(
            events, accepted, rejected.replace, f"{place}/checkpoint", f"{place}/rounds", order="offset"
        ).awaitTermination()

    run()
    keys = sorted((row.email, row.username) for row in accepted.rows().collect())
    expected = sequential([(n, e, u) for n, (e, u) in enumerate(pairs)])
    assert keys == sorted(pairs[n] for n in expected)
    assert rejected.rows().count() == len(pairs) - len(expected)
    _lose_last_commit(f"{place}/checkpoint")
    run()
    assert sorted((row.email, row.username) for row in accepted.rows().collect()) == keys
    assert rejected.rows().count() == len(pairs) - len(expected)


def _ingest(spark, place, responses):
    accepted = BatchTable(spark, f"{place}/users", CONSTRAINED)
    rejected = BatchTable(spark, f"{place}/rejected", REJECTED)
    unusable = BatchTable(spark, f"{place}/unusable", UNUSABLE)
    published = topic("parquet", path=f"{place}/published")
    jobs.ingest_responses(
        responses,
        published,
        accepted,
        rejected.replace,
        unusable.replace,
        f"{place}/checkpoint",
        f"{place}/rounds",
    ).awaitTermination()
    return accepted, rejected, unusable, spark.read.parquet(f"{place}/published")


BODIES = [
    response(),
    response(email="b@example.com"),
    response(email="c@example.com", login={"username": "c"}, phone=None),
    response(email="d@example.com", login={"username": "d"}),
    {"results": []},
]


def test_ingest_from_files_publishes_every_event(spark, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    for i, body in enumerate(BODIES):
        file = landing / f"{i}.json"
        file.write_text(json.dumps(body))
        os.utime(file, (1_700_000_000 + i, 1_700_000_000 + i))
    responses = responses_from_files(spark, str(landing), streaming=True)
    accepted, rejected, unusable, published = _ingest(spark, str(tmp_path), responses)
    assert {row.email for row in accepted.rows().collect()} == {"ada@example.com", "d@example.com"}
    assert {row.violation for row in rejected.rows().collect()} == {"unique:email,username", "null:phone"}
    assert [row.reason for row in unusable.rows().collect()] == ["no_result"]
    # The topic holds what the table rejected as well.
    events = records(parse_messages(published, EVENT, keep=()), keep=())
    assert events.columns == list(EVENT_FIELDS)
    assert events.count() == 4


def test_ingest_from_a_landed_table(spark, tmp_path):
    place = str(tmp_path)
    texts = spark.createDataFrame([(json.dumps(body),) for body in BODIES], "response string")
    texts.coalesce(1).write.parquet(f"{place}/landing")
    responses = responses_from_table(spark, f"{place}/landing", streaming=True)
    accepted, rejected, unusable, published = _ingest(spark, place, responses)
    assert {row.email for row in accepted.rows().collect()} == {"ada@example.com", "d@example.com"}
    assert (rejected.rows().count(), unusable.rows().count(), published.count()) == (2, 1, 4)


def test_ingest_from_messages(spark, tmp_path):
    place = str(tmp_path)
    _publish(spark, f"{place}/topic", BODIES)
    responses = responses_from_messages(file_messages(spark, f"{place}/topic"))
    accepted, rejected, unusable, published = _ingest(spark, place, responses)
    assert {row.email for row in accepted.rows().collect()} == {"ada@example.com", "d@example.com"}
    assert (rejected.rows().count(), unusable.rows().count(), published.count()) == (2, 1, 4)


def test_times_are_summed_up_without_a_sort(spark):
    at = lambda minute: datetime(2020, 1, 1, 0, minute)
    sent = spark.createDataFrame([("a", at(3)), ("a", at(1)), ("b", None), (None, at(2))], "email string, timestamp timestamp")
    spans = copies_per_slot(sent, ["email"], "timestamp", timedelta(hours=1))
    assert "SortAggregate" not in plan(spans)
    assert {(r.email, r.timestamp, r.first, r.last) for r in spans.collect()} == {
        ("a", at(1), at(1), at(3)), ("b", None, None, None), (None, at(2), at(2), at(2)),
    }


@pytest.mark.parametrize("order", [{"by_time": True}, {"by_key": True}, {}])
def test_a_topic_is_published_part_by_part(spark, tmp_path, order):
    """Each message as often as asked for, parts in their order, and nothing beside the topic."""
    days = [None, *(f"199{n % 7}-0{n % 9 + 1}-11 00:00:00" for n in range(40))]
    orders = [(None if n == 5 else n * n % 90, n % 4, day) for n, day in enumerate(days)]
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long, day string").selectExpr(
        "o_orderkey", "o_custkey", "cast(day as timestamp) as o_orderdate"
    ).write.parquet(f"{tmp_path}/orders.parquet")
    spark.sql("select id as c_custkey, concat('c', id) as c_name, 0 as c_nationkey, 's' as c_mktsegment from range(4)").write.parquet(f"{tmp_path}/customer.parquet")
    spark.sql("select 0 as n_nationkey, 'n' as n_name, 0 as n_regionkey").write.parquet(f"{tmp_path}/nation.parquet")
    spark.sql("select 0 as r_regionkey, 'r' as r_name").write.parquet(f"{tmp_path}/region.parquet")
    topic = given.publish_topic(spark, str(tmp_path), f"{tmp_path}/topic/users", copies=2, **order)
    wanted = given.messages(given.users(spark, str(tmp_path))).select(*MESSAGE.names)
    published = spark.read.schema(MESSAGE).parquet(topic)
    assert published.count() == 82
    assert published.exceptAll(wanted.union(wanted)).isEmpty()
    assert os.listdir(f"{tmp_path}/topic") == ["users"]
    if order:
        value = F.unix_micros("timestamp") if "by_time" in order else F.col("offset") * 8 + F.col("partition")
        low, high = published.select(F.min(value), F.max(value)).first()
        part = F.coalesce(F.floor((value - low) * given.PARTS / (high + 1 - low)), F.lit(0))
        files = sorted(Path(topic).glob("*.parquet"), key=lambda f: f.stat().st_mtime_ns)
        parts = [{r[0] for r in spark.read.schema(MESSAGE).parquet(str(f)).select(part).collect()} for f in files]
        assert all(len(p) <= 1 for p in parts)
        firsts = [min(p) for p in parts if p]
        assert firsts == sorted(firsts) and set(firsts) == set(range(given.PARTS))


def test_checked_rows_are_not_held_beside_the_batch(spark, tmp_path):
    held = lambda: spark.sparkContext._jsc.getPersistentRDDs().size()
    events = records(parse_messages(messages(spark, [event(), event()]).withColumn("id", position_id()), EVENT, keep=("id", "offset")), keep=("id", "offset"))
    accepted, before, seen = BatchTable(spark, f"{tmp_path}/users", CONSTRAINED), held(), []

    def rejected(rows, batch_id):
        seen.append((rows.count(), held()))

    jobs.write_constrained(events, 0, accepted, rejected, f"{tmp_path}/rounds", order="offset")
    assert accepted.rows().count() == 1 and seen == [(1, before)]
    jobs.write_constrained(events, 1, accepted, rejected, f"{tmp_path}/rounds", order="offset")
    assert accepted.rows().count() == 1 and seen[1] == (2, before + 1) and held() == before  # the keys taken
