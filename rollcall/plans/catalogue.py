"""The driver queries: each operator over the whole given tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollcall.functions import naive_timestamp, position_id
from rollcall.operators import charts, codec, constraints, counts, flatten
from rollcall.operators.latest import latest_per_key
from rollcall.operators.resent import seen_schema
from rollcall.operators.uniqueness import first_wins
from rollcall.plans import users as given
from rollcall.schemas import ADDRESSED, CONSTRAINED, COUNTED, DATE_FIELDS, EVENT, EVENT_FIELDS, STORED
from rollcall.sinks.batches import BatchTable, SlotTable
from rollcall.sinks.ddl import create_if_absent
from rollcall.sources.messages import file_messages
from rollcall.sources.tables import load_users, table
from rollcall.streaming import jobs
from rollcall.streaming.tables import REJECTED, SNAPSHOT, UNREADABLE
from rollcall.workspace import new_folder

# Files that a micro-batch of these queries takes: those of a part of the published topic (see `users.publish_topic`).
FILES = given.FILES

Query = Callable[[SparkSession, str], DataFrame]

# A second order of a customer this soon counts as the first one sent again.
RESENT_WITHIN = timedelta(days=30)


def load(spark: SparkSession, folder: str) -> DataFrame:
    return given.users(spark, folder)


def raw_first_result(spark: SparkSession, folder: str) -> DataFrame:
    parsed = flatten.parse_responses(given.responses(given.users(spark, folder)))
    return parsed.select(
        "user_key",
        F.col("user.email").alias("email"),
        F.col("user.location.street.number").alias("street_number"),
        F.col("user.location.postcode").alias("postcode"),
        "reason",
    )


def flatten_user(spark: SparkSession, folder: str) -> DataFrame:
    parsed = flatten.parse_responses(given.responses(given.users(spark, folder)))
    return flatten.flatten_users(parsed, keep=("user_key",))


def unusable_responses(spark: SparkSession, folder: str) -> DataFrame:
    parsed = flatten.parse_responses(given.responses(given.users(spark, folder)))
    return flatten.unusable_responses(parsed, keep=("user_key", "response"))


def encode_event(spark: SparkSession, folder: str) -> DataFrame:
    encoded = codec.encode(given.users(spark, folder), keep=("user_key",))
    return encoded.select("user_key", F.col("value").cast("string").alias("value"))


def _parsed(spark: SparkSession, folder: str) -> DataFrame:
    messages = given.messages(given.users(spark, folder), damaged=True)
    return codec.parse_messages(messages, keep=("topic", "partition", "offset"))


def decode_event(spark: SparkSession, folder: str) -> DataFrame:
    return codec.records(_parsed(spark, folder), keep=("partition", "offset"))


def decode_event_all(spark: SparkSession, folder: str) -> DataFrame:
    return codec.records(_parsed(spark, folder), keep=("partition", "offset"), include_unreadable=True)


def quarantine(spark: SparkSession, folder: str) -> DataFrame:
    bad = codec.quarantine(_parsed(spark, folder), keep=("topic", "partition", "offset"))
    return bad.select("topic", "partition", "offset", F.hex("value").alias("value_hex"), "reason")


def assign_id(spark: SparkSession, folder: str) -> DataFrame:
    messages = given.messages(given.users(spark, folder))
    parsed = codec.parse_messages(messages.withColumn("id", position_id()), keep=("id",))
    return codec.records(parsed, keep=("id",))


def reject_nulls(spark: SparkSession, folder: str) -> DataFrame:
    return constraints.storable(constraints.check_rows(given.users(spark, folder)))


def constraint_violations(spark: SparkSession, folder: str) -> DataFrame:
    checked = constraints.check_rows(given.users(spark, folder))
    return constraints.violators(checked).select("user_key", "violation")


def iso_date_cast(spark: SparkSession, folder: str) -> DataFrame:
    casts = [naive_timestamp(name).alias(name) for name in DATE_FIELDS]
    return given.users(spark, folder).select("user_key", *casts)


def unique_first_wins(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events").select(
        "event_id", "user_id", F.get_json_object("props", "$.k").cast("int").alias("k")
    )
    return first_wins(events, "user_id", "k", "event_id", new_folder(spark, "unique"))


def constrained_users(spark: SparkSession, folder: str) -> DataFrame:
    checked = constraints.check_table(given.users(spark, folder), "user_key", new_folder(spark, "constrained"))
    return constraints.storable(checked)


def rejected_users(spark: SparkSession, folder: str) -> DataFrame:
    checked = constraints.check_table(given.users(spark, folder), "user_key", new_folder(spark, "rejected"))
    return constraints.violators(checked).select("user_key", "violation")


def upsert_latest(spark: SparkSession, folder: str) -> DataFrame:
    return latest_per_key(given.users(spark, folder), "email", "user_key")


def _counted(count: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, folder: count(given.users(spark, folder))


def country_match(spark: SparkSession, folder: str) -> DataFrame:
    """A map that lacks one continent."""
    nations, regions = table(spark, folder, "nation"), table(spark, folder, "region")
    shown = nations.join(regions.filter("r_name <> 'AFRICA'"), F.col("n_regionkey") == F.col("r_regionkey"))
    return charts.match_countries(given.users(spark, folder), shown.select(F.col("n_name").alias("country")))


def top_countries(spark: SparkSession, folder: str) -> DataFrame:
    return charts.top_countries(given.users(spark, folder), 5)


def _store(spark: SparkSession, place: str, messages: DataFrame) -> tuple[DataFrame, DataFrame]:
    store = BatchTable(spark, f"{place}/users", STORED)
    unreadable = BatchTable(spark, f"{place}/unreadable", UNREADABLE)
    jobs.store_messages(messages, store.replace, unreadable.replace, f"{place}/checkpoint").awaitTermination()
    return store.rows(), unreadable.rows()


def stream_decode(spark: SparkSession, folder: str) -> DataFrame:
    """From a published topic, as a consumer sees it."""
    place = new_folder(spark, "stream")
    topic = given.publish_topic(spark, folder, f"{place}/topic", damaged=True)
    stored, _ = _store(spark, place, file_messages(spark, topic, max_per_trigger=FILES))
    return stored


def stream_quarantine(spark: SparkSession, folder: str) -> DataFrame:
    place = new_folder(spark, "stream-quarantine")
    topic = given.publish_topic(spark, folder, f"{place}/topic", damaged=True)
    _, bad = _store(spark, place, file_messages(spark, topic, max_per_trigger=FILES))
    return bad.select("topic", "partition", "offset", F.hex("value").alias("value_hex"), "reason")


def stream_sink_idempotent(spark: SparkSession, folder: str) -> DataFrame:
    """The job run twice on one checkpoint, as a scheduler's retry would."""
    place = new_folder(spark, "stream-twice")
    topic = given.publish_topic(spark, folder, f"{place}/topic", damaged=True)
    for _ in range(2):
        stored, _ = _store(spark, place, file_messages(spark, topic, max_per_trigger=FILES))
    return stored


def stream_counts(spark: SparkSession, folder: str) -> DataFrame:
    place = new_folder(spark, "stream-counts")
    topic = given.publish_topic(spark, folder, f"{place}/topic")
    parsed = codec.parse_messages(file_messages(spark, topic, max_per_trigger=FILES), COUNTED, keep=())
    snapshots = BatchTable(spark, f"{place}/totals", SNAPSHOT)
    jobs.count_users(codec.records(parsed, keep=()), snapshots.snapshot, f"{place}/checkpoint").awaitTermination()
    return snapshots.newest()


def stream_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Every message sent twice; kept are those that no message of the same e-mail precedes by at most the bound."""
    place = new_folder(spark, "stream-dedup")
    topic = given.publish_topic(spark, folder, f"{place}/topic", by_time=True, copies=2)
    parsed = codec.parse_messages(file_messages(spark, topic, max_per_trigger=FILES), ADDRESSED, keep=("timestamp",))
    received = codec.records(parsed, keep=("timestamp",)).select("email", "timestamp")
    kept = BatchTable(spark, f"{place}/kept", received.schema)
    seen = SlotTable(spark, f"{place}/seen", seen_schema(received.schema, ["email"]))
    jobs.drop_resent(received, ["email"], RESENT_WITHIN, kept.replace, seen, f"{place}/checkpoint").awaitTermination()
    return kept.rows().select("email", F.col("timestamp").cast("date").cast("string").alias("sent"))


def stream_constrained(spark: SparkSession, folder: str) -> DataFrame:
    """Messages published in the order of their keys, so that earlier batches hold earlier rows."""
    place = new_folder(spark, "stream-constrained")
    topic = given.publish_topic(spark, folder, f"{place}/topic", by_key=True)
    messages = file_messages(spark, topic, max_per_trigger=FILES).withColumn("id", position_id())
    # Partition and offset together number the messages as the key does.
    messages = messages.withColumn("user_key", F.col("offset") * 8 + F.col("partition"))
    events = codec.records(codec.parse_messages(messages, EVENT, keep=("id", "user_key")), keep=("id", "user_key"))
    accepted = BatchTable(spark, f"{place}/users", CONSTRAINED)
    rejected = BatchTable(spark, f"{place}/rejected", REJECTED)
    jobs.constrain_events(
        events, accepted, rejected.replace, f"{place}/checkpoint", f"{place}/rounds", order="user_key"
    ).awaitTermination()
    return accepted.rows()


def ddl_idempotent(spark: SparkSession, folder: str) -> DataFrame:
    """The table created twice, filled once, read back."""
    place = new_folder(spark, "ddl")
    namespace = place.rsplit("/", 1)[1].replace("-", "_")
    for _ in range(2):
        name = create_if_absent(spark, namespace, "users", EVENT, place)
    given.users(spark, folder).select(*EVENT_FIELDS).write.insertInto(name)
    return load_users(spark, path=f"{place}/users")


QUERIES: dict[str, Query] = {
    "load_users": load,
    "raw_first_result": raw_first_result,
    "flatten_user": flatten_user,
    "unusable_responses": unusable_responses,
    "encode_event": encode_event,
    "decode_event": decode_event,
    "decode_event_all": decode_event_all,
    "quarantine": quarantine,
    "assign_id": assign_id,
    "reject_nulls": reject_nulls,
    "constraint_violations": constraint_violations,
    "iso_date_cast": iso_date_cast,
    "unique_first_wins": unique_first_wins,
    "constrained_users": constrained_users,
    "rejected_users": rejected_users,
    "upsert_latest": upsert_latest,
    "count_by_country": _counted(counts.count_by_country),
    "count_by_gender": _counted(counts.count_by_gender),
    "count_by_year": _counted(counts.count_by_year),
    "chart_totals": _counted(counts.chart_totals),
    "share_by_country": _counted(charts.share_by_country),
    "distinct_countries": _counted(charts.distinct_countries),
    "country_match": country_match,
    "top_countries": top_countries,
    "stream_decode": stream_decode,
    "stream_quarantine": stream_quarantine,
    "stream_sink_idempotent": stream_sink_idempotent,
    "stream_counts": stream_counts,
    "stream_dedup": stream_dedup,
    "stream_constrained": stream_constrained,
    "ddl_idempotent": ddl_idempotent,
}
