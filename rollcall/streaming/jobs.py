"""The streaming jobs. Each returns the started query; the caller decides whether to wait.

A job gets its own checkpoint, kept as long as the table it writes. By default it takes what is there and
ends (``availableNow``), so any scheduler can run it again; pass ``trigger`` to keep it running. A ``limit`` in the
trigger, in seconds, refuses batches after that time (`limits.run_for` waits for such a query).
"""

from __future__ import annotations

import uuid
from datetime import timedelta

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from rollcall.functions import position_id
from rollcall.operators.codec import SOURCE_FIELDS, parse_messages, quarantine, records
from rollcall.operators.constraints import check_table, storable, violators
from rollcall.operators.counts import joint_counts, totals_from_joint
from rollcall.operators.flatten import flatten_users, parse_responses, unusable_responses
from rollcall.operators.resent import copies_per_slot, first_copies
from rollcall.schemas import EVENT_FIELDS
from rollcall.sinks.batches import BatchTable, SlotTable
from rollcall.sinks.keys import KeyIndex
from rollcall.sinks.stores import BatchWriter, both
from rollcall.streaming.limits import until
from rollcall.streaming.tables import CHECKED, METRICS
from rollcall.workspace import remove_folder

#: The constrained table's keys, and its kinds of constraints.
UNIQUE = ("email", "username")
KINDS = ("null", "date", "unique")


def start(
    stream: DataFrame, write: BatchWriter, checkpoint: str, *, mode: str = "append", trigger: dict | None = None
) -> StreamingQuery:
    trigger = dict(trigger or {"availableNow": True})
    limit = trigger.pop("limit", None)
    write = write if limit is None else until(write, limit)
    return (
        stream.writeStream.outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .foreachBatch(write)
        .start()
    )


def store_messages(
    messages: DataFrame,
    store: BatchWriter,
    unreadable: BatchWriter,
    checkpoint: str,
    *,
    include_unreadable: bool = False,
    counts: BatchTable | None = None,
    metrics: BatchTable | None = None,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Messages to stored users; messages that cannot be read go to ``unreadable`` with the reason.

    With ``include_unreadable`` they are stored as rows of NULLs as well, and so are counted. ``counts`` takes each batch's
    users per country, gender and year, from which a dashboard adds up its figures (`counts.joint_counts`). ``metrics``
    takes one row per batch with the numbers of its outcomes, observed while the batch is stored.

    The stream has no shuffle but for ``counts``: a micro-batch has the parallelism of its source partitions.
    """
    parsed = parse_messages(messages.withColumn("id", position_id()), keep=("id", *SOURCE_FIELDS))

    def write(batch: DataFrame, batch_id: int) -> None:
        # Parsed once for both outputs. A lost block is read again from the source, with the same ids.
        batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
        seen = Observation()
        try:
            users = records(batch, keep=("id",), include_unreadable=include_unreadable)
            store(users, batch_id)
            outcome = [F.count("*").alias("messages"), F.count("reason").alias("unreadable")]
            unreadable(quarantine(batch.observe(seen, *outcome) if metrics else batch), batch_id)
            if counts:
                counts.replace(joint_counts(users), batch_id)
            if metrics:
                metrics.replace(batch.sparkSession.createDataFrame([(seen.get["messages"], seen.get["unreadable"])], METRICS), batch_id)
        finally:
            batch.unpersist()

    return start(parsed, write, checkpoint, trigger=trigger)


def count_users(users: DataFrame, snapshots: BatchWriter, checkpoint: str, *, trigger: dict | None = None) -> StreamingQuery:
    """Chart totals kept current by the stream: every batch writes the full, small set of totals.

    State is one row per (country, gender, year); the totals are derived from it batch by batch.
    """

    def write(joint: DataFrame, batch_id: int) -> None:
        snapshots(totals_from_joint(joint), batch_id)

    return start(joint_counts(users), write, checkpoint, mode="complete", trigger=trigger)


def drop_resent(
    records: DataFrame,
    keys: list[str],
    within: timedelta,
    kept: BatchWriter,
    seen: SlotTable,
    checkpoint: str,
    *,
    time: str = "timestamp",
    late: timedelta | None = None,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Records to ``kept``, without those that follow a copy of themselves by at most ``within``.

    Within a batch that is decided by time. Between batches what has come first stands: a record that arrives later but
    is earlier by at most ``within`` is dropped too, and what it would have displaced stays. So the result depends on
    where batches end only for records that arrive out of order.

    ``seen`` holds the state, a table with the columns `resent.seen_schema` gives; only the times near a batch's are read.
    It goes back by ``within`` and ``late`` (as long, if not given) from the newest record of earlier batches; a record
    older than that is kept, since its copies are forgotten. Copies fold before the shuffle, so a record that makes up a
    third of a batch is no hot key, which it would be for ``dropDuplicatesWithinWatermark``.
    """
    # The slot of the newest record, one for records that begin in a slot, and those that late ones may reach.
    back = 2 + -(-(within if late is None else late) // within)

    def write(batch: DataFrame, batch_id: int) -> None:
        spans = copies_per_slot(batch, keys, time, within).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            slots = spans.agg((F.min("slot") - 1).alias("low"), (F.max("slot") + 1).alias("high"))
            low, high = slots.select("low").scalar(), slots.select("high").scalar()
            known = seen.before(batch_id)
            # From earlier batches only, so that a replay forgets and remembers the same.
            newest = known.agg(F.max("slot")).first()[0]
            oldest = None if newest is None else newest - back
            near = known.filter(F.col("slot").between(low, high))
            near = near if oldest is None else near.filter(F.col("slot") >= oldest)
            kept(first_copies(spans, near, keys, within).select(records.columns), batch_id)
            seen.replace(spans, batch_id)
            if oldest is not None:
                seen.forget(oldest)
        finally:
            spans.unpersist()

    return start(records, write, checkpoint, trigger=trigger)


def constrain_events(
    events: DataFrame,
    accepted: BatchTable,
    rejected: BatchWriter,
    checkpoint: str,
    workdir: str,
    *,
    order: str = "arrival",
    trigger: dict | None = None,
    **options,
) -> StreamingQuery:
    """Events to the constrained table. ``events`` carry ``id``, the event fields and a unique ``order``.

    A batch is checked against the keys of earlier batches only, so a replay does not meet its own rows.
    The keys the table holds are the state, and grow with it; they are looked up in an index beside the table (`KeyIndex`).
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            write_constrained(batch, batch_id, accepted, rejected, workdir, order=order, **options)
        finally:
            batch.unpersist()

    return start(events, write, checkpoint, trigger=trigger)


def write_constrained(
    events: DataFrame,
    batch_id: int,
    accepted: BatchTable,
    rejected: BatchWriter,
    workdir: str,
    *,
    order: str,
    also: BatchWriter | None = None,
    metrics: BatchTable | None = None,
    **options,
) -> None:
    """The batch's storable rows to the table, and to the writer ``also`` (an external store) if there is one.

    ``metrics`` takes one row per batch: rows, and rows rejected by the first constraint they break, observed on the way.
    """
    store = both(accepted.replace, also) if also else accepted.replace
    run = f"{workdir}/batch-{batch_id}-{uuid.uuid4().hex}"
    index = KeyIndex(events.sparkSession, f"{accepted.path}/_keys", UNIQUE)
    if not index.slices.live(before=batch_id) and accepted.slices.live(before=batch_id):
        index.put(accepted.before(batch_id), batch_id - 1)  # a table from before it had an index
    # Joined with each of the two keys, and found once.
    taken = index.taken(events, batch_id)
    if taken is not None:
        taken.persist(StorageLevel.MEMORY_AND_DISK)
    # The batch is held already, so it need neither be written nor held once more: the rejected rows leave with few columns.
    checked = check_table(events, order, run, taken=taken, write_checked=False, **options)
    try:
        store(storable(checked), batch_id)
        seen, broken = Observation(), [F.count(F.when(F.startswith("violation", F.lit(f"{kind}:")), 1)).alias(kind) for kind in KINDS]
        rejected(violators(checked.observe(seen, F.count("*").alias("events"), *broken) if metrics else checked), batch_id)
        if metrics:
            metrics.replace(events.sparkSession.createDataFrame([tuple(seen.get[name] for name in ("events", *KINDS))], CHECKED), batch_id)
        # What the table took, from its files. Until this is done the batch is replayed.
        index.put(accepted.batch(batch_id), batch_id)
    finally:
        if taken is not None:
            taken.unpersist()
        remove_folder(events.sparkSession, run)


def ingest_responses(
    responses: DataFrame,
    publish: BatchWriter,
    accepted: BatchTable,
    rejected: BatchWriter,
    unusable: BatchWriter,
    checkpoint: str,
    workdir: str,
    *,
    also: BatchWriter | None = None,
    metrics: BatchTable | None = None,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Landed responses to published events and to the constrained table.

    Every event is published, also one the table then rejects: publishing comes first and the two are not
    one transaction, so the published events are a superset of the table.
    """
    keep = ("id", "response", "arrival")
    parsed = parse_responses(responses).select(*keep, "user", "reason")

    def write(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            events = flatten_users(batch, keep=("id", "arrival"))
            publish(events.select(*EVENT_FIELDS), batch_id)
            write_constrained(events, batch_id, accepted, rejected, workdir, order="arrival", also=also, metrics=metrics)
            unusable(unusable_responses(batch, keep), batch_id)
        finally:
            batch.unpersist()

    return start(parsed, write, checkpoint, trigger=trigger)

