"""Command line for spark-submit.

  stream     messages to stored users and a quarantine
  ingest     landed API responses to published events and the constrained table
  counts     messages to totals by country, gender and year, kept current
  resent     messages to messages without those sent again within a time bound
  dashboard  the data set of each figure, written as Parquet
"""

from __future__ import annotations

import argparse
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from rollcall.operators.codec import parse_messages, records
from rollcall.operators.resent import seen_schema

from rollcall.plans.dashboard import dashboard, figures
from rollcall.schemas import CONSTRAINED, COUNTED, EVENT, STORED
from rollcall.sinks.batches import BatchTable, SlotTable
from rollcall.sinks.ddl import create_if_absent
from rollcall.sinks.stores import keyed_store, once_store, topic
from rollcall.sources.fetched import fetched_responses
from rollcall.sources.messages import file_messages, kafka_messages
from rollcall.sources.responses import responses_from_files, responses_from_messages, responses_from_table
from rollcall.sources.tables import load_users
from rollcall.streaming import jobs
from rollcall.streaming.limits import run_for, seconds
from rollcall.streaming.tables import CHECKED, COUNTS, METRICS, REJECTED, SNAPSHOT, UNREADABLE, UNUSABLE
from rollcall.workspace import new_folder, remove_folder


def _options(pairs: list[str]) -> dict[str, str]:
    return dict(pair.split("=", 1) for pair in pairs)


def _trigger(spark: SparkSession, args) -> dict:
    trigger = {"processingTime": args.every} if args.every else {"availableNow": True}
    return trigger | ({"limit": seconds(spark, args.limit)} if args.limit else {})


def _finish(spark: SparkSession, query: StreamingQuery, args) -> None:
    """Wait for the job's end, or stop it between two batches once its time is over."""
    if args.limit:
        run_for(query, seconds(spark, args.limit))
    else:
        query.awaitTermination()


def _messages(spark: SparkSession, args) -> DataFrame:
    bound = {"max_per_trigger": args.max_per_trigger} if args.max_per_trigger else {}
    if args.servers:
        return kafka_messages(spark, args.servers, args.topic, **bound, **_options(args.source_option))
    return file_messages(spark, args.source, **bound)


def stream(spark: SparkSession, args) -> None:
    unreadable = BatchTable(spark, f"{args.out}/unreadable", UNREADABLE).replace
    if args.format:
        store = keyed_store(args.format, **_options(args.option))
    else:
        name = create_if_absent(spark, args.namespace, "users", STORED, f"{args.out}/{args.namespace}", batches=f"{args.out}/users") if args.namespace else None
        store = BatchTable(spark, f"{args.out}/users", STORED, catalog=name).replace
    checkpoint = f"{args.out}/checkpoint"
    query = jobs.store_messages(
        _messages(spark, args),
        store,
        unreadable,
        checkpoint,
        include_unreadable=args.include_unreadable,
        counts=BatchTable(spark, f"{args.out}/counts", COUNTS),
        metrics=BatchTable(spark, f"{args.out}/metrics", METRICS),
        trigger=_trigger(spark, args),
    )
    _finish(spark, query, args)


def ingest(spark: SparkSession, args) -> None:
    bound = {"streaming": True, "max_per_trigger": args.max_per_trigger}
    if args.fetch:
        bound = {"perBatch": str(args.max_per_trigger)} if args.max_per_trigger else {}
        responses = fetched_responses(spark, args.fetch, f"{args.out}/landing", **bound, **_options(args.source_option))
    elif args.landing:
        responses = responses_from_files(spark, args.landing, **bound, **_options(args.source_option))
    elif args.landing_table:
        responses = responses_from_table(spark, args.landing_table, **bound, **_options(args.source_option))
    else:
        responses = responses_from_messages(_messages(spark, args))
    query = jobs.ingest_responses(
        responses,
        topic(args.format or "kafka", **_options(args.option)),
        BatchTable(spark, f"{args.out}/users", CONSTRAINED),
        BatchTable(spark, f"{args.out}/rejected", REJECTED).replace,
        BatchTable(spark, f"{args.out}/unusable", UNUSABLE).replace,
        f"{args.out}/checkpoint",
        new_folder(spark, "ingest"),
        also=once_store(spark, args.table_format, f"{args.out}/ledger", **_options(args.table_option)) if args.table_format else None,
        metrics=BatchTable(spark, f"{args.out}/metrics", CHECKED),
        trigger=_trigger(spark, args),
    )
    _finish(spark, query, args)


def counts(spark: SparkSession, args) -> None:
    """The newest totals are the last batch of the table `totals`."""
    users = records(parse_messages(_messages(spark, args), COUNTED, keep=()), keep=())
    snapshots = BatchTable(spark, f"{args.out}/totals", SNAPSHOT).snapshot
    _finish(spark, jobs.count_users(users, snapshots, f"{args.out}/checkpoint", trigger=_trigger(spark, args)), args)


def resent(spark: SparkSession, args) -> None:
    users = records(parse_messages(_messages(spark, args), EVENT, keep=("timestamp",)), keep=("timestamp",))
    keys = args.key or ["email"]
    kept = BatchTable(spark, f"{args.out}/kept", users.schema)
    seen = SlotTable(spark, f"{args.out}/seen", seen_schema(users.schema, keys))
    within = timedelta(minutes=args.within)
    _finish(spark, jobs.drop_resent(users, keys, within, kept.replace, seen, f"{args.out}/checkpoint", trigger=_trigger(spark, args)), args)


def show(spark: SparkSession, args) -> None:
    known = spark.read.parquet(args.known) if args.known else None
    work = new_folder(spark, "dashboard")
    if args.counts:
        frames = figures(load_users(spark, path=args.counts), known, args.top)
    else:
        frames = dashboard(load_users(spark, args.format or "parquet", **_options(args.option)), work, known, args.top)
    for name, frame in frames.items():
        frame.write.mode("overwrite").parquet(f"{args.out}/{name}")
    remove_folder(spark, work)


def main(arguments: list[str] | None = None, spark: SparkSession | None = None) -> None:
    parser = argparse.ArgumentParser(prog="rollcall", description=__doc__, formatter_class=argparse.RawTextHelpFormatter)
    commands = parser.add_subparsers(required=True)
    for name, run in (("stream", stream), ("ingest", ingest), ("counts", counts), ("resent", resent), ("dashboard", show)):
        command = commands.add_parser(name)
        command.set_defaults(run=run)
        command.add_argument("--out", required=True, help="folder of the tables and the checkpoint")
        command.add_argument("--format", help="connector of the external store or topic")
        command.add_argument("--option", action="append", default=[], metavar="NAME=VALUE", help="connector option")
        if run is show:
            command.add_argument("--known", help="folder of a Parquet table with the countries a map knows")
            command.add_argument("--counts", help="folder of the counts a stream has written per batch, instead of the users")
            command.add_argument("--top", type=int, default=10, help="rows of top_countries")
            continue
        command.add_argument("--servers", help="Kafka bootstrap servers")
        command.add_argument("--topic")
        command.add_argument("--source", help="folder of message files, instead of --servers")
        command.add_argument("--source-option", action="append", default=[], metavar="NAME=VALUE", help="option of the Kafka or file source")
        command.add_argument("--max-per-trigger", type=int, help="bound of a micro-batch: offsets, or files")
        command.add_argument("--for", dest="limit", help="stop between two batches after this time, e.g. '60 seconds'")
        command.add_argument("--every", help="keep running and start a batch this often, e.g. '10 seconds'")
        if run is stream:
            command.add_argument("--include-unreadable", action="store_true", help="store them as rows of NULLs too")
            command.add_argument("--namespace", help="namespace in which to create the table of users where absent")
        elif run is resent:
            command.add_argument("--key", action="append", help="field that copies have in common; email if not given")
            command.add_argument("--within", type=int, default=60, help="minutes within which a copy counts as sent again")
        elif run is ingest:
            command.add_argument("--table-format", help="connector of a store that gets the constrained rows as well")
            command.add_argument("--table-option", action="append", default=[], metavar="NAME=VALUE", help="its options")
            command.add_argument("--fetch", metavar="MODULE:FUNCTION", help="fetch responses, e.g. rollcall.sources.fetched:http with --source-option fetch.url=...")
            command.add_argument("--landing", help="folder of response files, one response each")
            command.add_argument("--landing-table", help="folder of Parquet files with a response column")
    args = parser.parse_args(arguments)
    args.run(spark or SparkSession.builder.appName("rollcall").getOrCreate(), args)


if __name__ == "__main__":
    main()
