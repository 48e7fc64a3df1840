"""Command line: ``generate``, ``ingest``, ``transform``, ``sync`` and ``ddl``.

Topics are a Kafka cluster (``--kafka host:port``) or a folder (``--topics``).
Tables are a Cassandra keyspace (``--cassandra host``) or a folder (``--store``).
Indices are an Elasticsearch cluster (``--elasticsearch host``) or in the store.
"""

from __future__ import annotations

import argparse
import hashlib
import logging
import os
import sys
import threading
from collections.abc import Callable
from datetime import datetime
from functools import partial

from pyspark.sql import DataFrame, SparkSession

from tillstream.entities import ENTITIES, KEYSPACE, POSITION, Entity
from tillstream.operators.documents import FOREIGN_KEYS, MAPPERS
from tillstream.operators.transforms import step_for
from tillstream.jobs import side_by_side
from tillstream.plans.changes import sync_all_changed
from tillstream.plans.sync import sync_all, sync_listed, sync_table
from tillstream.sources import connectors, topics
from tillstream.sources.bulk import elastic_bulk
from tillstream.sources.generate import SEED, Sizes, generate_all
from tillstream.sources.keyed import Store
from tillstream.streaming.ingest import ALL_AVAILABLE, start_routed, start_topic
from tillstream.streaming.progress import ProgressLog
from tillstream.streaming.supervise import Start, Supervisor, drained_by

Writer = Callable[[DataFrame], None]

MESSAGES_PER_BATCH = 20_000_000


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="tillstream", description=__doc__)
    jobs = top.add_subparsers(dest="job", required=True)
    generate = jobs.add_parser("generate", help="publish made-up entities")
    for name, size in vars(Sizes()).items():
        generate.add_argument(f"--{name}", type=int, default=size)
    generate.add_argument("--seed", type=int, default=SEED)
    generate.add_argument("--as-of", type=datetime.fromisoformat, default=None)
    ingest = jobs.add_parser("ingest", help="all topics into raw tables")
    transform = jobs.add_parser("transform", help="each topic into its transformed table")
    sync = jobs.add_parser("sync", help="tables into search documents")
    sync.add_argument("--changed", action="store_true", help="only new and changed documents")
    jobs.add_parser("ddl", help="print the statements for the Cassandra tables")
    for job in (generate, ingest, transform):
        where = job.add_mutually_exclusive_group(required=True)
        where.add_argument("--kafka", metavar="SERVERS")
        where.add_argument("--topics", metavar="FOLDER")
    for job in (ingest, transform):
        job.add_argument("--checkpoints", metavar="FOLDER")
        job.add_argument("--once", action="store_true", help="stop after what is there now")
        job.add_argument("--per-batch", type=int, help="messages, or files of a topics folder")
        job.add_argument("--tasks", type=int, help="at least so many reading tasks per batch")
    for job in (ingest, transform, sync):
        job.add_argument("--store", metavar="FOLDER", required=True)
        job.add_argument("--buckets", type=int, required=True, help="fixed for a store's life")
        job.add_argument("--cassandra", metavar="HOST")
    sync.add_argument("--elasticsearch", metavar="HOST")
    sync.add_argument(
        "--list-refused",
        action="store_true",
        help="send documents without the connector and store those that the index refuses",
    )
    sync.add_argument("--raw", action="store_true", help="read the raw tables")
    sync.add_argument(
        "--merge-first",
        action="store_true",
        help="read the raw tables, then transform: a record whose latest version is "
        "filtered out is not synced with an older one",
    )
    sync.add_argument("--none-text", action="store_true", help="write null references as None")
    return top


def run_generate(spark: SparkSession, args: argparse.Namespace) -> bool:
    sizes = Sizes(args.products, args.customers, args.orders, args.transactions)
    as_of = args.as_of or datetime.now().replace(microsecond=0)
    made = generate_all(spark, as_of, sizes, args.seed)
    write = (
        connectors.kafka_writer(args.kafka) if args.kafka else topics.folder_writer(args.topics)
    )
    sent = [topics.publish(made[n], e.topic, write) for n, e in ENTITIES.items()]
    return all(d.error is None for d in sent)


def _messages(spark: SparkSession, args: argparse.Namespace, *names: str) -> DataFrame:
    """A long backlog is read in several batches, since a batch is kept while its
    tables are written."""
    if args.kafka:
        size = args.per_batch or MESSAGES_PER_BATCH
        return connectors.kafka_stream(spark, args.kafka, *names, per_batch=size, tasks=args.tasks)
    return topics.stream_folder(spark, args.topics, *names, files_per_batch=args.per_batch)


def _store(spark: SparkSession, args: argparse.Namespace) -> Store:
    folder = args.store if "://" in args.store else os.path.abspath(args.store)
    return Store(spark, KEYSPACE, folder.rstrip("/"), args.buckets).ensure()


def _target(args: argparse.Namespace, table: str, columns: list[str], own: Writer) -> Writer:
    if not args.cassandra:
        return own
    return connectors.cassandra_writer(KEYSPACE, table, columns, args.cassandra, by_position=True)


def run_ingest(spark: SparkSession, args: argparse.Namespace) -> bool:
    store = _store(spark, args)
    messages = _messages(spark, args, *[e.topic for e in ENTITIES.values()])
    writers = {
        name: _target(
            args, connectors.raw_name(entity), entity.columns, store.raw(entity).append_folded
        )
        for name, entity in ENTITIES.items()
    }
    draining = threading.Event()
    start = partial(
        start_routed,
        messages,
        writers,
        store.letters("raw").append,
        _checkpoints(args),
        trigger=_trigger(args),
        closed=draining.is_set,
    )
    return _run(spark, {"raw": start}, draining)


def run_transform(spark: SparkSession, args: argparse.Namespace) -> bool:
    store, starts, draining = _store(spark, args), {}, threading.Event()
    for name, entity in ENTITIES.items():
        table = store.table(entity)
        columns = table.versions(spark).drop(*POSITION).columns
        starts[name] = partial(
            start_topic,
            _messages(spark, args, entity.topic),
            entity,
            _target(args, name, columns, table.append_folded),
            store.letters(name).append,
            _checkpoints(args),
            trigger=_trigger(args),
            closed=draining.is_set,
        )
    return _run(spark, starts, draining)


def _checkpoints(args: argparse.Namespace) -> str:
    """By default with the store, apart for each job and source, so that a new store
    or other topics are read from the beginning."""
    source = hashlib.md5((args.kafka or args.topics).encode()).hexdigest()[:12]
    return args.checkpoints or f"{args.store}/_checkpoints/{args.job}/{source}"


def _trigger(args: argparse.Namespace) -> dict | None:
    return ALL_AVAILABLE if args.once else None


def _run(spark: SparkSession, starts: dict[str, Start], draining: threading.Event) -> bool:
    """Until all streams have ended or a signal drains them; whether none was given up."""
    supervisor = Supervisor(spark, starts, draining=draining)
    with drained_by(supervisor):
        return not any(supervisor.run().values())


def run_sync(spark: SparkSession, args: argparse.Namespace) -> bool:
    store = _store(spark, args)

    raw = args.raw or args.merge_first

    def read(entity: Entity) -> DataFrame:
        if args.cassandra:
            table = connectors.raw_name(entity) if raw else entity.name
            rows = connectors.cassandra_table(spark, KEYSPACE, table, args.cassandra)
        else:
            rows = (store.read_raw if raw else store.read)(entity)
        return step_for(entity.name)(rows) if args.merge_first else rows

    tables = {name: partial(read, entity) for name, entity in ENTITIES.items()}
    if args.changed:
        if args.elasticsearch:
            raise SystemExit("--changed compares with the store's own indices")
        found = sync_all_changed(store, tables, none_text=args.none_text)
        for report in found:
            logging.getLogger("tillstream").info("%s", report)
        return all(report.error is None for report in found)
    if args.list_refused:
        if not args.elasticsearch:
            raise SystemExit("--list-refused belongs to --elasticsearch")
        done = sync_listed(
            store,
            tables,
            lambda entity: elastic_bulk(args.elasticsearch, entity.index),
            none_text=args.none_text,
        )
    elif not args.elasticsearch:
        done = sync_all(store, tables, none_text=args.none_text)
    else:
        jobs = [
            partial(
                sync_table,
                tables[name],
                entity.index,
                MAPPERS[name],
                connectors.index_writer(args.elasticsearch, entity.index),
                none_text=FOREIGN_KEYS.get(name, ()) if args.none_text else (),
            )
            for name, entity in ENTITIES.items()
        ]
        done = side_by_side(spark, jobs)
    for report in done:
        logging.getLogger("tillstream").info(
            "%s: %d documents, %d without id, error: %s, %d refused", *vars(report).values()
        )
    return all(report.error is None for report in done)


JOBS = {
    "generate": run_generate,
    "ingest": run_ingest,
    "transform": run_transform,
    "sync": run_sync,
}


def main(arguments: list[str] | None = None) -> int:
    args = parser().parse_args(arguments)
    if args.job == "ddl":
        print(";\n".join(connectors.cassandra_ddl(KEYSPACE)) + ";")
        return 0
    logging.basicConfig(level=logging.INFO)
    spark = SparkSession.builder.appName(f"tillstream-{args.job}").getOrCreate()
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    progress = ProgressLog()
    spark.streams.addListener(progress)
    try:
        return 0 if JOBS[args.job](spark, args) else 1
    finally:
        spark.streams.removeListener(progress)


if __name__ == "__main__":
    outcome = main()
    SparkSession.builder.getOrCreate().stop()
    sys.exit(outcome)
