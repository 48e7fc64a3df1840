"""From message streams to tables.

Two ways in, as two sets of tables:

* one query per topic, lenient parse, entity step, transformed tables;
* one query over all topics, full contract, raw tables.

Every query has a name and a checkpoint folder of its own, so a restart goes on
where the last run stopped. A batch that is written twice leaves the tables
unchanged, because they keep the latest version of each key.
"""

from __future__ import annotations

import logging
import time
from collections.abc import Callable, Iterable
from dataclasses import dataclass
from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tillstream.entities import ENTITIES, POSITION, Entity
from tillstream.functions.wire import (
    REASON,
    accepted,
    grade_lenient,
    rejected,
)
from tillstream.jobs import side_by_side
from tillstream.operators.latest import latest_per_key
from tillstream.operators.routing import grade_by_topic, live_messages, records_of
from tillstream.operators.transforms import Step, step_for
from tillstream.sources.keyed import LETTER_COLUMNS, Store
from tillstream.workspace import DROP_SHUFFLES

log = logging.getLogger(__name__)

Writer = Callable[[DataFrame], None]
ENVELOPE = ("topic", *POSITION, "value")
ALL_AVAILABLE = {"availableNow": True}


@dataclass(frozen=True)
class BatchReport:
    """What became of the messages of one batch."""

    query: str
    batch: int
    read: int
    rejected: int


Report = Callable[[BatchReport], None]
Closed = Callable[[], bool]


class Drained(RuntimeError):
    """A batch was not begun, because the stream is being drained."""


def never() -> bool:
    return False


def write_log(report: BatchReport) -> None:
    log.info("%s batch %d: %d read, %d rejected", *vars(report).values())


def start_topic(
    messages: DataFrame,
    entity: Entity,
    write: Writer,
    write_rejected: Writer,
    checkpoints: str,
    *,
    name: str | None = None,
    step: Step | None = None,
    trigger: dict | None = None,
    report: Report = write_log,
    closed: Closed = never,
) -> StreamingQuery:
    """Parse, transform and store the messages of one topic.

    ``write`` receives at most one row per key and batch, the latest, together
    with its position in the topic. While ``closed`` says so no further batch is begun:
    the query then ends by ``Drained``, at a batch's border.
    """
    name, step = name or entity.name, step or step_for(entity.name)
    graded = grade_lenient(live_messages(messages).select(*ENVELOPE), entity)

    def land(batch: DataFrame) -> None:
        kept = accepted(batch).drop("topic", "value", REASON)
        write(latest_per_key(step(kept), [entity.key], POSITION))

    return _start(graded, name, [land], write_rejected, checkpoints, trigger, report, closed)


def start_routed(
    messages: DataFrame,
    writers: dict[str, Writer],
    write_rejected: Writer,
    checkpoints: str,
    *,
    name: str = "raw",
    trigger: dict | None = None,
    report: Report = write_log,
    closed: Closed = never,
) -> StreamingQuery:
    """One subscription over many topics; each message goes to its entity's writer."""
    entities = [ENTITIES[n] for n in writers]
    graded = grade_by_topic(messages.select(*ENVELOPE), entities)

    def lander(entity: Entity) -> Writer:
        def land(batch: DataFrame) -> None:
            records = records_of(batch, entity, *POSITION)
            writers[entity.name](latest_per_key(records, [entity.key], POSITION))

        return land

    landers = [lander(e) for e in entities]
    return _start(graded, name, landers, write_rejected, checkpoints, trigger, report, closed)


def _start(
    graded: DataFrame,
    name: str,
    landers: list[Writer],
    write_rejected: Writer,
    checkpoints: str,
    trigger: dict | None,
    report: Report,
    closed: Closed,
) -> StreamingQuery:
    def on_batch(batch: DataFrame, number: int) -> None:
        if closed():
            raise Drained(f"{name} is drained before batch {number}")
        # Messages are fetched and parsed once per batch, by the count, and kept
        # for all writes below.
        seen = batch.persist()
        # The session is the stream's own.
        batch.sparkSession.conf.set(DROP_SHUFFLES, "true")
        try:
            read, bad = seen.agg(F.count(F.lit(1)), F.count(REASON)).first()
            if bad < read:
                side_by_side(batch.sparkSession, [partial(land, seen) for land in landers])
            if bad:
                write_rejected(rejected(seen).select(*LETTER_COLUMNS))
            report(BatchReport(name, number, read, bad))
        finally:
            seen.unpersist()

    # A batch is kept without the bytes of the messages that were read: only rejected ones
    # are written again.
    refused = F.when(F.col(REASON).isNotNull(), F.col("value"))
    writer = (
        graded.withColumn("value", refused)
        .writeStream.queryName(name)
        .option("checkpointLocation", f"{checkpoints}/{name}")
        .outputMode("append")
        .foreachBatch(on_batch)
    )
    return (writer.trigger(**trigger) if trigger else writer).start()


def start_all(
    sources: dict[str, DataFrame],
    store: Store,
    checkpoints: str,
    *,
    trigger: dict | None = None,
    report: Report = write_log,
) -> list[StreamingQuery]:
    """One query per topic, all running side by side."""
    return [
        start_topic(
            sources[name],
            entity,
            store.table(entity).append_folded,
            store.letters(name).append,
            checkpoints,
            name=f"{store.database}_{name}",
            trigger=trigger,
            report=report,
        )
        for name, entity in ENTITIES.items()
    ]


def start_raw(
    messages: DataFrame,
    store: Store,
    checkpoints: str,
    *,
    trigger: dict | None = None,
    report: Report = write_log,
) -> StreamingQuery:
    """All topics into the raw tables of ``store``."""
    writers = {name: store.raw(entity).append_folded for name, entity in ENTITIES.items()}
    return start_routed(
        messages,
        writers,
        store.letters("raw").append,
        checkpoints,
        name=f"{store.database}_raw",
        trigger=trigger,
        report=report,
    )


def wait_all(queries: Iterable[StreamingQuery], pause: float = 0.2) -> None:
    """Wait until every query has ended; raise as soon as any one fails."""
    running = list(queries)
    while running:
        for query in list(running):
            if not query.isActive:
                query.awaitTermination()  # raises what the query died of
                running.remove(query)
        time.sleep(pause if running else 0)


def finish_all(queries: Iterable[StreamingQuery]) -> None:
    """Wait for all; when one fails, stop the others before it is raised."""
    queries = list(queries)
    try:
        wait_all(queries)
    finally:
        stop_all(queries)


def stop_all(queries: Iterable[StreamingQuery]) -> None:
    for query in queries:
        query.stop()
