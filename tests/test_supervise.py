"""Restarts, draining, and streams of changes only."""

from __future__ import annotations

import os
import signal
import threading
import time
from datetime import datetime

import pandas as pd
import pytest
from helpers import key, land_file, messages, order, product
from pyspark.sql import functions as F

from tillstream.entities import ORDERS, PRODUCTS
from tillstream.functions.wire import accepted, grade_lenient
from tillstream.sources.topics import stream_folder
from tillstream.streaming.changes import COLUMNS, judging, read_changes, start_changes
from tillstream.streaming.ingest import ALL_AVAILABLE, never, start_topic
from tillstream.streaming.supervise import Supervisor, drained_by


@pytest.fixture
def topics(tmp_path):
    return tmp_path / "topics"


def starter(
    spark, store, topics, entity, write, place, trigger=ALL_AVAILABLE, per_batch=1000, closed=never
):
    def start():
        return start_topic(
            stream_folder(spark, str(topics), entity.topic, files_per_batch=per_batch),
            entity,
            write,
            store.letters(entity.name).append,
            str(place / "cp"),
            name=f"{store.database}_{entity.name}",
            trigger=trigger,
            closed=closed,
        )

    return start


def test_a_failed_stream_starts_again_while_others_run(spark, store, topics, tmp_path):
    land_file(messages(spark, PRODUCTS.topic, [product(1), product(2)]), topics)
    land_file(messages(spark, ORDERS.topic, [order(1)]), topics)
    tries = []

    def twice_broken(rows):
        tries.append(time.monotonic())
        if len(tries) < 3:
            raise RuntimeError("store is away")
        store.table(PRODUCTS).append(rows)

    starts = {
        "products": starter(spark, store, topics, PRODUCTS, twice_broken, tmp_path),
        "orders": starter(spark, store, topics, ORDERS, store.table(ORDERS).append, tmp_path),
    }
    assert Supervisor(spark, starts, pause=0.5).run() == {"products": None, "orders": None}
    assert len(tries) == 3 and tries[2] - tries[1] > 1.0 > 0.5 < tries[1] - tries[0]
    assert store.read(PRODUCTS).count() == 2 and store.read(ORDERS).count() == 1


def test_a_stream_that_keeps_failing_is_given_up(spark, store, topics, tmp_path):
    land_file(messages(spark, PRODUCTS.topic, [product(1)]), topics)
    land_file(messages(spark, ORDERS.topic, [order(1)]), topics)

    def broken(_):
        raise RuntimeError("disk full")

    def never():
        raise ValueError("no such topic")

    starts = {
        "products": starter(spark, store, topics, PRODUCTS, broken, tmp_path),
        "orders": starter(spark, store, topics, ORDERS, store.table(ORDERS).append, tmp_path),
        "unknown": never,
    }
    errors = Supervisor(spark, starts, restarts=1, pause=0.1).run()
    assert "disk full" in errors["products"] and "no such topic" in errors["unknown"]
    assert errors["orders"] is None and store.read(ORDERS).count() == 1


def test_a_signal_drains_at_a_batch_border(spark, store, topics, tmp_path):
    for n in range(6):
        land_file(messages(spark, PRODUCTS.topic, [product(n)], start=n), topics)
    begun, finished = [], []

    def slow(rows):
        begun.append(1)
        if len(begun) == 2:
            os.kill(os.getpid(), signal.SIGTERM)
        time.sleep(0.5)
        store.table(PRODUCTS).append(rows)
        finished.append(1)

    def run(write, trigger):
        draining = threading.Event()
        start = starter(
            spark, store, topics, PRODUCTS, write, tmp_path, trigger, 1, draining.is_set
        )
        supervisor = Supervisor(spark, {"products": start}, draining=draining)
        with drained_by(supervisor):
            return supervisor.run()

    assert run(slow, {"processingTime": "1 second"}) == {"products": None}
    assert len(begun) == len(finished) == 2
    assert store.table(PRODUCTS).versions(spark).count() == len(finished)
    assert signal.getsignal(signal.SIGTERM) is not None
    run(store.table(PRODUCTS).append, ALL_AVAILABLE)
    assert store.table(PRODUCTS).versions(spark).count() == 6
    assert store.read(PRODUCTS).count() == 6


def test_draining_from_another_thread_ends_an_endless_stream(spark, tmp_path):
    def endless():
        rows = spark.readStream.format("rate").load()
        return (
            rows.writeStream.format("noop").option("checkpointLocation", str(tmp_path / "rate")).start()
        )

    supervisor = Supervisor(spark, {"rate": endless})
    threading.Timer(3.0, supervisor.drain).start()
    assert supervisor.run() == {"rate": None} and not supervisor.queries


def changes(spark, topics, place):
    sent = stream_folder(spark, str(topics), PRODUCTS.topic)
    start_changes(
        accepted(grade_lenient(sent, PRODUCTS)),
        PRODUCTS,
        str(place / "changes"),
        str(place / "cp"),
        name="changes_test",
        trigger=ALL_AVAILABLE,
    ).awaitTermination()
    rows = read_changes(spark, PRODUCTS, str(place / "changes")).collect()
    return sorted(((r.product_id, r.title, r.stock, r.offset) for r in rows), key=repr)


def test_replays_and_repeats_change_nothing(spark, topics, tmp_path):
    land_file(messages(spark, PRODUCTS.topic, [product(1, title="a"), product(2, stock=None)]), topics)
    first = changes(spark, topics, tmp_path)
    assert first == [(key(1), "a", 3, 0), (key(2), "thing 2", None, 1)]
    # The same again, in a later message and in the same one.
    land_file(messages(spark, PRODUCTS.topic, [product(1, title="a")], start=5), topics)
    land_file(messages(spark, PRODUCTS.topic, [product(1, title="a"), product(2, stock=None)]), topics)
    assert changes(spark, topics, tmp_path) == first
    # A late version, a real change, and one that is undone within its batch.
    late, now = product(1, title="late"), product(2, stock=7)
    land_file(messages(spark, PRODUCTS.topic, [late], start=4), topics)
    land_file(messages(spark, PRODUCTS.topic, [now, product(1, title="b"), product(1, title="a")], start=6), topics)
    assert changes(spark, topics, tmp_path) == sorted([*first, (key(2), "thing 2", 7, 6)], key=repr)


def test_changes_keep_every_value(spark, topics, tmp_path):
    land_file(messages(spark, ORDERS.topic, [order(1, order_date="2024-01-02T03:04:05.000007")]), topics)
    sent = stream_folder(spark, str(topics), ORDERS.topic)
    start_changes(
        accepted(grade_lenient(sent, ORDERS)), ORDERS, str(tmp_path / "o"), str(tmp_path / "cp"),
        name="changes_orders", trigger=ALL_AVAILABLE,
    ).awaitTermination()
    row = read_changes(spark, ORDERS, str(tmp_path / "o")).withColumn(
        "order_date", F.col("order_date").cast("timestamp_ntz")
    ).first()
    assert row.order_date == datetime(2024, 1, 2, 3, 4, 5, 7) and row.quantity == 2
    assert row.timestamp is not None and row.offset == 0


def test_keys_share_the_groups_of_the_state(spark, topics, tmp_path, monkeypatch):
    monkeypatch.setattr("tillstream.streaming.changes.SLOTS", 2)
    land_file(messages(spark, PRODUCTS.topic, [product(n) for n in range(1, 41)]), topics)
    first = changes(spark, topics, tmp_path)
    assert len(first) == 40
    land_file(messages(spark, PRODUCTS.topic, [product(n) for n in range(1, 41)], start=50), topics)
    land_file(messages(spark, PRODUCTS.topic, [product(7, title="x")], start=100), topics)
    assert changes(spark, topics, tmp_path) == sorted([*first, (key(7), "x", 3, 100)], key=repr)


class Held:
    """A group's state at a time of our choice."""

    def __init__(self):
        self.now, self.hasTimedOut, self.get, self.due = 0, False, None, None

    exists = property(lambda self: self.get is not None)

    def getCurrentProcessingTimeMs(self):
        return self.now

    def update(self, value):
        self.get = value

    def remove(self):
        self.get = None

    def setTimeoutDuration(self, wait):
        self.due = self.now + wait


def test_each_key_of_a_slot_is_forgotten_in_its_own_time():
    state, judge = Held(), judging(100)

    def passed(now, *rows, timed_out=False):
        state.now, state.hasTimedOut = now, timed_out
        frames = [pd.DataFrame([(i, 1, 0, o, d, d) for i, o, d in rows], columns=COLUMNS)] if rows else []
        return [row.id for frame in judge((0,), iter(frames), state) for row in frame.itertuples()]

    assert passed(0, ("a", 1, "x"), ("b", 1, "x")) == ["a", "b"] and state.due == 100
    assert passed(60, ("b", 1, "x")) == [] and state.due == 100
    assert passed(110, timed_out=True) == [] and state.due == 160
    assert passed(120, ("a", 1, "x"), ("b", 1, "x")) == ["a"]
    assert passed(300, timed_out=True) == [] and not state.exists
