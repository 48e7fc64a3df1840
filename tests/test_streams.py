"""Streams: same result as batch, restart, replay, failure."""

from __future__ import annotations

import pytest
from helpers import key, land_file, messages, order, product
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from tillstream.entities import ENTITIES, ORDERS, PRODUCTS
from tillstream.functions.wire import decode, rejected
from tillstream.operators.transforms import sellable_products, standing_orders
from tillstream.sources.topics import stream_folder
from tillstream.streaming import ingest
from tillstream.streaming.append import start_append
from tillstream.streaming.ingest import (
    ALL_AVAILABLE,
    finish_all,
    start_all,
    start_raw,
    start_routed,
    start_topic,
    stop_all,
    wait_all,
)


@pytest.fixture
def topics(tmp_path):
    return tmp_path / "topics"


def run_topic(spark, store, topics, tmp_path, entity, checkpoints="cp", reports=None):
    collected = [] if reports is None else reports
    query = start_topic(
        stream_folder(spark, str(topics), entity.topic),
        entity,
        store.table(entity).append,
        store.letters(entity.name).append,
        str(tmp_path / checkpoints),
        name=f"{store.database}_{entity.name}",
        trigger=ALL_AVAILABLE,
        report=collected.append,
    )
    wait_all([query])
    return collected


def test_stream_gives_the_batch_result(spark, store, topics, tmp_path):
    sent = messages(
        spark,
        PRODUCTS.topic,
        [product(1), product(2, stock=0), product(3, stock=None), "{bad", None, product(4)],
    )
    land_file(sent, topics)
    reports = run_topic(spark, store, topics, tmp_path, PRODUCTS)
    batch = sellable_products(decode(sent, PRODUCTS))
    columns = sorted(batch.columns)
    assert sorted(store.read(PRODUCTS).select(columns).collect()) == sorted(
        batch.select(columns).collect()
    )
    assert [(r.read, r.rejected) for r in reports] == [(5, 1)]
    letters = store.letters("products").current(spark).collect()
    assert [(bytes(r.value), r.reason, r.offset) for r in letters] == [
        (b"{bad", "missing product_id", 3)
    ]


def test_restart_reads_only_what_is_new(spark, store, topics, tmp_path):
    land_file(messages(spark, PRODUCTS.topic, [product(1)]), topics)
    run_topic(spark, store, topics, tmp_path, PRODUCTS)
    assert run_topic(spark, store, topics, tmp_path, PRODUCTS) == []
    land_file(messages(spark, PRODUCTS.topic, [product(1, title="new")], start=1), topics)
    reports = run_topic(spark, store, topics, tmp_path, PRODUCTS)
    assert [r.read for r in reports] == [1]
    assert [r.title for r in store.read(PRODUCTS).collect()] == ["new"]


def test_replay_leaves_the_table_unchanged(spark, store, topics, tmp_path):
    sent = [product(n % 3, title=f"v{n}") for n in range(9)] + ["{bad"]
    land_file(messages(spark, PRODUCTS.topic, sent), topics)
    run_topic(spark, store, topics, tmp_path, PRODUCTS, "first")
    once = sorted(store.read(PRODUCTS).collect())
    run_topic(spark, store, topics, tmp_path, PRODUCTS, "second")
    assert sorted(store.read(PRODUCTS).collect()) == once
    assert {r.title for r in once} == {"v6", "v7", "v8"}
    assert store.letters("products").current(spark).count() == 1


def test_one_key_has_one_spelling(spark, store, topics, tmp_path):
    upper = product(0xABC, product_id=key(0xABC).upper(), title="second")
    land_file(messages(spark, PRODUCTS.topic, [product(0xABC), upper]), topics)
    run_topic(spark, store, topics, tmp_path, PRODUCTS)
    assert [(r.product_id, r.title) for r in store.read(PRODUCTS).collect()] == [
        (key(0xABC), "second")
    ]


def test_cancelled_order_keeps_its_last_standing_version(spark, store, topics, tmp_path):
    sent = [order(1), order(1, status="Cancelled"), order(2, status="Cancelled")]
    land_file(messages(spark, ORDERS.topic, sent), topics)
    run_topic(spark, store, topics, tmp_path, ORDERS)
    assert [(r.order_id, r.status) for r in store.read(ORDERS).collect()] == [(key(1), "Pending")]
    everything = stream_folder(spark, str(topics))
    wait_all([start_raw(everything, store, str(tmp_path / "cp"), trigger=ALL_AVAILABLE)])
    assert standing_orders(store.read_raw(ORDERS)).count() == 0


def test_a_batch_without_any_record(spark, store, topics, tmp_path):
    land_file(messages(spark, PRODUCTS.topic, [None, None]), topics)
    reports = run_topic(spark, store, topics, tmp_path, PRODUCTS)
    assert [(r.read, r.rejected) for r in reports] == [(0, 0)]
    land_file(messages(spark, PRODUCTS.topic, ["", "{"], start=2), topics)
    reports = run_topic(spark, store, topics, tmp_path, PRODUCTS)
    assert [(r.read, r.rejected) for r in reports] == [(2, 2)]
    assert store.read(PRODUCTS).count() == 0


def test_four_streams_side_by_side(spark, store, topics, tmp_path):
    land_file(messages(spark, PRODUCTS.topic, [product(n) for n in range(5)]), topics)
    land_file(messages(spark, ORDERS.topic, [order(n) for n in range(7)]), topics)
    sources = {n: stream_folder(spark, str(topics), e.topic) for n, e in ENTITIES.items()}
    queries = start_all(sources, store, str(tmp_path / "cp"), trigger=ALL_AVAILABLE)
    assert sorted(q.name for q in queries) == sorted(f"{store.database}_{n}" for n in ENTITIES)
    wait_all(queries)
    assert {n: store.read(e).count() for n, e in ENTITIES.items()} == {
        "products": 5,
        "customers": 0,
        "orders": 7,
        "transactions": 0,
    }


def test_routed_stream_in_several_batches(spark, store, topics, tmp_path):
    for start in range(3):
        land_file(messages(spark, PRODUCTS.topic, [product(1, title=f"v{start}")], start), topics)
        pair = [order(start), order(9, product_id=None)]
        land_file(messages(spark, ORDERS.topic, pair, 2 * start), topics)
    reports = []
    stream = stream_folder(spark, str(topics), files_per_batch=1)
    checkpoints = str(tmp_path / "cp")
    query = start_raw(
        stream, store, checkpoints, trigger=ALL_AVAILABLE, report=reports.append
    )
    wait_all([query])
    assert len(reports) == 6 and sum(r.read for r in reports) == 9
    assert [r.title for r in store.read_raw(PRODUCTS).collect()] == ["v2"]
    assert store.read_raw(ORDERS).count() == 3
    assert store.letters("raw").current(spark).count() == 3


def test_failure_is_raised_at_once_and_work_resumes(spark, store, topics, tmp_path):
    land_file(messages(spark, PRODUCTS.topic, [product(1)]), topics)

    def broken(_):
        raise RuntimeError("disk full")

    def start(write, name):
        return start_topic(
            stream_folder(spark, str(topics), PRODUCTS.topic),
            PRODUCTS,
            write,
            store.letters("products").append,
            str(tmp_path / "cp"),
            name=name,
            trigger=ALL_AVAILABLE,
        )

    endless = (
        spark.readStream.format("rate").load().writeStream.format("noop")
        .option("checkpointLocation", str(tmp_path / "rate")).start()
    )
    failing = start(broken, f"{store.database}_p")
    with pytest.raises(StreamingQueryException, match="disk full"):
        wait_all([endless, failing])
    assert endless.isActive
    stop_all([endless, failing])
    assert not endless.isActive
    wait_all([start(store.table(PRODUCTS).append, f"{store.database}_p")])
    assert store.read(PRODUCTS).count() == 1


def test_append_stream_writes_each_row_once(spark, tmp_path):
    source = tmp_path / "in"
    spark.range(10).write.parquet(str(source))

    def run():
        rows = spark.readStream.schema("id bigint").parquet(str(source))
        start_append(
            rows,
            lambda frame: frame.filter(F.col("id") % 2 == 0),
            str(tmp_path / "out"),
            str(tmp_path / "cp"),
            name="append_test",
            trigger=ALL_AVAILABLE,
        ).awaitTermination()
        return sorted(r.id for r in spark.read.parquet(str(tmp_path / "out")).collect())

    assert run() == run() == [0, 2, 4, 6, 8]


def test_batch_that_fails_after_its_first_table(spark, store, topics, tmp_path):
    """Products are written twice, orders once; the tables do not show it."""
    land_file(messages(spark, PRODUCTS.topic, [product(1), product(2)]), topics)
    land_file(messages(spark, ORDERS.topic, [order(1), "{bad"]), topics)

    def broken(_):
        raise RuntimeError("lost node")

    def run(orders_writer):
        writers = {
            "products": store.raw(PRODUCTS).append_folded,
            "orders": orders_writer or store.raw(ORDERS).append_folded,
        }
        wait_all(
            [
                start_routed(
                    stream_folder(spark, str(topics)),
                    writers,
                    store.letters("raw").append,
                    str(tmp_path / "cp"),
                    name=f"{store.database}_raw",
                    trigger=ALL_AVAILABLE,
                )
            ]
        )

    with pytest.raises(StreamingQueryException, match="lost node"):
        run(broken)
    run(None)
    assert store.raw(PRODUCTS).versions(spark).count() == 4
    assert store.read_raw(PRODUCTS).count() == 2
    assert store.read_raw(ORDERS).count() == 1
    assert store.letters("raw").current(spark).count() == 1


class Ended:
    def __init__(self, fails: bool, active: bool):
        self.fails, self.isActive, self.stopped = fails, active, False

    def awaitTermination(self):
        if self.fails:
            raise RuntimeError("lost")

    def stop(self):
        self.stopped = True


def test_a_failing_stream_stops_the_others():
    fine, broken, running = Ended(False, False), Ended(True, False), Ended(False, True)
    with pytest.raises(RuntimeError, match="lost"):
        finish_all([fine, running, broken])
    assert running.stopped


def test_a_batch_keeps_the_bytes_of_rejected_messages_only(spark, store, tmp_path, monkeypatch):
    land_file(messages(spark, PRODUCTS.topic, [product(1), "{bad"]), tmp_path / "topics")
    kept = []
    monkeypatch.setattr(
        ingest, "rejected", lambda seen: kept.extend(seen.collect()) or rejected(seen)
    )
    start_topic(
        stream_folder(spark, str(tmp_path / "topics")),
        PRODUCTS,
        lambda rows: None,
        store.letters("products").append,
        str(tmp_path / "cp"),
        trigger=ALL_AVAILABLE,
    ).awaitTermination()
    [letter] = store.letters("products").current(spark).collect()
    assert bytes(letter.value) == b"{bad"
    assert sorted((r.product_id, r.value is None) for r in kept if r.product_id) == [(key(1), True)]
