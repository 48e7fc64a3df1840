"""Syncing only what changed."""

from __future__ import annotations

from functools import partial

import pytest
from helpers import key, plan_of
from pyspark.sql import functions as F

from tillstream.entities import CUSTOMERS, PRODUCTS
from tillstream.operators.documents import MAPPERS, to_documents
from tillstream.plans.changes import (
    CHANGE,
    document_changes,
    gone_ids,
    sync_all_changed,
    sync_changed,
)

ROW = (
    "product_id string, title string, price float, category string, description string, stock int, "
    "timestamp timestamp, partition int, offset bigint"
)


def load(spark, store, offset, *rows):
    """(number, title, stock) as versions of products."""
    full = [(key(n), title, 1.5, "Books", None, stock, None, 0, offset) for n, title, stock in rows]
    frame = spark.createDataFrame(full, ROW)
    store.raw(PRODUCTS).append(frame.withColumn("timestamp", F.timestamp_seconds(F.lit(1_700_000_000))))


def stamps(store):
    rows = store.index(PRODUCTS).current(store.spark).collect()
    return {r.id: (r.title, r.stock, r.last_synced) for r in rows}


def test_only_new_and_changed_documents_are_written(spark, store):
    load(spark, store, 0, (1, "a", 1), (2, "b", None), (3, "c", 3))
    read = partial(store.read_raw, PRODUCTS)
    first = sync_changed(store, PRODUCTS, read, synced="s1")
    assert (first.new, first.changed, first.same, first.gone, first.error) == (3, 0, 0, 0, None)
    load(spark, store, 1, (1, "a", 1), (2, "b", 0), (4, "d", 4))
    again = sync_changed(store, PRODUCTS, read, synced="s2")
    assert (again.new, again.changed, again.same, again.gone) == (1, 1, 2, 0)
    assert stamps(store) == {
        key(1): ("a", 1, "s1"),
        key(2): ("b", 0, "s2"),
        key(3): ("c", 3, "s1"),
        key(4): ("d", 4, "s2"),
    }


def test_a_second_sync_of_the_same_writes_nothing(spark, store):
    load(spark, store, 0, *[(n, f"t{n}", n) for n in range(50)])
    read = partial(store.read_raw, PRODUCTS)
    sync_changed(store, PRODUCTS, read, synced="s1")
    held = store.index(PRODUCTS).versions(spark).count()
    report = sync_changed(store, PRODUCTS, read, synced="s2")
    assert (report.written, report.same) == (0, 50)
    assert store.index(PRODUCTS).versions(spark).count() == held == 50


def test_documents_that_are_gone_stay_and_are_listed(spark, store):
    load(spark, store, 0, (1, "a", 1), (2, "b", 2))
    sync_changed(store, PRODUCTS, partial(store.read_raw, PRODUCTS), synced="s1")
    report = sync_changed(
        store, PRODUCTS, lambda: store.read_raw(PRODUCTS).filter("stock > 1"), synced="s2"
    )
    assert (report.gone, report.same, report.written) == (1, 1, 0)
    assert set(stamps(store)) == {key(1), key(2)}
    assert [tuple(r) for r in store.gone(PRODUCTS).current(spark).collect()] == [(key(1), "s2")]


def test_changes_need_no_exchange(spark, store):
    load(spark, store, 0, *[(n, f"t{n}", n) for n in range(20)])
    sync_changed(store, PRODUCTS, partial(store.read_raw, PRODUCTS), synced="s1")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        documents = to_documents(store.read_raw(PRODUCTS), MAPPERS["products"], "s2")
        indexed = store.index(PRODUCTS).current(spark)
        for frame in (document_changes(documents, indexed), gone_ids(documents, indexed)):
            assert "Exchange" not in plan_of(frame)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("before, after", [(None, 0), (0, None), (1, 2)])
def test_a_null_is_a_value(spark, before, after):
    def frame(stock):
        return spark.createDataFrame([("x", "t", stock, "s")], "id string, title string, stock int, last_synced string")

    assert document_changes(frame(after), frame(before)).first()[CHANGE] == "changed"
    assert document_changes(frame(after), frame(after)).first()[CHANGE] == "same"


def test_a_failing_table_leaves_the_others_alone(spark, store):
    def broken():
        raise RuntimeError("no such table")

    rows = spark.createDataFrame([(key(1), "n", "e", None, "l", "Gold")], CUSTOMERS.message)
    good, bad = sync_all_changed(store, {"customers": lambda: rows, "products": broken}, synced="s1")
    assert (good.new, good.error) == (1, None) and "no such table" in bad.error
