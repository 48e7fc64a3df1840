"""Keyed tables: declared once, appended, read as one row per key."""

from __future__ import annotations

from datetime import datetime

import pytest
from helpers import key, plan_of
from pyspark.sql import functions as F

from tillstream import workspace
from tillstream.entities import PRODUCTS
from tillstream.sources.keyed import LETTER_DDL, Store

ROW = (
    "product_id string, title string, price float, category string, description string, "
    "stock int, timestamp timestamp, partition int, offset bigint"
)


def versions(spark, *rows):
    """(number, title, offset) triples; column order differs from the table's."""
    full = [(key(n), title, 1.5, "Books", "d", 1, None, 0, offset) for n, title, offset in rows]
    frame = spark.createDataFrame(full, ROW)
    return frame.withColumn("timestamp", F.timestamp_seconds(F.lit(1_700_000_000)))


def titles(store):
    return {r.product_id: r.title for r in store.read_raw(PRODUCTS).collect()}


def test_last_version_wins_across_appends(spark, store):
    table = store.raw(PRODUCTS)
    table.append(versions(spark, (1, "a", 1), (1, "b", 2), (2, "c", 3)))
    table.append(versions(spark, (1, "d", 5), (3, "e", 4)))
    table.append(versions(spark, (2, "too late", 0)))
    assert titles(store) == {key(1): "d", key(2): "c", key(3): "e"}


def test_one_append_stores_one_version_per_key(spark, store):
    table = store.raw(PRODUCTS)
    table.append(versions(spark, *[(1, f"v{n}", n) for n in range(100)]))
    assert table.versions(spark).count() == 1


def test_repeated_append_changes_nothing(spark, store):
    rows = versions(spark, (1, "a", 1), (2, "b", 2))
    store.raw(PRODUCTS).append(rows)
    once = titles(store)
    store.raw(PRODUCTS).append(rows)
    assert titles(store) == once


def test_columns_are_bound_by_name(spark, store):
    store.raw(PRODUCTS).append(versions(spark, (1, "a", 1)))
    row = store.read_raw(PRODUCTS).first()
    assert (row.category, row.description) == ("Books", "d")


def test_reading_needs_no_shuffle(spark, store):
    store.raw(PRODUCTS).append(versions(spark, (1, "a", 1)))
    assert "Exchange" not in plan_of(store.read_raw(PRODUCTS))


@pytest.mark.parametrize("buckets", [1, 3, 4, 8])
def test_files_per_append_are_bounded(spark, tmp_path, buckets):
    store = Store(spark, f"files_{buckets}", str(tmp_path / "s"), buckets).ensure()
    store.raw(PRODUCTS).append(versions(spark, *[(n, "t", n) for n in range(500)]))
    files = spark.table(store.raw(PRODUCTS).name).inputFiles()
    assert len(files) <= max(buckets, 4)
    assert store.read_raw(PRODUCTS).count() == 500


def test_declaring_twice_keeps_the_rows(spark, store):
    store.raw(PRODUCTS).append(versions(spark, (1, "a", 1)))
    store.ensure()
    assert titles(store) == {key(1): "a"}


def test_rows_are_found_again_by_a_new_catalog(spark, store):
    store.raw(PRODUCTS).append(versions(spark, (1, "a", 1)))
    spark.sql(f"DROP TABLE {store.raw(PRODUCTS).name}")  # forgets the name, keeps the files
    assert titles(store.ensure()) == {key(1): "a"}


def test_transformed_table_has_the_derived_column(store, spark):
    columns = spark.table(store.table(PRODUCTS).name).columns
    assert "price_with_tax" in columns
    assert "price_with_tax" not in spark.table(store.raw(PRODUCTS).name).columns


@pytest.mark.parametrize("buckets", [2, 3])
def test_copy_keeps_only_current_rows(spark, store, tmp_path, buckets):
    for n in range(3):
        store.raw(PRODUCTS).append(versions(spark, (1, f"v{n}", n)))
    copy = store.copy_to(Store(spark, f"{store.database}_copy", str(tmp_path / "copy"), buckets))
    assert len(copy.raw(PRODUCTS).versions(spark).inputFiles()) <= 4
    assert titles(copy) == titles(store) == {key(1): "v2"}
    assert copy.raw(PRODUCTS).versions(spark).count() == 1
    assert store.raw(PRODUCTS).versions(spark).count() == 3


def test_shared_root_is_the_named_folder(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    root = workspace.shared_root(spark)
    assert root == named.rstrip("/") if named else root
    assert workspace.fresh_folder(spark, "x") != workspace.fresh_folder(spark, "x")


def test_another_bucket_count_is_refused(spark, store):
    with pytest.raises(ValueError):
        Store(spark, store.database + "x", store.folder, buckets=8).ensure()


def test_letters_of_a_topic_made_anew_are_all_kept(spark, store):
    rows = [("t", 0, 0, datetime(2024, 1, d), v, "bad") for d, v in ((1, b"a"), (2, b"b"), (2, b"c"))]
    for row in rows:
        store.letters("raw").append(spark.createDataFrame([row], LETTER_DDL))
    assert store.letters("raw").current(spark).count() == 3


def test_a_database_in_another_folder_is_refused(spark, store, tmp_path):
    with pytest.raises(ValueError, match="lies in"):
        Store(spark, store.database, str(tmp_path / "elsewhere"), 4).ensure()
