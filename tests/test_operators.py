"""Transforms, last-version-wins, sampling and reference picks."""

from __future__ import annotations

import hashlib
import random

import pytest
from helpers import plan_of
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tillstream.operators import sample
from tillstream.operators.latest import (
    filter_then_merge,
    latest_per_key,
    merge_then_filter,
    upsert,
)
from tillstream.operators.reference import by_position, pick_reference, with_ordinal
from tillstream.operators.sample import bottom_sample, exact_sample, sample_rows
from tillstream.operators.transforms import sellable_products, standing_orders, step_for

VERSIONS = "k int, n int, v string"


def test_tax_is_computed_on_the_widened_price(spark):
    rows = spark.createDataFrame([(19.99, 1), (5.0, 0), (5.0, None)], "price float, stock int")
    assert [r.price_with_tax for r in sellable_products(rows).collect()] == [23.987999725341798]


def test_unknown_status_is_dropped_and_case_matters(spark):
    rows = spark.createDataFrame(
        [("Pending",), ("Cancelled",), (None,), ("cancelled",)], "status string"
    )
    assert [r[0] for r in standing_orders(rows).collect()] == ["Pending", "cancelled"]


def test_entities_without_a_step_pass_through(spark):
    rows = spark.range(3)
    assert step_for("customers")(rows) is rows


@settings(
    max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(st.lists(st.tuples(st.integers(0, 4), st.text("ab", max_size=2)), min_size=1, max_size=40))
def test_latest_is_what_a_dict_would_hold(spark, versions):
    rows = [(k, n, v) for n, (k, v) in enumerate(versions)]
    shuffled = random.Random(1).sample(rows, len(rows))
    got = latest_per_key(spark.createDataFrame(shuffled, VERSIONS), ["k"], ["n"]).collect()
    assert {r.k: r.v for r in got} == {k: v for k, _, v in rows}
    assert len(got) == len({k for k, _, _ in rows})


def test_upsert_does_not_care_about_splits_or_repeats(spark):
    rows = [(n % 5, n, f"v{n}") for n in range(50)]
    whole = spark.createDataFrame(rows, VERSIONS)
    first, second = whole.filter("n % 2 = 0"), whole.filter("n % 2 = 1")
    expected = sorted(latest_per_key(whole, ["k"], ["n"]).collect())
    stored = latest_per_key(second, ["k"], ["n"])
    merged = upsert(stored, first, ["k"], ["n"])
    assert sorted(merged.collect()) == expected
    assert sorted(upsert(merged, whole, ["k"], ["n"]).collect()) == expected


def test_upsert_binds_by_name(spark):
    stored = spark.createDataFrame([(1, 1, "old")], VERSIONS)
    arrived = spark.createDataFrame([("new", 1, 2)], "v string, k int, n int")
    assert [tuple(r) for r in upsert(stored, arrived, ["k"], ["n"]).collect()] == [(1, 2, "new")]


def test_hot_key_is_reduced_before_the_shuffle(spark):
    """A third of the rows has one key: a task passes on one of them."""
    rows = spark.range(0, 30_000, 1, 4).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), F.col("id").alias("n")
    )
    plan = plan_of(latest_per_key(rows, ["k"], ["n"]))
    partial, shuffle = plan.index("row_number(), 1, Partial"), plan.index("Exchange hash")
    assert shuffle < partial  # plans print from the top, so the partial step runs first
    got = latest_per_key(rows, ["k"], ["n"])
    assert got.count() == 20_001 and got.filter("k = 0").first().n == 29_997


def test_filter_order_matters(spark):
    rows = spark.createDataFrame(
        [(1, 1, "Pending"), (1, 2, "Cancelled"), (2, 1, "Shipped")], "k int, n int, status string"
    )
    before = filter_then_merge(rows, standing_orders, ["k"], ["n"]).collect()
    after = merge_then_filter(rows, standing_orders, ["k"], ["n"]).collect()
    assert sorted((r.k, r.status) for r in before) == [(1, "Pending"), (2, "Shipped")]
    assert [(r.k, r.status) for r in after] == [(2, "Shipped")]


def brute_sample(ids, size, seed):
    ranked = sorted(ids, key=lambda i: (hashlib.md5(f"{seed}:{i}".encode()).hexdigest(), str(i)))
    return set(ranked[:size])


@pytest.mark.parametrize("size", [0, 1, 499, 2_500, 4_999, 5_000])
def test_sample_has_the_exact_size(spark, size):
    got = [r.id for r in exact_sample(spark.range(5_000), size, ["id"], seed=7).collect()]
    assert len(got) == size and set(got) == brute_sample(range(5_000), size, 7)


def test_sample_searches_deeper_when_groups_are_large(spark, monkeypatch):
    monkeypatch.setattr(sample, "SMALL_GROUP", 1)
    monkeypatch.setattr(sample, "LEVEL_DIGITS", 1)
    got = {r.id for r in exact_sample(spark.range(3_000), 1_234, ["id"]).collect()}
    assert got == brute_sample(range(3_000), 1_234, 42)


def test_sample_moves_no_rows(spark):
    assert "Exchange" not in plan_of(exact_sample(spark.range(1_000), 500, ["id"]))


def test_sample_refuses_what_it_cannot_do(spark):
    with pytest.raises(ValueError, match="larger"):
        exact_sample(spark.range(10), 11, ["id"])
    with pytest.raises(ValueError, match="negative"):
        exact_sample(spark.range(10), -1, ["id"])
    twice = spark.range(10).union(spark.range(10))
    with pytest.raises(ValueError, match="identify"):
        exact_sample(twice, 1, ["id"])


def test_ordinals_are_dense(spark):
    got = with_ordinal(spark.range(0, 3_000, 1, 5), ["id"]).collect()
    assert sorted(r.ordinal for r in got) == list(range(3_000))
    again = with_ordinal(spark.range(0, 3_000, 1, 2), ["id"]).collect()
    assert {r.id: r.ordinal for r in got} == {r.id: r.ordinal for r in again}


def test_every_row_gets_one_existing_reference(spark):
    targets = spark.range(1_000, 1_037).withColumnRenamed("id", "t")
    rows = spark.range(2_000)
    number = F.xxhash64("id") % 1_000_003 + 1_000_003
    picked = pick_reference(rows, number, targets, ["t"], {"t": "ref"})
    got = picked.collect()
    assert sorted(r.id for r in got) == list(range(2_000))
    assert {r.ref for r in got} == set(range(1_000, 1_037))
    with pytest.raises(ValueError, match="no row"):
        pick_reference(rows, F.col("id"), targets.limit(0), ["t"], {"t": "ref"})


def test_references_for_signed_and_missing_numbers(spark):
    targets = spark.range(7).select(F.col("id").alias("t"))
    rows = spark.createDataFrame([(i, i - 500) for i in range(1000)] + [(1000, None)], "id int, n int")
    picked = pick_reference(rows, F.col("n"), targets, ["t"], {"t": "ref"}).collect()
    assert sorted(r.id for r in picked) == list(range(1001))
    assert [r.id for r in picked if r.ref is None] == [1000]


@pytest.mark.parametrize("size", [0, 1, 2_500, 4_999, 5_000])
def test_both_ways_to_sample_pick_the_same_rows(spark, size):
    rows = spark.range(0, 5_000, 1, 7).withColumn("_ticket", F.col("id") + 1)
    got = [tuple(r) for r in bottom_sample(rows, size, ["id"], seed=7).collect()]
    assert sorted(got) == sorted(tuple(r) for r in exact_sample(rows, size, ["id"], seed=7).collect())
    assert len(got) == size and {r[0] for r in got} == brute_sample(range(5_000), size, 7)


def test_a_sample_is_one_scan_and_runs_nothing_before(spark, tmp_path):
    spark.range(3_000).write.parquet(str(tmp_path / "rows"))
    rows = spark.read.parquet(str(tmp_path / "rows"))
    jobs = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("sampling", "")
    plan = plan_of(sample_rows(rows, 100, ["id"]))
    assert not jobs.getJobIdsForGroup("sampling") and plan.count("FileScan") == 1
    spark.sparkContext.setJobGroup("", "")


def test_what_a_heap_cannot_sample_fails_the_run(spark):
    for rows in (spark.range(10), spark.range(0)):
        with pytest.raises(Exception, match="larger"):
            bottom_sample(rows, 11, ["id"]).collect()
    twice = spark.range(10).union(spark.range(10))
    with pytest.raises(Exception, match="identify"):
        bottom_sample(twice, 1, ["id"]).collect()
    for size in (-1, sample.HEAP_ROWS + 1):
        with pytest.raises(ValueError):
            bottom_sample(spark.range(10), size, ["id"])
    with pytest.raises(ValueError, match="larger"):
        sample_rows(spark.range(10), sample.HEAP_ROWS + 1, ["id"])


def test_positions_are_those_of_the_rows_as_read(spark):
    rows = spark.range(0, 3_000, 1, 5).withColumn("_place", F.col("id") % 7)
    numbered = by_position(rows)
    assert {r.id: r.ordinal for r in numbered.collect()} == {i: i for i in range(3_000)}
    assert numbered.columns == ["id", "_place", "ordinal"]
    assert by_position(spark.range(0)).count() == 0
    # Only the tasks' own counts are shuffled; the rows are joined to them as they lie.
    plan = plan_of(numbered)
    assert "hashpartitioning(id" not in plan and "rangepartitioning" not in plan


def test_references_by_position(spark):
    targets = spark.range(1_000, 1_037).withColumnRenamed("id", "t")
    number = F.xxhash64("id") % 1_000_003
    picked = pick_reference(spark.range(2_000), number, targets, ["t"], {"t": "ref"}, as_read=True)
    got = picked.withColumn("want", F.pmod(number, F.lit(37)) + 1_000).collect()
    assert len(got) == 2_000 and all(r.ref == r.want for r in got)
    with pytest.raises(ValueError, match="no row"):
        pick_reference(spark.range(3), F.col("id"), targets.limit(0), ["t"], {"t": "r"}, as_read=True)
