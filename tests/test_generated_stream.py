"""Generated entities as a stream."""

from __future__ import annotations

from collections import Counter
from datetime import datetime

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from tillstream.sources.generate import generate_customers
from tillstream.streaming.append import start_append
from tillstream.streaming.generated import run_until, stream_ids

NOW = datetime(2024, 6, 30)


def start(spark, place, total, step):
    ids = stream_ids(spark, total, per_batch=100, tasks=3)
    return start_append(ids, step, f"{place}/rows", f"{place}/checkpoint", name="made_by_test")


def same(ids):
    return ids


def breaking_at(number):
    told = F.when(F.col("id") == number, F.raise_error(F.lit("lost"))).otherwise(F.col("id"))
    return lambda ids: ids.select(told.cast("long").alias("id"))


def test_a_run_that_breaks_off_in_a_batch_makes_each_id_once(spark, tmp_path):
    with pytest.raises(StreamingQueryException):
        run_until(start(spark, tmp_path, 750, breaking_at(350)), 750)
    assert spark.read.parquet(f"{tmp_path}/rows").count() == 300
    run_until(start(spark, tmp_path, 750, same), 750)
    got = Counter(r.id for r in spark.read.parquet(f"{tmp_path}/rows").collect())
    assert got == Counter(range(750))


def test_runs_that_are_stopped_go_on_behind_the_last_batch(spark, tmp_path):
    seen = []
    for upto in (100, 101, 450):
        through = run_until(start(spark, tmp_path, 450, same), upto)
        seen.append(through)
        assert through >= upto and through % 100 == 0
    assert seen == sorted(seen)
    got = Counter(r.id for r in spark.read.parquet(f"{tmp_path}/rows").collect())
    assert got == Counter(range(450))


def test_streamed_entities_are_those_of_the_batch(spark, tmp_path):
    run_until(start(spark, tmp_path, 250, lambda ids: generate_customers(ids, NOW)), 250)
    made = spark.read.parquet(f"{tmp_path}/rows").collect()
    assert Counter(made) == Counter(generate_customers(spark.range(250), NOW).collect())
