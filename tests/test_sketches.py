"""Sketches of batches against exact counts."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from tillstream.streaming.ingest import ALL_AVAILABLE
from tillstream.streaming.sketches import (
    DISTINCT_ERROR,
    RANK_ERROR,
    delay,
    estimates,
    merged,
    sketched,
    start_sketches,
)

NOW = datetime(2024, 1, 2)
GROUPS, DDL = ["kind"], "kind string, key string, at timestamp"


def facts(spark, n, keys):
    """``n`` rows of one large group and a small one; delays 0 .. n - 1 seconds."""
    at = F.timestamp_seconds(F.unix_timestamp(F.lit(NOW)) - F.col("id"))
    kind = F.when(F.col("id") % 100 == 0, "small").otherwise("large")
    return spark.range(n).select(
        kind.alias("kind"), (F.col("id") % keys).cast("string").alias("key"), at.alias("at")
    )


def sketch(rows):
    return sketched(rows, GROUPS, F.col("key"), delay(F.col("at"), NOW))


def test_parts_merge_to_the_same_bounds(spark):
    n, rows = 60_000, facts(spark, 60_000, 7_000)
    parts = [sketch(rows.filter(F.crc32("key") % 3 == part)) for part in range(3)]
    whole = parts[0].union(parts[1]).union(parts[2])
    got = {r.kind: r for r in estimates(merged(whole, GROUPS)).collect()}
    assert got["large"].rows + got["small"].rows == n
    for kind, keys in (("large", 6_930), ("small", 70)):
        assert abs(got[kind].distinct_keys - keys) <= DISTINCT_ERROR * keys
        for q in (50, 90, 99):
            assert abs(got[kind][f"delay_{q}"] / 1000 / n - q / 100) <= RANK_ERROR


def test_nulls_and_empty_tables(spark):
    rows = spark.createDataFrame([(None, None, None), ("a", None, None), ("a", "k", NOW)], DDL)
    got = {r.kind: r for r in estimates(merged(sketch(rows), GROUPS)).collect()}
    assert (got[None].rows, got[None].distinct_keys, got[None].delay_50) == (1, 0, None)
    assert (got["a"].rows, got["a"].distinct_keys, got["a"].delay_99) == (2, 1, 0)
    assert estimates(merged(sketch(rows.limit(0)), GROUPS)).count() == 0


def test_a_batch_that_is_done_again_counts_once(spark, tmp_path):
    """The commit of the last batch is lost, so it is done again after the restart."""
    rows = [("a", str(i), NOW - timedelta(seconds=i)) for i in range(40)]
    for part in (rows[:20], rows[20:]):
        spark.createDataFrame(part, DDL).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")

    def run():
        stream = spark.readStream.schema(DDL).option("maxFilesPerTrigger", 1)
        start_sketches(
            stream.parquet(f"{tmp_path}/in"), GROUPS, F.col("key"), F.col("at"),
            f"{tmp_path}/out", f"{tmp_path}/checkpoint",
            name="sketch_again", as_of=NOW, trigger=ALL_AVAILABLE,
        ).awaitTermination()
        return spark.read.parquet(f"{tmp_path}/out")

    assert run().count() == 2
    for file in (tmp_path / "checkpoint" / "commits").glob("*1*"):
        file.unlink()
    (row,) = estimates(merged(run(), GROUPS)).collect()
    assert (row.rows, row.distinct_keys) == (40, 40)
