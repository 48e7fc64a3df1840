"""What streams carried, in sketches per batch that merge over any span of batches.

Counts of distinct keys and quantiles of the delay cannot be added up from batch to
batch; their sketches can. A batch's sketches are a few kilobytes a group, whatever its size.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

# Distinct counts lie within 5 % (three standard errors), quantiles within 2 % of rank.
DISTINCT_BITS, QUANTILE_SIZE = 12, 400
DISTINCT_ERROR, RANK_ERROR = 0.05, 0.02
QUANTILES = (0.5, 0.9, 0.99)


def delay(moment: Column, as_of: datetime | None = None) -> Column:
    """Milliseconds from ``moment`` to ``as_of``, by default to the time of the query."""
    now = F.current_timestamp() if as_of is None else F.lit(as_of)
    return F.unix_millis(now.cast("timestamp")) - F.unix_millis(moment.cast("timestamp"))


def sketched(
    rows: DataFrame, groups: Sequence[str], key: Column, late: Column
) -> DataFrame:
    """Per group: rows, a sketch of the distinct keys and one of the delays.

    Each task sketches its own rows, so a group of any size moves as one sketch a task.
    Null keys and delays count as rows only; a group that has none at all has the
    sketch of nothing.
    """
    return rows.groupBy(*groups).agg(
        F.count(F.lit(1)).alias("rows"),
        F.hll_sketch_agg(key, F.lit(DISTINCT_BITS)).alias("keys"),
        F.kll_sketch_agg_bigint(late, F.lit(QUANTILE_SIZE)).alias("delays"),
    )


def merged(sketches: DataFrame, groups: Sequence[str]) -> DataFrame:
    """Sketches of many batches, or of finer groups, as one per group."""
    return sketches.groupBy(*groups).agg(
        F.sum("rows").alias("rows"),
        F.hll_union_agg("keys").alias("keys"),
        F.kll_merge_agg_bigint("delays").alias("delays"),
    )


def estimates(sketches: DataFrame, quantiles: Sequence[float] = QUANTILES) -> DataFrame:
    """The sketches read out: ``distinct_keys`` and, per quantile, ``delay_<percent>``
    in milliseconds (null where no row had a delay)."""
    some = F.kll_sketch_get_n_bigint("delays") > 0
    columns = {"distinct_keys": F.hll_sketch_estimate("keys")}
    for q in quantiles:
        at = F.kll_sketch_get_quantile_bigint("delays", F.lit(float(q)))
        columns[f"delay_{round(q * 100)}"] = F.when(some, at)
    return sketches.withColumns(columns).drop("keys", "delays")


def start_sketches(
    rows: DataFrame,
    groups: Sequence[str],
    key: Column,
    moment: Column,
    folder: str,
    checkpoint: str,
    *,
    name: str,
    as_of: datetime | None = None,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Sketches of every batch below ``folder``, with the batch's number as a partition.
    A batch that is done again replaces its own, so nothing counts twice."""

    def on_batch(batch: DataFrame, number: int) -> None:
        found = sketched(batch, groups, key, delay(moment, as_of))
        found.coalesce(1).write.mode("overwrite").parquet(f"{folder}/batch={number}")

    writer = (
        rows.writeStream.queryName(name)
        .option("checkpointLocation", checkpoint)
        .foreachBatch(on_batch)
    )
    return (writer.trigger(**trigger) if trigger else writer).start()
