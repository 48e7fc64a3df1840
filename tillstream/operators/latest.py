"""Insert-or-replace by key, expressed as "the last version wins"."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillstream.operators.transforms import Step


def latest_per_key(frame: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the one with the greatest ``order`` tuple.

    Spark keeps only the first row of each key inside every input task before it
    shuffles, so a key that holds a third of all rows sends one row per task.
    ``order`` must be total per key; equal tuples may only belong to equal rows.
    """
    newest = Window.partitionBy(*keys).orderBy(*[F.col(c).desc() for c in order])
    ranked = frame.withColumn("_rank", F.row_number().over(newest))
    return ranked.filter(F.col("_rank") == 1).drop("_rank")


def upsert(
    stored: DataFrame, arrived: DataFrame, keys: Sequence[str], order: Sequence[str]
) -> DataFrame:
    """``stored`` after every row of ``arrived`` was inserted or replaced by key.

    The result does not depend on how rows were split into arrivals nor on
    arrivals that come twice, which is what makes a replay harmless.
    """
    return latest_per_key(stored.unionByName(arrived), keys, order)


def filter_then_merge(
    versions: DataFrame, step: Step, keys: Sequence[str], order: Sequence[str]
) -> DataFrame:
    """Drop versions first: a key keeps its last version that passed."""
    return latest_per_key(step(versions), keys, order)


def merge_then_filter(
    versions: DataFrame, step: Step, keys: Sequence[str], order: Sequence[str]
) -> DataFrame:
    """Merge first: a key whose last version does not pass disappears."""
    return step(latest_per_key(versions, keys, order))
