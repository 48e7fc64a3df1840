"""Attach to every row the key of a randomly chosen row of another table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillstream.operators.sample import _free
from tillstream.workspace import fixed

GROUP_DIGITS = 4  # at most 16 ** 4 groups, whatever the size of the table


def with_ordinal(rows: DataFrame, keys: Sequence[str], name: str = "ordinal") -> DataFrame:
    """Number the rows 0, 1, 2, ... without passing them through one task.

    Rows are grouped by a hash prefix of their key, numbered inside their group,
    and shifted by the rows of all groups before. Only the group sizes, a fixed
    number of them, are ever seen together. ``keys`` must identify a row.
    """
    ident = F.concat_ws(":", *[F.col(k).cast("string") for k in keys])
    hashed = rows.withColumn("_hash", F.md5(ident))
    grouped = hashed.withColumn("_group", F.substring("_hash", 1, GROUP_DIGITS))
    before = Window.orderBy("_group").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        hashed.groupBy(F.substring("_hash", 1, GROUP_DIGITS).alias("_group"))
        .count()
        .select("_group", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_start"))
    )
    within = F.row_number().over(Window.partitionBy("_group").orderBy("_hash", *keys)) - 1
    return (
        grouped.withColumn("_place", within)
        .join(F.broadcast(starts), "_group")
        .withColumn(name, F.col("_start") + F.col("_place"))
        .drop("_group", "_hash", "_start", "_place")
    )


def by_position(rows: DataFrame, name: str = "ordinal") -> DataFrame:
    """Number the rows 0, 1, 2, ... in the order in which they are read.

    The rows are checkpointed in the shared folder, so their order stands, whatever is
    lost or done again; read anew, files of another layout may come in another order.
    Each task counts its own; how many rows lie before a task, one
    number each, is all that is ever seen together. No row moves and none is sorted.
    """
    stored = fixed(rows)
    place, task = _free(rows, "_place"), _free(rows, "_task")
    number = F.monotonically_increasing_id()  # task above 33 bits, place below
    placed = stored.withColumns(
        {task: F.shiftright(number, 33), place: number.bitwiseAND(F.lit((1 << 33) - 1))}
    )
    before = Window.orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        placed.groupBy(F.col(task).alias("_at"))
        .count()
        .select("_at", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_start"))
    )
    return (
        placed.join(F.broadcast(starts), F.col(task) == F.col("_at"))
        .withColumn(name, F.col("_start") + F.col(place))
        .drop(task, place, "_at", "_start")
    )


def pick_reference(
    rows: DataFrame,
    number: Column,
    targets: DataFrame,
    keys: Sequence[str],
    columns: dict[str, str],
    *,
    as_read: bool = False,
) -> DataFrame:
    """Join each row to the target at position ``number`` modulo their count.

    Targets are numbered by the hash of their ``keys``, whatever their order, or
    ``as_read``, which moves none of them (:func:`by_position`).
    ``columns`` maps target columns to their names in the result. Numbers may have
    either sign; a row without a number stays, without a reference. The positions
    are spread evenly, so the join has no hot key; whether the targets are small
    enough to be sent to every task is left to Spark's own size check.
    """
    wanted = targets.select(*dict.fromkeys([*keys, *columns]))
    if as_read:
        numbered = by_position(wanted, "_ordinal")
        total = numbered.count()
    else:
        total = targets.count()
        numbered = with_ordinal(wanted, keys, "_ordinal")
    if total == 0:
        raise ValueError("there is no row to refer to")
    picked = numbered.select(
        "_ordinal", *[F.col(old).alias(new) for old, new in columns.items()]
    )
    return (
        rows.withColumn("_ordinal", F.pmod(number, F.lit(total)))
        .join(picked, "_ordinal", "left")
        .drop("_ordinal")
    )
