"""Exact-size sampling without replacement."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# The histogram of one level has at most 16 ** LEVEL_DIGITS rows, and the search
# goes on until the group around the cut is small. Both bounds are independent of
# the size of the data; neither limits what is sampled.
LEVEL_DIGITS = 3
SMALL_GROUP = 10_000
HASH_DIGITS = 32
# A sample that fits a task's memory many times over (tens of MB) is found in one scan.
HEAP_ROWS = 100_000
LEVELS = 2
END = "~"  # after every ticket


def exact_sample(rows: DataFrame, size: int, keys: Sequence[str], seed: int = 42) -> DataFrame:
    """``size`` rows of ``rows``, each subset of that size equally likely.

    Every row gets a hash of its key, and the sample is the ``size`` smallest
    hashes. The cut between in and out is found from histograms of hash prefixes
    over the key columns alone, so no rows are sorted or moved: the sample itself
    is one filter on the input. ``keys`` must identify a row.
    """
    if size < 0:
        raise ValueError("sample size is negative")
    cut = _cut_after(rows, size, keys, seed)
    return rows.filter(_ticket(keys, seed) <= F.lit(cut))


def _ticket(keys: Sequence[str], seed: int) -> Column:
    """Hash and key in one text, so that equal hashes still have an order."""
    ident = F.concat_ws(":", *[F.col(k).cast("string") for k in keys])
    return F.concat(F.md5(F.concat(F.lit(f"{seed}:"), ident)), F.lit(":"), ident)


def _cut_after(rows: DataFrame, size: int, keys: Sequence[str], seed: int) -> str:
    """The ``size``-th smallest ticket."""
    tickets = rows.select(_ticket(keys, seed).alias("ticket"))
    prefix, wanted, total = "", size, None
    while len(prefix) < HASH_DIGITS - 1:
        digits = F.substring("ticket", len(prefix) + 1, LEVEL_DIGITS)
        group = tickets.filter(F.col("ticket").startswith(prefix))
        counts = sorted(tuple(r) for r in group.groupBy(digits).count().collect())
        if total is None:
            total = sum(count for _, count in counts)
            if size > total:
                raise ValueError(f"sample of {size} is larger than the {total} rows given")
            if size == 0:
                return ""
        for part, count in counts:
            if wanted <= count:
                prefix += part
                break
            wanted -= count
        if count <= SMALL_GROUP:
            break
    else:
        raise ValueError(f"the columns {list(keys)} do not identify a row")
    edge = tickets.filter(F.col("ticket").startswith(prefix)).orderBy("ticket").limit(wanted + 1)
    around = [r.ticket for r in edge.collect()]
    if len(around) > wanted and around[wanted] == around[wanted - 1]:
        raise ValueError(f"the columns {list(keys)} do not identify a row")
    return around[wanted - 1]


def sample_rows(rows: DataFrame, size: int, keys: Sequence[str], seed: int = 42) -> DataFrame:
    """``size`` rows, by whichever way suits the size; both pick the same rows."""
    way = bottom_sample if 0 <= size <= HEAP_ROWS else exact_sample
    return way(rows, size, keys, seed)


def bottom_sample(rows: DataFrame, size: int, keys: Sequence[str], seed: int = 42) -> DataFrame:
    """The rows that :func:`exact_sample` picks, found in one scan and within the plan.

    Every task passes on its ``size`` rows of the smallest tickets. These are dealt out
    anew into partitions of the session's advisory size, in which the same is done
    again, so what is left shrinks level by level before it meets in a single heap: a
    task takes in one such partition, not the rows of all tasks. ``size`` is at most
    ``HEAP_ROWS``; a larger sample is for :func:`exact_sample`, which moves no rows.

    Nothing runs while the plan is built. That there are too few rows, or that ``keys``
    do not tell apart the rows at the cut, is found when it runs, and fails it then.
    """
    if not 0 <= size <= HEAP_ROWS:
        raise ValueError(f"a sample of {size} rows is not between 0 and {HEAP_ROWS}")
    ticket, place, before = (_free(rows, name) for name in ("_ticket", "_place", "_before"))
    # A row that comes after all others shows where they end.
    end = rows.sparkSession.range(1).select(
        *[F.lit(None).cast(f.dataType).alias(f.name) for f in rows.schema], F.lit(END).alias(ticket)
    )
    least = rows.withColumn(ticket, _ticket(keys, seed)).unionByName(end)
    inside = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    for level in range(LEVELS + 1):
        least = least.hint("rebalance") if level else least
        sorted_here = least.sortWithinPartitions(ticket).withColumn(place, inside)
        least = sorted_here.filter(F.col(place) <= size).drop(place)
    order = Window.orderBy(ticket)
    numbered = (
        least.orderBy(ticket)
        .limit(size + 1)
        .withColumns({place: F.row_number().over(order), before: F.lag(ticket).over(order)})
    )
    short = F.raise_error(F.lit(f"sample of {size} is larger than the rows given"))
    twin = F.raise_error(F.lit(f"the columns {list(keys)} do not identify a row"))
    chosen = (
        F.when((F.col(ticket) == END) & (F.col(place) <= size), short.cast("boolean"))
        .when((F.col(ticket) == F.col(before)) & (F.col(place) == size + 1), twin.cast("boolean"))
        .otherwise(F.col(place) <= size)
    )
    return numbered.filter(chosen).drop(ticket, before, place)


def _free(rows: DataFrame, name: str) -> str:
    """``name``, lengthened until no column is called so."""
    while name in rows.columns:
        name += "_"
    return name
