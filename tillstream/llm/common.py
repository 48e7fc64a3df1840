"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import tempfile
import zipfile
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager
from itertools import pairwise
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstream.workspace import shared_root

WHITE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"

# At most so many rows of two or three numbers go to every executor (tens of MB);
# with more, the join is left to Spark, which shuffles.
BROADCAST_ROWS = 500_000

# Texts are worked on in runs of about so many bytes.
SPAN_BYTES = 2 << 20


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def ship(spark: SparkSession) -> None:
    """Sends this package's source to the executors, once per session: their Python
    workers need it and may not have it installed."""
    context = spark.sparkContext
    if getattr(context, "_corpus_code", False):
        return
    package = Path(__file__).resolve().parent.parent
    archive = Path(tempfile.mkdtemp(prefix="code-")) / f"{package.name}.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted(package.rglob("*.py")):
            out.write(file, file.relative_to(package.parent))
    context.addPyFile(str(archive))
    context._corpus_code = True


def or_empty(text: Column) -> Column:
    return F.coalesce(text.cast("string"), F.lit(""))


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, every other character as it is."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def without(rows: DataFrame, names: Iterable[str]) -> DataFrame:
    """Rows without the columns that an operator is about to add, in whatever case."""
    return rows.drop(*names)


def unused(rows: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``rows`` is called so in whatever case."""
    taken = {c.lower() for c in rows.columns}
    while name.lower() in taken:
        name += "_"
    return name


def kept_safe(rows: DataFrame) -> DataFrame:
    """Rows written once to the folder in ``spark.checkpoint.dir``; lineage ends there.

    Executors may be lost afterwards without work being done again, and what was
    drawn or numbered once stays as it was. Only narrow rows pass through here.
    """
    spark = rows.sparkSession
    context = spark.sparkContext
    if not context._jsc.sc().getCheckpointDir().isDefined():
        context.setCheckpointDir(shared_root(spark))
    return rows.checkpoint()


def small_side(rows: DataFrame, n_rows: int) -> DataFrame:
    """Rows marked for broadcast if there are few; else left to Spark's own choice."""
    return F.broadcast(rows) if n_rows <= BROADCAST_ROWS else rows


def spans(texts: pa.Array, size: int = SPAN_BYTES) -> Iterator[tuple[int, int]]:
    """Borders of runs of rows that hold about ``size`` bytes; a longer text is alone."""
    lengths = pc.binary_length(texts).to_numpy(zero_copy_only=False)
    cuts = np.flatnonzero(np.diff(np.cumsum(lengths, dtype=np.int64) // size)) + 1
    return pairwise([0, *cuts.tolist(), len(texts)])


def string_bytes(texts: pa.Array) -> tuple[bytes, list[int]]:
    """All bytes of a string array without nulls, and the borders of its rows in them."""
    sizes = pc.binary_length(texts).to_numpy(zero_copy_only=False)
    edge = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
    if not len(texts) or not edge[-1]:
        return b"", edge.tolist()
    wide = pa.types.is_large_string(texts.type)
    begin = np.frombuffer(texts.buffers()[1], dtype=np.int64 if wide else np.int32)[texts.offset]
    return texts.buffers()[2].slice(int(begin), int(edge[-1])).to_pybytes(), edge.tolist()


def give_back() -> None:
    """Returns freed memory of a Python worker to the system: workers live on between
    stages, and two or more of them share an executor's memory."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


@contextmanager
def arrow_batches(spark: SparkSession, size: int) -> Iterator[None]:
    """What is run inside hands rows to Python workers in batches of about ``size`` bytes,
    a longer row alone, and not by the number of rows only. A bound that the session has
    already is left."""
    bound = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(bound, None) is not None:
        yield
        return
    spark.conf.set(bound, str(size))
    try:
        yield
    finally:
        spark.conf.unset(bound)


def settled(
    work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A worker function that gives memory back when it ends."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from work(batches)
        finally:
            give_back()

    return run


def running_totals(rows: DataFrame, key: str, value: str, block: int = 4096) -> DataFrame:
    """Adds ``before``: the sum of ``value`` over all smaller keys.

    ``key`` is a non-negative number, one row each. Two passes: sums inside blocks
    of keys, then over the blocks' totals, so no task sees more than ``block`` rows
    or one total per block.
    """
    from pyspark.sql import Window as W

    blocks = rows.withColumn("_block", F.floor(F.col(key) / block))
    inner = W.partitionBy("_block").orderBy(key).rowsBetween(W.unboundedPreceding, -1)
    outer = W.orderBy("_block").rowsBetween(W.unboundedPreceding, -1)
    totals = (
        blocks.groupBy("_block")
        .agg(F.sum(value).alias("_total"))
        .withColumn("_base", F.coalesce(F.sum("_total").over(outer), F.lit(0)))
        .drop("_total")
    )
    inside = blocks.withColumn("_inside", F.coalesce(F.sum(value).over(inner), F.lit(0)))
    return (
        inside.join(totals, "_block")
        .withColumn("before", (F.col("_base") + F.col("_inside")).cast("long"))
        .drop("_block", "_base", "_inside")
    )
