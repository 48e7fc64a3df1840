"""Where checkpoints and written tables live.

On a cluster every path must be reachable from every executor, so the folder is
the one the session names in ``spark.checkpoint.dir``. A folder of our own is
used only on a local master that names none.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_local_root: str | None = None
DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_root(spark: SparkSession) -> str:
    """The folder shared by driver and executors."""
    global _local_root
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    if _local_root is None:
        _local_root = tempfile.mkdtemp(prefix="tillstream-")
    return _local_root


def fresh_folder(spark: SparkSession, label: str) -> str:
    """A new, unused folder name below the shared root."""
    return f"{shared_root(spark)}/{label}-{uuid.uuid4().hex[:12]}"


def fixed(rows: DataFrame) -> DataFrame:
    """Rows checkpointed in the shared folder: their order and content stand from now on,
    and executors may be lost without work being done again."""
    context = rows.sparkSession.sparkContext
    if not context._jsc.sc().getCheckpointDir().isDefined():
        context.setCheckpointDir(shared_root(rows.sparkSession))
    return rows.checkpoint()


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Within, a query's shuffle files go when it has ended, not when the driver next
    happens to collect its garbage."""
    before = spark.conf.get(DROP_SHUFFLES)
    if before == "true":  # by the caller, or by another thread that will put it back
        yield
        return
    spark.conf.set(DROP_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.set(DROP_SHUFFLES, before)
