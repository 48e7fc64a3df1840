"""Independent Spark jobs at the same time."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

Result = TypeVar("Result")


def side_by_side(spark: SparkSession, calls: Sequence[Callable[[], Result]]) -> list[Result]:
    """Results in the order of ``calls``; a failure is raised when all have ended.

    Jobs of different tables do not wait for each other's last tasks. They belong
    to the job group of the caller, so stopping a stream stops them too.
    """
    with ThreadPoolExecutor(max_workers=max(1, len(calls))) as pool:
        running = [pool.submit(inheritable_thread_target(spark)(call)) for call in calls]
    return [job.result() for job in running]
