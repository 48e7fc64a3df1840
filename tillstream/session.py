"""A Spark session with the settings the jobs were tuned with."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", partitions: int = 8) -> SparkSession:
    """Session for one machine. On a cluster, set partitions, memory and
    ``spark.checkpoint.dir`` where the job is submitted instead."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tillstream")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("TILLSTREAM_MEMORY", "8g"))
        .getOrCreate()
    )
