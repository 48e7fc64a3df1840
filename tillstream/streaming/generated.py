"""Generated entities as a stream: bounded batches, each id exactly once over restarts."""

from __future__ import annotations

import json
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

SOURCE = "rate-micro-batch"


def stream_ids(spark: SparkSession, total: int, per_batch: int, tasks: int = 1) -> DataFrame:
    """``id`` from 0 to ``total - 1``, ``per_batch`` of them a batch, made by ``tasks`` tasks.

    The stream's position is the next id and is kept in the checkpoint, so a batch that is
    done again has the same ids and a restart goes on behind the last one. The generators
    derive every entity from its id alone: nothing is stored to be streamed. ``per_batch``
    and ``tasks`` belong to the checkpoint's stream and must stay as they are.
    """
    ids = (
        spark.readStream.format(SOURCE)
        .option("rowsPerBatch", per_batch)
        .option("numPartitions", tasks)
        .load()
    )
    return ids.select(F.col("value").alias("id")).filter(F.col("id") < total)


def ids_made(query: StreamingQuery) -> int:
    """How many ids the batches that are through have taken, counted from 0."""
    done = query.lastProgress
    if done is None:
        return 0
    end = json.loads(done.json)["sources"][0]["endOffset"]
    return int(end["offset"]) if end else 0


def run_until(query: StreamingQuery, total: int, pause: float = 0.05) -> int:
    """Lets the query run until ``total`` ids are through and stops it at the border of a
    batch; raises what it died of. Returns how many are through."""
    try:
        while query.isActive and ids_made(query) < total:
            time.sleep(pause)
        failure = query.exception()
        if failure is not None:
            raise failure
        return ids_made(query)
    finally:
        query.stop()
