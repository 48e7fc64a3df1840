"""Topics as folders: messages with the columns of Spark's Kafka source.

Everything after the ``load()`` is the same for Kafka and for these folders, so
the streams are tested on the folders.
"""

from __future__ import annotations

import logging
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tillstream.functions.wire import json_message
from tillstream.workspace import shuffles_dropped

log = logging.getLogger(__name__)

MESSAGE_DDL = (
    "key binary, value binary, partition int, offset bigint, "
    "timestamp timestamp, timestampType int, topic string"
)
# A batch is kept while its tables are written: a bound in bytes holds for files of any size.
BYTES_PER_BATCH = 256 << 20


def to_messages(
    rows: DataFrame,
    topic: str,
    offset: Column | None = None,
    timestamp: Column | None = None,
    value: Column | None = None,
) -> DataFrame:
    """Rows as unkeyed messages of ``topic``; the value is the row in JSON.

    Offsets must tell the messages of a topic apart. The default numbers the rows
    of one call; give ``offset`` when a topic is written in several calls.
    """
    text = json_message(rows) if value is None else value
    return rows.select(
        F.lit(None).cast("binary").alias("key"),
        text.cast("binary").alias("value"),
        F.lit(0).alias("partition"),
        (F.monotonically_increasing_id() if offset is None else offset).alias("offset"),
        (F.current_timestamp() if timestamp is None else timestamp).alias("timestamp"),
        F.lit(0).alias("timestampType"),
        F.lit(topic).alias("topic"),
    )


@dataclass(frozen=True)
class Delivery:
    """What a publishing job sent; ``error`` is None when it went through."""

    topic: str
    messages: int
    error: str | None = None


def write_log(delivery: Delivery) -> None:
    log.info("%s: %d messages sent, error: %s", *vars(delivery).values())


def publish(
    rows: DataFrame,
    topic: str,
    write: Callable[[DataFrame], None],
    *,
    delivered: Callable[[Delivery], None] = write_log,
    attempts: int = 2,
    **columns: Column,
) -> Delivery:
    """Send rows to a topic and report the outcome, counted during the write.

    A failed write is done again, so a message may arrive twice. A lasting
    failure is reported and not raised: other topics are still published.
    """
    for attempt in range(attempts):
        sent = Observation()
        messages = to_messages(rows, topic, **columns)
        try:
            write(messages.observe(sent, F.count(F.lit(1)).alias("messages")))
            delivery = Delivery(topic, sent.get["messages"])
            break
        except Exception as failure:  # noqa: BLE001 - one topic must not stop the others
            log.warning("attempt %d to publish %s failed: %s", attempt + 1, topic, failure)
            delivery = Delivery(topic, 0, str(failure))
    delivered(delivery)
    return delivery


def folder_writer(folder: str) -> Callable[[DataFrame], None]:
    """Messages into ``folder``. They are mostly UUID text, which needs an entropy code to
    shrink, and what the shuffles before it left on disk goes when it is written."""

    def write(messages: DataFrame) -> None:
        with shuffles_dropped(messages.sparkSession):
            files = messages.write.mode("append").option("compression", "zstd")
            files.partitionBy("topic").parquet(folder)

    return write


def read_folder(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(MESSAGE_DDL).parquet(folder)


def stream_folder(
    spark: SparkSession,
    folder: str,
    *topics: str,
    files_per_batch: int | None = None,
    last_reader: bool = False,
) -> DataFrame:
    """Messages of the given topics from the earliest on; all topics when none is given.

    A batch is kept while its tables are written, so a long backlog is read in
    several: ``files_per_batch``, or else ``BYTES_PER_BATCH``, bounds one batch, not the
    stream. For the ``last_reader`` of a folder, files of batches that are done are deleted."""
    reader = spark.readStream.schema(MESSAGE_DDL)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    else:
        reader = reader.option("maxBytesPerTrigger", BYTES_PER_BATCH)
    if last_reader:
        reader = reader.option("cleanSource", "delete")
    messages = reader.parquet(folder)
    return messages.filter(F.col("topic").isin(*topics)) if topics else messages
