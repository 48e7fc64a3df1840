"""Only real changes of a key, out of a stream that may deliver versions again."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from datetime import timedelta

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tillstream.entities import POSITION, Entity
from tillstream.functions.wire import json_message, parse_fields

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
# Keys time out in batches that have messages; without, a stream that takes what is there
# and ends would run empty batches for ever.
IDLE_BATCHES = "spark.sql.streaming.noDataMicroBatches.enabled"
# Keys share the groups of the state: a call of Python has a price of its own, which is paid
# per group that has messages in a batch and not per key. Part of the checkpoint.
SLOTS = 1 << 13
# JSON: per key where the last version seen of it stood, what it said, and when a message
# came last.
STATE = "held string"
SEEN = "id string, at bigint, partition int, offset bigint, digest string, row string"
COLUMNS = ["id", "at", "partition", "offset", "digest", "row"]
KEPT = timedelta(days=7)


def changes_only(records: DataFrame, entity: Entity, kept: timedelta = KEPT) -> DataFrame:
    """The records that change what is known of their key, with their positions.

    Of the versions of a key in one batch only the latest counts. It is passed on if it
    comes after all earlier ones and says something else; a version that is delivered
    again, or late, or repeats the last one, is not. Per key the state is a position and
    a hash; it is forgotten when nothing came for ``kept``, after which a replay passes.
    Records without a key are left out.
    """
    own = records.select(*entity.columns)
    seen = records.filter(F.col(entity.key).isNotNull()).select(
        F.pmod(F.xxhash64(F.col(entity.key)), F.lit(SLOTS)).alias("slot"),
        F.col(entity.key).alias("id"),
        F.unix_micros(F.col("timestamp")).alias("at"),
        "partition",
        "offset",
        F.md5(json_message(own)).alias("digest"),
        json_message(own).alias("row"),
    )
    judged = seen.groupBy("slot").applyInPandasWithState(
        judging(int(kept.total_seconds() * 1000)),
        SEEN,
        STATE,
        "append",
        GroupStateTimeout.ProcessingTimeTimeout,
    )
    placed = judged.withColumn("timestamp", F.timestamp_micros("at"))
    return parse_fields(placed, F.col("row"), entity.message, *POSITION)


def judging(wait: int) -> Callable[[tuple, Iterator[pd.DataFrame], GroupState], Iterator[pd.DataFrame]]:
    """What finds the changes among one slot's messages; keys idle for ``wait`` ms are
    forgotten."""

    def judge(
        _: tuple, frames: Iterator[pd.DataFrame], state: GroupState
    ) -> Iterator[pd.DataFrame]:
        known = json.loads(state.get[0]) if state.exists else {}
        now = state.getCurrentProcessingTimeMs()
        latest: dict[str, tuple] = {}
        for frame in () if state.hasTimedOut else frames:
            for ident, *place, digest, row in zip(*[frame[c].tolist() for c in COLUMNS], strict=True):
                place = [int(part) for part in place]
                best = latest.get(ident)
                if best is None or place > best[0]:
                    latest[ident] = place, digest, row
        changed = []
        for ident, (place, digest, row) in latest.items():
            held = known.get(ident)
            if held is not None and place <= held[:3]:
                held[4] = now
                continue
            if held is None or held[3] != digest:
                changed.append((ident, *place, digest, row))
            known[ident] = [*place, digest, now]
        known = {ident: held for ident, held in known.items() if held[4] + wait > now}
        if known:
            state.update((json.dumps(known, separators=(",", ":")),))
            state.setTimeoutDuration(min(held[4] for held in known.values()) + wait - now)
        elif state.exists:
            state.remove()
        if changed:
            yield pd.DataFrame(changed, columns=COLUMNS)

    return judge


def start_changes(
    records: DataFrame,
    entity: Entity,
    folder: str,
    checkpoints: str,
    *,
    name: str,
    kept: timedelta = KEPT,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Append the changes of ``entity`` to parquet files below ``folder``.

    The state lies in RocksDB on the executors, with its changes in the checkpoint
    folder, so it may outgrow their memory. One name, one checkpoint: a restart goes on.
    """
    spark = records.sparkSession
    settings = {PROVIDER: ROCKSDB, IDLE_BATCHES: "false"}
    before = {setting: spark.conf.get(setting) for setting in settings}
    for setting, value in settings.items():
        spark.conf.set(setting, value)
    try:
        writer = (
            changes_only(records, entity, kept)
            .writeStream.queryName(name)
            .outputMode("append")
            .format("parquet")
            .option("path", folder)
            .option("checkpointLocation", f"{checkpoints}/{name}")
        )
        return (writer.trigger(**trigger) if trigger else writer).start()
    finally:
        for setting, value in before.items():
            spark.conf.set(setting, value)


def read_changes(spark: SparkSession, entity: Entity, folder: str) -> DataFrame:
    """All changes so far, in no order; ``latest_per_key`` folds them to a table."""
    position = "timestamp timestamp, partition int, offset bigint"
    return spark.read.schema(f"{position}, {entity.message}").parquet(folder)
