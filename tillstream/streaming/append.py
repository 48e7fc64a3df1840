"""Stateless streams into append-only files."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from tillstream.operators.transforms import Step


def start_append(
    rows: DataFrame,
    step: Step,
    folder: str,
    checkpoint: str,
    *,
    name: str,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Apply ``step`` and append to parquet files; each input row lands once."""
    writer = (
        step(rows)
        .writeStream.queryName(name)
        .format("parquet")
        .option("path", folder)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
    )
    return (writer.trigger(**trigger) if trigger else writer).start()
