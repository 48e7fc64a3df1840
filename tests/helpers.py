"""Small helpers shared by the tests."""

from __future__ import annotations

import json
import uuid
from datetime import datetime

from tillstream.sources.topics import MESSAGE_DDL


def key(n: int) -> str:
    return str(uuid.UUID(int=n))


def plan_of(frame) -> str:
    mode = frame._sc._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple")
    return frame._jdf.queryExecution().explainString(mode)


def product(n: int, **changes) -> dict:
    row = {
        "product_id": key(n),
        "title": f"thing {n}",
        "price": 19.99,
        "category": "Books",
        "description": "a thing",
        "stock": 3,
    }
    return {**row, **changes}


def order(n: int, **changes) -> dict:
    row = {
        "order_id": key(n),
        "customer_id": key(100),
        "product_id": key(200),
        "order_date": "2024-01-02T03:04:05.000007",
        "quantity": 2,
        "status": "Pending",
    }
    return {**row, **changes}


def messages(spark, topic: str, values: list, start: int = 0):
    """One message per value: a dict is sent as JSON, text as it is, None as a tombstone."""
    moment = datetime(2023, 11, 14, 22, 13, 20)
    rows = []
    for number, value in enumerate(values, start):
        text = json.dumps(value) if isinstance(value, dict) else value
        data = None if text is None else bytearray(text.encode())
        rows.append((None, data, 0, number, moment, 0, topic))
    return spark.createDataFrame(rows, MESSAGE_DDL)


def land_file(frame, folder) -> None:
    """Append messages to a topic folder."""
    frame.coalesce(1).write.mode("append").partitionBy("topic").parquet(str(folder))
