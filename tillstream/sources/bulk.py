"""Bulk writes of documents that return, as rows, what the index refused.

A connector's writer logs a refused document and goes on; here each task sends its
documents itself and passes on the refused ones, so that they can be stored and counted.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterator
from http.client import HTTPConnection

import pyarrow as pa
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tillstream.functions.wire import json_message

# Sends (id, JSON) pairs; returns for each of them why it was refused, or None.
Send = Callable[[list[tuple[str, str]]], list[str | None]]
# Opens a way to send, once per task.
Connect = Callable[[], Send]

REFUSED_DDL = "id string, reason string, document string, last_synced string"
ROWS, BYTES = 1_000, 5 << 20
BUSY = (429, 503)


def send_bulk(
    documents: DataFrame, connect: Connect, rows: int = ROWS, size: int = BYTES
) -> DataFrame:
    """Sends all ``documents``; returns the refused ones with their reason.

    They need the columns ``id`` and ``last_synced``. One request holds at most ``rows``
    documents and, unless a single one is longer, ``size`` characters, so a task needs no
    more memory than one request. A request that fails raises and the task is done again:
    sending replaces by id, so what went through before is only written once more.
    """

    def groups(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple[str, str, str]]]:
        held, length = [], 0
        for batch in batches:
            for row in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                if held and (len(held) == rows or length + len(row[1]) > size):
                    yield held
                    held, length = [], 0
                held.append(row)
                length += len(row[1])
        if held:
            yield held

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        send = None
        for group in groups(batches):
            send = send or connect()
            reasons = send([row[:2] for row in group])
            found = [
                (ident, reason, text, stamp)
                for (ident, text, stamp), reason in zip(group, reasons, strict=True)
                if reason is not None
            ]
            names = ("id", "reason", "document", "last_synced")
            cells = zip(*found, strict=True) if found else ([] for _ in names)
            yield pa.record_batch(
                {n: pa.array(c, pa.string()) for n, c in zip(names, cells, strict=True)}
            )

    sent = documents.select("id", json_message(documents).alias("document"), "last_synced")
    return sent.mapInArrow(work, REFUSED_DDL)


def listing_writer(
    connect: Connect, keep: Callable[[DataFrame], None]
) -> Callable[[DataFrame], int]:
    """A writer that sends documents, hands the refused ones to ``keep`` and returns
    their number. ``keep`` must use the rows exactly once."""

    def write(documents: DataFrame) -> int:
        found = Observation()
        counted = F.count(F.lit(1)).alias("refused")
        keep(send_bulk(documents, connect).observe(found, counted))
        return found.get["refused"]

    return write


def bulk_body(index: str, documents: list[tuple[str, str]]) -> bytes:
    """An Elasticsearch bulk request: an action and a document per pair, on lines."""
    lines = []
    for ident, text in documents:
        lines += [json.dumps({"index": {"_index": index, "_id": ident}}), text]
    return ("\n".join(lines) + "\n").encode()


def bulk_reasons(answer: dict) -> list[tuple[int, str | None]]:
    """Status and reason of each document of a bulk answer, in the request's order."""
    found = []
    for item in answer["items"]:
        (done,) = item.values()
        error = done.get("error")
        if isinstance(error, dict):
            error = ": ".join(str(error[k]) for k in ("type", "reason") if error.get(k))
        refused = done["status"] >= 300
        found.append((done["status"], (error or f"status {done['status']}") if refused else None))
    return found


def elastic_bulk(
    nodes: str, index: str, port: int = 9200, attempts: int = 5, timeout: float = 30.0
) -> Connect:
    """Sends to Elasticsearch. Documents refused because it is busy are sent again with
    growing pauses; after ``attempts`` they count as refused."""

    def post(body: bytes) -> dict:
        link = HTTPConnection(nodes.split(",")[0], port, timeout=timeout)
        try:
            link.request("POST", "/_bulk", body, {"Content-Type": "application/x-ndjson"})
            answer = link.getresponse()
            text = answer.read()
            if answer.status >= 300:
                raise OSError(f"bulk request to {index}: status {answer.status}")
            return json.loads(text)
        finally:
            link.close()

    return lambda: patient(lambda group: bulk_reasons(post(bulk_body(index, group))), attempts)


def patient(
    request: Callable[[list[tuple[str, str]]], list[tuple[int, str | None]]],
    attempts: int,
    pause: float = 0.5,
) -> Send:
    """Repeats ``request`` for the documents that a busy index sends back, no others."""

    def send(documents: list[tuple[str, str]]) -> list[str | None]:
        reasons: list[str | None] = [None] * len(documents)
        open_ones = list(range(len(documents)))
        for attempt in range(attempts):
            if attempt:
                time.sleep(pause * 2 ** (attempt - 1))
            answers = request([documents[i] for i in open_ones])
            for i, (_, reason) in zip(open_ones, answers, strict=True):
                reasons[i] = reason
            open_ones = [
                i for i, (status, _) in zip(open_ones, answers, strict=True) if status in BUSY
            ]
            if not open_ones:
                break
        return reasons

    return send
