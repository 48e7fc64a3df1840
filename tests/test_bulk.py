"""Bulk writes that return what was refused."""

from __future__ import annotations

import json
from pathlib import Path

from helpers import key
from pyspark.sql import functions as F

from tillstream.entities import CUSTOMERS
from tillstream.plans.sync import sync_listed, sync_table
from tillstream.sources.bulk import bulk_body, bulk_reasons, listing_writer, patient, send_bulk

DDL = "id string, name string, last_synced string"


def refusing(folder, *ids):
    """Notes each request in a file; refuses ``ids``."""

    def connect():
        def send(documents):
            import uuid

            Path(folder, uuid.uuid4().hex).write_text(json.dumps(documents))
            return ["no" if ident in ids else None for ident, _ in documents]

        return send

    return connect


def requests(folder):
    return [json.loads(p.read_text()) for p in Path(folder).iterdir()]


def documents(spark, *rows):
    return spark.createDataFrame([(i, n, "s") for i, n in rows], DDL)


def test_all_are_sent_and_the_refused_come_back(spark, tmp_path):
    rows = [(key(n), f"ü{n}" if n % 3 else None) for n in range(200)]
    bad = {key(n) for n in range(0, 200, 10)}
    frame = documents(spark, *rows).repartition(3)
    got = send_bulk(frame, refusing(tmp_path, *bad), rows=7).collect()
    assert {(r.id, r.reason, r.last_synced) for r in got} == {(i, "no", "s") for i in bad}
    assert len(got) == len(bad)
    asked = requests(tmp_path)
    assert max(map(len, asked)) == 7
    sent = {i: json.loads(t) for group in asked for i, t in group}
    assert sent == {i: {"id": i, "name": n, "last_synced": "s"} for i, n in rows}
    assert all(json.loads(r.document) == sent[r.id] for r in got)


def test_requests_are_bounded_but_one_long_document_goes_alone(spark, tmp_path):
    frame = documents(spark, *[(key(n), "x" * (5_000 if n == 3 else 100)) for n in range(9)])
    assert send_bulk(frame.coalesce(1), refusing(tmp_path), size=600).count() == 0
    lengths = [sum(len(t) for _, t in group) for group in requests(tmp_path)]
    assert sum(n > 600 for n in lengths) == 1
    assert all(len(g) == 1 for g, n in zip(requests(tmp_path), lengths, strict=True) if n > 600)


def test_an_empty_table_sends_nothing(spark, tmp_path):
    assert send_bulk(documents(spark), refusing(tmp_path)).count() == 0
    assert requests(tmp_path) == []


def test_the_report_counts_the_refused_and_the_store_keeps_them(spark, store, tmp_path):
    ids = [key(n) for n in range(30)] + [None]
    table = spark.createDataFrame(
        [(i, "n", None, None, "l", "Gold") for i in ids],
        "customer_id string, name string, email string, signup_date timestamp, location string, "
        "loyalty_status string",
    )
    bad = ids[4:7]
    for stamp, refused in (("s1", bad), ("s2", bad[:1])):
        (report,) = sync_listed(
            store, {"customers": lambda: table}, lambda _: refusing(tmp_path, *refused), synced=stamp
        )
        assert (report.error, report.refused, report.without_id) == (None, len(refused), 1)
        assert report.documents == 30 - len(refused)
    rows = store.refused(CUSTOMERS).current(spark).collect()
    assert {(r.id, r.last_synced) for r in rows} == {(bad[0], "s2"), (bad[1], "s1"), (bad[2], "s1")}


def test_a_request_that_fails_is_an_error_of_its_table(spark, tmp_path):
    def connect():
        def send(_):
            raise OSError("unreachable")

        return send

    table = documents(spark, (key(1), "a")).withColumnRenamed("id", "customer_id")
    mapper = lambda _: [F.col("customer_id").alias("id")]
    report = sync_table(
        lambda: table, "i", mapper, listing_writer(connect, lambda rows: rows.collect()), synced="s"
    )
    assert "unreachable" in report.error and report.documents == report.refused == 0


def test_only_documents_sent_back_by_a_busy_index_are_sent_again():
    asked = []

    def request(group):
        asked.append([i for i, _ in group])
        busy = len(asked) < 3
        return [
            (429, "full") if i == "a" and busy else (400, "bad") if i == "b" else (201, None)
            for i, _ in group
        ]

    pairs = [("a", "{}"), ("b", "{}"), ("c", "{}")]
    assert patient(request, 5, 0.0)(pairs) == [None, "bad", None]
    assert asked == [["a", "b", "c"], ["a"], ["a"]]
    asked.clear()
    assert patient(request, 2, 0.0)(pairs) == ["full", "bad", None]


def test_bulk_request_and_answer():
    lines = bulk_body("i", [('q"1', '{"x":1}')]).decode().split("\n")
    assert json.loads(lines[0]) == {"index": {"_index": "i", "_id": 'q"1'}}
    assert lines[1:] == ['{"x":1}', ""]
    answer = {
        "items": [
            {"index": {"_id": "1", "status": 201}},
            {"index": {"_id": "2", "status": 400, "error": {"type": "t", "reason": "r"}}},
            {"index": {"_id": "3", "status": 429}},
        ]
    }
    assert bulk_reasons(answer) == [(201, None), (400, "t: r"), (429, "status 429")]
