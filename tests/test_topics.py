"""Publishing, and the options of the external systems."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from tillstream.sources import connectors
from tillstream.sources.topics import folder_writer, publish, read_folder


def test_publish_counts_and_reports(spark, tmp_path):
    seen = []
    rows = spark.range(25).select("id", F.lit(None).cast("string").alias("note"))
    report = publish(rows, "t", folder_writer(str(tmp_path / "t")), delivered=seen.append)
    assert (report.topic, report.messages, report.error) == ("t", 25, None) and seen == [report]
    got = read_folder(spark, str(tmp_path / "t")).collect()
    assert sorted(json.loads(bytes(r.value))["id"] for r in got) == list(range(25))
    assert all(json.loads(bytes(r.value))["note"] is None for r in got)
    assert {r.key for r in got} == {None} and len({(r.partition, r.offset) for r in got}) == 25


def test_publishing_nothing(spark, tmp_path):
    assert publish(spark.range(0), "t", folder_writer(str(tmp_path / "t"))).messages == 0


def test_failed_publish_is_reported(spark):
    def broken(_):
        raise RuntimeError("no broker")

    report = publish(spark.range(3), "t", broken)
    assert report.messages == 0 and "no broker" in report.error


def test_kafka_options():
    assert connectors.kafka_read_options("h:9092", ["a", "b"], per_batch=10, tasks=64) == {
        "kafka.bootstrap.servers": "h:9092",
        "subscribe": "a,b",
        "startingOffsets": "earliest",
        "maxOffsetsPerTrigger": "10",
        "minPartitions": "64",
    }


def test_cassandra_options():
    assert connectors.cassandra_options("k", "t") == {"keyspace": "k", "table": "t"}
    assert connectors.cassandra_options("k", "t", "h")["spark.cassandra.connection.host"] == "h"


def test_index_options():
    options = connectors.index_options("h", 9201)
    assert options["es.nodes"] == "h" and options["es.port"] == "9201"
    assert options["es.mapping.id"] == "id" and options["es.write.operation"] == "index"


def test_cassandra_statements():
    statements = connectors.cassandra_ddl("shop", replicas=3)
    assert "'replication_factor': 3" in statements[0] and len(statements) == 9
    assert statements[1] == (
        "CREATE TABLE IF NOT EXISTS shop.products (product_id uuid, title text, price float, "
        "description text, category text, stock int, price_with_tax double, "
        "PRIMARY KEY (product_id))"
    )
    assert statements[2].startswith("CREATE TABLE IF NOT EXISTS shop.raw_products (")
    assert "price_with_tax" not in statements[2]
    assert "customer_id uuid, product_id uuid, order_date timestamp" in statements[5]


def test_refused_documents_are_passed_over():
    assert connectors.index_options("h")["es.write.rest.error.handlers"] == "log"


def test_late_older_versions_carry_the_older_write_time(spark):
    rows = spark.sql(
        "select 'k' as id, 1 as n, timestamp_millis(m) as timestamp, 0 as partition, o as offset "
        "from values (1700000000000, 4l), (1700000000000, 5l), (1700000000001, 1l), "
        "(1699999999999, 999l), (null, 7l) as v(m, o)"
    )
    sent = connectors.written_columns(rows, ["id", "n"], True)
    assert sent.columns == ["id", "n", connectors.WRITE_TIME]
    times = [r[2] for r in sent.collect()]
    assert times[3] < times[0] < times[1] < times[2] and times[4] is None
    assert times[0] == 1_700_000_000_000_004
    fine = rows.withColumn("timestamp", F.timestamp_micros(F.lit(1_700_000_000_000_123)))
    assert {r[2] for r in connectors.written_columns(fine, ["id", "n"], True).collect()} == {
        1_700_000_000_000_123
    }
    assert connectors.written_columns(rows, ["id"], False).columns == ["id"]


def test_write_time_is_an_option_of_the_writer(spark, monkeypatch):
    seen = {}

    class Writer:
        def format(self, name):
            seen["format"] = name
            return self

        def options(self, **options):
            seen.update(options)
            return self

        def mode(self, name):
            return self

        def save(self):
            seen["saved"] = True

    frame = type(spark.range(0))
    monkeypatch.setattr(frame, "write", property(lambda self: Writer()))
    rows = spark.sql("select 1 as id, current_timestamp() as timestamp, 2l as offset")
    connectors.cassandra_writer("k", "t", ["id"], "h", by_position=True)(rows)
    assert seen["writetime"] == connectors.WRITE_TIME and seen["saved"]
    seen.clear()
    connectors.cassandra_writer("k", "t", ["id"], "h")(rows)
    assert "writetime" not in seen and seen["table"] == "t"
