"""The four jobs from the command line, over folders."""

from __future__ import annotations

from datetime import datetime

import pytest
from helpers import order
from pyspark.sql import functions as F

from tillstream import __main__ as cli
from tillstream.entities import ENTITIES, KEYSPACE, ORDERS
from tillstream.sources.keyed import Store


def test_jobs_one_after_another(spark, tmp_path):
    topics, store = f"--topics={tmp_path}/topics", f"--store={tmp_path}/store"
    tables = [store, "--buckets=4"]
    streams = [topics, *tables, f"--checkpoints={tmp_path}/cp", "--once"]
    assert cli.main(["generate", topics, "--as-of=2024-06-30T12:00:00"]) == 0
    for _ in range(2):  # the second run finds nothing new
        assert cli.main(["ingest", *streams]) == 0
        assert cli.main(["transform", *streams]) == 0
    assert cli.main(["sync", *tables]) == 0
    found = Store(spark, KEYSPACE, f"{tmp_path}/store", 4)
    raw = {n: found.read_raw(e).count() for n, e in ENTITIES.items()}
    assert raw == {"products": 50, "customers": 20, "orders": 100, "transactions": 50}
    standing = found.read_raw(ENTITIES["orders"]).filter("status <> 'Cancelled'").count()
    assert found.read(ENTITIES["orders"]).count() == standing < 100
    assert found.index(ENTITIES["orders"]).current(spark).count() == standing
    spark.sql(f"DROP DATABASE {KEYSPACE} CASCADE")


def test_a_place_for_topics_is_required():
    with pytest.raises(SystemExit):
        cli.parser().parse_args(["generate"])


def test_two_stores_read_the_same_topics_from_the_beginning(spark, tmp_path):
    topics = f"--topics={tmp_path}/topics"
    assert cli.main(["generate", topics, "--as-of=2024-06-30T12:00:00"]) == 0
    for place in ("a", "b"):
        store = [f"--store={tmp_path}/{place}", "--buckets=4"]
        for _ in range(2):  # the second run goes on behind the first
            assert cli.main(["ingest", topics, *store, "--once"]) == 0
        found = Store(spark, KEYSPACE, f"{tmp_path}/{place}", 4)
        assert found.raw(ENTITIES["orders"]).versions(spark).count() == 100
        assert found.read_raw(ENTITIES["customers"]).count() == 20
        with pytest.raises(ValueError, match="buckets"):
            cli.main(["sync", f"--store={tmp_path}/{place}", "--buckets=8"])
        spark.sql(f"DROP DATABASE {KEYSPACE} CASCADE")


def test_statements_are_printed(capsys):
    assert cli.main(["ddl"]) == 0
    assert capsys.readouterr().out.count("CREATE TABLE") == 8


def test_sync_after_the_merge_or_before_it(spark, tmp_path):
    """An order that was stored, and cancelled later: its filtered table keeps the older
    version, the merge comes to the newer one and drops it."""
    store = Store(spark, KEYSPACE, f"{tmp_path}/store", 4).ensure()
    raw, kept = store.raw(ORDERS), store.table(ORDERS)
    position = {"timestamp": F.lit("2024-01-01").cast("timestamp"), "partition": F.lit(0)}
    for offset, status in ((0, "Pending"), (1, "Cancelled")):
        one = {**order(1), "order_date": datetime(2024, 1, 2), "status": status}
        row = spark.createDataFrame([one], ORDERS.message)
        row = row.withColumns({**position, "offset": F.lit(offset).cast("bigint")})
        raw.append(row)
        kept.append(row.filter("status <> 'Cancelled'"))
    tables = [f"--store={tmp_path}/store", "--buckets=4"]
    assert cli.main(["sync", "--merge-first", *tables]) == 0
    assert store.index(ORDERS).current(spark).count() == 0
    assert cli.main(["sync", *tables]) == 0
    assert [r.status for r in store.index(ORDERS).current(spark).collect()] == ["Pending"]
    copy = store.copy_to(Store(spark, f"{KEYSPACE}_copy", f"{tmp_path}/copy", 4))
    assert copy.index(ORDERS).current(spark).count() == 1
    for name in (KEYSPACE, copy.database):
        spark.sql(f"DROP DATABASE {name} CASCADE")
