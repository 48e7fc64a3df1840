"""Queries whose work must be shared out over tasks when their tables grow."""

from __future__ import annotations

import time
from pathlib import Path

from helpers import key, land_file, messages, plan_of, product
from pyspark.sql import functions as F

from tillstream.entities import CUSTOMERS, PRODUCTS

from tillstream.plans import catalogue
from tillstream.sources import topics, views
from tillstream.streaming.ingest import ALL_AVAILABLE, finish_all, start_raw

SMALL = "/root/testdata/sf0.001"


def test_a_delivery_is_written_by_many_tasks_and_read_in_one_batch(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(catalogue, "fresh_folder", lambda _, label: str(tmp_path / f"{label}-x"))
    monkeypatch.setattr(catalogue, "files_for", lambda rows: 3)
    rows = catalogue.stream_drained_resumed(spark, SMALL)
    assert rows.count() == spark.read.parquet(f"{SMALL}/orders.parquet").count()
    assert len(list(Path(tmp_path / "topics-x").glob("topic=*/*.parquet"))) == 9
    batches = list(Path(tmp_path / "drained-x/checkpoints").glob("*/commits/[0-9]*"))
    assert len(batches) == 3


def test_files_grow_with_the_rows():
    assert [catalogue.files_for(n) for n in (0, 249_999, 18_000_000)] == [1, 1, 73]


def test_many_orders_are_dealt_out_before_they_are_wide(spark, monkeypatch):
    before = {name: sorted(map(str, views.VIEWS[name](spark, SMALL).collect())) for name in ("orders", "transactions")}
    monkeypatch.setattr(views, "ROWS_A_TASK", 100)
    for name, rows in before.items():
        wide = views.VIEWS[name](spark, SMALL)
        assert "REPARTITION_BY_NUM" in plan_of(wide) and sorted(map(str, wide.collect())) == rows


def test_tables_are_written_with_an_entropy_code(spark, store, tmp_path):
    rows = spark.createDataFrame([(key(1), "n", "e", None, "l", "Gold", None, 0, 0)], f"{CUSTOMERS.message}, timestamp timestamp, partition int, offset bigint")
    store.raw(CUSTOMERS).append(rows)
    assert [f.name for f in Path(store.folder).glob("raw_customers*/*.zstd.parquet")]


def ends_as(found, wanted, seconds: float = 20) -> bool:
    """Files are deleted behind a query's back."""
    until = time.time() + seconds
    while found() != wanted and time.time() < until:
        time.sleep(0.1)
    return found() == wanted


def shuffle_files(spark) -> set[str]:
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    names = disk.getAllFiles().mkString("|").split("|")
    return {name for name in names if "/shuffle_" in name}


def test_topics_are_written_with_an_entropy_code(spark, tmp_path):
    topics.publish(spark.range(3), "t", topics.folder_writer(str(tmp_path)))
    assert len(list(tmp_path.glob("topic=t/*.zstd.parquet"))) == len(list(tmp_path.glob("topic=t/*.parquet")))


def test_publishing_leaves_no_shuffle_files(spark, tmp_path):
    before = shuffle_files(spark)
    rows = spark.range(100).repartition(3, "id").groupBy((F.col("id") % 7).alias("n")).count()
    assert topics.publish(rows, "t", topics.folder_writer(str(tmp_path))).messages == 7
    assert ends_as(lambda: shuffle_files(spark) - before, set())


def backlog(spark, folder, files: int) -> None:
    for number in range(files):
        sent = [product(number), product(100, title=f"v{number}"), "{bad"]
        land_file(messages(spark, PRODUCTS.topic, sent, start=3 * number), folder)


def deliver(spark, store, folder, checkpoints, **how) -> list[tuple[int, int]]:
    reports = []
    sent = topics.stream_folder(spark, str(folder), **how)
    finish_all([start_raw(sent, store, str(checkpoints), trigger=ALL_AVAILABLE, report=reports.append)])
    return [(r.read, r.rejected) for r in reports]


def test_a_backlog_is_read_in_batches_of_so_many_bytes(spark, store, tmp_path, monkeypatch):
    backlog(spark, tmp_path / "topics", 4)
    one = max(f.stat().st_size for f in (tmp_path / "topics").glob("*/*.parquet"))
    monkeypatch.setattr(topics, "BYTES_PER_BATCH", 2 * one)
    before = shuffle_files(spark)
    assert deliver(spark, store, tmp_path / "topics", tmp_path / "a") == [(6, 2), (6, 2)]
    assert ends_as(lambda: shuffle_files(spark) - before, set())
    monkeypatch.setattr(topics, "BYTES_PER_BATCH", 1)  # a file that is larger is a batch
    assert deliver(spark, store, tmp_path / "topics", tmp_path / "b") == [(3, 1)] * 4
    rows = {r.product_id: r.title for r in store.read_raw(PRODUCTS).collect()}
    assert rows == {key(100): "v3"} | {key(n): f"thing {n}" for n in range(4)}
    assert store.letters("raw").current(spark).count() == 4


def test_only_the_last_reader_gives_back_what_is_stored(spark, store, tmp_path, monkeypatch):
    folder = tmp_path / "topics"
    backlog(spark, folder, 4)
    monkeypatch.setattr(topics, "BYTES_PER_BATCH", 1)
    deliver(spark, store, folder, tmp_path / "first")
    rows = sorted(store.read_raw(PRODUCTS).collect())
    assert len(rows) == 5 and len(list(folder.glob("*/*.parquet"))) == 4
    read = deliver(spark, store, folder, tmp_path / "second", last_reader=True)
    assert read == [(3, 1)] * 4 and sorted(store.read_raw(PRODUCTS).collect()) == rows
    assert ends_as(lambda: len(list(folder.glob("*/*.parquet"))) <= 1, True)


def test_a_replay_in_many_batches_leaves_the_topics_of_its_last_one(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(catalogue, "fresh_folder", lambda _, label: str(tmp_path / f"{label}-replay"))
    monkeypatch.setattr(topics, "BYTES_PER_BATCH", 20_000)
    stream_folder, sent = catalogue.stream_folder, []

    def held() -> int:
        return sum(f.stat().st_size for f in Path(tmp_path / "topics-replay").glob("*/*.parquet"))

    def watched(*args, **how):
        sent.append(held())
        return stream_folder(*args, **how)

    monkeypatch.setattr(catalogue, "stream_folder", watched)
    rows = catalogue.stream_replay_unchanged(spark, SMALL)
    wanted = views.VIEWS["transactions"](spark, SMALL)
    assert rows.count() == wanted.count() and rows.select(wanted.columns).exceptAll(wanted).isEmpty()
    place = Path(tmp_path / "replayed-replay")
    first, second = [len(list(place.glob(f"{run}/*/commits/[0-9]*"))) for run in ("first", "second")]
    assert first == second > 2 and sent[0] == sent[1] > 100_000
    assert ends_as(lambda: held() <= 20_000, True)
