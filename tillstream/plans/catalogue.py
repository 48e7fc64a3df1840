"""The registered queries. Each maps (spark, folder of parquet tables) to rows."""

from __future__ import annotations

import threading
from collections.abc import Callable
from datetime import datetime
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillstream.entities import CUSTOMERS, ENTITIES, POSITION, PRODUCTS, TRANSACTIONS, Entity
from tillstream.functions.draws import digest, wide_draw
from tillstream.functions.ids import canonical_uuid, derived_uuid
from tillstream.functions.isotime import iso_date, iso_seconds, iso_text, moment_of
from tillstream.functions.wire import (
    REASON,
    accepted,
    decode,
    grade_lenient,
    grade_strict,
    message_text,
    parse_fields,
    rejected,
)
from tillstream.operators.documents import FOREIGN_KEYS, MAPPERS, to_documents
from tillstream.operators.latest import (
    filter_then_merge,
    latest_per_key,
    merge_then_filter,
    upsert,
)
from tillstream.operators.reference import by_position, pick_reference, with_ordinal
from tillstream.operators.sample import sample_rows
from tillstream.operators.transforms import sellable_products, standing_orders
from tillstream.plans.changes import sync_all_changed
from tillstream.plans.sync import sync_all, sync_listed
from tillstream.sources.bulk import Connect
from tillstream.sources.generate import (
    generate_customers,
    generate_orders,
    generate_products,
    generate_transactions_of,
    payments_for,
)
from tillstream.sources.keyed import Store
from tillstream.sources.topics import (
    Delivery,
    folder_writer,
    publish,
    read_folder,
    stream_folder,
    to_messages,
)
from tillstream.sources.views import VIEWS, load
from tillstream.streaming.append import start_append
from tillstream.streaming.ingest import (
    ALL_AVAILABLE,
    BatchReport,
    finish_all,
    start_all,
    start_raw,
    start_topic,
    write_log,
)
from tillstream.streaming.changes import read_changes, start_changes
from tillstream.streaming.generated import run_until, stream_ids
from tillstream.streaming.sketches import (
    DISTINCT_ERROR,
    QUANTILES,
    RANK_ERROR,
    delay,
    estimates,
    merged,
    start_sketches,
)
from tillstream.streaming.supervise import Supervisor
from tillstream.workspace import fresh_folder

Query = Callable[[SparkSession, str], DataFrame]

AS_OF = datetime(2024, 6, 30, 12, 0, 0)
FIRST_SYNC, SECOND_SYNC = "2024-01-01T00:00:00", "2024-01-02T00:00:00.000001"


def payload(rows: DataFrame, entity: Entity) -> Column:
    """All columns but the key in one text: money in cents, null as ``~``."""
    kinds = dict(rows.dtypes)

    def cell(name: str) -> Column:
        column = F.col(name)
        if kinds[name] in ("float", "double"):
            column = F.round(column.cast("double") * 100).cast("bigint")
        elif kinds[name].startswith("timestamp"):
            column = iso_text(column)
        return F.coalesce(column.cast("string"), F.lit("~"))

    return F.concat_ws("|", *[cell(name) for name in entity.columns if name != entity.key])


def _stored(rows: DataFrame, entity: Entity, table: str) -> DataFrame:
    """Rows of a table as (table_name, id, payload)."""
    return rows.select(
        F.lit(table).alias("table_name"),
        F.col(entity.key).alias("id"),
        payload(rows, entity).alias("payload"),
    )


def naive(frame: DataFrame) -> DataFrame:
    """Timestamps as the wall clock of the session, like the given tables."""
    local = {
        f.name: F.col(f.name).cast("timestamp_ntz")
        for f in frame.schema.fields
        if isinstance(f.dataType, T.TimestampType)
    }
    return frame.withColumns(local) if local else frame


def _count(spark: SparkSession, folder: str, table: str) -> int:
    return load(spark, folder, table).count()


def open_store(spark: SparkSession, folder: str, label: str) -> Store:
    """A store of its own for one run of a query, laid out for the largest entity."""
    place = fresh_folder(spark, label)
    database = place.rsplit("/", 1)[1].replace("-", "_")
    return Store(spark, database, place, buckets_for(_count(spark, folder, "orders"))).ensure()


def buckets_for(rows: int) -> int:
    """Buckets of about a million rows; a power of two, to divide evenly."""
    return max(8, 1 << (rows // 1_000_000).bit_length())


def files_for(rows: int) -> int:
    """Files of about a quarter of a million messages, each written by a task of its own."""
    return 1 + rows // 250_000


# --- parsing and transforms -------------------------------------------------


def json_round_trip(entity: Entity, spark: SparkSession, folder: str) -> DataFrame:
    messages = to_messages(VIEWS[entity.name](spark, folder), entity.topic)
    return naive(decode(messages, entity))


def products_in_stock_taxed(spark: SparkSession, folder: str) -> DataFrame:
    return sellable_products(VIEWS["products"](spark, folder))


def products_ingested(spark: SparkSession, folder: str) -> DataFrame:
    """From message bytes to taxed products in stock."""
    return sellable_products(json_round_trip(PRODUCTS, spark, folder))


def orders_not_cancelled(spark: SparkSession, folder: str) -> DataFrame:
    return standing_orders(VIEWS["orders"](spark, folder))


def event_props_parse(spark: SparkSession, folder: str) -> DataFrame:
    events = load(spark, folder, "events")
    return parse_fields(events, F.col("props"), "k int", "event_id")


def _spoiled_events(spark: SparkSession, folder: str) -> DataFrame:
    """All events as messages; half of them are no proper JSON object."""
    events = load(spark, folder, "events")
    kind, props = F.col("event_id") % 20, F.col("props")
    value = (
        F.when(kind.isin(0, 10), "{bad")
        .when(kind.isin(1, 11), '{"k":"x"}')
        .when(kind.isin(2, 12), "[1]")
        .when(kind == 3, F.concat(props, F.lit(" and more")))
        .when(kind == 4, F.concat(props, props))
        .when(kind == 5, F.replace(props, F.lit('"'), F.lit("'")))
        .when(kind == 6, F.concat(props, F.lit("]")))
        .otherwise(props)
    )
    no_text = F.concat(props.cast("binary"), F.unhex(F.lit("FF")))
    value = F.when(kind == 7, no_text).otherwise(value.cast("binary"))
    return events.select("event_id", value.alias("value"))


def dead_letter_split(spark: SparkSession, folder: str) -> DataFrame:
    graded = grade_strict(_spoiled_events(spark, folder), Entity("events", "k int"))
    return rejected(graded).select("event_id", F.hex("value").alias("value"), REASON)


def accepted_messages(spark: SparkSession, folder: str) -> DataFrame:
    graded = grade_strict(_spoiled_events(spark, folder), Entity("events", "k int"))
    return accepted(graded).select("event_id", "k")


def permissive_parse(spark: SparkSession, folder: str) -> DataFrame:
    """The lenient parse keeps every message; what cannot be read is null."""
    return decode(_spoiled_events(spark, folder), Entity("events", "k int"), "event_id")


def uuid_canonical(spark: SparkSession, folder: str) -> DataFrame:
    """Every accepted spelling of a UUID, and two that are none."""
    key = F.col("o_orderkey")
    plain = derived_uuid("order", key)
    spelled = (
        F.when(key % 6 == 0, F.upper(plain))
        .when(key % 6 == 1, F.concat(F.lit("{"), plain, F.lit("}")))
        .when(key % 6 == 2, F.concat(F.lit("urn:uuid:"), plain))
        .when(key % 6 == 3, F.replace(plain, F.lit("-"), F.lit("")))
        .when(key % 6 == 4, F.concat(plain, F.lit("0")))
        .otherwise(F.concat(F.lit("g"), F.substring(plain, 2, 35)))
    )
    orders = load(spark, folder, "orders").select("o_orderkey", spelled.alias("spelled"))
    return orders.select("o_orderkey", canonical_uuid(F.col("spelled")).alias("order_id"))


def iso_datetimes(spark: SparkSession, folder: str) -> DataFrame:
    """ISO text with and without fraction, and back without it."""
    text = iso_text(F.col("ts"))
    return load(spark, folder, "events").select(
        "event_id",
        text.alias("iso"),
        iso_seconds(F.col("ts")).alias("iso_seconds"),
        iso_date(F.col("ts")).alias("iso_date"),
        moment_of(text).alias("whole_second"),
    )


# --- upsert -----------------------------------------------------------------


def upsert_latest_event(spark: SparkSession, folder: str) -> DataFrame:
    events = load(spark, folder, "events")
    return latest_per_key(events, ["user_id"], ["ts", "event_id"])


def upsert_two_loads(spark: SparkSession, folder: str) -> DataFrame:
    """Purchases are stored first, then everything else arrives on top of them."""
    events = load(spark, folder, "events")
    bought = F.col("event_type") == "purchase"
    order = ["ts", "event_id"]
    stored = latest_per_key(events.filter(bought), ["user_id"], order)
    return upsert(stored, events.filter(~bought), ["user_id"], order)


def _no_errors(events: DataFrame) -> DataFrame:
    return events.filter(F.col("event_type") != "error")


def merge_then_filter_events(spark: SparkSession, folder: str) -> DataFrame:
    events = load(spark, folder, "events")
    return merge_then_filter(events, _no_errors, ["user_id"], ["event_id"])


def filter_then_merge_events(spark: SparkSession, folder: str) -> DataFrame:
    events = load(spark, folder, "events")
    return filter_then_merge(events, _no_errors, ["user_id"], ["event_id"])


def ensure_tables(spark: SparkSession, folder: str) -> DataFrame:
    """Declare the tables twice, load each entity twice, and read it back."""
    store = open_store(spark, folder, "declared").ensure()
    parts = []
    for name, entity in ENTITIES.items():
        for offset in (0, 1):
            rows = VIEWS[name](spark, folder).withColumns(
                {
                    "timestamp": F.lit("2024-01-01").cast("timestamp"),
                    "partition": F.lit(0),
                    "offset": F.lit(offset).cast("bigint"),
                }
            )
            store.raw(entity).append(rows)
        parts.append(_stored(store.read_raw(entity), entity, name))
    return _stacked(parts)


def _stacked(parts: list[DataFrame]) -> DataFrame:
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole


# --- streams ----------------------------------------------------------------


def _event_stream(spark: SparkSession, folder: str) -> DataFrame:
    schema = load(spark, folder, "events").schema
    reader = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet")
    return reader.parquet(folder)


def stream_filter_append(spark: SparkSession, folder: str, runs: int = 1) -> DataFrame:
    """Stateless append; further runs with the same checkpoint add nothing."""
    place = fresh_folder(spark, "append")
    for _ in range(runs):
        start_append(
            _event_stream(spark, folder),
            _no_errors,
            f"{place}/rows",
            f"{place}/checkpoint",
            name=place.rsplit("/", 1)[1],
            trigger=ALL_AVAILABLE,
        ).awaitTermination()
    return spark.read.parquet(f"{place}/rows")


def stream_restart_no_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return stream_filter_append(spark, folder, runs=2)


def _publish_entities(spark: SparkSession, folder: str) -> str:
    """The four entities as topics."""
    place = fresh_folder(spark, "topics")
    for name, entity in ENTITIES.items():
        _sent(publish(VIEWS[name](spark, folder), entity.topic, folder_writer(place)))
    return place


def _published(spark: SparkSession, folder: str) -> str:
    """The topics with three kinds of noise: a tombstone per customer, a topic that
    belongs to no entity, and in every topic a broken message per supplier."""
    place = _publish_entities(spark, folder)
    write, nothing = folder_writer(place), F.lit(None).cast("string")
    customers, events = load(spark, folder, "customer"), load(spark, folder, "events")
    _sent(publish(customers, CUSTOMERS.topic, write, value=nothing))
    _sent(publish(events, "ecommerce-events", write, value=F.col("props")))
    _publish_broken(spark, folder, place, 1)
    return place


def _publish_broken(spark: SparkSession, folder: str, place: str, run: int) -> None:
    """A JSON object that breaks off, per supplier, into every topic."""
    text = F.concat(F.lit(f'{{"run":{run},"supplier":'), F.col("s_suppkey").cast("string"))
    suppliers = load(spark, folder, "supplier")
    for entity in ENTITIES.values():
        _sent(publish(suppliers, entity.topic, folder_writer(place), value=text))


def _sent(delivery: Delivery) -> None:
    if delivery.error:
        raise RuntimeError(delivery.error)


def four_streams(spark: SparkSession, folder: str) -> DataFrame:
    """One stream per topic into transformed tables."""
    place, store = _published(spark, folder), open_store(spark, folder, "streams")
    sources = {n: stream_folder(spark, place, e.topic) for n, e in ENTITIES.items()}
    finish_all(start_all(sources, store, f"{store.folder}/checkpoints", trigger=ALL_AVAILABLE))
    taxed = {"products": F.col("price_with_tax")}
    parts = []
    for n, e in ENTITIES.items():
        rows = store.read(e)
        tax = taxed.get(n, F.lit(None).cast("double"))
        parts.append(
            rows.select(
                F.lit(n).alias("table_name"),
                F.col(e.key).alias("id"),
                payload(rows, e).alias("payload"),
                tax.alias("price_with_tax"),
            )
        )
    return _stacked(parts)


def route_by_topic(spark: SparkSession, folder: str) -> DataFrame:
    """One stream over all topics into raw tables and dead letters."""
    place, store = _published(spark, folder), open_store(spark, folder, "routed")
    messages = stream_folder(spark, place)
    finish_all([start_raw(messages, store, f"{store.folder}/checkpoints", trigger=ALL_AVAILABLE)])
    stored = [_stored(store.read_raw(e), e, f"raw_{n}") for n, e in ENTITIES.items()]
    letters = store.letters("raw").current(spark)
    text = message_text(F.col("value"))
    dead = letters.select(
        F.concat(F.lit("dead "), F.col("topic")).alias("table_name"),
        F.get_json_object(text, "$.order_id").alias("id"),
        F.col(REASON).alias("payload"),
    )
    return _stacked([*stored, dead])


def stream_replay_unchanged(spark: SparkSession, folder: str) -> DataFrame:
    """Everything is delivered twice, under two checkpoints: no row changes.

    The topics are this query's own, so the second delivery, which nothing reads after,
    gives back what it has stored."""
    place, store = _published(spark, folder), open_store(spark, folder, "replayed")
    for run in ("first", "second"):
        messages = stream_folder(spark, place, last_reader=run == "second")
        finish_all([start_raw(messages, store, f"{store.folder}/{run}", trigger=ALL_AVAILABLE)])
    return naive(store.read_raw(TRANSACTIONS))


def stream_dead_letters(spark: SparkSession, folder: str) -> DataFrame:
    """Broken messages, published twice with other content, on both ways in."""
    place, store = fresh_folder(spark, "topics"), open_store(spark, folder, "letters")
    for run in (1, 2):
        _publish_broken(spark, folder, place, run)
    sources = {n: stream_folder(spark, place, e.topic) for n, e in ENTITIES.items()}
    checkpoints = f"{store.folder}/checkpoints"
    ways = start_all(sources, store, checkpoints, trigger=ALL_AVAILABLE)
    ways.append(
        start_raw(stream_folder(spark, place), store, checkpoints, trigger=ALL_AVAILABLE)
    )
    finish_all(ways)
    return _stacked(
        [
            store.letters(way).current(spark).select(
                F.lit(way).alias("way"), "topic", message_text(F.col("value")).alias("value"), REASON
            )
            for way in (*ENTITIES, "raw")
        ]
    )


def stream_changes_only(spark: SparkSession, folder: str) -> DataFrame:
    """Transactions are published twice; only the first time anything changes."""
    place, changes = fresh_folder(spark, "topics"), fresh_folder(spark, "changes")
    rows = VIEWS["transactions"](spark, folder)
    for _ in range(2):
        _sent(publish(rows, TRANSACTIONS.topic, folder_writer(place)))
        graded = grade_lenient(stream_folder(spark, place), TRANSACTIONS)
        start_changes(
            accepted(graded),
            TRANSACTIONS,
            changes,
            f"{place}-checkpoints",
            name=changes.rsplit("/", 1)[1],
            trigger=ALL_AVAILABLE,
        ).awaitTermination()
    return naive(read_changes(spark, TRANSACTIONS, changes).drop(*POSITION))


def stream_drained_resumed(spark: SparkSession, folder: str) -> DataFrame:
    """A stream of one delivery a batch is drained after its first batch, and goes on later."""
    place, store = fresh_folder(spark, "topics"), open_store(spark, folder, "drained")
    rows = VIEWS["transactions"](spark, folder)
    files = files_for(_count(spark, folder, "orders") // 3)
    for part in range(3):
        some = rows.filter(F.pmod(F.xxhash64("transaction_id"), F.lit(3)) == part)
        dealt = some.repartition(files, "transaction_id")
        _sent(publish(dealt, TRANSACTIONS.topic, folder_writer(place)))
    for drained in (True, False):
        draining = threading.Event()
        start = partial(
            start_topic,
            stream_folder(spark, place, files_per_batch=files),
            TRANSACTIONS,
            store.table(TRANSACTIONS).append_folded,
            store.letters(TRANSACTIONS.name).append,
            f"{store.folder}/checkpoints",
            name=f"{store.database}_{TRANSACTIONS.name}",
            trigger=ALL_AVAILABLE,
            closed=draining.is_set,
            report=(lambda _, end=draining: end.set()) if drained else write_log,
        )
        failed = Supervisor(spark, {"transactions": start}, draining=draining).run()
        if any(failed.values()):
            raise RuntimeError(str(failed))
    return naive(store.table(TRANSACTIONS).versions(spark).drop(*POSITION))


def batch_reports(spark: SparkSession, folder: str) -> DataFrame:
    """How many messages each topic's stream read and rejected."""
    place, store = _published(spark, folder), open_store(spark, folder, "reported")
    reports: list[BatchReport] = []
    sources = {n: stream_folder(spark, place, e.topic) for n, e in ENTITIES.items()}
    finish_all(
        start_all(
            sources,
            store,
            f"{store.folder}/checkpoints",
            trigger=ALL_AVAILABLE,
            report=reports.append,
        )
    )
    rows = [(r.query.rsplit("_", 1)[1], r.read, r.rejected) for r in reports]
    per_batch = spark.createDataFrame(rows, "topic string, read bigint, rejected bigint")
    return per_batch.groupBy("topic").agg(
        F.sum("read").alias("messages"), F.sum("rejected").alias("rejected")
    )


def stream_sketches(spark: SparkSession, folder: str) -> DataFrame:
    """Users and delays per type of event from sketches of four batches, merged, and
    whether they lie within their bounds of what all events say."""
    place, events = fresh_folder(spark, "sketches"), load(spark, folder, "events")
    events.repartition(4, "event_id").write.parquet(f"{place}/events")
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1)
    kind, ts = ["event_type"], F.col("ts")
    start_sketches(
        stream.parquet(f"{place}/events"),
        kind,
        F.col("user_id"),
        ts,
        f"{place}/sketches",
        f"{place}/checkpoint",
        name=place.rsplit("/", 1)[1],
        as_of=AS_OF,
        trigger=ALL_AVAILABLE,
    ).awaitTermination()
    found = estimates(merged(spark.read.parquet(f"{place}/sketches"), kind))
    late = delay(ts, AS_OF)
    named = {q: f"delay_{round(q * 100)}" for q in QUANTILES}
    truth = events.join(F.broadcast(found), kind).groupBy(*kind, "rows", "distinct_keys").agg(
        F.count_distinct("user_id").alias("users"),
        *[
            F.abs(F.avg((late <= F.col(n)).cast("int")) - q).alias(n)
            for q, n in named.items()
        ],
    )
    off = F.abs(F.col("distinct_keys") - F.col("users"))
    return truth.select(
        *kind,
        "rows",
        "users",
        (off <= DISTINCT_ERROR * F.col("users")).alias("users_close"),
        *[(F.col(n) <= RANK_ERROR).alias(f"{n}_close") for n in named.values()],
    )


def publish_topic(spark: SparkSession, folder: str) -> DataFrame:
    """Publish the entities, then read the topics back as text."""
    place = _publish_entities(spark, folder)
    keys = F.array_join(F.json_object_keys(message_text(F.col("value"))), ",")
    sent, parts = read_folder(spark, place).withColumn("fields", keys), []
    for entity in ENTITIES.values():
        rows = decode(sent.filter(F.col("topic") == entity.topic), entity, "topic", "fields")
        key = F.col(entity.key).alias("id")
        parts.append(rows.select("topic", "fields", key, payload(rows, entity).alias("payload")))
    return _stacked(parts)


# --- documents --------------------------------------------------------------


def documents(
    name: str, spark: SparkSession, folder: str, none_text: tuple[str, ...] = ()
) -> DataFrame:
    return to_documents(VIEWS[name](spark, folder), MAPPERS[name], FIRST_SYNC, none_text)


def sync_index_upsert(spark: SparkSession, folder: str) -> DataFrame:
    """Sync all rows, then only what the transforms keep: documents of rows that
    are gone stay as they were, the others are replaced."""
    store = open_store(spark, folder, "indices")
    everything = {n: partial(view, spark, folder) for n, view in VIEWS.items()}
    remaining = {
        **everything,
        "orders": lambda: standing_orders(everything["orders"]()),
        "products": lambda: everything["products"]().filter(F.col("stock") > 0),
    }
    for tables, stamp in ((everything, FIRST_SYNC), (remaining, SECOND_SYNC)):
        failed = [r for r in sync_all(store, tables, synced=stamp) if r.error]
        if failed:
            raise RuntimeError(str(failed))
    parts = []
    for e in ENTITIES.values():
        rows, name = store.index(e).current(spark), F.lit(e.index).alias("index_name")
        parts.append(rows.select(name, "id", payload(rows, e).alias("payload"), "last_synced"))
    return _stacked(parts)


def documents_null_dates(spark: SparkSession, folder: str) -> DataFrame:
    """Documents of orders of which every seventh has no date."""
    orders = load(spark, folder, "orders")
    date = F.when(F.col("o_orderkey") % 7 != 0, F.col("o_orderdate"))
    rows = orders.select(
        derived_uuid("order", F.col("o_orderkey")).alias("order_id"),
        derived_uuid("customer", F.col("o_custkey")).alias("customer_id"),
        F.lit(None).cast("string").alias("product_id"),
        date.alias("order_date"),
        (F.col("o_orderkey") % 5 + 1).cast("int").alias("quantity"),
        F.col("o_orderstatus").alias("status"),
    )
    return to_documents(rows, MAPPERS["orders"], FIRST_SYNC)


def sync_changes(spark: SparkSession, folder: str) -> DataFrame:
    """Sync, then sync what changed: products without stock get another title, those of
    unknown stock come new, cancelled orders are gone, and nothing else is written."""
    store = open_store(spark, folder, "changes")
    first = {n: partial(view, spark, folder) for n, view in VIEWS.items()}
    title = F.when(F.col("stock") == 0, F.concat("title", F.lit("*"))).otherwise(F.col("title"))
    second = {
        **first,
        "products": lambda: first["products"]().withColumn("title", title),
        "orders": lambda: standing_orders(first["orders"]()),
    }
    known = {**first, "products": lambda: first["products"]().filter("stock is not null")}
    for tables, stamp in ((known, FIRST_SYNC), (second, SECOND_SYNC)):
        failed = [r for r in sync_all_changed(store, tables, synced=stamp) if r.error]
        if failed:
            raise RuntimeError(str(failed))
    parts = []
    for e in ENTITIES.values():
        rows = store.index(e).current(spark)
        gone = store.gone(e).current(spark).select("id", F.col("last_synced").alias("gone_since"))
        listed = rows.select("id", payload(rows, e).alias("payload"), "last_synced")
        parts.append(listed.join(gone, "id", "left").withColumn("index_name", F.lit(e.index)))
    return _stacked(parts)


def _tenth_refused(_: Entity) -> Connect:
    """An index that refuses about every tenth document, by the end of its id."""

    def connect():
        def reason(ident: str) -> str | None:
            digits = int(ident[-4:], 16)
            return f"unwanted id ending in {ident[-4:]}" if digits % 10 == 0 else None

        return lambda documents: [reason(ident) for ident, _ in documents]

    return connect


def sync_refused(spark: SparkSession, folder: str) -> DataFrame:
    """Every document that the index refused, with its reason, and its entity's counts."""
    store = open_store(spark, folder, "refused")
    tables = {n: partial(view, spark, folder) for n, view in VIEWS.items()}
    parts = []
    reports = sync_listed(store, tables, _tenth_refused, synced=FIRST_SYNC)
    for entity, report in zip(ENTITIES.values(), reports, strict=True):
        if report.error:
            raise RuntimeError(report.error)
        rows = store.refused(entity).current(spark)
        parts.append(
            rows.select(
                F.lit(entity.index).alias("index_name"),
                "id",
                "reason",
                F.array_join(F.json_object_keys("document"), ",").alias("fields"),
                "last_synced",
                F.lit(report.refused).cast("bigint").alias("refused"),
                F.lit(report.documents).cast("bigint").alias("taken"),
            )
        )
    return _stacked(parts)


# --- generators and sampling ------------------------------------------------


def _ids(spark: SparkSession, folder: str, table: str, key: str) -> DataFrame:
    return load(spark, folder, table).select(F.col(key).alias("id"))


def generated_products(spark: SparkSession, folder: str) -> DataFrame:
    return generate_products(_ids(spark, folder, "part", "p_partkey"))


def generated_customers(spark: SparkSession, folder: str) -> DataFrame:
    return generate_customers(_ids(spark, folder, "customer", "c_custkey"), AS_OF)


def _numbered_keys(spark: SparkSession, folder: str, table: str, key: str) -> int:
    """How many rows a table has, whose keys must be 0, 1, 2, ..."""
    low, high, n = (
        load(spark, folder, table).agg(F.min(key), F.max(key), F.count_distinct(key)).first()
    )
    if n and (low, high) != (0, n - 1):
        raise ValueError(f"{table} is not numbered from 0 to {n - 1}")
    return n


def generated_orders(spark: SparkSession, folder: str) -> DataFrame:
    return generate_orders(
        _ids(spark, folder, "orders", "o_orderkey"),
        _numbered_keys(spark, folder, "customer", "c_custkey"),
        _numbered_keys(spark, folder, "part", "p_partkey"),
        AS_OF,
    )


def generated_transactions(spark: SparkSession, folder: str) -> DataFrame:
    return generate_transactions_of(
        _ids(spark, folder, "orders", "o_orderkey"),
        _count(spark, folder, "orders") // 2,
        _numbered_keys(spark, folder, "customer", "c_custkey"),
        _numbered_keys(spark, folder, "part", "p_partkey"),
        AS_OF,
    )


def generated_stream(spark: SparkSession, folder: str) -> DataFrame:
    """The customers as a stream of four batches, broken off half-way and started again."""
    place, n = fresh_folder(spark, "made"), _numbered_keys(spark, folder, "customer", "c_custkey")
    for upto in (n // 2, n):
        query = start_append(
            stream_ids(spark, n, -(-n // 4), tasks=4),
            partial(generate_customers, as_of=AS_OF),
            f"{place}/rows",
            f"{place}/checkpoint",
            name=place.rsplit("/", 1)[1],
        )
        run_until(query, upto)
    return spark.read.parquet(f"{place}/rows")


def payments_rejected(spark: SparkSession, folder: str) -> DataFrame:
    """Order dates as text, some unreadable and some after the payment window."""
    key = F.col("o_orderkey")
    text = F.when(key % 7 == 0, iso_date(F.col("o_orderdate"))).otherwise(
        F.concat(iso_text(F.col("o_orderdate")), F.lit(".123456"))
    )
    orders = load(spark, folder, "orders").select(
        derived_uuid("order", key).alias("order_id"),
        F.when(key % 11 == 0, F.concat(F.lit("on "), text)).otherwise(text).alias("order_date"),
    )
    return rejected(payments_for(orders, datetime(2000, 1, 1))).select("order_id", REASON)


def exact_sample_orders(spark: SparkSession, folder: str) -> DataFrame:
    orders = load(spark, folder, "orders")
    return sample_rows(orders, orders.count() // 2, ["o_orderkey"])


def customers_numbered(spark: SparkSession, folder: str) -> DataFrame:
    customers = load(spark, folder, "customer").select("c_custkey", "c_name")
    return with_ordinal(customers, ["c_custkey"])


def customers_by_position(spark: SparkSession, folder: str) -> DataFrame:
    return by_position(load(spark, folder, "customer").select("c_custkey", "c_name"))


def reference_pick_by_position(spark: SparkSession, folder: str) -> DataFrame:
    return reference_pick(spark, folder, as_read=True)


def reference_pick(spark: SparkSession, folder: str, as_read: bool = False) -> DataFrame:
    """For every order a customer and a part, chosen anew."""
    orders = load(spark, folder, "orders").select("o_orderkey")

    def number(tag: str) -> Column:
        return wide_draw(digest(tag, 42, F.col("o_orderkey")))

    customers, parts = load(spark, folder, "customer"), load(spark, folder, "part")
    with_customer = pick_reference(
        orders,
        number("customer"),
        customers,
        ["c_custkey"],
        {"c_custkey": "customer_key"},
        as_read=as_read,
    )
    return pick_reference(
        with_customer,
        number("part"),
        parts,
        ["p_partkey"],
        {"p_partkey": "part_key"},
        as_read=as_read,
    )


def _catalogue() -> dict[str, Query]:
    named: list[Query] = [
        products_in_stock_taxed,
        products_ingested,
        orders_not_cancelled,
        event_props_parse,
        dead_letter_split,
        accepted_messages,
        permissive_parse,
        uuid_canonical,
        iso_datetimes,
        upsert_latest_event,
        upsert_two_loads,
        merge_then_filter_events,
        filter_then_merge_events,
        ensure_tables,
        stream_filter_append,
        stream_restart_no_duplicates,
        four_streams,
        route_by_topic,
        stream_replay_unchanged,
        stream_dead_letters,
        stream_changes_only,
        stream_drained_resumed,
        batch_reports,
        stream_sketches,
        publish_topic,
        sync_index_upsert,
        generated_products,
        generated_customers,
        generated_orders,
        generated_transactions,
        generated_stream,
        payments_rejected,
        exact_sample_orders,
        customers_numbered,
        customers_by_position,
        reference_pick,
        reference_pick_by_position,
        sync_changes,
        sync_refused,
        documents_null_dates,
    ]
    found = {query.__name__: query for query in named}
    for name, entity in ENTITIES.items():
        found[f"json_round_trip_{name}"] = partial(json_round_trip, entity)
        found[f"documents_{name}"] = partial(documents, name)
    for name, keys in FOREIGN_KEYS.items():
        found[f"documents_{name}_none_text"] = partial(documents, name, none_text=keys)
    return found


QUERIES = _catalogue()
