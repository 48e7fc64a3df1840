"""Tables with a primary key on plain parquet.

Writing appends versions, reading keeps the last version of each key. Nothing is
ever overwritten in place: a job or driver that dies half-way, or a batch that is
delivered twice, leaves only versions that the next read folds together. Random
keys touch every part of a table, so replacing rows on write would rewrite the
whole table for each small batch; appending writes each arrival once.

Tables are bucketed by key, so the fold on read needs no shuffle.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from tillstream.entities import ENTITIES, POSITION, Entity
from tillstream.operators.latest import latest_per_key
from tillstream.sources.bulk import REFUSED_DDL

POSITION_DDL = "timestamp timestamp, partition int, offset bigint"
LETTER_COLUMNS = ("topic", "partition", "offset", "timestamp", "value", "reason")
GONE_DDL = "id string, last_synced string"
LETTER_DDL = (
    "topic string, partition int, offset bigint, timestamp timestamp, value binary, reason string"
)
# A topic that is made anew counts its offsets from zero again: time and content
# tell its messages from those that had the same place before.
LETTER_KEY = ("topic", "partition", "offset", "timestamp", "value")


def _plain(folder: str) -> str:
    """A folder without the scheme of local files, of which Spark writes several forms."""
    return "/" + folder.removeprefix("file:").strip("/")


@dataclass(frozen=True)
class KeyedTable:
    """A bucketed table and the columns that say which version is the latest."""

    name: str
    keys: tuple[str, ...]
    order: tuple[str, ...]
    buckets: int

    def append(self, versions: DataFrame) -> None:
        """Add the latest version of each key in ``versions``."""
        self.append_folded(latest_per_key(versions, self.keys, self.order))

    def append_folded(self, rows: DataFrame, partitions: int | None = None) -> None:
        """Add ``rows``, one per key, bound by name.

        Folding has already spread the rows by key over ``partitions`` tasks, by
        default the session's shuffle partitions. When these line up with the
        buckets each task fills few buckets; otherwise rows are moved once more,
        which is cheaper than every task writing a sliver of every bucket.
        """
        spark = rows.sparkSession
        partitions = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
        if max(partitions, self.buckets) % min(partitions, self.buckets):
            rows = rows.repartition(self.buckets, *self.keys)
        rows.select(*spark.table(self.name).columns).write.insertInto(self.name)

    def versions(self, spark: SparkSession) -> DataFrame:
        """All stored versions, also those that other sessions (each stream has
        its own) appended since this session listed the files last."""
        spark.catalog.refreshTable(self.name)
        return spark.table(self.name)

    def current(self, spark: SparkSession) -> DataFrame:
        """The table as a reader sees it: one row per key."""
        return latest_per_key(self.versions(spark), self.keys, self.order)


@dataclass(frozen=True)
class Store:
    """A database of keyed tables below one folder.

    ``buckets`` belongs to the files, not to the session: it is part of each
    table's folder name, so files of another bucket count are never mixed in.
    """

    spark: SparkSession
    database: str
    folder: str
    buckets: int

    def ensure(self) -> Store:
        """Create what is missing: the database, and per entity a raw table, a
        table of transformed records, an index of documents and dead letters."""
        self._check_layout()
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {self.database} LOCATION '{self.folder}'")
        held = self.spark.catalog.getDatabase(self.database).locationUri
        if _plain(held) != _plain(self.folder):
            raise ValueError(f"{self.database} lies in {held}, not in {self.folder}")
        for entity in ENTITIES.values():
            self._create(entity.name, f"{entity.table_ddl}, {POSITION_DDL}", entity.key)
            self._create(f"raw_{entity.name}", f"{entity.message}, {POSITION_DDL}", entity.key)
            self.ensure_letters(entity.name)
        self.ensure_letters("raw")
        return self

    def _check_layout(self) -> None:
        """The bucket count is kept with the files; another one is refused, as its
        tables would be new and empty."""
        place = f"{self.folder}/_layout"
        fresh = self.spark.createDataFrame([(str(self.buckets),)], "value string")
        try:
            # Of several jobs that start together one writes it; an existing one stays.
            fresh.coalesce(1).write.mode("error").text(place)
            return
        except AnalysisException as failure:
            if failure.getCondition() != "PATH_ALREADY_EXISTS":
                raise
        known = int(self.spark.read.text(place).first()[0])
        if known != self.buckets:
            raise ValueError(f"{self.folder} has {known} buckets, not {self.buckets}")

    def ensure_letters(self, stream: str) -> None:
        """One table of rejected messages per stream: a table has one writer."""
        self._create(f"dead_letters_{stream}", LETTER_DDL, *LETTER_KEY)

    def ensure_index(self, index: str, ddl: str) -> None:
        """A table of documents; call once per job, before the write."""
        self._create(index, ddl, "id")

    def ensure_gone(self, entity: Entity) -> None:
        """A table of the ids that an index has and its source has no more."""
        self._create(f"gone_{entity.index}", GONE_DDL, "id")

    def ensure_refused(self, entity: Entity) -> None:
        """A table of the documents that an index outside refused."""
        self._create(f"refused_{entity.index}", REFUSED_DDL, "id")

    def _create(self, table: str, ddl: str, *keys: str) -> None:
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.database}.{table} ({ddl}) USING parquet "
            # UUID text hardly shrinks without an entropy code.
            f"OPTIONS (compression 'zstd') "
            f"CLUSTERED BY ({', '.join(keys)}) INTO {self.buckets} BUCKETS "
            f"LOCATION '{self.folder}/{table}_b{self.buckets}'"
        )

    def _keyed(self, table: str, keys: Iterable[str], order: Sequence[str]) -> KeyedTable:
        return KeyedTable(f"{self.database}.{table}", tuple(keys), tuple(order), self.buckets)

    def table(self, entity: Entity) -> KeyedTable:
        return self._keyed(entity.name, [entity.key], POSITION)

    def raw(self, entity: Entity) -> KeyedTable:
        return self._keyed(f"raw_{entity.name}", [entity.key], POSITION)

    def letters(self, stream: str) -> KeyedTable:
        return self._keyed(
            f"dead_letters_{stream}", LETTER_KEY, ["timestamp"]
        )

    def index(self, entity: Entity) -> KeyedTable:
        return self._keyed(entity.index, ["id"], ["last_synced"])

    def gone(self, entity: Entity) -> KeyedTable:
        return self._keyed(f"gone_{entity.index}", ["id"], ["last_synced"])

    def refused(self, entity: Entity) -> KeyedTable:
        return self._keyed(f"refused_{entity.index}", ["id"], ["last_synced"])

    def copy_to(self, other: Store) -> Store:
        """Fold old versions away: the current rows, written into another store.

        This store is only read, so a copy that breaks off can be started over.
        Point the streams, with their checkpoints, at the copy when it is done.
        """
        other.ensure()
        pairs = [(self.letters("raw"), other.letters("raw"))]
        for entity in ENTITIES.values():
            index = self.index(entity)
            if self.spark.catalog.tableExists(index.name):
                kinds = index.versions(self.spark).dtypes
                other.ensure_index(entity.index, ", ".join(f"{n} {kind}" for n, kind in kinds))
                pairs.append((index, other.index(entity)))
            pairs += [
                (self.table(entity), other.table(entity)),
                (self.raw(entity), other.raw(entity)),
                (self.letters(entity.name), other.letters(entity.name)),
            ]
        for here, there in pairs:
            there.append_folded(here.current(self.spark), here.buckets)
        return other

    def read(self, entity: Entity) -> DataFrame:
        """Current transformed records, without the message positions."""
        return self.table(entity).current(self.spark).drop(*POSITION)

    def read_raw(self, entity: Entity) -> DataFrame:
        return self.raw(entity).current(self.spark).drop(*POSITION)
