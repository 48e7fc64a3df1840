"""Copy tables into document indices."""

from __future__ import annotations

import logging
from collections.abc import Callable
from dataclasses import dataclass
from functools import partial

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tillstream.entities import ENTITIES, Entity
from tillstream.jobs import side_by_side
from tillstream.operators.documents import FOREIGN_KEYS, MAPPERS, Mapper, to_documents
from tillstream.sources.bulk import Connect, listing_writer
from tillstream.sources.keyed import Store

log = logging.getLogger(__name__)

# Writes documents; one that knows how many were refused returns their number.
Writer = Callable[[DataFrame], int | None]


@dataclass(frozen=True)
class SyncReport:
    """What one entity's job did; ``error`` is None when it went through. ``documents``
    were taken by the index, ``refused`` were not."""

    index: str
    documents: int
    without_id: int
    error: str | None = None
    refused: int = 0


def sync_table(
    read: Callable[[], DataFrame],
    index: str,
    mapper: Mapper,
    write: Writer,
    *,
    synced: str | None = None,
    none_text: tuple[str, ...] = (),
    attempts: int = 2,
) -> SyncReport:
    """Index every row of a table under its ``id``.

    Writing is an insert-or-replace, so a write that failed half-way is simply
    done again. A failure stays with this table and is reported, not raised.
    Rows that left the table keep their last document.
    """
    error = None
    for _ in range(attempts):
        try:
            counts = Observation()
            documents = to_documents(read(), mapper, synced, none_text).observe(
                counts, F.count(F.lit(1)).alias("rows"), F.count("id").alias("documents")
            )
            refused = write(documents.filter(F.col("id").isNotNull())) or 0
            done = counts.get
            without_id = done["rows"] - done["documents"]
            return SyncReport(index, done["documents"] - refused, without_id, refused=refused)
        except Exception as failure:  # noqa: BLE001 - one table must not stop the others
            log.warning("sync to %s failed: %s", index, failure)
            error = str(failure)
    return SyncReport(index, 0, 0, error)


def sync_all(
    store: Store,
    tables: dict[str, Callable[[], DataFrame]],
    *,
    synced: str | None = None,
    none_text: bool = False,
) -> list[SyncReport]:
    """One job per entity into the indices of ``store``, all at the same time; a
    job that fails leaves the others alone."""

    def job(name: str) -> Callable[[], SyncReport]:
        return partial(
            sync_table,
            tables[name],
            ENTITIES[name].index,
            MAPPERS[name],
            _index_writer(store, ENTITIES[name]),
            synced=synced,
            none_text=FOREIGN_KEYS.get(name, ()) if none_text else (),
        )

    return side_by_side(store.spark, [job(name) for name in tables])


def sync_listed(
    store: Store,
    tables: dict[str, Callable[[], DataFrame]],
    connect: Callable[[Entity], Connect],
    *,
    synced: str | None = None,
    none_text: bool = False,
) -> list[SyncReport]:
    """One job per entity into an index outside; what it refuses is kept in the store's
    table ``refused_<index>``, with reason, document and the stamp of the sync."""

    def job(name: str) -> Callable[[], SyncReport]:
        entity = ENTITIES[name]
        store.ensure_refused(entity)
        return partial(
            sync_table,
            tables[name],
            entity.index,
            MAPPERS[name],
            listing_writer(connect(entity), store.refused(entity).append),
            synced=synced,
            none_text=FOREIGN_KEYS.get(name, ()) if none_text else (),
        )

    return side_by_side(store.spark, [job(name) for name in tables])


def _index_writer(store: Store, entity: Entity) -> Writer:
    def write(documents: DataFrame) -> None:
        ddl = ", ".join(f"{name} {kind}" for name, kind in documents.dtypes)
        store.ensure_index(entity.index, ddl)
        store.index(entity).append(documents)

    return write
