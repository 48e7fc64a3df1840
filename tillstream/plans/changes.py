"""Copy into document indices only what has changed since the last time."""

from __future__ import annotations

import logging
from collections.abc import Callable
from dataclasses import dataclass
from functools import partial

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tillstream.entities import ENTITIES, Entity
from tillstream.functions.wire import json_message
from tillstream.jobs import side_by_side
from tillstream.operators.documents import FOREIGN_KEYS, MAPPERS, to_documents
from tillstream.sources.keyed import Store

log = logging.getLogger(__name__)

NEW, CHANGED, SAME, GONE = "new", "changed", "same", "gone"
CHANGE = "change"
STAMP = "last_synced"


@dataclass(frozen=True)
class ChangeReport:
    """What one entity's job found; ``error`` is None when it went through."""

    index: str
    new: int = 0
    changed: int = 0
    same: int = 0
    gone: int = 0
    without_id: int = 0
    error: str | None = None

    @property
    def written(self) -> int:
        return self.new + self.changed


def document_digest(documents: DataFrame) -> Column:
    """One hash of a whole document: field names, values and nulls, but not its stamp."""
    return F.md5(json_message(documents.drop(STAMP, "id")))


def document_changes(documents: DataFrame, indexed: DataFrame) -> DataFrame:
    """Every document with its ``change`` against the index: new, changed or same.

    Both sides hold one row per ``id``. Only digests of the index take part, not its
    documents; with both sides bucketed alike the join moves no row.
    """
    known = indexed.select(
        F.col("id").alias("_known"), document_digest(indexed).alias("_digest")
    )
    joined = documents.withColumn("_now", document_digest(documents)).join(
        known, F.col("id") == F.col("_known"), "left"
    )
    change = (
        F.when(F.col("_known").isNull(), NEW)
        .when(F.col("_now") == F.col("_digest"), SAME)
        .otherwise(CHANGED)
    )
    return joined.withColumn(CHANGE, change).drop("_known", "_digest", "_now")


def gone_ids(documents: DataFrame, indexed: DataFrame) -> DataFrame:
    """Ids of the index that no document has any more; reads nothing but ids."""
    return indexed.select("id").join(documents.select("id"), "id", "left_anti")


def sync_changed(
    store: Store,
    entity: Entity,
    read: Callable[[], DataFrame],
    *,
    synced: str | None = None,
    none_text: tuple[str, ...] = (),
    attempts: int = 2,
) -> ChangeReport:
    """Write the documents of one table that are new or changed; list those gone.

    Documents that are the same keep their stamp and cost no write. Gone ones stay in
    the index, as a full sync leaves them, and are kept in the table of gone ids with
    the stamp of the sync that missed them. A job that breaks off is done again: what
    it had written already is the same by then. Rows without an id are counted only.
    """
    error = None
    for _ in range(attempts):
        try:
            documents = to_documents(read(), MAPPERS[entity.name], synced, none_text)
            ddl = ", ".join(f"{name} {kind}" for name, kind in documents.dtypes)
            store.ensure_index(entity.index, ddl)
            store.ensure_gone(entity)
            indexed = store.index(entity).current(store.spark)
            named = documents.filter(F.col("id").isNotNull())
            found = Observation()
            changes = document_changes(named, indexed).observe(
                found, *[F.count_if(F.col(CHANGE) == c).alias(c) for c in (NEW, CHANGED, SAME)]
            )
            lost = documents.filter(F.col("id").isNull()).count()
            gone = gone_ids(named, indexed).withColumn(STAMP, _stamp(documents, synced))
            missed = Observation()
            # Listed before the index changes: both are read as they were.
            store.gone(entity).append(gone.observe(missed, F.count("id").alias(GONE)))
            written = changes.filter(F.col(CHANGE) != SAME).drop(CHANGE)
            store.index(entity).append(written)
            return ChangeReport(entity.index, **found.get, **missed.get, without_id=lost)
        except Exception as failure:  # noqa: BLE001 - one table must not stop the others
            log.warning("sync of changes to %s failed: %s", entity.index, failure)
            error = str(failure)
    return ChangeReport(entity.index, error=error)


def _stamp(documents: DataFrame, synced: str | None) -> Column:
    if synced is not None:
        return F.lit(synced)
    return F.date_format(F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss")


def sync_all_changed(
    store: Store,
    tables: dict[str, Callable[[], DataFrame]],
    *,
    synced: str | None = None,
    none_text: bool = False,
) -> list[ChangeReport]:
    """One job per entity, all at the same time; a failing one leaves the others alone."""

    def job(name: str) -> Callable[[], ChangeReport]:
        return partial(
            sync_changed,
            store,
            ENTITIES[name],
            tables[name],
            synced=synced,
            none_text=FOREIGN_KEYS.get(name, ()) if none_text else (),
        )

    return side_by_side(store.spark, [job(name) for name in tables])
