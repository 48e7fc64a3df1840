"""Table rows to search documents."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstream.functions.isotime import iso_text, moment_at

# A mapper turns a table into the list of its document fields; "id" is required.
Mapper = Callable[[DataFrame], list[Column]]


def _id(key: str) -> Column:
    """The key as text. A plain rename: the documents stay partitioned by it."""
    return F.col(key).cast("string").alias("id")


def _reference(key: str) -> Column:
    return F.col(key).cast("string").alias(key)


def _number(column: str) -> Column:
    """A 32-bit float is written with all digits of its exact value."""
    return F.col(column).cast("double").alias(column)


def _moment(column: str) -> Column:
    return iso_text(F.col(column)).alias(column)


def product_fields(_: DataFrame) -> list[Column]:
    plain = [F.col(c) for c in ("category", "description", "stock")]
    return [_id("product_id"), F.col("title"), _number("price"), *plain]


def customer_fields(_: DataFrame) -> list[Column]:
    plain = [F.col(c) for c in ("name", "email", "location", "loyalty_status")]
    return [_id("customer_id"), _moment("signup_date"), *plain]


def order_fields(_: DataFrame) -> list[Column]:
    keys = [_id("order_id"), _reference("customer_id"), _reference("product_id")]
    return [*keys, _moment("order_date"), F.col("quantity"), F.col("status")]


def transaction_fields(_: DataFrame) -> list[Column]:
    keys = [_id("transaction_id"), _reference("order_id")]
    paid = [F.col("payment_method"), _moment("payment_date"), _number("amount")]
    return [*keys, *paid, F.col("status")]


MAPPERS: dict[str, Mapper] = {
    "products": product_fields,
    "customers": customer_fields,
    "orders": order_fields,
    "transactions": transaction_fields,
}

FOREIGN_KEYS = {"orders": ("customer_id", "product_id"), "transactions": ("order_id",)}


def to_documents(
    table: DataFrame, mapper: Mapper, synced: str | None = None, none_text: tuple[str, ...] = ()
) -> DataFrame:
    """Documents of ``table``, stamped with ``last_synced``.

    ``synced`` fixes the stamp; without it the time of the query is used, in UTC
    whatever the session's zone, so that stamps order documents by their time.
    ``none_text`` names references whose null is written as the text ``None``.
    """
    seconds = F.unix_micros(F.current_timestamp()).cast("decimal(20,0)") / F.lit(1_000_000)
    stamp = F.lit(synced) if synced is not None else iso_text(moment_at(seconds))
    documents = table.select(*mapper(table), stamp.alias("last_synced"))
    return documents.fillna("None", subset=list(none_text)) if none_text else documents
