"""The optional per-entity step between parsing and storing."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstream.entities import CANCELLED, TAX_FACTOR

Step = Callable[[DataFrame], DataFrame]


def price_after_tax(products: DataFrame) -> DataFrame:
    """The 32-bit price is widened first, so the product is a double."""
    taxed = F.col("price").cast("double") * F.lit(TAX_FACTOR)
    return products.select("*", taxed.alias("price_with_tax"))


def only_in_stock(products: DataFrame) -> DataFrame:
    """An unknown stock counts as none."""
    return products.where("stock > 0")


def sellable_products(products: DataFrame) -> DataFrame:
    return price_after_tax(only_in_stock(products))


def standing_orders(orders: DataFrame) -> DataFrame:
    """Orders that were not cancelled; an unknown status is dropped as well."""
    return orders.where(F.col("status") != F.lit(CANCELLED))


STEPS: dict[str, Step] = {"products": sellable_products, "orders": standing_orders}


def step_for(entity_name: str) -> Step:
    return STEPS.get(entity_name, lambda frame: frame)
