"""Made-up retail entities, repeatable at any size.

Each generator maps a DataFrame of ids to rows of one entity. All randomness
comes from hashes of the id, so rows can be made in any number of tasks, in any
order, and again after a loss, and are always the same.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstream.entities import (
    CATEGORIES,
    LOYALTY_LEVELS,
    ORDER_STATUSES,
    PAYMENT_METHODS,
    PAYMENT_STATUSES,
)
from tillstream.functions.draws import (
    digest,
    draw,
    money_between,
    one_of,
    whole_between,
    wide_draw,
    words_from,
)
from tillstream.functions.ids import derived_uuid
from tillstream.functions.isotime import moment_at, moment_of, wall_seconds
from tillstream.functions.wire import REASON, accepted
from tillstream.operators.reference import pick_reference
from tillstream.operators.sample import exact_sample

SEED = 42
DAY = 86400
DESCRIPTION_LIMIT = 200

# Sixteen words per list: one hex digit of a hash chooses one word.
MANNERS = (
    "Adaptive", "Balanced", "Compact", "Durable", "Elegant", "Flexible", "Gentle", "Handy",
    "Intuitive", "Light", "Modular", "Nimble", "Portable", "Quiet", "Robust", "Simple",
)
MATERIALS = (
    "bamboo", "carbon", "ceramic", "copper", "cotton", "glass", "granite", "leather",
    "linen", "marble", "oak", "paper", "silk", "steel", "walnut", "wool",
)
THINGS = (
    "anthology", "backpack", "blanket", "charger", "chair", "guide", "headset", "jacket",
    "kettle", "lamp", "novel", "racket", "scarf", "speaker", "trainer", "vase",
)
FIRST_NAMES = (
    "Ada", "Bruno", "Clara", "David", "Elena", "Farid", "Grace", "Hugo",
    "Iris", "Jonas", "Kira", "Louis", "Maya", "Noah", "Olga", "Pablo",
)
LAST_NAMES = (
    "Adler", "Bauer", "Costa", "Dubois", "Evans", "Fischer", "Garcia", "Hansen",
    "Ivanov", "Jensen", "Keller", "Lopez", "Moreau", "Novak", "Olsen", "Petit",
)
CITIES = (
    "Antwerp", "Bergen", "Bologna", "Cork", "Dresden", "Geneva", "Ghent", "Graz",
    "Leeds", "Lyon", "Malmo", "Nantes", "Porto", "Seville", "Turin", "Utrecht",
)
PROSE = (
    "and", "built", "comfort", "daily", "easy", "every", "fits", "for",
    "home", "long", "made", "quality", "ready", "soft", "travel", "with",
)
PROSE_WORDS = 20


@dataclass(frozen=True)
class Sizes:
    """How many rows a run makes. The defaults are fixed values."""

    products: int = 50
    customers: int = 20
    orders: int = 100
    transactions: int = 50


def _namespace(kind: str, seed: int) -> str:
    return f"{kind}-{seed}"


def generate_products(ids: DataFrame, seed: int = SEED) -> DataFrame:
    """One product per ``id``."""
    facts, text = digest("product", seed, F.col("id")), digest("product-text", seed, F.col("id"))
    name_words = [
        one_of(draw(text, slot), words) for slot, words in enumerate((MANNERS, MATERIALS, THINGS))
    ]
    prose = F.concat(F.concat_ws(" ", *words_from(text, PROSE, PROSE_WORDS)), F.lit("."))
    return ids.select(
        derived_uuid(_namespace("product", seed), F.col("id")).alias("product_id"),
        F.concat_ws(" ", *name_words).alias("title"),
        money_between(draw(facts, 0), 5, 500).alias("price"),
        one_of(draw(facts, 1), CATEGORIES).alias("category"),
        F.substring(prose, 1, DESCRIPTION_LIMIT).alias("description"),
        whole_between(draw(facts, 2), 10, 200).alias("stock"),
    )


def generate_customers(ids: DataFrame, as_of: datetime, seed: int = SEED) -> DataFrame:
    """One customer per ``id``, signed up on a day in the three years to ``as_of``."""
    facts, text = digest("customer", seed, F.col("id")), digest("customer-text", seed, F.col("id"))
    first, last = one_of(draw(text, 0), FIRST_NAMES), one_of(draw(text, 1), LAST_NAMES)
    mailbox = (draw(text, 2) % 1000).cast("string")
    days_ago = (draw(facts, 0) % (3 * 365 + 1)).cast("int")
    return ids.select(
        derived_uuid(_namespace("customer", seed), F.col("id")).alias("customer_id"),
        F.concat_ws(" ", first, last).alias("name"),
        F.concat(F.lower(first), F.lit("."), F.lower(last), mailbox, F.lit("@example.org")).alias(
            "email"
        ),
        F.date_sub(F.lit(as_of.date()), days_ago).alias("signup_date"),
        one_of(draw(text, 3), CITIES).alias("location"),
        one_of(draw(facts, 1), LOYALTY_LEVELS).alias("loyalty_status"),
    )


def generate_orders(
    ids: DataFrame,
    customers: DataFrame | int,
    products: DataFrame | int,
    as_of: datetime,
    seed: int = SEED,
) -> DataFrame:
    """One order per ``id``, dated in the year to ``as_of``.

    Each order refers to one customer and one product. Given tables, their rows
    are numbered and joined. Given a number n, they are the generated entities
    with ids 0 .. n-1; their keys follow from the id, so there is nothing to join.
    """
    facts = digest("order", seed, F.col("id"))
    orders = ids
    for kind, targets in (("customer", customers), ("product", products)):
        number, key = wide_draw(digest(f"order-{kind}", seed, F.col("id"))), f"{kind}_id"
        if isinstance(targets, int):
            orders = orders.withColumn(key, derived_uuid(_namespace(kind, seed), number % targets))
        else:
            orders = pick_reference(orders, number, targets, [key], {key: key})
    ago = draw(facts, 0) % (365 * DAY + 1)
    return orders.select(
        derived_uuid(_namespace("order", seed), F.col("id")).alias("order_id"),
        "customer_id",
        "product_id",
        moment_at(F.lit(_wall_seconds(as_of)) - ago).alias("order_date"),
        whole_between(draw(facts, 1), 1, 5).alias("quantity"),
        one_of(draw(facts, 2), ORDER_STATUSES).alias("status"),
    )


def payments_for(orders: DataFrame, as_of: datetime, seed: int = SEED) -> DataFrame:
    """One payment per order, at a whole second between the order and ``as_of``.

    An order date may be a timestamp or ISO text. Orders that cannot be paid, for
    want of a readable date before ``as_of``, carry a ``reason``.
    """
    ordered = F.col("order_date")
    if dict(orders.dtypes)["order_date"] == "string":
        ordered = moment_of(ordered)
    facts = digest("transaction", seed, F.col("order_id"))
    start, end = wall_seconds(ordered), F.lit(_wall_seconds(as_of))
    paid = start + draw(facts, 0) % (end - start + 1)
    reason = F.when(ordered.isNull(), F.lit("unreadable order_date")).when(
        start > end, F.lit("order_date in the future")
    )
    return orders.select(
        derived_uuid(_namespace("transaction", seed), F.col("order_id")).alias("transaction_id"),
        "order_id",
        one_of(draw(facts, 1), PAYMENT_METHODS).alias("payment_method"),
        F.when(reason.isNull(), moment_at(paid)).alias("payment_date"),
        money_between(draw(facts, 2), 20, 1000).alias("amount"),
        one_of(draw(facts, 3), PAYMENT_STATUSES).alias("status"),
        reason.alias(REASON),
    )


def generate_transactions(
    orders: DataFrame, size: int, as_of: datetime, seed: int = SEED
) -> DataFrame:
    """Transactions for ``size`` of the orders, at most one each."""
    sampled = exact_sample(orders, size, ["order_id"], seed)
    return accepted(payments_for(sampled, as_of, seed)).drop(REASON)


def generate_transactions_of(
    ids: DataFrame,
    size: int,
    customers: DataFrame | int,
    products: DataFrame | int,
    as_of: datetime,
    seed: int = SEED,
) -> DataFrame:
    """Transactions for ``size`` of the orders that :func:`generate_orders` makes of
    ``ids``. The ids are sampled, so only the chosen orders are made."""
    chosen = exact_sample(ids, size, ["id"], seed)
    orders = generate_orders(chosen, customers, products, as_of, seed)
    return accepted(payments_for(orders, as_of, seed)).drop(REASON)


def generate_all(
    spark: SparkSession, as_of: datetime, sizes: Sizes = Sizes(), seed: int = SEED
) -> dict[str, DataFrame]:
    """Four related tables."""
    ids, refers_to = spark.range(sizes.orders), (sizes.customers, sizes.products)
    return {
        "products": generate_products(spark.range(sizes.products), seed),
        "customers": generate_customers(spark.range(sizes.customers), as_of, seed),
        "orders": generate_orders(ids, *refers_to, as_of, seed),
        "transactions": generate_transactions_of(
            ids, sizes.transactions, *refers_to, as_of, seed
        ),
    }


def _wall_seconds(moment: datetime) -> int:
    return int((moment.replace(tzinfo=None) - datetime(1970, 1, 1)).total_seconds())
