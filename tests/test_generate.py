"""Made-up entities: ranges, references, dates, repeatability."""

from __future__ import annotations

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tillstream.entities import (
    CATEGORIES,
    LOYALTY_LEVELS,
    ORDER_STATUSES,
    PAYMENT_METHODS,
    PAYMENT_STATUSES,
)
from tillstream.functions.isotime import iso_text
from tillstream.functions.wire import REASON
from tillstream.sources.generate import (
    Sizes,
    generate_all,
    generate_customers,
    generate_orders,
    generate_products,
    generate_transactions,
    payments_for,
)

AS_OF = datetime(2024, 6, 30, 12)


@pytest.fixture(scope="module", params=[Sizes(), Sizes(3_000, 1_000, 100_000, 50_000)])
def made(request, spark):
    frames = generate_all(spark, AS_OF, request.param)
    kept = {name: frame.cache() for name, frame in frames.items()}
    yield request.param, kept
    for frame in kept.values():
        frame.unpersist()


def values(frame, column):
    return {r[0] for r in frame.select(column).distinct().collect()}


def test_sizes_and_unique_keys(made):
    sizes, frames = made
    for name, size in vars(sizes).items():
        frame = frames[name]
        assert frame.count() == size
        assert frame.select(frame.columns[0]).distinct().count() == size


def test_domains_and_ranges(made):
    _, frames = made
    for name, column, domain in (
        ("products", "category", CATEGORIES),
        ("customers", "loyalty_status", LOYALTY_LEVELS),
        ("orders", "status", ORDER_STATUSES),
        ("transactions", "payment_method", PAYMENT_METHODS),
        ("transactions", "status", PAYMENT_STATUSES),
    ):
        assert values(frames[name], column) == set(domain)
    wrong = frames["products"].filter(
        "price not between 5 and 500 or price <> round(price, 2) or stock not between 10 and 200 "
        "or length(description) > 200"
    )
    assert wrong.count() == 0
    assert frames["orders"].filter("quantity not between 1 and 5").count() == 0
    assert frames["transactions"].filter("amount not between 20 and 1000").count() == 0


def test_references_exist(made):
    _, frames = made
    orders = frames["orders"]
    assert orders.join(frames["customers"], "customer_id", "left_anti").count() == 0
    assert orders.join(frames["products"], "product_id", "left_anti").count() == 0
    transactions = frames["transactions"]
    assert transactions.join(orders, "order_id", "left_anti").count() == 0
    assert transactions.select("order_id").distinct().count() == transactions.count()


def test_dates(made):
    _, frames = made
    end = F.lit(AS_OF)
    signups = frames["customers"].select(F.min("signup_date"), F.max("signup_date")).first()
    assert date(2021, 7, 1) <= signups[0] <= signups[1] <= AS_OF.date()
    dated = frames["orders"].select("order_id", "order_date")
    paid = frames["transactions"].join(dated, "order_id")
    early_or_late = (F.col("payment_date") < F.col("order_date")) | (F.col("payment_date") > end)
    assert paid.filter(early_or_late | F.col("payment_date").isNull()).count() == 0
    assert paid.filter(F.date_format("payment_date", "SSSSSS") != "000000").count() == 0


def test_same_rows_whatever_the_partitions(spark):
    def rows(parts):
        ids = spark.range(0, 500, 1, parts)
        orders = generate_orders(ids, 20, 50, AS_OF)
        return [
            sorted(f.collect(), key=str)
            for f in (
                generate_products(ids),
                generate_customers(ids, AS_OF),
                orders,
                generate_transactions(orders, 100, AS_OF),
            )
        ]

    assert rows(1) == rows(6)


def test_seed_changes_the_rows(spark):
    ids = spark.range(100)
    assert generate_products(ids, 1).join(generate_products(ids, 2), "product_id").count() == 0


def test_orders_can_refer_to_given_tables(spark):
    customers = spark.createDataFrame([("c1",), ("c2",)], "customer_id string")
    products = spark.createDataFrame([("p1",), ("p2",), ("p3",)], "product_id string")
    orders = generate_orders(spark.range(300), customers, products, AS_OF)
    assert orders.count() == 300
    assert values(orders, "customer_id") == {"c1", "c2"}
    assert values(orders, "product_id") == {"p1", "p2", "p3"}


def test_order_dates_as_text(spark):
    typed = generate_orders(spark.range(200), 5, 5, AS_OF)
    text = typed.withColumn("order_date", iso_text(F.col("order_date")))
    first, second = payments_for(typed, AS_OF), payments_for(text, AS_OF)
    assert sorted(first.collect()) == sorted(second.collect())


def test_orders_that_cannot_be_paid(spark):
    orders = spark.createDataFrame(
        [
            ("a", "yesterday"),
            ("b", None),
            ("c", "2030-01-01T00:00:00"),
            ("d", "2024-06-30T12:00:00.5"),
        ],
        "order_id string, order_date string",
    )
    got = {r.order_id: r for r in payments_for(orders, AS_OF).collect()}
    assert got["a"][REASON] == got["b"][REASON] == "unreadable order_date"
    assert got["c"][REASON] == "order_date in the future"
    assert got["d"][REASON] is None and got["d"].payment_date == AS_OF
    assert generate_transactions(orders, 4, AS_OF).count() == 1
