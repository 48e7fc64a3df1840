"""The four entities, built from star-schema tables (part, customer, orders, ...)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstream.functions.ids import derived_uuid


def load(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


# Rows of a task that derives entities: wide ones, which are sorted by key and should not
# have to leave memory for it.
ROWS_A_TASK = 500_000


def spread(rows: DataFrame, key: str, n: int) -> DataFrame:
    """``rows``, still narrow, dealt out by ``key`` when they are many: a task of a scan gets
    as many as fit 128 MB of compressed file, which is too many once they are wide."""
    return rows.repartition(1 + n // ROWS_A_TASK, key) if n > 2 * ROWS_A_TASK else rows


def _day(text_or_date: Column) -> Column:
    return text_or_date.cast("timestamp_ntz")


def products(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("p_partkey")
    return load(spark, folder, "part").select(
        derived_uuid("product", key).alias("product_id"),
        F.col("p_name").alias("title"),
        F.col("p_retailprice").cast("float").alias("price"),
        F.col("p_type").alias("category"),
        F.concat_ws(" ", "p_brand", "p_type", "p_name").alias("description"),
        F.when(key % 17 != 0, F.col("p_size") % 10).alias("stock"),
    )


def customers(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("c_custkey")
    nations = load(spark, folder, "nation").select("n_nationkey", "n_name")
    level = F.when(key % 3 == 0, "Bronze").when(key % 3 == 1, "Silver").otherwise("Gold")
    signup = F.date_add(F.lit("2020-01-01").cast("date"), (key % 1095).cast("int"))
    mailbox = F.lower(F.replace("c_name", F.lit("#"), F.lit(".")))
    return (
        load(spark, folder, "customer")
        .join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            derived_uuid("customer", key).alias("customer_id"),
            F.col("c_name").alias("name"),
            F.concat(mailbox, F.lit("@example.com")).alias("email"),
            _day(signup).alias("signup_date"),
            F.col("n_name").alias("location"),
            level.alias("loyalty_status"),
        )
    )


def orders(spark: SparkSession, folder: str) -> DataFrame:
    lines = (
        load(spark, folder, "lineitem")
        .groupBy("l_orderkey")
        .agg(F.min("l_partkey").alias("part"), F.min("l_quantity").alias("least"))
    )
    status = F.col("o_orderstatus")
    found = load(spark, folder, "orders")
    own = found.select("o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus")
    return (
        spread(own, "o_orderkey", found.count())
        .join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left")
        .select(
            derived_uuid("order", F.col("o_orderkey")).alias("order_id"),
            derived_uuid("customer", F.col("o_custkey")).alias("customer_id"),
            derived_uuid("product", F.col("part")).alias("product_id"),
            F.col("o_orderdate").alias("order_date"),
            (F.col("least").cast("int") % 5 + 1).alias("quantity"),
            F.when(status == "P", "Pending")
            .when(status == "O", "Shipped")
            .when(status == "F", "Cancelled")
            .alias("status"),
        )
    )


def transactions(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("o_orderkey")
    method = (
        F.when(key % 3 == 0, "Credit Card").when(key % 3 == 1, "PayPal").otherwise("Bank Transfer")
    )
    paid = F.date_add(F.col("o_orderdate").cast("date"), (key % 30).cast("int"))
    found = load(spark, folder, "orders")
    own = found.select("o_orderkey", "o_orderdate", "o_totalprice")
    return (
        spread(own, "o_orderkey", found.count())
        .select(
            derived_uuid("txn", key).alias("transaction_id"),
            derived_uuid("order", key).alias("order_id"),
            method.alias("payment_method"),
            _day(paid).alias("payment_date"),
            F.col("o_totalprice").cast("float").alias("amount"),
            F.when(key % 5 == 0, "Failed").otherwise("Completed").alias("status"),
        )
    )


VIEWS = {
    "products": products,
    "customers": customers,
    "orders": orders,
    "transactions": transactions,
}
