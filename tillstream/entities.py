"""The four retail entities, declared once.

Every other module asks this registry for schemas, keys, topics and table
names, so an entity is bound by name everywhere and never by column position.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# Topic, table and index names and the enumerated domains below
# are part of the data contract and must stay as they are.
KEYSPACE = "ecommerce"
CATEGORIES = ("Electronics", "Fashion", "Home", "Books", "Sports")
LOYALTY_LEVELS = ("Bronze", "Silver", "Gold")
ORDER_STATUSES = ("Pending", "Shipped", "Cancelled")
PAYMENT_METHODS = ("Credit Card", "PayPal", "Bank Transfer")
PAYMENT_STATUSES = ("Completed", "Failed")
TAX_FACTOR = 1.2
CANCELLED = "Cancelled"

# Where a message stood in its topic. Compared as a whole this is a total order
# over all versions of one key, so "the latest version" is always well defined.
POSITION = ("timestamp", "partition", "offset")


@dataclass(frozen=True)
class Entity:
    """One kind of record: its message schema and what identifies a record.

    ``uuids`` are the columns that hold UUID text, the key first when the entity
    has one. ``derived`` are columns that the entity's transform step adds.
    """

    name: str
    message: str
    key: str | None = None
    uuids: tuple[str, ...] = ()
    derived: str = ""

    @property
    def topic(self) -> str:
        return f"ecommerce-{self.name}"

    @property
    def index(self) -> str:
        return f"ecommerce_{self.name}"

    @property
    def schema(self) -> T.StructType:
        return T.StructType.fromDDL(self.message)

    @property
    def columns(self) -> list[str]:
        return self.schema.names

    @property
    def table_ddl(self) -> str:
        """Columns of the table that receives the transformed records."""
        return f"{self.message}, {self.derived}" if self.derived else self.message


PRODUCTS = Entity(
    name="products",
    key="product_id",
    uuids=("product_id",),
    message="product_id string, title string, price float, description string, "
    "category string, stock int",
    derived="price_with_tax double",
)
CUSTOMERS = Entity(
    name="customers",
    key="customer_id",
    uuids=("customer_id",),
    message="customer_id string, name string, email string, signup_date timestamp, "
    "location string, loyalty_status string",
)
ORDERS = Entity(
    name="orders",
    key="order_id",
    uuids=("order_id", "customer_id", "product_id"),
    message="order_id string, customer_id string, product_id string, "
    "order_date timestamp, quantity int, status string",
)
TRANSACTIONS = Entity(
    name="transactions",
    key="transaction_id",
    uuids=("transaction_id", "order_id"),
    message="transaction_id string, order_id string, payment_method string, "
    "payment_date timestamp, amount float, status string",
)

ENTITIES = {e.name: e for e in (PRODUCTS, CUSTOMERS, ORDERS, TRANSACTIONS)}
