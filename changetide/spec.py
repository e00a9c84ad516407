"""Table specifications and the names of the columns every change carries."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import types as T

# Fields the capture side adds to every change (fixed values of the message format).
OP = "__op"
TABLE = "__table"
SOURCE_TS = "__source_ts_ms"
DELETED = "__deleted"
META_FIELDS = [
    T.StructField(OP, T.StringType()),
    T.StructField(TABLE, T.StringType()),
    T.StructField(SOURCE_TS, T.LongType()),
    T.StructField(DELETED, T.StringType()),
]

# Columns this library adds.
BROKER_TS = "__broker_ts"
PARTITION = "__partition"
OFFSET = "__offset"
VALUE = "__value"
BAD = "__bad"
KIND = "__kind"
REASON = "__reason"
PARTIAL = "__partially_decoded"
COMMITTED = "__committed_at"
REST = "__rest"
BATCH = "batch_id"

UPSERT, DELETE, REJECT = "upsert", "delete", "reject"

MESSAGE_SCHEMA = T.StructType([
    T.StructField("value", T.StringType()),
    T.StructField("ts", T.TimestampType()),
    T.StructField("topic", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
])


@dataclass(frozen=True)
class TableSpec:
    """One replicated table: its key column and the types of its row columns.

    ``defaults`` fills columns that a bulk file does not carry; streamed changes
    are full rows and never use it. ``times`` are text columns that hold a time: the log
    keeps the text, the published table has timestamps. With ``keep_unknown`` the log also keeps fields of the payload that the schema doesn't
    name, as JSON, and a later specification of the table that names them reads them from there.
    """

    name: str
    pk: str
    schema: T.StructType
    defaults: Mapping[str, object] = field(default_factory=dict, hash=False)
    times: tuple[str, ...] = ()
    keep_unknown: bool = False

    def __post_init__(self) -> None:
        if self.pk not in self.schema.names:
            raise ValueError(f"{self.name}: key column {self.pk!r} is not in the schema")

    @property
    def columns(self) -> list[str]:
        return list(self.schema.names)

    @property
    def payload_schema(self) -> T.StructType:
        """Type of a decoded payload, with room for text that did not decode."""
        return T.StructType([*self.schema.fields, *META_FIELDS, T.StructField(BAD, T.StringType())])

    @property
    def log_schema(self) -> T.StructType:
        """Columns of a stored change, without the directory columns."""
        return T.StructType([
            *self.schema.fields,
            *META_FIELDS,
            T.StructField(BROKER_TS, T.TimestampType()),
            T.StructField(PARTITION, T.IntegerType()),
            T.StructField(OFFSET, T.LongType()),
            T.StructField(VALUE, T.StringType()),
            T.StructField(KIND, T.StringType()),
            T.StructField(REASON, T.StringType()),
            T.StructField(PARTIAL, T.BooleanType()),
            T.StructField(COMMITTED, T.TimestampType()),
            *([T.StructField(REST, T.StringType())] if self.keep_unknown else []),
        ])

    def topic(self, prefix: str, database: str) -> str:
        return ".".join([prefix, database, self.name])


def row_schema(columns: str) -> T.StructType:
    """Nullable columns from ``"name type, name type"``; unlike a DDL string, without a session."""
    schema = T.StructType()
    for column in columns.split(","):
        schema.add(*column.split())
    return schema


# The shop tables' columns, keys and column defaults.
ORDERS = TableSpec(
    "orders", "order_id",
    row_schema("order_id integer, user_id integer, eval_set string, order_number integer, "
               "order_dow integer, order_hour_of_day integer, days_since_prior float, "
               "status string, created_at string, updated_at string"),
    {"eval_set": "train", "order_number": 1, "order_dow": 0, "order_hour_of_day": 12,
     "status": "completed"},
    ("created_at", "updated_at"),
)
ORDER_PRODUCTS = TableSpec(
    "order_products", "id",
    row_schema("id long, order_id integer, product_id integer, add_to_cart_order integer, "
               "reordered integer, created_at string"),
    {"add_to_cart_order": 1, "reordered": 0},
    ("created_at",),
)
PRODUCTS = TableSpec(
    "products", "product_id",
    row_schema("product_id integer, product_name string, aisle_id integer, department_id integer"),
    {"aisle_id": 1, "department_id": 1},
)
SHOP_TABLES = [ORDERS, ORDER_PRODUCTS, PRODUCTS]
