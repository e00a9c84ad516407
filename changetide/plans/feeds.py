"""Change feeds derived from the given tables, whole tables at a time.

``events`` becomes the changes of one row per user: a signup creates, an error deletes,
anything else updates. ``orders``, ``lineitem`` and ``part`` become the shop tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.decode import changes, classify, decode, to_messages
from ..spec import (
    BATCH, BROKER_TS, DELETED, OFFSET, OP, ORDER_PRODUCTS, ORDERS, PARTITION, PRODUCTS, SOURCE_TS, TABLE,
    TableSpec, row_schema,
)
from ..sources.bulk import bootstrap

PREFIX, DATABASE = "shop", "main"

USERS = TableSpec(
    "users", "user_id",
    row_schema("user_id long, event_id long, event_type string, value double, props string"))

# The same table as it was first described, and as it is read later.
NARROW_USERS = TableSpec("users", "user_id", row_schema("user_id long, event_type string"), keep_unknown=True)
WIDE_USERS = TableSpec("users", "user_id", USERS.schema, keep_unknown=True)

# One row per customer order, as the last line item to ship.
LAST_LINES = TableSpec(
    "last_lines", "l_orderkey",
    row_schema("l_orderkey long, l_linenumber integer, l_partkey long, l_suppkey long, "
               "l_quantity double, l_extendedprice double"))

# Every 17th event arrives one batch late; every 101st is cut short on the way.
LATE, DAMAGED = 17, 101

# Source time given to snapshot rows.
SNAPSHOT_TS = 0


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def millis(ts: str) -> str:
    """Milliseconds of a timestamp without zone, read as UTC in any session time zone."""
    return f"unix_millis(from_utc_timestamp(CAST({ts} AS TIMESTAMP), current_timezone()))"


def event_changes(events: DataFrame, late: bool = False) -> DataFrame:
    """Flat change rows of ``events`` with their batch: the day of month, from 0."""
    delay = f"CASE WHEN event_id % {LATE} = 0 THEN 1 ELSE 0 END" if late else "0"
    return events.selectExpr(
        *USERS.columns,
        f"CASE event_type WHEN 'signup' THEN 'c' WHEN 'error' THEN 'd' ELSE 'u' END AS {OP}",
        f"'{USERS.name}' AS {TABLE}",
        f"{millis('ts')} AS {SOURCE_TS}",
        f"CASE event_type WHEN 'error' THEN 'true' ELSE 'false' END AS {DELETED}",
        f"CAST(ts AS TIMESTAMP) AS {BROKER_TS}",
        f"0 AS {PARTITION}",
        f"event_id AS {OFFSET}",
        f"CAST(dayofmonth(ts) - 1 + {delay} AS BIGINT) AS {BATCH}",
    )


def event_messages(events: DataFrame, late: bool = False, damaged: bool = False) -> DataFrame:
    """``events`` as messages; with ``damaged`` some texts are unusable in known ways."""
    messages = to_messages(event_changes(events, late), USERS, USERS.topic(PREFIX, DATABASE))
    if not damaged:
        return messages
    number = F.col("offset")
    broken = (
        F.when(number % DAMAGED == 0, F.substring("value", 1, 10))
        .when(number % DAMAGED == 1, F.lit(None).cast("string"))
        .when(number % DAMAGED == 2, F.regexp_replace("value", '"user_id":', '"user":'))
        .when(number % DAMAGED == 3, F.regexp_replace("value", '"__op":"[cud]"', '"__op":"t"'))
        .when(number % DAMAGED == 4, F.regexp_replace("value", '"__', '"x_'))
        .when(number % DAMAGED == 5, F.regexp_replace("value", '"value":[-0-9.Ee]+', '"value":"n/a"'))
        .otherwise(F.col("value"))
    )
    return messages.withColumn("value", broken)


def classified_events(spark: SparkSession, sf_dir: str, late: bool = False,
                      damaged: bool = False) -> DataFrame:
    messages = event_messages(table(spark, sf_dir, "events"), late, damaged)
    return classify(decode(messages, USERS), USERS)


def event_log(spark: SparkSession, sf_dir: str, late: bool = False) -> DataFrame:
    """Change log of ``events``: written as messages, decoded and classified again."""
    return changes(classified_events(spark, sf_dir, late))


def as_orders(orders: DataFrame) -> DataFrame:
    """``orders`` in the columns of the shop's orders."""
    values = {
        "order_id": "o_orderkey", "user_id": "o_custkey",
        "eval_set": f"'{ORDERS.defaults['eval_set']}'", "order_number": "1",
        "order_dow": "dayofweek(o_orderdate) - 1", "order_hour_of_day": "hour(o_orderdate)",
        "days_since_prior": "NULL", "status": "o_orderstatus",
        "created_at": "o_orderdate", "updated_at": "o_orderdate",
    }
    return _cast(orders, ORDERS, values)


def as_products(parts: DataFrame) -> DataFrame:
    """``part`` in the columns of the shop's products; the brand number is the aisle."""
    values = {
        "product_id": "p_partkey", "product_name": "p_name",
        "aisle_id": "regexp_extract(p_brand, '([0-9]+)', 1)", "department_id": "p_size",
    }
    return _cast(parts, PRODUCTS, values)


def as_order_products(lines: DataFrame) -> DataFrame:
    """``lineitem`` in the columns of the shop's line items, numbered by order and line."""
    values = {
        "id": "l_orderkey * 8 + l_linenumber", "order_id": "l_orderkey", "product_id": "l_partkey",
        "add_to_cart_order": "l_linenumber", "reordered": "0", "created_at": "l_shipdate",
    }
    return _cast(lines, ORDER_PRODUCTS, values)


def _cast(rows: DataFrame, spec: TableSpec, values: dict[str, str]) -> DataFrame:
    return rows.selectExpr(*[f"CAST({values[f.name]} AS {f.dataType.simpleString()}) AS {f.name}"
                             for f in spec.schema])


def order_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_orders(table(spark, sf_dir, "orders"))


def product_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_products(table(spark, sf_dir, "part"))


def order_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _snapshot(order_rows(spark, sf_dir), ORDERS)


def product_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _snapshot(product_rows(spark, sf_dir), PRODUCTS)


def _snapshot(rows: DataFrame, spec: TableSpec) -> DataFrame:
    return bootstrap(rows, spec, SNAPSHOT_TS).withColumn(BATCH, F.lit(-1).cast("long"))


def line_changes(lines: DataFrame) -> DataFrame:
    """``lineitem`` as updates of its order's last line; returned lines delete it."""
    return lines.selectExpr(
        *LAST_LINES.columns,
        f"CASE l_returnflag WHEN 'R' THEN 'd' ELSE 'u' END AS {OP}",
        f"'{LAST_LINES.name}' AS {TABLE}",
        f"{millis('l_shipdate')} AS {SOURCE_TS}",
        f"CASE l_returnflag WHEN 'R' THEN 'true' ELSE 'false' END AS {DELETED}",
        f"0 AS {PARTITION}",
        f"CAST(l_linenumber AS BIGINT) AS {OFFSET}",
    )
