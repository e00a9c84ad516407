"""The reports. Each returns DataFrames; nothing is printed or collected."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.report import share_of_total, weekday_label
from ..operators.reconcile import reconcile_summary, verify_rows
from ..operators.timeline import last_operations
from ..spec import ORDER_PRODUCTS, ORDERS, TableSpec
from ..streaming.changelog import ChangeLog, consistent_cut

# Lengths of the report lists.
SAMPLE_ROWS, FIRST_VERSION_ROWS = 10, 5
TOP_HOURS, HOUR_SHARES, TOP_PRODUCTS = 5, 10, 10
HISTORY_ROWS, LAST_OPERATIONS, LISTED_FILES = 20, 5, 5


# -- building blocks ----------------------------------------------------------------


def count_by(rows: DataFrame, column: str) -> DataFrame:
    """Rows per value, most frequent first."""
    return rows.groupBy(column).agg(F.count("*").alias("n")).orderBy(F.desc("n"), column)


def top_counts(rows: DataFrame, column: str, k: int) -> DataFrame:
    """The k most frequent values; equal counts are ordered by value."""
    return count_by(rows, column).limit(k)


def share_by(rows: DataFrame, column: str, k: int) -> DataFrame:
    """The k most frequent values with their share of all rows in percent."""
    counted = rows.groupBy(column).agg(F.count("*").alias("n"))
    return (counted.withColumn("pct", share_of_total("n").cast("double"))
            .orderBy(F.desc("n"), column).limit(k))


def count_by_weekday(rows: DataFrame, column: str = "order_dow") -> DataFrame:
    """Rows per weekday number, with its label, in the order of the week."""
    counted = rows.groupBy(column).agg(F.count("*").alias("n"))
    return counted.select(column, weekday_label(F.col(column)).alias("day"), "n").orderBy(column)


def sample_rows(rows: DataFrame, pk: str, n: int) -> DataFrame:
    return rows.orderBy(pk).limit(n)


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Row count of each table."""
    counts = [rows.agg(F.count("*").alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
              for name, rows in tables.items()]
    return reduce(DataFrame.unionByName, counts)


# -- reports ------------------------------------------------------------------------


def overview(tables: Sequence[tuple[TableSpec, DataFrame, DataFrame]]) -> DataFrame:
    """Row count, number of versions, last operation and columns of each table.

    A table is given as its specification, live rows and history, of which the last row will do.
    """
    def one(spec: TableSpec, rows: DataFrame, history: DataFrame) -> DataFrame:
        live = rows.agg(F.count("*").alias("n")).scalar()
        return history.agg(
            (F.max("version") + 1).alias("n_versions"),
            F.max_by("operation", "version").alias("last_operation"),
        ).select(F.lit(spec.name).alias("table_name"), live.alias("n_rows"), "n_versions",
                 "last_operation", F.lit(",".join(spec.columns)).alias("columns"))

    return reduce(DataFrame.unionByName, [one(*table) for table in tables])


def latest_batches(logs: Mapping[str, ChangeLog], last: int = 1) -> DataFrame:
    """The last batches of each table: messages, duration and time of the commit."""
    return reduce(DataFrame.unionByName, [
        log.batch_timings(last).withColumn("table_name", F.lit(name)) for name, log in logs.items()])


def at_cut(logs: Mapping[str, ChangeLog]) -> DataFrame:
    """Row count of each table at the latest time that all have passed, and that time; no rows before there is one."""
    cut = consistent_cut(list(logs.values()))
    if cut is None:
        any_log = next(iter(logs.values()))
        return any_log.spark.createDataFrame([], "table_name STRING, n_rows LONG, cut_ms LONG")
    return table_counts({name: log.as_of(ts_ms=cut, columns=[]) for name, log in logs.items()}).withColumn(
        "cut_ms", F.lit(cut).cast("long"))


def current_data(orders: DataFrame) -> dict[str, DataFrame]:
    """Total, first rows, orders by status and the busiest hours of the current orders."""
    return {
        "total": table_counts({ORDERS.name: orders}),
        "sample": sample_rows(orders, ORDERS.pk, SAMPLE_ROWS),
        "by_status": count_by(orders, "status"),
        "top_hours": top_counts(orders, "order_hour_of_day", TOP_HOURS),
    }


def time_travel(log: ChangeLog, history: int = HISTORY_ROWS, versions: int | None = None) -> dict[str, DataFrame]:
    """The last operations, row counts of all or the first versions, and the first rows at version 0."""
    return {
        "history": last_operations(log.history(last=history), history),
        "row_counts": log.version_row_counts(first=versions).orderBy("version"),
        "first_version": sample_rows(log.as_of(version=0), log.spec.pk, FIRST_VERSION_ROWS),
    }


def verify(source: DataFrame, replica: DataFrame, pk: str, column: str,
           key: object = None) -> dict[str, DataFrame]:
    """All keys counted by status, and one column of one key on both sides.

    Without ``key`` the source's first key is taken; its one row goes to the replica's tasks.
    """
    if key is None:
        picked = sample_rows(source, pk, 1)
        there = replica.join(F.broadcast(picked.select(pk)), pk, "left_semi")
    else:
        picked, there = (rows.filter(F.col(pk) == F.lit(key)) for rows in (source, replica))
    return {"summary": reconcile_summary(source, replica, pk),
            "row": verify_rows(picked, there, pk, column)}


def analytics(orders: DataFrame, order_products: DataFrame | None = None) -> dict[str, DataFrame]:
    """Hours with shares, weekdays and status of orders; top products if there are line items."""
    out = {
        "hour_share": share_by(orders, "order_hour_of_day", HOUR_SHARES),
        "by_weekday": count_by_weekday(orders),
        "by_status": count_by(orders, "status"),
    }
    if order_products is not None:
        out["top_products"] = top_counts(order_products, "product_id", TOP_PRODUCTS)
    return out


def metadata(log: ChangeLog) -> dict[str, DataFrame]:
    """Table detail, last operations, and the number and first names of the data files."""
    files = log.files()
    return {
        "detail": log.detail(),
        "operations": last_operations(log.history(last=LAST_OPERATIONS), LAST_OPERATIONS),
        "file_count": table_counts({log.spec.name: files}).withColumnRenamed("n_rows", "n_files"),
        "files": files.select("file_name", "kb").orderBy("file_name").limit(LISTED_FILES),
    }


def stored_reports(logs: Mapping[str, ChangeLog],
                   only: str | None = None) -> dict[str, dict[str, DataFrame]]:
    """The reports on stored logs by table name, or one of them; absent tables are skipped.

    ``verify`` is not among them: it needs the source's rows as well.
    """
    present = {name: log for name, log in logs.items() if log.exists()}
    builders: dict[str, Callable[[], dict[str, DataFrame]]] = {}
    if present:
        builders["overview"] = lambda: {
            "overview": overview([(log.spec, log.current(columns=[]), log.history(last=1))
                                  for log in present.values()])}
    if ORDERS.name in present:
        log, lines = present[ORDERS.name], present.get(ORDER_PRODUCTS.name)
        builders.update({
            "current": lambda: current_data(log.current()),
            "time-travel": lambda: time_travel(log),
            "analytics": lambda: analytics(log.current(), lines.current() if lines else None),
            "metadata": lambda: metadata(log),
        })
    if present and only == "consistent":   # shown on request only
        builders["consistent"] = lambda: {"rows": at_cut(present)}
    return {name: build() for name, build in builders.items() if only in (None, name)}
