"""Every operator as a named query over the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.changes import DELETE_WINS
from ..operators import (
    as_of, batch_metrics, cascade_delete, current, history, insert_if_absent, last_operations,
    lookup, merge_delete, merge_upsert, reconcile, reconcile_by_checksum, reject_summary, update_where, verify_key,
    version_row_counts,
)
from ..operators.decode import classify, decode, to_messages
from ..sources import bootstrap, csv_rejects, flatten_envelope, load_csv, route, scratch_dir, to_changes
from ..spec import (
    BATCH, KIND, OFFSET, ORDER_PRODUCTS, ORDERS, PARTIAL, PRODUCTS, REASON, UPSERT, DELETE, TableSpec,
)
from ..streaming import ChangeLog, cascade_delete_logged, make_batch_writer, progress, write_snapshot
from . import feeds, replays, reports

Query = Callable[[SparkSession, str], DataFrame]

# Parameters of the registered queries.
VERSION = 12
SOURCE_TIME = 1705276800000
KEY = 7
STORED_VERSION = 4
LIMIT = 500
CSV_DAMAGED = 50
LOST, CHANGED = (20, 29), (100, 107)

_EXTRA_KEYS = 10_000_000


# -- decoding -----------------------------------------------------------------------


def decode_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = feeds.event_messages(feeds.table(spark, sf_dir, "events"), damaged=True)
    return decode(messages, feeds.USERS).select(
        F.col(OFFSET).alias("msg_offset"), "user_id", "event_id", "event_type", "value", "props",
        F.col("__op").alias("op"), F.col("__deleted").alias("deleted"),
        F.col("__source_ts_ms").alias("source_ts_ms"))


def classify_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feeds.classified_events(spark, sf_dir, damaged=True).select(
        F.col(OFFSET).alias("msg_offset"), F.col(KIND).alias("kind"), F.col(REASON).alias("reason"),
        F.col(PARTIAL).alias("partially_decoded"))


def rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reject_summary(feeds.classified_events(spark, sf_dir, damaged=True))


def route_by_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One frame with the messages of four tables, three of them wanted."""
    def inserted(rows: DataFrame, spec: TableSpec) -> DataFrame:
        flat = rows.withColumn("__op", F.lit("c"))
        return to_messages(flat, spec, spec.topic(feeds.PREFIX, feeds.DATABASE))

    users = feeds.event_messages(feeds.table(spark, sf_dir, "events")).drop(BATCH)
    unwanted = users.withColumn("topic", F.lit(f"{feeds.PREFIX}.{feeds.DATABASE}.audit"))
    together = (
        users.unionByName(unwanted)
        .unionByName(inserted(feeds.order_rows(spark, sf_dir), ORDERS))
        .unionByName(inserted(feeds.product_rows(spark, sf_dir), PRODUCTS)))
    specs = [feeds.USERS, ORDERS, PRODUCTS]
    routed = route(together, specs, feeds.PREFIX, feeds.DATABASE)

    def counted(spec: TableSpec) -> DataFrame:
        return classify(decode(routed[spec.name], spec), spec).agg(
            F.count("*").alias("n_messages"),
            F.count_if(F.col(KIND) == UPSERT).alias("n_upserts"),
            F.count_if(F.col(KIND) == DELETE).alias("n_deletes"),
        ).withColumn("table_name", F.lit(spec.name))

    first, *others = [counted(spec) for spec in specs]
    for other in others:
        first = first.unionByName(other)
    return first


def flattened(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Envelopes of all events; every delete is followed by a tombstone."""
    flat = feeds.event_changes(feeds.table(spark, sf_dir, "events"))
    row = F.struct(*feeds.USERS.columns)
    deleted = F.col("__op") == "d"
    envelopes = flat.select(
        F.col("__op").alias("op"), F.when(deleted, row).alias("before"),
        F.when(~deleted, row).alias("after"), F.col("__table").alias("table"),
        F.col("__source_ts_ms").alias("ts_ms"))
    nothing = [F.lit(None).cast(f.dataType).alias(f.name) for f in envelopes.schema]
    tombstones = flat.filter(deleted).select(*nothing)
    return flatten_envelope(envelopes.unionByName(tombstones)).select(
        *feeds.USERS.columns, F.col("__op").alias("op"), F.col("__table").alias("table_name"),
        F.col("__source_ts_ms").alias("source_ts_ms"), F.col("__deleted").alias("deleted"))


# -- state --------------------------------------------------------------------------


def _late_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feeds.event_log(spark, sf_dir, late=True)


def current_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return current(_late_log(spark, sf_dir), feeds.USERS)


def current_state_delete_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return current(_late_log(spark, sf_dir), feeds.USERS, DELETE_WINS)


def time_travel_v(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_of(_late_log(spark, sf_dir), feeds.USERS, version=VERSION)


def time_travel_ts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_of(_late_log(spark, sf_dir), feeds.USERS, ts_ms=SOURCE_TIME)


def point_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookup(_late_log(spark, sf_dir), feeds.USERS, KEY)


def history_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return history(_late_log(spark, sf_dir), feeds.USERS).drop("timestamp")


def last_five_operations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return last_operations(history(_late_log(spark, sf_dir), feeds.USERS),
                           reports.LAST_OPERATIONS).select("version", "operation", "n_upserts",
                                                           "n_deletes")


def version_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return version_row_counts(_late_log(spark, sf_dir), feeds.USERS)


def version_counts_delete_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return version_row_counts(_late_log(spark, sf_dir), feeds.USERS, DELETE_WINS)


def metrics_by_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return batch_metrics(feeds.classified_events(spark, sf_dir, late=True, damaged=True))


# -- merges -------------------------------------------------------------------------


def upserted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts above a size renamed, and small ones added again under new keys."""
    parts = feeds.product_rows(spark, sf_dir)
    renamed = parts.filter("department_id > 25").withColumn("product_name", F.upper("product_name"))
    added = parts.filter("department_id <= 5").withColumn(
        "product_id", (F.col("product_id") + _EXTRA_KEYS).cast("int"))
    return merge_upsert(parts, renamed.unionByName(added), PRODUCTS.pk)


def deleted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders without those that have a returned line."""
    orders = feeds.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    returned = feeds.table(spark, sf_dir, "lineitem").filter("l_returnflag = 'R'").select(
        F.col("l_orderkey").alias("o_orderkey"))
    return merge_delete(orders, returned, "o_orderkey")


def inserted_if_absent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers in credit, and for each other customer with orders a row from the first order."""
    customers = feeds.table(spark, sf_dir, "customer").select(
        "c_custkey", "c_acctbal").filter("c_acctbal > 0")
    incoming = feeds.table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("c_custkey"), F.col("o_totalprice").alias("c_acctbal"), "o_orderkey")
    return insert_if_absent(customers, incoming, "c_custkey", order=["o_orderkey"])


def updated_where(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = update_where(feeds.order_rows(spark, sf_dir), F.col("status") == "P",
                        {"status": "cancelled", "order_number": F.col("order_number") + 1})
    return rows.select("order_id", "user_id", "status", "order_number")


def updated_where_logged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same update, written to the log as changes of the matching rows."""
    log = feeds.order_log(spark, sf_dir)
    matching = current(log, ORDERS).filter(F.col("status") == "P")
    updates = update_where(matching, F.lit(True),
                           {"status": "cancelled", "order_number": F.col("order_number") + 1})
    written = to_changes(updates.withColumn(BATCH, F.lit(0).cast("long")), ORDERS, "u", 1)
    return current(log.unionByName(written), ORDERS,
                   columns=["order_id", "user_id", "status", "order_number"])


def cascaded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fulfilled orders removed with their lines; what stays, by key."""
    orders = feeds.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    lines = feeds.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_quantity")
    doomed = orders.filter("o_orderstatus = 'F'").select("o_orderkey")
    parents, children = cascade_delete(orders, lines, doomed, "o_orderkey", "l_orderkey")
    return _kept(parents, "o_orderkey", "orders").unionByName(_kept(children, "l_orderkey", "lineitem"))


def _kept(rows: DataFrame, key: str, name: str) -> DataFrame:
    return rows.groupBy(F.col(key).cast("long").alias("order_key")).agg(
        F.count("*").alias("n_rows")).withColumn("table_name", F.lit(name))


def cascaded_logged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same as deletes in the logs of both tables, which appear together. Lines are known by order and number."""
    orders, lines = replays.orders_and_lines(spark, sf_dir)
    doomed = orders.current(columns=["status"]).filter("status = 'F'")
    cascade_delete_logged(orders, lines, doomed, "order_id", ts_ms=1)
    return _kept(orders.current(columns=[]), "order_id", "orders").unionByName(
        _kept(lines.current(columns=["order_id"]), "order_id", "lineitem"))


def _replica(parts: DataFrame) -> DataFrame:
    key = F.col("product_id")
    changed = parts.filter(key % 97 != 0).withColumn(
        "product_name", F.when(key % 89 == 0, F.lit(None)).otherwise(F.col("product_name")))
    extra = parts.filter(key % 83 == 0).withColumn("product_id", (key + _EXTRA_KEYS).cast("int"))
    return changed.unionByName(extra)


def reconciled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``part`` against a copy with rows dropped, changed and added."""
    parts = feeds.product_rows(spark, sf_dir)
    return reconcile(parts, _replica(parts), PRODUCTS.pk)


def reconciled_by_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = feeds.product_rows(spark, sf_dir)
    return reconcile(parts, _replica(parts), PRODUCTS.pk, unique_keys=True)


def reconciled_by_checksum(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers against a copy that differs in a stretch of keys and lacks another."""
    customers = feeds.table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_acctbal")
    key = F.col("c_custkey")
    copy = customers.filter(~key.between(*LOST)).withColumn(
        "c_acctbal", F.when(key.between(*CHANGED), F.col("c_acctbal") + 1).otherwise(F.col("c_acctbal")))
    return reconcile_by_checksum(customers, copy, "c_custkey", unique_keys=True)


def verified_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One part on both sides after an update that the replica has not seen."""
    parts = feeds.product_rows(spark, sf_dir)
    source = update_where(parts, F.col("product_id") == KEY, {"aisle_id": 0})
    return verify_key(source, _replica(parts), PRODUCTS.pk, KEY, "aisle_id")


# -- bulk ---------------------------------------------------------------------------


def csv_loaded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All orders written as CSV and loaded; the first candidate file does not exist."""
    path = scratch_dir(spark, "orders-csv")
    rows = feeds.as_orders(feeds.table(spark, sf_dir, "orders"))
    rows.write.option("header", True).option("escape", '"').csv(path)
    return load_csv(spark, [f"{path}-missing", path], ORDERS)


def csv_limited(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first orders of a folder of CSV files whose order is that of the keys."""
    path = scratch_dir(spark, "orders-csv")
    rows = feeds.as_orders(feeds.table(spark, sf_dir, "orders"))
    rows.orderBy(ORDERS.pk).write.option("header", True).option("escape", '"').csv(path)
    return load_csv(spark, [path], ORDERS, limit=LIMIT)


def _damaged_orders(spark: SparkSession, sf_dir: str) -> str:
    """All orders as CSV lines, some of them cut short and some with a cell that is no number."""
    path = scratch_dir(spark, "damaged-csv")
    rows = feeds.as_orders(feeds.table(spark, sf_dir, "orders")).select(*ORDERS.columns)
    damage = F.col(ORDERS.pk) % CSV_DAMAGED
    cells = {c: F.coalesce(F.col(c).cast("string"), F.lit("")) for c in rows.columns}
    cells["user_id"] = F.when(damage == 1, "x").otherwise(cells["user_id"])
    cells[ORDERS.pk] = F.when(damage == 2, "none").otherwise(cells[ORDERS.pk])
    line = F.concat_ws(",", *cells.values())
    cut = F.substring_index(line, ",", 3)
    # Written as one column with another separator, so that commas stay as they are.
    rows.select(F.when(damage == 0, cut).otherwise(line).alias(",".join(cells))).write.option("header", True).option("sep", "\x01").csv(path)
    return path


def csv_damaged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What can be loaded of them."""
    return load_csv(spark, [_damaged_orders(spark, sf_dir)], ORDERS, lenient=True).select("order_id", "user_id", "status", "order_dow")


def csv_left_out(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What cannot, by reason and column."""
    found = csv_rejects(spark, [_damaged_orders(spark, sf_dir)], ORDERS)
    return found.groupBy("reason", "column_name").agg(F.count("*").alias("n"), F.min("value").alias("least"))


def csv_numbered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All line items written as CSV without a key; the loader numbers them."""
    path = scratch_dir(spark, "lines-csv")
    feeds.table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("order_id"), F.col("l_partkey").alias("product_id"),
        F.col("l_linenumber").alias("add_to_cart_order"),
    ).write.option("header", True).csv(path)
    lines = load_csv(spark, [path], ORDER_PRODUCTS)
    return lines.agg(
        F.count("*").alias("n_rows"), F.min("id").alias("min_id"), F.max("id").alias("max_id"),
        F.count_distinct("id").alias("n_ids"), F.sum("order_id").alias("sum_order_id"),
        F.sum("product_id").alias("sum_product_id"), F.sum("reordered").alias("sum_reordered"))


def bootstrapped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Products from a snapshot, then live updates of some and deletes of others."""
    rows = feeds.product_rows(spark, sf_dir)
    snapshot = bootstrap(rows, PRODUCTS, 1000)
    renamed = rows.filter("department_id < 10").withColumn("product_name", F.upper("product_name"))
    live = to_changes(renamed, PRODUCTS, "u", 2000).unionByName(
        to_changes(rows.filter("department_id >= 40"), PRODUCTS, "d", 3000))
    return current(snapshot.unionByName(live), PRODUCTS)


# -- streams ------------------------------------------------------------------------


def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return replays.ingested(spark, sf_dir)[0].current()


def stream_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = replays.replayed(spark, sf_dir).read()
    return log.agg(
        F.count("*").alias("n_changes"), F.count_if(F.col(KIND) == UPSERT).alias("n_upserts"),
        F.count_if(F.col(KIND) == DELETE).alias("n_deletes"),
        F.count_distinct(OFFSET).alias("n_offsets"))


def stream_resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changes and live rows of every version of a stream resumed twice."""
    log = replays.resumed(spark, sf_dir)
    return log.history().select("version", "operation", "n_upserts", "n_deletes").join(
        log.version_row_counts().select("version", "n_rows", "change"), "version")


def stream_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return replays.numbered(spark, sf_dir).current()


def stream_multi_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    logs = replays.several_tables(spark, sf_dir)
    return reports.table_counts({name: log.current(columns=[]) for name, log in logs.items()})


def stream_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, query = replays.ingested(spark, sf_dir)
    return progress(spark, [query])


def compacted_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """State from a base of the first version and the versions after it."""
    log = replays.resumed(spark, sf_dir)
    if not log.bases():
        log.compact(version=0)
    return log.current()


def stored_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """History from the summaries that the commits left."""
    return replays.stored_log(spark, sf_dir).history().drop("timestamp")


def stored_batch_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return replays.stored_log(spark, sf_dir, damaged=True).batch_metrics()


def stored_time_travel_v(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A version between the base it starts from and one that it must not see."""
    return replays.stored_log(spark, sf_dir, compacted=[1, 5]).as_of(version=STORED_VERSION)


def stored_time_travel_ts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A time that no base after the first is old enough for."""
    return replays.stored_log(spark, sf_dir, compacted=[0, 4]).as_of(ts_ms=SOURCE_TIME)


def stored_point_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return replays.stored_log(spark, sf_dir, compacted=[2, 4]).lookup(KEY)


def stored_overview(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = replays.stored_log(spark, sf_dir, compacted=[3])
    return reports.overview([(log.spec, log.current(columns=[]), log.history(last=1))])


def compacted_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """State from a base that was compacted three times, and the versions after it."""
    return replays.stored_log(spark, sf_dir, compacted=[0, 2, 5]).current()


def compacted_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row counts of all versions, most of them from the steps that bases keep."""
    return replays.stored_log(spark, sf_dir, compacted=[1, 4]).version_row_counts()


def table_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    return replays.resumed(spark, sf_dir).detail()


def file_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return replays.resumed(spark, sf_dir).files().select("file_name", "kb")


# -- reports ------------------------------------------------------------------------


def _orders(spark: SparkSession, sf_dir: str, columns: list[str]) -> DataFrame:
    return current(feeds.order_log(spark, sf_dir), ORDERS, columns=columns)


def orders_by_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.count_by(_orders(spark, sf_dir, ["status"]), "status")


def orders_by_weekday(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.count_by_weekday(_orders(spark, sf_dir, ["order_dow"]))


def _hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feeds.table(spark, sf_dir, "events").select(F.hour("ts").alias("order_hour_of_day"))


def top_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.top_counts(_hours(spark, sf_dir), "order_hour_of_day", reports.TOP_HOURS)


def hour_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.share_by(_hours(spark, sf_dir), "order_hour_of_day", reports.HOUR_SHARES)


def top_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = feeds.table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("product_id"))
    return reports.top_counts(lines, "product_id", reports.TOP_PRODUCTS)


def sampled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.sample_rows(current_state(spark, sf_dir), feeds.USERS.pk, reports.SAMPLE_ROWS)


def table_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.table_counts({name: feeds.table(spark, sf_dir, name)
                                 for name in ["orders", "lineitem", "part", "events"]})


def overview(spark: SparkSession, sf_dir: str) -> DataFrame:
    logs = [(feeds.USERS, _late_log(spark, sf_dir)), (ORDERS, feeds.order_log(spark, sf_dir)),
            (PRODUCTS, feeds.product_log(spark, sf_dir))]
    return reports.overview([(spec, current(log, spec, columns=[]), history(log, spec))
                             for spec, log in logs])


def widened_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return replays.widened_log(spark, sf_dir).current()


def snapshot_refreshed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Products loaded, changed by a stream, and loaded anew with other rows: the load replaces the load, not the stream's changes."""
    log = ChangeLog(spark, PRODUCTS, scratch_dir(spark, "refreshed"))
    rows = feeds.product_rows(spark, sf_dir)
    write_snapshot(bootstrap(rows, PRODUCTS), PRODUCTS, log.root)
    renamed = rows.filter("department_id < 10").withColumns(
        {"product_name": F.upper("product_name"), "__op": F.lit("u"), "__source_ts_ms": F.lit(5)})
    make_batch_writer(PRODUCTS, log.root)(to_messages(renamed, PRODUCTS, PRODUCTS.topic(feeds.PREFIX, feeds.DATABASE)), 0)
    write_snapshot(bootstrap(rows.filter("department_id % 2 = 0").withColumn("aisle_id", F.lit(0)), PRODUCTS), PRODUCTS, log.root)
    return log.current()


def rows_at_cut(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.at_cut(replays.uneven_logs(spark, sf_dir))


QUERIES: dict[str, Query] = {
    "decode_changes": decode_changes,
    "classify_changes": classify_changes,
    "reject_summary": rejected,
    "route_by_table": route_by_table,
    "flatten_envelope": flattened,
    "current_state": current_state,
    "current_state_delete_wins": current_state_delete_wins,
    "time_travel_v": time_travel_v,
    "time_travel_ts": time_travel_ts,
    "point_lookup": point_lookup,
    "history": history_rows,
    "last_operations": last_five_operations,
    "version_row_counts": version_counts,
    "version_row_counts_delete_wins": version_counts_delete_wins,
    "batch_metrics": metrics_by_batch,
    "merge_upsert": upserted,
    "merge_delete": deleted,
    "insert_if_absent": inserted_if_absent,
    "update_where": updated_where,
    "update_where_logged": updated_where_logged,
    "cascade_delete": cascaded,
    "cascade_delete_logged": cascaded_logged,
    "reconcile": reconciled,
    "reconcile_unique_keys": reconciled_by_join,
    "reconcile_by_checksum": reconciled_by_checksum,
    "verify_key": verified_key,
    "csv_snapshot_load": csv_loaded,
    "csv_limited_load": csv_limited,
    "csv_damaged_load": csv_damaged,
    "csv_rejects": csv_left_out,
    "csv_numbered_load": csv_numbered,
    "snapshot_bootstrap": bootstrapped,
    "stream_ingest": stream_ingest,
    "stream_replay": stream_replay,
    "stream_resume": stream_resume,
    "stream_offsets": stream_offsets,
    "stream_multi_table": stream_multi_table,
    "stream_progress": stream_progress,
    "compacted_state": compacted_state,
    "stored_history": stored_history,
    "stored_batch_metrics": stored_batch_metrics,
    "stored_time_travel_v": stored_time_travel_v,
    "stored_time_travel_ts": stored_time_travel_ts,
    "stored_point_lookup": stored_point_lookup,
    "stored_overview": stored_overview,
    "compacted_runs": compacted_runs,
    "compacted_counts": compacted_counts,
    "table_detail": table_detail,
    "file_listing": file_listing,
    "orders_by_status": orders_by_status,
    "orders_by_weekday": orders_by_weekday,
    "top_hours": top_hours,
    "hour_share": hour_share,
    "top_products": top_products,
    "sample_rows": sampled,
    "table_counts": table_counts,
    "overview": overview,
    "rows_at_cut": rows_at_cut,
    "widened_table": widened_table,
    "snapshot_refresh": snapshot_refreshed,
}
