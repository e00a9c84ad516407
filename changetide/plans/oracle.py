"""The registered queries in ANSI SQL over the given tables, to check the results against.

Nothing here is executed by the library.
"""

from __future__ import annotations

from .catalog import CHANGED, CSV_DAMAGED, KEY, LIMIT, LOST, SOURCE_TIME, STORED_VERSION, VERSION
from .feeds import DAMAGED, LATE
from .replays import DELIVERIES, PERIOD, STOPPED, TOPIC_PARTITIONS

_EXTRA = 10_000_000

# Changes of ``events``, optionally with late ones a batch later.
_CHANGES = """
log AS (
  SELECT user_id, event_id, event_type, value, props, epoch_us(ts) // 1000 AS ts_ms,
         CASE event_type WHEN 'signup' THEN 'c' WHEN 'error' THEN 'd' ELSE 'u' END AS op,
         event_type = 'error' AS is_delete,
         CAST(day(ts) - 1 + {delay} AS BIGINT) AS batch_id
  FROM events
)"""
_ON_TIME = _CHANGES.format(delay="0")
_WITH_LATE = _CHANGES.format(delay=f"CASE WHEN event_id % {LATE} = 0 THEN 1 ELSE 0 END")

_ROW = "user_id, event_id, event_type, value, props"

# What becomes of each damaged message.
_DAMAGED = f"""
msgs AS (
  SELECT event_id AS msg_offset, ts, event_id % {DAMAGED} AS damage, user_id, event_id, event_type,
         value, props, epoch_us(ts) // 1000 AS ts_ms, day(ts) - 1 AS day_no,
         CASE event_type WHEN 'signup' THEN 'c' WHEN 'error' THEN 'd' ELSE 'u' END AS op,
         event_type = 'error' AS is_delete
  FROM events
),
classified AS (
  SELECT *, CASE WHEN damage = 0 THEN 'malformed' WHEN damage = 1 THEN 'tombstone'
                 WHEN damage = 2 THEN 'null_key'
                 WHEN damage = 3 AND NOT is_delete THEN 'unknown_op'
                 WHEN damage = 4 THEN 'no_metadata' END AS reason
  FROM msgs
),
kinds AS (
  SELECT *, CASE WHEN reason IS NOT NULL THEN 'reject' WHEN is_delete THEN 'delete'
                 ELSE 'upsert' END AS kind
  FROM classified
)"""


def _latest(source: str, order: str = "ts_ms DESC, event_id DESC") -> str:
    return (f"SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY {order}) "
            f"AS rn FROM {source}) ranked WHERE rn = 1")


def _state(changes: str, where: str = "TRUE", order: str = "ts_ms DESC, event_id DESC",
           then: str = "") -> str:
    return f"""
WITH {changes}, seen AS (SELECT * FROM log WHERE {where}),
won AS ({_latest("seen", order)})
SELECT {_ROW} FROM won WHERE NOT is_delete {then}"""


_DELETE_WINS = "batch_id DESC, is_delete DESC, ts_ms DESC, event_id DESC"


def _version_counts(order: str, changes: str = _WITH_LATE) -> str:
    return f"""
WITH {changes},
v AS (SELECT batch_id AS upto, row_number() OVER (ORDER BY batch_id) - 1 AS version
      FROM (SELECT DISTINCT batch_id FROM log) b),
ranked AS (
  SELECT v.version, v.upto, l.is_delete, row_number() OVER (
           PARTITION BY v.version, l.user_id ORDER BY {order}) AS rn
  FROM v JOIN log l ON l.batch_id <= v.upto),
counted AS (
  SELECT version, upto AS batch_id, CAST(count(*) FILTER (WHERE NOT is_delete) AS BIGINT) AS n_rows
  FROM ranked WHERE rn = 1 GROUP BY version, upto)
SELECT version, batch_id, n_rows, n_rows - lag(n_rows) OVER (ORDER BY version) AS change
FROM counted"""


# The same by periods of days, as the stored log has them.
_BY_PERIOD = f"""{_CHANGES.format(delay=f"CASE WHEN event_id % {LATE} = 0 THEN 1 ELSE 0 END").replace("log AS", "days AS")},
log AS (SELECT * REPLACE (batch_id // {PERIOD} AS batch_id) FROM days)"""

_BATCHES = """
batches AS (
  SELECT batch_id, count(*) FILTER (WHERE NOT is_delete) AS n_upserts,
         count(*) FILTER (WHERE is_delete) AS n_deletes,
         min(ts_ms) AS min_source_ts_ms, max(ts_ms) AS max_source_ts_ms
  FROM log GROUP BY batch_id),
hist AS (
  SELECT row_number() OVER (ORDER BY batch_id) - 1 AS version, * FROM batches)
"""
_HISTORY = f"WITH {_WITH_LATE}, {_BATCHES}"
_OPERATION = "CASE WHEN version = 0 THEN 'WRITE' ELSE 'MERGE' END AS operation"

_OPERATIONS = f"""
SELECT version, batch_id, {_OPERATION},
       CASE WHEN version = 0 THEN 'mode=create' ELSE 'key=user_id' END AS operation_parameters,
       n_upserts, n_deletes, min_source_ts_ms, max_source_ts_ms FROM hist"""

_PRODUCTS = """
products AS (
  SELECT CAST(p_partkey AS INTEGER) AS product_id, p_name AS product_name,
         CAST(regexp_extract(p_brand, '([0-9]+)', 1) AS INTEGER) AS aisle_id,
         CAST(p_size AS INTEGER) AS department_id
  FROM part
)"""
_REPLICA = f"""
replica AS (
  SELECT product_id, CASE WHEN product_id % 89 = 0 THEN NULL ELSE product_name END AS product_name,
         aisle_id, department_id
  FROM products WHERE product_id % 97 <> 0
  UNION ALL
  SELECT product_id + {_EXTRA}, product_name, aisle_id, department_id
  FROM products WHERE product_id % 83 = 0
)"""

_METRICS = f"""
WITH {_DAMAGED}, late AS (
  SELECT *, CAST(day_no + CASE WHEN event_id % {LATE} = 0 THEN 1 ELSE 0 END AS BIGINT) AS batch_id
  FROM kinds)
SELECT {{batch}} AS batch_id, count(*) AS n_total, count(*) FILTER (WHERE kind = 'upsert') AS n_upserts,
       count(*) FILTER (WHERE kind = 'delete') AS n_deletes,
       count(*) FILTER (WHERE kind = 'reject') AS n_rejects,
       count(*) FILTER (WHERE reason IS NULL AND damage = 5) AS n_partially_decoded
FROM late GROUP BY 1"""

_CSV_ORDERS = """
SELECT CAST(o_orderkey AS INTEGER) AS order_id, CAST(o_custkey AS INTEGER) AS user_id,
       'train' AS eval_set, 1 AS order_number, CAST(dayofweek(o_orderdate) AS INTEGER) AS order_dow,
       CAST(hour(o_orderdate) AS INTEGER) AS order_hour_of_day,
       CAST(NULL AS FLOAT) AS days_since_prior, o_orderstatus AS status,
       strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS created_at,
       strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS updated_at
FROM orders"""

_RECONCILED = f"""
WITH {_PRODUCTS}, {_REPLICA}
SELECT coalesce(s.product_id, r.product_id) AS product_id,
       CASE WHEN r.product_id IS NULL THEN 'missing' WHEN s.product_id IS NULL THEN 'extra'
            WHEN s.product_name IS NOT DISTINCT FROM r.product_name
             AND s.aisle_id IS NOT DISTINCT FROM r.aisle_id
             AND s.department_id IS NOT DISTINCT FROM r.department_id THEN 'equal'
            ELSE 'different' END AS status
FROM products s FULL OUTER JOIN replica r ON s.product_id = r.product_id"""

_UPDATED = """
SELECT CAST(o_orderkey AS INTEGER) AS order_id, CAST(o_custkey AS INTEGER) AS user_id,
       CASE WHEN o_orderstatus = 'P' THEN 'cancelled' ELSE o_orderstatus END AS status,
       CAST(CASE WHEN o_orderstatus = 'P' THEN 2 ELSE 1 END AS INTEGER) AS order_number
FROM orders"""

_CASCADED = """
WITH kept AS (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'F')
SELECT 'orders' AS table_name, o_orderkey AS order_key, count(*) AS n_rows FROM kept GROUP BY o_orderkey
UNION ALL
SELECT 'lineitem', l_orderkey, {n} FROM lineitem l
WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_orderkey = l.l_orderkey AND o.o_orderstatus = 'F')
GROUP BY l_orderkey"""

_DELIVERY = "CASE " + " ".join(
    f"WHEN batch_id >= {first} THEN {number}"
    for number, first in reversed(list(enumerate(DELIVERIES)))) + " END"

ORACLE: dict[str, str] = {
    "decode_changes": f"""
WITH {_DAMAGED}
SELECT msg_offset,
       CASE WHEN damage NOT IN (0, 1, 2) THEN user_id END AS user_id,
       CASE WHEN damage NOT IN (0, 1) THEN event_id END AS event_id,
       CASE WHEN damage NOT IN (0, 1) THEN event_type END AS event_type,
       CASE WHEN damage NOT IN (0, 1, 5) THEN value END AS value,
       CASE WHEN damage NOT IN (0, 1) THEN props END AS props,
       CASE WHEN damage IN (0, 1, 4) THEN NULL WHEN damage = 3 THEN 't' ELSE op END AS op,
       CASE WHEN damage IN (0, 1, 4) THEN NULL WHEN is_delete THEN 'true' ELSE 'false' END AS deleted,
       CASE WHEN damage IN (0, 1, 4) THEN NULL ELSE ts_ms END AS source_ts_ms
FROM msgs""",
    "classify_changes": f"""
WITH {_DAMAGED}
SELECT msg_offset, kind, reason, reason IS NULL AND damage = 5 AS partially_decoded FROM kinds""",
    "reject_summary": f"""
WITH {_DAMAGED}
SELECT reason, count(*) AS n_messages FROM kinds WHERE reason IS NOT NULL GROUP BY reason""",
    "route_by_table": """
SELECT 'users' AS table_name, count(*) AS n_messages,
       count(*) FILTER (WHERE event_type <> 'error') AS n_upserts,
       count(*) FILTER (WHERE event_type = 'error') AS n_deletes FROM events
UNION ALL SELECT 'orders', count(*), count(*), 0 FROM orders
UNION ALL SELECT 'products', count(*), count(*), 0 FROM part""",
    "flatten_envelope": f"""
WITH {_ON_TIME}
SELECT {_ROW}, op, 'users' AS table_name, ts_ms AS source_ts_ms,
       CASE WHEN is_delete THEN 'true' ELSE 'false' END AS deleted FROM log
UNION ALL
SELECT NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL FROM log WHERE is_delete""",
    "current_state": _state(_WITH_LATE),
    "current_state_delete_wins": _state(_WITH_LATE, order=_DELETE_WINS),
    "time_travel_v": _state(
        _WITH_LATE, f"batch_id <= (SELECT batch_id FROM (SELECT batch_id, row_number() OVER "
                    f"(ORDER BY batch_id) - 1 AS version FROM (SELECT DISTINCT batch_id FROM log) b)"
                    f" v WHERE version = {VERSION})"),
    "time_travel_ts": _state(_WITH_LATE, f"ts_ms <= {SOURCE_TIME}"),
    "point_lookup": _state(_WITH_LATE, f"user_id = {KEY}"),
    "history": _HISTORY + _OPERATIONS,
    "last_operations": _HISTORY + f"""
SELECT version, {_OPERATION}, n_upserts, n_deletes FROM hist ORDER BY version DESC LIMIT 5""",
    "version_row_counts": _version_counts("l.ts_ms DESC, l.event_id DESC"),
    "version_row_counts_delete_wins": _version_counts(
        "l.batch_id DESC, l.is_delete DESC, l.ts_ms DESC, l.event_id DESC"),
    "batch_metrics": _METRICS.format(batch="batch_id"),
    "merge_upsert": f"""
WITH {_PRODUCTS}
SELECT product_id, CASE WHEN department_id > 25 THEN upper(product_name) ELSE product_name END
         AS product_name, aisle_id, department_id FROM products
UNION ALL
SELECT product_id + {_EXTRA}, product_name, aisle_id, department_id FROM products
WHERE department_id <= 5""",
    "merge_delete": """
SELECT o_orderkey, o_custkey, o_totalprice FROM orders o
WHERE NOT EXISTS (SELECT 1 FROM lineitem l
                  WHERE l.l_orderkey = o.o_orderkey AND l.l_returnflag = 'R')""",
    "insert_if_absent": """
WITH target AS (SELECT c_custkey, c_acctbal FROM customer WHERE c_acctbal > 0),
incoming AS (
  SELECT o_custkey, o_totalprice,
         row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS rn FROM orders)
SELECT c_custkey, c_acctbal FROM target
UNION ALL
SELECT o_custkey, o_totalprice FROM incoming
WHERE rn = 1 AND NOT EXISTS (SELECT 1 FROM target t WHERE t.c_custkey = incoming.o_custkey)""",
    "update_where": _UPDATED,
    "update_where_logged": _UPDATED,
    "cascade_delete": _CASCADED.format(n="count(*)"),
    "cascade_delete_logged": _CASCADED.format(n="count(DISTINCT l_linenumber)"),
    "reconcile": _RECONCILED,
    "reconcile_unique_keys": _RECONCILED,
    "reconcile_by_checksum": f"""
SELECT c_custkey, CASE WHEN c_custkey BETWEEN {LOST[0]} AND {LOST[1]} THEN 'missing'
                       WHEN c_custkey BETWEEN {CHANGED[0]} AND {CHANGED[1]} THEN 'different' ELSE 'equal' END AS status
FROM customer""",
    "verify_key": f"""
WITH {_PRODUCTS}
SELECT product_id, 0 AS source_value, aisle_id AS replica_value, aisle_id = 0 AS in_sync
FROM products WHERE product_id = {KEY}""",
    "csv_snapshot_load": _CSV_ORDERS,
    "csv_limited_load": f"{_CSV_ORDERS} ORDER BY o_orderkey LIMIT {LIMIT}",
    "csv_damaged_load": f"""
SELECT CAST(o_orderkey AS INTEGER) AS order_id,
       CASE WHEN o_orderkey % {CSV_DAMAGED} <> 1 THEN CAST(o_custkey AS INTEGER) END AS user_id, o_orderstatus AS status,
       CAST(dayofweek(o_orderdate) AS INTEGER) AS order_dow
FROM orders WHERE o_orderkey % {CSV_DAMAGED} NOT IN (0, 2)""",
    "csv_rejects": f"""
SELECT 'malformed' AS reason, NULL AS column_name, count(*) AS n, min(o_orderkey || ',' || o_custkey || ',train') AS least
FROM orders WHERE o_orderkey % {CSV_DAMAGED} = 0
UNION ALL
SELECT 'unreadable', 'user_id', count(*), 'x' FROM orders WHERE o_orderkey % {CSV_DAMAGED} = 1
UNION ALL
SELECT 'null_key', 'order_id', count(*), min(
         '{{"order_id":"none","user_id":"' || o_custkey || '","eval_set":"train","order_number":"1","order_dow":"'
         || dayofweek(o_orderdate) || '","order_hour_of_day":"' || hour(o_orderdate) || '","status":"' || o_orderstatus
         || '","created_at":"' || strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') || '","updated_at":"'
         || strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') || '"}}')
FROM orders WHERE o_orderkey % {CSV_DAMAGED} = 2""",
    "csv_numbered_load": """
SELECT count(*) AS n_rows, CAST(1 AS BIGINT) AS min_id, count(*) AS max_id, count(*) AS n_ids,
       CAST(sum(l_orderkey) AS BIGINT) AS sum_order_id,
       CAST(sum(l_partkey) AS BIGINT) AS sum_product_id, CAST(0 AS BIGINT) AS sum_reordered
FROM lineitem""",
    "snapshot_bootstrap": f"""
WITH {_PRODUCTS}
SELECT product_id, CASE WHEN department_id < 10 THEN upper(product_name) ELSE product_name END
         AS product_name, aisle_id, department_id
FROM products WHERE department_id < 40""",
    "stream_ingest": _state(_ON_TIME),
    "stream_offsets": _state(_ON_TIME, order=f"ts_ms DESC, event_id % {TOPIC_PARTITIONS} DESC, event_id DESC"),
    "stream_replay": """
SELECT count(*) AS n_changes, count(*) FILTER (WHERE event_type <> 'error') AS n_upserts,
       count(*) FILTER (WHERE event_type = 'error') AS n_deletes, count(*) AS n_offsets
FROM events""",
    "stream_resume": f"""
WITH {_WITH_LATE},
delivered AS (SELECT *, {_DELIVERY} AS version FROM log),
v AS (SELECT DISTINCT version FROM delivered),
ranked AS (
  SELECT v.version, l.is_delete, row_number() OVER (
           PARTITION BY v.version, l.user_id ORDER BY l.ts_ms DESC, l.event_id DESC) AS rn
  FROM v JOIN delivered l ON l.version <= v.version),
counted AS (
  SELECT version, count(*) FILTER (WHERE NOT is_delete) AS n_rows
  FROM ranked WHERE rn = 1 GROUP BY version),
sizes AS (
  SELECT version, count(*) FILTER (WHERE NOT is_delete) AS n_upserts,
         count(*) FILTER (WHERE is_delete) AS n_deletes FROM delivered GROUP BY version)
SELECT CAST(s.version AS BIGINT) AS version,
       CASE WHEN s.version = 0 THEN 'WRITE' ELSE 'MERGE' END AS operation, n_upserts, n_deletes,
       n_rows, n_rows - lag(n_rows) OVER (ORDER BY s.version) AS change
FROM sizes s JOIN counted c ON c.version = s.version""",
    "stream_multi_table": """
WITH ranked AS (
  SELECT l_returnflag, row_number() OVER (
           PARTITION BY l_orderkey ORDER BY l_shipdate DESC, l_linenumber DESC,
           CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS rn FROM lineitem)
SELECT 'orders' AS table_name, count(*) AS n_rows FROM orders
UNION ALL SELECT 'last_lines', count(*) FROM ranked WHERE rn = 1 AND l_returnflag <> 'R'
UNION ALL SELECT 'products', count(*) FROM part""",
    "compacted_state": _state(_WITH_LATE),
    "compacted_runs": _state(_BY_PERIOD),
    "compacted_counts": _version_counts("l.ts_ms DESC, l.event_id DESC", _BY_PERIOD),
    "stored_history": f"WITH {_BY_PERIOD}, {_BATCHES}{_OPERATIONS}",
    "stored_batch_metrics": _METRICS.format(batch=f"batch_id // {PERIOD}"),
    "stored_time_travel_v": _state(_BY_PERIOD, f"batch_id <= {STORED_VERSION}"),
    "stored_time_travel_ts": _state(_BY_PERIOD, f"ts_ms <= {SOURCE_TIME}"),
    "stored_point_lookup": _state(_BY_PERIOD, f"user_id = {KEY}"),
    "stored_overview": f"""
WITH {_BY_PERIOD}, won AS ({_latest("log")})
SELECT 'users' AS table_name, (SELECT count(*) FROM won WHERE NOT is_delete) AS n_rows,
       (SELECT count(DISTINCT batch_id) FROM log) AS n_versions, 'MERGE' AS last_operation,
       'user_id,event_id,event_type,value,props' AS "columns" """,
    "orders_by_status": """
SELECT o_orderstatus AS status, count(*) AS n FROM orders GROUP BY o_orderstatus""",
    "orders_by_weekday": """
SELECT CAST(dayofweek(o_orderdate) AS INTEGER) AS order_dow,
       CASE dayofweek(o_orderdate) WHEN 0 THEN 'CN' WHEN 1 THEN 'T2' WHEN 2 THEN 'T3'
         WHEN 3 THEN 'T4' WHEN 4 THEN 'T5' WHEN 5 THEN 'T6' WHEN 6 THEN 'T7' END AS day,
       count(*) AS n FROM orders GROUP BY 1, 2""",
    "top_hours": """
SELECT CAST(hour(ts) AS INTEGER) AS order_hour_of_day, count(*) AS n FROM events
GROUP BY 1 ORDER BY n DESC, 1 LIMIT 5""",
    "hour_share": """
SELECT CAST(hour(ts) AS INTEGER) AS order_hour_of_day, count(*) AS n,
       CAST((count(*) * 2000 + sum(count(*)) OVER ()) // (2 * sum(count(*)) OVER ()) AS DOUBLE) / 10
         AS pct
FROM events GROUP BY 1 ORDER BY n DESC, 1 LIMIT 10""",
    "top_products": """
SELECT l_partkey AS product_id, count(*) AS n FROM lineitem
GROUP BY l_partkey ORDER BY n DESC, l_partkey LIMIT 10""",
    "sample_rows": _state(_WITH_LATE, then="ORDER BY user_id LIMIT 10"),
    "table_counts": """
SELECT 'orders' AS table_name, count(*) AS n_rows FROM orders
UNION ALL SELECT 'lineitem', count(*) FROM lineitem
UNION ALL SELECT 'part', count(*) FROM part
UNION ALL SELECT 'events', count(*) FROM events""",
    "overview": f"""
WITH {_WITH_LATE}, won AS ({_latest("log")})
SELECT 'users' AS table_name, (SELECT count(*) FROM won WHERE NOT is_delete) AS n_rows,
       (SELECT count(DISTINCT batch_id) FROM log) AS n_versions, 'MERGE' AS last_operation,
       'user_id,event_id,event_type,value,props' AS "columns"
UNION ALL
SELECT 'orders', (SELECT count(*) FROM orders), 1, 'WRITE',
       'order_id,user_id,eval_set,order_number,order_dow,order_hour_of_day,days_since_prior,'
       || 'status,created_at,updated_at'
UNION ALL
SELECT 'products', (SELECT count(*) FROM part), 1, 'WRITE',
       'product_id,product_name,aisle_id,department_id'""",
    "rows_at_cut": f"""
WITH {_WITH_LATE},
seen AS (SELECT *, CASE WHEN user_id % 2 = 0 THEN 'even' ELSE 'odd' END AS table_name FROM log
         WHERE user_id % 2 = 1 OR batch_id < {STOPPED}),
cut AS (SELECT min(passed) AS ms FROM (SELECT max(ts_ms) AS passed FROM seen GROUP BY table_name) p),
known AS (SELECT * FROM seen WHERE ts_ms <= (SELECT ms FROM cut)),
won AS ({_latest("known")})
SELECT t.table_name, (SELECT count(*) FROM won w WHERE w.table_name = t.table_name AND NOT is_delete) AS n_rows,
       (SELECT ms FROM cut) AS cut_ms
FROM (VALUES ('even'), ('odd')) t(table_name)""",
    "widened_table": _state(_WITH_LATE),
    "snapshot_refresh": f"""
WITH {_PRODUCTS}
SELECT product_id, CASE WHEN department_id < 10 THEN upper(product_name) ELSE product_name END AS product_name,
       CASE WHEN department_id < 10 THEN aisle_id ELSE 0 END AS aisle_id, department_id
FROM products WHERE department_id < 10 OR department_id % 2 = 0""",
}
