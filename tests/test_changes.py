"""Decoding, classification and reject reasons, case by case."""

import itertools

import pytest
from pyspark.sql import functions as F

from changetide.functions.changes import is_delete, is_upsert
from changetide.functions.report import WEEKDAYS, weekday_label
from changetide.operators import classify, decode, reject_summary, rejects, to_messages
from changetide.sources import flatten_envelope, route
from changetide.spec import (
    BAD, DELETED, KIND, ORDERS, ORDER_PRODUCTS, PARTIAL, PRODUCTS, REASON, SHOP_TABLES, VALUE,
)

from helpers import ITEMS, messages_of, payload

# (payload, kind, reason) for the shop's orders.
EDGE_CASES = [
    (None, "reject", "tombstone"),
    ("{bad", "reject", "malformed"),
    ('{"order_id":1,"reordered":true,"__op":"c"}', "upsert", None),
    ('{"order_id":"x","__op":"c"}', "reject", "null_key"),
    ('{"order_id":7,"extra":1,"__op":"u","__deleted":"false"}', "upsert", None),
    ("null", "reject", "tombstone"),
    ("", "reject", "tombstone"),
    ("  ", "reject", "tombstone"),
    ('{"order_id":8,"__op":"d","__deleted":"false"}', "delete", None),
    ('{"order_id":9,"__op":"c","__deleted":"true"}', "delete", None),
    ('{"order_id":10,"__deleted":"true"}', "delete", None),
    ('{"order_id":11,"__deleted":"false"}', "reject", "unknown_op"),
    ('{"order_id":12,"__op":"t"}', "reject", "unknown_op"),
    ('{"order_id":13,"__op":"r"}', "upsert", None),
    ('{"order_id":5}', "reject", "no_metadata"),
    ('{"order_id":6,"__op":"u","user_id":"many"}', "upsert", None),
    ("[1, 2]", "reject", "malformed"),
]


def classified(spark, values, spec):
    return classify(decode(messages_of(spark, values), spec), spec).orderBy("__offset").collect()


def test_edge_cases(spark):
    rows = classified(spark, [value for value, _, _ in EDGE_CASES], ORDERS)
    assert [(r[KIND], r[REASON]) for r in rows] == [(k, reason) for _, k, reason in EDGE_CASES]
    kept = [r[VALUE] for r in rows if r[KIND] == "reject"]
    assert kept == [value for value, kind, _ in EDGE_CASES if kind == "reject"]
    assert all(r[VALUE] is None for r in rows if r[KIND] != "reject")


def test_one_bad_field_leaves_the_others(spark):
    value = '{"id":3,"order_id":1,"reordered":true,"__op":"c"}'
    row, = classified(spark, [value], ORDER_PRODUCTS)
    assert (row["id"], row["order_id"], row["reordered"]) == (3, 1, None)
    assert row[KIND] == "upsert" and row[PARTIAL]


def test_truth_table(spark):
    ops = [None, "c", "u", "r", "d", "t"]
    flags = [None, "true", "false", "TRUE", ""]
    cases = list(itertools.product(ops, flags))

    def expected(op, deleted):
        if deleted == "true" or op == "d":
            return (True, False)
        return (False, op in ("c", "u", "r"))

    frame = spark.createDataFrame(cases, f"__op STRING, {DELETED} STRING")
    rows = frame.select("__op", DELETED, is_delete().alias("del"),
                        is_upsert().alias("up")).collect()
    for row in rows:
        want_delete, want_upsert = expected(row["__op"], row[DELETED])
        assert row["del"] == want_delete, row
        if not want_delete:
            assert row["up"] == want_upsert, row


def test_rejects_are_counted_by_reason(spark):
    values = ["", "{bad", "{bad too", payload(1, 1), payload(None, 1)]
    classified_rows = classify(decode(messages_of(spark, values), ITEMS), ITEMS)
    assert {r.reason: r.n_messages for r in reject_summary(classified_rows).collect()} == {
        "tombstone": 1, "malformed": 2, "null_key": 1}
    assert {r.value for r in rejects(classified_rows).collect()} >= {"{bad", "{bad too"}


def test_messages_survive_a_round_trip(spark):
    rows = spark.createDataFrame(
        [(1, 5, "c", 10, "false", 3, 8)],
        "k INT, v INT, __op STRING, __source_ts_ms LONG, __deleted STRING, __partition INT, __offset LONG")
    back = decode(to_messages(rows, ITEMS, "t"), ITEMS).select(*rows.columns)
    assert back.collect() == rows.collect()


def test_decode_keeps_columns_beyond_the_frame(spark):
    messages = messages_of(spark, [payload(1, 2)]).withColumn("batch_id", F.lit(4))
    row = decode(messages, ITEMS).first()
    assert row["batch_id"] == 4 and row[BAD] is None


def test_weekday_labels(spark):
    days = spark.createDataFrame([(d,) for d in [*range(7), 7, -1, None]], "d INT")
    labels = [r[0] for r in days.select(weekday_label(F.col("d"))).collect()]
    assert labels == [*WEEKDAYS, None, None, None]


@pytest.mark.parametrize("keep", [True, False])
def test_envelopes(spark, keep):
    row = "STRUCT<k: INT, v: INT>"
    envelopes = spark.createDataFrame([
        ("c", None, (1, 10), "items", 100),
        ("u", (1, 10), (1, 11), "items", 200),
        ("d", (1, 11), None, "items", 300),
        (None, None, None, None, None),
    ], f"op STRING, before {row}, after {row}, table STRING, ts_ms LONG")
    flat = flatten_envelope(envelopes, keep_tombstones=keep)
    rows = [tuple(r) for r in flat.select("k", "v", "__op", "__table", "__source_ts_ms",
                                          "__deleted").collect()]
    expected = [(1, 10, "c", "items", 100, "false"), (1, 11, "u", "items", 200, "false"),
                (1, 11, "d", "items", 300, "true"), (None,) * 6]
    assert rows == (expected if keep else expected[:3])


def test_routing_by_topic(spark):
    topics = ["a.b.orders", "a.b.orders", "a.b.products", "a.b.audit", "other.b.orders"]
    frame = spark.createDataFrame([("{}", None, t, 0, i) for i, t in enumerate(topics)],
                                  "value STRING, ts TIMESTAMP, topic STRING, partition INT, offset LONG")
    routed = route(frame, SHOP_TABLES, "a", "b")
    assert {name: rows.count() for name, rows in routed.items()} == {
        "orders": 2, "order_products": 0, "products": 1}


def test_topic_names():
    assert PRODUCTS.topic("p", "db") == "p.db.products"
