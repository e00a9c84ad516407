"""Merges in snapshot form, and that the log form ends the same."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from changetide.operators import (
    cascade_delete, current, insert_if_absent, merge_delete, merge_upsert, reconcile,
    reconcile_summary, update_where, verify_key,
)
from changetide.plans.reports import verify
from changetide.sources import bootstrap, to_changes
from changetide.spec import TableSpec, row_schema

from helpers import ITEMS, state


def items(spark, rows):
    return spark.createDataFrame(rows, "k INT, v INT")


def test_upsert_replaces_and_adds(spark):
    target, source = items(spark, [(1, 1), (2, 2)]), items(spark, [(2, 20), (3, 30)])
    assert state(merge_upsert(target, source, "k")) == {1: 1, 2: 20, 3: 30}


def test_upsert_refuses_a_repeated_key_without_an_order(spark):
    merged = merge_upsert(items(spark, [(1, 1)]), items(spark, [(1, 2), (1, 3)]), "k")
    with pytest.raises(Exception, match="several rows for k = 1"):
        merged.collect()


def test_upsert_takes_the_greatest_by_order(spark):
    source = spark.createDataFrame([(1, 5, 2), (1, 9, 1), (2, 7, 1)], "k INT, v INT, seq INT")
    merged = merge_upsert(items(spark, [(1, 1)]), source, "k", order=["seq"])
    assert merged.columns == ["k", "v"]
    assert state(merged) == {1: 5, 2: 7}


def test_null_keys_never_match(spark):
    target, source = items(spark, [(None, 1), (1, 1)]), items(spark, [(None, 2)])
    rows = sorted(tuple(r) for r in merge_upsert(target, source, "k").fillna(-1).collect())
    assert rows == [(-1, 1), (-1, 2), (1, 1)]


def test_delete(spark):
    target = items(spark, [(1, 1), (2, 2), (3, 3)])
    assert state(merge_delete(target, items(spark, [(2, 0), (2, 1), (9, 0)]), "k")) == {1: 1, 3: 3}


def test_insert_if_absent(spark):
    target, source = items(spark, [(1, 1)]), items(spark, [(1, 10), (2, 20)])
    assert state(insert_if_absent(target, source, "k")) == {1: 1, 2: 20}
    repeated = spark.createDataFrame([(2, 8, 2), (2, 9, 1)], "k INT, v INT, seq INT")
    assert state(insert_if_absent(target, repeated, "k", order=["seq"])) == {1: 1, 2: 9}


TABLE = st.dictionaries(st.integers(0, 15), st.integers(0, 99), max_size=10)


@settings(max_examples=8, deadline=None,
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(TABLE, TABLE)
def test_merges_equal_dictionaries(spark, old, new):
    target, source = items(spark, list(old.items())), items(spark, list(new.items()))
    assert state(merge_upsert(target, source, "k")) == {**old, **new}
    assert state(merge_delete(target, source, "k")) == {k: v for k, v in old.items() if k not in new}
    assert state(insert_if_absent(target, source, "k")) == {**new, **old}
    expected = {k: "missing" if k not in new else "extra" if k not in old
                else "equal" if old[k] == new[k] else "different" for k in {**old, **new}}
    for unique in (False, True):
        found = reconcile(target, source, "k", unique_keys=unique).collect()
        assert {r.k: r.status for r in found} == expected


def test_update_where_leaves_null_conditions_alone(spark):
    rows = update_where(items(spark, [(1, 1), (2, None), (3, 5)]), F.col("v") > 2, {"v": 0})
    assert state(rows) == {1: 1, 2: None, 3: 0}


def test_update_reads_the_old_values_of_all_columns(spark):
    rows = update_where(items(spark, [(1, 2)]), F.lit(True), {"k": F.col("v"), "v": F.col("k")})
    assert state(rows) == {2: 1}


def test_cascade(spark):
    parents = items(spark, [(1, 1), (2, 2)])
    lines = spark.createDataFrame([(10, 1), (11, 1), (12, 2)], "id INT, parent INT")
    kept, children = cascade_delete(parents, lines, items(spark, [(1, 0)]).select("k"), "k", "parent")
    assert state(kept) == {2: 2}
    assert [tuple(r) for r in children.collect()] == [(12, 2)]


def test_snapshot_form_equals_log_form(spark):
    start = items(spark, [(1, 1), (2, 2), (3, 3)])
    upserts, doomed = items(spark, [(2, 20), (4, 40)]), items(spark, [(3, 0), (4, 0)])
    snapshot = merge_delete(merge_upsert(start, upserts, "k"), doomed, "k")
    log = (bootstrap(start, ITEMS, 0).unionByName(to_changes(upserts, ITEMS, "u", 1))
           .unionByName(to_changes(doomed, ITEMS, "d", 2)))
    assert state(snapshot) == state(current(log, ITEMS)) == {1: 1, 2: 20}


def test_reconcile(spark):
    source = items(spark, [(1, 1), (2, None), (3, 3), (4, 4), (6, 6), (6, 7), (8, 8), (8, 8)])
    replica = items(spark, [(1, 1), (2, None), (3, 30), (5, 5), (6, 7), (6, 6), (8, 8)])
    result = {r.k: r.status for r in reconcile(source, replica, "k").collect()}
    assert result == {1: "equal", 2: "equal", 3: "different", 4: "missing", 5: "extra",
                      6: "equal", 8: "different"}
    unique = source.filter("k < 6"), replica.filter("k < 6")
    joined = {r.k: r.status for r in reconcile(*unique, "k", unique_keys=True).collect()}
    assert joined == {k: status for k, status in result.items() if k < 6}
    summary = {r.status: r.n_keys for r in reconcile_summary(source, replica, "k").collect()}
    assert summary == {"equal": 3, "different": 2, "missing": 1, "extra": 1}


def test_reconcile_needs_the_same_columns(spark):
    with pytest.raises(ValueError, match="columns differ"):
        reconcile(items(spark, []), items(spark, []).withColumnRenamed("v", "w"), "k")


def test_verify_key(spark):
    source, replica = items(spark, [(1, 1), (2, 2), (3, None)]), items(spark, [(1, 1), (2, 9), (3, None)])

    def check(key):
        return [tuple(r) for r in verify_key(source, replica, "k", key, "v").collect()]

    assert check(1) == [(1, 1, 1, True)]
    assert check(2) == [(2, 2, 9, False)]
    assert check(3) == [(3, None, None, True)]
    assert check(4) == []


def test_verify_report(spark):
    source, replica = items(spark, [(2, 2), (1, 1)]), items(spark, [(1, 7), (2, 2)])
    found = verify(source, replica, "k", "v")
    assert [tuple(r) for r in found["row"].collect()] == [(1, 1, 7, False)]
    assert {r.status: r.n_keys for r in found["summary"].collect()} == {"equal": 1, "different": 1}
    assert [tuple(r) for r in verify(source, replica, "k", "v", key=2)["row"].collect()] == [
        (2, 2, 2, True)]


def test_cascade_in_log_form(spark):
    """Deletes of the parents and of their children, written to both logs."""
    lines = TableSpec("lines", "id", row_schema("id integer, parent integer"))
    parents = items(spark, [(1, 1), (2, 2)])
    children = spark.createDataFrame([(10, 1), (11, 1), (12, 2)], "id INT, parent INT")
    doomed = parents.filter("k = 1").select("k")
    kept, left = cascade_delete(parents, children, doomed, "k", "parent")
    gone = children.join(doomed, F.col("parent") == F.col("k"), "left_semi")
    parent_log = bootstrap(parents, ITEMS, 0).unionByName(
        to_changes(parents.join(doomed, "k"), ITEMS, "d", 1))
    child_log = bootstrap(children, lines, 0).unionByName(to_changes(gone, lines, "d", 1))
    assert state(current(parent_log, ITEMS)) == state(kept)
    assert current(child_log, lines).collect() == left.collect()


def test_rows_without_a_key_all_stay(spark):
    target = spark.createDataFrame([(1, 1)], "k INT, v INT")
    source = spark.createDataFrame([(None, 2), (None, 3), (1, 4)], "k INT, v INT")
    for merge, kept in ((merge_upsert, 4), (insert_if_absent, 1)):
        for order in (None, ["v"]):
            found = sorted(tuple(r) for r in merge(target, source, "k", order).fillna(-1).collect())
            assert found == [(-1, 2), (-1, 3), (1, kept)]


def test_reconcile_of_null_keys_and_copies(spark):
    one = spark.createDataFrame([(1, 5)], "k INT, v INT")
    other = spark.createDataFrame([(1, 5), (None, 9)], "k INT, v INT")
    for unique in (True, False):
        assert sorted((r["k"] or 0, r["status"]) for r in reconcile(one, other, "k", unique).collect()) == [
            (0, "extra"), (1, "equal")]
        assert (None, "missing") in [tuple(r) for r in reconcile(other, one, "k", unique).collect()]
    copies = spark.createDataFrame([(1, 5), (1, 3)], "k INT, v INT")
    assert not verify_key(one, copies, "k", 1, "v").first()["in_sync"]
    assert verify_key(one, one, "k", 1, "v").first()["in_sync"]
