"""State, versions and counts against a replay in plain Python."""

import datetime

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from changetide.functions.changes import DELETE_WINS, ORDERED
from changetide.operators import (
    as_of, batch_metrics, current, history, last_changes, last_operations, lookup, published,
    versions,
    version_row_counts,
)

from changetide.spec import TableSpec, row_schema

from helpers import ITEMS, log_from, log_of, payload, state

FEW = settings(max_examples=12, deadline=None,
               suppress_health_check=[HealthCheck.function_scoped_fixture])

# Changes of a few keys; the place in the list is the offset, times may tie.
CHANGES = st.lists(
    st.tuples(st.integers(1, 6), st.one_of(st.none(), st.integers(0, 99)), st.integers(0, 9),
              st.integers(0, 4)),
    min_size=1, max_size=60)


def numbered(changes):
    return [(k, v, ts, offset, batch) for offset, (k, v, ts, batch) in enumerate(changes)]


def replay(events, mode=ORDERED):
    """Live rows by the definition of the mode, one key at a time."""
    by_key = {}
    for event in events:
        by_key.setdefault(event[0], []).append(event)
    live = {}
    for key, own in by_key.items():
        if mode == DELETE_WINS:
            last = max(batch for *_, batch in own)
            own = [e for e in own if e[4] == last]
            if any(e[1] is None for e in own):
                continue
        winner = max(own, key=lambda e: (e[2], e[3]))
        if winner[1] is not None:
            live[key] = winner[1]
    return live


@FEW
@given(CHANGES)
def test_current_equals_a_replay(spark, changes):
    events = numbered(changes)
    log = log_of(spark, events)
    for mode in (ORDERED, DELETE_WINS):
        assert state(current(log, ITEMS, mode)) == replay(events, mode)


@FEW
@given(CHANGES, st.randoms(use_true_random=False))
def test_ordered_state_ignores_how_changes_are_batched(spark, changes, random):
    events = numbered(changes)
    shuffled = [(*e[:4], random.randrange(5)) for e in events]
    random.shuffle(shuffled)
    assert state(current(log_of(spark, shuffled), ITEMS)) == replay(events)


@FEW
@given(CHANGES)
def test_counts_equal_the_state_of_every_version(spark, changes):
    events = numbered(changes)
    log = log_of(spark, events)
    batches = sorted({e[4] for e in events})
    for mode in (ORDERED, DELETE_WINS):
        rows = version_row_counts(log, ITEMS, mode).orderBy("version").collect()
        expected = [len(replay([e for e in events if e[4] <= b], mode)) for b in batches]
        assert [(r.version, r.batch_id, r.n_rows) for r in rows] == [
            (i, b, n) for i, (b, n) in enumerate(zip(batches, expected))]
        assert [r.change for r in rows] == [None, *(b - a for a, b in zip(expected, expected[1:]))]


@FEW
@given(CHANGES, st.integers(0, 4), st.integers(0, 9))
def test_as_of(spark, changes, version, ts):
    events = numbered(changes)
    log = log_of(spark, events)
    batches = sorted({e[4] for e in events})
    if version < len(batches):
        wanted = [e for e in events if e[4] <= batches[version]]
        assert state(as_of(log, ITEMS, version=version)) == replay(wanted)
    elif events:
        with pytest.raises(Exception, match="no version"):
            as_of(log, ITEMS, version=version).collect()
    assert state(as_of(log, ITEMS, ts_ms=ts)) == replay([e for e in events if e[2] <= ts])


@FEW
@given(CHANGES, st.integers(0, 4))
def test_a_compacted_prefix_stands_in_for_its_log(spark, changes, upto):
    events = numbered(changes)
    log = log_of(spark, events)
    for mode in (ORDERED, DELETE_WINS):
        base = last_changes(log.filter(f"batch_id <= {upto}"), ITEMS, mode)
        together = base.unionByName(log.filter(f"batch_id > {upto}"))
        assert state(current(together, ITEMS, mode)) == replay(events, mode)


def test_sequences_of_one_key(spark):
    cases = {
        "c,u,u": ([(1, 1, 1, 1, 0), (1, 2, 2, 2, 0), (1, 3, 3, 3, 0)], {1: 3}, {1: 3}),
        "c,d": ([(1, 1, 1, 1, 0), (1, None, 2, 2, 0)], {}, {}),
        "c,d,c": ([(1, 1, 1, 1, 0), (1, None, 2, 2, 0), (1, 5, 3, 3, 0)], {1: 5}, {}),
        "c,d,c over batches": (
            [(1, 1, 1, 1, 0), (1, None, 2, 2, 1), (1, 5, 3, 3, 2)], {1: 5}, {1: 5}),
        "d first": ([(1, None, 1, 1, 0), (1, 4, 2, 2, 1)], {1: 4}, {1: 4}),
        "same time": ([(1, 1, 7, 1, 0), (1, 2, 7, 2, 0)], {1: 2}, {1: 2}),
        "late": ([(1, 1, 9, 5, 0), (1, 2, 3, 4, 1)], {1: 1}, {1: 2}),
        "twice": ([(1, 1, 1, 1, 0), (1, 1, 1, 1, 0)], {1: 1}, {1: 1}),
    }
    for name, (events, ordered, delete_wins) in cases.items():
        log = log_of(spark, events)
        assert state(current(log, ITEMS)) == ordered, name
        assert state(current(log, ITEMS, DELETE_WINS)) == delete_wins, name


def test_a_late_change_cannot_revive_a_compacted_delete(spark):
    events = [(1, 7, 100, 1, 0), (1, None, 300, 3, 0), (1, 8, 200, 2, 1), (2, 9, 50, 4, 0)]
    log = log_of(spark, events)
    base = last_changes(log.filter("batch_id = 0"), ITEMS)
    assert base.count() == 2
    together = base.unionByName(log.filter("batch_id = 1"))
    assert state(current(log, ITEMS)) == state(current(together, ITEMS)) == {2: 9}


def test_a_key_without_a_time_loses_to_any_other_and_stays_alone(spark):
    log = log_of(spark, [(1, 1, None, None, 0), (1, 2, 5, 1, 0), (2, 3, None, None, 0)])
    assert state(current(log, ITEMS)) == {1: 2, 2: 3}


def test_lookup(spark):
    log = log_of(spark, [(1, 1, 1, 1, 0), (2, 5, 1, 2, 0), (2, None, 2, 3, 1)])
    assert state(lookup(log, ITEMS, 1)) == {1: 1}
    assert state(lookup(log, ITEMS, 2)) == {}


def test_columns_are_chosen(spark):
    log = log_of(spark, [(1, 1, 1, 1, 0)])
    assert current(log, ITEMS).columns == ["k", "v"]
    assert current(log, ITEMS, columns=[]).columns == ["k"]
    assert current(log, ITEMS, columns=["v"]).columns == ["k", "v"]


def test_versions_skip_batches_without_changes(spark):
    log = log_of(spark, [(1, 1, 1, 1, 3), (1, 2, 2, 2, 8)])
    assert [(r.version, r.batch_id) for r in versions(log).orderBy("version").collect()] == [
        (0, 3), (1, 8)]
    rows = history(log, ITEMS).orderBy("version").collect()
    assert [(r.operation, r.n_upserts, r.n_deletes) for r in rows] == [
        ("WRITE", 1, 0), ("MERGE", 1, 0)]
    assert [r.version for r in last_operations(history(log, ITEMS), 1).collect()] == [1]


def test_batch_metrics_count_every_message(spark):
    from changetide.operators import classify, decode
    from helpers import messages_of
    from pyspark.sql import functions as F

    values = [payload(1, 1), payload(2, 2, op="d"), "{bad", payload(3, "much")]
    frame = messages_of(spark, values).withColumn("batch_id", F.lit(0).cast("long"))
    row, = batch_metrics(classify(decode(frame, ITEMS), ITEMS)).collect()
    assert (row.n_total, row.n_upserts, row.n_deletes, row.n_rejects, row.n_partially_decoded) == (
        4, 2, 1, 1, 1)


def test_published_times(spark):
    spec = TableSpec("t", "k", row_schema("k integer, at string"), times=("at",))
    rows = spark.createDataFrame(
        [(1, "2024-01-02T03:04:05Z"), (2, "2024-01-02 03:04:05"), (3, "soon"), (4, None)],
        "k INT, at STRING")
    times = {r.k: r["at"] for r in published(rows, spec).collect()}
    assert times[1] == times[2] == datetime.datetime(2024, 1, 2, 3, 4, 5)
    assert times[3] is None and times[4] is None


def test_empty_log(spark):
    log = log_of(spark, [])
    assert current(log, ITEMS).count() == 0
    assert version_row_counts(log, ITEMS).count() == 0
    assert as_of(log, ITEMS, version=0).count() == 0
    assert log_from(spark, []).count() == 0
