"""Batches of several logs that become visible together, and row counts kept with bases."""

import pytest
from pyspark.sql import functions as F

from changetide.operators import version_row_counts
from changetide.sources import bootstrap, entries, to_changes
from changetide.spec import TableSpec, row_schema
from changetide.streaming import (
    ChangeLog, cascade_delete_logged, commit_together, make_batch_writer, start, together, write_snapshot,
)
from changetide.sources import text_messages

from helpers import ITEMS, messages_of, payload, state
from test_commits import logged, random_batches, rows_of

PARTS = TableSpec("parts", "id", row_schema("id integer, k integer"))


@pytest.fixture
def logs(spark, tmp_path):
    parent, child = (ChangeLog(spark, spec, f"{tmp_path}/{spec.name}") for spec in (ITEMS, PARTS))
    write_snapshot(bootstrap(spark.createDataFrame([(1, 10), (2, 20), (3, 30)], "k INT, v INT"), ITEMS), ITEMS, parent.root)
    write_snapshot(bootstrap(spark.createDataFrame([(i, i % 4) for i in range(12)], "id INT, k INT"), PARTS), PARTS, child.root)
    return parent, child


def both(logs):
    return {tuple(r) for r in logs[0].current().collect()}, {tuple(r) for r in logs[1].current().collect()}


def keys(spark, *found):
    return spark.createDataFrame([(k,) for k in found], "k INT")


WHOLE = {(1, 10), (2, 20), (3, 30)}, {(i, i % 4) for i in range(12)}
CUT = {(1, 10), (3, 30)}, {(i, i % 4) for i in range(12) if i % 4 != 2}


def test_parents_and_children_go_together(spark, logs):
    before = both(logs)
    assert before == WHOLE
    assert cascade_delete_logged(*logs, keys(spark, 2, 2, 77), "k", ts_ms=5) == [0, 0]
    assert both(logs) == CUT
    assert [r.n_deletes for log in logs for r in log.history(last=1).collect()] == [1, 3]
    assert [log.as_of(version=0).count() for log in logs] == [3, 12]
    # Again: nothing left to delete, so nothing is committed.
    cascade_delete_logged(*logs, keys(spark, 2), "k", ts_ms=6)
    assert both(logs) == CUT and [len(log.batches()) for log in logs] == [2, 2]
    assert cascade_delete_logged(*logs, keys(spark, 1), "k", ts_ms=7) == [1, 1]
    assert [log.current().count() for log in logs] == [1, 6]


class Crash(Exception):
    pass


@pytest.mark.parametrize("step", ["second data", "marker", "first own commit", "second own commit", "removal"])
def test_a_crash_shows_all_or_nothing(spark, logs, monkeypatch, step):
    calls = {"commit": 0, "write": 0}
    commit, write_text, remove = together.commit, together.write_text, together.remove

    def failing_commit(*args):
        calls["commit"] += 1
        if step == "second data" and calls["commit"] == 2:
            raise Crash
        return commit(*args)

    def failing_write(spark, path, text):
        calls["write"] += 1     # the shared marker, then each table's own commit
        if {"marker": 1, "first own commit": 2, "second own commit": 3}.get(step) == calls["write"]:
            raise Crash
        write_text(spark, path, text)

    def failing_remove(spark, path):
        if step == "removal" and "/together/" in path:
            raise Crash
        remove(spark, path)

    with monkeypatch.context() as m:
        m.setattr(together, "commit", failing_commit)
        m.setattr(together, "write_text", failing_write)
        m.setattr(together, "remove", failing_remove)
        with pytest.raises(Crash):
            cascade_delete_logged(*logs, keys(spark, 2), "k", ts_ms=5)
    done = step not in ("second data", "marker")
    assert both(logs) == (CUT if done else WHOLE)
    assert [len(log.batches()) for log in logs] == ([2, 2] if done else [1, 1])
    assert all(log.history().count() == len(log.batches()) for log in logs)
    # The next call completes or replaces what was left.
    cascade_delete_logged(*logs, keys(spark, 2, 3), "k", ts_ms=6)
    assert both(logs) == ({(1, 10)}, {(i, i % 4) for i in range(12) if i % 4 < 2})
    folder = logs[0].root.rsplit("/", 1)[0]
    assert entries(spark, f"{folder}/together") == []


def test_logs_that_cannot_be_committed_together(spark, logs, tmp_path):
    other = ChangeLog(spark, ITEMS, f"{tmp_path}/far/items")
    changes = to_changes(spark.createDataFrame([(9, 9)], "k INT, v INT"), ITEMS, "c", 1)
    for parts in ([(logs[0], changes), (other, changes)], [(logs[0], changes), (logs[0], changes)]):
        with pytest.raises(ValueError, match="one folder"):
            commit_together(parts)
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_text(payload(5, 5) + "\n")
    streamed = ChangeLog(spark, ITEMS, f"{tmp_path}/streamed")
    start(ITEMS, text_messages(spark, str(tmp_path / "in"), "t"), streamed.root, trigger={"availableNow": True}).awaitTermination()
    with pytest.raises(ValueError, match="stream numbers"):
        commit_together([(streamed, changes)])
    # A log that only bulk commits fill is no log for a stream with a new checkpoint.
    commit_together([(logs[0], changes)])
    with pytest.raises(ValueError, match="no checkpoint"):
        start(ITEMS, text_messages(spark, str(tmp_path / "in"), "t"), logs[0].root, trigger={"availableNow": True})


@pytest.mark.parametrize("mode", ["ordered", "delete_wins"])
@pytest.mark.parametrize("seed", [1, 2])
def test_kept_counts_equal_a_full_pass(spark, tmp_path, mode, seed):
    log = logged(spark, tmp_path, random_batches(seed, 11, keys=15))
    want = rows_of(version_row_counts(log.read(), ITEMS, mode))
    assert rows_of(log.version_row_counts(mode)) == want
    for version in (0, 3, 7):
        log.compact(version, mode, buckets=3)
        assert rows_of(log.version_row_counts(mode)) == want
    assert rows_of(log.version_row_counts(mode, first=5)) == [r if r[0] else r for r in want if r[0] < 5]
    opened = {f for f in log.version_row_counts(mode).inputFiles() if "batch_id=" in f}
    late = {f"batch_id={b}/" for b in log.batches()[8:]}
    assert opened and all(any(b in f for b in late) for f in opened)
    log.compact(mode=mode)
    assert rows_of(log.version_row_counts(mode)) == want
    assert not [f for f in log.version_row_counts(mode).inputFiles() if "batch_id=" in f or "runs" in f]


def test_counts_read_only_keys_that_were_touched(spark, tmp_path):
    write, log = make_batch_writer(ITEMS, str(tmp_path)), ChangeLog(spark, ITEMS, str(tmp_path))
    write(messages_of(spark, [payload(k, k, ts=1) for k in range(200)]), 0)
    log.compact()
    write(messages_of(spark, [payload(7, op="d", ts=2), payload(500, 1, ts=2), payload(8, 1, ts=0)]).withColumn(
        "offset", F.col("offset") + 1000), 1)
    assert rows_of(log.version_row_counts()) == [(0, 0, 200, None), (1, 1, 200, 0)]
    assert "LeftSemi" in log.version_row_counts()._jdf.queryExecution().executedPlan().toString()


def test_made_up_positions_have_no_limit_of_their_own(spark, tmp_path):
    write, log = make_batch_writer(ITEMS, str(tmp_path)), ChangeLog(spark, ITEMS, str(tmp_path))
    unplaced = [F.lit(None).cast("long").alias("offset"), F.lit(None).cast("int").alias("partition")]
    for batch in (2 ** 22, 2 ** 31 - 2):   # beyond what a few bits of an offset can tell
        messages = messages_of(spark, [payload(1, batch % 1000, ts=1)]).select("value", "ts", "topic", *unplaced)
        write(messages, batch)
    assert state(log.current()) == {1: (2 ** 31 - 2) % 1000}
    placed = messages_of(spark, [payload(2, 5, ts=1)]).withColumns({"partition": F.lit(3), "offset": F.lit(8).cast("long")})
    write(placed, 2 ** 31 - 1)
    assert log.read().filter("k = 2").select("__partition", "__offset").first()[:] == (3, 8)
