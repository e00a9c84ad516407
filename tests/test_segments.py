"""The stream of numbered message files: offsets, resuming, lost files; and cuts over several logs."""

import json
import os

import pytest
from pyspark.sql import functions as F

from changetide.plans.reports import at_cut
from changetide.sources import segment_messages, write_segments
from changetide.sources.segments import SegmentReader, listed
from changetide.streaming import ChangeLog, consistent_cut, make_batch_writer, start

from helpers import ITEMS, messages_of, payload, state

ALL_NOW = {"availableNow": True}


def numbered(spark, first, n, partition=0, ts=0):
    """Messages ``first`` to ``first + n - 1`` of a partition; message i sets key i % 7."""
    rows = [(payload(i % 7 + 10 * partition, i, ts=ts), None, "t", partition, i) for i in range(first, first + n)]
    return spark.createDataFrame(rows, messages_of(spark, []).schema)


def run(spark, folder, root, **options):
    query = start(ITEMS, segment_messages(spark, str(folder), **options), str(root), trigger=ALL_NOW)
    query.awaitTermination()
    return ChangeLog(spark, ITEMS, str(root))


def test_files_hold_ranges_without_gaps(spark, tmp_path):
    both = numbered(spark, 0, 250).union(numbered(spark, 40, 30, partition=3)).repartition(6)
    write_segments(both, str(tmp_path), rows=100)
    found = listed(str(tmp_path))
    assert set(found) == {"0", "3"}
    for partition, first, last in (("0", 0, 249), ("3", 40, 69)):
        segments = found[partition]
        assert (segments[0].first, segments[-1].last) == (first, last)
        assert all(a.last + 1 == b.first for a, b in zip(segments, segments[1:]))
    assert all(s.last - s.first < 100 for s in found["0"]) and len(found["0"]) >= 3
    assert not [f for _, _, names in os.walk(tmp_path) for f in names if f.startswith(".") and not f.endswith(".crc")]


def test_a_stream_resumes_at_its_offsets(spark, tmp_path):
    folder, root = tmp_path / "in", tmp_path / "log"
    write_segments(numbered(spark, 0, 30), str(folder), rows=10)
    log = run(spark, folder, root)
    assert state(log.current()) == {i % 7: i for i in range(23, 30)}
    assert log.read().select("__partition", "__offset").distinct().count() == 30
    run(spark, folder, root)
    assert len(log.batches()) == 1, "nothing new"
    write_segments(numbered(spark, 30, 5).union(numbered(spark, 0, 9, partition=1)), str(folder), rows=10)
    run(spark, folder, root)
    assert log.read().count() == 44 and len(log.batches()) == 2
    assert {r[0] for r in log.read().filter("__partition = 0").select("__offset").collect()} == set(range(35))
    assert log.read().select("__partition", "__offset").distinct().count() == 44


def test_starting_offsets(spark, tmp_path):
    folder = tmp_path / "in"
    write_segments(numbered(spark, 0, 30).union(numbered(spark, 0, 8, partition=1)), str(folder), rows=10)
    log = run(spark, folder, tmp_path / "given", startingOffsets=json.dumps({"0": 25, "1": 8}))
    assert {tuple(r) for r in log.read().select("__partition", "__offset").collect()} == {(0, i) for i in range(25, 30)}
    latest = run(spark, folder, tmp_path / "latest", startingOffsets="latest")
    assert latest.batches() == []


def drop(folder, partition, first):
    """Delete the file that begins with an offset."""
    segment = next(s for s in listed(str(folder))[str(partition)] if s.first == first)
    os.remove(segment.path)


def test_lost_offsets_are_an_error_or_skipped(spark, tmp_path):
    folder, root = tmp_path / "in", tmp_path / "log"
    write_segments(numbered(spark, 0, 5), str(folder))
    run(spark, folder, root)
    write_segments(numbered(spark, 5, 30).coalesce(1), str(folder), rows=10)
    starts = [s.first for s in listed(str(folder))["0"]]
    gone = starts[2]
    lost = next(set(range(s.first, s.last + 1)) for s in listed(str(folder))["0"] if s.first == gone)
    drop(folder, 0, gone)
    with pytest.raises(Exception, match="are gone"):
        run(spark, folder, root)
    log = run(spark, folder, root, failOnDataLoss=False)
    assert {r[0] for r in log.read().select("__offset").collect()} == set(range(35)) - lost
    # What is deleted before it was ever read by a new stream is not missed.
    assert run(spark, folder, tmp_path / "new", startingOffsets=json.dumps({"0": max(lost) + 1})).read().count() == 34 - max(lost)


def test_a_partition_without_files_keeps_its_place(tmp_path, spark):
    folder = tmp_path / "in"
    write_segments(numbered(spark, 0, 5).union(numbered(spark, 0, 4, partition=1)), str(folder))
    reader = SegmentReader({"path": str(folder)})
    end = reader.latestOffset()
    assert end == {"0": 5, "1": 4} and reader.initialOffset() == {"0": 0, "1": 0}
    reader.partitions(reader.initialOffset(), end)
    drop(folder, 1, 0)
    assert reader.latestOffset() == end
    write_segments(numbered(spark, 6, 2, partition=1), str(folder))
    assert reader.latestOffset() == {"0": 5, "1": 8}
    with pytest.raises(Exception, match="2 messages of partition 1"):
        reader.partitions(end, reader.latestOffset())
    lenient = SegmentReader({"path": str(folder), "failondataloss": "false"})
    assert [(r.partition, r.start, r.end) for r in lenient.partitions(end, {"0": 5, "1": 8})] == [("1", 4, 8)]


def test_small_files_share_a_task(spark, tmp_path, monkeypatch):
    """200 files of five messages: four tasks, not 200, and every message of the range once."""
    folder = tmp_path / "in"
    write_segments(numbered(spark, 0, 1000).coalesce(1), str(folder), rows=5)
    assert len(listed(str(folder))["0"]) >= 200
    monkeypatch.setattr("changetide.sources.segments.TASK_ROWS", 250)
    reader = SegmentReader({"path": str(folder)})
    ranges = reader.partitions({"0": 0}, reader.latestOffset())
    assert 4 <= len(ranges) <= 6
    found = [i for r in reader.partitions({"0": 3}, {"0": 998}) for b in reader.read(r) for i in b.column("offset").to_pylist()]
    assert found == list(range(3, 998))
    monkeypatch.setattr("changetide.sources.segments.TASK_ROWS", 2)
    assert len(reader.partitions({"0": 0}, {"0": 1000})) == len(listed(str(folder))["0"]), "a larger file has its own"
    assert run(spark, folder, tmp_path / "log").read().select("__offset").distinct().count() == 1000


def test_tables_are_cut_at_a_time_that_all_have_passed(spark, tmp_path):
    logs = {name: ChangeLog(spark, ITEMS, f"{tmp_path}/{name}") for name in ("a", "b")}
    write = {name: make_batch_writer(ITEMS, log.root) for name, log in logs.items()}
    write["a"](messages_of(spark, [payload(1, 1, ts=5), payload(2, 2, ts=30)]), 0)
    assert consistent_cut(list(logs.values())) is None and at_cut(logs).count() == 0
    write["b"](messages_of(spark, [payload(1, 1, ts=4), payload(2, op="d", ts=9)]), 0)
    assert consistent_cut(list(logs.values())) == 9
    assert {tuple(r) for r in at_cut(logs).collect()} == {("a", 1, 9), ("b", 1, 9)}
    write["b"](messages_of(spark, [payload(3, 3, ts=31)]), 1)
    assert {tuple(r) for r in at_cut(logs).collect()} == {("a", 2, 30), ("b", 1, 30)}
    assert logs["a"].as_of(ts_ms=30).agg(F.count("*")).first()[0] == 2
