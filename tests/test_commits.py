"""Summaries, folds and zone maps of commits, and bases in runs."""

import random
import re

import pytest
from pyspark.sql import functions as F

from changetide.operators import as_of, batch_metrics, current, history
from changetide.plans import replays
from changetide.plans.reports import latest_batches
from changetide.sources import bootstrap, paths
from changetide.spec import KIND, TableSpec, row_schema
from changetide.streaming import ChangeLog, base, make_batch_writer, write_snapshot, writer
from changetide.streaming.commits import CHANGES, Fold, measures

from helpers import ITEMS, messages_of, payload, state

SF_DIR = "/root/testdata/sf0.001"


def rows_of(frame):
    return sorted((tuple(r) for r in frame.collect()), key=repr)


def random_batches(seed, batches, keys=12, rows=9):
    """Payloads of batches with late, repeated and deleted keys, and some that can't be applied."""
    draw = random.Random(seed)
    return [[draw.choice(["{bad", "null"]) if draw.random() < 0.1
             else payload(draw.randrange(keys), draw.randrange(100), draw.choice("cuud"), draw.randrange(batches * 10))
             for _ in range(draw.randrange(1, rows))] for _ in range(batches)]


def logged(spark, root, batches):
    """Batches committed one by one; offsets go on from batch to batch."""
    write, log = make_batch_writer(ITEMS, str(root)), ChangeLog(spark, ITEMS, str(root))
    for number, values in enumerate(batches):
        write(messages_of(spark, values).withColumn("offset", F.col("offset") + 1000 * number), number)
    return log


def batches_in(frame):
    return {int(found.group(1)) for f in frame.inputFiles() if (found := re.search(r"batch_id=(-?\d+)", f))}


# -- summaries and folds ------------------------------------------------------------


@pytest.fixture(scope="module")
def folded(spark, tmp_path_factory):
    """Thirty batches with a snapshot before them, folded three at a time."""
    root = tmp_path_factory.mktemp("folded")
    write_snapshot(bootstrap(spark.createDataFrame([(1, 1), (50, 2)], "k INT, v INT"), ITEMS), ITEMS, str(root))
    before, writer.FOLD = writer.FOLD, 3
    log = logged(spark, root, random_batches(5, 30))
    writer.FOLD = before
    return log


def test_few_names_are_listed_however_many_batches(spark, folded):
    names = [paths.entries(spark, f"{folded.root}/{folder}") for folder in ("commits", "folded")]
    assert len(names[0]) <= 8 and len(names[1]) <= 8
    assert max(Fold.named(name).level for name in names[1]) >= 2
    found = folded.committed()
    assert found == sorted(set(found)) and len(found) == 31 and found[0] == -1


def test_summaries_say_what_the_rows_say(spark, folded):
    log = folded
    assert rows_of(log.history()) == rows_of(history(log.read(), ITEMS))
    both = log.read().unionByName(log._stored(log.committed("rejects"), "rejects"))
    assert rows_of(log.batch_metrics()) == rows_of(batch_metrics(both))
    assert batches_in(log.history()) == batches_in(log.batch_metrics()) == batches_in(log.detail()) == set()
    detail = log.detail().first()
    assert (detail.n_files, detail.size_bytes) == (log.files().count(), log.files().groupBy().sum("bytes").first()[0])
    assert detail.n_versions == len(log.batches()) == log.history().count()
    last = log.history(last=4).orderBy("version").collect()
    assert [r.version for r in last] == list(range(detail.n_versions - 4, detail.n_versions))
    assert rows_of(log.history(last=1000)) == rows_of(log.history())
    assert len([f for f in log.history(last=1).inputFiles() if "/summaries/" in f]) <= 1


def test_durations_of_all_batches_outlive_the_session_that_wrote_them(folded):
    timings = ChangeLog(folded.spark, ITEMS, folded.root).batch_timings().collect()
    assert len(timings) == 31
    assert all(r.duration_ms >= 0 and r.committed_at is not None and r.n_total > 0 for r in timings)
    assert sorted(r.batch_id for r in folded.batch_timings(last=3).collect()) == [27, 28, 29]
    shown = latest_batches({"a": folded, "b": folded}, last=2).collect()
    assert sorted((r.table_name, r.batch_id) for r in shown) == [("a", 28), ("a", 29), ("b", 28), ("b", 29)]


def test_folded_batches_stay_as_they_are(spark, folded):
    before = rows_of(folded.read())
    write = make_batch_writer(ITEMS, folded.root)
    for number in (0, 7, 29):
        write(messages_of(spark, [payload(99, 99)]), number)
    assert rows_of(folded.read()) == before
    with pytest.raises(ValueError, match="folded"):
        folded.commits.withdraw(3)
    write_snapshot(bootstrap(spark.createDataFrame([(1, 1), (50, 2)], "k INT, v INT"), ITEMS), ITEMS, folded.root)
    assert state(folded.current()) == state(current(folded.read(), ITEMS)) and folded.committed()[0] == -1


def test_a_fold_that_was_cut_short_changes_nothing(spark, tmp_path):
    log = logged(spark, tmp_path, random_batches(8, 7))
    whole, state_before = rows_of(log.commits.summaries()), rows_of(log.read())
    log.commits._store(log.commits.summaries(), Fold(0, 6, 0), 7)   # singles and fold both stand
    assert rows_of(log.commits.summaries()) == whole and log.committed() == list(range(7))
    paths.remove(spark, f"{tmp_path}/folded/0+0+6")                 # the fold without its marker
    assert rows_of(log.commits.summaries()) == whole
    for _ in range(3):
        log.commits.fold(2)
        assert rows_of(log.commits.summaries()) == whole and rows_of(log.read()) == state_before
    assert paths.entries(spark, f"{tmp_path}/commits") == []


def test_a_summary_is_the_same_from_stored_rows(spark, tmp_path):
    log = logged(spark, tmp_path, random_batches(2, 3))
    seen = rows_of(log.commits.summaries().drop("duration_ms"))
    for batch in log.committed():
        log.commits.withdraw(batch)
    assert log.committed() == [] and log.history().count() == 0
    for batch in range(3):
        log.commits.publish(batch)
    assert rows_of(log.commits.summaries().drop("duration_ms")) == seen


# -- zone maps ----------------------------------------------------------------------


def test_only_batches_that_may_hold_a_key_or_a_time_are_opened(spark, tmp_path):
    batches = [[payload(k, b, ts=100 * b + k) for k in range(b % 4, 400, 4)] for b in range(8)]
    log = logged(spark, tmp_path, batches)
    for key in (0, 5, 102, 399):
        opened = batches_in(log.lookup(key))
        assert {key % 4, key % 4 + 4} == opened
        assert state(log.lookup(key)) == {key: key % 4 + 4}
    assert batches_in(log.lookup(4000)) == set() and log.lookup(4000).count() == 0
    assert batches_in(log.as_of(ts_ms=250)) == {0, 1, 2}
    assert state(log.as_of(ts_ms=250)) == state(as_of(log.read(), ITEMS, ts_ms=250))
    log.compact(version=3)
    assert batches_in(log.lookup(5)) == {5}
    assert len([f for f in log.lookup(5).inputFiles() if "bucket=" in f]) == 1


@pytest.mark.parametrize("mode", ["ordered", "delete_wins"])
def test_times_and_keys_with_and_without_bases(spark, tmp_path, mode):
    log = logged(spark, tmp_path, random_batches(21, 9))
    plain = log.read().cache()
    last = len(log.batches()) - 1

    def check():
        for ts in (0, 25, 90):
            assert state(log.as_of(ts_ms=ts, mode=mode)) == state(as_of(plain, ITEMS, ts_ms=ts, mode=mode)), ts
        for version in (3, last):
            assert state(log.as_of(version=version, mode=mode)) == state(as_of(plain, ITEMS, version=version, mode=mode))
        whole = state(current(plain, ITEMS, mode))
        for key in (0, 5, 12):
            assert state(log.lookup(key, mode)) == ({key: whole[key]} if key in whole else {})

    check()
    for version in (1, 4, last - 1):
        log.compact(version, mode, buckets=4)
    check()


def test_changes_without_time_are_no_part_of_a_time(spark, tmp_path):
    untimed = payload(1, 7).replace('"__source_ts_ms": 0', '"__source_ts_ms": null')
    log = logged(spark, tmp_path, [[untimed, payload(2, 2, ts=1)], [payload(3, 3, ts=2)]])
    assert log.commits.summaries().agg(F.sum("n_untimed")).first()[0] == 1
    log.compact(version=0)
    assert state(log.as_of(ts_ms=5)) == {2: 2, 3: 3}


def test_keys_of_text_are_found(spark, tmp_path):
    spec = TableSpec("words", "w", row_schema("w string, v integer"))
    write, log = make_batch_writer(spec, str(tmp_path)), ChangeLog(spark, spec, str(tmp_path))
    for number, words in enumerate([["apple", "pear"], ["zebra", "é\"\n"], ["apple", "fig"]]):
        write(messages_of(spark, [f'{{"w": {spark_json(w)}, "v": {number}, "__op": "c", "__source_ts_ms": {number}}}' for w in words]), number)
    assert batches_in(log.lookup("zebra")) == {1} and batches_in(log.lookup("apple")) == {0, 2}
    assert log.lookup('é"\n').first().v == 1 and log.lookup("apple").first().v == 2
    log.compact(version=1)
    assert log.lookup("zebra").first().v == 1 and log.lookup("none").count() == 0


def spark_json(text):
    import json
    return json.dumps(text)


# -- bases --------------------------------------------------------------------------


def test_only_touched_buckets_are_written_again(spark, tmp_path):
    n, buckets = 20_000, 100
    write, log = make_batch_writer(ITEMS, str(tmp_path)), ChangeLog(spark, ITEMS, str(tmp_path))
    def text(value):
        return F.format_string('{"k": %d, "v": %d, "__op": "u", "__source_ts_ms": %d}', F.col("id"), F.lit(value), F.lit(value))

    def batch(keys, number):
        write(keys.select(text(number).alias("value"), F.lit(None).cast("timestamp").alias("ts"), F.lit("t").alias("topic"),
                          F.lit(0).alias("partition"), (F.col("id") + n * number).alias("offset")), number)

    keys = spark.range(n)
    batch(keys, 0)
    log.compact(buckets=buckets)
    bases = log.stored_bases()
    hashed = bases.bucket(buckets, F.col("id").cast("int"))
    batch(keys.filter(hashed == 17), 1)      # about 1 % of the keys, of one bucket
    batch(keys.filter(F.col("id") % 100 == 3), 2)   # 1 % of the keys, of all buckets
    for version, touched, share in ((1, {17}, 0.02), (2, set(range(buckets)), 0.02)):
        log.compact(version=version)
        files = paths.data_files(spark, [f"{tmp_path}/base/mode=ordered/runs/upto={version}"]).select("path").collect()
        assert {int(re.search(r"bucket=(\d+)", f.path).group(1)) for f in files} <= touched
        rows = spark.read.parquet(f"{tmp_path}/base/mode=ordered/runs/upto={version}").count()
        assert 0 < rows <= share * n
        runs = bases.manifest(version).runs
        assert sum(each[0][1] for each in runs.values()) == n and base.falling(runs)
    assert {b for b, each in bases.manifest(1).runs.items() if each[-1][0] == 1} == {17}
    assert state(log.current()) == {k: v for k, v in rows_of(current(log.read(), ITEMS))}
    assert log.current().count() == n and log.stored_bases().runs(2).count() > buckets


@pytest.mark.parametrize("mode", ["ordered", "delete_wins"])
def test_many_compactions_keep_state_and_few_runs(spark, tmp_path, mode):
    log = logged(spark, tmp_path, random_batches(3, 10, keys=40, rows=14))
    last = len(log.batches()) - 1
    for version in range(0, last, 2):
        log.compact(version, mode, buckets=3)
        runs = log.stored_bases(mode).manifest(log.bases(mode)[-1]).runs
        assert base.falling(runs) and all(len(each) <= 6 for each in runs.values())
    plain = log.read().cache()
    want = {v: state(as_of(plain, ITEMS, version=v, mode=mode)) for v in (2, 5, last)}
    assert {v: state(log.as_of(version=v, mode=mode)) for v in want} == want
    log.stored_bases(mode).forget(keep=1)
    assert len(log.bases(mode)) == 1
    assert {v: state(log.as_of(version=v, mode=mode)) for v in want} == want


def test_a_compaction_that_was_cut_short_is_no_base(spark, tmp_path):
    log = logged(spark, tmp_path, random_batches(6, 4))
    log.compact(version=1)
    want = state(log.current())
    log.compact(version=3)
    paths.remove(spark, f"{tmp_path}/base/mode=ordered/manifests/{log.batch_of(3)}")
    assert log.bases() == [log.batch_of(1)] and state(log.current()) == want
    log.compact(version=3)
    assert state(log.current()) == want


def test_measures_need_no_second_job(spark, tmp_path):
    """What the write has seen is the summary: no column of the rows is read again."""
    log = logged(spark, tmp_path, [[payload(1, 1, ts=5), payload(2, op="d", ts=9), "{bad"]])
    row = log.commits.summaries(CHANGES).first()
    assert (row.n_total, row.n_upserts, row.n_deletes, row.n_rejects) == (3, 1, 1, 1)
    assert (row.min_source_ts_ms, row.max_source_ts_ms, row.min_key, row.max_key) == (5, 9, 1, 2)
    assert len(row.key_bits_1) == 4096 and sum(bin(b).count("1") for b in row.key_bits_1) == 2
    assert log.read().agg(*measures(ITEMS)).first().n_total == 2 and KIND in log.read().columns


def test_registered_stored_log_opens_what_it_needs(spark):
    log = replays.stored_log(spark, SF_DIR, compacted=[1, 5])
    assert log.bases() == [1, 5]
    version = log.as_of(version=4)
    assert batches_in(version) == {2, 3, 4} and any("upto=1" in f for f in version.inputFiles())
    assert not any("upto=5" in f for f in version.inputFiles())
    assert batches_in(log.history()) == set()
    early = log.as_of(ts_ms=1705276800000)
    assert 6 not in batches_in(early) and not any("upto=5" in f for f in early.inputFiles())
