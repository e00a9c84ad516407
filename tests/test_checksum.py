"""Comparison by checksums against the plain one."""

import random

import pytest
from pyspark.sql import functions as F

from changetide.operators import reconcile, reconcile_by_checksum
from changetide.operators.checksum import Ranges, differing, held


def statuses(frame):
    return sorted((tuple(r) for r in frame.collect()), key=repr)


def copy_of(rows, draw, share, columns):
    """Some rows dropped, changed, doubled or added, and all in another order."""
    out = []
    for row in rows:
        if draw.random() < share:
            kind = draw.choice(["drop", "change", "double", "null"])
            out += {"drop": [], "change": [(row[0], "other", *row[2:])], "double": [row, row],
                    "null": [(row[0], None, *row[2:])]}[kind]
        else:
            out.append(row)
    out += [(draw.randrange(-5000, 5000) if columns.startswith("k int") else f"new{draw.random()}", "extra", 0) for _ in range(int(share * 20))]
    draw.shuffle(out)
    return out


@pytest.mark.parametrize("seed, share", [(1, 0.0), (2, 0.02), (3, 0.5)])
@pytest.mark.parametrize("kind", ["int", "string"])
def test_equal_to_the_plain_comparison(spark, seed, share, kind):
    draw = random.Random(seed)
    keys = [draw.randrange(-3000, 3000) for _ in range(250)]
    rows = [(k if kind == "int" else f"k{k}", draw.choice("abc"), draw.randrange(3)) for k in keys] + [(None, "a", 1), (None, "a", 1)]
    schema = f"k {kind}, v string, n int"
    source = spark.createDataFrame(rows, schema).repartition(3)
    replica = spark.createDataFrame(copy_of(rows, draw, share, schema), schema).repartition(5).select("n", "v", "k")
    want = statuses(reconcile(source, replica, "k"))
    assert statuses(reconcile_by_checksum(source, replica, "k", fanout=4, followed=10)) == want
    assert statuses(reconcile_by_checksum(source, replica, "k")) == want


def test_rows_are_compared_only_where_they_differ(spark):
    source = spark.range(100_000).select(F.col("id").alias("k"), (F.col("id") * 7 % 1000).alias("v"))
    replica = source.filter("k not in (500, 70000)").withColumn("v", F.when(F.col("k").between(40_000, 40_003), -1).otherwise(F.col("v")))
    found = differing(source, replica, "k", fanout=16)
    assert found.width <= 16 and sum(b - a + 1 for a, b in found.intervals()) <= 64
    assert all(any(a <= k <= b for a, b in found.intervals()) for k in (500, 70_000, 40_000, 40_003))
    assert differing(source, source.repartition(7), "k").slots == ()
    counted = reconcile_by_checksum(source, replica, "k", unique_keys=True).groupBy("status").count()
    assert dict(map(tuple, counted.collect())) == {"equal": 99_994, "different": 4, "missing": 2}


def test_rows_that_cancel_out_are_seen(spark):
    schema = "k int, v int"
    twice, other = spark.createDataFrame([(1, 5), (1, 5)], schema), spark.createDataFrame([(1, 6), (1, 6)], schema)
    assert statuses(reconcile_by_checksum(twice, other, "k")) == [(1, "different")]
    swapped = spark.createDataFrame([(1, 2), (2, 1)], schema), spark.createDataFrame([(1, 1), (2, 2)], schema)
    assert statuses(reconcile_by_checksum(*swapped, "k")) == [(1, "different"), (2, "different")]


def test_empty_tables_and_a_filter_that_reaches_the_scan(spark, tmp_path):
    schema = "k long, v long"
    none, some = spark.createDataFrame([], schema), spark.createDataFrame([(1, 1), (None, 2)], schema)
    assert statuses(reconcile_by_checksum(none, none, "k")) == []
    assert statuses(reconcile_by_checksum(some, none, "k")) == [(1, "missing"), (None, "missing")]
    assert statuses(reconcile_by_checksum(none, some, "k")) == [(1, "extra"), (None, "extra")]
    with pytest.raises(ValueError, match="columns differ"):
        reconcile_by_checksum(some, some.drop("v"), "k")
    spark.range(50_000).select(F.col("id").alias("k"), F.lit(1).cast("long").alias("v")).write.parquet(f"{tmp_path}/a")
    source = spark.read.parquet(f"{tmp_path}/a")
    found = differing(source, source.filter("k <> 777"), "k")
    plan = source.filter(held(found, source, "k"))._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(k,777)" in plan or "GreaterThanOrEqual(k,777)" in plan
    assert found.intervals() == [(777, 777)]


def test_keys_at_the_ends_of_their_type(spark):
    ends = [-2**63, -2**62, -1, 0, 2**53 + 1, 2**60, 2**63 - 1]
    source = spark.createDataFrame([(k, 1) for k in ends], "k long, v int")
    replica = spark.createDataFrame([(k, 1 if k != 2**53 + 1 else 2) for k in ends[1:]], "k long, v int")
    assert statuses(reconcile_by_checksum(source, replica, "k")) == statuses(reconcile(source, replica, "k"))


def test_ranges_tell_their_numbers():
    ranges = Ranges(-10, 5, (0, 1, 4))
    assert ranges.intervals() == [(-10, -1), (10, 14)]
    assert Ranges(0, 1, ()).intervals() == []
