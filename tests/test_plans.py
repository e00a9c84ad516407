"""Physical plans: what is pruned, pushed down, aggregated early, and never done."""

import re

import pytest
from pyspark.sql import functions as F

from changetide.functions.changes import DELETE_WINS
from changetide.operators import (
    as_of, cascade_delete, changes, classify, current, decode, merge_delete, merge_upsert, reconcile,
    version_row_counts,
)
from changetide.plans import catalog, feeds, reports
from changetide.sources import scratch_dir
from changetide.streaming import ChangeLog, make_batch_writer

from helpers import ITEMS, LOG_SCHEMA, messages_of, payload

SF_DIR = "/root/testdata/sf0.001"


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def log(spark):
    root = scratch_dir(spark, "plans")
    writer = make_batch_writer(ITEMS, root)
    for batch in range(4):
        values = [payload(key, key + batch, ts=batch) for key in range(20)]
        writer(messages_of(spark, values), batch)
    return ChangeLog(spark, ITEMS, root)


def test_text_is_decoded_once(spark):
    messages = messages_of(spark, [payload(1, 1)])
    kept = current(changes(classify(decode(messages, ITEMS), ITEMS)), ITEMS)
    assert plan_of(kept).count("from_json(") == 1


def test_a_version_opens_only_its_batches(log):
    files = log.as_of(version=1).inputFiles()
    assert {re.search(r"batch_id=(\d+)", f).group(1) for f in files} == {"0", "1"}


def test_a_version_of_a_plain_log_prunes_partitions(log):
    plan = plan_of(as_of(log.read(), ITEMS, version=1))
    assert re.search(r"PartitionFilters: \[[^\]]*batch_id[^\]]*<=", plan)


def test_a_key_filter_reaches_the_scan(log):
    plan = plan_of(log.lookup(7))
    assert "EqualTo(k,7)" in re.search(r"PushedFilters: \[([^\]]*)\]", plan).group(1)


def test_only_needed_columns_are_read(log):
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", plan_of(log.current(columns=[])))
    assert schemas
    for schema in schemas:
        assert "v:" not in schema and "__value" not in schema and "__op" not in schema


def test_keys_are_reduced_before_the_shuffle(log):
    for mode in ("ordered", DELETE_WINS):
        plan = plan_of(current(log.read(), ITEMS, mode))
        assert plan.index("functions=[max") < plan.index("Exchange") < plan.index("partial_max")
        counts = plan_of(version_row_counts(log.read(), ITEMS, mode))
        assert counts.count("partial_") >= 2


def test_a_base_is_not_shuffled_for_a_few_changed_keys(spark, log):
    log.compact(version=2)
    plan = plan_of(log.current())
    assert "LeftAnti, BuildRight" in plan and "SortMergeJoin" not in plan
    untouched = plan[:plan.index("LeftAnti")]
    assert "hashpartitioning" not in untouched
    found = plan_of(log.lookup(7))
    assert found.count("FileScan") == found.count("EqualTo(k,7)") == 2
    log.compact()
    assert "Exchange" not in plan_of(log.current())


def test_merging_a_small_source_does_not_shuffle_the_target(spark):
    parts = feeds.product_rows(spark, SF_DIR)
    few = parts.filter("product_id < 10")
    for frame in (merge_delete(parts, few, "product_id"), merge_upsert(parts, few, "product_id")):
        plan = plan_of(frame)
        assert "LeftAnti, BuildRight" in plan
        assert "SortMergeJoin" not in plan


def test_reconcile_joins_nothing(spark):
    parts = feeds.product_rows(spark, SF_DIR)
    plan = plan_of(reconcile(parts, parts, "product_id"))
    assert "Join" not in plan and plan.count("partial_") >= 2


def test_top_k_is_one_operator(spark):
    for name in ("top_products", "top_hours", "hour_share", "sample_rows"):
        assert "TakeOrderedAndProject" in plan_of(catalog.QUERIES[name](spark, SF_DIR)), name


@pytest.mark.parametrize("name", sorted(n for n in catalog.QUERIES if not n.startswith("stream_")))
def test_no_query_pairs_rows_without_a_key(spark, name):
    plan = plan_of(catalog.QUERIES[name](spark, SF_DIR))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "PythonUDF" not in plan and "InPandas" not in plan


def shuffled_records(spark, frame):
    """Records written to shuffles while the frame is computed."""
    store = spark.sparkContext._jsc.sc().statusStore()

    def total():
        stages = store.stageList(None, False, False,
                                 spark.sparkContext._gateway.new_array(
                                     spark.sparkContext._jvm.double, 0), None)
        return sum(stages.apply(i).shuffleWriteRecords() for i in range(stages.size()))

    before = total()
    frame.write.format("noop").mode("overwrite").save()
    return total() - before


def test_a_key_with_a_third_of_the_changes_is_reduced_where_it_is_read(spark):
    """90,000 changes, a third of one key, in 6 tasks: a task sends a key once."""
    key = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 50).cast("int")
    hot = spark.range(0, 90_000, 1, 6).select(
        key.alias("k"), F.col("id").cast("int").alias("v"), F.lit("upsert").alias("__kind"),
        F.col("id").alias("__source_ts_ms"), F.lit(0).alias("__partition"),
        F.col("id").alias("__offset"), (F.col("id") % 5).alias("batch_id"))
    assert hot.schema.simpleString().replace("bigint", "LONG") and hot.columns == [
        c.split()[0] for c in LOG_SCHEMA.split(", ")]
    assert 50 <= shuffled_records(spark, current(hot, ITEMS)) <= 6 * 50
    assert shuffled_records(spark, version_row_counts(hot, ITEMS)) <= 6 * 50 * 5 + 50 * 5 + 8 * 5 + 5 + 50
    top = reports.top_counts(hot, "k", 3)
    assert shuffled_records(spark, top) <= 6 * 50 + 8 * 3
    assert top.first().k == 0
    same = reconcile(hot.select("k", F.lit(1).alias("v")), hot.select("k", F.lit(1).alias("v")), "k")
    assert shuffled_records(spark, same) <= 12 * 50 + 50 * 2


def test_a_parent_with_a_third_of_the_children_is_split(spark):
    """Where the doomed keys are too many to send around, the adaptive skew join takes over."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20000",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20000",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        parent = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 1000)
        children = spark.range(0, 200_000, 1, 8).select("id", parent.alias("fk"))
        parents = spark.range(0, 1000).withColumnRenamed("id", "pk")
        _, kept = cascade_delete(parents, children, parents.filter("pk % 2 = 1"), "pk", "fk")
        rows = kept.collect()
        assert "skew=true" in plan_of(kept)
        expected = sum(1 for i in range(200_000) if i % 3 == 0 or (i % 1000) % 2 == 0)
        assert len(rows) == expected
    finally:
        for key in settings:
            spark.conf.unset(key)
