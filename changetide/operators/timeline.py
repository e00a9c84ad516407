"""History, per-batch metrics and row counts of every version."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from ..functions.changes import DELETE_WINS, ORDERED, arrival_order
from ..spec import BATCH, COMMITTED, DELETE, KIND, PARTIAL, SOURCE_TS, UPSERT, TableSpec


def _by_batch() -> WindowSpec:
    """A frame over one row per batch; aggregates below it have run before the shuffle."""
    return Window.orderBy(BATCH)


def _kind_count(kind: str) -> Column:
    return F.count_if(F.col(KIND) == kind)


def batch_metrics(classified: DataFrame) -> DataFrame:
    """Messages per batch: total, upserts, deletes, rejects, and partly decoded ones."""
    return classified.groupBy(BATCH).agg(
        F.count("*").alias("n_total"),
        _kind_count(UPSERT).alias("n_upserts"),
        _kind_count(DELETE).alias("n_deletes"),
        F.count_if(~F.col(KIND).isin(UPSERT, DELETE)).alias("n_rejects"),
        F.count_if(F.col(PARTIAL)).alias("n_partially_decoded"),
    )


def history(log: DataFrame, spec: TableSpec, skipped: int = 0) -> DataFrame:
    """One row per version: when it was committed, what it did and to how many rows.

    A log without its first ``skipped`` versions is numbered on from there.
    """
    committed = F.max(COMMITTED) if COMMITTED in log.columns else F.lit(None).cast("timestamp")
    batches = log.groupBy(BATCH).agg(
        committed.alias("timestamp"),
        _kind_count(UPSERT).alias("n_upserts"),
        _kind_count(DELETE).alias("n_deletes"),
        F.min(SOURCE_TS).alias("min_source_ts_ms"),
        F.max(SOURCE_TS).alias("max_source_ts_ms"),
    )
    return history_of(batches, spec, skipped)


def history_of(batches: DataFrame, spec: TableSpec, skipped: int = 0) -> DataFrame:
    """The same from one row per batch with its time, counts and range of source times."""
    first = F.col("version") == 0
    return batches.withColumn(
        "version", (F.row_number().over(_by_batch()) + (skipped - 1)).cast("long")
    ).select(
        "version", BATCH, "timestamp",
        F.when(first, "WRITE").otherwise("MERGE").alias("operation"),
        F.when(first, "mode=create").otherwise(f"key={spec.pk}").alias("operation_parameters"),
        "n_upserts", "n_deletes", "min_source_ts_ms", "max_source_ts_ms",
    )


def last_operations(history_rows: DataFrame, k: int) -> DataFrame:
    return history_rows.orderBy(F.desc("version")).limit(k)


def version_steps(log: DataFrame, spec: TableSpec, mode: str = ORDERED, after: int | None = None) -> DataFrame:
    """``batch_id`` and ``step``: by how much each batch changes the number of live rows.

    One pass for all batches: reduce to one row per (key, batch), see which of these
    rows bring a key to life or end it, and add up the steps. The window per key holds at
    most one row per batch. Under ``ordered`` a late change may lose to an earlier
    batch, so a key lives by the greatest change seen so far, not by the batch's own.
    Rows up to the batch ``after`` make no steps: they are the state that later batches meet.
    """
    per_key = Window.partitionBy(spec.pk).orderBy(BATCH)
    touched = log.groupBy(spec.pk, BATCH)
    if mode == ORDERED:
        position = [c.alias(f"by{i}") for i, c in enumerate(arrival_order())]
        best = F.max(F.struct(*position, (F.col(KIND) == UPSERT).alias("live")))
        so_far = per_key.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        states = touched.agg(best.alias("best")).select(
            spec.pk, BATCH, F.max("best").over(so_far)["live"].alias("live"))
    elif mode == DELETE_WINS:
        states = touched.agg((~F.bool_or(F.col(KIND) == DELETE)).alias("live"))
    else:
        raise ValueError(f"unknown mode {mode!r}")
    before = F.coalesce(F.lag("live").over(per_key), F.lit(False))
    steps = states.select(BATCH, (F.col("live").cast("long") - before.cast("long")).alias("step"))
    if after is not None:
        steps = steps.filter(F.col(BATCH) > after)
    return steps.groupBy(BATCH).agg(F.sum("step").alias("step"))


def counts_of(steps: DataFrame) -> DataFrame:
    """Live rows at every version, and the change against the version before, from the batches' steps."""
    return (
        steps.select(
            (F.row_number().over(_by_batch()) - 1).cast("long").alias("version"),
            BATCH,
            F.sum("step").over(
                _by_batch().rowsBetween(Window.unboundedPreceding, Window.currentRow)).alias("n_rows"),
            "step",
        )
        .select("version", BATCH, "n_rows",
                F.when(F.col("version") > 0, F.col("step")).alias("change"))
    )


def version_row_counts(log: DataFrame, spec: TableSpec, mode: str = ORDERED) -> DataFrame:
    """Live rows at every version, and the change against the version before."""
    return counts_of(version_steps(log, spec, mode))
