"""Commit of one micro-batch to a change log."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..operators.decode import classify, decode
from ..sources.messages import with_tasks
from ..spec import COMMITTED, KIND, REJECT, REST, TableSpec
from .base import drop_bases
from .commits import CHANGES, FOLD, LANE, REJECTS, SNAPSHOT_BATCH, Commits, batch_path, measures


def commit(classified: DataFrame, spec: TableSpec, root: str, batch_id: int, folder: str = "commits") -> str | None:
    """Write upserts, deletes and rejects in one job, then set one commit with what the job has seen; its name.

    Writing a batch again replaces it. Rows are sorted by key in each file, so that a
    key filter can skip row groups; the same sort serves the directory split.
    """
    commits, began = Commits(classified.sparkSession, spec, root), time.monotonic()
    commits.withdraw(batch_id)
    seen = Observation()
    lane = F.when(F.col(KIND) == REJECT, REJECTS).otherwise(CHANGES)
    if spec.keep_unknown and REST not in classified.columns:   # rows that were no messages
        classified = classified.withColumn(REST, F.lit(None).cast("string"))
    (
        classified.withColumns({LANE: lane, COMMITTED: F.current_timestamp()})
        .select(*spec.log_schema.names, LANE)
        .observe(seen, *measures(spec))
        .sortWithinPartitions(LANE, spec.pk)
        .write.mode("overwrite").option("partitionOverwriteMode", "static")
        .partitionBy(LANE).parquet(batch_path(root, batch_id))
    )
    marker = commits.publish(batch_id, seen.get, round(1000 * (time.monotonic() - began)), folder)
    if (batch_id + 1) % FOLD == 0:
        commits.fold(FOLD)
    return marker


def _positioned(messages: DataFrame, batch_id: int) -> DataFrame:
    """Messages with a position, made up where the source gives none: by batch, task and place in the task.

    The batch stands as the partition and Spark's row number, which holds task and row, as the offset, so neither
    has a limit of its own.
    """
    unplaced = F.col("offset").isNull()
    return messages.withColumns({
        "partition": F.when(unplaced, F.lit(batch_id).cast("int")).otherwise(F.col("partition")),
        "offset": F.when(unplaced, F.monotonically_increasing_id()).otherwise(F.col("offset"))})


def make_batch_writer(spec: TableSpec, root: str,
                      tasks: int | None = None) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that decodes, classifies and commits a batch of messages.

    The batch is read once. A batch that is committed stays as it is: delivered again, be it with fewer rows
    because its source has lost some, it is skipped, so readers never miss it.
    ``tasks`` decodes and writes with that many tasks, and so files: fewer than the source's
    partitions where frequent batches would leave very small files, more where a source has
    few partitions or one that holds most messages.
    """
    def write(messages: DataFrame, batch_id: int) -> None:
        if Commits(messages.sparkSession, spec, root).is_committed(batch_id):
            return
        # Only a batch frame, not a stream, can number the messages of a source without offsets.
        placed = _positioned(messages, batch_id)
        if tasks:
            placed = with_tasks(placed, tasks)
        commit(classify(decode(placed, spec), spec), spec, root, batch_id)

    return write


def write_snapshot(changes: DataFrame, spec: TableSpec, root: str) -> None:
    """Commit an initial snapshot, made by ``bootstrap``, ahead of the first stream batch.

    A snapshot written again replaces the one before, a full refresh.
    """
    drop_bases(changes.sparkSession, root)
    commit(changes, spec, root, SNAPSHOT_BATCH)
