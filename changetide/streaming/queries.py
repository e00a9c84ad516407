"""Start, watch and stop the streaming queries, one per table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..sources.paths import exists
from ..spec import TableSpec
from .changelog import ChangeLog
from .commits import SNAPSHOT_BATCH
from .writer import make_batch_writer

DEFAULT_TRIGGER = {"processingTime": "10 seconds"}

_PROGRESS = ("table_name STRING, batch_id LONG, timestamp STRING, n_input_rows LONG, "
             "duration_ms LONG")


def start(spec: TableSpec, messages: DataFrame, root: str, checkpoint: str | None = None,
          trigger: Mapping[str, object] | None = None,
          tasks: int | None = None) -> StreamingQuery:
    """Stream messages into the table's change log.

    The log and the checkpoint live and die together: a new checkpoint would number its
    batches from 0 and replace committed ones, so it is refused over a log that has them.
    """
    spark = messages.sparkSession
    checkpoint = checkpoint or f"{root}/checkpoint"
    streamed = [b for b in ChangeLog(spark, spec, root).committed() if b != SNAPSHOT_BATCH]
    if streamed and not exists(spark, f"{checkpoint}/offsets"):
        raise ValueError(f"{root} holds committed batches, but {checkpoint} is no checkpoint of them")
    return (
        messages.writeStream.queryName(spec.name)
        .foreachBatch(make_batch_writer(spec, root, tasks))
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or DEFAULT_TRIGGER))
        .start()
    )


def start_all(specs: Sequence[TableSpec], messages: Mapping[str, DataFrame], base: str,
              checkpoint: str | None = None, trigger: Mapping[str, object] | None = None,
              tasks: int | Mapping[str, int] | None = None) -> list[StreamingQuery]:
    """One query per table, side by side, below a common base path; ``tasks`` is one number for all or a number for each."""
    each = tasks if isinstance(tasks, Mapping) else {spec.name: tasks for spec in specs}
    return [
        start(spec, messages[spec.name], f"{base}/{spec.name}",
              f"{checkpoint}/{spec.name}" if checkpoint else None, trigger, each.get(spec.name))
        for spec in specs
    ]


def await_all(queries: Sequence[StreamingQuery]) -> None:
    """Wait for bounded queries; the first failure is raised after the others have ended."""
    failures = []
    for query in queries:
        try:
            query.awaitTermination()
        except Exception as failure:  # noqa: BLE001
            failures.append(failure)
    if failures:
        raise failures[0]


def stop_all(queries: Sequence[StreamingQuery], timeout: int = 15) -> None:
    """Stop every query, then give each up to ``timeout`` seconds to end; the first failure is raised after all."""
    failures = []
    for act in (lambda q: q.stop() if q.isActive else None, lambda q: q.awaitTermination(timeout)):
        for query in queries:
            try:
                act(query)
            except Exception as failure:  # noqa: BLE001
                failures.append(failure)
    if failures:
        raise failures[0]


def progress(spark: SparkSession, queries: Sequence[StreamingQuery]) -> DataFrame:
    """Input rows and duration of the batches Spark still reports, at most a setting's number."""
    rows = [
        (q.name, p["batchId"], p["timestamp"], p["numInputRows"],
         p["durationMs"].get("triggerExecution"))
        for q in queries for p in q.recentProgress
    ]
    return spark.createDataFrame(rows, _PROGRESS)


def batch_timings(metrics: DataFrame, reported: DataFrame, table: str) -> DataFrame:
    """Batch metrics with the duration of the batches that are still reported."""
    durations = reported.filter(F.col("table_name") == table).groupBy("batch_id").agg(
        F.max("duration_ms").alias("duration_ms"))
    return metrics.join(durations, "batch_id", "left")
