"""Optional target: Delta tables, where the delta-spark package is installed.

The package is imported on use. Each batch becomes one MERGE, so readers never see
upserts without the deletes of the same batch. Positions are not kept in the
target: between batches the later one decides, within a batch the newest change.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.decode import changes, classify, decode
from ..operators.state import last_changes
from ..spec import BATCH, DELETE, KIND, UPSERT, TableSpec


def make_delta_writer(spec: TableSpec, path: str) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that applies a batch of messages to a Delta table."""
    from delta.tables import DeltaTable

    def write(messages: DataFrame, batch_id: int) -> None:
        spark = messages.sparkSession
        placed = messages.withColumns({
            "offset": F.coalesce("offset", F.monotonically_increasing_id()),
            BATCH: F.lit(batch_id).cast("long")})
        last = last_changes(changes(classify(decode(placed, spec), spec)), spec).select(
            *spec.columns, KIND)
        DeltaTable.createIfNotExists(spark).location(path).addColumns(spec.schema).execute()
        row = {c: f"source.`{c}`" for c in spec.columns}
        (
            DeltaTable.forPath(spark, path).alias("target")
            .merge(last.alias("source"), f"target.`{spec.pk}` = source.`{spec.pk}`")
            .whenMatchedDelete(f"source.{KIND} = '{DELETE}'")
            .whenMatchedUpdate(set=row)
            .whenNotMatchedInsert(f"source.{KIND} = '{UPSERT}'", row)
            .execute()
        )

    return write


def read_delta(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    reader = spark.read.format("delta")
    return (reader if version is None else reader.option("versionAsOf", version)).load(path)


def delta_history(spark: SparkSession, path: str) -> DataFrame:
    from delta.tables import DeltaTable

    return DeltaTable.forPath(spark, path).history()


def delta_detail(spark: SparkSession, path: str) -> DataFrame:
    from delta.tables import DeltaTable

    return DeltaTable.forPath(spark, path).detail()
