"""Change messages as streams, all in the frame ``(value, ts, topic, partition, offset)``."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..spec import MESSAGE_SCHEMA, TableSpec


def _frame(raw: DataFrame) -> DataFrame:
    return raw.select(
        F.col("value").cast("string").alias("value"),
        F.col("timestamp").alias("ts"), "topic", "partition", "offset")


def kafka_messages(spark: SparkSession, servers: str, topic: str,
                   options: Mapping[str, str] | None = None) -> DataFrame:
    """Stream of a topic from its start; needs Spark's Kafka package.

    Pass ``minPartitions`` to split a topic partition that holds much more than the
    others over several tasks, and ``maxOffsetsPerTrigger`` to bound a batch.
    """
    # Read from the start, survive expired offsets, session timings.
    settings = {
        "startingOffsets": "earliest",
        "failOnDataLoss": "false",
        "kafka.session.timeout.ms": "30000",
        "kafka.heartbeat.interval.ms": "10000",
        **(options or {}),
    }
    return _frame(
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers).option("subscribe", topic)
        .options(**settings).load())


def file_messages(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """Stream of JSON-lines files whose objects are message frames."""
    reader = spark.readStream.schema(MESSAGE_SCHEMA)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.json(path)


def text_messages(spark: SparkSession, path: str, topic: str,
                  max_files: int | None = None) -> DataFrame:
    """Stream of text files with one payload per line.

    Plain text has no broker position: the file's time stands for the message's time, and
    the batch writer numbers the lines.
    """
    reader = spark.readStream.format("text")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path).select(
        "value",
        F.col("_metadata.file_modification_time").alias("ts"),
        F.lit(topic).alias("topic"),
        F.lit(0).alias("partition"),
        F.lit(None).cast("long").alias("offset"))


def with_tasks(frame: DataFrame, tasks: int) -> DataFrame:
    """This many tasks, by a shuffle that the caller asks for; a scan's splits are set by configuration."""
    return frame.repartition(tasks)


def route(messages: DataFrame, specs: Sequence[TableSpec], prefix: str,
          database: str) -> dict[str, DataFrame]:
    """Messages of each included table; topics of other tables are left out."""
    return {spec.name: messages.filter(F.col("topic") == spec.topic(prefix, database))
            for spec in specs}

