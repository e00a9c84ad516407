"""Bounded streaming runs over the given tables, each into a log of its own."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.decode import to_messages
from ..sources.bulk import bootstrap
from ..sources.messages import file_messages
from ..sources.paths import scratch_dir
from ..sources.segments import segment_messages, write_segments
from ..spec import BATCH, OFFSET, ORDER_PRODUCTS, ORDERS, PARTITION, PRODUCTS, TableSpec
from ..streaming import ChangeLog, await_all, make_batch_writer, start, start_all, write_snapshot
from . import feeds

_ALL_NOW = {"availableNow": True}

# First day of each delivery of the resumed stream.
DELIVERIES = [0, 10, 20]

# Rows of a table that one task writes: a task sorts its rows, so their number bounds its memory.
TASK_ROWS = 500_000

# Partitions of the topic that numbered files stand for.
TOPIC_PARTITIONS = 4

# Day on which one of two uneven logs stops.
STOPPED = 17

# Days of each batch of the stored log, and how many batches the days of a month and a late one make.
PERIOD, PERIODS = 5, 7


def table_stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table as a stream, be it a file or a folder of files.

    A stream's plain path must be a folder; a pattern may match either.
    """
    schema = spark.read.parquet(f"{sf_dir}/{name}.parquet").schema
    return spark.readStream.schema(schema).parquet(f"{sf_dir}/{name}.parque[t]")


def write_tasks(spark: SparkSession, sf_dir: str, name: str) -> int:
    """As many tasks as cores for a table that is streamed in one batch, more for a large one; counted from the files' footers."""
    return max(spark.sparkContext.defaultParallelism, -(-feeds.table(spark, sf_dir, name).count() // TASK_ROWS))


def _event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feeds.event_messages(table_stream(spark, sf_dir, "events")).drop(BATCH)


def ingested(spark: SparkSession, sf_dir: str) -> tuple[ChangeLog, StreamingQuery]:
    """All events streamed into a log."""
    root = scratch_dir(spark, "ingest")
    query = start(feeds.USERS, _event_stream(spark, sf_dir), root, trigger=_ALL_NOW,
                  tasks=write_tasks(spark, sf_dir, "events"))
    await_all([query])
    return ChangeLog(spark, feeds.USERS, root), query


def replayed(spark: SparkSession, sf_dir: str) -> ChangeLog:
    """The same, with the first batch delivered a second time."""
    log, _ = ingested(spark, sf_dir)
    messages = feeds.event_messages(feeds.table(spark, sf_dir, "events")).drop(BATCH)
    make_batch_writer(log.spec, log.root)(messages, log.batches()[0])
    return log


def deliver(messages: DataFrame, landing: str) -> None:
    """Add messages to a folder that a stream reads."""
    messages.write.mode("append").json(landing)


def resumed(spark: SparkSession, sf_dir: str) -> ChangeLog:
    """Events in three deliveries; the stream ends after each and resumes from its checkpoint."""
    root, landing = scratch_dir(spark, "resume"), scratch_dir(spark, "landing")
    messages = feeds.event_messages(feeds.table(spark, sf_dir, "events"), late=True)
    for first, following in zip(DELIVERIES, [*DELIVERIES[1:], None]):
        day = F.col(BATCH)
        wanted = day >= first if following is None else (day >= first) & (day < following)
        deliver(messages.filter(wanted).drop(BATCH), landing)
        await_all([start(feeds.USERS, file_messages(spark, landing), root, trigger=_ALL_NOW)])
    return ChangeLog(spark, feeds.USERS, root)


def stored_log(spark: SparkSession, sf_dir: str, damaged: bool = False, compacted: Sequence[int] = ()) -> ChangeLog:
    """Events committed by periods of some days, with bases of some versions written in turn."""
    log = ChangeLog(spark, feeds.USERS, scratch_dir(spark, "stored"))
    writer = make_batch_writer(feeds.USERS, log.root)
    messages = feeds.event_messages(feeds.table(spark, sf_dir, "events"), late=True, damaged=damaged)
    for number in range(PERIODS):
        writer(messages.filter(F.floor(F.col(BATCH) / PERIOD) == number).drop(BATCH), number)
    for version in compacted:
        log.compact(version)
    return log


def widened_log(spark: SparkSession, sf_dir: str) -> ChangeLog:
    """Events written under a description that lacks most fields, compacted, and read under one that has them; the last ones under that."""
    narrow = ChangeLog(spark, feeds.NARROW_USERS, scratch_dir(spark, "widened"))
    wide = ChangeLog(spark, feeds.WIDE_USERS, narrow.root)
    messages = feeds.event_messages(feeds.table(spark, sf_dir, "events"), late=True)
    for number, first in enumerate(DELIVERIES):
        log, day = (wide if first == DELIVERIES[-1] else narrow), F.col(BATCH) - first
        wanted = messages.filter((day >= 0) & (day < 10 if log is narrow else F.lit(True)))
        make_batch_writer(log.spec, log.root)(wanted.drop(BATCH), number)
    narrow.compact(version=0)
    return wide


def uneven_logs(spark: SparkSession, sf_dir: str) -> dict[str, ChangeLog]:
    """Users with even and with odd numbers in logs of their own, of which the first has stopped at an earlier day."""
    base = scratch_dir(spark, "uneven")
    changes = feeds.event_changes(feeds.table(spark, sf_dir, "events"), late=True)
    logs = {}
    for name, rest, days in (("even", 0, STOPPED), ("odd", 1, None)):
        log = logs[name] = ChangeLog(spark, feeds.USERS, f"{base}/{name}")
        writer, mine = make_batch_writer(log.spec, log.root), changes.filter(F.col("user_id") % 2 == rest)
        for number, first in enumerate(DELIVERIES):
            day = F.col(BATCH) - first
            wanted = mine.filter((day >= 0) & (day < 10 if first != DELIVERIES[-1] else F.lit(True)))
            wanted = wanted if days is None else wanted.filter(F.col(BATCH) < days)
            writer(to_messages(wanted, log.spec, name).drop(BATCH), number)
    return logs


def orders_and_lines(spark: SparkSession, sf_dir: str) -> tuple[ChangeLog, ChangeLog]:
    """Orders and their lines as the snapshots of two logs in one folder."""
    base = scratch_dir(spark, "shop")
    rows = feeds.as_orders(feeds.table(spark, sf_dir, "orders")), feeds.as_order_products(feeds.table(spark, sf_dir, "lineitem"))
    logs = [ChangeLog(spark, spec, f"{base}/{spec.name}") for spec in (ORDERS, ORDER_PRODUCTS)]
    for log, each in zip(logs, rows):
        write_snapshot(bootstrap(each, log.spec), log.spec, log.root)
    return logs[0], logs[1]


def numbered(spark: SparkSession, sf_dir: str) -> ChangeLog:
    """Events in numbered files of four partitions, delivered twice, and the stream resumed by its offsets."""
    root, folder = scratch_dir(spark, "offsets"), scratch_dir(spark, "segments")
    messages = feeds.event_messages(feeds.table(spark, sf_dir, "events")).withColumns({
        "partition": (F.col("offset") % TOPIC_PARTITIONS).cast("int"),
        "offset": F.floor(F.col("offset") / TOPIC_PARTITIONS).cast("long")}).drop(BATCH)
    half = F.lit(messages.agg(F.max("offset")).first()[0] // 2)
    for part in (F.col("offset") < half, F.col("offset") >= half):
        write_segments(messages.filter(part), folder, rows=1000)
        await_all([start(feeds.USERS, segment_messages(spark, folder), root, trigger=_ALL_NOW)])
    return ChangeLog(spark, feeds.USERS, root)


def _created(rows: DataFrame, spec: TableSpec) -> DataFrame:
    position = {PARTITION: F.lit(0), OFFSET: F.col(spec.pk).cast("long")}
    written = rows.withColumns({"__op": F.lit("c"), "__source_ts_ms": F.lit(0), **position})
    return to_messages(written, spec, spec.topic(feeds.PREFIX, feeds.DATABASE))


def several_tables(spark: SparkSession, sf_dir: str) -> dict[str, ChangeLog]:
    """Orders, last lines and products, each by its own query at the same time."""
    specs = [ORDERS, feeds.LAST_LINES, PRODUCTS]
    lines = feeds.line_changes(table_stream(spark, sf_dir, "lineitem"))
    messages = {
        ORDERS.name: _created(feeds.as_orders(table_stream(spark, sf_dir, "orders")), ORDERS),
        feeds.LAST_LINES.name: to_messages(
            lines, feeds.LAST_LINES, feeds.LAST_LINES.topic(feeds.PREFIX, feeds.DATABASE)),
        PRODUCTS.name: _created(feeds.as_products(table_stream(spark, sf_dir, "part")), PRODUCTS),
    }
    sources = {ORDERS.name: "orders", feeds.LAST_LINES.name: "lineitem", PRODUCTS.name: "part"}
    base = scratch_dir(spark, "tables")
    await_all(start_all(specs, messages, base, trigger=_ALL_NOW,
                        tasks={name: write_tasks(spark, sf_dir, source) for name, source in sources.items()}))
    return {spec.name: ChangeLog(spark, spec, f"{base}/{spec.name}") for spec in specs}
