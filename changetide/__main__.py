"""Command line: load bulk files, compare with them, follow topics, show reports.

    python -m changetide load   --base PATH --data-dir DIR [--limit N]
    python -m changetide verify --base PATH --data-dir DIR [--limit N]
    python -m changetide ingest --base PATH --servers HOST:PORT --prefix P --database D
    python -m changetide report --base PATH [--demo NAME] [--rows N]
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

from .plans import reports
from .sources import as_rejects, bootstrap, kafka_messages, load_shop_tables, shop_rejects
from .sources.bulk import BEFORE_ALL
from .spec import SHOP_TABLES
from .streaming import ChangeLog, start_all, stop_all, write_snapshot

# Fixed value: how often a running ingest reports.
PROGRESS_SECONDS = 30

REPORT_NAMES = ["overview", "current", "time-travel", "analytics", "metadata", "consistent"]


def _logs(spark: SparkSession, base: str) -> dict[str, ChangeLog]:
    return {spec.name: ChangeLog(spark, spec, f"{base}/{spec.name}") for spec in SHOP_TABLES}


def load(spark: SparkSession, args: argparse.Namespace) -> None:
    """Bulk files as the snapshot that precedes the streams; what can't be loaded goes to the rejects. A second load is a full refresh."""
    tables, rejects = load_shop_tables(spark, args.data_dir, args.limit, lenient=True), shop_rejects(spark, args.data_dir)
    for spec in SHOP_TABLES:
        rows = bootstrap(tables[spec.name], spec, args.exported).unionByName(as_rejects(rejects[spec.name], spec))
        write_snapshot(rows, spec, f"{args.base}/{spec.name}")
    logs = _logs(spark, args.base)
    reports.table_counts({name: log.current(columns=[]) for name, log in logs.items()}).show(truncate=False)
    for name, log in logs.items():
        if log.committed("rejects"):
            print(f"load {name}: rejects")
            log.reject_summary().show(truncate=False)


def verify(spark: SparkSession, args: argparse.Namespace) -> None:
    """Bulk files against the tables: keys by status, and the first key's value on both sides."""
    source = load_shop_tables(spark, args.data_dir, args.limit, lenient=True)
    for name, log in _logs(spark, args.base).items():
        if log.exists():
            column = next(c for c in log.spec.columns if c != log.spec.pk)
            found = reports.verify(source[name], log.current(), log.spec.pk, column)
            for part, frame in found.items():
                print(f"verify {name}: {part}")
                frame.show(truncate=False)


def ingest(spark: SparkSession, args: argparse.Namespace) -> None:
    """Follow the topics of all tables until one query ends or the user interrupts; show the last batches now and then."""
    messages = {spec.name: kafka_messages(spark, args.servers, spec.topic(args.prefix, args.database))
                for spec in SHOP_TABLES}
    queries = start_all(SHOP_TABLES, messages, args.base, args.checkpoint,
                        {"processingTime": args.trigger})
    try:
        while not spark.streams.awaitAnyTermination(args.progress):
            reports.latest_batches(_logs(spark, args.base)).show(truncate=False)
    except KeyboardInterrupt:
        pass
    finally:
        stop_all(queries)


def report(spark: SparkSession, args: argparse.Namespace) -> None:
    found = reports.stored_reports(_logs(spark, args.base), None if args.demo == "all" else args.demo)
    for title, parts in found.items():
        for part, frame in parts.items():
            print(f"{title}: {part}")
            frame.show(args.rows, truncate=False)


def main(argv: list[str]) -> None:
    parser = argparse.ArgumentParser(prog="changetide")
    commands = parser.add_subparsers(dest="command", required=True)

    loading, verifying = commands.add_parser("load"), commands.add_parser("verify")
    for command in (loading, verifying):
        command.add_argument("--data-dir", required=True)
        command.add_argument("--limit", type=int, help="first rows of each file; all if absent")

    loading.add_argument("--exported", type=int, default=BEFORE_ALL, help="time of export in ms")

    ingesting = commands.add_parser("ingest")
    ingesting.add_argument("--servers", required=True)
    ingesting.add_argument("--prefix", required=True)
    ingesting.add_argument("--database", required=True)
    ingesting.add_argument("--checkpoint")
    ingesting.add_argument("--trigger", default="10 seconds")
    ingesting.add_argument("--progress", type=int, default=PROGRESS_SECONDS, help="seconds between two reports of progress")

    reporting = commands.add_parser("report")
    reporting.add_argument("--demo", choices=["all", *REPORT_NAMES], default="all")
    reporting.add_argument("--rows", type=int, default=20)

    actions = ((loading, load), (verifying, verify), (ingesting, ingest), (reporting, report))
    for command, action in actions:
        command.add_argument("--base", required=True)
        command.set_defaults(action=action)

    args = parser.parse_args(argv)
    args.action(SparkSession.builder.appName("changetide").getOrCreate(), args)


if __name__ == "__main__":
    main(sys.argv[1:])
