"""Batches of several tables that become visible together.

    BASE/TABLE/pending/N+lanes    a table's commit, written but not yet valid
    BASE/together/ID              marker of all of them, as JSON: the one write that makes them valid

Readers take a pending commit for a commit as soon as the shared marker names it. Afterwards every
table gets a commit of its own and the marker goes; if that is cut short, the next call completes it.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.merge import doomed_rows
from ..sources.bulk import to_changes
from ..sources.paths import entries, exists, read_text, remove, write_text
from .changelog import ChangeLog
from .commits import shared_folder, shared_names
from .writer import commit


def settle(spark: SparkSession, base: str) -> None:
    """Give every table of a folder its own commits for the shared markers that stand, and remove these."""
    folder = shared_folder(f"{base}/any")
    for name in entries(spark, folder):
        for table, marker in json.loads(read_text(spark, f"{folder}/{name}")).items():
            if not exists(spark, f"{base}/{table}/commits/{marker}"):
                write_text(spark, f"{base}/{table}/commits/{marker}", read_text(spark, f"{base}/{table}/pending/{marker}"))
        remove(spark, f"{folder}/{name}")


def commit_together(parts: Sequence[tuple[ChangeLog, DataFrame]]) -> list[int]:
    """Commit changes, in the log's columns, to several logs of one folder; readers see all or none. The batches.

    A running stream numbers its batches itself, so a log that has a stream's checkpoint is refused.
    Pending commits whose marker was never written are left over from a call that failed, and are removed.
    """
    logs = [log for log, _ in parts]
    spark, base = logs[0].spark, logs[0].root.rsplit("/", 1)[0]
    if len({log.root for log in logs}) < len(logs) or {log.root.rsplit("/", 1)[0] for log in logs} != {base}:
        raise ValueError("give each log once, and logs of one folder")
    for log in logs:
        if exists(spark, f"{log.root}/checkpoint/offsets"):
            raise ValueError(f"a stream numbers the batches of {log.root}")
    settle(spark, base)
    markers, batches = {}, []
    for log, changes in parts:
        valid = shared_names(spark, log.root)
        for name in entries(spark, f"{log.root}/pending"):
            if name not in valid:
                remove(spark, f"{log.root}/pending/{name}")
        batches.append(max(log.committed(), default=-1) + 1)
        marker = commit(changes, log.spec, log.root, batches[-1], "pending")
        if marker is not None:
            markers[log.root.rsplit("/", 1)[1]] = marker
    if markers:
        write_text(spark, f"{shared_folder(logs[0].root)}/{uuid.uuid4().hex}", json.dumps(markers))
        settle(spark, base)
    return batches


def cascade_delete_logged(parent: ChangeLog, child: ChangeLog, keys: DataFrame, fk: str, ts_ms: int) -> list[int]:
    """Delete parents by key and the children that refer to them, as changes of both logs that appear together."""
    doomed = keys.select(F.col(parent.spec.pk)).distinct()
    gone = doomed_rows(parent.current(), doomed, parent.spec.pk), doomed_rows(
        child.current(), doomed.withColumnRenamed(parent.spec.pk, fk), fk)
    return commit_together([(log, to_changes(rows, log.spec, "d", ts_ms)) for log, rows in zip((parent, child), gone)])
