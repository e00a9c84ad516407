"""State of a table, computed from its change log."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.changes import ORDERED, state_order
from ..spec import BATCH, KIND, SOURCE_TS, UPSERT, TableSpec

_WON = "__won"
_LIVE = "__live"


def _last_change(log: DataFrame, spec: TableSpec, mode: str, columns: Sequence[str]) -> DataFrame:
    """One row per key: the columns of the change that decides it, and whether it lives.

    The maximum of a struct is computed before the shuffle as well, so each map task
    sends at most one row per key however often the key changed. Equal positions
    can only be copies of one change; the row columns then break the tie the same way
    on every run.
    """
    packed = F.struct(
        *[c.alias(f"__by{i}") for i, c in enumerate(state_order(mode))],
        (F.col(KIND) == UPSERT).alias(_LIVE),
        *columns,
    )
    return log.groupBy(spec.pk).agg(F.max(packed).alias(_WON))


def current(log: DataFrame, spec: TableSpec, mode: str = ORDERED,
            columns: Iterable[str] | None = None) -> DataFrame:
    """Live rows, without metadata. Only ``columns`` (and the key) are read from the log."""
    wanted = spec.columns if columns is None else [c for c in spec.columns if c in set(columns)]
    carried = [c for c in wanted if c != spec.pk]
    won = _last_change(log, spec, mode, carried).filter(F.col(_WON)[_LIVE])
    out = wanted if spec.pk in wanted else [spec.pk, *wanted]
    return won.select(*[F.col(c) if c == spec.pk else F.col(_WON)[c].alias(c) for c in out])


def published(rows: DataFrame, spec: TableSpec) -> DataFrame:
    """Live rows with their time columns as timestamps; unreadable times become NULL."""
    return rows.withColumns({c: F.try_to_timestamp(c) for c in spec.times if c in rows.columns})


def last_changes(log: DataFrame, spec: TableSpec, mode: str = ORDERED,
                 columns: Sequence[str] | None = None) -> DataFrame:
    """The deciding change of every key, deletes included, with all or some log columns.

    With all of them the result can stand in for the log it came from: a later or late
    change is compared with it exactly as with the full log.
    """
    out = log.columns if columns is None else [spec.pk, *[c for c in columns if c != spec.pk]]
    won = _last_change(log, spec, mode, [c for c in out if c != spec.pk])
    return won.select(*[F.col(c) if c == spec.pk else F.col(_WON)[c].alias(c) for c in out])


def versions(log: DataFrame) -> DataFrame:
    """``version`` and ``batch_id``: non-empty batches, numbered from 0 without gaps.

    One row per batch, hence the window over a single partition.
    """
    return log.select(BATCH).distinct().select(
        (F.row_number().over(Window.orderBy(BATCH)) - 1).cast("long").alias("version"), BATCH)


def up_to(log: DataFrame, version: int | None = None, ts_ms: int | None = None) -> DataFrame:
    """The part of a log that a reader of a version, or of a source time, would see."""
    if (version is None) == (ts_ms is None):
        raise ValueError("give either version or ts_ms")
    if ts_ms is not None:
        return log.filter(F.col(SOURCE_TS) <= F.lit(ts_ms).cast("long"))
    last = versions(log).filter(F.col("version") == version).select(BATCH).scalar()
    known = F.coalesce(last, F.raise_error(F.lit(f"the log has no version {version}")).cast("long"))
    return log.filter(F.col(BATCH) <= known)


def as_of(log: DataFrame, spec: TableSpec, version: int | None = None, ts_ms: int | None = None,
          mode: str = ORDERED, columns: Iterable[str] | None = None) -> DataFrame:
    """State at a version, or at a source time. A version that does not exist is an error when rows are read."""
    return current(up_to(log, version, ts_ms), spec, mode, columns)


def lookup(log: DataFrame, spec: TableSpec, key: object, mode: str = ORDERED) -> DataFrame:
    """The live row of one key. The key filter reaches the scan."""
    return current(log.filter(F.col(spec.pk) == F.lit(key)), spec, mode)
