"""Commits of a change log, each with a summary of its batch.

    commits/N+changes+rejects     batch N is whole, with these lanes; holds its summary as JSON
    summaries/L+A+B/*.parquet     summaries of batches A to B, folded together
    folded/L+A+B                  empty marker: that folder is whole
    pending/N+lanes               commit of a batch that others must be visible with (``together.py``)

The writer learns the summary from the write itself, so nothing is read for it. Readers answer
from summaries what these can answer (history, counts, times, sizes) and choose by
them which batches to open. Commits are folded ``FOLD`` at a time, and folds in turn, so
however many batches a log has, a reader lists a few hundred names.
"""

from __future__ import annotations

import base64
import json
from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.paths import entries, exists, folder_size, read_text, remove, touch, write_text
from ..spec import BATCH, COMMITTED, DELETE, KIND, PARTIAL, REJECT, SOURCE_TS, UPSERT, TableSpec

LANE, CHANGES, REJECTS = "lane", "changes", "rejects"

# The initial snapshot comes before batch 0 of the stream. It may be written again, so it is never folded.
SNAPSHOT_BATCH = -1

# Commits, or folds of one level, that are folded into one.
FOLD = 64

# Bits of each of a batch's two key filters, the size of Spark's bitmap aggregates. Up to some ten thousand keys a
# batch they rule out nearly all others; of fuller batches the key range and the files' own filters remain.
FILTER_BITS = 32768
_FILTERS = ["key_bits_1", "key_bits_2"]

_COUNTS = ["n_total", "n_upserts", "n_deletes", "n_rejects", "n_partially_decoded", "n_untimed"]


def batch_path(root: str, batch_id: int) -> str:
    return f"{root}/batches/{BATCH}={batch_id}"


def summary_schema(spec: TableSpec) -> T.StructType:
    numbers = [BATCH, *_COUNTS, "min_source_ts_ms", "max_source_ts_ms", "committed_us", "duration_ms", "n_files", "size_bytes"]
    return T.StructType([
        *[T.StructField(name, T.LongType()) for name in numbers],
        T.StructField("lanes", T.StringType()),
        *[T.StructField(name, spec.schema[spec.pk].dataType) for name in ("min_key", "max_key")],
        *[T.StructField(name, T.BinaryType()) for name in _FILTERS],
    ])


def _filter_bit(number: int, key: str) -> str:
    return f"pmod(xxhash64({number}, {key}), {FILTER_BITS})"


def measures(spec: TableSpec) -> list[Column]:
    """Aggregates over a batch's rows, rejects included, that make up its summary.

    As SQL text, one call into the JVM each: they are built for every batch.
    """
    key, change = f"`{spec.pk}`", f"{KIND} <> '{REJECT}'"
    aggregates = {
        "n_total": "count(1)",
        "n_upserts": f"count_if({KIND} = '{UPSERT}')",
        "n_deletes": f"count_if({KIND} = '{DELETE}')",
        "n_rejects": f"count_if({KIND} = '{REJECT}')",
        "n_partially_decoded": f"count_if({PARTIAL})",
        "n_untimed": f"count_if({change} AND {SOURCE_TS} IS NULL)",
        "min_source_ts_ms": f"min(CASE WHEN {change} THEN {SOURCE_TS} END)",
        "max_source_ts_ms": f"max(CASE WHEN {change} THEN {SOURCE_TS} END)",
        "committed_us": f"unix_micros(max({COMMITTED}))",
        "min_key": f"CAST(min(CASE WHEN {change} THEN {key} END) AS STRING)",
        "max_key": f"CAST(max(CASE WHEN {change} THEN {key} END) AS STRING)",
        **{name: f"bitmap_construct_agg(CASE WHEN {change} THEN {_filter_bit(i, key)} END)"
           for i, name in enumerate(_FILTERS)},
    }
    return [F.expr(f"{text} AS {name}") for name, text in aggregates.items()]


def may_hold(spec: TableSpec, key: object) -> Column:
    """Whether a batch can have changes of a key, as its summary tells."""
    wanted = F.lit(key).cast(spec.schema[spec.pk].dataType)
    held = [F.col("min_key") <= wanted, F.col("max_key") >= wanted]
    for i, name in enumerate(_FILTERS):
        bit = F.pmod(F.xxhash64(F.lit(i), wanted), F.lit(FILTER_BITS))
        byte = F.conv(F.hex(F.substring(F.col(name), F.floor(bit / 8).cast("int") + 1, F.lit(1))), 16, 10)
        held.append(F.floor(byte.cast("long") / F.pow(F.lit(2), bit % 8)) % 2 == 1)
    return reduce(Column.__and__, held)


def shared_folder(root: str) -> str:
    """Where tables that lie in one folder keep the markers they share."""
    return f"{root.rsplit('/', 1)[0]}/together"


def shared_names(spark: SparkSession, root: str) -> set[str]:
    """Names of a table's pending commits whose shared marker stands."""
    folder, table = shared_folder(root), root.rsplit("/", 1)[1]
    found = [json.loads(read_text(spark, f"{folder}/{name}")) for name in entries(spark, folder)]
    return {parts[table] for parts in found if table in parts}


@dataclass(frozen=True, order=True)
class Fold:
    first: int
    last: int
    level: int

    @classmethod
    def named(cls, name: str) -> Fold:
        level, first, last = map(int, name.split("+"))
        return cls(first, last, level)

    @property
    def name(self) -> str:
        return f"{self.level}+{self.first}+{self.last}"

    def covers(self, other: Fold) -> bool:
        return self != other and self.level > other.level and self.first <= other.first and other.last <= self.last


@dataclass(frozen=True)
class Commits:
    spark: SparkSession
    spec: TableSpec
    root: str

    # -- what there is --------------------------------------------------------------

    def _markers(self, batch_id: int) -> list[str]:
        """The markers a batch may have, so that writing one batch lists no others."""
        return [f"{self.root}/commits/{batch_id}+{lanes}"
                for lanes in (CHANGES, REJECTS, f"{CHANGES}+{REJECTS}")]

    def _singles(self) -> dict[int, str]:
        """Batches with a marker of their own, and its path below the root.

        A pending commit counts as soon as the marker that it shares with others stands. Pending ones are
        listed first: what is moved in between is then seen twice, not never.
        """
        waiting = entries(self.spark, f"{self.root}/pending")
        shared = shared_names(self.spark, self.root) if waiting else set()
        found = {int(name.split("+", 1)[0]): f"pending/{name}" for name in waiting if name in shared}
        return found | {int(name.split("+", 1)[0]): f"commits/{name}" for name in entries(self.spark, f"{self.root}/commits")}

    def _folds(self) -> list[Fold]:
        return sorted(Fold.named(name) for name in entries(self.spark, f"{self.root}/folded"))

    def _listed(self) -> tuple[dict[int, str], list[Fold]]:
        """Single commits and folds that together hold every batch once.

        Singles are listed first: what is folded in between is then seen twice, not never.
        """
        singles, folds = self._singles(), self._folds()
        folds = [f for f in folds if not any(other.covers(f) for other in folds)]
        return {b: path for b, path in sorted(singles.items())
                if not any(f.first <= b <= f.last for f in folds)}, folds

    def _read(self, singles: Mapping[int, str], folds: list[Fold]) -> DataFrame:
        schema = summary_schema(self.spec)
        found = self.spark.createDataFrame([], schema)
        if singles:
            found = self.spark.read.schema(schema).json([f"{self.root}/{path}" for path in singles.values()])
        if folds:
            found = found.unionByName(self.spark.read.schema(schema).parquet(
                *[f"{self.root}/summaries/{f.name}" for f in folds]))
        return found

    def summaries(self, lane: str | None = None, after: int | None = None) -> DataFrame:
        """One row per committed batch, or per batch that has a lane or follows another; older folds are not read."""
        singles, folds = self._listed()
        if after is not None:
            singles = {b: path for b, path in singles.items() if b > after}
            folds = [f for f in folds if f.last > after]
        found = self._read(singles, folds)
        if after is not None and folds:
            found = found.filter(F.col(BATCH) > after)
        return found if lane is None else found.filter(F.col("lanes").contains(lane))

    def batches(self, lane: str | None = None, after: int | None = None, upto: int | None = None,
                where: Column | None = None) -> list[int]:
        """Committed batches in order, of a lane, of a range, with summaries that meet a condition.

        Names tell range and lanes of single commits; folds beyond the range are not read.
        """
        def inside(batch: int) -> bool:
            return (after is None or batch > after) and (upto is None or batch <= upto)

        singles, folds = self._listed()
        singles = {b: path for b, path in singles.items() if inside(b) and (lane is None or lane in path.split("+"))}
        folds = [f for f in folds if (after is None or f.last > after) and (upto is None or f.first <= upto)]
        if where is None and not folds:
            return list(singles)
        if not singles and not folds:
            return []
        found = self._read(singles, folds)
        if lane is not None:
            found = found.filter(F.col("lanes").contains(lane))
        if where is not None:
            found = found.filter(where)
        return sorted(b for row in found.select(BATCH).collect() if inside(b := row[BATCH]))

    def is_committed(self, batch_id: int) -> bool:
        if any(exists(self.spark, marker) for marker in self._markers(batch_id)):
            return True
        return bool(self._folds_over(batch_id)) and batch_id in self.batches(after=batch_id - 1, upto=batch_id)

    def _folds_over(self, batch_id: int) -> list[Fold]:
        return [f for f in self._folds() if f.first <= batch_id <= f.last]

    # -- changes --------------------------------------------------------------------

    def withdraw(self, batch_id: int) -> None:
        """Hide a batch from readers before it is written again."""
        if self._folds_over(batch_id):
            raise ValueError(f"batch {batch_id} of {self.spec.name} is folded, so it can't be written again")
        for marker in self._markers(batch_id):
            remove(self.spark, marker)

    def publish(self, batch_id: int, seen: Mapping[str, object] | None = None, duration_ms: int | None = None,
                folder: str = "commits") -> str | None:
        """Show a completely written batch to readers, unless nothing was written; the marker's name.

        ``seen`` holds the batch's :func:`measures`; without it they are taken from the stored rows.
        """
        stored = batch_path(self.root, batch_id)
        lanes = [lane for lane in (CHANGES, REJECTS) if exists(self.spark, f"{stored}/{LANE}={lane}")]
        if not lanes:
            return None
        if seen is None:
            rows = self.spark.read.schema(self.spec.log_schema).parquet(*[f"{stored}/{LANE}={x}" for x in lanes])
            seen = rows.agg(*measures(self.spec)).first().asDict()
        n_files, size = folder_size(self.spark, f"{stored}/{LANE}={CHANGES}")
        row = {name: base64.b64encode(value).decode() if isinstance(value, (bytes, bytearray)) else value
               for name, value in seen.items()}
        row |= {BATCH: batch_id, "lanes": "+".join(lanes), "duration_ms": duration_ms, "n_files": n_files, "size_bytes": size}
        integral = isinstance(self.spec.schema[self.spec.pk].dataType, T.IntegralType)
        for name in ("min_key", "max_key"):
            row[name] = int(row[name]) if integral and row[name] is not None else row[name]
        marker = "+".join([str(batch_id), *lanes])
        write_text(self.spark, f"{self.root}/{folder}/{marker}", json.dumps(row))
        return marker

    def fold(self, size: int = FOLD) -> None:
        """Fold single commits, and then folds of each level, as soon as there are ``size`` of them.

        Of every folded batch the older form is deleted by the next fold only, so that readers
        that have listed it can still open it.
        """
        every, folds = self._singles(), self._folds()
        singles, whole = self._listed()
        for batch in every.keys() - singles.keys():
            remove(self.spark, f"{self.root}/{every[batch]}")
        for old in set(folds) - set(whole):
            remove(self.spark, f"{self.root}/folded/{old.name}")
            remove(self.spark, f"{self.root}/summaries/{old.name}", recursive=True)
        loose = {b: path for b, path in singles.items() if b != SNAPSHOT_BATCH}
        if len(loose) >= size:
            self._store(self._read(loose, []), Fold(min(loose), max(loose), 0), len(loose))
        level = 0
        while len(peers := [f for f in self._listed()[1] if f.level == level]) >= size:
            level += 1
            self._store(self._read({}, peers), Fold(peers[0].first, peers[-1].last, level), size ** (level + 1))

    def _store(self, rows: DataFrame, fold: Fold, n: int) -> None:
        files = max(1, n // FOLD ** 2)
        rows.repartitionByRange(files, BATCH).sortWithinPartitions(BATCH).write.mode("overwrite").parquet(
            f"{self.root}/summaries/{fold.name}")
        touch(self.spark, f"{self.root}/folded/{fold.name}")
