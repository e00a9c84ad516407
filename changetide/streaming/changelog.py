"""A stored change log and the tables that can be read from it.

Layout below the root, with one directory per committed micro-batch:

    batches/batch_id=N/lane=changes/*.parquet     upserts and deletes
    batches/batch_id=N/lane=rejects/*.parquet     messages that could not be applied
    commits, summaries, folded                    which batches are whole, and what each holds
    base                                          deciding change of every key up to some batches

Overwriting a directory is not atomic, so a batch counts only once its commit stands
(``commits.py``). Commits share one folder and carry a summary of their batch: whole reports come from
these, and they tell which batches a read must open. A base (``base.py``) spares readers the batches before it.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.changes import ORDERED
from ..operators import state, timeline
from ..operators.decode import reject_summary, widened
from ..sources.paths import data_files, reads_files
from ..spec import BATCH, KIND, REASON, SOURCE_TS, UPSERT, VALUE, TableSpec
from .base import BUCKETS, GROWTH, Bases, log_columns
from .commits import CHANGES, LANE, REJECTS, Commits, batch_path, may_hold


@dataclass(frozen=True)
class ChangeLog:
    spark: SparkSession
    spec: TableSpec
    root: str

    # -- what is stored -------------------------------------------------------------

    @property
    def commits(self) -> Commits:
        return Commits(self.spark, self.spec, self.root)

    def committed(self, lane: str | None = None) -> list[int]:
        """Committed batches, or those of them that have a lane."""
        return self.commits.batches(lane)

    def batches(self) -> list[int]:
        """Committed batches that hold changes; their places are the version numbers."""
        return self.committed(CHANGES)

    def exists(self) -> bool:
        return bool(self.batches())

    def batch_of(self, version: int) -> int:
        batches = self.batches()
        if not 0 <= version < len(batches):
            raise ValueError(f"{self.spec.name} has no version {version}, only {len(batches)} versions")
        return batches[version]

    def _stored(self, batches: list[int], lane: str) -> DataFrame:
        schema = log_columns(self.spec)
        if not batches:
            return self.spark.createDataFrame([], schema)
        rows = (
            self.spark.read.schema(schema).option("basePath", f"{self.root}/batches")
            .parquet(*[f"{batch_path(self.root, b)}/{LANE}={lane}" for b in batches])
            .select(*schema.names)
        )
        return widened(rows, self.spec)

    def read(self, after: int | None = None, upto: int | None = None, where: Column | None = None) -> DataFrame:
        """Changes of committed batches, of a range and with summaries that meet a condition.

        Directories of other batches are not opened.
        """
        return self._stored(self.commits.batches(CHANGES, after, upto, where), CHANGES)

    def rejects(self) -> DataFrame:
        return self._stored(self.committed(REJECTS), REJECTS).select(
            BATCH, F.col(REASON).alias("reason"), F.col(VALUE).alias("value"))

    def reject_summary(self) -> DataFrame:
        return reject_summary(self._stored(self.committed(REJECTS), REJECTS))

    # -- compaction -----------------------------------------------------------------

    def stored_bases(self, mode: str = ORDERED) -> Bases:
        return Bases(self.spark, self.spec, self.root, mode)

    def bases(self, mode: str = ORDERED) -> list[int]:
        """Batches up to which a complete base is stored."""
        return self.stored_bases(mode).stored()

    def compact(self, version: int | None = None, mode: str = ORDERED, buckets: int = BUCKETS,
                growth: int = GROWTH) -> int:
        """Store the deciding change of every key up to a version; returns its batch.

        Deletes and positions are stored too, so a late change cannot bring a deleted key back. The newest older base
        is the starting point: only the changes since, and the runs they absorb, are written.
        """
        batches = self.batches()
        if not batches:
            raise ValueError(f"{self.spec.name} has no version to compact")
        upto = self.batch_of(len(batches) - 1 if version is None else version)
        bases = self.bases(mode)
        if upto not in bases:
            before = max((b for b in bases if b < upto), default=None)
            self.stored_bases(mode).write(self.read(before, upto), upto, before, buckets, growth)
        return upto

    def _decided(self, base: int, mode: str, later: DataFrame, columns: list[str] | None = None) -> DataFrame:
        """The deciding change of every key, from a base and the changes after it.

        Only keys that changed since the oldest runs are grouped anew; other rows are final as they are. Spark
        sizes the joins when they run: few changed keys go to the base's tasks, many meet it in a shuffle.
        """
        pk = self.spec.pk
        oldest, younger = self.stored_bases(mode).read(base)
        # A frame without files has no known size, which would make Spark shuffle the base.
        parts = [rows for rows in (younger, later) if reads_files(rows)]
        tail = reduce(DataFrame.unionByName, parts) if parts else None
        if tail is None:
            return oldest if columns is None else oldest.select(pk, *[c for c in columns if c != pk])
        touched = tail.select(pk).distinct()
        reopened = oldest.join(touched, pk, "left_semi").select(*tail.columns).unionByName(tail)
        decided = state.last_changes(reopened, self.spec, mode, columns)
        return oldest.join(touched, pk, "left_anti").select(*decided.columns).unionByName(decided)

    # -- tables ---------------------------------------------------------------------

    def _rows(self, base: int | None, later: DataFrame, mode: str, columns: Iterable[str] | None) -> DataFrame:
        """Live rows from a base, if there is one, and the changes after it."""
        spec = self.spec
        wanted = spec.columns if columns is None else [c for c in spec.columns if c in set(columns)]
        if base is None:
            return state.current(later, spec, mode, wanted)
        out = wanted if spec.pk in wanted else [spec.pk, *wanted]
        return self._decided(base, mode, later, [*wanted, KIND]).filter(F.col(KIND) == UPSERT).select(*out)

    def current(self, mode: str = ORDERED, columns: Iterable[str] | None = None,
                upto: int | None = None) -> DataFrame:
        """Live rows, from the newest base that helps and the batches after it."""
        base = max((b for b in self.bases(mode) if upto is None or b <= upto), default=None)
        return self._rows(base, self.read(base, upto), mode, columns)

    def as_of(self, version: int | None = None, ts_ms: int | None = None, mode: str = ORDERED,
              columns: Iterable[str] | None = None) -> DataFrame:
        """State at a version or at a source time.

        For a version only its batches are opened; for a time only those that begin by then, after
        the newest base whose changes are all that old.
        """
        if (version is None) == (ts_ms is None):
            raise ValueError("give either version or ts_ms")
        if version is not None:
            return self.current(mode, columns, upto=self.batch_of(version))
        base = self._base_before(ts_ms, mode)
        seen = self.read(base, where=F.col("min_source_ts_ms") <= ts_ms)
        return self._rows(base, seen.filter(F.col(SOURCE_TS) <= F.lit(ts_ms).cast("long")), mode, columns)

    def _base_before(self, ts_ms: int, mode: str) -> int | None:
        """The newest base without a change that is later, or that has no time and so counts as later."""
        bases = self.bases(mode)
        if not bases:
            return None
        late = self.commits.batches(CHANGES, upto=max(bases), where=(
            (F.col("max_source_ts_ms") > ts_ms) | (F.col("n_untimed") > 0)))
        return max((b for b in bases if not late or b < late[0]), default=None)

    def lookup(self, key: object, mode: str = ORDERED) -> DataFrame:
        """The live row of one key: from its bucket of a base, and batches that may hold it."""
        base = max(self.bases(mode), default=None)
        log = self.read(base, where=may_hold(self.spec, key))
        if base is not None:
            oldest, younger = self.stored_bases(mode).read(base, key)
            log = oldest.unionByName(younger).unionByName(log)
        return state.lookup(log, self.spec, key, mode)

    def create_view(self, name: str | None = None, mode: str = ORDERED) -> None:
        """The published table as a SQL view, under the table's name unless another is given."""
        state.published(self.current(mode), self.spec).createOrReplaceTempView(
            name or self.spec.name)

    def history(self, last: int | None = None) -> DataFrame:
        """History of all versions, or of the last ones, from the summaries; no batch is opened."""
        after, skipped = None, 0
        if last is not None:
            batches = self.batches()
            skipped = max(0, len(batches) - last)
            after = batches[skipped - 1] if skipped else None
        rows = self.commits.summaries(CHANGES, after)
        return timeline.history_of(
            rows.withColumn("timestamp", F.timestamp_micros("committed_us")), self.spec, skipped)

    def version_row_counts(self, mode: str = ORDERED, first: int | None = None) -> DataFrame:
        """Row counts of all versions, or of the first ones.

        Bases keep the steps of the batches they were made of; of a base's rows only the keys that later batches touch are read.
        """
        batches = self.batches()[:first]
        upto = batches[-1] if batches else None
        base = max((b for b in self.bases(mode) if batches and b <= upto), default=None)
        later = self._stored([b for b in batches if base is None or b > base], CHANGES)
        bases = self.stored_bases(mode)
        if base is None:
            return timeline.counts_of(bases.later_steps(later, None))
        steps = bases.steps(base)
        if reads_files(later):
            steps = steps.unionByName(bases.later_steps(later, base))
        return timeline.counts_of(steps)

    def batch_metrics(self) -> DataFrame:
        """Messages of every committed batch by kind, rejects included, from the summaries."""
        return self.commits.summaries().select(
            BATCH, "n_total", "n_upserts", "n_deletes", "n_rejects", "n_partially_decoded")

    def batch_timings(self, last: int | None = None) -> DataFrame:
        """Messages of all committed batches, or the last ones, the time each commit took and when that was, however long ago."""
        after = None
        if last is not None:
            batches = self.committed()
            after = batches[-last - 1] if len(batches) > last else None
        return self.commits.summaries(after=after).select(
            BATCH, "n_total", "duration_ms", F.timestamp_micros("committed_us").alias("committed_at"))

    # -- several tables -------------------------------------------------------------

    def passed(self) -> int | None:
        """The greatest source time that the log has seen, from the summaries; None while there is none."""
        return self.commits.summaries(CHANGES).agg(F.max("max_source_ts_ms")).first()[0]

    # -- files ----------------------------------------------------------------------

    def files(self) -> DataFrame:
        """Parquet files of the committed changes."""
        return data_files(self.spark, [f"{batch_path(self.root, b)}/{LANE}={CHANGES}"
                                       for b in self.batches()])

    def detail(self) -> DataFrame:
        """One row: format, location, files, bytes, columns, partition column, versions; from the summaries."""
        committed = F.timestamp_micros("committed_us")
        return self.commits.summaries(CHANGES).agg(
            F.coalesce(F.sum("n_files"), F.lit(0)).alias("n_files"),
            F.coalesce(F.sum("size_bytes"), F.lit(0)).alias("size_bytes"),
            F.count("*").alias("n_versions"),
            F.min(committed).alias("created_at"),
            F.max(committed).alias("last_modified"),
        ).select(
            F.lit(self.spec.name).alias("table_name"), F.lit("parquet").alias("format"),
            F.lit(self.root).alias("location"), "created_at", "last_modified",
            "n_files", "size_bytes", "n_versions",
            F.lit(",".join(self.spec.columns)).alias("columns"),
            F.lit(BATCH).alias("partition_columns"), F.lit(self.spec.pk).alias("key_column"))


def consistent_cut(logs: Sequence[ChangeLog]) -> int | None:
    """The greatest source time that all logs have passed; None while one of them has seen none.

    Tables of one database are committed apart, each at its own pace. As of this time they show one state of it, unless a
    change older than it is still to come.
    """
    times = [log.passed() for log in logs]
    return None if None in times else min(times, default=None)
