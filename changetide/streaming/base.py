"""Compacted state of a change log, cut by key into buckets and stored in runs.

    base/mode=M/runs/upto=N/bucket=B/*.parquet    deciding changes of keys of bucket B, written at batch N
    base/mode=M/steps/upto=N/*.parquet            change of the row count by each batch since the base before
    base/mode=M/manifests/N                       the runs and steps that make up the base of batch N, as JSON

A new base writes only buckets whose keys have changed, and of these only a run with the keys that did, unless the
runs before are not much larger: then it absorbs them. So a bucket has a few runs of falling size, and
a row is written again about once each time its bucket's younger runs have grown like it.
Manifests share unchanged runs, so each base stays readable as long as it has its manifest.
"""

from __future__ import annotations

import json
from dataclasses import dataclass
from functools import reduce
from itertools import pairwise

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import state, timeline
from ..operators.decode import widened
from ..sources.paths import entries, read_text, reads_files, remove, write_text
from ..spec import BATCH, TableSpec

# Parts of a base by hash of the key; the first base of a mode decides.
BUCKETS = 32

# A new run absorbs the one before it unless that has more than this many times its rows.
GROWTH = 2

BUCKET = "bucket"

Runs = dict[int, list[list[int]]]   # by bucket: batch and rows of each run, the oldest first


def log_columns(spec: TableSpec) -> T.StructType:
    return T.StructType([*spec.log_schema.fields, T.StructField(BATCH, T.LongType())])


@dataclass(frozen=True)
class Manifest:
    upto: int
    buckets: int
    runs: Runs
    steps: list[int]   # batches at which steps were written

    @classmethod
    def parsed(cls, text: str) -> Manifest:
        found = json.loads(text)
        return cls(found["upto"], found["buckets"], {int(b): runs for b, runs in found["runs"].items()},
                   found["steps"])

    def text(self) -> str:
        return json.dumps({"upto": self.upto, "buckets": self.buckets, "runs": self.runs, "steps": self.steps})


@dataclass(frozen=True)
class Bases:
    spark: SparkSession
    spec: TableSpec
    root: str
    mode: str

    @property
    def _folder(self) -> str:
        return f"{self.root}/base/mode={self.mode}"

    def _run(self, upto: int, bucket: int) -> str:
        return f"{self._folder}/runs/upto={upto}/{BUCKET}={bucket}"

    def stored(self) -> list[int]:
        """Batches up to which a whole base is stored."""
        return sorted(map(int, entries(self.spark, f"{self._folder}/manifests")))

    def manifest(self, upto: int) -> Manifest:
        return Manifest.parsed(read_text(self.spark, f"{self._folder}/manifests/{upto}"))

    def bucket(self, buckets: int, key: Column | None = None) -> Column:
        hashed = F.xxhash64(F.col(self.spec.pk) if key is None else key)
        return F.pmod(hashed, F.lit(buckets)).cast("int")

    def _read(self, paths: list[str]) -> DataFrame:
        schema = log_columns(self.spec)
        if not paths:
            return self.spark.createDataFrame([], schema)
        return widened(self.spark.read.schema(schema).parquet(*paths), self.spec)

    def read(self, upto: int, key: object = None) -> tuple[DataFrame, DataFrame]:
        """Rows of every bucket's oldest run, in which no key repeats, and those of its younger ones.

        With a key only the runs of its bucket are opened.
        """
        found = self.manifest(upto)
        runs = found.runs
        if key is not None:
            wanted = F.lit(key).cast(self.spec.schema[self.spec.pk].dataType)
            one = self.spark.range(1).select(self.bucket(found.buckets, wanted)).first()[0]
            runs = {one: runs.get(one, [])}
        oldest = [self._run(each[0][0], b) for b, each in runs.items() if each]
        younger = [self._run(batch, b) for b, each in runs.items() for batch, _ in each[1:]]
        return self._read(oldest), self._read(younger)

    def write(self, tail: DataFrame, upto: int, before: int | None, buckets: int = BUCKETS,
              growth: int = GROWTH) -> None:
        """Store the base of ``upto`` from the changes since the base ``before``, or since the beginning."""
        old = Manifest(upto, buckets, {}, []) if before is None else self.manifest(before)
        bucket = self.bucket(old.buckets)
        # Distinct keys of each touched bucket, near enough for the choice of the runs to absorb.
        grown = {row[BUCKET]: row["n"] for row in tail.groupBy(bucket.alias(BUCKET)).agg(
            F.approx_count_distinct(self.spec.pk).alias("n")).collect()}
        runs, absorbed = dict(old.runs), []
        for number, n in grown.items():
            kept = list(runs.get(number, []))
            while kept and kept[-1][1] <= growth * n:
                batch, rows = kept.pop()
                absorbed.append(self._run(batch, number))
                n += rows
            runs[number] = kept
        rows = state.last_changes(self._read(absorbed).unionByName(tail.select(*log_columns(self.spec).names)),
                                  self.spec, self.mode)
        folder = f"{self._folder}/runs/upto={upto}"
        (
            # Spark deals rows by bucket and then splits large buckets and joins small ones.
            rows.withColumn(BUCKET, bucket).hint("rebalance", BUCKET)
            .sortWithinPartitions(BUCKET, self.spec.pk)
            .write.mode("overwrite").option("partitionOverwriteMode", "static")
            .option("parquet.bloom.filter.enabled#" + self.spec.pk, "true")
            .option("parquet.bloom.filter.adaptive.enabled", "true")
            .partitionBy(BUCKET).parquet(folder)
        )
        if grown:
            written = self.spark.read.parquet(folder).groupBy(BUCKET).agg(F.count("*").alias("n")).collect()
            for row in written:
                runs[row[BUCKET]] = [*runs[row[BUCKET]], [upto, row["n"]]]
        self.later_steps(tail, before).coalesce(1).write.mode("overwrite").parquet(f"{self._folder}/steps/upto={upto}")
        found = Manifest(upto, old.buckets, runs, [*old.steps, upto])
        write_text(self.spark, f"{self._folder}/manifests/{upto}", found.text())

    def later_steps(self, tail: DataFrame, before: int | None) -> DataFrame:
        """Steps of the batches in ``tail``, the changes since the base ``before``, from the keys they touch alone."""
        if before is None:
            return timeline.version_steps(tail, self.spec, self.mode)
        pk = self.spec.pk
        touched = tail.select(pk).distinct()
        met = [rows.join(touched, pk, "left_semi").select(*tail.columns) for rows in self.read(before) if reads_files(rows)]
        return timeline.version_steps(reduce(DataFrame.unionByName, met, tail), self.spec, self.mode, before)

    def steps(self, upto: int) -> DataFrame:
        """Steps of all batches up to a base."""
        return self.spark.read.schema(f"{BATCH} LONG, step LONG").parquet(
            *[f"{self._folder}/steps/upto={batch}" for batch in self.manifest(upto).steps])

    def runs(self, upto: int) -> DataFrame:
        """``bucket, upto, n_rows`` of the runs of a base."""
        found = [(b, batch, n) for b, each in self.manifest(upto).runs.items() for batch, n in each]
        return self.spark.createDataFrame(found, f"{BUCKET} INT, upto LONG, n_rows LONG")

    def forget(self, keep: int = 1) -> None:
        """Delete all bases but the newest ones, and the runs that none of these uses."""
        stored = self.stored()
        going, staying = stored[:len(stored) - keep], stored[len(stored) - keep:]
        used = {(batch, b) for upto in staying for b, each in self.manifest(upto).runs.items() for batch, _ in each}
        for upto in going:
            remove(self.spark, f"{self._folder}/manifests/{upto}")
        for name in entries(self.spark, f"{self._folder}/runs"):
            batch = int(name.removeprefix("upto="))
            for part in entries(self.spark, f"{self._folder}/runs/{name}"):
                if part.startswith(f"{BUCKET}=") and (batch, int(part.removeprefix(f"{BUCKET}="))) not in used:
                    remove(self.spark, f"{self._folder}/runs/{name}/{part}", recursive=True)


def falling(runs: Runs) -> bool:
    """Whether every bucket's runs get smaller, so that there are few of them."""
    return all(older[1] > newer[1] for each in runs.values() for older, newer in pairwise(each))


def drop_bases(spark: SparkSession, root: str) -> None:
    """Forget the compacted state, when batches it was made from are written anew."""
    remove(spark, f"{root}/base", recursive=True)
