"""Operator 7: fingerprints by order MinHash."""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .tables import mixed, table

GRAM = 6        # code points of a k-mer
BINS = 64       # parts of a fingerprint
CHOSEN = 2      # k-mers that a part puts in order
_EMPTY = "0" * 8
_FACTOR = np.uint64(0x100000001B3 * 2 + 1)


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def _ordinals(sorted_values: np.ndarray) -> np.ndarray:
    """How many equal values stand before each one of a sorted array."""
    places = np.arange(len(sorted_values))
    first = np.ones(len(sorted_values), bool)
    first[1:] = sorted_values[1:] != sorted_values[:-1]
    return places - np.maximum.accumulate(np.where(first, places, 0))


def fingerprint(points: np.ndarray) -> str:
    """``BINS`` parts of eight hex digits; the same code points always give the same parts.

    Every k-mer gets the number of its occurrence, so repeats are distinct. A hash deals the numbered
    k-mers to the bins and ranks them there. A bin takes its ``CHOSEN`` smallest, puts them back into the
    order of the text and hashes that tuple: the same k-mers in another order give another part. A bin
    with fewer takes those it has; one without any is written as zeros. A text shorter than a
    k-mer counts as one k-mer, an empty text has zeros only.
    """
    n = len(points)
    if n == 0:
        return _EMPTY * BINS
    gram = min(GRAM, n)
    values = np.zeros(n - gram + 1, np.uint64)
    with np.errstate(over="ignore"):
        for i in range(gram):
            values = values * _FACTOR + points[i:n - gram + 1 + i]
        values = mixed(values)
    where = np.argsort(values, kind="stable")
    ordered = values[where]
    seen = _ordinals(ordered)
    repeat = np.flatnonzero(seen)
    if len(repeat):
        with np.errstate(over="ignore"):
            ordered[repeat] = mixed(ordered[repeat] + seen[repeat].astype(np.uint64), 1)
        again = np.argsort(ordered, kind="stable")
        ordered, where = ordered[again], where[again]
    # The bin is in the low bits, so each bin is still sorted by the whole hash.
    bins = (ordered % np.uint64(BINS)).astype(np.int16)
    by_bin = np.argsort(bins, kind="stable")
    starts = np.searchsorted(bins[by_bin], np.arange(BINS + 1))
    at = starts[:-1, None] + np.arange(CHOSEN)
    there = at < starts[1:, None]
    chosen = by_bin[np.minimum(at, len(by_bin) - 1)]
    # Back to the order of the text; places that a bin lacks come last and count as zero.
    turn = np.argsort(np.where(there, where[chosen], n), axis=1, kind="stable")
    grams = np.take_along_axis(np.where(there, ordered[chosen], np.uint64(0)), turn, axis=1)
    parts = np.zeros(BINS, np.uint64)
    for place in range(CHOSEN):
        parts = mixed(parts ^ grams[:, place], place + 2)
    parts = (parts >> np.uint64(32)).astype(">u4")
    return np.where(there[:, 0], np.maximum(parts, 1), 0).astype(">u4").tobytes().hex()


def likeness(a: str, b: str) -> float:
    """Share of equal parts among those that at least one of the two has; 1 for two empty texts."""
    size = len(_EMPTY)
    pairs = [(a[i:i + size], b[i:i + size]) for i in range(0, len(a), size)]
    pairs = [p for p in pairs if p != (_EMPTY, _EMPTY)]
    return sum(x == y for x, y in pairs) / len(pairs) if pairs else 1.0


def fingerprints(frame: DataFrame, text: str = "text", into: str = "fingerprint") -> DataFrame:
    """The rows with the fingerprint of their whole text; a null text counts as empty."""
    source = frame.drop(into)

    def work(batches):
        for batch in batches:
            marks = [fingerprint(code_points(t.as_py() or "")) for t in batch.column(text)]
            yield batch.append_column(into, pa.array(marks, pa.string()))

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema)
    return source.mapInArrow(work, f"{schema}, `{into}` string")


def in_runs(frame: DataFrame, key: str, runs: int) -> DataFrame:
    """Rows in tasks of neighbouring numeric keys, each run followed by the first row of the next.

    ``__run`` numbers the runs and ``__ahead`` marks the row that only looks ahead; after the last run
    stands the first row of all. The cuts between the runs are quantiles of the keys of all rows; they and
    the first key of each run, so a few numbers a run, are all that reaches the driver. Each text is sent once,
    but for one row a run.
    """
    shares = [i / runs for i in range(1, runs)]
    cuts = np.unique(frame.approxQuantile(key, shares, 0.2 / runs)) if runs > 1 else np.empty(0)

    @F.pandas_udf(T.IntegerType())
    def run_of(keys: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(cuts, keys.to_numpy(np.float64), side="left").astype(np.int32))

    placed = frame.withColumns({
        "__run": F.coalesce(F.when(F.col(key).isNotNull(), run_of(F.coalesce(F.col(key).cast("double"), F.lit(0.0)))), F.lit(0)),
        "__tie": F.xxhash64("text")})
    # The first row of every run: its key and, among equal keys, the least tie.
    first = F.min(F.struct(F.col(key).alias("k"), F.col("__tie").alias("t")))
    heads = placed.groupBy("__run").agg(first.alias("h")).orderBy("__run").collect()
    ahead = frame.sparkSession.createDataFrame(
        [(h["h"]["k"], h["h"]["t"], heads[i - 1]["__run"]) for i, h in enumerate(heads)],
        T.StructType([T.StructField("__k", frame.schema[key].dataType), T.StructField("__t", T.LongType()),
                      T.StructField("__previous", T.IntegerType())]))
    same = F.col(key).eqNullSafe(F.col("__k")) & (F.col("__tie") == F.col("__t"))
    here = F.struct(F.lit(0).alias("ahead"), F.col("__run").alias("run"))
    there = F.struct(F.lit(1).alias("ahead"), F.col("__previous").alias("run"))
    return (
        placed.join(F.broadcast(ahead), same, "left")
        .withColumn("__to", F.explode(F.when(F.col("__previous").isNull(), F.array(here)).otherwise(F.array(here, there))))
        .withColumns({"__run": F.col("__to.run"), "__ahead": F.col("__to.ahead")})
        .drop("__to", "__k", "__t", "__previous")
        .repartition(max(len(heads), 1), "__run")
        .sortWithinPartitions("__run", "__ahead", F.col(key).asc_nulls_first(), "__tie"))


def compare_with_next(frame: DataFrame, key: str, runs: int) -> DataFrame:
    """Each document's fingerprint against that of its edited text and of the next document by key.

    The edit puts the first floor(n/2) code points of the next document (all, if it has fewer)
    in the place of the last floor(n/2). Null texts are empty, null keys come first, rows with equal
    keys follow each other by a hash of their text, and the last row's next is the first.
    """

    def work(batches):
        held = None   # the row whose next has not come yet
        for batch in batches:
            out = []
            columns = [batch.column(c) for c in (key, "text", "__run", "__ahead")]
            for name, text, run, ahead in zip(*columns):
                points = code_points(text.as_py() or "")
                now = (name.as_py(), run.as_py(), points, fingerprint(points))
                if held and held[1] == now[1]:
                    out.append(_compared(held, now))
                held = None if ahead.as_py() else now
            yield pa.RecordBatch.from_pylist([dict(zip(schema.names, row)) for row in out], schema)

    kind = frame.schema[key].dataType.simpleString()
    result = (f"`{key}` {kind}, n_chars long, edited_sha256 string, fingerprint string, "
              "edited_fingerprint string, near_edited double, near_next double")
    schema = to_arrow_schema(T._parse_datatype_string(result))
    return in_runs(frame.select(key, "text"), key, runs).select(
        key, "text", "__run", "__ahead").mapInArrow(work, result)


def _compared(held: tuple, following: tuple) -> tuple:
    name, _, own, mark = held
    half = len(own) // 2
    points = np.concatenate([own[:len(own) - half], following[2][:half]])
    edited = points.tobytes().decode("utf-32-le", "surrogatepass")
    edited_mark = fingerprint(points)
    digest = hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest()
    return (name, len(own), digest, mark, edited_mark, likeness(mark, edited_mark), likeness(mark, following[3]))


def op7_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document against its edited text and the next document."""
    documents = table(spark, sf_dir, "documents")
    runs = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    return compare_with_next(documents, "doc_id", runs)
