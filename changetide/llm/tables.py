"""Small helpers that the operators share: reading, storing, and Arrow batches as numpy."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.paths import input_files, remove, scratch_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Settings of Spark that hold while a table is stored: an execution's shuffle files are deleted when it ends.
_SETTINGS = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}

# Paths of the stored tables of every open ``temporary`` block, the innermost last.
_scratch: list[list[str]] = []


# Settings for wide rows: at most some megabytes go to Python at once, however long the rows are.
_SMALL_BATCHES = {"spark.sql.execution.arrow.maxBytesPerBatch": str(8 << 20)}


def small_batches(spark: SparkSession):
    """A block whose stored tables are made from small batches."""
    return _settings(spark, _SMALL_BATCHES)


@contextmanager
def _settings(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    before = {name: spark.conf.get(name, None) for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def stored(frame: DataFrame, name: str, keep: bool = False) -> DataFrame:
    """The frame written once to the shared folder, so that no lost executor makes it run again.

    Its shuffle files are deleted as soon as it is written. In a ``temporary`` block the table goes with the block, or
    with the one around it if it is to be kept.
    """
    spark = frame.sparkSession
    path = scratch_dir(spark, name)
    with _settings(spark, _SETTINGS):
        frame.write.parquet(path)
    if len(_scratch) > keep:
        _scratch[-1 - keep].append(path)
    return spark.read.schema(frame.schema).parquet(path)


@contextmanager
def temporary(spark: SparkSession) -> Iterator[None]:
    """A block whose stored tables are deleted when it ends. What is used after it must be stored in it, with ``keep``."""
    _scratch.append([])
    try:
        yield
    finally:
        for path in _scratch.pop():
            remove(spark, path, recursive=True)


def discarded(frame: DataFrame) -> None:
    """Delete a stored table that nothing reads any more."""
    for path in input_files(frame)[:1]:
        remove(frame.sparkSession, path.rsplit("/", 1)[0], recursive=True)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string column, one text behind the other, and where each text begins and ends.

    A null text has no bytes.
    """
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    size = len(column) + 1
    bounds = np.frombuffer(column.buffers()[1], np.int64, size, column.offset * 8)
    data = column.buffers()[2]
    if data is None or bounds[-1] == bounds[0]:
        return np.empty(0, np.uint8), np.zeros(size, np.int64)
    flat = np.frombuffer(data, np.uint8)[bounds[0]:bounds[-1]]
    return flat, bounds - bounds[0]


def pieces(bounds: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Runs of whole texts of about ``most`` bytes; a longer text is a run of its own."""
    first, last = 0, len(bounds) - 1
    while first < last:
        end = int(np.searchsorted(bounds, bounds[first] + most, side="right")) - 1
        end = min(max(end, first + 1), last)
        yield first, end
        first = end


def mixed(values: np.ndarray, salt: int = 0) -> np.ndarray:
    """Spread 64-bit values evenly (the finishing steps of a splitmix generator)."""
    with np.errstate(over="ignore"):
        x = values.astype(np.uint64) + np.uint64((0x9E3779B97F4A7C15 * (salt + 1)) & (2**64 - 1))
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def let_go() -> None:
    """Freed memory back to the system: Arrow's pool and the C library keep it otherwise."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)   # of glibc only
    if trim:
        trim(0)


def frugal(work: Callable) -> Callable:
    """A task's function that lets go of its memory at the end: the worker stays for tasks of other kinds, beside the executor's own heap."""

    def frugally(batches):
        try:
            yield from work(batches)
        finally:
            let_go()

    return frugally


def fresh(frame: DataFrame, name: str) -> str:
    """The name, with underscores added until no column of the frame has it."""
    taken = {c.lower() for c in frame.columns}
    while name.lower() in taken:
        name += "_"
    return name


def literal_text(column: str):
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def joined_by_key(rows: DataFrame, facts: DataFrame, key: str, n: str, share: int = 1024) -> DataFrame:
    """Rows of a stored table with the facts about their key, for keys that have facts; null keys match each other.

    ``facts`` is stored too and has one row a key, with the number ``n`` of its rows. Keys with more than one in ``share`` of all these rows
    are fewer than ``share``, whatever the size, so they go to every task and their rows stay where they are; the rows of no other key
    can fill a task.
    """
    most = (facts.agg(F.sum(n)).first()[0] or 0) / share
    names, own = rows.columns, [c for c in facts.columns if c != key]
    there = facts.withColumnRenamed(key, "__key")
    hot, cold = there.filter(F.col(n) > most), there.filter(F.col(n) <= most)
    equal = F.col(key).eqNullSafe(F.col("__key"))
    out = [*names, *own]
    others = rows.join(F.broadcast(hot.select("__key")), equal, "left_anti")
    return rows.join(F.broadcast(hot), equal).select(*out).unionByName(others.join(cold, equal).select(*out))
