"""Comparison of two large tables that mostly agree, by checksums of key ranges."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .reconcile import reconcile

# Ranges that a range is split into at each step, and how many differing ones are followed at all.
FANOUT = 256
FOLLOWED = 4096

# Intervals that become a filter on the key, which a scan can use; more are looked up as a table.
INTERVALS = 64

_HALF = (1 << 32) - 1

# Keys beyond are placed by their hash, so that differences of places fit 64 bits.
FARTHEST = 1 << 60


def _place(rows: DataFrame, pk: str) -> Column:
    """A whole number for the key: the key itself, or a hash of one that is no number or too large to be counted from another."""
    hashed = F.pmod(F.xxhash64(pk), F.lit(1 << 31))
    if not isinstance(rows.schema[pk].dataType, T.IntegralType):
        return F.when(F.col(pk).isNotNull(), hashed)
    key = F.col(pk).cast("long")
    return F.when(key.between(-FARTHEST, FARTHEST), key).when(key.isNotNull(), hashed + F.lit(FARTHEST))


def _sums(columns: list[str]) -> list[Column]:
    """Number of rows, and sums of two hashes of theirs in halves, which no number of rows a range has can overflow.

    Sums don't depend on the order of the rows, and unlike exclusive or they count repeated rows.
    """
    halves = []
    for i, hashed in enumerate((F.xxhash64(F.lit(1), *columns), F.xxhash64(F.lit(2), *[F.struct(c) for c in columns]))):
        halves += [F.sum(hashed.bitwiseAND(F.lit(_HALF))).alias(f"low{i}"),
                   F.sum(F.shiftrightunsigned(hashed, 32)).alias(f"high{i}")]
    return [F.count("*").alias("n"), *halves]


@dataclass(frozen=True)
class Ranges:
    """Equal ranges of numbers from ``low`` on, and which of them are meant."""

    low: int
    width: int
    slots: tuple[int, ...]

    def slot(self, place: Column) -> Column:
        return F.call_function("div", place - F.lit(self.low), F.lit(self.width))

    def intervals(self) -> list[tuple[int, int]]:
        """First and last number of the meant ranges, neighbours as one."""
        out: list[tuple[int, int]] = []
        for slot in self.slots:
            first = self.low + slot * self.width
            if out and out[-1][1] + 1 == first:
                out[-1] = out[-1][0], first + self.width - 1
            else:
                out.append((first, first + self.width - 1))
        return out

    def hold(self, place: Column) -> Column:
        """Whether a number lies in a meant range. A few intervals can be pushed into the scan."""
        intervals = self.intervals()
        if not intervals:
            return F.lit(False)
        if len(intervals) <= INTERVALS:
            return reduce(or_, [place.between(a, b) for a, b in intervals])
        return place.between(intervals[0][0], intervals[-1][1]) & self.slot(place).isin(list(self.slots))


def held(found: Ranges, rows: DataFrame, pk: str) -> Column:
    """Whether a row's key lies in a meant range; on the key itself where that says the same, so that a scan can use it."""
    intervals = found.intervals()
    if (isinstance(rows.schema[pk].dataType, T.IntegralType) and len(intervals) <= INTERVALS
            and all(-FARTHEST <= a and b <= FARTHEST for a, b in intervals)):
        return found.hold(F.col(pk).cast("long"))
    return found.hold(_place(rows, pk))


def differing(source: DataFrame, replica: DataFrame, pk: str, fanout: int = FANOUT, followed: int = FOLLOWED) -> Ranges:
    """Key ranges outside which both tables have the same rows, null keys aside.

    All ranges of a step are compared at once: one aggregation on each side, which sends a few numbers a range, and is done
    before the shuffle. Only ranges that differ are split further, until they hold single numbers, are too many to be
    followed, or hold more than half of what the step before held.
    """
    columns = sorted(source.columns)
    sides = [rows.select(*columns, _place(rows, pk).alias("__place")) for rows in (source, replica)]
    ends = [x for rows in sides for x in rows.agg(F.min("__place"), F.max("__place")).first() if x is not None]
    if not ends:
        return Ranges(0, 1, ())
    low, width = min(ends), max(ends) - min(ends) + 1
    found, place = Ranges(low, width, (0,)), F.col("__place")
    while found.width > 1:
        step = Ranges(low, -(-found.width // fanout), ())
        here, there = (
            rows.filter(held(found, rows, pk)).groupBy(step.slot(place).alias("slot")).agg(*_sums(columns))
            .select("slot", F.struct("n", "low0", "high0", "low1", "high1").alias(side))
            for rows, side in zip(sides, ("here", "there")))
        uneven = here.join(there, "slot", "full_outer").filter(~F.col("here").eqNullSafe(F.col("there"))).select("slot")
        # One more than are followed tells that there are more.
        slots = sorted(row[0] for row in uneven.limit(followed + 1).collect())
        if len(slots) > followed:
            break
        before, found = found, Ranges(low, step.width, tuple(slots))
        if not slots or 2 * len(slots) * found.width > len(before.slots) * before.width:
            break
    return found


def reconcile_by_checksum(source: DataFrame, replica: DataFrame, pk: str, unique_keys: bool = False,
                          fanout: int = FANOUT, followed: int = FOLLOWED) -> DataFrame:
    """Each key with its status, as :func:`reconcile` tells it, for tables that mostly agree.

    Checksums find the key ranges that differ; only their rows, and rows without a key, are compared one by one. All other keys are
    equal, and listed from the source alone. Ranges are told by two 64-bit hashes of all their rows.
    """
    if sorted(source.columns) != sorted(replica.columns):
        raise ValueError(f"columns differ: {source.columns} and {replica.columns}")
    found = differing(source, replica, pk, fanout, followed)

    def open_(rows: DataFrame) -> Column:
        return held(found, rows, pk) | F.col(pk).isNull()

    compared = reconcile(source.filter(open_(source)), replica.filter(open_(replica)), pk, unique_keys)
    rest = source.filter(~open_(source)).select(pk)
    same = rest if unique_keys else rest.distinct()
    return compared.unionByName(same.withColumn("status", F.lit("equal")))
