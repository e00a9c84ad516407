"""Merges in snapshot form: a table and the rows to apply to it."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_ROW = "__row"


def one_per_key(rows: DataFrame, pk: str, order: Sequence[str] | None = None) -> DataFrame:
    """One row per key: the greatest by ``order``, or an error where a key repeats. Rows without a key all stay.

    Rows are reduced before the shuffle, so a key that fills a third of the input
    reaches its reducer as one row per map task.
    """
    names = rows.columns
    rest = [c for c in names if c != pk]
    rows, keyless = rows.filter(F.col(pk).isNotNull()), rows.filter(F.col(pk).isNull())
    keyed = rows.groupBy(pk)
    if order:
        packed = F.struct(*[F.col(c).alias(f"__by{i}") for i, c in enumerate(order)], *rest)
        found = keyed.agg(F.max(packed).alias(_ROW))
    else:
        repeated = F.concat(F.lit(f"several rows for {pk} = "), F.col(pk).cast("string"))
        found = keyed.agg(F.first(F.struct(*rest)).alias(_ROW), F.count("*").alias("n")).withColumn(
            _ROW, F.when(F.col("n") == 1, F.col(_ROW))
                   .otherwise(F.raise_error(repeated)))
    return found.select(*[F.col(c) if c == pk else F.col(_ROW)[c].alias(c) for c in names]).unionByName(keyless)


def merge_upsert(target: DataFrame, source: DataFrame, pk: str,
                 order: Sequence[str] | None = None) -> DataFrame:
    """Replace the target's rows that the source has too, add the others.

    Without ``order`` a key may occur once in the source; a repeated key is an error
    rather than a silent choice. The target is shuffled only if Spark finds the source's
    keys too large to send to every task.
    """
    fresh = one_per_key(source, pk, order).select(*target.columns)
    return target.join(source.select(pk).distinct(), pk, "left_anti").select(
        *target.columns).unionByName(fresh)


def merge_delete(target: DataFrame, keys: DataFrame, pk: str) -> DataFrame:
    return target.join(keys.select(pk).distinct(), pk, "left_anti").select(*target.columns)


def insert_if_absent(target: DataFrame, source: DataFrame, pk: str,
                     order: Sequence[str] | None = None) -> DataFrame:
    """Add source rows whose key the target lacks; the least by ``order`` wins among copies.
    Rows without a key match nothing, so all of them are added.

    The keys both sides share are found first. That join may send the small source to the
    target's tasks, where comparing the source with the target's keys could not.
    """
    names = target.columns
    incoming = source.select(*names)
    if order:
        rest = [c for c in names if c != pk]
        packed = F.struct(*[F.col(c).alias(f"__by{i}") for i, c in enumerate(order)], *rest)
        incoming = source.filter(F.col(pk).isNotNull()).groupBy(pk).agg(F.min(packed).alias(_ROW)).select(
            *[F.col(c) if c == pk else F.col(_ROW)[c].alias(c) for c in names]).unionByName(
                incoming.filter(F.col(pk).isNull()))
    else:
        incoming = one_per_key(incoming, pk)
    shared = target.select(pk).join(source.select(pk).distinct(), pk, "left_semi")
    return target.unionByName(incoming.join(shared.distinct(), pk, "left_anti").select(*names))


def update_where(rows: DataFrame, condition: Column, values: Mapping[str, object]) -> DataFrame:
    """Set columns where the condition is true; elsewhere, and where it is NULL, keep them."""
    types = {f.name: f.dataType for f in rows.schema.fields}
    new = {name: value if isinstance(value, Column) else F.lit(value)
           for name, value in values.items()}
    return rows.withColumns({
        name: F.when(condition, value.cast(types[name])).otherwise(F.col(name))
        for name, value in new.items()})


def doomed_rows(rows: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """The rows that have one of the keys; a row with very many equals is split by the adaptive skew join."""
    return rows.join(keys.select(key).distinct(), key, "left_semi").select(*rows.columns)


def cascade_delete(parent: DataFrame, child: DataFrame, keys: DataFrame, pk: str,
                   fk: str) -> tuple[DataFrame, DataFrame]:
    """Remove parents by key and the children that refer to them.

    Both joins keep the big side's rows where they are if the keys are few; otherwise
    a parent with very many children is split by the adaptive skew join.
    """
    doomed = keys.select(F.col(pk)).distinct()
    children = child.join(doomed.withColumnRenamed(pk, fk), fk, "left_anti").select(*child.columns)
    return parent.join(doomed, pk, "left_anti").select(*parent.columns), children
