"""Comparison of a source table with its replica."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_SOURCE, _REPLICA = "__n_source", "__n_replica"


def reconcile(source: DataFrame, replica: DataFrame, pk: str,
              unique_keys: bool = False) -> DataFrame:
    """Each key with its status: equal, different, missing (in the replica) or extra.

    A key is equal when both sides hold the same rows equally often, NULLs being equal.
    Where the key is unique on both sides, as a primary key is, say so: one join is enough
    and about twice as fast.
    """
    if sorted(source.columns) != sorted(replica.columns):
        raise ValueError(f"columns differ: {source.columns} and {replica.columns}")
    return (_joined if unique_keys else _counted)(source, replica, pk)


def _joined(source: DataFrame, replica: DataFrame, pk: str) -> DataFrame:
    rest = [c for c in source.columns if c != pk]
    here = source.withColumn(_SOURCE, F.lit(True)).alias("here")
    there = replica.withColumn(_REPLICA, F.lit(True)).alias("there")
    same = reduce(and_, [F.col(f"here.{c}").eqNullSafe(F.col(f"there.{c}")) for c in rest], F.lit(True))
    key_here, key_there = F.col(f"here.{pk}"), F.col(f"there.{pk}")
    return here.join(there, key_here == key_there, "full_outer").select(
        F.coalesce(key_here, key_there).alias(pk),
        F.when(F.col(_REPLICA).isNull(), "missing").when(F.col(_SOURCE).isNull(), "extra")
         .when(same, "equal").otherwise("different").alias("status"))


def _counted(source: DataFrame, replica: DataFrame, pk: str) -> DataFrame:
    """By counting equal rows, where a join would meet every pair of a repeated key.

    A frequent key is spread over many tasks, and both aggregations begin before the shuffle.
    """
    both = source.withColumns({_SOURCE: F.lit(1), _REPLICA: F.lit(0)}).unionByName(
        replica.withColumns({_SOURCE: F.lit(0), _REPLICA: F.lit(1)}))
    rows = both.groupBy(*source.columns).agg(
        F.sum(_SOURCE).alias(_SOURCE), F.sum(_REPLICA).alias(_REPLICA))
    keys = rows.groupBy(pk).agg(
        F.sum(_SOURCE).alias(_SOURCE), F.sum(_REPLICA).alias(_REPLICA),
        F.bool_and(F.col(_SOURCE) == F.col(_REPLICA)).alias("same"))
    return keys.select(
        pk,
        F.when(F.col(_REPLICA) == 0, "missing").when(F.col(_SOURCE) == 0, "extra")
         .when(F.col("same"), "equal").otherwise("different").alias("status"))


def reconcile_summary(source: DataFrame, replica: DataFrame, pk: str,
                      unique_keys: bool = False) -> DataFrame:
    return reconcile(source, replica, pk, unique_keys).groupBy("status").agg(
        F.count("*").alias("n_keys"))


def verify_rows(source: DataFrame, replica: DataFrame, pk: str, column: str) -> DataFrame:
    """One column of each key on both sides, and whether the replica has caught up: as many rows, the same greatest value."""
    def side(rows: DataFrame, name: str) -> DataFrame:
        return rows.select(pk, F.lit(name).alias("side"), F.col(column).alias("v"))

    def of(name: str) -> Column:
        return F.max(F.when(F.col("side") == name, F.col("v")))

    both = side(source, "source").unionByName(side(replica, "replica"))
    return both.groupBy(pk).agg(
        of("source").alias("source_value"), of("replica").alias("replica_value"),
        F.count_if(F.col("side") == "source").alias("here"),
        F.count_if(F.col("side") == "replica").alias("there"),
    ).select(pk, "source_value", "replica_value",
             ((F.col("here") > 0) & (F.col("here") == F.col("there"))
              & F.col("source_value").eqNullSafe(F.col("replica_value"))).alias("in_sync"))


def verify_key(source: DataFrame, replica: DataFrame, pk: str, key: object,
               column: str) -> DataFrame:
    """The same for one key, looked up on both sides."""
    wanted = F.col(pk) == F.lit(key)
    return verify_rows(source.filter(wanted), replica.filter(wanted), pk, column)
