"""Operator 6: shards by jump consistent hashing."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .tables import table

SHARDS = 24
# Fixed values of the published algorithm: multiplier of its generator, and 2 to the power 31.
_STEP, _SPAN = np.uint64(2862933555777941757), float(1 << 31)


def jump(keys: np.ndarray, shards: int) -> np.ndarray:
    """Shard of every 64-bit key: the last bucket, below ``shards``, that the key jumps to."""
    state = keys.astype(np.uint64)
    at = np.zeros(len(state), np.int64)
    ahead = np.zeros(len(state), np.int64)
    moving = np.ones(len(state), bool)
    with np.errstate(over="ignore"):
        while moving.any():
            at[moving] = ahead[moving]
            state[moving] = state[moving] * _STEP + np.uint64(1)
            draw = ((state[moving] >> np.uint64(33)) + np.uint64(1)).astype(np.float64)
            ahead[moving] = ((at[moving] + 1) * (_SPAN / draw)).astype(np.int64)
            moving &= ahead < shards
    return at


def shard_of(key: Column, shards: int) -> Column:
    """Shard of a key of any type, from its 64-bit hash alone; nulls share one shard."""

    @F.pandas_udf(T.IntegerType())
    def assign(hashed: pd.Series) -> pd.Series:
        return pd.Series(jump(hashed.to_numpy(np.int64).view(np.uint64), shards).astype(np.int32))

    return assign(F.xxhash64(key))


def with_shards(frame: DataFrame, key: str, shards: int = SHARDS, blocks: int = 1024) -> DataFrame:
    """The rows with ``shard``, ``slot`` and ``grown_shard`` (the shard were there one more).

    The key alone decides the shard, so rows can be placed one by one and no table of ranges is kept;
    one more shard takes 1/(n+1) of the keys, and only into itself. Slots number a shard's rows from 0:
    each shard is cut into ``blocks`` by another hash, a block's rows are numbered by key, and
    the counts of the blocks before are added, so no task sorts a whole shard. Repeated keys share a
    shard and get slots of their own; a null key is a key like others. Columns of these names in the
    input are replaced.
    """
    frame = frame.drop("shard", "slot", "grown_shard", "__block")
    placed = frame.select(
        "*", shard_of(F.col(key), shards).alias("shard"),
        shard_of(F.col(key), shards + 1).alias("grown_shard"),
        F.pmod(F.xxhash64(F.lit("slot"), F.col(key)), F.lit(blocks)).cast("int").alias("__block"))
    # One row per block of a shard: at most shards * blocks, whatever the input.
    before = placed.groupBy("shard", "__block").agg(F.count("*").alias("__n")).select(
        "shard", "__block",
        (F.sum("__n").over(Window.partitionBy("shard").orderBy("__block")) - F.col("__n"))
        .alias("__before"))
    in_block = F.row_number().over(Window.partitionBy("shard", "__block").orderBy(key)) - 1
    return (
        placed.withColumn("__place", in_block).join(before, ["shard", "__block"])
        .withColumn("slot", F.col("__before") + F.col("__place"))
        .drop("__block", "__before", "__place"))


def op6_jump_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's shard under the law ``key``."""
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    rows = table(spark, sf_dir, "documents").select(
        "doc_id", (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"), F.lit("key").alias("law"))
    return with_shards(rows, "doc_id").select(
        "doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")
