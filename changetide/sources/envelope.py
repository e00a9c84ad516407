"""Change envelopes, with the row before and after the change, as flat change rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.changes import DELETING_OP
from ..spec import DELETED, OP, SOURCE_TS, TABLE

_ENVELOPE = ["op", "before", "after", "table", "ts_ms"]


def flatten_envelope(envelopes: DataFrame, keep_tombstones: bool = True) -> DataFrame:
    """Row columns plus operation, table, source time and deletion flag.

    The row is the one after the change, or for a delete the one before it. A tombstone,
    an envelope without an operation, becomes a row of NULLs. Other columns stay.
    """
    extra = [c for c in envelopes.columns if c not in _ENVELOPE]
    if not keep_tombstones:
        envelopes = envelopes.filter(F.col("op").isNotNull())
    return envelopes.select(
        F.coalesce("after", "before").alias("row"),
        F.col("op").alias(OP),
        F.col("table").alias(TABLE),
        F.col("ts_ms").alias(SOURCE_TS),
        F.when(F.col("op").isNotNull(),
               F.when(F.col("op") == DELETING_OP, "true").otherwise("false")).alias(DELETED),
        *extra,
    ).select("row.*", OP, TABLE, SOURCE_TS, DELETED, *extra)
