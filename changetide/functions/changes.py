"""Predicates and ordering of changes, as plain column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..spec import BAD, BATCH, DELETE, DELETED, KIND, OFFSET, OP, PARTITION, SOURCE_TS, VALUE

ORDERED, DELETE_WINS = "ordered", "delete_wins"

# Operation codes that write a row, and the one that removes it.
WRITING_OPS = ["c", "u", "r"]
DELETING_OP = "d"

# SQL text rather than composed columns: one call into the JVM for a whole predicate.
# The comparisons never yield NULL, so that they can be negated.
_IS_DELETE = f"(coalesce({DELETED} = 'true', false) OR coalesce({OP} = '{DELETING_OP}', false))"
_IS_UPSERT = (
    f"(coalesce({DELETED} <> 'true', true) AND "
    f"coalesce({OP} IN ({', '.join(repr(op) for op in WRITING_OPS)}), false))"
)


def is_delete() -> Column:
    return F.expr(_IS_DELETE)


def is_upsert() -> Column:
    return F.expr(_IS_UPSERT)


def reject_reason(pk: str) -> Column:
    """Why a decoded message cannot be applied; NULL when it can. First match wins.

    A payload that is not wholly decodable is no reason by itself: one unreadable
    field leaves the others usable.
    """
    return F.expr(f"""
        CASE WHEN coalesce(trim({VALUE}), '') IN ('', 'null') THEN 'tombstone'
             WHEN {OP} IS NULL AND {DELETED} IS NULL AND {BAD} IS NOT NULL THEN 'malformed'
             WHEN {OP} IS NULL AND {DELETED} IS NULL THEN 'no_metadata'
             WHEN `{pk}` IS NULL THEN 'null_key'
             WHEN NOT {_IS_DELETE} AND NOT {_IS_UPSERT} THEN 'unknown_op' END""")


def arrival_order() -> list[Column]:
    """Source time, then broker position: time alone ties within a millisecond."""
    return [F.col(SOURCE_TS), F.col(PARTITION), F.col(OFFSET)]


def state_order(mode: str) -> list[Column]:
    """Columns whose greatest combination is the change that decides a key.

    ``ordered``      the newest change at the source.
    ``delete_wins``  the last batch that touches the key; in it any delete beats
                     the upserts, as when a batch applies upserts before deletes.
    """
    if mode == ORDERED:
        return arrival_order()
    if mode == DELETE_WINS:
        return [F.col(BATCH), (F.col(KIND) == DELETE).alias("__is_delete"), *arrival_order()]
    raise ValueError(f"unknown mode {mode!r}")
