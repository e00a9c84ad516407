"""From raw messages to classified changes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.changes import is_delete, reject_reason
from ..spec import (
    BAD, BROKER_TS, DELETE, KIND, META_FIELDS, OFFSET, PARTIAL, PARTITION, REASON, REJECT, REST, UPSERT,
    VALUE, TableSpec,
)

_MESSAGE_COLUMNS = {"value", "ts", "topic", "partition", "offset"}


def decode(messages: DataFrame, spec: TableSpec) -> DataFrame:
    """Row and metadata columns of each message; columns beyond the message frame stay.

    Decoding never fails: unreadable text and unreadable fields become NULL, and
    the text is kept in ``__bad``. Exploding a one-element array keeps later filters
    above the decoding; pushed below it, they would decode the text again for every field.
    """
    extra = [c for c in messages.columns if c not in _MESSAGE_COLUMNS]
    rest = [_unknown(spec).alias(REST)] if spec.keep_unknown else []
    payload = F.from_json("value", spec.payload_schema, {"columnNameOfCorruptRecord": BAD})
    return messages.select(
        F.explode(F.array(payload)).alias("payload"),
        F.col("ts").alias(BROKER_TS),
        F.col("partition").alias(PARTITION),
        F.col("offset").alias(OFFSET),
        F.col("value").alias(VALUE),
        *rest,
        *extra,
    ).select("payload.*", BROKER_TS, PARTITION, OFFSET, VALUE, *[REST for _ in rest], *extra)


def _unknown(spec: TableSpec) -> Column:
    """Fields of the payload that the schema doesn't name, as JSON with their types; NULL if there are none."""
    named = [*spec.columns, *(f.name for f in META_FIELDS)]
    fields = F.from_json("value", "map<string, variant>")
    rest = F.map_filter(fields, lambda name, _: ~name.isin(named))
    return F.when(F.size(rest) > 0, F.to_json(rest))


def widened(rows: DataFrame, spec: TableSpec) -> DataFrame:
    """Stored rows whose columns also take what was unknown when they were written."""
    if not spec.keep_unknown:
        return rows
    known = T.StructType([f for f in spec.schema if f.name != spec.pk])
    found = F.from_json(REST, known)
    return rows.withColumns({f.name: F.coalesce(F.col(f.name), found[f.name]) for f in known})


def classify(decoded: DataFrame, spec: TableSpec) -> DataFrame:
    """Add ``__kind`` (upsert, delete, reject), the reject reason, and the partial flag.

    The payload text is dropped from changes: only a reject needs it later.
    """
    rejected = f"{REASON} IS NOT NULL"
    return (
        decoded.withColumns({REASON: reject_reason(spec.pk), KIND: is_delete()})
        .withColumns({
            KIND: F.expr(f"CASE WHEN {rejected} THEN '{REJECT}' "
                         f"WHEN {KIND} THEN '{DELETE}' ELSE '{UPSERT}' END"),
            PARTIAL: F.expr(f"{REASON} IS NULL AND {BAD} IS NOT NULL"),
            VALUE: F.expr(f"CASE WHEN {rejected} THEN {VALUE} END"),
        })
        .drop(BAD)
    )


def changes(classified: DataFrame) -> DataFrame:
    return classified.filter(F.col(KIND) != REJECT)


def rejects(classified: DataFrame) -> DataFrame:
    return classified.filter(F.col(KIND) == REJECT).select(
        F.col(REASON).alias("reason"), F.col(VALUE).alias("value"))


def reject_summary(classified: DataFrame) -> DataFrame:
    """Messages that were not applied, counted by reason."""
    return rejects(classified).groupBy("reason").agg(F.count("*").alias("n_messages"))


def to_messages(rows: DataFrame, spec: TableSpec, topic: str) -> DataFrame:
    """Change rows as messages, the inverse of :func:`decode`.

    Row and metadata columns go into the JSON text; ``__partition``, ``__offset``
    and ``__broker_ts`` become the message's position. Other columns stay.
    """
    payload = [c for c in [*spec.columns, *(f.name for f in META_FIELDS)] if c in rows.columns]
    position = {"ts": (BROKER_TS, "timestamp"), "partition": (PARTITION, "int"),
                "offset": (OFFSET, "long")}
    used = {*payload, *(source for source, _ in position.values())}
    return rows.select(
        F.to_json(F.struct(*payload)).alias("value"),
        *[(F.col(source) if source in rows.columns else F.lit(None)).cast(kind).alias(name)
          for name, (source, kind) in position.items()],
        F.lit(topic).alias("topic"),
        *[c for c in rows.columns if c not in used],
    ).select("value", "ts", "topic", "partition", "offset",
             *[c for c in rows.columns if c not in used])
