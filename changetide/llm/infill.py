"""Operator 12: texts rearranged for filling in the middle."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .tables import fresh, literal_text, pieces, table, utf8

SEED = 7
RATE = 100       # of 100 texts, how many are rearranged
SPM_RATE = 50    # of 100 rearranged texts, how many begin with the suffix
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"   # marks; no end of one is the beginning of another
BATCH_BYTES = 16 << 20                         # text that one step holds, unless a single text is longer
ROLES = 3
FOUND = ["n", "form", "prefix_chars", "middle_chars", "output"]


def _lists(values: pa.Array, parents: pa.Array, n: int) -> pa.Array:
    """One list for each of ``n`` parents from its values, which stand in order of their parents."""
    sizes = np.bincount(parents.to_numpy(zero_copy_only=False), minlength=n)
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()), values)


def _cut(text: pa.Array, hashes: list[pa.Array]) -> tuple[pa.Array, list[pa.Array]]:
    """Number of units of each text, and its prefix, middle and suffix.

    Units are lines with their ends. The texts become one list array, which is flattened; every piece knows its text and its place
    in it, places decide the role, and the pieces of a role are joined again.
    """
    lists = pc.split_pattern(text, "\n")
    piece, parent = pc.list_flatten(lists), pc.list_parent_indices(lists)
    first = pc.take(pa.array(lists.offsets.to_numpy()[:-1] - lists.offsets[0].as_py(), pa.int64()), parent)
    place = pc.subtract(pa.array(np.arange(len(piece)), pa.int64()), first)
    last = pc.equal(place, pc.subtract(pc.take(pc.list_value_length(lists), parent), 1))
    unit = pc.binary_join_element_wise(piece, pc.if_else(last, "", "\n"), "")
    real = pc.not_equal(unit, "")   # what follows the last line end is a unit only if it has text
    unit, parent, place = (pc.filter(x, real) for x in (unit, parent, place))
    n = pa.array(np.bincount(parent.to_numpy(zero_copy_only=False), minlength=len(text)), pa.int64())
    a, b = (_remainder(h, pc.add(n, 1)) for h in hashes)
    low, high = (pc.take(f(a, b), parent) for f in (pc.min_element_wise, pc.max_element_wise))
    role = pc.add(pc.cast(pc.greater_equal(place, low), pa.int8()), pc.cast(pc.greater_equal(place, high), pa.int8()))
    parts = []
    for r in range(ROLES):
        mine = pc.equal(role, r)
        parts.append(pc.binary_join(_lists(pc.filter(unit, mine), pc.filter(parent, mine), len(text)), ""))
    return n, parts


def _remainder(a: pa.Array, b) -> pa.Array:
    return pc.subtract(a, pc.multiply(pc.divide(a, b), b))


def rearranged(text: pa.Array, hashes: list[pa.Array], rate: int = RATE, spm_rate: int = SPM_RATE) -> pa.RecordBatch:
    """``n, form, prefix_chars, middle_chars, output`` of texts without nulls, given four hashes of each."""
    n, (prefix, middle, suffix) = _cut(text, hashes[:2])
    plain = pc.greater_equal(_remainder(hashes[2], 100), rate)
    plain = pc.or_(plain, pc.equal(text, ""))
    for mark in (PREFIX, SUFFIX, MIDDLE):
        plain = pc.or_(plain, pc.match_substring(text, mark))
    spm = pc.less(_remainder(hashes[3], 100), spm_rate)
    form = pc.if_else(plain, "plain", pc.if_else(spm, "spm", "psm"))
    psm = pc.binary_join_element_wise(PREFIX, prefix, SUFFIX, suffix, MIDDLE, middle, "")
    spm_text = pc.binary_join_element_wise(SUFFIX, suffix, PREFIX, prefix, MIDDLE, middle, "")
    output = pc.if_else(plain, text, pc.if_else(spm, spm_text, psm))
    chars = [pc.if_else(plain, pa.scalar(None, pa.int64()), pc.cast(pc.utf8_length(x), pa.int64())) for x in (prefix, middle)]
    return pa.RecordBatch.from_arrays([n, form, *chars, output], FOUND)


def rebuilt(output: pa.Array, form: pa.Array) -> pa.Array:
    """The texts that were rearranged, from the outputs and forms alone."""
    def after(rows: pa.Array, mark: str) -> tuple[pa.Array, pa.Array]:
        halves = pc.split_pattern(rows, mark, max_splits=1)
        return pc.list_element(halves, 0), pc.list_element(halves, 1)

    found = pa.array([None] * len(output), output.type)
    for name, between, order in (("psm", SUFFIX, (0, 2, 1)), ("spm", PREFIX, (1, 2, 0))):
        mine = pc.equal(form, name)
        rows = pc.utf8_slice_codeunits(pc.filter(output, mine), len(PREFIX))   # all marks are as long
        one, rest = after(rows, between)
        two, three = after(rest, MIDDLE)
        parts = (one, two, three)
        found = pc.replace_with_mask(found, mine, pc.binary_join_element_wise(*(parts[i] for i in order), ""))
    return pc.if_else(pc.equal(form, "plain"), output, found)


def _runs(batch: pa.RecordBatch, column: int) -> Iterator[pa.RecordBatch]:
    """The batch in runs of whole texts."""
    _, bounds = utf8(batch.column(column))
    for first, end in pieces(bounds, BATCH_BYTES):
        yield batch.slice(first, end - first)


def _added(docs: DataFrame, more: list[tuple[str, T.DataType]], function) -> DataFrame:
    """The frame with columns that a function makes of its last ones, run by run; those last ones go."""
    taken = len(docs.columns)

    def each(batches):
        for batch in batches:
            if batch.num_rows:
                for run in _runs(batch, taken - 1):
                    yield function(run)

    return docs.mapInArrow(each, T.StructType([T.StructField(*column) for column in more]))


def with_infill(docs: DataFrame, key: str, text: str = "text", seed: int = SEED, rate: int = RATE,
                spm_rate: int = SPM_RATE) -> DataFrame:
    """The documents with ``n``, ``form``, ``prefix_chars``, ``middle_chars`` and ``output``, the text rearranged.

    A text's ``n`` lines are cut into prefix, middle and suffix at two places drawn from the key. Form ``psm`` is
    ``<P>prefix<S>suffix<M>middle``, ``spm`` is ``<S>suffix<P>prefix<M>middle``, and ``plain`` the text itself: of empty texts, of those
    that hold one of the marks, and of ``100 - rate`` in a hundred others; its two lengths are null.

    A null text is an empty one, a null key draws as an empty key. Rows are independent of each other, so equal keys draw alike and
    nothing is shuffled. Input columns named as an output are replaced; all others stay.
    """
    docs = docs.drop(*FOUND)
    drawn = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit(""))).cast("binary"), 256)
    names = [fresh(docs, f"hash{i}") for i in range(4)]
    whole = fresh(docs, "whole")
    hashes = [F.conv(F.substring(drawn, 8 * i + 1, 8), 16, 10).cast("long").alias(n) for i, n in enumerate(names)]
    ready = docs.select("*", *hashes, literal_text(text).alias(whole))
    kept = [(f.name, f.dataType) for f in docs.schema]
    kinds = [T.LongType(), T.StringType(), T.LongType(), T.LongType(), T.StringType()]

    def function(run: pa.RecordBatch) -> pa.RecordBatch:
        columns = run.columns
        found = rearranged(pc.cast(columns[-1], pa.string()), columns[-5:-1], rate, spm_rate)
        return pa.RecordBatch.from_arrays([*columns[:-5], *found.columns], [n for n, _ in kept] + FOUND)

    return _added(ready, kept + list(zip(FOUND, kinds)), function)


def restored(docs: DataFrame, output: str = "output", form: str = "form", into: str = "restored") -> DataFrame:
    """The rows with the text that each output was made of; a column named ``into`` is replaced."""
    docs = docs.drop(into)
    ready = docs.select("*", F.col(form).alias(fresh(docs, "form_")), F.col(output).alias(fresh(docs, "output_")))
    kept = [(f.name, f.dataType) for f in docs.schema]

    def function(run: pa.RecordBatch) -> pa.RecordBatch:
        columns = run.columns
        text = rebuilt(pc.cast(columns[-1], pa.string()), pc.cast(columns[-2], pa.string()))
        return pa.RecordBatch.from_arrays([*columns[:-2], text], [n for n, _ in kept] + [into])

    return _added(ready, [*kept, (into, T.StringType())], function)


def op12_infill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document rearranged, and its text rebuilt from that."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    made = with_infill(docs, "doc_id").drop("text")

    def digest(column: str):
        return F.sha2(F.col(column).cast("binary"), 256).alias(f"{column}_sha256")

    digested = made.select("*", digest("output"))
    return restored(digested).select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", digest("restored"))


def _hash_sql(number: int) -> str:
    return f"CAST('0x' || substr(h, {8 * number + 1}, 8) AS BIGINT) AS h{number + 1}"


OP12_SQL = rf"""
WITH docs AS (
  SELECT doc_id, coalesce(text, '') AS t, sha256('{SEED}:' || doc_id) AS h,
         regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS units FROM documents),
drawn AS (SELECT doc_id, t, units, len(units) AS n, {", ".join(map(_hash_sql, range(4)))} FROM docs),
placed AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
         CASE WHEN t = '' OR contains(t, '{PREFIX}') OR contains(t, '{SUFFIX}') OR contains(t, '{MIDDLE}') OR h3 % 100 >= {RATE}
              THEN 'plain' WHEN h4 % 100 < {SPM_RATE} THEN 'spm' ELSE 'psm' END AS form FROM drawn),
parts AS (
  SELECT doc_id, t, n, form, coalesce(array_to_string(units[1:a], ''), '') AS p, coalesce(array_to_string(units[a + 1:b], ''), '') AS m,
         coalesce(array_to_string(units[b + 1:n], ''), '') AS s FROM placed)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '{PREFIX}' || p || '{SUFFIX}' || s || '{MIDDLE}' || m
              ELSE '{SUFFIX}' || s || '{PREFIX}' || p || '{MIDDLE}' || m END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM parts"""
