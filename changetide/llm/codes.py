"""Operator 13: vectors as short codes, by codebooks that norm-of-sum bounds keep from being searched again and again."""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .tables import discarded, joined_by_key, stored, table

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
LARGEST = 1 << 25   # of a scaled component: squared distances then fit 64 bits for parts of up to 2,047 components
BLOCK = 1 << 21     # components of one block of differences
# What a task keeps of a part: its entry, a bound above its distance and one below that to all other entries, and each bound's round.
BOUND = np.dtype([("entry", "u1"), ("above_round", "u1"), ("below_round", "u1"), ("above", "<f4"), ("below", "<f4")])


def scaled(vectors: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """Components times ``scale``, rounded down."""
    found = np.floor(vectors.astype(np.float64) * scale)
    if found.size and np.abs(found).max() >= LARGEST:
        raise ValueError(f"a component is {LARGEST / scale:g} or more, which 64-bit sums of squares don't hold")
    return found.astype(np.int32)


def _squares(rows: np.ndarray, book: np.ndarray) -> np.ndarray:
    """Exact squared distances of parts from all entries."""
    out = np.empty((len(rows), len(book)), np.int64)
    step = max(1, BLOCK // max(book.size, 1))
    for i in range(0, len(rows), step):
        gap = rows[i:i + step, None, :].astype(np.int64) - book
        out[i:i + step] = np.einsum("ijk,ijk->ij", gap, gap)
    return out


def _own(rows: np.ndarray, book: np.ndarray, entry: np.ndarray) -> np.ndarray:
    gap = rows.astype(np.int64) - book[entry]
    return np.einsum("ij,ij->i", gap, gap)


def _up(square: np.ndarray) -> np.ndarray:
    return np.nextafter(np.sqrt(square).astype(np.float32), np.float32(np.inf))


def _down(square: np.ndarray) -> np.ndarray:
    return np.maximum(np.nextafter(np.sqrt(square).astype(np.float32), np.float32(0)), np.float32(0))


def shifts(books: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """How far each entry of one part is from where it was in each round, and the farthest of the others.

    A bound of round s holds now, widened by the length of the entry's whole way since: not by the sum of its steps,
    which is never shorter and often longer.
    """
    now = books[-1]
    gap = np.array(books) - now
    net = np.sqrt(np.einsum("sjk,sjk->sj", gap, gap).astype(np.float64))
    others = np.zeros_like(net)
    if len(now) > 1:
        order = np.argsort(net, axis=1)
        far, next_far = order[:, -1], np.take_along_axis(net, order[:, -2:-1], 1)
        others = np.where(np.arange(len(now)) == far[:, None], next_far, net.max(axis=1, keepdims=True))
    return net, others


def assign(rows: np.ndarray, bounds: np.ndarray | None, books: list[np.ndarray]) -> tuple[np.ndarray, int]:
    """Bounds that name every part's nearest entry in the last of ``books``, and how many parts were compared with all entries.

    ``rows`` are one position's parts, ``bounds`` what an earlier round found. A part keeps its entry if the bound above its distance, widened by
    the entry's net way, is below the bound of all others, narrowed by their longest net way; or else if its distance, taken
    anew, is. All other parts are compared with all entries. Bounds are rounded outwards, so that only a strictly nearest entry stays unseen;
    among equally near ones the lowest wins.
    """
    turn, book = len(books) - 1, books[-1]
    found = np.zeros(len(rows), BOUND) if bounds is None else bounds.copy()
    open_ = np.arange(len(rows))
    if bounds is not None:
        net, others = shifts(books)
        entry = found["entry"]
        below = found["below"] - others[found["below_round"], entry]
        open_ = np.flatnonzero(found["above"] + net[found["above_round"], entry] >= below)
        found["above"][open_] = _up(_own(rows[open_], book, entry[open_]))
        found["above_round"][open_] = turn
        open_ = open_[found["above"][open_] >= below[open_]]
    if len(open_):
        square = _squares(rows[open_], book)
        nearest = square.argmin(axis=1)
        found["entry"][open_], found["above"][open_] = nearest, _up(square.min(axis=1))
        if len(book) > 1:
            np.put_along_axis(square, nearest[:, None], np.iinfo(np.int64).max, 1)
        found["below"][open_] = _down(square.min(axis=1))
        found["above_round"][open_] = found["below_round"][open_] = turn
    return found, len(open_)


def _sums(rows: np.ndarray, entry: np.ndarray, entries: int) -> np.ndarray:
    """Sum of the parts of each entry, and behind it their number."""
    chosen = np.eye(entries)[entry]
    whole = np.concatenate([rows, np.ones((len(rows), 1))], axis=1)
    return np.rint(chosen.T @ whole).astype(np.int64)   # below 2**53, so exact in double precision


def _first(kept: DataFrame, entries: int, parts: int) -> np.ndarray:
    """Parts of the vectors of the least keys, by part and entry; of several vectors of a key the least."""
    keys = kept.filter("id is not null").select("id").distinct().orderBy("id").limit(entries)
    vectors = kept.join(F.broadcast(keys), "id").groupBy("id").agg(F.min("vector").alias("vector")).orderBy("id").collect()
    if not vectors:
        return np.empty((parts, 0, 0), np.int64)
    sizes = {len(r["vector"]) for r in vectors}
    if len(sizes) > 1 or sizes.pop() % parts:
        raise ValueError(f"vectors need one length, a multiple of {parts}")
    rows = scaled(np.array([r["vector"] for r in vectors]))
    return rows.reshape(len(rows), parts, -1).transpose(1, 0, 2).astype(np.int64)


def with_codes(frame: DataFrame, key: str, vector: str, label: str, parts: int = PARTS, entries: int = ENTRIES,
               rounds: int = ROUNDS) -> tuple[DataFrame, np.ndarray]:
    """One row per usable vector, ``key, label, code, error, label_error``, and the last codebooks by part and entry.

    Components become integers, floor(4096 x), and everything after that is exact. Each of the vector's equal ``parts`` has a codebook
    of its own, at first that part of the vectors with the least keys. A round assigns all parts to their nearest entries, the lower one of
    equally near ones, and replaces entries by the rounded-down means of their parts; entries without parts stay. After the last round parts
    are assigned once more. ``code`` has two hex digits a part, ``error`` is the sum of the squared distances and ``label_error`` its
    sum over rows with equal labels; null labels are equal.

    Rows are dropped whose vector is null, empty or holds null or non-finite components. Repeated rows count as often as they stand;
    a key that several vectors share begins a codebook with the least of them, and a null key with none. Fewer keys than ``entries`` make
    smaller codebooks, no usable vector an empty result; vectors without any key get no code and are dropped. Vectors of several
    lengths, lengths that ``parts`` doesn't divide and components of 8,192 or more are an error.

    Each round is one pass over a stored table of vectors and bounds. A task adds one row with its sums, so what is summed grows with the number of
    tasks, and only codebooks, whose size the vectors' length bounds, reach the driver. The table before is deleted when the next one stands.
    """
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    kept = frame.filter(F.col(vector).isNotNull()).filter((F.size(vector) > 0) & finite).select(
        F.col(key).alias("id"), F.col(label).alias("label"), F.col(vector).cast("array<double>").alias("vector"))
    history = [_first(kept, entries, parts)]
    kinds = kept.schema
    schema = T.StructType([kinds["id"], kinds["label"], T.StructField("raw", T.BinaryType()), T.StructField("bounds", T.BinaryType()),
                           T.StructField("sums", T.ArrayType(T.LongType()))])

    def assigned(batch: pa.RecordBatch, books: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Integers by row, part and component, and new bounds by row and part."""
        n, (_, size, width) = batch.num_rows, books[0].shape
        if "vector" in batch.schema.names:
            lists = batch.column("vector")
            if n and set(np.diff(lists.offsets.to_numpy())) != {parts * width}:
                raise ValueError(f"vectors need one length, a multiple of {parts}")
            rows, old = scaled(lists.flatten().to_numpy(zero_copy_only=False)), None
        else:
            rows = np.frombuffer(b"".join(batch.column("raw").to_pylist()), "<i4")
            old = np.frombuffer(b"".join(batch.column("bounds").to_pylist()), BOUND).reshape(n, parts)
        rows = rows.reshape(n, parts, width)
        new = np.empty((n, parts), BOUND)
        for p in range(parts):
            new[:, p], _ = assign(rows[:, p], None if old is None else old[:, p], [b[p] for b in books])
        return rows, new

    def turn(books: list[np.ndarray]):
        def each(batches):
            total, kind = 0, None
            for batch in batches:
                if not batch.num_rows:
                    continue
                rows, new = assigned(batch, books)
                kind = batch.schema
                total = total + np.array([_sums(rows[:, p], new[:, p]["entry"], books[0].shape[1]) for p in range(parts)])
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id"), batch.column("label"), pa.array([r.tobytes() for r in rows], pa.binary()),
                     pa.array([b.tobytes() for b in new], pa.binary()), pa.nulls(len(rows), pa.list_(pa.int64()))], schema.names)
            if kind is not None:
                yield pa.RecordBatch.from_arrays(
                    [pa.nulls(1, kind.field("id").type), pa.nulls(1, kind.field("label").type), pa.nulls(1, pa.binary()),
                     pa.nulls(1, pa.binary()), pa.array([total.ravel().tolist()], pa.list_(pa.int64()))], schema.names)
        return each

    def last(books: list[np.ndarray]):
        def each(batches):
            for batch in batches:
                rows, new = assigned(batch, books)
                chosen = new["entry"]
                error = sum(_own(rows[:, p], books[-1][p], chosen[:, p]) for p in range(parts))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id"), batch.column("label"), pa.array([bytes(c).hex() for c in chosen], pa.string()),
                     pa.array(error, pa.int64())], ["id", "label", "code", "error"])
        return each

    out = T.StructType([kinds["id"], kinds["label"], T.StructField("code", T.StringType()), T.StructField("error", T.LongType())])
    if not history[0].size:
        coded = kept.limit(0).select("id", "label", F.lit("").alias("code"), F.lit(0).cast("long").alias("error"))
        return _named(coded.withColumn("label_error", F.col("error")), key, label), history[0]
    rows, before = kept, None
    for _ in range(rounds):
        state = stored(rows.mapInArrow(turn(history), schema), "bounds")
        history.append(_moved(state, history[-1]))
        if before is not None:
            discarded(before)
        rows, before = state.filter("raw is not null").select("id", "label", "raw", "bounds"), state
    coded = stored(rows.mapInArrow(last(history), out), "codes")
    if before is not None:
        discarded(before)
    errors = stored(coded.groupBy("label").agg(F.sum("error").alias("label_error"), F.count("*").alias("n")), "label_errors")
    return _named(joined_by_key(coded, errors, "label", "n"), key, label), history[-1]


def _named(coded: DataFrame, key: str, label: str) -> DataFrame:
    return coded.select(F.col("id").alias(key), F.col("label").alias(label), "code", "error", "label_error")


def _moved(state: DataFrame, books: np.ndarray) -> np.ndarray:
    """The next codebooks, from the sums that tasks have left; one number a component reaches the driver."""
    parts, size, width = books.shape
    sums = state.filter("sums is not null").select(F.posexplode("sums").alias("place", "x")).groupBy("place").agg(F.sum("x").alias("x"))
    found: pd.DataFrame = sums.toPandas().sort_values("place")
    total = found["x"].to_numpy(np.int64).reshape(parts, size, width + 1)
    counts = total[:, :, -1:]
    return np.where(counts > 0, total[:, :, :-1] // np.maximum(counts, 1), books)


def books_digest(books: np.ndarray) -> str:
    """SHA-256 of all entries' components, by part, entry and place."""
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every usable embedding's code and error, and the digest of the codebooks."""
    coded, books = with_codes(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", "label")
    return coded.select("vec_id", "code", "error", "label_error", F.lit(books_digest(books)).alias("codebooks_sha256"))
