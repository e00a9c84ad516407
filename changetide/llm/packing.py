"""Operator 2: token ids packed into rows of one length by best-fit-decreasing."""

from __future__ import annotations

import base64

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import table
from .words import encoded

ROW = 2048            # ids of a row
END = 50256           # the id after each document, free in the vocabulary; it also fills the ends of rows
GATHERED = 1 << 21    # ids that are packed together


class Capacities:
    """A segment tree over rows, by the room they have left: finds a row with the least room that suffices."""

    def __init__(self, row: int):
        self.size = 1 << row.bit_length()
        self.tree = np.zeros(2 * self.size, np.int32)   # how many rows have each room, and sums of those
        self.rows: list[list[int]] = [[] for _ in range(row + 1)]
        self.top = row

    def add(self, room: int, row: int) -> None:
        self.rows[room].append(row)
        at = room + self.size
        while at:
            self.tree[at] += 1
            at >>= 1

    def take(self, least: int) -> tuple[int, int] | None:
        """Remove a row with the smallest room of ``least`` or more; its room and the row."""
        at = least + self.size
        if not self.tree[at]:
            # Up to the first right neighbour that holds a row, then down to its leftmost one.
            while at > 1 and (at & 1 or not self.tree[at + 1]):
                at >>= 1
            if at <= 1:
                return None
            at += 1
            while at < self.size:
                at = 2 * at if self.tree[2 * at] else 2 * at + 1
        room = at - self.size
        while at:
            self.tree[at] -= 1
            at >>= 1
        return room, self.rows[room].pop()


def best_fit(lengths: np.ndarray, row: int) -> np.ndarray:
    """Row of every piece: longest first, each into the fullest row that has room for it, else a new one."""
    rooms, out, rows = Capacities(row), np.empty(len(lengths), np.int64), 0
    for i in np.argsort(-lengths, kind="stable"):
        found = rooms.take(int(lengths[i]))
        if found is None:
            found, rows = (row, rows), rows + 1
        room, out[i] = found
        if room > lengths[i]:
            rooms.add(room - int(lengths[i]), int(out[i]))
    return out


def _ids_of(text: str, encoder, end: int) -> np.ndarray:
    return np.array([*encoded(encoder.encode_ordinary, text), end], np.uint16)


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def pack(frame: DataFrame, key: str, text: str = "text", row: int = ROW, end: int = END,
         gathered: int = GATHERED, vocabulary: str | None = None) -> DataFrame:
    """Rows of a matrix of ids, each with its segments, so that every id of every text is in exactly one place.

    Each text becomes its ids and one end id; a null text counts as empty. A text longer than a row is split into
    whole rows and a rest, and ``parts`` says which place each piece has in its document, so nothing is lost and
    documents can be put together again. Pieces are gathered in each task up to ``gathered`` ids, then packed:
    memory is bounded by that and by the longest text, and no text is sent between tasks. Columns:

    * ``block`` and ``row``: the task's gathering (its partition and number) and the row in it;
    * ``ids``: ``row`` ids as little-endian unsigned 16-bit integers, filled up with the end id;
    * ``cu_seqlens``: 0 and the running sum of segment lengths, the filling being none of them;
    * ``positions``: places counted anew from 0 in each segment (and in the filling), in the same binary form;
    * ``doc_ids``, ``parts``, ``starts``: for each segment its document, piece number and first id in the document.

    Repeated and null keys are packed like others. An empty table gives no rows.
    """
    if not 1 < row < 1 << 16:
        raise ValueError("a row holds 2 to 65,535 ids")
    with open(vocabulary or default_vocabulary(), "rb") as file:
        described = frame.sparkSession.sparkContext.broadcast(file.read())

    def work(batches):
        import public_tokenizers
        import tiktoken
        from pyspark import TaskContext

        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, described.value.splitlines())}
        encoder = tiktoken.Encoding("packing", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        partition, blocks, held, total = TaskContext.get().partitionId(), 0, [], 0
        for batch in batches:
            for name, value in zip(batch.column(key).to_pylist(), batch.column(text)):
                ids = _ids_of(value.as_py() or "", encoder, end)
                for part, start in enumerate(range(0, len(ids), row)):
                    held.append((name, part, start, ids[start:start + row]))
                total += len(ids)
                if total >= gathered:
                    yield from packed(held, partition << 32 | blocks)
                    held, total, blocks = [], 0, blocks + 1
        if held:
            yield from packed(held, partition << 32 | blocks)

    def packed(held: list, block: int):
        lengths = np.array([len(h[3]) for h in held])
        rows = best_fit(lengths, row)
        order = np.argsort(rows, kind="stable")
        out = {c: [] for c in names}
        for group in np.split(order, np.flatnonzero(np.diff(rows[order])) + 1):
            ids, places = np.full(row, end, "<u2"), np.zeros(row, "<u2")
            ends = np.append(0, np.cumsum(lengths[group]))
            for i, a, b in zip(group, ends, ends[1:]):
                ids[a:b], places[a:b] = held[i][3], np.arange(b - a)
            places[ends[-1]:] = np.arange(row - ends[-1])
            for c, v in zip(names, (block, int(rows[group[0]]), ids.tobytes(), ends.tolist(), places.tobytes(),
                                    [held[i][0] for i in group], [held[i][1] for i in group], [held[i][2] for i in group])):
                out[c].append(v)
            if len(out["row"]) == 512:
                yield batch_of(out)
                out = {c: [] for c in names}
        if out["row"]:
            yield batch_of(out)

    def batch_of(out: dict) -> pa.RecordBatch:
        kinds = {"ids": pa.binary(), "positions": pa.binary(), "cu_seqlens": pa.list_(pa.int32()), "parts": pa.list_(pa.int32()),
                 "doc_ids": pa.list_(pa.int64()), "starts": pa.list_(pa.int64()), "block": pa.int64(), "row": pa.int64()}
        return pa.RecordBatch.from_arrays([pa.array(out[c], kinds[c]) for c in names], names)

    names = ["block", "row", "ids", "cu_seqlens", "positions", "doc_ids", "parts", "starts"]
    return frame.select(F.col(key).cast("long").alias(key), text).mapInArrow(
        work, "block long, row long, ids binary, cu_seqlens array<int>, positions binary, doc_ids array<long>, "
              "parts array<int>, starts array<long>")


def op2_packed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as packed rows of ids."""
    return pack(table(spark, sf_dir, "documents"), "doc_id")
