"""Operator 10: bytes inside long strings that occur again, by prefix-free parsing.

A rolling hash over a few bytes decides where a phrase ends, so equal stretches of text are cut alike wherever they
stand. The corpus becomes a parse (phrases in order) over a dictionary (distinct phrases). Suffixes of the dictionary, of
the parse and at last of the text are sorted, and equal neighbours are repeats. Only the first ``length`` bytes of
a suffix matter here, so a suffix is known by the 64-bit fingerprint of those, and sorting is by fingerprint: equal
suffixes meet as in byte order, and the sort is spread over the cluster without a hot key range. Each
sort handles only what the one before has left:

1. Dictionary: phrases that occur once rule out every string that holds one whole.
2. Parse: what is left is cut into units, the strings that begin within one phrase. A unit that occurs again
   is settled as a whole, and one of its occurrences stands for all.
3. Text: the strings of unsettled units are sorted against each other and against the units that stand for others.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import frugal, mixed, pieces, stored, table, temporary, utf8
from .words import _BACK, powers

LENGTH = 400      # bytes of a string that must not occur twice
TRIGGER = 12      # bytes that decide whether a phrase ends
CHUNK = 1 << 19
FILTER_BITS = 1 << 24
OPEN, EDGE = 1, 2
_CODE = mixed(np.arange(256, dtype=np.uint64), 7)


class Text:
    """Fingerprints of any span of some bytes, from one running sum."""

    def __init__(self, data: np.ndarray):
        self.back = powers(len(data) + 1, _BACK)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        with np.errstate(over="ignore"):
            np.cumsum(_CODE[data] * powers(len(data)), out=self.sums[1:])

    def of(self, starts: np.ndarray, ends: np.ndarray, salt: int) -> np.ndarray:
        with np.errstate(over="ignore"):
            return mixed((self.sums[ends] - self.sums[starts]) * self.back[starts] + (ends - starts).astype(np.uint64), salt)

    def cuts(self, every: int) -> np.ndarray:
        """Where the bytes before end a phrase, one place in ``every`` on average."""
        n = len(self.sums) - 1
        if n < TRIGGER:
            return np.empty(0, np.int64)
        starts = np.arange(n - TRIGGER + 1)
        return np.flatnonzero(self.of(starts, starts + TRIGGER, 0) % np.uint64(every) == 0) + TRIGGER


def phrases(text: Text, bounds: np.ndarray, every: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every phrase of texts that lie one behind the other, and the text it belongs to."""
    cuts = text.cuts(every)
    if len(cuts):
        owner = np.searchsorted(bounds, cuts, side="right") - 1
        cuts = cuts[(cuts < bounds[-1]) & (cuts - TRIGGER >= bounds[np.minimum(owner, len(bounds) - 1)])]
    begins = bounds[:-1][np.diff(bounds) > 0]
    starts = np.union1d(begins, cuts)
    ends = np.append(starts[1:], bounds[-1]) if len(starts) else starts
    return starts, ends, np.searchsorted(bounds, starts, side="right") - 1


def _sorted_rows(batches, names: list[str], key: str) -> Iterator[tuple[dict, np.ndarray, np.ndarray]]:
    """Rows that come sorted by all columns, each once, with two marks: its key occurs again; it is its key's first.

    One row is held back at a time, so a key of any number of rows needs no memory.
    """
    held, told = None, False
    for batch in batches:
        if not batch.num_rows:
            continue
        now = {c: batch.column(c).to_numpy(zero_copy_only=False) for c in names}
        if held is not None:
            now = {c: np.concatenate([held[c], now[c]]) for c in names}
        new = np.zeros(len(now[key]), bool)
        new[0] = True
        for c in names[:3]:
            new[1:] |= now[c][1:] != now[c][:-1]
        now = {c: v[new] for c, v in now.items()}
        first = np.append(True, now[key][1:] != now[key][:-1])
        size = np.diff(np.append(np.flatnonzero(first), len(first)))
        again = np.repeat(size > 1, size)
        give = np.ones(len(first), bool)
        if held is not None and told:
            again[:size[0]], first[0], give[0] = True, False, False
        told = bool(again[-1])
        if not told:
            give[-1] = False
        held = {c: v[-1:].copy() for c, v in now.items()}
        yield {c: v[give] for c, v in now.items()}, again[give], first[give]
    if held is not None and not told:
        yield held, np.zeros(1, bool), np.ones(1, bool)


def _by_name(batches, names: list[str]) -> Iterator[dict]:
    """Whole texts' rows together; the rows come sorted by name."""
    rest = None
    for batch in batches:
        if not batch.num_rows:
            continue
        now = {c: batch.column(c).to_numpy(zero_copy_only=False) for c in names}
        if rest is not None:
            now = {c: np.concatenate([rest[c], now[c]]) for c in names}
        cut = np.searchsorted(now["name"], now["name"][-1])
        rest = {c: v[cut:] for c, v in now.items()}
        if cut:
            yield {c: v[:cut] for c, v in now.items()}
    if rest is not None:
        yield rest


def union_of(group: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs covered by half-open ranges of each group; ranges that touch are one run."""
    order = np.lexsort((low, group))
    group, low, high = group[order], low[order], high[order]
    if not len(group):
        return group, low, high
    number = np.cumsum(np.append(0, group[1:] != group[:-1]))
    lift = number * (int(high.max()) + 2)
    reach = np.maximum.accumulate(high + lift)
    begin = np.append(True, low[1:] + lift[1:] > reach[:-1])
    at = np.flatnonzero(begin)
    last = np.append(at[1:], len(group)) - 1
    return group[at], low[at], reach[last] - lift[last]


def _phrase_rows(documents: DataFrame, length: int) -> DataFrame:
    """``phrase, name, place, around, kind`` of all phrases; place packs start and size, around the neighbours' sizes.

    A phrase includes the trigger bytes before it, so a string that holds it is cut there in any text. Where a text begins
    or ends there is no trigger, so such a phrase (``EDGE``) rules nothing out. A row of kind ``OPEN`` stands for
    strings that hold no whole phrase, which the dictionary can't rule out.
    """
    every = max(length // 10, 1)

    def work(batches):
        for batch in batches:
            data, bounds = utf8(batch.column("text"))
            names = batch.column("name").to_numpy(zero_copy_only=False)
            # Copies met together count once, and short texts hold no string of the length.
            _, once = np.unique(names, return_index=True)
            take = np.zeros(len(names), bool)
            take[once] = True
            for a, b in pieces(bounds, CHUNK):
                inner = bounds[a:b + 1] - bounds[a]
                text = Text(data[bounds[a]:bounds[b]])
                start, end, owner = phrases(text, inner, every)
                if not len(start):
                    continue
                use = take[a + owner] & (np.diff(inner)[owner] >= length)
                zero = inner[owner]
                first, last = start == zero, end == inner[owner + 1]
                before = np.where(first, 0, start - np.append(0, start[:-1]))
                after = np.where(last, 0, np.append(end[1:], 0) - end)
                marks, name = text.of(np.where(first, start, start - TRIGGER), end, 1), names[a + owner]
                place = (start - zero) << 32 | (end - start)
                around = before << 32 | after
                open_ = use & (end - start + after + TRIGGER >= length)
                kinds = np.concatenate([np.where(first | last, EDGE, 0)[use], np.full(open_.sum(), OPEN)])
                both = lambda v: np.concatenate([v[use], v[open_]])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate([marks[use], mixed(marks[open_] + name[open_].view(np.uint64), 2)]).view(np.int64)),
                     pa.array(both(name)), pa.array(both(place)), pa.array(both(around)), pa.array(kinds)],
                    ["phrase", "name", "place", "around", "kind"])

    return documents.select("name", "text").mapInArrow(
        frugal(work), "phrase long, name long, place long, around long, kind long")


def _open_ranges(rows: DataFrame, length: int) -> DataFrame:
    """``name, low, high``: starts of the strings whose whole phrases all occur again."""
    names = ["phrase", "name", "place", "around", "kind"]

    def again(batches):
        for row, twice, _ in _sorted_rows(batches, names, "phrase"):
            use = twice | (row["kind"] > 0)
            yield pa.RecordBatch.from_arrays([pa.array(row[c][use]) for c in names[1:]], names[1:])

    def ranges(batches):
        for row in _by_name(batches, names[1:]):
            name, place, around, kind = (row[c] for c in names[1:])
            sure = kind == OPEN
            start, size = place >> 32, place & 0xFFFFFFFF
            before, after = around >> 32, around & 0xFFFFFFFF
            end = start + size
            # Phrases that occur again and follow each other are a run; strings may reach into its unique neighbours.
            n, s, e, b, f = (v[~sure] for v in (name, start, end, before, after))
            begin = np.append(True, (n[1:] != n[:-1]) | (s[1:] != e[:-1])) if len(n) else np.empty(0, bool)
            at = np.flatnonzero(begin)
            last = np.append(at[1:], len(n)) - 1 if len(n) else at
            low = np.maximum(s[at] - b[at] - TRIGGER + 1, 0)
            high = np.where(f[last] == 0, e[last], e[last] + f[last] - 1) - length + 1
            group = np.concatenate([n[at], name[sure]])
            low = np.concatenate([low, np.maximum(start[sure] - TRIGGER, 0)])
            high = np.concatenate([high, (end + after)[sure] - length + 1])
            fits = high > low
            group, low, high = union_of(group[fits], low[fits], high[fits])
            yield pa.RecordBatch.from_arrays([pa.array(group), pa.array(low), pa.array(high)], ["name", "low", "high"])

    found = rows.repartition("phrase").sortWithinPartitions("phrase", "name", "place").mapInArrow(
        frugal(again), "name long, place long, around long, kind long")
    return found.repartition("name").sortWithinPartitions("name", "place", "kind").mapInArrow(
        frugal(ranges), "name long, low long, high long")


def _texts_of(documents: DataFrame, key_of: DataFrame) -> DataFrame:
    """``name, text`` of the wanted names; a bitmap of fixed size keeps most other texts from being sent."""
    bit = F.pmod("name", F.lit(FILTER_BITS))
    words = key_of.groupBy(F.shiftright(bit, 5).alias("w")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), (bit % 32).cast("int"))).alias("m")).collect()
    bitmap = np.zeros(FILTER_BITS // 32, np.uint32)
    for row in words:
        bitmap[row["w"]] = row["m"]
    sent = documents.sparkSession.sparkContext.broadcast(bitmap)

    def wanted(batches):
        for batch in batches:
            at = batch.column("name").to_numpy(zero_copy_only=False) % FILTER_BITS
            hit = (sent.value[at >> 5] >> (at & 31).astype(np.uint32)) & np.uint32(1) == 1
            # Copies met together are sent once.
            _, once = np.unique(batch.column("name").to_numpy(zero_copy_only=False), return_index=True)
            take = np.zeros(len(hit), bool)
            take[once] = True
            yield batch.filter(pa.array(hit & take))

    return documents.select("name", "text").mapInArrow(frugal(wanted), "name long, text string").join(key_of, "name")


def _lists(column, dtype=np.int64) -> list[np.ndarray]:
    values, ends = column.flatten().to_numpy(zero_copy_only=False).astype(dtype), column.offsets.to_numpy()
    return [values[a - ends[0]:b - ends[0]] for a, b in zip(ends, ends[1:])]


def _units(texts: DataFrame, length: int) -> DataFrame:
    """Runs of string starts that belong to one phrase: fingerprint of all their bytes, and the phrase that follows."""
    every = max(length // 10, 1)

    def work(batches):
        for batch in batches:
            out = []
            for name, value, copied, low, high in zip(
                    batch.column("name").to_pylist(), batch.column("text"), batch.column("copied").to_pylist(),
                    _lists(batch.column("low")), _lists(batch.column("high"))):
                data = np.frombuffer(value.as_buffer(), np.uint8)
                text = Text(data)
                start, end, _ = phrases(text, np.array([0, len(data)]), every)
                order = np.argsort(low)
                low, high = low[order], high[order]
                # A string belongs to the last phrase whose trigger begins before it: it holds the next one's trigger whole.
                turn = start[1:] - TRIGGER + 1
                at = np.union1d(low, turn[turn <= high[-1]])
                home = np.searchsorted(low, at, side="right") - 1
                use = (home >= 0) & (at < high[home])
                at, home = at[use], home[use]
                phrase = np.searchsorted(turn, at, side="right")
                stop = np.minimum(np.append(turn, len(data))[phrase], high[home])
                follows = np.minimum(phrase + 1, len(start) - 1)
                sure = (phrase + 2 < len(start)) & (end[follows] <= at + length)
                out.append((text.of(at, stop + length - 1, 3), np.full(len(at), name), at, stop,
                            text.of(np.maximum(start[follows] - TRIGGER, 0), end[follows], 1), sure, np.full(len(at), copied)))
            if out:
                unit, name, at, stop, following, sure, copied = (np.concatenate(c) for c in zip(*out))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(unit.view(np.int64)), pa.array(name), pa.array(at), pa.array(stop),
                     pa.array(following.view(np.int64)), pa.array(sure), pa.array(copied)],
                    ["unit", "name", "at", "stop", "following", "sure", "copied"])

    return texts.select("name", "text", "copied", "low", "high").mapInArrow(
        frugal(work), "unit long, name long, at long, stop long, following long, sure boolean, copied boolean")


def _settled(units: DataFrame) -> DataFrame:
    """Units with two marks: ``settled`` (all its strings occur again) and ``stands`` (for the other occurrences)."""
    names = ["unit", "name", "at", "stop", "following", "sure", "copied"]

    def work(batches):
        for row, again, first in _sorted_rows(batches, names, "unit"):
            settled = again | row["copied"]
            yield pa.RecordBatch.from_arrays(
                [*[pa.array(row[c]) for c in names[1:]], pa.array(settled), pa.array(settled & first)],
                [*names[1:], "settled", "stands"])

    return units.repartition("unit").sortWithinPartitions("unit", "name", "at").mapInArrow(
        frugal(work), "name long, at long, stop long, following long, sure boolean, copied boolean, settled boolean, stands boolean")


def _strings_again(texts: DataFrame, units: DataFrame, length: int) -> DataFrame:
    """``name, low, high`` of the single strings of unsettled units that occur again."""
    # Equal strings are followed by equal phrases, so units without such a counterpart are done.
    counts = units.filter("not settled or stands").groupBy("following").agg(
        F.count("*").alias("all"), F.count(F.when(~F.col("settled"), 1)).alias("open"))
    kept = units.join(counts, "following").filter(
        "(not settled and (all > 1 or not sure)) or (stands and (open > 0 or not sure))")
    lists = kept.groupBy("name").agg(F.sort_array(F.collect_list(F.struct("at", "stop", "settled"))).alias("u")).select(
        "name", F.col("u.at").alias("at"), F.col("u.stop").alias("stop"), F.col("u.settled").alias("settled"))

    def strings(batches):
        for batch in batches:
            for name, value, at, stop, settled in zip(
                    batch.column("name").to_pylist(), batch.column("text"), _lists(batch.column("at")),
                    _lists(batch.column("stop")), _lists(batch.column("settled"), bool)):
                text = Text(np.frombuffer(value.as_buffer(), np.uint8))
                size = stop - at
                start = np.repeat(at - np.append(0, np.cumsum(size)[:-1]), size) + np.arange(size.sum())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(text.of(start, start + length, 4).view(np.int64)), pa.array(np.full(len(start), name)),
                     pa.array(start), pa.array(np.repeat(~settled, size))], names)

    def again(batches):
        for row, twice, _ in _sorted_rows(batches, names, "string"):
            use = twice & row["own"]
            yield pa.RecordBatch.from_arrays(
                [pa.array(row["name"][use]), pa.array(row["start"][use]), pa.array(row["start"][use] + length)],
                ["name", "low", "high"])

    names = ["string", "name", "start", "own"]
    rows = texts.select("name", "text").join(lists, "name").select("name", "text", "at", "stop", "settled").mapInArrow(
        frugal(strings), "string long, name long, start long, own boolean")
    return rows.repartition("string").sortWithinPartitions("string", "name", "start").mapInArrow(
        frugal(again), "name long, low long, high long")


def _named(frame: DataFrame, key: str, text: str) -> DataFrame:
    value = F.coalesce(F.col(text).cast("string"), F.lit(""))
    return frame.select(F.col(key).alias("id"), value.alias("text")).withColumn("digest", F.sha2(value, 256)).withColumn(
        "name", F.conv(F.substring("digest", 1, 15), 16, 10).cast("long"))


def without_repeats(frame: DataFrame, key: str, text: str = "text", length: int = LENGTH, characters: bool = False) -> DataFrame:
    """Per row: ``key``, ``n_bytes``, ``n_removed``, ``n_spans``, ``kept_sha256`` and ``kept`` (the bytes that stay).

    A byte goes if a string of ``length`` bytes that covers it also starts anywhere else, in this text or another;
    strings overlap freely and are judged on the whole input. Matches do not cross texts. A null text is
    empty; a text shorter than the length loses nothing; a text that occurs twice loses everything, if long enough.
    ``kept`` is null where a text stays as it is. Keys may repeat or be null: each row gets its own result.
    With ``characters`` a character that loses a byte goes as a whole, so that ``kept`` is text again.
    """
    named = _named(frame, key, text)
    rows = stored(named.select("id", "name", "digest", F.octet_length("text").cast("long").alias("n_bytes")), "texts")
    classes = rows.groupBy("name").agg(F.count("*").alias("copies"), F.first("n_bytes").alias("n_bytes"))
    documents = named.select("name", "text")

    def cut(batches):
        for batch in batches:
            out = []
            for name, value, low, high in zip(
                    batch.column("name").to_pylist(), batch.column("text"), _lists(batch.column("low")), _lists(batch.column("high"))):
                data = np.frombuffer(value.as_buffer(), np.uint8)
                _, low, high = union_of(np.zeros(len(low), np.int64), low, high)
                inside = np.zeros(len(data) + 1, np.int8)
                inside[low] += 1
                inside[high] -= 1
                stays = np.cumsum(inside[:-1]) == 0
                if characters:   # a byte that goes on with a character begins with the bits 10
                    character = np.cumsum(data & 0xC0 != 0x80)
                    stays = (np.bincount(character, ~stays) == 0)[character]
                kept = data[stays].tobytes()
                out.append((name, len(data) - len(kept), len(low), hashlib.sha256(kept).hexdigest(), kept))
            columns = zip(*out) if out else [[]] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()))],
                ["name", "n_removed", "n_spans", "kept_sha256", "kept"])

    # Of the search only the cut texts stay.
    with temporary(frame.sparkSession):
        ranges = _open_ranges(_phrase_rows(documents, length), length)
        asked = stored(
            ranges.groupBy("name").agg(F.collect_list(F.struct("low", "high")).alias("r"))
            .join(classes, "name").select("name", (F.col("copies") > 1).alias("copied"),
                                          F.col("r.low").alias("low"), F.col("r.high").alias("high")), "ranges")
        texts = stored(_texts_of(documents, asked).dropDuplicates(["name"]), "candidates")
        units = stored(_settled(_units(texts, length)), "units")
        whole = units.filter("settled and not copied").select(
            "name", F.col("at").alias("low"), (F.col("stop") + (length - 1)).alias("high"))
        gone = whole.union(_strings_again(texts, units, length)).groupBy("name").agg(
            F.collect_list(F.struct("low", "high")).alias("r")).select("name", F.col("r.low").alias("low"), F.col("r.high").alias("high"))
        partly = texts.filter("not copied").select("name", "text").join(gone, "name").select("name", "text", "low", "high").mapInArrow(
            frugal(cut), "name long, n_removed long, n_spans long, kept_sha256 string, kept binary")
        partly = stored(partly, "cut", keep=True)
    wholly = classes.filter((F.col("copies") > 1) & (F.col("n_bytes") >= length)).select(
        "name", F.col("n_bytes").alias("n_removed"), F.lit(1).cast("long").alias("n_spans"),
        F.sha2(F.lit(b""), 256).alias("kept_sha256"), F.lit(b"").alias("kept"))
    return rows.join(partly.union(wholly), "name", "left").select(
        F.col("id").alias(key), "n_bytes", F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce("n_spans", F.lit(0)).cast("long").alias("n_spans"),
        F.coalesce("kept_sha256", "digest").alias("kept_sha256"), "kept")


def op10_repeated_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the bytes of strings that occur again."""
    return without_repeats(table(spark, sf_dir, "documents"), "doc_id").drop("kept")
