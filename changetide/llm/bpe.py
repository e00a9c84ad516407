"""Operator 9: byte-pair encoding by forced boundaries, and decoding."""

from __future__ import annotations

import hashlib
import json
import unicodedata
from array import array
from collections.abc import Iterator
from contextlib import contextmanager
from heapq import heapify, heappop, heappush
from itertools import chain, islice
from threading import Timer

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import frugal, let_go, mixed, pieces, table, utf8

# White space as the vocabulary's patterns mean it, the word pattern, the word end.
_SPACE = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_WORD = r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^" + _SPACE + r"\p{L}\p{N}]+"
_END = "</w>"
_STOP = "\n"     # ends a word's last fragment here; no word holds it
CACHE_BYTES = 24 << 20   # of a cache's generation, by estimate; a worker holds four, two of words and two of fragments
ENTRY_BYTES = 250        # of an entry beside its text and ids
RUN_BYTES = 8 << 20      # text whose stretches are looked up together
IDLE = 3.0               # seconds without a task after which a worker lets its codec go
LONG = 64                # letters of a fragment that is merged by a heap and not kept
_NEVER = 1 << 30


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in the vocabulary's strings."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    letters = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}
    return [letters[b] for b in range(256)]


class Codec:
    """Encodes and decodes with the vocabulary of one tokenizer file.

    A pair of bytes that stands inside no token can never be joined, whatever the merges, so the text
    is cut there; each fragment is merged on its own and the ids are put together again. Fragments
    repeat far more than words do, and a word's and a fragment's ids are kept in caches of bounded size.
    """

    def __init__(self, description: str):
        model = json.loads(description)
        vocab = model["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in model["added_tokens"] if t["special"]}
        self.names = {i: t for t, i in vocab.items()} | {i: t for t, i in self.special.items()}
        self.vocab = vocab
        self.ranks: dict[int, int] = {}
        self.joined: list[int] = []
        for rank, (left, right) in enumerate(model["model"]["merges"]):
            self.ranks.setdefault(vocab[left] << 20 | vocab[right], rank)
            self.joined.append(vocab[left + right])
        self.pairs, self.joins = Pairs(self.ranks), np.array(self.joined, np.int64)
        # Ids of letters by code point, inside a word and at its end.
        self.first = np.zeros((2, 1 + max(map(ord, byte_letters()))), np.int64)
        for letter in byte_letters():
            self.first[:, ord(letter)] = vocab[letter], vocab[letter + _END]
        # Letters by byte, and the pairs of letters that stand inside a token; a word's end is never cut off.
        self.letter = np.array([*map(ord, byte_letters())], np.uint16)
        self.letter[ord(_STOP)] = ord(_STOP)
        self.inside = np.zeros((self.first.shape[1],) * 2, bool)
        self.inside[:, ord(_STOP)] = True
        for token in vocab:
            body = token.removesuffix(_END) if token != _END else token
            for left, right in zip(body, body[1:]):
                self.inside[ord(left), ord(right)] = True
        self.word = regex.compile(_WORD)
        self.gap = regex.compile(f"[{_SPACE}]+")
        self.marks = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")")
        self.chunks, self.fragments = Cache(), Cache()

    def _fragments(self, words: list[str]) -> tuple[list[str], np.ndarray]:
        """The fragments of all words between the certain cuts, and how many each word has; the last one of a word ends in ``_STOP``."""
        if not words:
            return [], np.zeros(0, np.int64)
        letters = self.letter[np.frombuffer((_STOP.join(words) + _STOP).encode(), np.uint8)]
        over = letters[:-1] == ord(_STOP)
        begin = np.flatnonzero(np.append(True, over | ~self.inside[letters[:-1], letters[1:]]))
        end = np.append(begin[1:], len(letters))
        flat = letters.astype("<u2").tobytes().decode("utf-16-le")
        last = np.flatnonzero(letters[end - 1] == ord(_STOP))
        return [flat[i:j] for i, j in zip(begin.tolist(), end.tolist())], np.diff(last, prepend=-1)

    def _merged(self, keys: list[str]) -> dict[str, bytes]:
        """Ids of fragments: the pair of the lowest rank is joined, leftmost first, until none is left.

        Fragments of one length are merged side by side. Each step joins one pair in every fragment that has one left, so
        those stay of one length; the others are done.
        """
        found, by_size = {}, {}
        for key in keys:
            size = len(key) - key.endswith(_STOP)
            if size <= LONG:
                by_size.setdefault(size, []).append(key)
            else:
                found[key] = array("I", self._merged_long(self._letters([key], size)[0].tolist())).tobytes()
        for size, some in by_size.items():
            names, ids = np.array(some, object), self._letters(some, size)
            ranks = self.pairs.of(ids[:, :-1], ids[:, 1:])
            while len(names):
                best = ranks.min(axis=1) if ranks.shape[1] else np.full(len(names), _NEVER)
                done = best == _NEVER
                if done.any():
                    row = 4 * ids.shape[1]
                    flat = ids[done].astype("<u4").tobytes()
                    found.update((key, flat[i * row:(i + 1) * row]) for i, key in enumerate(names[done]))
                    names, ids, ranks, best = (x[~done] for x in (names, ids, ranks, best))
                if not len(names):
                    break
                n, width = ids.shape
                each, at = np.arange(n), ranks.argmin(axis=1)
                ids = ids[np.arange(width) != (at + 1)[:, None]].reshape(n, width - 1)
                ids[each, at] = self.joins[best]
                ranks = ranks[np.arange(width - 1) != at[:, None]].reshape(n, width - 2)
                for rows, place in ((each[at > 0], at[at > 0] - 1), (each[at < width - 2], at[at < width - 2])):
                    ranks[rows, place] = self.pairs.of(ids[rows, place], ids[rows, place + 1])
        return found

    def _letters(self, keys: list[str], size: int) -> np.ndarray:
        """Ids of the single letters of fragments of one length."""
        last = np.array([key.endswith(_STOP) for key in keys])
        codes = np.frombuffer("".join([key[:size] for key in keys]).encode("utf-32-le"), "<u4").reshape(len(keys), size)
        ids = self.first[0][codes]
        ids[last, -1] = self.first[1][codes[last, -1]]
        return ids

    def _merged_long(self, ids: list[int]) -> list[int]:
        """The same by a heap over linked ids, in time n log n."""
        rank_of, joined = self.ranks.get, self.joined
        n = len(ids)
        after, before = [*range(1, n + 1)], [*range(-1, n - 1)]
        heap = [(rank, i) for i in range(n - 1) if (rank := rank_of(ids[i] << 20 | ids[i + 1])) is not None]
        heapify(heap)
        while heap:
            rank, i = heappop(heap)
            j = after[i]
            # Passed over if one of the two ids has been joined since.
            if ids[i] < 0 or j == n or rank_of(ids[i] << 20 | ids[j]) != rank:
                continue
            ids[i], ids[j] = joined[rank], -1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if (rank := rank_of(ids[i] << 20 | ids[k])) is not None:
                    heappush(heap, (rank, i))
            if (h := before[i]) >= 0 and (rank := rank_of(ids[h] << 20 | ids[i])) is not None:
                heappush(heap, (rank, h))
        return [i for i in ids if i >= 0]

    def _words(self, part: str) -> list[str]:
        """Words of a stretch without white space and special tokens. No rule of this vocabulary looks past white space."""
        if part.isascii():
            lower = part.lower()
            return [lower] if lower.isalpha() else self.word.findall(lower)
        # Letter by letter, so that a capital sigma does not depend on its place.
        return self.word.findall(unicodedata.normalize("NFC", part).replace("Σ", "σ").lower())

    def _parts(self, chunks: list[str]) -> tuple[list[str], list[str], list[int]]:
        """The stretches, plain ones first, the fragments and special tokens of all of them, and how many each has."""
        plain, marked, words, sizes = [], [], [], []
        for chunk in chunks:
            if "<" in chunk and self.marks.search(chunk):
                marked.append(chunk)
                continue
            some = self._words(chunk)
            plain.append(chunk)
            words += some
            sizes.append(len(some))
        parts, n = self._fragments(words)
        upto = np.concatenate([[0], np.cumsum(n)])[np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])]
        counts = np.diff(upto).tolist()
        for chunk in marked:
            before = len(parts)
            for part in self.marks.split(chunk):
                parts += [part] if part in self.special else self._fragments(self._words(part))[0]
            counts.append(len(parts) - before)
        return plain + marked, parts, counts

    def _learned(self, chunks: set[str]) -> dict[str, tuple[bytes, str]]:
        """Ids of every stretch, and the text these decode to."""
        found = self.chunks.known(chunks)
        order, parts, counts = self._parts(list(chunks.difference(found)))
        known = {token: (array("I", [i]).tobytes(), self.names[i]) for token, i in self.special.items()}
        wanted = set(parts).difference(known)
        known |= self.fragments.known(wanted)
        merged = {part: (ids, self.decode(ids)) for part, ids in self._merged(list(wanted.difference(known))).items()}
        self.fragments.keep(merged)
        known |= merged
        pairs, at, learned = [*map(known.__getitem__, parts)], 0, {}
        for chunk, n in zip(order, counts):
            if n == 1:
                learned[chunk] = pairs[at]
            else:
                learned[chunk] = b"".join([ids for ids, _ in pairs[at:at + n]]), " ".join([back for _, back in pairs[at:at + n]])
            at += n
        self.chunks.keep(learned)
        return found | learned

    def _stretches(self, texts: pa.Array) -> pa.ListArray:
        """Each text split at white space; a text that begins or ends with it has an empty stretch there."""
        if pa.compute.any(pa.compute.match_substring_regex(texts, "[\x1c-\x1f]")).as_py():   # white space to Arrow, but not to the vocabulary
            return pa.compute.split_pattern_regex(texts, f"[{_SPACE}]+")
        return pa.compute.utf8_split_whitespace(texts)

    def coded(self, texts: list[str]) -> Iterator[tuple[bytes, str]]:
        """Of each text the ids, as little-endian unsigned 32-bit integers, and the text they decode to."""
        for ids, back in self.laid(pa.array(texts, pa.large_string())):
            yield bytes(ids), str(back, "utf-8")

    def laid(self, texts: pa.Array) -> Iterator[tuple[memoryview, memoryview]]:
        """The same, the decoded text in UTF-8. Each different stretch is encoded and decoded once for all texts."""
        lists = self._stretches(texts)
        flat = lists.flatten().dictionary_encode()
        distinct = flat.dictionary.to_pylist()
        found = self._learned(set(distinct).difference([""]))
        pairs = [found[chunk] if chunk else (b"", None) for chunk in distinct]
        first = np.asarray(lists.offsets)
        ids, id_at = _chosen(pa.array([ids for ids, _ in pairs], pa.large_binary()), flat.indices, first)
        backs, back_at = _chosen(pa.array(["" if back is None else back + " " for _, back in pairs], pa.large_string()), flat.indices, first)
        for i, j, a, b in zip(id_at, id_at[1:], back_at, back_at[1:]):
            yield ids[i:j], backs[a:max(a, b - 1)]

    def encode(self, text: str) -> bytes:
        return next(self.coded([text]))[0]

    def decode(self, ids: bytes) -> str:
        """The tokens' strings with a blank between two, as this vocabulary's file, without a decoder, asks."""
        return " ".join(map(self.names.__getitem__, memoryview(ids).cast("I")))


def _chosen(values: pa.Array, which: pa.Array, first: np.ndarray) -> tuple[memoryview, list[int]]:
    """The chosen values one behind the other, and where those of each text begin."""
    chosen = values.take(which)
    at = np.frombuffer(chosen.buffers()[1], np.int64, len(chosen) + 1, 8 * chosen.offset)
    data = chosen.buffers()[2]
    return memoryview(data or b""), at[first].tolist()


class Pairs:
    """Ranks of pairs of ids, for whole arrays: a hash table with open addressing."""

    SIZE = 1 << 18   # several times the merges of any vocabulary file

    def __init__(self, ranks: dict[int, int]):
        self.keys = np.full(self.SIZE, -1, np.int64)
        self.ranks = np.full(self.SIZE, _NEVER, np.int64)
        for key, rank in ranks.items():
            at = int(self._slot(np.array([key]))[0])
            while self.keys[at] >= 0:
                at = (at + 1) % self.SIZE
            self.keys[at], self.ranks[at] = key, rank

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return (mixed(key) % np.uint64(self.SIZE)).astype(np.int64)

    def of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left << 20 | right
        at = self._slot(key)
        out = np.where(self.keys[at] == key, self.ranks[at], _NEVER)
        far = np.nonzero((self.keys[at] != key) & (self.keys[at] >= 0))
        key, at = key[far], at[far]
        while len(at):
            at = (at + 1) % self.SIZE
            hit = self.keys[at] == key
            out[tuple(x[hit] for x in far)] = self.ranks[at[hit]]
            going = ~hit & (self.keys[at] >= 0)
            key, at, far = key[going], at[going], tuple(x[going] for x in far)
        return out


class Cache:
    """Two generations: the older one goes when the newer one is full, so what is used often stays.

    It is bounded by bytes and kept from task to task of its worker.
    """

    def __init__(self, most: int = CACHE_BYTES):
        self.new: dict = {}
        self.old: dict = {}
        self.size, self.most = 0, most

    def known(self, keys: set[str]) -> dict:
        """What is kept of these keys; what only the older generation has moves to the newer one."""
        found = {key: self.new[key] for key in keys & self.new.keys()}
        again = {key: self.old[key] for key in (keys & self.old.keys()).difference(found)}
        self.keep(again)
        return found | again

    def keep(self, found: dict[str, tuple[bytes, str]]) -> None:
        """Keep ids and text of all but long keys, some entries at a time so that the bound holds."""
        short = ((key, pair) for key, pair in found.items() if len(key) <= LONG)
        while some := dict(islice(short, max(1, self.most // (64 * ENTRY_BYTES)))):
            size = ENTRY_BYTES * len(some) + sum(map(len, chain(some, *zip(*some.values()))))
            if self.size + size > self.most:
                self.old, self.new, self.size = self.new, {}, 0
            self.new.update(some)
            self.size += size


_codecs: dict[int, Codec] = {}
_timers: list[Timer] = []


@contextmanager
def _coder(description: str) -> Iterator[Codec]:
    """The worker's codec. Workers go on to tasks of other kinds, so it goes when no task has used it for some seconds."""
    while _timers:
        _timers.pop().cancel()
    try:
        yield _codec(description)
    finally:
        timer = Timer(IDLE, _dropped)
        timer.daemon = True
        _timers.append(timer)
        timer.start()


def _dropped() -> None:
    _codecs.clear()
    let_go()


def _codec(description: str) -> Codec:
    key = hash(description)
    if key not in _codecs:
        _codecs.clear()
        _codecs[key] = Codec(description)
    return _codecs[key]


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def _described(spark: SparkSession, path: str | None):
    """The tokenizer file, read on the driver and sent to the executors; its size is fixed."""
    with open(path or default_vocabulary(), encoding="utf-8") as file:
        return spark.sparkContext.broadcast(file.read())


def _runs(batch: pa.RecordBatch, name: str) -> Iterator[pa.Array]:
    """The batch's texts, some megabytes at a time; a null one is empty."""
    column = batch.column(name).cast(pa.large_string()).fill_null("")
    _, bounds = utf8(column)
    for first, end in pieces(bounds, RUN_BYTES):
        yield column.slice(first, end - first)


def encode(frame: DataFrame, text: str = "text", ids: str = "ids", vocabulary: str | None = None) -> DataFrame:
    """The rows with the ids of their text as binary, four little-endian bytes each.

    Whole texts, nothing added around them; a null or empty text has no ids (an empty binary). Words
    of any length are encoded. A column named like the result is replaced.
    """
    described = _described(frame.sparkSession, vocabulary)
    source = frame.drop(ids) if ids != text else frame

    def work(batches):
        with _coder(described.value) as codec:
            for batch in batches:
                column = pa.array([bytes(i) for run in _runs(batch, text) for i, _ in codec.laid(run)], pa.binary())
                yield batch.append_column(ids, column)

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema)
    return source.mapInArrow(frugal(work), f"{schema}, `{ids}` binary")


def decode(frame: DataFrame, ids: str = "ids", text: str = "decoded", vocabulary: str | None = None) -> DataFrame:
    """The rows with the text of their ids; null or no ids give an empty text."""
    described = _described(frame.sparkSession, vocabulary)
    source = frame.drop(text)

    def work(batches):
        with _coder(described.value) as codec:
            for batch in batches:
                column = pa.array([codec.decode(v.as_py() or b"") for v in batch.column(ids)], pa.string())
                yield batch.append_column(text, column)

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema)
    return source.mapInArrow(frugal(work), f"{schema}, `{text}` string")


def digests(frame: DataFrame, key: str, text: str = "text", vocabulary: str | None = None) -> DataFrame:
    """Per row: number of ids, SHA-256 of the ids, and of the text decoded from them, in one pass.

    Neither ids nor decoded texts leave the task, so nothing wide is sent between Python and Spark.
    """
    described = _described(frame.sparkSession, vocabulary)

    def work(batches):
        with _coder(described.value) as codec:
            for batch in batches:
                counts, first, second = [], [], []
                for run in _runs(batch, text):
                    for ids, back in codec.laid(run):
                        counts.append(len(ids) // 4)
                        first.append(hashlib.sha256(ids).hexdigest())
                        second.append(hashlib.sha256(back).hexdigest())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(key), pa.array(counts, pa.int64()), pa.array(first, pa.string()),
                     pa.array(second, pa.string())],
                    [key, "n_tokens", "ids_sha256", "decoded_sha256"])

    kind = frame.schema[key].dataType.simpleString()
    return frame.select(key, F.col(text)).mapInArrow(
        frugal(work), f"`{key}` {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded and decoded again."""
    return digests(table(spark, sf_dir, "documents"), "doc_id")
