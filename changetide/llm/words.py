"""Words and runs of words of many texts at once, as 64-bit numbers."""

from __future__ import annotations

import re
from collections.abc import Callable

import numpy as np

from .tables import mixed

# The bytes that part words (blank and 0x09 to 0x0D).
_PART = np.zeros(256, bool)
_PART[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
# A-Z count as a-z.
_FOLD = np.arange(256)
_FOLD[ord("A"):ord("Z") + 1] += 32
_LETTER = mixed(np.arange(256, dtype=np.uint64), 7)[_FOLD]
# An odd number has an inverse among 64-bit numbers, so sums of powers can be shifted back.
_BASE = 0x5851F42D4C957F2D
_BACK = pow(_BASE, -1, 2**64)
_powers: dict[int, np.ndarray] = {}


# A tokenizer's pattern keeps a step for every blank of a run, and a million of them exhaust its stack.
RUN = 100_000
_LONG_RUN = re.compile(r"(?<!\s)\s{%d,}" % (RUN + 1))


def encoded(encode: Callable[[str], list[int]], text: str) -> list[int]:
    """Ids of a text whose very long runs of white space are cut every ``RUN`` characters and encoded piece by piece.

    The ids decode to the whole text; without such runs they are the tokenizer's own.
    """
    if len(text) <= RUN or (found := _LONG_RUN.search(text)) is None:
        return encode(text)
    ids, at = [], 0
    while found is not None:
        for cut in range(found.start() + RUN, found.end(), RUN):
            ids += encode(text[at:cut])
            at = cut
        found = _LONG_RUN.search(text, found.end())
    return ids + encode(text[at:])


def powers(size: int, base: int = _BASE) -> np.ndarray:
    """The first powers of an odd number, wrapping at 64 bits; kept for the next call."""
    have = _powers.get(base)
    if have is None or len(have) < size:
        have = np.empty(max(size, 1 << 16), np.uint64)
        have[0] = 1
        have[1:] = np.uint64(base)
        with np.errstate(over="ignore"):
            have = np.cumprod(have)
        _powers[base] = have
    return have[:size]


def span_hashes(letters: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of every span of an array of 64-bit letter codes; equal spans have equal hashes."""
    with np.errstate(over="ignore"):
        sums = np.zeros(len(letters) + 1, np.uint64)
        np.cumsum(letters * powers(len(letters)), out=sums[1:])
        return mixed((sums[ends] - sums[starts]) * powers(len(letters) + 1, _BACK)[starts])


def word_spans(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where words begin and end in texts that lie one behind the other, and the text of each."""
    if not len(data):
        none = np.empty(0, np.int64)
        return none, none, none
    inside = ~_PART[data]
    border = np.zeros(len(data) + 1, bool)
    border[bounds] = True
    start = inside.copy()
    start[1:] &= ~inside[:-1] | border[1:-1]
    stop = inside.copy()
    stop[:-1] &= ~inside[1:] | border[1:-1]
    starts, ends = np.flatnonzero(start), np.flatnonzero(stop) + 1
    return starts, ends, np.searchsorted(bounds, starts, side="right") - 1


def word_hashes(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word, A-Z as a-z, and the text it stands in."""
    starts, ends, owner = word_spans(data, bounds)
    return span_hashes(_LETTER[data], starts, ends), owner


def shingle_sets(data: np.ndarray, bounds: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of ``size`` words of each text, sorted, and where each text's set begins.

    A text with fewer words has one shingle, all its words; one without words has none.
    """
    words, owner = word_hashes(data, bounds)
    texts = len(bounds) - 1
    count = np.bincount(owner, minlength=texts)
    first = np.concatenate([[0], np.cumsum(count)])
    hashes = np.zeros(len(words), np.uint64)
    with np.errstate(over="ignore"):
        for i in range(size):
            moved = words[i:]
            hashes[:len(moved)] = hashes[:len(moved)] * np.uint64(_BASE) + moved
        # A word begins a shingle if the text goes on long enough.
        full = np.arange(len(words)) + size <= first[owner + 1] if len(words) else np.empty(0, bool)
        hashes, owner = mixed(hashes[full]), owner[full]
        for text in np.flatnonzero((count > 0) & (count < size)):
            whole = np.uint64(int(count[text]))
            for w in words[first[text]:first[text + 1]]:
                whole = whole * np.uint64(_BASE) + w
            hashes = np.append(hashes, mixed(np.array([whole]), 1))
            owner = np.append(owner, text)
    order = np.lexsort((hashes, owner))
    hashes, owner = hashes[order], owner[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
    hashes, owner = hashes[new], owner[new]
    return hashes, np.searchsorted(owner, np.arange(texts + 1))
