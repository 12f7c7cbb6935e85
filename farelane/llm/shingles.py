"""Word-shingle sets of texts, as sorted arrays of 64-bit hashes, inside Arrow tasks.

A batch's bytes are hashed without a loop over words: prefix sums of (random value of a byte) * (power of an odd
number) give the polynomial hash of every word at once, modulo 2**64.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

WIDTH = 5
PIECE_BYTES = 1 << 20  # texts are hashed together up to this size; a longer one is hashed alone
_rng = np.random.default_rng(5)
_BYTE = _rng.integers(0, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BYTE[ord("A") : ord("Z") + 1] = _BYTE[ord("a") : ord("z") + 1]  # A-Z count as a-z
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 2**64)
_powers = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def _power(name: str, base: int, n: int) -> np.ndarray:
    if len(_powers[name]) < n:
        grown = np.full(max(n, PIECE_BYTES + 1), base, np.uint64)
        grown[0] = 1
        _powers[name] = np.multiply.accumulate(grown)
    return _powers[name][:n]


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(32))
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


def _words(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of texts that lie one behind the other (the last byte of each is a blank), and each one's text."""
    space = _IS_SPACE[data]
    starts = np.flatnonzero(~space & np.concatenate([[True], space[:-1]]))
    stops = np.flatnonzero(space & np.concatenate([[False], ~space[:-1]]))
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * _power("up", _BASE, len(data)), out=sums[1:])
    word = _mixed((sums[stops] - sums[starts]) * _power("down", _BASE_INVERSE, len(data))[starts])
    return word, np.searchsorted(ends, starts, side="right")


def _piece(data: np.ndarray, ends: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingle hashes of such texts, and each one's text."""
    word, text = _words(data, ends)
    count = np.bincount(text, minlength=len(ends))
    first = np.cumsum(count) - count
    # Shingles of `width` words where a text has that many, else one of all its words.
    take = np.minimum(count, width)
    at = np.arange(len(word)) - first[text]
    head = np.flatnonzero(at <= count[text] - take[text])
    length = take[text[head]]
    value = length.astype(np.uint64) * np.uint64(_BASE)
    for i in range(width):
        inside = head[length > i] if i else head
        step = _mixed(value[length > i] ^ word[inside + i])
        if len(step) == len(value):
            value = step
        else:
            value[length > i] = step
    return value, text[head]


def _pieces(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Texts joined by blanks, as bytes with the ends of the texts."""
    texts = column.cast(pa.large_binary())
    sizes = [0 if s is None else s + 1 for s in pc.binary_length(texts).to_pylist()]
    at = 0
    while at < len(sizes):
        to, total = at + 1, sizes[at]
        while to < len(sizes) and total + sizes[to] <= PIECE_BYTES:
            total += sizes[to]
            to += 1
        raw = b"".join(b"" if t is None else t + b" " for t in texts.slice(at, to - at).to_pylist())
        yield np.frombuffer(raw, np.uint8), np.cumsum(sizes[at:to])
        at = to


def word_hashes(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For some texts at a time: the hashes of all their words in order, and where each text begins (with the end)."""
    for data, ends in _pieces(column):
        word, text = _words(data, ends) if len(data) else (np.empty(0, np.uint64), np.empty(0, np.int64))
        yield word, np.searchsorted(text, np.arange(len(ends) + 1))


def shingle_sets(column: pa.Array, width: int = WIDTH) -> Iterator[np.ndarray]:
    """For each text the sorted distinct hashes of the ``width``-word shingles of the whole text.

    A-Z count as a-z; words lie between ASCII white space. With fewer words the whole sequence is
    one shingle; a text without words, or null, gives none. Different shingles have different
    hashes but for a chance of about 2**-64 a pair.
    """
    for data, ends in _pieces(column):
        value, text = _piece(data, ends, width) if len(data) else (np.empty(0, np.uint64), np.empty(0, np.int64))
        bounds = np.searchsorted(text, np.arange(len(ends) + 1))
        for a, b in zip(bounds[:-1], bounds[1:]):
            yield np.unique(value[a:b])


def least_hashes(shingles: np.ndarray, seeds: list[int]) -> list[int]:
    """One MinHash value per seed, as signed longs."""
    return [int(((shingles ^ np.uint64(s)) * np.uint64(0xC4CEB9FE1A85EC53)).min().astype(np.int64)) for s in seeds]
