"""Vectorised byte and word hashing of Arrow text columns (used inside tasks)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_U = np.uint64
_BASE = _U(0x9E3779B97F4A7C15 | 1)
_BASE_INV = _U(pow(int(_BASE), -1, 1 << 64))
_RNG = np.random.Generator(np.random.PCG64(20240607))
BYTE_VALUE = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64) * _U(2) + _U(1)
BYTE_VALUE_LOWER = BYTE_VALUE.copy()
BYTE_VALUE_LOWER[65:91] = BYTE_VALUE[97:123]
# The white space of the word and line rules: \x20 and \x09 to \x0D.
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[9, 10, 11, 12, 13, 32]] = True

# Separators of word models: every ASCII character but letters and digits.
IS_MARK = np.ones(256, bool)
IS_MARK[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False

_powers: dict[str, np.ndarray] = {}


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i (mod 2**64) for i < n."""
    if len(_powers.get("up", ())) < n:
        size = max(n, 1 << 16)
        for name, base in (("up", _BASE), ("down", _BASE_INV)):
            p = np.full(size, base, np.uint64)
            p[0] = 1
            np.multiply.accumulate(p, out=p)
            _powers[name] = p
    return _powers["up"], _powers["down"]


def mix(h: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser: spreads every bit of a 64-bit value."""
    h = (h ^ (h >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> _U(27))) * _U(0x94D049BB133111EB)
    return h ^ (h >> _U(31))


def prefix_hash(values: np.ndarray) -> np.ndarray:
    """Rabin-Karp prefix sums S: span [i, j) hashes to (S[j] - S[i]) * base**-i."""
    up, _ = _power(len(values) + 1)
    s = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[: len(values)], out=s[1:])
    return s


def span_hash(s: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Hashes of spans [i, j) from their prefix sums (equal content, equal hash)."""
    _, down = _power(len(s))
    return (s[j] - s[i]) * down[i]


def rolling_hash(values: np.ndarray, width: int) -> np.ndarray:
    """Mixed Rabin-Karp hash of every run of ``width`` consecutive values."""
    n = len(values) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    s = prefix_hash(values)
    _, down = _power(n)
    return mix((s[width:] - s[:n]) * down[:n])


def text_buffers(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets of a text column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays([c.cast(pa.large_binary()) for c in column.chunks]) if column.num_chunks else pa.array([], pa.large_binary())
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    if len(column) == 0:
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    _, off, data = column.buffers()
    offsets = np.frombuffer(off, np.int64)[column.offset : column.offset + len(column) + 1].copy()
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    raw = raw[offsets[0] : offsets[-1]]
    return raw, offsets - offsets[0]


def blocks(offsets: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Row ranges [i, j) of about ``limit`` bytes, at least one row each."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


def word_spans(data: np.ndarray, offsets: np.ndarray, between: np.ndarray = IS_SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words ``[^\\x20\\x09-\\x0D]+`` and the first word index of each row (one more at the end).

    ``between`` flags the bytes between words, if they are others.
    """
    n = len(data)
    word = ~between[data]
    cut = np.zeros(n + 1, bool)
    cut[offsets] = True
    start = word.copy()
    end = word.copy()
    if n > 1:
        start[1:] &= ~word[:-1] | cut[1:n]
        end[:-1] &= ~word[1:] | cut[1:n]
    starts, ends = np.flatnonzero(start), np.flatnonzero(end) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = False) -> np.ndarray:
    """A mixed 64-bit hash of every word (A-Z lower-cased first if asked)."""
    s = prefix_hash((BYTE_VALUE_LOWER if lower else BYTE_VALUE)[data])
    return mix(span_hash(s, starts, ends) ^ (ends - starts).astype(np.uint64))


def word_runs(hashes: np.ndarray, first: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of every run of ``size`` words in one row and the row of each; a shorter row is one run."""
    counts = np.diff(first)
    whole = rolling_hash(hashes, size)
    row = np.repeat(np.arange(len(counts)), counts)
    last = np.repeat(first[1:], counts) - size
    at = np.flatnonzero(np.arange(len(whole)) <= last[: len(whole)])
    short = np.flatnonzero((counts > 0) & (counts < size))
    if not len(short):
        return whole[at], row[at]
    s = prefix_hash(hashes)
    own = mix(span_hash(s, first[short], first[short + 1]) ^ counts[short].astype(np.uint64))
    rows = np.concatenate([row[at], short])
    order = np.argsort(rows, kind="stable")
    return np.concatenate([whole[at], own])[order], rows[order]
