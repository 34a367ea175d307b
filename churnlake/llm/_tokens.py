"""Byte-level BPE ids of whole texts, a distinct pre-token encoded once.

A byte-level BPE merges only inside a pre-token, so a text's ids are its pre-tokens' ids
in order.  Pre-tokens are found with array operations on the code points; each distinct
one is encoded by ``tokenizers`` and remembered.

Added tokens are found before the split: each is a piece, and the text ends on both sides
of it.  Texts with code points that Python's Unicode table does not know, and the
tokenizer's may, go to ``tokenizers`` whole.  So does every text of a tokenizer with another
split, a normalizer, truncation, padding or added tokens that take white space or whole words.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
import sys
import unicodedata
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer

from churnlake.llm._text import blocks, text_buffers

OTHER, LETTER, NUMBER, WHITE, UNKNOWN = 0, 1, 2, 3, 4
# Code points that the pre-token pattern takes as white space (fixed values).
WHITE_SPACE = [9, 10, 11, 12, 13, 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
_kinds: list[np.ndarray] = []


def _kind_table() -> np.ndarray:
    if not _kinds:
        kind = np.zeros(sys.maxunicode + 1, np.uint8)
        for c in range(sys.maxunicode + 1):
            k = unicodedata.category(chr(c))
            kind[c] = UNKNOWN if k == "Cn" else LETTER if k[0] == "L" else NUMBER if k[0] == "N" else OTHER
        kind[WHITE_SPACE] = WHITE
        _kinds.append(kind)
    return _kinds[0]


def pre_token_starts(points: np.ndarray, kind: np.ndarray, row_starts: np.ndarray) -> np.ndarray:
    """First code point of every pre-token; no pre-token crosses a row.  ``kind`` is that of each point.

    The split: a contraction ('s 't 're 've 'm 'll 'd); a run of letters, of numbers or of
    others, with the one space before it; white space without its last character when
    something follows; white space.
    """
    n = len(points)
    first = np.zeros(n, bool)
    first[row_starts[row_starts < n]] = True
    start = first.copy()
    start[1:] |= kind[1:] != kind[:-1]
    white = kind == WHITE
    # The last white character before a visible one stands apart from those before it ...
    before_word = np.zeros(n, bool)
    before_word[:-1] = white[:-1] & ~white[1:] & ~first[1:]
    start |= before_word
    # ... and is part of the word if it is a space.
    joined = before_word & (points == 32)
    start[1:] &= ~joined[:-1] | first[1:]
    quote = np.flatnonzero((points == 39) & start)
    if len(quote):
        quote = quote[quote + 1 < n]
        pad = np.concatenate([points, np.zeros(2, points.dtype)])
        last = np.concatenate([first, [True, True]])  # a following character is of the same row unless it is a first one
        a, b = pad[quote + 1], pad[quote + 2]
        one = ~last[quote + 1]
        two = one & ~last[quote + 2]
        short = one & np.isin(a, [ord(c) for c in "stmd"])
        long = two & (((a == ord("r")) & (b == ord("e"))) | ((a == ord("v")) & (b == ord("e"))) | ((a == ord("l")) & (b == ord("l"))))
        for at, width in ((quote[short], 2), (quote[long], 3)):
            start[at + 1] = False
            after = at + width
            after = after[after < n]
            start[after] = True
    return np.flatnonzero(start)


class WordTokenizer:
    """Ids of text columns; remembers up to ``remembered`` pre-tokens (then starts anew)."""

    def __init__(self, tokenizer_json: str, remembered: int = 700_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        self.tokenizer = Tokenizer.from_str(tokenizer_json)
        parts = json.loads(tokenizer_json)
        split = parts.get("pre_tokenizer") or {}
        added = parts.get("added_tokens") or []
        self.by_words = (split.get("type") == "ByteLevel" and split.get("use_regex", True) and not split.get("add_prefix_space", True)
                         and not any(parts.get(k) for k in ("normalizer", "truncation", "padding"))
                         and not any(t[k] for t in added for k in ("single_word", "lstrip", "rstrip", "normalized")))
        self.added = sorted((t["content"] for t in added), key=len, reverse=True)
        self.remembered = remembered
        self.known: dict[str, bytes] = {}

    def _ids(self, words: list[str]) -> list[bytes]:
        new = [w for w in words if w not in self.known]
        if new:
            if len(self.known) > self.remembered:
                self.known.clear()
                new = words
            for w, e in zip(new, self.tokenizer.encode_batch_fast(new, add_special_tokens=False), strict=True):
                self.known[w] = array("I", e.ids).tobytes()
        return [self.known[w] for w in words]

    def _added_spans(self, column: pa.Array, raw: bytes, bounds: np.ndarray) -> np.ndarray:
        """First and end byte (n x 2) of every added token in the rows, the longest at each place."""
        spans = []
        holds = np.zeros(len(column), bool)
        for content in self.added:
            holds |= pc.match_substring(column, content).fill_null(False).to_numpy(zero_copy_only=False)
        any_of = re.compile(b"|".join(re.escape(c.encode()) for c in self.added))
        for r in np.flatnonzero(holds).tolist():
            spans += [m.span() for m in any_of.finditer(raw, int(bounds[r]), int(bounds[r + 1]))]
        return np.array(spans, np.int64).reshape(-1, 2)

    def encode(self, column: pa.Array, end_id: int, limit: int = 1 << 21) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """(i, j, ids, ends): rows i to j's ids, ``end_id`` after each row, and where each row ends."""
        data, offsets = text_buffers(column)
        for i, j in blocks(offsets, limit):
            raw = data[offsets[i] : offsets[j]].tobytes()
            points = np.frombuffer(raw.decode("utf-8").encode("utf-32-le"), np.uint32)
            width = (1 + (points >= 0x80) + (points >= 0x800) + (points >= 0x10000)).astype(np.int64)
            at = np.concatenate([[0], np.cumsum(width)])
            bounds = offsets[i : j + 1] - offsets[i]
            row_starts = np.searchsorted(at, bounds)
            kind = _kind_table()[points]
            added = np.searchsorted(at, self._added_spans(column.slice(i, j - i), raw, bounds))
            starts = pre_token_starts(points, kind, np.concatenate([row_starts[:-1], added.ravel()]))
            inside = np.zeros(len(points) + 1, np.int8)
            inside[added[:, 0] + 1] += 1
            inside[added[:, 1]] -= 1
            starts = starts[np.cumsum(inside, dtype=np.int8)[starts] == 0]
            row = lambda point: np.searchsorted(row_starts, point, "right") - 1
            whole = np.full(j - i, not self.by_words)
            whole[row(np.flatnonzero(kind == UNKNOWN))] = True
            alone = np.empty(0, np.int64)  # the starts that are whole rows
            if whole.any():  # such a row is one "word", encoded apart
                starts = starts[~whole[row(starts)] | np.isin(starts, row_starts)]
                alone = np.flatnonzero(whole[row(starts)])
            cuts = at[np.append(starts, len(points))].astype(np.int32)
            words = pa.StringArray.from_buffers(len(starts), pa.py_buffer(cuts), pa.py_buffer(raw))
            if len(alone):
                texts = words.take(pa.array(alone)).to_pylist()
                apart = np.zeros(len(starts), bool)
                apart[alone] = True
                words = pc.if_else(pa.array(apart), pa.scalar("", pa.string()), words)
            coded = pc.dictionary_encode(words) if len(starts) else pa.array([], pa.string()).dictionary_encode()
            ids = self._ids(coded.dictionary.to_pylist())
            index = coded.indices.to_numpy(zero_copy_only=False).copy()
            if len(alone):
                index[alone] = len(ids) + np.arange(len(alone))
                # One at a time: an encoding of a long text takes many times its bytes.
                ids += [array("I", self.tokenizer.encode(t, add_special_tokens=False).ids).tobytes() for t in texts]
            flat = np.append(np.frombuffer(b"".join(ids), np.uint32), np.uint32(end_id))
            size = np.array([len(x) // 4 for x in ids] + [1], np.int32)  # the last "word" is the end id
            base = np.cumsum(size, dtype=np.int32) - size
            # Each row's words, then the end id.
            rows = j - i
            row_ends = np.searchsorted(starts, row_starts)[1:] + np.arange(1, rows + 1)
            code = np.full(len(starts) + rows, len(ids), np.int32)
            is_word = np.ones(len(code), bool)
            is_word[row_ends - 1] = False
            code[is_word] = index
            sizes = size[code]
            word_ends = np.cumsum(sizes, dtype=np.int32)
            place = np.repeat(base[code] - (word_ends - sizes), sizes)
            place += np.arange(len(place), dtype=np.int32)
            ends = word_ends[row_ends - 1].astype(np.int64)
            yield i, j, flat[place], ends


_loaded: dict[str, WordTokenizer] = {}


def word_tokenizer(tokenizer_json: str) -> WordTokenizer:
    """The tokenizer of this Python worker: parsed once, then shared by its tasks; only the last one is held."""
    key = hashlib.sha1(tokenizer_json.encode()).hexdigest()
    if key not in _loaded:
        _loaded.clear()
        _loaded[key] = WordTokenizer(tokenizer_json)
    return _loaded[key]
