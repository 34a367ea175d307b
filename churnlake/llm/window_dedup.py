"""Substring dedup on fixed windows of words.

Every window of ``window`` consecutive words has a Rabin-Karp hash (64 bits, over the
words' own hashes).  Chunks of documents count their own windows and send their distinct
hashes to buckets by leading bits; a bucket finds the hashes that more than one chunk
holds.  A window that occurs twice, anywhere, is repeated; the repeated windows of a
document merge into maximal intervals of words, which are removed.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from churnlake.llm import _chunks as C
from churnlake.llm._text import blocks, rolling_hash, text_buffers, word_hashes, word_spans

RESULT = "doc_id long, n_words long, n_removed long, removed array<struct<start:long,length:long>>, kept string"


class _Chunk:
    """A chunk's words and the hashes of its windows."""

    def __init__(self, table: pa.Table, window: int):
        self.rows = C.in_order(table)
        self.data, self.offsets = text_buffers(self.rows["text"])
        starts, ends, hashes, first, at = [], [], [], [np.zeros(1, np.int64)], 0
        for i, j in blocks(self.offsets, 1 << 19):
            lo = self.offsets[i]
            part = self.data[lo : self.offsets[j]]
            s, e, f = word_spans(part, self.offsets[i : j + 1] - lo)
            hashes.append(word_hashes(part, s, e))
            starts.append(s + lo)
            ends.append(e + lo)
            first.append(f[1:] + at)
            at += len(s)
        self.starts, self.ends, self.first = (np.concatenate(x or [np.empty(0, np.int64)]) for x in (starts, ends, first))
        words = np.concatenate(hashes or [np.empty(0, np.uint64)])
        whole = rolling_hash(words, window)
        # A window must end in the document it starts in.
        last = np.repeat(self.first[1:], np.diff(self.first)) - window
        self.at = np.flatnonzero(np.arange(len(whole)) <= last[: len(whole)])
        self.windows = whole[self.at]


def remove_repeated_windows(docs: DataFrame, window: int = 35, id_col: str = "doc_id", text_col: str = "text",
                            chunk_bytes: int = C.CHUNK_BYTES) -> DataFrame:
    """``doc_id, n_words, n_removed, removed, kept``: one row per row of ``docs``.

    A word goes if a window over it has a word sequence that starts anywhere else, in
    the same document too; windows are judged on the input.  ``removed`` lists the
    maximal intervals (first word, number of words), ``kept`` the other words joined by
    one space.  Words are runs of anything but \\x20 and \\x09 to \\x0D, compared as they
    are.  A null or empty text has no words; rows with equal or null ids are judged each
    as a document of its own; other columns are ignored.
    """
    rows, total = C.chunked(docs, id_col, text_col, chunk_bytes)
    buckets = C.bucket_count(max(1, total // 6))

    def send(key: tuple, table: pa.Table) -> pa.Table:
        return C.pack_hashes(key[0].as_py(), np.unique(_Chunk(table, window).windows), buckets)

    def remove(key: tuple, table: pa.Table, answers: pa.Table) -> pa.Table:
        chunk = _Chunk(table, window)
        values, index, count = np.unique(chunk.windows, return_inverse=True, return_counts=True)
        repeated = (C.read_bits(answers, values, buckets) | (count > 1))[index]
        edge = np.zeros(len(chunk.starts) + 1, np.int64)
        at = chunk.at[repeated]
        edge[at] += 1
        edge[at + window] -= 1
        gone = np.cumsum(edge[:-1]) > 0
        return _result(chunk, gone)

    packed = rows.groupBy("chunk").applyInArrow(send, C.HASHES)
    answers = C.shared_bits(packed)
    return rows.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(remove, RESULT)


def _result(chunk: _Chunk, gone: np.ndarray) -> pa.Table:
    lo, hi = C.runs(gone, chunk.first)
    spans = pa.StructArray.from_arrays([pa.array(lo - np.repeat(chunk.first[:-1], np.diff(np.searchsorted(lo, chunk.first)))), pa.array(hi - lo)],
                                       ["start", "length"])
    removed = pa.ListArray.from_arrays(pa.array(np.searchsorted(lo, chunk.first).astype(np.int32)), spans)
    # The kept words' bytes, each word after the first of its row behind one space.
    keep = np.flatnonzero(~gone)
    kept_first = np.searchsorted(keep, chunk.first)
    starts, size = chunk.starts[keep], chunk.ends[keep] - chunk.starts[keep]
    lead = np.ones(len(keep), np.int64)
    lead[kept_first[:-1][kept_first[:-1] < kept_first[1:]]] = 0
    ends = np.cumsum(size + lead)
    text = np.full(ends[-1] if len(ends) else 0, 32, np.uint8)
    for a in range(0, len(keep), 1 << 18):  # bounded index arrays
        s, n, e = starts[a : a + (1 << 18)], size[a : a + (1 << 18)], ends[a : a + (1 << 18)]
        step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        text[np.repeat(e - n, n) + step] = chunk.data[np.repeat(s, n) + step]
    bounds = np.concatenate([[0], ends])[kept_first].astype(np.int64)
    kept = pa.LargeStringArray.from_buffers(len(bounds) - 1, pa.py_buffer(bounds), pa.py_buffer(text.tobytes())).cast(pa.string())
    return pa.table({"doc_id": chunk.rows["doc_id"], "n_words": pa.array(np.diff(chunk.first)), "n_removed": pa.array(C.per_row(gone, chunk.first)),
                     "removed": removed, "kept": kept})
