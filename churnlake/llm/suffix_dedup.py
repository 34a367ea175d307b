"""Exact byte-substring dedup with a sparse suffix array.

A corpus has as many suffixes as bytes, and each would carry ``length`` bytes to its
bucket.  So only suffixes at anchors are sorted: the anchor of a ``length``-byte string
is the least hashed ``GRAM``-byte string in it, which equal strings have at the same
place, and only anchors whose first bytes occur in more than one document can matter.

1. Chunks of documents find their anchors; packed hashes of the anchors' first ``GRAM``
   bytes are counted in buckets, and unique ones drop out.
2. Each remaining anchor's suffix, with the bytes before it that a string over it needs,
   goes to one of the ranges that sampled splitters cut by the leading tokens (three of 8
   bytes).  The sample holds pieces of texts from everywhere, a fixed amount for each
   range.  Beyond ``MAX_RANGES`` ranges each is dealt on by the hash of the first ``GRAM``
   bytes, so the splitters stay bounded while ranges keep their size.  A chunk sends equal
   suffixes once, with their least document.
3. A range sorts its strings by multikey quicksort: by the first token, then each run of
   equals by the next, until seven tokens agree.  The splitters are cut before the
   suffixes' first ``GRAM`` bytes end, so strings that share an anchor never lie on both
   sides of a boundary, and neighbours are compared within a range only.
4. The least document of every run of equals answers, per suffix, which of the strings
   over the anchor an earlier document has; the chunks cut them out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlake.llm import _chunks as C
from churnlake.llm._common import let
from churnlake.llm._text import BYTE_VALUE, blocks, rolling_hash, text_buffers

GRAM = 25  # so a string has 26 grams, and a reign fits 32 bits
LEAD = 24  # bytes that the splitters compare: three tokens, fewer than GRAM
MAX_RANGES = 1 << 12  # ranges that splitters cut
PIECE = 1 << 12  # bytes of a sampled piece of text
SAMPLE_BYTES = 1 << 14  # bytes of sampled pieces for each range: some 70 leads
SUFFIXES = "part int, chunk long, suffixes binary, reign binary, owner binary, ordinal binary"
ANSWERS = "chunk long, ordinal binary, mask binary"
RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, removed array<struct<start:long,length:long>>, kept binary"


def _slide(x: np.ndarray, width: int, best: np.ufunc) -> np.ndarray:
    """``best`` over every ``width`` consecutive values, by doubling."""
    have, out = 1, x
    while have * 2 <= width:
        out = best(out[:-have], out[have:])
        have *= 2
    return best(out[: len(x) - width + 1], out[width - have :]) if have < width else out


class _Chunk:
    """A chunk's bytes, its anchors and the strings that each anchor stands for."""

    def __init__(self, table: pa.Table, length: int):
        self.length, self.rows = length, C.in_order(table)
        self.data, self.offsets = text_buffers(self.rows["text"])
        self.ids = self.rows["doc_id"].to_numpy()
        self.span = length - GRAM + 1  # grams in a string
        # Of each string that lies in one document, its least gram hash; 0 for others.
        self.least = np.zeros(len(self.data) + 1, np.uint64)
        at, gram = [np.empty(0, np.int64)], [np.empty(0, np.uint64)]
        for i, j in blocks(self.offsets, 1 << 18):
            lo, hi = int(self.offsets[i]), int(self.offsets[j])
            if hi - lo < length:
                continue
            g = rolling_hash(BYTE_VALUE[self.data[lo:hi]], GRAM) | np.uint64(1)
            least = _slide(g, self.span, np.minimum)
            edge = np.zeros(hi - lo + 1, np.int32)
            own = self.offsets[i : j + 1] - lo
            whole = np.diff(own) >= length
            np.add.at(edge, own[:-1][whole], 1)
            np.add.at(edge, own[1:][whole] - length + 1, -1)
            least[np.cumsum(edge)[: len(least)] == 0] = 0
            self.least[lo : lo + len(least)] = least
            pad = np.zeros(self.span - 1, np.uint64)
            a = np.flatnonzero(_slide(np.concatenate([pad, least, pad]), self.span, np.maximum) == g)
            at.append(a + lo)
            gram.append(g[a])
        self.at, self.gram = np.concatenate(at), np.concatenate(gram)
        self.doc = np.searchsorted(self.offsets, self.at, "right") - 1

    def suffixes(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Reign (bit o: the string that starts o bytes before the anchor is its own) and bytes around each anchor.

        Bytes that no such string covers are zero, so equal content gives equal rows.
        """
        if len(which) > 1 << 15:  # bounded index arrays
            parts = [self.suffixes(which[a : a + (1 << 15)]) for a in range(0, len(which), 1 << 15)]
            return np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
        at, span, before = self.at[which], self.span, self.span - 1
        start = at[:, None] - np.arange(span)
        own = (start >= 0) & (self.least[np.maximum(start, 0)] == self.gram[which][:, None])
        reign = (own.astype(np.uint64) << np.arange(span, dtype=np.uint64)).sum(1).astype(np.uint64)
        first = span - 1 - np.argmax(own[:, ::-1], 1)  # the largest o
        last = np.argmax(own, 1)
        column = np.arange(before + self.length)
        place = at[:, None] + (column - before)
        used = (column >= before - first[:, None]) & (column < before - last[:, None] + self.length)
        text = np.where(used, self.data[np.clip(place, 0, len(self.data) - 1)], 0).astype(np.uint8)
        return reign, text


def _rows_as_keys(reign: np.ndarray, text: np.ndarray) -> np.ndarray:
    wide = np.ascontiguousarray(np.concatenate([reign.astype("<u8").view(np.uint8).reshape(-1, 8), text], 1))
    return wide.view(np.dtype((np.void, wide.shape[1]))).ravel()


def _equal_runs(strings: np.ndarray) -> np.ndarray:
    """Run number of every string, equal exactly for equal strings: multikey quicksort on tokens of 8 bytes.

    The first token sorts all; then every run of equals is sorted by the next one.
    """
    run = np.zeros(len(strings), np.int64)
    todo = np.arange(len(strings))
    for k in range(0, strings.shape[1], 8):
        if not len(todo):
            break
        key = np.ascontiguousarray(strings[todo, k : k + 8]).view(">u8").ravel().astype(np.uint64)
        order = np.lexsort((key, run[todo]))
        todo, key = todo[order], key[order]
        old = run[todo]
        new = np.ones(len(todo), bool)
        new[1:] = (old[1:] != old[:-1]) | (key[1:] != key[:-1])
        starts = np.flatnonzero(new)
        sizes = np.diff(np.append(starts, len(todo)))
        number = starts[0] + np.cumsum(new)
        base = run.max() + 1
        run[todo] = base + number
        todo = todo[np.repeat(sizes > 1, sizes)]
    return np.unique(run, return_inverse=True)[1]


def _earlier(reign: np.ndarray, text: np.ndarray, owner: np.ndarray, length: int) -> np.ndarray:
    """Of each suffix, the strings of its reign (as bits) that a suffix with a smaller owner has too."""
    n = len(reign)
    mask = np.zeros(n, np.uint64)
    if n < 2:
        return mask
    order = np.argsort(owner, kind="stable")
    keys = _rows_as_keys(reign, text)[order]
    _, first, back = np.unique(keys, return_index=True, return_inverse=True)
    group = np.empty(n, np.int64)
    group[order] = back
    one = order[first]  # of equal suffixes, the one with the least owner
    before = text.shape[1] - length
    who, o = np.nonzero((reign[one][:, None] >> np.arange(before + 1, dtype=np.uint64)) & np.uint64(1))
    strings = np.zeros((len(who), -(-length // 8) * 8), np.uint8)
    for k in range(before + 1):
        at = o == k
        strings[at, :length] = text[one[who[at]], before - k : before - k + length]
    run = _equal_runs(strings)
    del strings
    least = np.full(run.max() + 1, np.iinfo(np.int64).max)
    np.minimum.at(least, run, owner[one][who])
    table = np.full((len(one), before + 1), np.iinfo(np.int64).max)
    table[who, o] = least[run]
    return ((table[group] < owner[:, None]).astype(np.uint64) << np.arange(before + 1, dtype=np.uint64)).sum(1).astype(np.uint64)


def _splitters(rows: DataFrame, length: int, parts: int, rate: int) -> np.ndarray:
    """At most ``parts - 1`` leads that cut the suffixes evenly: quantiles of every 16th anchor of one piece of text in ``rate``.

    Pieces are picked by hash from all rows, so long texts and short ones count by their
    bytes.  Only balance depends on the sample.
    """
    pieces = F.sequence(F.lit(0), F.floor(F.octet_length("text") / F.lit(PIECE)).cast("int"))
    picked = F.filter(pieces, lambda i: F.pmod(F.xxhash64("mark", i), F.lit(rate)) == 0)
    cut = let(F.col("text").cast("binary"), lambda body: F.transform(picked, lambda i: F.substring(body, i * PIECE + 1, F.lit(PIECE))))

    def leads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            chunk = _Chunk(pa.table({"doc_id": pa.array(np.zeros(n, np.int64)), "mark": pa.array(np.arange(n)), "text": batch.column(0)}), length)
            yield pa.RecordBatch.from_arrays([pa.array([chunk.data[a : a + LEAD].tobytes() for a in chunk.at[::16].tolist()], pa.binary())], ["lead"])

    found = rows.select(F.explode(cut).alias("text")).mapInArrow(leads, "lead binary").toArrow()["lead"].to_pylist()
    sample = np.sort(np.array(found, f"S{LEAD}"))
    return np.unique(sample[len(sample) * np.arange(1, parts) // parts]) if len(sample) else sample


def remove_repeated_bytes(docs: DataFrame, length: int = 50, id_col: str = "doc_id", text_col: str = "text",
                          chunk_bytes: int = C.CHUNK_BYTES, part_bytes: int = 4 << 20) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, removed, kept``: one row per row of ``docs``.

    A byte goes if a ``length``-byte string over it (``length`` from 25 to 56) also starts
    in a document with a smaller id; strings are judged on the input and never cross
    documents.  ``removed`` lists the maximal runs, ``kept`` holds the other bytes.  A null
    text is empty.  Rows of one id are not smaller than each other.  Rows without an id
    lose nothing and count for nothing.  Other columns are ignored.
    """
    if not GRAM <= length <= GRAM + 31:
        raise ValueError(f"length is {length}; strings have from {GRAM} to {GRAM + 31} bytes")
    spark = docs.sparkSession
    known = docs.where(F.col(id_col).isNotNull())
    rows, total = C.chunked(known, id_col, text_col, chunk_bytes)
    buckets = C.bucket_count(max(1, total // 12))
    wanted = max(1, -(-total // part_bytes))
    parts = min(wanted, MAX_RANGES)
    deals = -(-wanted // parts)

    def send(key: tuple, table: pa.Table) -> pa.Table:
        return C.pack_hashes(key[0].as_py(), np.unique(_Chunk(table, length).gram), buckets)

    answers = C.shared_bits(rows.groupBy("chunk").applyInArrow(send, C.HASHES))

    cuts = _splitters(rows, length, parts, max(1, total // parts // SAMPLE_BYTES)) if parts > 1 else np.array([], f"S{LEAD}")
    splitters = spark.sparkContext.broadcast(cuts)

    def candidates(key: tuple, table: pa.Table, bits: pa.Table) -> pa.Table:
        chunk = _Chunk(table, length)
        values, index = np.unique(chunk.gram, return_inverse=True)
        which = np.flatnonzero(C.read_bits(bits, values, buckets)[index])
        out: dict[str, list] = {k: [] for k in ("part", "suffixes", "reign", "owner", "ordinal")}
        if len(which):
            reign, text = chunk.suffixes(which)
            # Rows are in order of id, so the first of equals has the least id.
            _, first = np.unique(_rows_as_keys(reign, text), return_index=True)
            reign, text, which = reign[first], text[first], which[first]
            lead = np.ascontiguousarray(text[:, chunk.span - 1 : chunk.span - 1 + LEAD]).view(f"S{LEAD}").ravel()
            part = np.searchsorted(splitters.value, lead, "right") * deals + (chunk.gram[which] >> np.uint64(8)).astype(np.int64) % deals
            for p in np.unique(part).tolist():
                at = np.flatnonzero(part == p)
                out["part"].append(p)
                out["suffixes"].append(text[at].tobytes())
                out["reign"].append(reign[at].astype(np.uint32).tobytes())
                out["owner"].append(chunk.ids[chunk.doc[which[at]]].astype(np.int64).tobytes())
                out["ordinal"].append(which[at].astype(np.uint32).tobytes())
        n = len(out["part"])
        return pa.table({"part": pa.array(out["part"], pa.int32()), "chunk": pa.array([key[0].as_py()] * n, pa.int64()),
                         **{k: pa.array(out[k], pa.binary()) for k in ("suffixes", "reign", "owner", "ordinal")}})

    def compare(group: pa.Table) -> pa.Table:
        load = lambda name, kind: [np.frombuffer(x, kind) for x in group[name].to_pylist()]
        reign, owner, ordinal = load("reign", np.uint32), load("owner", np.int64), load("ordinal", np.uint32)
        text = np.concatenate(load("suffixes", np.uint8)).reshape(-1, 2 * length - GRAM)
        mask = _earlier(np.concatenate(reign).astype(np.uint64), text, np.concatenate(owner), length)
        masks = np.split(mask, np.cumsum([len(r) for r in reign])[:-1])
        hit = [m != 0 for m in masks]
        return pa.table({"chunk": group["chunk"], "ordinal": pa.array([o[h].tobytes() for o, h in zip(ordinal, hit, strict=True)], pa.binary()),
                         "mask": pa.array([m[h].tobytes() for m, h in zip(masks, hit, strict=True)], pa.binary())})

    def remove(key: tuple, table: pa.Table, found: pa.Table) -> pa.Table:
        chunk = _Chunk(table, length)
        ids = chunk.ids.astype(np.int64)
        edge = np.zeros(len(chunk.data) + length + 1, np.int64)

        def cut(which: np.ndarray, mask: np.ndarray) -> None:
            who, o = np.nonzero((mask[:, None] >> np.arange(chunk.span, dtype=np.uint64)) & np.uint64(1))
            start = chunk.at[which[who]] - o
            np.add.at(edge, start, 1)
            np.add.at(edge, start + length, -1)

        # What other chunks have: an answer holds for every anchor with the same suffix.
        ordinal = np.concatenate([np.frombuffer(x, np.uint32) for x in found["ordinal"].to_pylist()] or [np.empty(0, np.uint32)])
        if len(ordinal):
            mask = np.concatenate([np.frombuffer(x, np.uint64) for x in found["mask"].to_pylist()])
            which = np.flatnonzero(np.isin(chunk.gram, chunk.gram[ordinal]))
            keys, index = np.unique(_rows_as_keys(*chunk.suffixes(which)), return_inverse=True)
            answer = np.zeros(len(keys), np.uint64)
            answer[index[np.searchsorted(which, ordinal)]] = mask
            cut(which, answer[index])
        # What this chunk's own documents have.
        values, index = np.unique(chunk.gram, return_inverse=True)
        if len(values):
            low, high = np.full(len(values), len(ids)), np.full(len(values), -1)
            np.minimum.at(low, index, chunk.doc)
            np.maximum.at(high, index, chunk.doc)
            which = np.flatnonzero((ids[low] != ids[high])[index])
            if len(which):
                cut(which, _earlier(*chunk.suffixes(which), ids[chunk.doc[which]], length))
        gone = np.cumsum(edge[: len(chunk.data)]) > 0
        lo, hi = C.runs(gone, chunk.offsets)
        n_spans = np.diff(np.searchsorted(lo, chunk.offsets))
        spans = pa.StructArray.from_arrays([pa.array(lo - np.repeat(chunk.offsets[:-1], n_spans)), pa.array(hi - lo)], ["start", "length"])
        n_removed = C.per_row(gone, chunk.offsets)
        bounds = np.concatenate([[0], np.cumsum(np.diff(chunk.offsets) - n_removed)]).astype(np.int64)
        kept = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(bounds) - 1, [None, pa.py_buffer(bounds), pa.py_buffer(chunk.data[~gone].tobytes())])
        return pa.table({
            "doc_id": chunk.rows["doc_id"], "n_bytes": pa.array(np.diff(chunk.offsets)), "n_removed": pa.array(n_removed), "n_spans": pa.array(n_spans),
            "removed": pa.ListArray.from_arrays(pa.array(np.searchsorted(lo, chunk.offsets).astype(np.int32)), spans), "kept": kept.cast(pa.binary())})

    suffixes = rows.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(candidates, SUFFIXES)
    found = suffixes.groupBy("part").applyInArrow(compare, ANSWERS)
    out = rows.groupBy("chunk").cogroup(found.groupBy("chunk")).applyInArrow(remove, RESULT)
    loose = docs.where(F.col(id_col).isNull()).select(
        F.col(id_col).cast("long").alias("doc_id"), F.encode(F.coalesce(F.col(text_col), F.lit("")), "UTF-8").alias("kept"))
    loose = loose.select("doc_id", F.octet_length("kept").cast("long").alias("n_bytes"), F.lit(0).cast("long").alias("n_removed"),
                         F.lit(0).cast("long").alias("n_spans"), F.array().cast("array<struct<start:long,length:long>>").alias("removed"), "kept")
    return out.unionByName(loose)
