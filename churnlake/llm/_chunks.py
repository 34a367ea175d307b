"""Documents in chunks, and hashes of chunks counted in buckets.

A corpus has far more windows or anchors than rows.  Each chunk (some megabytes of
documents, picked by hash) sends every bucket one packed array of its distinct hashes;
the bucket answers with one bit per hash.  A hash that a third of all documents hold
arrives once per chunk.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlake.llm._common import ship_code, text_bytes

CHUNK_BYTES = 4 << 20
HASHES = "bucket int, chunk long, hashes binary"
BITS = "chunk long, bucket int, bits binary"


def chunked(docs: DataFrame, id_col: str, text_col: str, chunk_bytes: int = CHUNK_BYTES) -> tuple[DataFrame, int]:
    """``chunk, doc_id, mark, text`` (rows of equal id and text share a chunk) and the total bytes of text."""
    ship_code(docs.sparkSession)
    total = int(text_bytes(docs, text_col))
    chunks = max(1, -(-total // chunk_bytes))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = rows.withColumn("mark", F.xxhash64("doc_id", "text"))
    return rows.select(F.pmod(F.xxhash64("mark"), F.lit(chunks)).alias("chunk"), "doc_id", "mark", "text"), total


def in_order(chunk: pa.Table) -> pa.Table:
    """A chunk's rows in an order that does not depend on the shuffle (null ids first)."""
    return chunk.take(pc.sort_indices(chunk, [("doc_id", "ascending"), ("mark", "ascending")], null_placement="at_start"))


def bucket_count(hashes: int, per_bucket: int = 1 << 19) -> int:
    """A power of two with about ``per_bucket`` hashes in each bucket."""
    return 1 << max(0, int(hashes - 1).bit_length() - (per_bucket - 1).bit_length())


def bucket_bounds(values: np.ndarray, buckets: int) -> np.ndarray:
    """Where each bucket (the leading bits) begins in sorted ``values``; one more at the end."""
    if buckets == 1:
        return np.array([0, len(values)])
    edge = np.arange(1, buckets, dtype=np.uint64) << np.uint64(64 - (buckets - 1).bit_length())
    return np.concatenate([[0], np.searchsorted(values, edge), [len(values)]])


def pack_hashes(chunk: int, values: np.ndarray, buckets: int) -> pa.Table:
    """Rows (bucket, chunk, hashes) of a chunk's sorted distinct hashes."""
    bounds = bucket_bounds(values, buckets)
    full = np.flatnonzero(bounds[1:] > bounds[:-1])
    blobs = [values[bounds[b] : bounds[b + 1]].tobytes() for b in full]
    return pa.table({"bucket": pa.array(full, pa.int32()), "chunk": pa.array(np.full(len(full), chunk), pa.int64()), "hashes": pa.array(blobs, pa.binary())})


def shared_bits(packed: DataFrame) -> DataFrame:
    """For every chunk and bucket, which of its hashes another chunk has too (``BITS``; none: no row)."""

    def count(group: pa.Table) -> pa.Table:
        arrays = [np.frombuffer(x.as_buffer(), np.uint64) for x in group["hashes"].combine_chunks()] if group.num_rows else []
        values = np.concatenate(arrays)
        order = np.argsort(values, kind="stable")
        values = values[order]
        same = values[1:] == values[:-1]
        twice = np.zeros(len(values), bool)
        twice[1:] |= same
        twice[:-1] |= same
        flags = np.empty(len(values), bool)
        flags[order] = twice
        parts = np.split(flags, np.cumsum([len(a) for a in arrays])[:-1])
        keep = [k for k, p in enumerate(parts) if p.any()]
        return pa.table({"chunk": group["chunk"].take(pa.array(keep, pa.int64())), "bucket": group["bucket"].take(pa.array(keep, pa.int64())),
                         "bits": pa.array([np.packbits(parts[k]).tobytes() for k in keep], pa.binary())})

    return packed.groupBy("bucket").applyInArrow(count, BITS)


def read_bits(answers: pa.Table, values: np.ndarray, buckets: int) -> np.ndarray:
    """The answers as one flag for each of the chunk's sorted distinct hashes."""
    flags = np.zeros(len(values), bool)
    bounds = bucket_bounds(values, buckets)
    for b, bits in zip(answers["bucket"].to_pylist(), answers["bits"].to_pylist(), strict=True):
        n = bounds[b + 1] - bounds[b]
        flags[bounds[b] : bounds[b + 1]] = np.unpackbits(np.frombuffer(bits, np.uint8), count=n).astype(bool)
    return flags


def runs(mask: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of ``mask``, cut at the row offsets."""
    n = len(mask)
    cut = np.zeros(n + 1, bool)
    cut[offsets] = True
    start, end = mask.copy(), mask.copy()
    if n > 1:
        start[1:] &= ~mask[:-1] | cut[1:n]
        end[:-1] &= ~mask[1:] | cut[1:n]
    return np.flatnonzero(start), np.flatnonzero(end) + 1


def per_row(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sums of ``values`` between consecutive offsets."""
    total = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    return total[offsets[1:]] - total[offsets[:-1]]
