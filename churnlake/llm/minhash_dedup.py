"""Near-dedup by SuperMinHash signatures, banding, exact verification and components.

1. Documents become sets of word shingles (64-bit hashes).  Documents of equal sets form
   a class (a grouping on a set digest); the rest works on one set of each class.
2. SuperMinHash (Ertl, 2017): every element walks one random permutation of the bins and
   offers step + fraction to each bin in turn; a set stops as soon as no bin can improve,
   after one or two steps for large sets.  The values are cut to 16 bits, four to a band.
3. Classes that share a band are candidates.  First each is verified against the least
   class that shares a band with it: one pair per class, however large a group is.
4. Buckets that still hold several components go on: their classes form clusters (the
   components of sharing an open bucket).  A cluster's sets meet all at once, or bucket by
   bucket where that reads fewer bytes: in a long chain of buckets, whose cluster may be
   most of the corpus.  Both ways compare every pair that shares an open bucket.  Sets meet
   in blocks of bounded bytes, each pair of blocks in one task.  An inverted index over the
   block counts the common shingles of every class outside the block's largest component;
   only a spanning set of the links between components is emitted, never the pairs.
Verified links go through distributed connected components; those of step 4 join the
components of step 3, so they are contracted first.  Sets are compared in tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlake.llm._common import connected_components, materialise
from churnlake.llm._text import blocks, mix, text_buffers, word_hashes, word_runs, word_spans

BANDS, ROWS = 30, 4
PLACES = BANDS * ROWS
BLOCK_BYTES = 4 << 20
SIGNED = "doc_id long, n_shingles long, d1 long, d2 long, bands array<long>"
_STEP = np.uint64(48)
_WORD = (1 << 64) - 1


def shingle_sets(column: pa.Array, size: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(i, j, hashes, bounds): for rows i to j, each row's sorted distinct shingles one after another."""
    data, offsets = text_buffers(column)
    for i, j in blocks(offsets, 1 << 19):
        lo = offsets[i]
        part = data[lo : offsets[j]]
        starts, ends, first = word_spans(part, offsets[i : j + 1] - lo)
        hashes, row = word_runs(word_hashes(part, starts, ends, lower=True), first, size)
        cut = np.searchsorted(row, np.arange(j - i + 1))
        sets = [np.unique(hashes[a:b]) for a, b in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True)]
        yield i, j, np.concatenate(sets), np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int64)


def superminhash(hashes: np.ndarray, bounds: np.ndarray, places: int = PLACES) -> np.ndarray:
    """Signatures (rows x places, uint64) of the sets between consecutive bounds; empty sets stay at the maximum."""
    rows = len(bounds) - 1
    sig = np.full((rows, places), np.iinfo(np.uint64).max, np.uint64)
    flat = sig.reshape(-1)
    row = np.repeat(np.arange(rows), np.diff(bounds))
    active, perm = hashes, None
    for step in range(places):
        if not len(active):
            break
        # One draw per element and step: the swap partner and the fraction.
        draw = mix(active + np.uint64((step + 1) * 0xD1342543DE82EF95 & _WORD))
        partner = step + ((draw >> np.uint64(32)) * np.uint64(places - step) >> np.uint64(32)).astype(np.int64)
        if step == 0:
            place = partner
        else:
            each = np.arange(len(active))
            place = perm[each, partner].astype(np.int64)
            perm[each, partner] = perm[:, step]
        value = (np.uint64(step) << _STEP) | (mix(draw) >> (np.uint64(64) - _STEP))
        np.minimum.at(flat, row * places + place, value)
        more = sig.max(1) >= (np.uint64(step + 1) << _STEP)
        more[np.diff(bounds) == 0] = False
        left = more[row]
        if step == 0:
            place = place[left]
            perm = np.tile(np.arange(places, dtype=np.uint8), (len(place), 1))
            perm[np.arange(len(place)), place] = 0  # the swap of step 0
        else:
            perm = perm[left]
        active, row = active[left], row[left]
    return sig


def sign(docs: DataFrame, size: int, id_col: str, text_col: str) -> DataFrame:
    """``doc_id, n_shingles, d1, d2, bands``: set size, set digest and signature of every row (no bands if empty)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, hashes, bounds in shingle_sets(batch.column(1), size):
                n = np.diff(bounds)
                bands = np.ascontiguousarray((mix(superminhash(hashes, bounds)) >> _STEP).astype(np.uint16)).view(np.int64)
                total = [np.concatenate([[np.uint64(0)], np.cumsum(mix(hashes ^ np.uint64(c)))]) for c in (0x5bd1e995, 0x1b873593)]
                d1, d2 = ((t[bounds[1:]] - t[bounds[:-1]]).view(np.int64) for t in total)
                at = np.concatenate([[0], np.cumsum(np.where(n > 0, BANDS, 0))]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i), pa.array(n), pa.array(d1), pa.array(d2),
                     pa.ListArray.from_arrays(pa.array(at), pa.array(bands[n > 0].reshape(-1)))], ["doc_id", "n_shingles", "d1", "d2", "bands"])

    return docs.select(F.col(id_col).cast("long"), F.col(text_col)).mapInArrow(run, SIGNED)


def _sets_of(docs: DataFrame, ids: DataFrame, size: int, id_col: str, text_col: str) -> DataFrame:
    """``id, shingles`` (packed hashes) of the rows whose id is in ``ids(id)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, hashes, bounds in shingle_sets(batch.column(1), size):
                sets = [hashes[a:b].tobytes() for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), pa.array(sets, pa.binary())], ["id", "shingles"])

    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).join(ids, "id", "left_semi")
    return texts.mapInArrow(run, "id long, shingles binary")


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets reach the similarity."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                s, t = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                both = len(np.intersect1d(s, t, assume_unique=True))
                keep.append(100 * both >= percent * (len(s) + len(t) - both))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    left = sets.select(F.col("id").alias("a"), F.col("shingles").alias("sa"))
    right = sets.select(F.col("id").alias("b"), F.col("shingles").alias("sb"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "sa", "sb").mapInArrow(run, "a long, b long").distinct()


def _linker(percent: int):
    """Pairs of components that a pair of blocks (``rep, component, block, shingles``) links: a spanning set."""

    def run(key: tuple, group: pa.Table) -> pa.Table:
        order = np.argsort(group["rep"].to_numpy(), kind="stable")
        rep, comp, block = (group[c].to_numpy()[order] for c in ("rep", "component", "block"))
        sets = group["shingles"].combine_chunks()
        sets = [np.frombuffer(sets[k].as_buffer(), np.uint64) for k in order.tolist()]
        size = np.array([len(x) for x in sets])
        row = np.repeat(np.arange(len(sets)), size)
        term = np.unique(np.concatenate(sets), return_inverse=True)[1]
        first = np.cumsum(size) - size
        posting = row[np.argsort(term, kind="stable")]
        bound = np.concatenate([[0], np.cumsum(np.bincount(term))])
        names, local, count = np.unique(comp, return_inverse=True, return_counts=True)
        local = local.copy()
        a, b = [], []
        for k in np.flatnonzero(local != np.argmax(count)).tolist():
            own = term[first[k] : first[k] + size[k]]
            n = bound[own + 1] - bound[own]
            at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(bound[own], n)
            both = np.bincount(posting[at], minlength=len(sets))
            linked = (100 * both >= percent * (size + size[k] - both)) & (local != local[k])
            if key[2] != key[3]:
                linked &= block != block[k]
            for other in np.flatnonzero(linked).tolist():
                if local[other] != local[k]:
                    local[local == local[other]] = local[k]
                    a.append(comp[k])
                    b.append(comp[other])
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return run


def _blocks(members: DataFrame, by: list[str]) -> DataFrame:
    """Per unit (cluster or bucket): how many blocks its sets fill, and the bytes that reach tasks if each block meets each."""
    size = F.sum(F.col("n_shingles") * 8)
    count = F.greatest(F.ceil(size / F.lit(BLOCK_BYTES)), F.lit(1)).cast("long")
    return members.groupBy(*by).agg(count.alias("blocks"), (count * size).cast("double").alias("cost"))


def _meetings(members: DataFrame, found: DataFrame) -> DataFrame:
    """Which classes meet in which task: ``cluster, key, lo, hi, rep, component, block``, a task for each cluster, key, lo and hi.

    ``members`` has a row ``key, rep, n_shingles`` for each class of each shared bucket,
    ``found`` the components so far.
    """
    placed = members.join(found.withColumnRenamed("id", "rep"), "rep", "left").select(
        "key", "rep", "n_shingles", F.coalesce("component", "rep").alias("component"))
    several = placed.groupBy("key").agg(F.min("component").alias("x"), F.max("component").alias("y"), F.min("rep").alias("low")).where("x < y")
    open_ = materialise(placed.join(several.select("key", "low"), "key"), "open")
    cluster = connected_components(open_.select(F.col("rep").alias("a"), F.col("low").alias("b"))).withColumnRenamed("component", "cluster")
    grouped = materialise(open_.drop("low").join(cluster.withColumnRenamed("id", "rep"), "rep"), "grouped")
    once = grouped.drop("key").distinct()
    whole, each = _blocks(once, ["cluster"]), _blocks(grouped, ["cluster", "key"])
    # Each cluster goes the way that reads less; every pair of a shared open bucket is compared on both.
    ways = whole.withColumnRenamed("cost", "at_once").join(each.groupBy("cluster").agg(F.sum("cost").alias("by_bucket")), "cluster")
    ways = materialise(ways.select("cluster", "blocks", (F.col("by_bucket") < F.col("at_once")).alias("split")), "ways")
    together = once.join(ways.where("NOT split"), "cluster").withColumn("key", F.lit(0).cast("long"))
    apart = grouped.join(ways.where("split").select("cluster"), "cluster").join(each.drop("cost"), ["cluster", "key"])
    names = ["cluster", "key", "rep", "component", "blocks"]
    rows = together.select(*names).unionByName(apart.select(*names))
    rows = rows.withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    return rows.select("cluster", "key", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"), "rep", "component", "block")


def _cluster_links(members: DataFrame, sets: DataFrame, found: DataFrame, percent: int) -> DataFrame:
    """``a, b``: the components of ``found`` that links within open buckets join (a spanning set in every pair of blocks)."""
    rows = _meetings(members, found).join(sets.withColumnRenamed("id", "rep"), "rep")
    return rows.groupBy("cluster", "key", "lo", "hi").applyInArrow(_linker(percent), "a long, b long")


def _contracted(found: DataFrame, merged: DataFrame) -> DataFrame:
    """Components ``found(id, component)`` after ``merged(id, component)`` joined some of them (or classes that had no link before)."""
    known = found.withColumnRenamed("component", "c").join(
        merged.select(F.col("id").alias("c"), F.col("component").alias("m")), "c", "left").select("id", F.coalesce("m", "c").alias("component"))
    return known.unionByName(merged.join(found.select("id"), "id", "left_anti"))


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id, kept``: one row per row of ``docs``.

    Two documents are linked if ``100 * intersection >= percent * union`` of their sets of
    ``size``-word shingles (words: A-Z lower-cased, cut at \\x20 and \\x09 to \\x0D; with
    fewer words, the whole sequence is one shingle).  ``component_id`` is the least id
    reachable over links, ``kept`` marks the document that bears it.  Documents without
    words are linked with nothing.  Rows of one id are one document with several texts:
    linked if any of its texts is, all in one component.  Rows without an id have no component and are kept.
    Other columns are ignored; no rows give no rows.
    """
    signed = materialise(sign(docs, size, id_col, text_col), "signed")
    key = ["n_shingles", "d1", "d2"]
    known = signed.where(F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0))
    classes = materialise(known.groupBy(*key).agg(F.min("doc_id").alias("rep"), F.first("bands").alias("bands")), "classes")

    bands = classes.select("rep", "n_shingles", F.posexplode("bands").alias("band", "value")).select(
        "rep", "n_shingles", F.xxhash64("band", "value").alias("key"))
    shared = bands.groupBy("key").agg(F.min("rep").alias("low"), F.max("rep").alias("high")).where(F.col("low") < F.col("high"))
    members = materialise(bands.join(shared.drop("high"), "key"), "members")
    sets = materialise(_sets_of(docs, members.select(F.col("rep").alias("id")).distinct(), size, id_col, text_col), "sets")

    # Rows of one id in several classes tie these together.
    ids = signed.where(F.col("doc_id").isNotNull())
    several = ids.groupBy("doc_id").agg(F.min(F.struct(*key)).alias("x"), F.max(F.struct(*key)).alias("y")).where("x <> y").select("doc_id")
    of_id = materialise(known.join(several, "doc_id", "left_semi").select("doc_id", *key).distinct().join(
        classes.drop("bands"), key).select("doc_id", "rep").distinct(), "of_id")
    least = of_id.groupBy("doc_id").agg(F.min("rep").alias("b"))
    same = of_id.join(least, "doc_id").select(F.col("rep").alias("a"), "b").where("a <> b").distinct()

    pairs = members.groupBy(F.col("rep").alias("a")).agg(F.min("low").alias("b")).where(F.col("a") != F.col("b"))
    links = materialise(_verified(pairs, sets, percent).unionByName(same), "links")
    found = connected_components(links)
    merged = connected_components(_cluster_links(members.drop("low"), sets, found, percent))
    found = _contracted(found, merged)
    where = classes.drop("bands").join(found.withColumnRenamed("id", "rep"), "rep", "left").select(
        *key, F.coalesce("component", "rep").alias("of_class"))
    # An id's rows without words are of the component of its other rows.
    by_id = least.join(found.withColumnRenamed("id", "b"), "b", "left").select("doc_id", F.coalesce("component", "b").alias("of_id"))
    own = F.when(F.col("n_shingles") > 0, F.coalesce("of_id", "of_class", "doc_id")).otherwise(F.coalesce("of_id", "doc_id"))
    return signed.drop("bands").join(where, key, "left").join(by_id, "doc_id", "left").select(
        "doc_id", "n_shingles", own.alias("component_id"),
    ).withColumn("component_id", F.when(F.col("doc_id").isNotNull(), F.col("component_id"))).withColumn(
        "kept", F.coalesce(F.col("component_id") == F.col("doc_id"), F.lit(True)))
