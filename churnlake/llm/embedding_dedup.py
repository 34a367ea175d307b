"""Embedding near-dedup: blocks of a label meet pair by pair, cells of random directions spare most comparisons.

1. Rows travel in blobs of many vectors.  A label of up to ``BLOCK`` vectors is one group; a
   larger one is dealt by hash into blocks, each the home of its own vectors and host of those of
   half the other blocks, so any two vectors meet exactly once.
2. Beyond ``BLOCKS`` blocks a label falls into cells first: a vector lives in the cell of the
   random direction it points to most, and visits those that come within a margin of it.  Two
   vectors meet if either visits the other's home, and count in one place.  How a label is
   divided comes from a bounded sample (``MAX_FIT`` vectors); every vector is routed.
3. In a group the same cells, finer and in memory only, choose what is compared.  Equal vectors
   are one with a count.  Products are single precision, those near the threshold are made again
   in double precision.  Links are counted without emitting pairs, and only a spanning set of
   them leaves the task, for connected components.  Homes are held, visitors stream by.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import groupby, islice
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnlake.llm._common import connected_components, materialise, ship_code, small_batches

TREES = 4
MARGIN = 3.5  # in standard deviations of what a pair at the threshold differs by along a random direction
LEAF = 128  # vectors of a group that a cell in memory aims at
MAX_FIT = 20_000
BLOCK = 327_680  # vectors of a label that are held at once, of BLOCK_BYTES at most
BLOCK_BYTES = 80 << 20
BLOCKS = 8
CELLS = 64  # of a label, at most; bits of a long
FINE = 512  # cells in memory, at most
BLOB = 32 << 10
BATCH = 256
TILE = 256, 1024
ROUTED = "spot int, size int, label long, cell int, block int, guest boolean, rows int, data binary"
FOUND = "label long, h1 long, h2 long, rep long, n long, links long, other1 long, other2 long"
META = (("id", np.int64), ("h1", np.int64), ("h2", np.int64), ("n", np.int64), ("cells", np.uint64), ("home", np.int16))


def _scaled(x: np.ndarray) -> np.ndarray:
    """Exact scaling by a power of two: squares of very large or very small components stay in range."""
    return np.ldexp(x, -np.frexp(np.abs(x).max(axis=1, keepdims=True))[1])


def _unit(x: np.ndarray) -> np.ndarray:
    x = _scaled(x.astype(np.float64))
    return x / np.linalg.norm(x, axis=1, keepdims=True)


@lru_cache(16)
def directions(size: int, count: int, seed: int) -> np.ndarray:
    """``count`` unit vectors: random orthogonal ones and their opposites, set after set."""
    rng = np.random.Generator(np.random.PCG64([seed, size]))
    sets = []
    while sum(map(len, sets)) < count:
        q = np.linalg.qr(rng.standard_normal((size, min(size, (count + 1) // 2))))[0].T
        sets.append(np.stack([q, -q], axis=1).reshape(-1, size))
    return np.concatenate(sets)[:count].astype(np.float32)


def margin(threshold: float, size: int) -> float:
    """How far behind its best direction's a vector's product with another may be for it to visit that one's cell."""
    return MARGIN * float(np.sqrt(max(0.0, 2 - 2 * threshold) / size))


def _cells(x: np.ndarray, pivots: np.ndarray, reach: float) -> tuple[np.ndarray, np.ndarray]:
    """Home cell of every row, and whether it lives in or visits each cell.

    For unit vectors, whose mean is not taken off: that what a pair shares outweighs what it
    differs by is what keeps its vectors in reach of each other, in tight clusters too.
    """
    p = x @ pivots.T
    home = p.argmax(1)
    return home, p >= p[np.arange(len(p)), home][:, None] - np.float32(reach)


def _alike(order: np.ndarray, *keys: np.ndarray) -> np.ndarray:
    """Where a run of equal keys begins in ``order``."""
    new = np.ones(len(order), bool)
    if len(order):
        new[1:] = np.any([k[order][1:] != k[order][:-1] for k in keys], axis=0)
    return np.flatnonzero(new)


def _hosts(block: np.ndarray, other: int, blocks: int) -> np.ndarray:
    """Whether rows of ``block`` are guests of block ``other``: of any two blocks one is the other's guest."""
    ahead = (other - block) % blocks
    return (ahead > 0) & ((2 * ahead < blocks) | ((2 * ahead == blocks) & (block < other)))


def _pack(meta: dict[str, np.ndarray], x: np.ndarray, rows: np.ndarray) -> Iterator[tuple[int, bytes]]:
    step = max(1, BLOB // (x.shape[1] * x.itemsize))
    for at in range(0, len(rows), step):
        own = rows[at : at + step]
        yield len(own), b"".join([*(meta[k][own].tobytes() for k, _ in META), x[own].tobytes()])


class _Rows:
    """Vectors of a group; once settled distinct, scaled, with counts and least ids, sorted by home cell."""

    def __init__(self, size: int, kind: type) -> None:
        self.parts: dict[str, list] = {k: [] for k, _ in META}
        self.x, self.filled = np.empty((4096, size), kind), 0

    def add(self, rows: int, data: bytes) -> None:
        at = 0
        for k, t in META:
            self.parts[k].append(np.frombuffer(data, t, rows, at).copy())
            at += rows * np.dtype(t).itemsize
        if self.filled + rows > len(self.x):
            self.x.resize((2 * (self.filled + rows), self.x.shape[1]), refcheck=False)
        self.x[self.filled : self.filled + rows] = np.frombuffer(data, self.x.dtype, rows * self.x.shape[1], at).reshape(rows, -1)
        self.filled += rows

    def __len__(self) -> int:
        return self.filled

    def _take(self, order: np.ndarray) -> None:
        for at in range(0, self.x.shape[1], step := -(-self.x.shape[1] // 8)):  # no second copy of all
            self.x[: len(order), at : at + step] = self.x[order, at : at + step]
        self.filled = len(order)
        self.n = self.n[order]
        self.meta = {k: v[order] for k, v in self.meta.items()}

    def close(self) -> None:
        """Equal vectors become one."""
        self.meta = {k: np.concatenate(v) if v else np.zeros(0, t) for (k, t), v in zip(META, self.parts.values(), strict=True)}
        del self.parts
        self.n = self.meta.pop("n")
        order = np.lexsort((self.meta["id"], self.meta["h2"], self.meta["h1"]))
        first = _alike(order, self.meta["h1"], self.meta["h2"])
        if len(first) < len(order):
            n = np.add.reduceat(self.n[order], first)
            self._take(order[first])
            self.n = n
        self.inverse = np.empty(len(self))
        for at in range(0, len(self), 4096):
            own = slice(at, min(at + 4096, len(self)))
            self.x[own] = _scaled(self.x[own])
            self.inverse[own] = 1 / np.linalg.norm(self.x[own].astype(np.float64), axis=1)
        self.single = self.inverse.astype(np.float32)[:, None]
        self.links = np.zeros(len(self), np.int64)

    def unit(self, rows: np.ndarray | slice) -> np.ndarray:
        x = self.x[rows] if isinstance(rows, slice) else self.x.take(rows, 0)
        return (x * self.single[rows]).astype(np.float32, copy=False)

    def exact(self, rows: np.ndarray) -> np.ndarray:
        return self.x.take(rows, 0).astype(np.float64) * self.inverse[rows][:, None]

    def settle(self, pivots: np.ndarray, reach: float) -> None:
        """Home cells, cells visited (bits, by cell), and where each cell's own rows begin."""
        home = np.zeros(len(self), np.int32)
        self.bits = np.empty(((len(pivots) + 7) // 8, len(self)), np.uint8)
        for at in range(0, len(self), 4096):
            own = slice(at, min(at + 4096, len(self)))
            home[own], near = _cells(self.unit(own), pivots, reach)
            self.bits[:, own] = np.packbits(near, axis=1).T
        order = np.argsort(home, kind="stable")
        self._take(order)
        self.inverse, self.single, self.bits, self.fine = self.inverse[order], self.single[order], self.bits.take(order, 1), home[order]
        self.starts = np.searchsorted(self.fine, np.arange(len(pivots) + 1))

    def visits(self, rows: np.ndarray, cells: np.ndarray | int) -> np.ndarray:
        return (self.bits[cells >> 3, rows] >> (7 - (cells & 7))) & 1 > 0

    def near(self, cell: int) -> np.ndarray:
        return np.flatnonzero(self.bits[cell >> 3] & (128 >> (cell & 7)))


class _Forest:
    """Union-find over the homes of a group and the guests at hand."""

    def __init__(self, homes: int) -> None:
        self.up, self.homes = np.arange(homes), homes

    def guests(self, count: int) -> None:
        self.up = np.concatenate([self.up[: self.homes], np.arange(self.homes, self.homes + count)])

    def find(self, at: np.ndarray) -> np.ndarray:
        root = self.up[at]
        while not np.array_equal(new := self.up[root], root):
            root = new
        self.up[at] = root
        return root

    def join(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Places of those of the links ``a``, ``b`` that join what was apart."""
        left, used = np.arange(len(a)), []
        while True:
            ra, rb = self.find(a[left]), self.find(b[left])
            apart = ra != rb
            if not apart.any():
                return np.concatenate([*used, left[:0]])
            left, ra, rb = left[apart], ra[apart], rb[apart]
            low = np.maximum(ra, rb)  # guests hang on homes
            low, pick = np.unique(low, return_index=True)
            self.up[low] = np.minimum(ra, rb)[pick]
            used.append(left[pick])


class _Group:
    """One group of homes and their guests: counts every link of a home once."""

    def __init__(self, key: tuple[int, int, int, int], homes: _Rows, threshold: float, leaf: int) -> None:
        self.size, self.label, self.cell, _ = key
        self.threshold = threshold
        self.slack = (self.size + 8) * 2.0**-23  # single precision of products of unit vectors, with room
        self.homes = homes
        homes.close()
        count = min(FINE, len(self.homes) // leaf)
        self.pivots = directions(self.size, count if count >= 8 else 1, 1)
        self.reach = margin(threshold, self.size) + self.slack
        self.homes.settle(self.pivots, self.reach)
        self.forest, self.edges = _Forest(len(self.homes)), [np.empty((0, 4), np.int64)]
        self.told = np.empty(0, "V16")
        self.out: list[pa.RecordBatch] = []
        self._own()

    def _hits(self, a: _Rows, ra: np.ndarray, b: _Rows, rb: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        high, wide = TILE
        tops = [(own := ra[i : i + high], a.unit(own)) for i in range(0, len(ra), high)]
        for j in range(0, len(rb), wide):
            v = b.unit(cols := rb[j : j + wide]).T
            for rows, u in tops:
                g = u @ v
                hit = g >= np.float32(self.threshold - self.slack)
                own = np.flatnonzero(hit.any(1))
                if not len(own):
                    continue
                r, c = np.nonzero(hit[own])
                r = own[r]
                close = np.flatnonzero(g[r, c] < np.float32(self.threshold + self.slack))
                drop = [p[np.einsum("ij,ij->i", a.exact(rows[r[p]]), b.exact(cols[c[p]])) < self.threshold] for p in np.array_split(close, len(close) // 4096 + 1)]
                if len(close) and len(drop := np.concatenate(drop)):
                    r, c = np.delete(r, drop), np.delete(c, drop)
                yield rows[r], cols[c]

    def _count(self, x: np.ndarray, b: _Rows, y: np.ndarray) -> None:
        if not len(x):
            return
        a, base = self.homes, 0 if b is self.homes else len(self.homes)
        np.add.at(a.links, x, b.n[y])
        np.add.at(b.links, y, a.n[x])
        if len(new := self.forest.join(x, y + base)):
            self.edges.append(np.stack([a.meta["h1"][x[new]], a.meta["h2"][x[new]], b.meta["h1"][y[new]], b.meta["h2"][y[new]]], axis=1))

    def _own(self) -> None:
        a = self.homes
        for cell, (lo, hi) in enumerate(zip(a.starts[:-1].tolist(), a.starts[1:].tolist(), strict=True)):
            here = np.arange(lo, hi)
            for at in range(lo, hi, TILE[0]):
                for x, y in self._hits(a, np.arange(at, min(at + TILE[0], hi)), a, np.arange(at, hi)):
                    self._count(x[x < y], a, y[x < y])
            if lo == hi:
                continue
            near = a.near(cell)
            for x, y in self._hits(a, here, a, near[(near < lo) | (near >= hi)]):
                twice = (a.fine[y] < cell) & a.visits(x, a.fine[y])
                self._count(x[~twice], a, y[~twice])

    def host(self, b: _Rows) -> None:
        a = self.homes
        b.close()
        b.settle(self.pivots, self.reach)
        self.forest.guests(len(b))
        home, cells = b.meta["home"].astype(np.int64), a.meta["cells"]

        def count(x: np.ndarray, y: np.ndarray) -> None:  # in the lower of two cells if either could
            there = home[y]
            elsewhere = (there < self.cell) & (cells[x] >> there.astype(np.uint64) & np.uint64(1) > 0)
            self._count(x[~elsewhere], b, y[~elsewhere])

        for cell, (lo, hi) in enumerate(zip(a.starts[:-1].tolist(), a.starts[1:].tolist(), strict=True)):
            if lo < hi:
                for x, y in self._hits(a, np.arange(lo, hi), b, b.near(cell)):
                    count(x, y)
            if b.starts[cell] < b.starts[cell + 1]:
                near = a.near(cell)
                for y, x in self._hits(b, np.arange(b.starts[cell], b.starts[cell + 1]), a, near[(near < lo) | (near >= hi)]):
                    twice = b.visits(y, a.fine[x])
                    count(x[~twice], y[~twice])
        hit = np.flatnonzero(b.links)
        # A class that comes in parts has the same links each time.
        keys = np.stack([b.meta["h1"][hit], b.meta["h2"][hit]], axis=1).view("V16")[:, 0]
        new = ~np.isin(keys, self.told)
        hit, self.told = hit[new], np.concatenate([self.told, keys[new]])
        self._tell(b, hit, np.zeros(len(hit), np.int64))

    def _tell(self, rows: _Rows, hit: np.ndarray, n: np.ndarray) -> None:
        self._put(*(rows.meta[k][hit] for k in ("h1", "h2", "id")), n, rows.links[hit], None, None)

    def _put(self, *columns: np.ndarray | None) -> None:
        rows = len(columns[0])
        data = [pa.nulls(rows, pa.int64()) if c is None else pa.array(c, pa.int64()) for c in (np.full(rows, self.label), *columns)]
        self.out.append(pa.RecordBatch.from_arrays(data, [c.split()[0] for c in FOUND.split(", ")]))

    def found(self) -> Iterator[pa.RecordBatch]:
        hit = np.flatnonzero((self.homes.links > 0) | (self.homes.n > 1))
        self._tell(self.homes, hit, self.homes.n[hit])
        h1, h2, other1, other2 = (c.copy() for c in np.concatenate(self.edges).T)
        self._put(h1, h2, None, None, None, other1, other2)
        for batch in self.out:
            for at in range(0, batch.num_rows, 10_000):
                yield batch.slice(at, 10_000)


def _comparer(threshold: float, kind: type, leaf: int):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            keys = zip(*(batch.column(c).to_pylist() for c in range(6)), strict=True)
            for row, (*key, guest, rows) in enumerate(keys):
                yield tuple(key), guest, rows, batch.column(6)[row].as_py()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, own in groupby(read(batches), itemgetter(0)):
            group, rows = None, _Rows(key[0], kind)
            for _, guest, count, data in own:  # homes come first
                if guest and group is None:
                    if not len(rows):
                        break
                    group, rows = _Group(key, rows, threshold, leaf), _Rows(key[0], kind)
                rows.add(count, data)
                if guest and rows.filled * rows.x.itemsize * key[0] >= BLOCK_BYTES // 3:
                    group.host(rows)
                    rows = _Rows(key[0], kind)
            if group is not None and len(rows):
                group.host(rows)
            elif group is None and len(rows):
                group = _Group(key, rows, threshold, leaf)
            if group is not None:
                yield from group.found()

    return run


def _plan(sample: pa.Table, share: float, threshold: float, trees: int, kind: type) -> tuple[dict[tuple[int, int], tuple], list[tuple[int, int, int, int]]]:
    """``(size, label)`` of labels that are more than one group: directions, and how many blocks each cell has.  And the groups, largest first."""
    plans: dict[tuple[int, int], tuple] = {}
    groups: list[tuple] = []
    label, h1, h2 = (sample[c].to_numpy() for c in ("label", "h1", "h2"))
    size = sample["size"].to_numpy()
    order = np.lexsort((h2, h1, label, size))
    order = order[_alike(order, size, label, h1, h2)]
    starts = [*_alike(order, size, label).tolist(), len(order)]
    for lo, hi in zip(starts[:-1], starts[1:], strict=True):
        rows = order[lo:hi]
        d = int(size[rows[0]])
        held = max(1, min(BLOCK, BLOCK_BYTES // (d * np.dtype(kind).itemsize)))
        blocks = int(np.ceil(len(rows) / share / held))
        own_label = int(label[rows[0]])
        if blocks <= BLOCKS:
            groups += [(-len(rows) / blocks, d, own_label, 0, b) for b in range(blocks)]
            if blocks > 1:
                plans[d, own_label] = (np.zeros((1, d), np.float32), np.array([blocks]))
            continue
        x = _unit(sample["vector"].take(pa.array(rows)).combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(rows), d)).astype(np.float32)
        reach = margin(threshold, d)
        best = None
        for seed in range(max(1, trees)):  # the directions whose cells cost the fewest copies
            pivots = directions(d, min(CELLS, blocks), 100 + seed)
            home, near = _cells(x, pivots, reach)
            own = np.ceil(np.bincount(home, minlength=len(pivots)) / share / held).astype(int).clip(1)
            copies = (near * own).sum()
            if best is None or copies < best[0]:
                best = copies, (pivots, own)
        plans[d, own_label] = best[1]
        groups += [(-len(rows) / blocks, d, own_label, cell, b) for cell, count in enumerate(best[1][1].tolist()) for b in range(count)]
    return plans, [tuple(g[1:]) for g in sorted(groups)]


def _spots(spark: SparkSession, groups: list[tuple[int, int, int, int]]) -> dict[tuple[int, int, int, int], int]:
    """Values by which Spark's hash deals the largest groups to partitions of their own."""
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    tried = spark.range(16 * parts).select(F.col("id").cast("int").alias("spot")).select("spot", F.pmod(F.hash("spot"), F.lit(parts)).alias("part"))
    spots = [r["spot"] for r in tried.groupBy("part").agg(F.min("spot").alias("spot")).orderBy("spot").collect()]
    return dict(zip(groups, spots, strict=False))


def _router(shared, threshold: float, kind: type):
    """Blobs of homes and guests for each group; equal vectors that come together travel as one."""

    def deal(table: pa.Table) -> Iterator[tuple]:
        plans, spots = shared.value
        label, h1, h2, ids = (table[c].to_numpy() for c in ("label", "h1", "h2", "vec_id"))
        vectors = table["vector"].combine_chunks()
        size = np.diff(vectors.offsets.to_numpy())
        order = np.lexsort((ids, h2, h1, label, size))
        first = _alike(order, size, label, h1, h2)
        n = np.diff(np.append(first, len(order)))
        order = order[first]
        starts = [*_alike(order, size, label).tolist(), len(order)]
        flat, at = vectors.values.to_numpy(zero_copy_only=False), vectors.offsets.to_numpy()[:-1]
        for lo, hi in zip(starts[:-1], starts[1:], strict=True):
            rows = order[lo:hi]
            d, own_label = int(size[rows[0]]), int(label[rows[0]])
            x = flat[at[rows][:, None] + np.arange(d)].astype(kind, copy=False)
            home, near, blocks = np.zeros(len(rows), np.int64), np.ones((len(rows), 1), bool), np.ones(1, int)
            if (plan := plans.get((d, own_label))) is not None:
                pivots, blocks = plan
                if len(pivots) > 1:
                    home, near = _cells(_unit(x).astype(np.float32), pivots, np.float32(margin(threshold, d)))
            block = (h1[rows].view(np.uint64) % blocks[home].astype(np.uint64)).astype(np.int64)
            bits = (near.astype(np.uint64) << np.arange(near.shape[1], dtype=np.uint64)).sum(1, dtype=np.uint64)
            meta = {"id": ids[rows], "h1": h1[rows], "h2": h2[rows], "n": n[lo:hi], "cells": bits, "home": home.astype(np.int16)}
            for cell, count in enumerate(blocks.tolist()):
                here = home == cell
                for b in range(count):
                    for guest, chosen in ((False, here & (block == b)), (True, np.where(here, _hosts(block, b, count), near[:, cell]))):
                        for held, data in _pack(meta, x, np.flatnonzero(chosen)):
                            yield spots.get((d, own_label, cell, b), own_label & 0x7FFFFFFF), d, own_label, cell, b, guest, held, data

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            held: list[pa.RecordBatch] = []
            for batch in batches:
                held.append(batch)
                if sum(b.nbytes for b in held) >= BLOCK_BYTES // 8:
                    yield from deal(pa.Table.from_batches(held))
                    held = []
            if held:
                yield from deal(pa.Table.from_batches(held))

        kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.bool_(), pa.int32(), pa.binary()]
        names = [c.split()[0] for c in ROUTED.split(", ")]
        todo = rows()
        while part := list(islice(todo, BATCH)):
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*part, strict=True), kinds, strict=True)], names)

    return route


def near_vectors(vectors: DataFrame, threshold: float = 0.93, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
                 trees: int = TREES, max_fit: int = MAX_FIT) -> DataFrame:
    """``vec_id, n_links, component_id, kept``: one row per row of ``vectors``.

    Vectors of one label with a cosine of ``threshold`` or more (double precision) are
    linked; ``component_id`` is the least id reachable.  Vectors that are null, empty, zero,
    or hold null or non-finite components, and rows with a null label or id, link with
    nothing.  Vectors of different lengths never link.  Repeated rows are vectors of their
    own.  Other columns are ignored.
    """
    spark = vectors.sparkSession
    v = F.col("vector")
    single = vectors.schema[vector_col].dataType.simpleString() == "array<float>"
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<float>" if single else "array<double>").alias("vector"), F.col(label_col).cast("long").alias("label"))
    fine = (F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.coalesce(F.size(v) > 0, F.lit(False))
            & F.coalesce(F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False))
            & F.coalesce(F.exists(v, lambda x: x != 0), F.lit(False)))
    rows = rows.withColumn("fine", fine).withColumn("h1", F.xxhash64("vector")).withColumn("h2", F.xxhash64(F.lit(1), F.col("vector")))
    found = _found(rows, threshold, trees, max_fit, np.float32 if single else np.float64)
    # A class: equal vectors of a label; its representative is the least id.
    key = ["label", "h1", "h2"]
    classes = found.where("rep IS NOT NULL").groupBy(*key).agg(F.min("rep").alias("rep"), F.sum("n").alias("n"), F.sum("links").alias("links"))
    classes = materialise(classes, "classes")
    repeated = classes.where("n > 1").select(*key, "rep", "n", F.lit(True).alias("fine"))
    ends = found.where("rep IS NULL").select("label", "h1", "h2", "other1", "other2")
    for end, names in (("a", ("h1", "h2")), ("b", ("other1", "other2"))):
        ends = ends.join(classes.select("label", *(F.col(k).alias(n) for k, n in zip(("h1", "h2"), names, strict=True)), F.col("rep").alias(end)), ["label", *names])
    component = connected_components(ends.select("a", "b"))
    of_rep = (classes.where("links > 0").groupBy("rep").agg(F.sum("links").alias("links"))
              .join(component.select(F.col("id").alias("rep"), "component"), "rep", "full"))
    out = rows.select("vec_id", *key, "fine").join(repeated, [*key, "fine"], "left")
    out = out.withColumn("rep", F.when(F.col("fine"), F.coalesce("rep", "vec_id"))).join(of_rep, "rep", "left")
    component_id = F.coalesce("component", "rep", "vec_id")
    return out.select("vec_id", (F.coalesce("links", F.lit(0)) + F.coalesce("n", F.lit(1)) - 1).cast("long").alias("n_links"), component_id.alias("component_id"),
                      F.coalesce(component_id == F.col("vec_id"), F.lit(True)).alias("kept"))


def _found(rows: DataFrame, threshold: float, trees: int, max_fit: int, kind: type) -> DataFrame:
    """Classes with links or several rows (of a class in parts: parts of its links), and links that span the components."""
    spark: SparkSession = rows.sparkSession
    ship_code(spark)  # before the functions below are made
    total, longest = rows.agg(F.count("*"), F.max(F.size("vector"))).first()
    fit = max(64, min(max_fit, (64 << 20) // (8 * max(1, longest or 1))))
    share = min(1.0, fit / max(1, total))
    sample = rows.where(F.rand(7) < share).where("fine").select("label", "h1", "h2", F.size("vector").alias("size"), "vector").toArrow()
    plans, groups = _plan(sample, share, threshold, trees, kind)
    shared = spark.sparkContext.broadcast((plans, _spots(spark, groups)))
    group = ["size", "label", "cell", "block"]
    with small_batches(spark, BATCH):
        routed = rows.where("fine").select("label", "h1", "h2", "vec_id", "vector").mapInArrow(_router(shared, threshold, kind), ROUTED)
        met = routed.repartition("spot").drop("spot").sortWithinPartitions(*group, "guest").mapInArrow(_comparer(threshold, kind, LEAF), FOUND)
        return materialise(met, "found")
