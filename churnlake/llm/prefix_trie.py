"""Prefix trie of conversations with subtree totals by a depth-band rollup.

Texts are hashed in the first scan; everything after that is narrow rows.

* **Turn numbers.** Rows are range-partitioned by (conversation, turn), so a conversation
  that holds a third of all rows is spread over tasks; a row's number is its place in its
  partition plus the rows of earlier partitions.
* **Nodes.** A prefix is the XOR of a 128-bit hash of (depth, role, text) for each of its
  turns, a running aggregate over segments of ``SEGMENT`` turns.  Rows with equal prefix
  are one node (partial aggregates, so the root and common first turns are no hot groups).
* **Subtree totals.** Depths are cut into bands of ``BAND`` levels.  A node adds its counts
  to its ancestors inside its band only: at most ``BAND`` rows.  Band roots then form a
  trie of their own, ``BAND`` times flatter, which is summed the same way; a band root's
  completed total is added to its ancestors in the band above.  So the rounds grow with
  the logarithm of the depth and the explosion by ``BAND`` at most.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from churnlake.llm._common import materialise, ship_code

BAND, SEGMENT = 32, 4096
KEY = ["depth", "k1", "k2"]
# Ids whose decimals are joined by one task before hashing.
PIECE_IDS = 4096


def number_turns(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """``conv, pos, t1, t2, chars``: every row with its number (from 1) in its conversation and the hash and length of its text.

    Ordered by turn (null first), role and text; a null role or text is empty.  Equal rows
    stay, each a turn of its own.  Rows without a conversation id are left out, as no
    node could name them.
    """
    role, text = F.coalesce(rows[role_col], F.lit("")), F.coalesce(rows[text_col], F.lit(""))
    order = ["conv", "turn", "role", "text"]
    turns = rows.where(rows[conv_col].isNotNull()).select(rows[conv_col].cast("long").alias("conv"), rows[turn_col].alias("turn"), role.alias("role"), text.alias("text"))
    placed = turns.repartitionByRange(*order).sortWithinPartitions(*order).select(
        "conv", F.monotonically_increasing_id().alias("place"), F.xxhash64("role", "text").alias("t1"),
        F.xxhash64(F.lit(1), "text", "role").alias("t2"), F.length("text").cast("long").alias("chars"))
    # The upper bits of the place are the partition; a conversation's rows are consecutive in it.
    placed = materialise(placed.withColumn("part", F.shiftright("place", 33)), "trie-turns")
    parts = placed.groupBy("conv", "part").agg(F.count("*").alias("n"), F.min("place").alias("first"))
    before = F.sum("n").over(Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    parts = parts.withColumn("before", F.coalesce(before, F.lit(0)))
    return placed.join(parts, ["conv", "part"]).select("conv", (F.col("place") - F.col("first") + F.col("before") + 1).alias("pos"), "t1", "t2", "chars")


def rebuild(rows: DataFrame, block: int = 100, heads: int = 6) -> tuple[DataFrame, DataFrame]:
    """Conversations whose first turns are those of the first conversation of their block.

    Conversation c begins with the first h turns of conversation c - c % block (all if
    it has fewer, none if it is absent), h = crc32(decimal c) % heads, and goes on with its
    own turns after its first h.  Returns ``(turns, convs)`` as ``prefix_nodes`` takes them.
    """
    ship_code(rows.sparkSession)
    turns = materialise(number_turns(rows), "trie-numbered")
    convs = turns.groupBy("conv").agg(F.count("*").alias("own")).select(
        "conv", "own", (F.col("conv") - F.col("conv") % block).alias("base"), F.crc32(F.col("conv").cast("string").cast("binary")).alias("crc"))
    convs = convs.withColumn("h", F.col("crc") % heads).drop("crc")
    sizes = convs.select(F.col("conv").alias("base"), F.col("own").alias("base_own"))
    convs = convs.join(sizes, "base", "left").select(
        "conv", "base", "h", F.least("h", F.coalesce("base_own", F.lit(0))).alias("head"), "own")
    convs = materialise(convs.withColumn("n", F.col("head") + F.greatest(F.col("own") - F.col("h"), F.lit(0))), "trie-convs")
    first = turns.where(F.col("pos") < heads).withColumnRenamed("conv", "base")
    given = convs.where(F.col("head") > 0).select("conv", "base", "head").join(first, "base").where(F.col("pos") <= F.col("head"))
    own = convs.select("conv", "h", "head").join(turns, "conv").where(F.col("pos") > F.col("h"))
    columns = ["t1", "t2", "chars"]
    return (given.select("conv", F.col("pos").alias("depth"), *columns).unionByName(
        own.select("conv", (F.col("head") + F.col("pos") - F.col("h")).alias("depth"), *columns)), convs.select("conv", "n"))


def _prefixes(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """A row per conversation and depth (0: the root): its prefix ``k1, k2``, its parent's ``p1, p2``, the last turn's ``chars``, and whether it ``ends`` there."""
    z1, z2 = F.xxhash64("depth", "t1", "t2"), F.xxhash64(F.lit(2), "t2", "t1", "depth")
    rows = turns.select("conv", "depth", "chars", z1.alias("z1"), z2.alias("z2"), F.floor((F.col("depth") - 1) / SEGMENT).alias("segment"))
    inside = Window.partitionBy("conv", "segment").orderBy("depth").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumns({"i1": F.bit_xor("z1").over(inside), "i2": F.bit_xor("z2").over(inside)})
    earlier = Window.partitionBy("conv").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    # A map-side combine leaves one row per segment; only long conversations have more than one.
    totals = turns.select("conv", F.floor((F.col("depth") - 1) / SEGMENT).alias("segment"), z1.alias("z1"), z2.alias("z2")).groupBy("conv", "segment").agg(
        F.bit_xor("z1").alias("s1"), F.bit_xor("z2").alias("s2"))
    totals = totals.select("conv", "segment", F.coalesce(F.bit_xor("s1").over(earlier), F.lit(0)).alias("s1"), F.coalesce(F.bit_xor("s2").over(earlier), F.lit(0)).alias("s2"))
    rows = rows.join(totals, ["conv", "segment"]).join(convs, "conv")
    k1, k2 = F.col("i1").bitwiseXOR(F.col("s1")), F.col("i2").bitwiseXOR(F.col("s2"))
    below = rows.select("conv", "depth", k1.alias("k1"), k2.alias("k2"), k1.bitwiseXOR(F.col("z1")).alias("p1"), k2.bitwiseXOR(F.col("z2")).alias("p2"),
                        "chars", (F.col("depth") == F.col("n")).alias("ends"))
    zero = F.lit(0).cast("long")
    root = convs.select("conv", zero.alias("depth"), zero.alias("k1"), zero.alias("k2"), zero.alias("p1"), zero.alias("p2"), zero.alias("chars"), (F.col("n") == 0).alias("ends"))
    return below.unionByName(root)


def _subtree_totals(nodes: DataFrame, prefixes: DataFrame, values: list[str], max_depth: int, unit: int = 1) -> DataFrame:
    """``values`` of ``nodes(depth, k1, k2, rep, ...)`` summed over each node's subtree; depths are multiples of ``unit``."""
    level = F.floor(F.col("depth") / unit)
    band = F.floor(level / BAND)
    # A conversation's prefixes in one band, topmost first: at most BAND of them.
    paths = (prefixes.where(F.col("depth") % unit == 0).groupBy(F.col("conv").alias("rep"), band.alias("band"))
             .agg(F.sort_array(F.collect_list(F.struct(*KEY))).alias("path")))
    sums = [F.sum(v).alias(v) for v in values]
    up = (nodes.withColumn("band", band).join(paths, ["rep", "band"])
          .select(F.explode(F.slice("path", F.lit(1), (level % BAND + 1).cast("int"))).alias("a"), *values))
    inside = up.select("a.*", *values).groupBy(*KEY).agg(*sums)
    if max_depth < unit * BAND:
        return inside
    roots = materialise(inside.where(level % BAND == 0).join(nodes.select(*KEY, "rep"), KEY), "trie-bands")
    whole = _subtree_totals(roots, prefixes, values, max_depth, unit * BAND)
    whole = whole.where(F.col("depth") > 0).join(roots.select(*KEY, "rep"), KEY).withColumn("band", band - 1)
    across = whole.join(paths, ["rep", "band"]).select(F.explode("path").alias("a"), *values).select("a.*", *values)
    return inside.unionByName(across).groupBy(*KEY).agg(*sums)


def _stream_digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of the pieces of each node; a node's rows are consecutive and in order."""
    schema = pa.schema([("depth", pa.int64()), ("k1", pa.int64()), ("k2", pa.int64()), ("digest", pa.string())])
    now, h = None, None
    for batch in batches:
        done = []
        for *key, piece in zip(*(batch.column(c).to_pylist() for c in [*KEY, "piece"])):
            if key == now:
                h.update(b"," + piece.encode())
                continue
            if now:
                done.append((*now, h.hexdigest()))
            now, h = key, hashlib.sha256(piece.encode())
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*done), schema)], schema=schema)
    if now:
        yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip((*now, h.hexdigest()), schema)], schema=schema)


def _end_digests(prefixes: DataFrame) -> DataFrame:
    """``depth, k1, k2, digest``: SHA-256 of the comma-joined ids of the conversations that end at a node, ascending.

    Ids are joined in pieces of at most PIECE_IDS by range partitions; a node's pieces are then
    streamed through one hash, which is sequential by nature, and never held together.
    """
    ends = prefixes.where("ends").select(*KEY, "conv").repartitionByRange(*KEY, "conv").sortWithinPartitions(*KEY, "conv")
    placed = ends.select("*", F.floor(F.monotonically_increasing_id() / PIECE_IDS).alias("piece_no"))
    pieces = placed.groupBy(*KEY, "piece_no").agg(F.array_join(F.transform(F.sort_array(F.collect_list("conv")), lambda c: c.cast("string")), ",").alias("piece"))
    pieces = pieces.repartition(*[F.col(c) for c in KEY]).sortWithinPartitions(*KEY, "piece_no").select(*KEY, "piece")
    return pieces.mapInArrow(_stream_digests, "depth long, k1 long, k2 long, digest string")


def prefix_nodes(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """The trie of ``turns(conv, depth, t1, t2, chars)``, depths 1 to ``n`` of ``convs(conv, n)``.

    One row per distinct prefix, all columns long but the last: ``conv_id`` (smallest
    member), ``depth``, ``parent_conv_id`` (null for the root), ``n_convs``, ``n_children``,
    ``n_leaves``, ``saved_tokens`` (code points that the subtree's nodes share, each counted
    n_convs - 1 times) and ``ends_sha256`` of the members that end there.  Conversations
    without turns are members of the root; no conversations give no rows.  Prefixes
    are told apart by 128 hash bits.
    """
    ship_code(turns.sparkSession)
    prefixes = materialise(_prefixes(turns, convs), "trie-prefixes")
    max_depth = prefixes.agg(F.max("depth")).first()[0] or 0
    nodes = prefixes.groupBy(*KEY).agg(
        F.min("conv").alias("rep"), F.count("*").alias("n_convs"), F.min("p1").alias("p1"), F.min("p2").alias("p2"), F.min("chars").alias("chars"))
    parent = [F.col("depth") - 1, F.col("p1"), F.col("p2")]
    children = nodes.where(F.col("depth") > 0).groupBy(*[c.alias(k) for c, k in zip(parent, KEY)]).agg(F.count("*").alias("n_children"))
    nodes = nodes.join(children, KEY, "left").withColumns({
        "n_children": F.coalesce("n_children", F.lit(0)), "n_leaves": F.col("n_children").isNull().cast("long"),
        "saved_tokens": (F.col("n_convs") - 1) * F.col("chars")})
    nodes = materialise(nodes, "trie-nodes")
    totals = _subtree_totals(nodes.select(*KEY, "rep", "n_leaves", "saved_tokens"), prefixes, ["n_leaves", "saved_tokens"], max_depth)
    parents = nodes.select((F.col("depth") + 1).alias("depth"), F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("rep").alias("parent_conv_id"))
    out = nodes.drop("n_leaves", "saved_tokens").join(totals, KEY).join(_end_digests(prefixes), KEY, "left").join(parents, ["depth", "p1", "p2"], "left")
    return out.select(F.col("rep").alias("conv_id"), "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                      F.coalesce("digest", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"))
