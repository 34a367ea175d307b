"""Filter interaction audit: what each filter removes, alone and behind the others.

The duplicate filter is the only one that needs other documents.  A counting-Bloom
prepass clears texts that are certainly unique, so only possible repeats are shuffled:

1. One scan writes a narrow row per document: its part, the mask of the row-local
   filters and a 64-bit hash of the text.
2. The sketch is a blocked counting Bloom filter kept as a relation, one block of
   ``SLOTS`` counters a document on average, so it grows with the input and no task or
   driver holds it.  Tasks add up partial sketches and Spark merges them by block.  A
   text one of whose slots counts a single document is unique.
3. The hashes that are not cleared become one bitmap of bounded size (``MAX_BITS``),
   broadcast to a second scan; cleared texts go no further.  A full bitmap lets more
   texts through but changes no result.
4. What is left is grouped by whole text for its least document id.

Counts are additive: each document adds one to (part, mask); a duplicate moves from its
mask to the mask with the duplicate bit.  All 120 orders follow from the 32 counts of a part.
"""

from __future__ import annotations

from itertools import permutations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from churnlake.llm._common import materialise, ship_code

# Filters in the order of their bits; E is the duplicate filter.
FILTERS = "ABCDE"
DUPLICATE = 1 << FILTERS.index("E")
WORD = r"[^\x20\x09-\x0D]+"
SLOTS, PROBES, SLOT_BITS = 16, 3, 4
BITMAP_PAGE = 32768  # bits of one bitmap of Spark's bitmap functions
MAX_BITS = 1 << 29  # 64 MB: the most that is broadcast


def local_mask(text: Column) -> Column:
    """Bits of the filters A to D that a text fails."""
    words = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    n, distinct = F.size(words), F.size(F.array_distinct(words))
    fails = [n < 200, distinct * 100 < n * 50, F.regexp_count(text, F.lit("[A-Z]")) * 100 > F.length(text) * 3, text.rlike("[#$%&*|]")]
    return sum((F.when(f, 1 << i).otherwise(0) for i, f in enumerate(fails)), F.lit(0))


def _slots(h: Column) -> Column:
    """The bits of a hash's slots in its block."""
    at = [F.shiftright(h, SLOT_BITS * k).bitwiseAND(SLOTS - 1).cast("int") for k in range(PROBES)]
    bits = F.lit(0)
    for a in at:
        bits = bits.bitwiseOR(F.call_function("shiftleft", F.lit(1), a))
    return bits


def possible_repeats(hashes: DataFrame, n_docs: int) -> DataFrame:
    """Distinct ``h`` of ``hashes(h)`` that the counting sketch cannot clear."""
    rows = hashes.select("h", F.pmod(F.shiftright("h", SLOT_BITS * PROBES), F.lit(max(n_docs, 1))).alias("block"), _slots(F.col("h")).alias("bits"))
    counts = [F.sum(F.shiftright("bits", i).bitwiseAND(1).cast("long")).alias(f"c{i}") for i in range(SLOTS)]
    often = sum((F.when(F.col(f"c{i}") > 1, 1 << i).otherwise(0) for i in range(SLOTS)), F.lit(0))
    sketch = rows.groupBy("block").agg(*counts).select("block", often.alias("often")).where(F.bit_count("often") > 0)
    return rows.join(sketch, "block").where(F.col("bits").bitwiseAND(F.col("often")) == F.col("bits")).select("h").distinct()


def _membership(spark: SparkSession, hashes: DataFrame):
    """A test of 64-bit hashes against ``hashes(h)`` by a broadcast bitmap of at most MAX_BITS bits."""
    n_bits = BITMAP_PAGE
    wanted = 16 * hashes.count()
    while n_bits < min(wanted, MAX_BITS):
        n_bits *= 2
    at = F.pmod("h", F.lit(n_bits)) + 1  # Spark's bitmap functions count from 1
    pages = hashes.groupBy(F.bitmap_bucket_number(at).alias("page")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("bits"))
    bitmap = np.zeros(n_bits // 8, np.uint8)
    for page, bits in pages.toLocalIterator():
        start = (page - 1) * (BITMAP_PAGE // 8)
        bitmap[start : start + len(bits)] = np.frombuffer(bits, np.uint8)
    shared = spark.sparkContext.broadcast(bitmap)

    @F.pandas_udf("boolean")
    def known(h: pd.Series) -> pd.Series:
        i = np.mod(h.to_numpy(), n_bits)
        return pd.Series((shared.value[i >> 3] >> (i & 7).astype(np.uint8)) & 1 == 1)

    return known


def mask_counts(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """``part, mask, n, good, toxic``: documents of each part that fail exactly the filters of ``mask``.

    A null text is empty, a null part the empty string.  Every row is a document: repeated
    rows count each, and are duplicates only of smaller ids.  A row without an id is never a
    duplicate and makes none.  ``labels(doc_id, quality, toxic)`` may repeat ids: a
    document is good (toxic) if any of its rows says 1; without a label it is neither.
    """
    spark = docs.sparkSession
    ship_code(spark)
    docs = docs.select(docs[id_col].alias("id"), F.coalesce(docs[part_col], F.lit("")).alias("part"), F.coalesce(docs[text_col], F.lit("")).alias("text"))
    flags = materialise(docs.select("id", "part", local_mask(F.col("text")).alias("mask"), F.xxhash64("text").alias("h")), "audit-flags")
    repeats = materialise(possible_repeats(flags.select("h"), flags.count()), "audit-repeats")
    known = _membership(spark, repeats)
    maybe = docs.withColumn("h", F.xxhash64("text")).where(known("h"))
    firsts = maybe.groupBy("h", "text").agg(F.min("id").alias("first")).where(F.col("first").isNotNull())
    firsts = firsts.withColumn("mask", local_mask(F.col("text")))
    copies = maybe.join(firsts, ["h", "text"]).where(F.col("id") > F.col("first")).select("id", "part", "mask")
    moved = copies.select("id", "part", F.explode(F.array(
        F.struct(F.col("mask").alias("mask"), F.lit(-1).alias("n")), F.struct((F.col("mask") + DUPLICATE).alias("mask"), F.lit(1).alias("n")))).alias("m"))
    rows = flags.select("id", "part", "mask", F.lit(1).alias("n")).unionByName(moved.select("id", "part", "m.*"))
    marks = labels.where(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").alias("id")).agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    rows = rows.join(marks, "id", "left")

    def count(when: Column | None = None) -> Column:
        return F.sum(F.col("n") if when is None else F.when(when, F.col("n")).otherwise(0)).cast("long")

    return rows.groupBy("part", "mask").agg(count().alias("n"), count(F.col("good") == 1).alias("good"), count(F.col("toxic") == 1).alias("toxic"))


def audit(counts: DataFrame) -> DataFrame:
    """One row per part, order of the filters and step, from the 32 counts of a part (no parts: no rows)."""
    bit = {f: 1 << i for i, f in enumerate(FILTERS)}
    steps = [F.struct(F.lit("".join(o)).alias("filter_order"), F.lit(k + 1).alias("step"), F.lit(bit[o[k]]).alias("own"), F.lit(sum(bit[f] for f in o[:k])).alias("earlier"))
             for o in permutations(FILTERS) for k in range(len(FILTERS))]
    m = F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("m")
    rows = counts.groupBy("part").agg(m).select("part", "m", F.explode(F.array(*steps)).alias("s")).select("part", "m", "s.*")

    def total(what: str, when) -> Column:
        return F.aggregate("m", F.lit(0).cast("long"), lambda acc, x: acc + F.when(when(x["mask"]), x[what]).otherwise(F.lit(0).cast("long")))

    def fails(mask: Column) -> Column:
        return mask.bitwiseAND(F.col("own")) != 0

    def earlier(mask: Column) -> Column:
        return mask.bitwiseAND(F.col("earlier")) != 0

    def removed(mask: Column) -> Column:
        return fails(mask) & ~earlier(mask)

    # Of the orders, one in |mask| puts a given failing filter first: it then removes the document.
    orders = len(list(permutations(FILTERS)))
    share = F.aggregate("m", F.lit(0).cast("long"), lambda acc, x: acc + F.when(
        fails(x["mask"]), x["n"] * F.call_function("div", F.lit(orders), F.bit_count(x["mask"]))).otherwise(F.lit(0).cast("long")))
    return rows.select(
        "part", "filter_order", "step", total("n", lambda k: ~fails(k) & ~earlier(k)).alias("kept"), total("n", removed).alias("removed"),
        total("n", lambda k: fails(k) & earlier(k)).alias("redundant"), total("n", lambda k: k == F.col("own")).alias("unique_fails"),
        total("good", removed).alias("good_lost"), total("toxic", removed).alias("toxic_lost"), share.alias("shapley"))
