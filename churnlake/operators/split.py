"""Train/test split and CV folds (M1, M2, M7 folds) from per-row hashes.

A row's part depends only on its id and a salt: no sort, no shuffle, no
global state, identical on reruns and task retries.  ``split_column`` cuts at a
fixed hash, so each class is split 80/20 in expectation (``split_counts`` reports
the realised shares).  Training and evaluation use ``exact_split_column`` and
``exact_fold_column``, whose cuts are found per class, so shares are exact to one row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnlake.functions import unit_hash

SPLIT_SALT = "split42"
FOLD_SALT = "fold42"


def split_column(id_col: str = "customerID", test_size: float = 0.2, salt: str = SPLIT_SALT) -> Column:
    return F.when(unit_hash(id_col, salt) < F.lit(1.0 - test_size), "train").otherwise("test")


def with_split(df: DataFrame, id_col: str = "customerID", test_size: float = 0.2, salt: str = SPLIT_SALT) -> DataFrame:
    return df.withColumn("split", split_column(id_col, test_size, salt))


def train_test(df: DataFrame, id_col: str = "customerID", test_size: float = 0.2,
               salt: str = SPLIT_SALT) -> tuple[DataFrame, DataFrame]:
    """M1: disjoint, complete parts (``split_column``'s; a null id is a test row)."""
    part = split_column(id_col, test_size, salt)
    return df.filter(part == "train"), df.filter(part == "test")


def evaluation_sample(df: DataFrame, id_col: str = "customerID") -> DataFrame:
    """M2: the evaluation rows are M1's test part (not an overlapping sample), as training cuts it."""
    return df.filter(exact_split_column(df, id_col=id_col) == "test")


def fold_column(id_col: str = "customerID", k: int = 5, salt: str = FOLD_SALT) -> Column:
    return F.coalesce(F.floor(unit_hash(id_col, salt) * k).cast("int"), F.lit(0))


def with_folds(df: DataFrame, id_col: str = "customerID", k: int = 5, salt: str = FOLD_SALT) -> DataFrame:
    return df.withColumn("fold", fold_column(id_col, k, salt))


def split_counts(df: DataFrame, label: str = "churn_label", id_col: str = "customerID") -> DataFrame:
    """Rows per (split, label) with the share of the label inside its split part."""
    from pyspark.sql import Window as W

    counts = with_split(df, id_col).groupBy("split", label).agg(F.count(F.lit(1)).alias("rows"))
    # The grouped table has at most 2 x classes rows: the window is tiny.
    return counts.withColumn("share", F.col("rows") / F.sum("rows").over(W.partitionBy("split")))


# --- exact stratified cuts ------------------------------------------------------
HASH_BUCKETS = 1 << 16


def _order_keys(id_col: str, salt: str) -> tuple[Column, Column]:
    """What rows of a class are ordered by: their hash, then their id (a null id comes first)."""
    return F.coalesce(unit_hash(id_col, salt), F.lit(0.0)), F.coalesce(F.col(id_col).cast("string"), F.lit(""))


def stratum_cuts(df: DataFrame, parts: int, label: str, id_col: str, salt: str) -> list:
    """Rows ``(label, u, id)``: for each class the last row, in hash order, of its parts 1 to ``parts - 1``.

    Part j of a class of n rows ends at row ceil(j n / parts), so parts differ by one row
    at most.  No global sort: a histogram of the hashes (at most HASH_BUCKETS rows a class,
    combined map-side) names the bucket that holds each cut, and only the rows of those
    buckets, some n / HASH_BUCKETS each, are ranked.  What is collected is one row per
    class and cut.
    """
    from pyspark.sql import Window as W

    u, i = _order_keys(id_col, salt)
    rows = df.select(F.col(label).alias("label"), u.alias("u"), i.alias("id"), F.floor(u * HASH_BUCKETS).alias("bucket"))
    counts = rows.groupBy("label", "bucket").agg(F.count(F.lit(1)).alias("n"))
    by_class = W.partitionBy("label")
    sums = counts.withColumns({"total": F.sum("n").over(by_class), "upto": F.sum("n").over(by_class.orderBy("bucket"))})
    rank = F.ceil(F.col("j") * F.col("total") / parts)
    cuts = (sums.withColumn("j", F.explode(F.sequence(F.lit(1), F.lit(parts - 1)))).withColumn("rank", rank)
            .where((F.col("rank") <= F.col("upto")) & (F.col("rank") > F.col("upto") - F.col("n")))
            .select(F.col("label").alias("l"), F.col("bucket").alias("b"), (F.col("rank") - F.col("upto") + F.col("n")).alias("inside")))
    at = F.col("label").eqNullSafe(F.col("l")) & (F.col("bucket") == F.col("b"))
    ranked = rows.join(cuts.select("l", "b").distinct(), at, "left_semi").withColumn(
        "inside_", F.row_number().over(W.partitionBy("label", "bucket").orderBy("u", "id")))
    return ranked.join(cuts, at & (F.col("inside_") == F.col("inside"))).select("label", "u", "id").collect()


def part_column(cuts: list, label: str, id_col: str, salt: str) -> Column:
    """Number of a row's part (from 0) by the cuts of its class: row-local, so any scan of the same rows agrees.

    Rows of one id and class stay together.
    """
    u, i = _order_keys(id_col, salt)
    part = F.lit(0)
    for c in cuts:
        beyond = (u > F.lit(c["u"])) | ((u == F.lit(c["u"])) & (i > F.lit(c["id"])))
        part = part + F.when(F.col(label).eqNullSafe(F.lit(c["label"])) & beyond, 1).otherwise(0)
    return part


def exact_parts(df: DataFrame, parts: int, label: str, id_col: str, salt: str) -> Column:
    return part_column(stratum_cuts(df, parts, label, id_col, salt), label, id_col, salt)


def exact_split_column(df: DataFrame, label: str = "churn_label", id_col: str = "customerID", test_parts: int = 5) -> Column:
    """M1 with exact class shares: ceil(n / test_parts) rows of every class are the test part."""
    return F.when(exact_parts(df, test_parts, label, id_col, SPLIT_SALT) == 0, "test").otherwise("train")


def exact_fold_column(train: DataFrame, k: int = 5, label: str = "churn_label", id_col: str = "customerID") -> Column:
    """M7's folds with exact class shares: of each class, folds differ by one row at most."""
    return exact_parts(train, k, label, id_col, FOLD_SALT)
