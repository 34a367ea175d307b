"""Line dedup with DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnlake.llm._common import let, materialise

# The white space stripped from both ends of a line: \x20 and \x09 to \x0D.
SPACE = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def line_key(line: Column) -> Column:
    """The line without white space at both ends and with A-Z lower-cased."""
    return F.translate(F.btrim(line, F.lit(SPACE)), UPPER, LOWER)


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 40,
                min_docs: int = 5) -> DataFrame:
    """Every row of ``docs``, its ``text_col`` without the lines that many documents share, with ``n_lines, n_dropped``.

    A line whose key has ``min_chars`` code points or more and occurs in ``min_docs``
    documents or more is dropped everywhere but in the document of the largest id that
    holds it (all its lines of that key stay).  Documents are told apart by id: rows of
    one id count once.  A null or empty text is one empty line; rows without an id are
    returned as they are and count for nothing.  ``n_lines`` and ``n_dropped`` replace
    columns of the same names; all other columns are kept.

    Keys travel as 128 hash bits, counted with a map-side combine, so a line that a third
    of all documents hold is one row per task.  Exact distinct counts are taken only for
    keys with enough rows.  The joins are plain equi-joins, which AQE splits at a hot key.
    """
    id_, text = F.col(id_col), F.col(text_col)
    mark = F.xxhash64(text)
    key = F.col("key")
    # The text is hashed once, below the rows that it explodes to.
    lines = (docs.where(id_.isNotNull() & (F.octet_length(text) >= min_chars))
             .select(id_.alias("id"), mark.alias("mark"), text.alias("text"))
             .select("id", "mark", F.posexplode(_lines(F.col("text"))).alias("pos", "line"))
             .where(F.octet_length("line") >= min_chars)
             .select("id", "mark", "pos", line_key(F.col("line")).alias("key"))
             .where(F.length("key") >= min_chars)
             .select("id", "mark", "pos", F.xxhash64(key).alias("h1"), F.xxhash64(F.lit(1), key).alias("h2")))
    lines = materialise(lines, "lines")
    frequent = lines.groupBy("h1", "h2").agg(F.count("*").alias("n")).where(F.col("n") >= min_docs).drop("n")
    held = materialise(lines.join(frequent, ["h1", "h2"]), "held-lines")
    shared = (held.select("h1", "h2", "id").distinct().groupBy("h1", "h2")
              .agg(F.count("*").alias("n"), F.max("id").alias("keeper")).where(F.col("n") >= min_docs).drop("n"))
    drops = (held.join(shared, ["h1", "h2"]).where(F.col("id") != F.col("keeper"))
             .groupBy(F.col("id").alias("__id"), F.col("mark").alias("__mark")).agg(F.collect_set("pos").alias("__drop")))
    # The join key and the dropped positions sit beside a struct of the row, under names with two underscores.
    out = (docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("__row"), id_.alias("__id"), mark.alias("__mark"))
           .join(drops, ["__id", "__mark"], "left"))
    lines_now = _lines(F.col("__row")[text_col])
    # The text is split once for all its lines; ``array_except`` looks positions up in a hash set.
    kept_text = let(lines_now, lambda lines: F.array_join(F.transform(
        F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("__drop")), lambda i: F.get(lines, i)), "\n"))
    names = [c for c in docs.columns if c not in (text_col, "n_lines", "n_dropped")]
    return out.select(
        *[F.col("__row")[c].alias(c) for c in names],
        F.when(F.col("__drop").isNull(), F.col("__row")[text_col]).otherwise(kept_text).alias(text_col),
        F.size(lines_now).cast("long").alias("n_lines"),
        F.when(F.col("__drop").isNull(), 0).otherwise(F.size("__drop")).cast("long").alias("n_dropped"))


def line_digests(deduped: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    return deduped.select(F.col(id_col).alias("doc_id"), "n_lines", "n_dropped",
                          F.sha2(F.coalesce(F.col(text_col), F.lit("")), 256).alias("kept_sha256"))
