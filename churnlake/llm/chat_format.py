"""Chat formatting with Spark expressions only.

A conversation's rows are collected as structs and sorted; runs of one role merge into
one block; blocks are concatenated into one string of the template

    <|turn|>role<|text|>text<|next|>text<|end|>

``<|next|>`` keeps the border between the rows that a block merged, so the format is
reversible.  Inside roles and texts a backslash doubles and ``<|`` becomes ``<\\|``: no
control string can then occur in them, and reading back is a split and two replacements.
The loss mask is a list of character spans, one for each assistant text.

Every step takes time in proportion to a conversation's length (running sums: with the
logarithm of its turns besides): arrays and splits are bound before a lambda reads them,
spans come from running sums, and masked texts are cut from chunks of the output.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnlake.llm._common import let, running_sums

TURN, TEXT, NEXT, END = "<|turn|>", "<|text|>", "<|next|>", "<|end|>"
CHUNK = 4096  # code points that are searched for one masked text at most, besides its own


def escape(c: Column) -> Column:
    return F.replace(F.replace(c, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescape(c: Column) -> Column:
    return F.replace(F.replace(c, F.lit("<\\|"), F.lit("<|")), F.lit("\\\\"), F.lit("\\"))


def _split(c: Column, mark: str) -> Column:
    return F.split(c, mark.replace("|", "\\|"))


def format_chats(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                 text_col: str = "text", loss_role: str = "assistant") -> DataFrame:
    """``conv_id, formatted, loss_spans`` (array of start, length in characters): one row per conversation.

    Rows are ordered by turn, then role, then text; equal rows stay, each as a turn of
    its own.  A null role or text is empty; rows whose turn is null come first; a null
    conversation id is a conversation of its own.  Other columns are ignored.  No rows
    give no rows.
    """
    turns = rows.select(
        F.col(conv_col).alias("conv_id"),
        F.struct(F.col(turn_col).alias("turn"), escape(F.coalesce(F.col(role_col), F.lit(""))).alias("role"),
                 escape(F.coalesce(F.col(text_col), F.lit(""))).alias("text")).alias("t"))
    chats = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("t"))
    index = F.sequence(F.lit(0), F.size("t") - 1)

    def role(i: Column) -> Column:
        return F.get(F.col("t"), i)["role"]

    first = F.filter(index, lambda i: (i == 0) | (role(i) != role(i - 1)))
    chats = chats.select("conv_id", "t", first.alias("first"))
    # One block for each run of a role, made of slices of the sorted array.
    blocks = F.transform("first", lambda s, k: F.struct(
        role(s).alias("role"),
        F.transform(F.slice("t", s + 1, F.coalesce(F.get(F.col("first"), k + 1), F.size("t")) - s), lambda x: x["text"]).alias("texts")))
    pieces = F.transform("blocks", lambda b: F.concat(
        F.lit(TURN), b["role"], F.lit(TEXT), F.array_join(b["texts"], NEXT), F.lit(END)))
    chats = chats.select("conv_id", "t", blocks.alias("blocks")).select("conv_id", "t", F.array_join(pieces, "").alias("formatted"))

    # Characters from the end of the text before to the end of each text; their running sums are the ends.
    def grown(x: Column, i: Column) -> Column:
        head = len(TURN) + F.length(x["role"]) + len(TEXT)
        before = F.when(i == 0, head).when(role(i - 1) != x["role"], len(END) + head).otherwise(len(NEXT))
        return (before + F.length(x["text"])).cast("long")

    chats = chats.withColumn("grown", F.transform("t", grown)).withColumn("ends", running_sums(F.col("grown")))
    masked = let(F.col("ends"), lambda ends: F.transform(F.filter(index, lambda i: role(i) == loss_role), lambda i: let(
        F.length(F.get(F.col("t"), i)["text"]).cast("long"),
        lambda n: F.struct((F.get(ends, i) - n).alias("start"), n.alias("length")))))
    return chats.select("conv_id", "formatted", masked.alias("loss_spans"))


def read_chats(chats: DataFrame) -> DataFrame:
    """Read the output back: ``conv_id, turns`` (array of role, text) and ``loss_text`` (all text under the mask)."""
    parts = F.slice(_split(F.col("formatted"), TURN), 2, 1 << 30)

    def turns_of(part: Column) -> Column:
        return let(_split(part, TEXT), lambda head: let(unescape(F.get(head, F.lit(0))), lambda role: F.transform(
            _split(F.get(_split(F.get(head, F.lit(1)), END), F.lit(0)), NEXT),
            lambda x: F.struct(role.alias("role"), unescape(x).alias("text")))))

    def cut(chunks: Column, s: Column) -> Column:
        """A span from the few chunks that hold it."""
        first, last = F.floor(s["start"] / CHUNK), F.floor((s["start"] + F.greatest(s["length"], F.lit(1)) - 1) / CHUNK)
        held = F.array_join(F.slice(chunks, (first + 1).cast("int"), (last - first + 1).cast("int")), "")
        return F.substring(held, (s["start"] - first * CHUNK + 1).cast("int"), s["length"].cast("int"))

    chunks = F.regexp_extract_all("formatted", F.lit(f"(?s).{{1,{CHUNK}}}"), F.lit(0))
    masked = let(chunks, lambda c: F.transform("loss_spans", lambda s: unescape(cut(c, s))))
    return chats.select("conv_id", "formatted", F.flatten(F.transform(parts, turns_of)).alias("turns"),
                        F.array_join(masked, "").alias("loss_text"))


def chat_digests(chats: DataFrame) -> DataFrame:
    """The digest columns of formatted chats, all read back from ``formatted`` and ``loss_spans``."""
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read_chats(chats).select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"), F.sha2("loss_text", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"))
