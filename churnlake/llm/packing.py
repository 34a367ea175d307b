"""Best-fit packing of tokenised documents into sequences of a fixed length.

Documents become pieces of 1 to ``seq_len`` tokens.  Which pieces share a sequence
depends on lengths alone, so the plan is made from the histogram of lengths, at most
``seq_len`` rows however large the corpus, by linear grouping:

1. lengths over ``seq_len / 16`` are sorted and cut into groups of equal cardinality,
   and each is rounded up to its group's largest length;
2. with few sizes, whole configurations are optimised: the largest size left and the
   fullest complement of it (a bounded subset sum), used as often as the counts allow;
3. the documents' own lengths are substituted for the rounded ones, which leaves gaps;
4. the small lengths go best-fit, longest first, into the gaps, then into new sequences.

The plan is a table of intervals (length, first rank, count, first sequence, offset).
Pieces get a rank among those of their length (two-level: a salted row number plus the
salt's offset, so no length is a single task) and look up their place.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from churnlake.llm._common import materialise, small_batches
from churnlake.llm._tokens import word_tokenizer

SEQ_LEN = 2048
GROUPS = 1024
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def token_pieces(docs: DataFrame, tokenizer_json: str, seq_len: int = SEQ_LEN, end_id: int = 0, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32``: every document's ids (its text's, then ``end_id``) in pieces.

    Only documents over ``seq_len`` ids are cut; the first of their pieces may be shorter.
    A null or empty text is the end id alone.  Rows with equal ids or texts each give
    pieces; a null id stays null.
    """
    spark = docs.sparkSession
    vocabulary = spark.sparkContext.broadcast(tokenizer_json)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pa.default_memory_pool().release_unused()  # what earlier stages left in this worker
        tokenizer = word_tokenizer(vocabulary.value)
        for batch in batches:
            ids = batch.column(0)
            for i, j, tokens, ends in tokenizer.encode(batch.column(1), end_id):
                begins = np.concatenate([[0], ends[:-1]])
                rows, piece, start, length, crc = [], [], [], [], []
                raw = memoryview(tokens.astype("<u4").tobytes())
                for row, (a, b) in enumerate(zip(begins.tolist(), ends.tolist(), strict=True)):
                    at, k = a, 0
                    while at < b:
                        size = min((b - at - 1) % seq_len + 1, b - at) if at == a else seq_len
                        rows.append(row)
                        piece.append(k)
                        start.append(at - a)
                        length.append(size)
                        crc.append(zlib.crc32(raw[4 * at : 4 * (at + size)]))
                        at, k = at + size, k + 1
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(i, j - i).take(pa.array(rows, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                     pa.array(length, pa.int64()), pa.array(crc, pa.int64())], ["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select(F.col(id_col).cast("long"), F.col(text_col)).mapInArrow(cut, PIECES)


def _fullest(sizes: list[int], left: list[int], room: int) -> list[tuple[int, int]]:
    """(index, uses) of the sizes that fill ``room`` best, no size more often than it is left."""
    reach, steps = 1, []  # bit x of reach: the sum x can be made
    full = (1 << (room + 1)) - 1
    for k, size in enumerate(sizes):
        n = min(left[k], room // size)
        take = 1
        while n > 0:
            take = min(take, n)
            new = (reach | reach << (size * take)) & full
            if new != reach:
                steps.append((k, take, reach))
                reach = new
                if reach >> room & 1:
                    n = take
            n -= take
            take *= 2
        if reach >> room & 1:
            break
    at, uses = reach.bit_length() - 1, {}
    for k, take, before in reversed(steps):
        if not before >> at & 1:
            at -= sizes[k] * take
            uses[k] = uses.get(k, 0) + take
    return sorted(uses.items())


def plan_sequences(counts: dict[int, int], seq_len: int = SEQ_LEN, groups: int = GROUPS) -> tuple[list[tuple[int, int, int, int, int]], int]:
    """Intervals (length, first rank, count, first sequence, offset) and the number of sequences.

    The r-th piece of a length, first rank <= r < first rank + count, goes to sequence
    ``first sequence + r - first rank`` at ``offset``.
    """
    intervals: list[tuple[int, int, int, int, int]] = []
    used = {length: 0 for length in counts}
    n_seq = 0

    def place(length: int, n: int, seq: int, offset: int) -> None:
        intervals.append((length, used[length], n, seq, offset))
        used[length] += n

    small_limit = seq_len // 16
    large = sorted((x for x in counts if small_limit < x < seq_len and counts[x] > 0), reverse=True)
    if counts.get(seq_len):
        place(seq_len, counts[seq_len], 0, 0)
        n_seq = counts[seq_len]

    # 1. Groups of equal cardinality; runs of (length, count) from the longest to the shortest.
    total = sum(counts[x] for x in large)
    per_group = max(1, -(-total // groups))
    runs: list[list[list[int]]] = []
    room = 0
    for x in large:
        n = counts[x]
        while n:
            if room == 0:
                runs.append([])
                room = per_group
            t = min(n, room)
            runs[-1].append([x, t])
            n, room = n - t, room - t
    by_size: dict[int, list[list[int]]] = {}
    for group in runs:  # groups of one rounded size are one size
        by_size.setdefault(group[0][0], []).extend(group)
    sizes = sorted(by_size, reverse=True)
    members = [by_size[s] for s in sizes]
    left = [sum(n for _, n in m) for m in members]

    # Gaps of equal room: room -> [first sequence, sequences, offset of the gap].
    gaps: dict[int, list[list[int]]] = {}
    rooms: list[int] = []

    def add_gap(space: int, seq: int, n: int, offset: int) -> None:
        if space > 0 and n > 0:
            if not gaps.get(space):
                bisect.insort(rooms, space)
                gaps[space] = []
            gaps[space].append([seq, n, offset])

    # 2. Configurations of the rounded sizes, 3. with the documents' own lengths.
    for k, size in enumerate(sizes):
        while left[k]:
            left[k] -= 1
            use = dict(_fullest(sizes[k:], left[k:], seq_len - size))
            left[k] += 1
            use = {k + j: n for j, n in use.items()}
            use[k] = use.get(k, 0) + 1
            times = min(left[j] // n for j, n in use.items())
            columns = [j for j, n in sorted(use.items()) for _ in range(n)]
            for j, n in use.items():
                left[j] -= n * times
            # Each column takes the next ``times`` pieces of its size; sequences of equal lengths form a segment.
            taken: list[list[tuple[int, int]]] = []
            for j in columns:
                need, got = times, []
                while need:
                    run = members[j][0]
                    t = min(need, run[1])
                    got.append((run[0], t))
                    run[1] -= t
                    need -= t
                    if not run[1]:
                        members[j].pop(0)
                taken.append(got)
            at = [0] * len(taken)
            remain = [c[0][1] for c in taken]
            done = 0
            while done < times:
                n = min(remain)
                offset = 0
                for c, col in enumerate(taken):
                    place(col[at[c]][0], n, n_seq + done, offset)
                    offset += col[at[c]][0]
                    remain[c] -= n
                    if remain[c] == 0 and at[c] + 1 < len(col):
                        at[c] += 1
                        remain[c] = col[at[c]][1]
                add_gap(seq_len - offset, n_seq + done, n, offset)
                done += n
            n_seq += times

    # 4. Best fit for the small lengths: the tightest gap that holds them, else a new sequence.
    for x in sorted((x for x in counts if 0 < x <= small_limit), reverse=True):
        n = counts[x]
        while n:
            i = bisect.bisect_left(rooms, x)
            if i == len(rooms):
                fresh = -(-n // (seq_len // x))
                add_gap(seq_len, n_seq, fresh, 0)
                n_seq += fresh
                continue
            space = rooms[i]
            seq, have, offset = gap = gaps[space][-1]
            t = min(n, have)
            place(x, t, seq, offset)
            gap[0], gap[1] = seq + t, have - t
            if not gap[1]:
                gaps[space].pop()
                if not gaps[space]:
                    rooms.pop(i)
            add_gap(space - x, seq, t, offset + x)
            n -= t
    return intervals, n_seq


def pack_pieces(pieces: DataFrame, seq_len: int = SEQ_LEN, groups: int = GROUPS) -> DataFrame:
    """``pieces`` (as from ``token_pieces``; written, since it is read twice) with ``sequence_id`` and ``offset``.

    The driver holds the length histogram and the plan made of it: at most ``seq_len``
    counts and a few intervals for each configuration, whatever the number of rows.
    """
    spark = pieces.sparkSession
    salts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    salted = pieces.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(salts)).cast("int"))
    by_salt = salted.groupBy("length", "salt").agg(F.count("*").alias("n"))
    counts = {r[0]: r[1] for r in by_salt.groupBy("length").agg(F.sum("n")).collect()}
    intervals, _ = plan_sequences(counts, seq_len, groups)
    table = np.array(sorted(intervals), np.int64).reshape(-1, 5)
    plan = spark.sparkContext.broadcast(table)
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    first = by_salt.withColumn("first", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    own = Window.partitionBy("length", "salt").orderBy("doc_id", "piece")
    ranked = (salted.withColumn("own", F.row_number().over(own) - 1).join(first, ["length", "salt"])
              .withColumn("rank", F.col("own") + F.col("first"))
              .select("doc_id", "piece", "start", "length", "ids_crc32", "rank"))

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = plan.value
        step = np.int64(1 << 48)
        keys = t[:, 0] * step + t[:, 1]
        for batch in batches:
            length, rank = (batch.column(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in (3, 5))
            at = np.searchsorted(keys, length * step + rank, "right") - 1
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:5], pa.array(t[at, 3] + rank - t[at, 1]), pa.array(t[at, 4])],
                [*batch.schema.names[:5], "sequence_id", "offset"])

    return ranked.mapInArrow(look_up, PIECES + ", sequence_id long, offset long")


def pack_documents(docs: DataFrame, tokenizer_json: str, seq_len: int = SEQ_LEN, groups: int = GROUPS, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """Pieces of all documents with their sequence and offset; see ``token_pieces`` and ``pack_pieces``.

    An empty table gives no rows.  Columns other than the id and the text are ignored.
    """
    with small_batches(docs.sparkSession):
        pieces = materialise(token_pieces(docs, tokenizer_json, seq_len, 0, id_col, text_col), "pieces")
    return pack_pieces(pieces, seq_len, groups)
