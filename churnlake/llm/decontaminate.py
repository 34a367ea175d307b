"""Benchmark decontamination: a BM25 index of the test items, queried by every training passage.

The index holds the items' words with their BM25 weights, each as a share of the item's
own full score, so a passage's score for an item lies between 0 and 1.  Postings are
sorted by word and item and cut into blocks of items, with the largest weight of each word
in each block.  A passage is scored block-max WAND fashion, for many passages at once:

* a passage whose words' largest weights sum below the threshold is skipped;
* the block maxima of its words are summed, and blocks below the threshold are skipped;
* items of the remaining blocks are scored exactly; all at or above the threshold are kept.

Hits are verified on the texts: the question's five-word shingles and the answer's words
must lie in the passage to a share of 0.8.  An index part holds items of one class of
lengths, which sets the size of their passages.  One scan of the documents carries the
parts of ``GROUP_BYTES`` of item text (some ten thousand items), which bounds the broadcast.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlake.llm._common import materialise, ship_code
from churnlake.llm._text import IS_MARK, blocks, text_buffers, word_hashes, word_runs, word_spans

K1, B = 1.2, 0.75
SHINGLE = 5
BLOCK_ITEMS = 16
PART_ITEMS = 1024  # items of one index part
STEP = 1 << 20  # sums that are added up at once
GROUP_BYTES = 8 << 20  # of item text that one scan carries; the index has at most some 20 times as many
SHORT = 64  # items of up to 64, 128, 256, ... words are classes, with passages of twice as many
HITS = "doc_id long, item_id long, score double, question_overlap double, answer_overlap double"


def _words(text: str) -> tuple[np.ndarray, int]:
    data, offsets = text_buffers(pc.utf8_lower(pa.array([text])))
    starts, ends, _ = word_spans(data, offsets, IS_MARK)
    return word_hashes(data, starts, ends), len(starts)


def question_answer(text: str) -> tuple[str, str]:
    """The item's question and answer: the answer is the last line, or the last sentence of a single line.

    A text of one sentence is a question without an answer.
    """
    lines = [x for x in text.split("\n") if x.strip()]
    if len(lines) > 1:
        return "\n".join(lines[:-1]), lines[-1]
    parts = [x for x in re.split(r"(?<=[.!?])\s+", text.strip()) if x]
    return (" ".join(parts[:-1]), parts[-1]) if len(parts) > 1 else (text, "")


@dataclass(frozen=True)
class Index:
    """A part of the inverted index: words, their blocks, the blocks' postings, and what verifies a hit."""

    words: np.ndarray  # sorted word hashes
    top: np.ndarray  # largest weight of each word
    first: np.ndarray  # where each word's blocks begin in ``key``; one more at the end
    key: np.ndarray  # word number * n_blocks + block, sorted
    block_max: np.ndarray  # largest weight of the word in the block
    entry: np.ndarray  # where each block's postings begin in ``item``; one more at the end
    item: np.ndarray
    weight: np.ndarray
    n_blocks: int
    item_ids: np.ndarray
    questions: list[np.ndarray]  # distinct shingles
    answers: list[np.ndarray]  # distinct words
    longest: int  # words of an item, at most


def build_index(items: list[tuple[int, str, np.ndarray]], longest: int, n_items: int, mean_words: float, known: np.ndarray, frequency: np.ndarray) -> Index:
    """Index of one part (id, text, word hashes); document frequencies (of sorted ``known`` words) and the mean length are those of all items."""
    size = np.array([len(t) for _, _, t in items])
    word, rank = np.concatenate([t for _, _, t in items]), np.repeat(np.arange(len(items)), size)
    order = np.lexsort((rank, word))
    word, rank = word[order], rank[order]
    start = np.flatnonzero(np.append(True, (word[1:] != word[:-1]) | (rank[1:] != rank[:-1])))
    tf = np.diff(np.append(start, len(word)))
    word, rank = word[start], rank[start]
    words, begin, number = np.unique(word, return_index=True, return_inverse=True)
    df = frequency[np.searchsorted(known, words)].astype(float)
    idf = np.log1p((n_items - df + 0.5) / (df + 0.5))
    weight = idf[number] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * size[rank] / mean_words))
    weight /= np.bincount(rank, weight)[rank]
    n_blocks = -(-len(items) // BLOCK_ITEMS)
    key, entry = np.unique(number * np.int64(n_blocks) + rank // BLOCK_ITEMS, return_index=True)
    questions, answers = [], []
    for _, text, _ in items:
        question, answer = question_answer(text)
        q, n = _words(question)
        questions.append(np.unique(word_runs(q, np.array([0, n]), SHINGLE)[0]))
        answers.append(np.unique(_words(answer)[0]))
    return Index(words, np.maximum.reduceat(weight, begin), np.searchsorted(key // n_blocks, np.arange(len(words) + 1)), key,
                 np.maximum.reduceat(weight, entry), np.append(entry, len(weight)), rank.astype(np.int32), weight, n_blocks,
                 np.array([i for i, _, _ in items], np.int64), questions, answers, longest)


def build_group(items: list[tuple[int, str]], n_items: int, mean_words: float, known: np.ndarray, frequency: np.ndarray) -> list[Index]:
    """The index parts of the items that have words: by class of length, ``PART_ITEMS`` at most in each."""
    classes: dict[int, list] = {}
    for i, text in sorted(items):
        tokens = _words(text)[0]
        if len(tokens):
            classes.setdefault(SHORT << max(0, (-(-len(tokens) // SHORT) - 1).bit_length()), []).append((i, text, tokens))
    return [build_index(own[k : k + PART_ITEMS], longest, n_items, mean_words, known, frequency)
            for longest, own in sorted(classes.items()) for k in range(0, len(own), PART_ITEMS)]


def _passages(first: np.ndarray, size: int, step: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, first and end word of every passage: windows of ``size`` words every ``step``, until a row's end."""
    n = np.diff(first)
    count = np.where(n > 0, np.maximum(1, -(-(n - size) // step) + 1), 0)
    row = np.repeat(np.arange(len(n)), count)
    k = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    start = first[row] + k * step
    return row, start, np.minimum(start + size, first[row + 1])


def _search(index: Index, hashes: np.ndarray, first: np.ndarray, threshold: float, seen: np.ndarray) -> list[tuple[int, int, float, float, float]]:
    """(row, item position, score, question overlap, answer overlap) of all hits in a block of rows."""
    row, start, end = _passages(first, 2 * index.longest, index.longest)
    # Words of the index, by place in the block.
    place = np.flatnonzero(seen[hashes >> np.uint64(44)])
    word = np.searchsorted(index.words, hashes[place])
    word[word == len(index.words)] = 0
    hit = index.words[word] == hashes[place]
    place, word = place[hit], word[hit]
    at, passage = _spread(np.searchsorted(place, start), np.searchsorted(place, end))
    pair = np.unique(passage * np.int64(len(index.words)) + word[at])  # distinct words of each passage
    passage, word = pair // len(index.words), pair % len(index.words)
    bounds = np.searchsorted(passage, np.arange(len(start) + 1))
    least = threshold - 1e-9  # sums may be off by rounding
    # Level 1: sums of the words' largest weights; level 2: of their block maxima; level 3: of the items' own.
    full = np.flatnonzero(np.diff(bounds))
    full = full[np.add.reduceat(index.top[word], bounds[full]) >= least] if len(full) else full
    out = []
    width = np.concatenate([[0], np.cumsum(index.first[word + 1] - index.first[word])])
    for a, b in blocks(_offsets(width[bounds[full + 1]] - width[bounds[full]] + index.n_blocks), STEP):
        of, local = _spread(bounds[full[a:b]], bounds[full[a:b] + 1])
        at, back = _spread(index.first[word[of]], index.first[word[of] + 1])
        sums = np.bincount(local[back] * index.n_blocks + index.key[at] % index.n_blocks, index.block_max[at], (b - a) * index.n_blocks)
        near = np.flatnonzero(sums >= least)
        p, block = full[a + near // index.n_blocks], near % index.n_blocks
        for c, d in blocks(_offsets(bounds[p + 1] - bounds[p] + BLOCK_ITEMS), STEP):
            of, local = _spread(bounds[p[c:d]], bounds[p[c:d] + 1])
            key = word[of] * index.n_blocks + block[c:d][local]
            at = np.minimum(np.searchsorted(index.key, key), len(index.key) - 1)
            held = index.key[at] == key
            posting, back = _spread(index.entry[at[held]], index.entry[at[held] + 1])
            scores = np.bincount(local[held][back] * BLOCK_ITEMS + index.item[posting] % BLOCK_ITEMS, index.weight[posting], (d - c) * BLOCK_ITEMS)
            for k in np.flatnonzero(scores >= least).tolist():
                q, item = int(p[c + k // BLOCK_ITEMS]), int(block[c + k // BLOCK_ITEMS]) * BLOCK_ITEMS + k % BLOCK_ITEMS
                out.append((int(row[q]), item, float(scores[k]), *_overlaps(index, item, hashes[start[q] : end[q]])))
    return out


def _spread(lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of the ranges [lo, hi) one after another, and the range that each comes from."""
    n = hi - lo
    return np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(lo, n), np.repeat(np.arange(len(n)), n)


def _offsets(sizes: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)


def _overlaps(index: Index, item: int, text: np.ndarray) -> tuple[float, float]:
    """The shares of the question's shingles and of the answer's words that the passage holds."""
    runs = word_runs(text, np.array([0, len(text)]), SHINGLE)[0]
    question, answer = index.questions[item], index.answers[item]
    share = float(np.isin(question, runs).mean()) if len(question) else 1.0
    if len(question) == 1 and share < 1:  # perhaps a question of fewer words than a shingle
        share = float(_short_question(index, item, text))
    return share, float(np.isin(answer, text).mean()) if len(answer) else 1.0


def _short_question(index: Index, item: int, text: np.ndarray) -> bool:
    """Whether a question that is one shingle as a whole occurs in the passage."""
    for size in range(1, min(SHINGLE, len(text) + 1)):
        starts = np.arange(len(text) - size + 1)
        for s in starts.tolist():
            if word_runs(text[s : s + size], np.array([0, size]), SHINGLE)[0][0] == index.questions[item][0]:
                return True
    return False


def contaminated(docs: DataFrame, items: DataFrame, threshold: float = 0.6, overlap: float = 0.8, id_col: str = "doc_id",
                 text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """``doc_id, item_id, score, question_overlap, answer_overlap``: every (document, item) pair with a verified passage.

    All passages of all rows are queried.  Those of an item of n words have 128 words for
    n up to 64, 256 for n up to 128 and so on, and step by half of that, so any run of
    words as long as the item lies in one.  A pair reports its best passage.  Words are
    letter and digit runs, lower-cased.  Items or rows with a null or empty text match
    nothing; a null document id stays null; rows of one id report once; an item id that
    several texts bear is several items, reported once.  No items or no documents give no
    rows.  Other columns are ignored.
    """
    spark = docs.sparkSession
    ship_code(spark)
    test = items.select(F.col(item_col).cast("long").alias("item_id"), F.col(item_text_col).alias("text")).where(
        F.col("item_id").isNotNull() & (F.trim(F.coalesce("text", F.lit(""))) != "")).distinct()
    # Collection statistics, then groups of bounded size; the loop is over groups.
    n_items, n_bytes = test.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    if not n_items:
        return spark.createDataFrame([], HITS)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = [_words(t)[0] for t in batch.column(0).to_pylist()]
            each = [np.unique(w) for w in words]
            yield pa.RecordBatch.from_arrays([
                pa.array(np.concatenate([np.zeros(1, np.int64), *[e.view(np.int64) for e in each]])),
                pa.array(np.concatenate([[sum(map(len, words))], *[np.ones(len(e), np.int64) for e in each]]))], ["word", "n"])

    def frequencies(texts: DataFrame) -> DataFrame:
        return texts.select("text").mapInArrow(count, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))

    frequency = materialise(frequencies(test), "frequency")
    mean = max(1.0, (frequency.where("word = 0").first()["n"] or 1) / n_items)
    n_groups = max(1, -(-n_bytes // GROUP_BYTES))
    hits = None
    for group in range(n_groups):
        own = test.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n_groups)) == group)
        table = frequency.join(frequencies(own).select("word"), "word", "left_semi").toArrow()
        words, n = table["word"].to_numpy().view(np.uint64), table["n"].to_numpy()
        order = np.argsort(words)
        indexes = build_group([(r[0], r[1]) for r in own.collect()], n_items, mean, words[order], n[order])
        found = _query(docs, indexes, threshold, overlap, id_col, text_col)
        hits = found if hits is None else hits.unionByName(found)
    best = F.max(F.struct("score", "question_overlap", "answer_overlap"))
    return hits.groupBy("doc_id", "item_id").agg(best.alias("b")).select("doc_id", "item_id", "b.*")


def _query(docs: DataFrame, indexes: list[Index], threshold: float, overlap: float, id_col: str, text_col: str) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(indexes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = []
        for index in shared.value:
            seen = np.zeros(1 << 20, bool)  # by leading hash bits: most words are in no item
            seen[index.words >> np.uint64(44)] = True
            own.append((index, seen))
        for batch in batches:
            ids = batch.column(0)
            data, offsets = text_buffers(pc.utf8_lower(batch.column(1)))
            rows: list[tuple] = []
            for i, j in blocks(offsets, 1 << 19):
                part = data[offsets[i] : offsets[j]]
                starts, ends, first = word_spans(part, offsets[i : j + 1] - offsets[i], IS_MARK)
                hashes = word_hashes(part, starts, ends)
                for index, seen in own if len(starts) else []:
                    for r, item, score, question, answer in _search(index, hashes, first, threshold, seen):
                        if question >= overlap and answer >= overlap:
                            rows.append((ids[i + r].as_py(), int(index.item_ids[item]), score, question, answer))
            cols = list(zip(*rows, strict=True)) or [[]] * 5
            kinds = [pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)],
                                             ["doc_id", "item_id", "score", "question_overlap", "answer_overlap"])

    return docs.select(F.col(id_col).cast("long"), F.col(text_col)).mapInArrow(run, HITS)
