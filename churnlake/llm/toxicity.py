"""Toxicity by maximum-scoring segments over token log-odds.

1. Tokens (letter and digit runs, lower-cased) of labelled documents and their first 4 and
   6 bytes are counted per class, each kind in 2**18 hashed slots: a model of fixed size.
   A slot's weight is its log-odds ratio between the classes with an informative Dirichlet
   prior (Monroe et al., 2008), moved towards zero by 1.96 standard deviations, so unsure
   slots weigh nothing; nor do slots with less than 1.0 left, which tell languages and
   topics apart rather than toxic words.  A token takes the largest of its three weights by size, so rare
   forms of a known stem count too.
2. A token scores its weight minus a drift, so that clean text scores below zero on
   average.  A linear scan (Ruzzo and Tompa, 1999) finds all maximal scoring segments.
3. Segment scores are calibrated by extreme-value theory (Karlin and Altschul, 1990):
   lambda solves E[exp(lambda * score)] = 1 over the tokens of clean documents, K is the
   median fit on their best segments, and a document of n tokens has the E-value K * n * exp(-lambda * S).
4. A logistic curve over the best segment's -log E-value and the sum over significant
   segments turns into the score; it is fitted on labelled documents the weights did not see.

The fit reads at most ``MAX_TRAIN`` labelled documents (a documented bound, picked by
hash); everything else covers all rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlake.llm._common import materialise, release, written
from churnlake.llm._text import IS_MARK, blocks, text_buffers, word_hashes, word_spans

SLOT_BITS = 18
MAX_TRAIN = 20_000
PRIOR = 500.0
STEMS = (4, 6)
LEAST_WEIGHT = 1.0
GRID = 0.02  # weights are rounded to it, so their distribution is a small table
REACH = 300  # weights lie within REACH steps of zero
SEGMENTS = "array<struct<start:long,length:long,score:double,evalue:double>>"


@dataclass(frozen=True)
class ToxicityModel:
    """Slot weights (3 kinds of 2**18), drift, lambda, log K and the logistic curve."""

    weights: np.ndarray
    drift: float
    lam: float
    log_k: float
    curve: tuple[float, ...]
    e_value: float = 0.05


def token_slots(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(i, j, slots, first): for rows i to j, three slots of every token (kinds x tokens) and each row's first token."""
    data, offsets = text_buffers(pc.utf8_lower(column))
    for i, j in blocks(offsets, 1 << 19):
        part = data[offsets[i] : offsets[j]]
        starts, ends, first = word_spans(part, offsets[i : j + 1] - offsets[i], IS_MARK)
        forms = [ends, *(np.minimum(ends, starts + n) for n in STEMS)]
        yield i, j, np.stack([(word_hashes(part, starts, e) >> np.uint64(64 - SLOT_BITS)).astype(np.int32) for e in forms]), first


def _token_weights(slots: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Of every token, the largest of its weights by size."""
    w = weights[0][slots[0]]
    for k in range(1, len(slots)):
        other = weights[k][slots[k]]
        w = np.where(np.abs(other) > np.abs(w), other, w)
    return w


def maximal_segments(at: np.ndarray, gain: np.ndarray, before: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (first token, last token, score) of one text.

    Arguments hold its positive tokens: places, scores, and the sums of all scores before.
    Each token is pushed and popped once at most, so the scan is linear.
    """
    stack: list[tuple[int, int, float, float]] = []  # first, last, sum before, sum up to the end
    for place, score, low in zip(at.tolist(), gain.tolist(), before.tolist(), strict=True):
        first, high = place, low + score
        while True:
            # The nearest earlier segment that begins lower; those between are closed for good.
            k = len(stack) - 1
            skipped = []
            while k >= 0 and stack[k][2] >= low:
                skipped.append(stack[k])
                k -= 1
            if k < 0 or stack[k][3] >= high:
                break
            first, low = stack[k][0], stack[k][2]
            del stack[k:]
        stack.append((first, place, low, high))
    return [(a, b, hi - lo) for a, b, lo, hi in stack]


def _documents(column: pa.Array, weights: np.ndarray, drift: float) -> Iterator[tuple[int, list[tuple[int, int, float]]]]:
    """(number of tokens, maximal segments) of each text."""
    for i, j, slots, first in token_slots(column):
        gain = _token_weights(slots, weights) - drift
        total = np.concatenate([[0.0], np.cumsum(gain)])
        hot = np.flatnonzero(gain > 0)
        cut = np.searchsorted(hot, first)
        for r in range(j - i):
            own = hot[cut[r] : cut[r + 1]]
            yield int(first[r + 1] - first[r]), maximal_segments(own - first[r], gain[own], total[own] - total[first[r]]) if len(own) else []


def _features(n: int, segments: list[tuple[int, int, float]], lam: float, log_k: float, e_value: float) -> tuple[float, float]:
    """-log E-value of the best segment and the log of one plus the sum over the significant ones."""
    if not segments:
        return 0.0, 0.0
    bits = lam * np.array([s for _, _, s in segments]) - log_k - np.log(max(n, 1))
    strong = bits[bits > -np.log(e_value)]
    return float(max(bits.max(), 0.0)), float(np.log1p(strong.sum()))


def train_rows(labels: DataFrame, id_col: str = "doc_id", label_col: str = "toxic", max_train: int = MAX_TRAIN) -> DataFrame:
    """``id, toxic, part``: at most ``max_train`` labelled ids that are not held out; part 0 fits the curve, 1 to 3 the weights."""
    known = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isin(0, 1) & ~held_out(F.col(id_col)))
    one = known.groupBy(F.col(id_col).cast("long").alias("id")).agg(F.max(label_col).cast("int").alias("toxic"))
    pick = F.xxhash64(F.lit("train"), "id")
    return one.orderBy(pick, "id").limit(max_train).withColumn("part", F.pmod(F.xxhash64(F.lit("part"), "id"), F.lit(4)).cast("int"))


def held_out(id_: F.Column) -> F.Column:
    return F.coalesce(F.crc32(id_.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def fit_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
                 max_train: int = MAX_TRAIN) -> ToxicityModel:
    """The model of ``docs`` whose ids are labelled 0 or 1 and not held out.

    Labels of one id that disagree count as toxic; null labels and ids are left out; rows of
    one id each count.  With no toxic or no clean document (an empty table, too) every score is the same.
    ``docs`` is read once: the texts of the sample are written, and all passes read those.
    Reaches the driver: three times 2**18 slot counts, and a label and two numbers of
    each row that fits the curve (a quarter of at most ``max_train`` ids), in two passes.
    """
    spark, before = docs.sparkSession, written(docs.sparkSession)
    train = train_rows(labels, id_col, label_col, max_train)
    rows = materialise(docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
                       .join(F.broadcast(train), "id").select("text", "toxic", "part"), "toxic-sample")
    try:
        return _fit(rows)
    finally:
        release(spark, [p for p in written(spark) if p not in before])


def _fit(rows: DataFrame) -> ToxicityModel:
    """The model of ``rows(text, toxic, part)``."""
    spark = rows.sparkSession
    kinds = 1 + len(STEMS)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, kinds << SLOT_BITS), np.int64)
        for batch in batches:
            toxic = batch.column(1).to_numpy()
            for i, j, slots, first in token_slots(batch.column(0)):
                of = np.repeat(toxic[i:j], np.diff(first)) == 1
                for k in range(kinds):
                    for c in (0, 1):
                        own = slots[k][of == c]
                        np.add.at(total[c], own + (k << SLOT_BITS), 1)
        used = np.flatnonzero(total.sum(0))
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[0, used]), pa.array(total[1, used])], ["slot", "clean", "toxic"])

    counted = (rows.where("part > 0").select("text", "toxic").mapInArrow(count, "slot long, clean long, toxic long")
               .groupBy("slot").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")).toArrow())
    y = np.zeros((2, kinds << SLOT_BITS))
    for c, name in enumerate(("clean", "toxic")):
        y[c, counted["slot"].to_numpy()] = counted[name].to_numpy()
    if not y[0].sum() or not y[1].sum():
        return ToxicityModel(np.zeros((kinds, 1 << SLOT_BITS), np.float32), 1.0, 1.0, 0.0, (-3.0, 0.0, 0.0))
    weights = np.stack([_slot_weights(t) for t in np.split(y, kinds, axis=1)])
    slot_weights = spark.sparkContext.broadcast(weights)

    # The weights' distribution over clean tokens that they were not counted from.
    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(2 * REACH + 1, np.int64)
        for batch in batches:
            for _, _, slots, _ in token_slots(batch.column(0)):
                total += np.bincount(np.rint(_token_weights(slots, slot_weights.value) / GRID).astype(int) + REACH, minlength=2 * REACH + 1)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(2 * REACH + 1)), pa.array(total)], ["step", "n"])

    clean = np.full(2 * REACH + 1, 1e-9)
    for r in rows.where("part = 0 AND toxic = 0").select("text").mapInArrow(spread, "step long, n long").groupBy("step").agg(F.sum("n").alias("n")).collect():
        clean[r["step"]] += r["n"]
    drift, lam = _drift_and_lambda(clean / clean.sum())

    # Of the same rows the best segment, whose median gives K, and then the features by that K for the curve.
    def measure(log_k: float | None):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                found = list(_documents(batch.column(0), slot_weights.value, drift))
                if log_k is None:
                    pairs = [(float(n), max((s for _, _, s in seg), default=0.0)) for n, seg in found]
                else:
                    pairs = [_features(n, seg, lam, log_k, 0.05) for n, seg in found]
                yield pa.RecordBatch.from_arrays([batch.column(1), *(pa.array([x[k] for x in pairs], pa.float64()) for k in (0, 1))], ["toxic", "a", "b"])

        return rows.where("part = 0").select("text", "toxic").mapInArrow(run, "toxic int, a double, b double").collect()

    best = [lam * r.b - np.log(r.a) for r in measure(None) if not r.toxic and r.b > 0]
    log_k = float(np.median(best) + np.log(np.log(2))) if best else 0.0
    seen = measure(log_k)
    x = np.array([(1.0, r.a, r.b) for r in seen]).reshape(-1, 3)
    return ToxicityModel(weights, drift, lam, log_k, _logistic(x, np.array([r.toxic for r in seen], float)))


def _slot_weights(y: np.ndarray) -> np.ndarray:
    """Weights, rounded to the grid, of one kind's slots from their clean and toxic counts."""
    share = (y[0] + y[1]) / y.sum()
    prior = PRIOR * share + 1e-3  # informative: proportional to the slot's share of all tokens
    a, b = y[1] + prior, y[0] + prior
    odds = np.log(a / (a.sum() - a)) - np.log(b / (b.sum() - b))
    sure = np.maximum(np.abs(odds) - 1.96 * np.sqrt(1 / a + 1 / b), 0)
    sure[sure < LEAST_WEIGHT] = 0
    return (np.rint(np.clip(np.sign(odds) * sure, -1.0, REACH * GRID) / GRID) * GRID).astype(np.float32)


def _drift_and_lambda(clean: np.ndarray) -> tuple[float, float]:
    """A drift that makes clean tokens score below zero on average, and the lambda of those scores."""
    steps = (np.arange(len(clean)) - REACH) * GRID
    drift = max(float(clean @ steps), 0.0) + 0.1
    scores = steps - drift
    low, high = 0.0, 1.0
    while clean @ np.exp(high * scores) < 1 and high < 64:
        low, high = high, high * 2
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (mid, high) if clean @ np.exp(mid * scores) < 1 else (low, mid)
    return drift, high


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.5) -> tuple[float, ...]:
    """Ridge logistic regression by Newton steps (two features)."""
    w = np.zeros(x.shape[1])
    keep = np.array([1e-6] + [ridge] * (x.shape[1] - 1))
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(keep), x.T @ (y - p) - keep * w)
        w = w + np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-9:
            break
    return tuple(float(v) for v in w)


def score_toxicity(docs: DataFrame, model: ToxicityModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, score, predicted, segments``: one row per row of ``docs``.

    ``segments`` lists the significant segments (first token, tokens, score, E-value).  A
    null or empty text has none and gets the curve's lowest value.  Whole texts are scanned.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            score, found = [], []
            for n, segments in _documents(batch.column(1), m.weights, m.drift):
                x = (1.0, *_features(n, segments, m.lam, m.log_k, m.e_value))
                score.append(1 / (1 + np.exp(-np.clip(np.dot(x, m.curve), -30, 30))))
                e = [max(n, 1) * np.exp(m.log_k - m.lam * s) for _, _, s in segments]
                found.append([{"start": a, "length": b - a + 1, "score": s, "evalue": float(v)}
                              for (a, b, s), v in zip(segments, e, strict=True) if v < m.e_value])
            kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("score", pa.float64()), ("evalue", pa.float64())]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(score, pa.float64()), pa.array([int(s >= 0.5) for s in score], pa.int32()), pa.array(found, kind)],
                ["doc_id", "score", "predicted", "segments"])

    return docs.select(F.col(id_col).cast("long"), F.col(text_col)).mapInArrow(run, f"doc_id long, score double, predicted int, segments {SEGMENTS}")


def drop_toxic(docs: DataFrame, model: ToxicityModel, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, that the model scores below 0.5 (null and empty texts like any other)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            keep = [np.dot((1.0, *_features(n, s, m.lam, m.log_k, m.e_value)), m.curve) < 0 for n, s in _documents(batch.column(at), m.weights, m.drift)]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
