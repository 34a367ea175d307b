"""Cost of one very long row, the full set of maximal segments, and the pipeline stage by stage against plain Python."""

import collections
import re
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from churnlake.llm import chat_format, filter_audit, line_dedup, quality_rules, toxicity
from conftest import SF_SMALL

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def _ratio(run, small):
    """How much longer twice the work takes; the least of three runs each."""
    run(small)
    times = []
    for n in (small, 2 * small):
        best = 1e9
        for _ in range(3):
            t = time.perf_counter()
            run(n)
            best = min(best, time.perf_counter() - t)
        times.append(best)
    return times[1] / times[0]


def test_line_dedup_is_linear_in_a_document(spark):
    def run(n):
        line = F.transform(F.sequence(F.lit(1), F.lit(n)), lambda i: F.concat(
            F.when(i % 2 == 0, "a common line that everyone of us has in its text ").otherwise(F.concat(F.lit("a line of one's own "), F.col("id").cast("string"))), i.cast("string")))
        docs = spark.range(5).select(F.col("id").alias("doc_id"), F.array_join(line, "\n").alias("text"))
        rows = line_dedup.line_digests(line_dedup.dedup_lines(docs)).collect()
        assert sorted(r.n_dropped for r in rows) == [0] + [n // 2] * 4

    assert _ratio(run, 16_000) < 3


@pytest.mark.parametrize("role", ["'assistant'", "if(turn % 2 = 0, 'user', 'assistant')"])
def test_chat_format_is_linear_in_a_conversation(spark, role):
    def run(n):
        rows = spark.range(n).selectExpr("1L conv_id", "id turn").withColumn("role", F.expr(role)).withColumn("text", F.concat(F.lit("é <| word "), F.col("turn").cast("string")))
        r = chat_format.chat_digests(chat_format.format_chats(rows)).first()
        assert r.n_turns == n

    assert _ratio(run, 16_000) < 3


def test_quality_counts_are_linear_in_a_text(spark):
    def run(n):
        text = F.array_join(F.transform(F.sequence(F.lit(1), F.lit(n)), lambda i: F.concat(F.lit("w"), (i.cast("long") * i % 997).cast("string"))), " ")
        assert quality_rules.text_counts(spark.range(1).select(F.lit(1).alias("doc_id"), text.alias("text"))).first().n_words == n

    assert _ratio(run, 100_000) < 3.5


def test_long_chats_keep_masked_texts(spark):
    """Texts longer than a chunk, beyond the basic plane, and empty ones."""
    texts = ["\U0001F600" * 9000, "", "a" * 4096, "b" * 4095, "\\<|" * 3000, ""]
    rows = [(1, i, "assistant" if i % 2 or i < 3 else "user", t) for i, t in enumerate(texts)]
    r = chat_format.read_chats(chat_format.format_chats(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))).first()
    assert [t.text for t in r.turns] == texts and r.loss_text == "".join(t for _, _, role, t in rows if role == "assistant")


def test_maximal_segments_are_all_found():
    rng = np.random.default_rng(6)

    def best(gain, lo, hi):
        total = np.concatenate([[0], np.cumsum(gain[lo:hi])])
        top, at = 0, None
        for i in range(hi - lo):
            for j in range(i + 1, hi - lo + 1):
                if total[j] - total[i] > top:
                    top, at = total[j] - total[i], (lo + i, lo + j)
        return [] if at is None else best(gain, lo, at[0]) + [(at[0], at[1] - 1)] + best(gain, at[1], hi)

    for n in (0, 1, 5, 25, 40):
        for _ in range(15):
            gain = rng.normal(-0.2, 1, n)
            total = np.concatenate([[0], np.cumsum(gain)])
            hot = np.flatnonzero(gain > 0)
            found = toxicity.maximal_segments(hot, gain[hot], total[hot])
            assert sorted((int(a), int(b)) for a, b, _ in found) == sorted(best(gain, 0, n))


@pytest.mark.parametrize("rows", [[], [(1, None, "x"), (1, None, "x"), (None, "", "y"), (2, "a b", "z")]])
def test_toxicity_edges(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string").withColumn("toxic", F.lit("clash")).withColumn("part", F.lit(0))
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, 0), (None, 1), (2, None)], "doc_id long, toxic int")
    model = toxicity.fit_toxicity(docs, labels)
    assert toxicity.score_toxicity(docs, model).where("score BETWEEN 0 AND 1").count() == len(rows)
    kept = toxicity.drop_toxic(docs, model)
    assert kept.columns == docs.columns and kept.count() <= len(rows)


def test_audit_labels_of_repeated_documents(spark):
    docs = spark.createDataFrame([(1, "en", "a"), (1, "en", "a"), (2, "en", "a")], "doc_id long, lang string, text string")
    labels = spark.createDataFrame([(1, 0, 0), (1, 1, 0), (2, None, 1)], "doc_id long, quality int, toxic int")
    got = {r["mask"]: (r["n"], r["good"], r["toxic"]) for r in filter_audit.mask_counts(docs, labels).collect() if r["n"]}
    assert got == {1: (2, 2, 0), 17: (1, 0, 1)}


# --- the pipeline, stage by stage -------------------------------------------------
def _lines(rows):
    """Plain line dedup of (doc_id, text)."""
    def key(line):
        return re.sub(r"[A-Z]", lambda m: m[0].lower(), line.strip("\x20\x09\x0a\x0b\x0c\x0d"))

    holders = collections.defaultdict(set)
    for i, t in rows:
        for line in (t or "").split("\n"):
            if len(key(line)) >= 40:
                holders[key(line)].add(i)
    keeper = {k: max(v) for k, v in holders.items() if len(v) >= 5}
    return {i: "\n".join(x for x in (t or "").split("\n") if keeper.get(key(x), i) == i) for i, t in rows}


def _first_of_near_copies(rows):
    sets = {i: {tuple(w[k : k + 5]) for k in range(max(len(w) - 4, 1 if w else 0))} for i, t in rows for w in [WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))]}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    by = collections.defaultdict(list)
    for i, s in sets.items():
        for g in s:
            by[g].append(i)
    for a, b in {(a, b) for ids in by.values() if len(ids) < 80 for a in ids for b in ids if a < b}:
        if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return {i for i in sets if find(i) == i}


def test_pipeline_stages_match_plain_python(spark):
    import corpus_pipeline
    from churnlake.llm import queries

    stages = dict(corpus_pipeline.STAGES)
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    labels, items = (spark.read.parquet(f"{SF_SMALL}/{t}.parquet") for t in ("labels", "benchmark"))

    def step(name, docs):
        out = stages[name](spark, docs, SF_SMALL)
        rows = out.collect()
        return spark.createDataFrame(rows, out.schema), rows

    every = {r.doc_id: r for r in docs.collect()}
    clean, rows = step("toxicity", docs)
    scores = {r.doc_id: r.score for r in toxicity.score_toxicity(docs, toxicity.fit_toxicity(docs, labels)).collect()}
    assert clean.columns == docs.columns
    assert {r.doc_id: r for r in rows} == {i: r for i, r in every.items() if scores[i] < 0.5}
    marked = {r.doc_id: r.toxic for r in labels.collect()}
    assert sum(marked.get(i) == 1 for i in every if scores[i] >= 0.5) >= sum(marked.get(i) == 0 for i in every if scores[i] >= 0.5)

    short, after = step("line_dedup", clean)
    want = _lines([(r.doc_id, r.text) for r in rows])
    assert {r.doc_id: r.text for r in after} == want and all(r.n_chars == len(r.text) for r in after)

    single, kept = step("near_dedup", short)
    assert {r.doc_id for r in kept} == _first_of_near_copies([(r.doc_id, r.text) for r in after])
    assert {r.doc_id: r for r in kept} == {r.doc_id: r for r in after if r.doc_id in {k.doc_id for k in kept}}

    pure, left = step("decontamination", single)
    wanted = [" ".join(re.findall(r"\w+", r.text.lower())) for r in items.collect() if r.text]
    grams = {tuple(w[k : k + 5]) for t in wanted for w in [t.split()] for k in range(len(w) - 4)}
    stay = {r.doc_id for r in left}
    for r in kept:
        words = re.findall(r"\w+", (r.text or "").lower())
        body = f" {' '.join(words)} "
        if any(f" {t} " in body for t in wanted):
            assert r.doc_id not in stay  # a whole item
        if not any(tuple(words[k : k + 5]) in grams for k in range(len(words) - 4)):
            assert r.doc_id in stay  # nothing of any item
    assert pure.columns == docs.columns

    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_str(queries.tokenizer_json())
    packed, pieces = step("packing", pure)
    tokens = collections.Counter()
    for r in pieces:
        tokens[r.doc_id] += r.length
    assert tokens == {r.doc_id: len(tokenizer.encode(r.text or "", add_special_tokens=False).ids) + 1 for r in left}


@pytest.mark.parametrize("name", ["line_dedup", "near_dedup", "decontamination", "toxicity", "packing"])
def test_pipeline_stages_take_empty_tables(spark, name):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").limit(0)
    assert dict(corpus_pipeline.STAGES)[name](spark, docs, SF_SMALL).count() == 0
