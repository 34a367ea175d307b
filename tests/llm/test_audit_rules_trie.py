"""Brute-force and edge-case tests of the filter audit, the quality rules and the prefix trie."""

import collections
import hashlib
import itertools
import math
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from churnlake.llm import filter_audit, prefix_trie, quality_rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")


# --- filter audit -----------------------------------------------------------------
@pytest.fixture(scope="module")
def audited():
    """(doc_id, lang, text): every combination of filters, copies within and across parts, null and empty texts, repeated rows."""
    rng = random.Random(3)
    clean = [" ".join("w%x" % rng.randrange(1 << 30) for _ in range(230)).lower() for _ in range(8)]
    out, i = [], 1000
    for base in clean[:4]:
        for repeat, capitals, symbol in itertools.product((False, True), repeat=3):
            text = base if not repeat else base + " " + " ".join(["same"] * 400)
            text = text.upper() if capitals else text
            out.append((i, rng.choice(["en", "fr", None, ""]), text + " #" * symbol))
            i -= 7
    for k in range(40):
        source = rng.choice(out)
        out.append((rng.choice([i - 5 - k, 2000 + k]), rng.choice(["en", "de"]), source[2]))
    return [*out, (3000, "en", None), (3001, "en", ""), (3001, "en", ""), (None, "en", clean[5]), (4, "en", clean[5]), (None, "en", clean[6]), (None, "en", clean[6])]


def _mask(text):
    w = WORD.findall(text)
    return ((len(w) < 200) | (100 * len(set(w)) < 50 * len(w)) << 1 | (100 * len(re.findall("[A-Z]", text)) > 3 * len(text)) << 2
            | bool(re.search("[#$%&*|]", text)) << 3)


def test_audit_matches_brute_force(spark, audited):
    labels = [(i, k % 2, k % 3 == 0) for k, (i, _, _) in enumerate(audited) if i and k % 2] + [(audited[1][0], 0, True), (None, 1, True)]
    docs = spark.createDataFrame(audited, "doc_id long, lang string, text string").withColumns({"mask": F.lit("x"), "h": F.lit(1), "n": F.lit(9)})
    marks = spark.createDataFrame([(i, q, int(t)) for i, q, t in labels], "doc_id long, quality int, toxic int")
    got = {(r["part"], r["filter_order"], r["step"]): tuple(r)[3:] for r in filter_audit.audit(filter_audit.mask_counts(docs, marks)).collect()}
    good, toxic = {i for i, q, _ in labels if q and i}, {i for i, _, t in labels if t and i}
    first = {}
    for i, _, t in audited:
        if i is not None:
            first[t or ""] = min(i, first.get(t or "", i))
    rows = [(p or "", i, _mask(t or "") | 16 * (i is not None and i > first[t or ""])) for i, p, t in audited]
    assert {m & 16 for _, _, m in rows} == {0, 16}
    want, shapley = {}, collections.Counter()
    for part in {p for p, _, _ in rows}:
        for order in itertools.permutations("ABCDE"):
            left = [r for r in rows if r[0] == part]
            for step, f in enumerate(order, 1):
                bit = 1 << "ABCDE".index(f)
                gone = [r for r in left if r[2] & bit]
                failing = [r for r in rows if r[0] == part and r[2] & bit]
                left = [r for r in left if not r[2] & bit]
                shapley[part, f] += len(gone)
                want[part, "".join(order), step] = (len(left), len(gone), len(failing) - len(gone), sum(r[2] == bit for r in failing),
                                                    sum(r[1] in good for r in gone), sum(r[1] in toxic for r in gone))
    want = {k: (*v, shapley[k[0], k[1][k[2] - 1]]) for k, v in want.items()}
    assert got == want


def test_sketch_keeps_every_repeat_and_clears_unique_texts(spark):
    hashes = spark.range(5000).select(F.xxhash64("id").alias("h"))
    twice = hashes.limit(40)
    left = {r["h"] for r in filter_audit.possible_repeats(hashes.unionByName(twice).unionByName(twice.limit(5)), 5045).collect()}
    assert {r["h"] for r in twice.collect()} <= left and len(left) < 400
    known = filter_audit._membership(spark, twice)
    passed = hashes.where(known("h")).collect()
    assert {r["h"] for r in twice.collect()} <= {r["h"] for r in passed} and len(passed) < 400
    assert filter_audit.possible_repeats(hashes.limit(0), 0).count() == 0


def test_audit_of_no_documents(spark):
    docs = spark.createDataFrame([], "doc_id long, lang string, text string")
    assert filter_audit.audit(filter_audit.mask_counts(docs, spark.createDataFrame([], "doc_id long, quality int, toxic int"))).count() == 0


# --- quality rules ----------------------------------------------------------------
def _base_counts(text):
    w = WORD.findall(text or "")
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    at = collections.defaultdict(list)
    for k in range(len(w) - 2):
        at[tuple(w[k : k + 3])].append(k)
    covered = {k + d for s in at.values() if len(s) > 1 for k in s for d in range(3)}
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered)


@pytest.fixture(scope="module")
def judged():
    rng = random.Random(11)
    words = ["".join(rng.choice("aeioubcdflmnprst") for _ in range(rng.randint(2, 8))) for _ in range(400)]
    out = []
    for i in range(160):
        lines = [" ".join(rng.choice(words) for _ in range(12)) + "." for _ in range(rng.randint(5, 12))]
        if i % 8 == 1:
            lines = [" ".join(x + "#$%"[k % 3] * 3 for k, x in enumerate(line.split())) for line in lines]
        if i % 8 == 2:
            lines = lines[:3] * 4
        out.append((i, "\n".join(lines)))
    return [*out, (900, None), (901, ""), (902, " \n\t\n"), (903, "a b"), (904, "é é é é"), (905, "x\n \n\nx\n\tx"), (None, out[0][1]), (5, out[5][1]), (5, out[5][1])]


def test_quality_counts_match_brute_force(spark, judged):
    docs = spark.createDataFrame(judged, "doc_id long, text string").withColumns({"w": F.lit(1), "lines": F.lit("x"), "n_words": F.lit(2)})
    out = quality_rules.judge_quality(docs)
    got = collections.Counter(tuple(r) for r in out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed").collect())
    want = collections.Counter()
    for i, t in judged:
        n = _base_counts(t)
        want[(i, *n, n[0] < 50 or 100 * n[4] > 50 * n[0])] += 1
    assert got == want
    kept = {r["doc_id"]: r["kept"] for r in out.select("doc_id", "kept").collect()}
    assert all(kept[i] == (i % 8 not in (1, 2)) for i in range(160))


def test_rule_model_matches_plain_em(spark):
    rng, names = random.Random(4), ["a", "b", "c", "d"]
    rows = []
    for _ in range(400):
        good = rng.random() < 0.7
        rows.append(tuple(0 if rng.random() < 0.2 else (1 if good == (rng.random() < p) else -1) for p in (0.95, 0.8, 0.7, 0.9)))
    got = quality_rules.fit_rules(spark.createDataFrame(rows, "a int, b int, c int, d int"), names)
    prior, g, b = quality_rules.START_PRIOR, [quality_rules.START_GOOD] * 4, [quality_rules.START_BAD] * 4
    for _ in range(quality_rules.MAX_ROUNDS):
        post = []
        for r in rows:
            x = math.log(prior / (1 - prior)) + sum(math.log(g[k] / (1 - b[k])) if v == 1 else math.log((1 - g[k]) / b[k]) if v else 0 for k, v in enumerate(r))
            post.append(1 / (1 + math.exp(-x)))
        old = (prior, *g, *b)
        prior = (sum(post) + 1) / (len(rows) + 2)
        g = [(sum(p for p, r in zip(post, rows) if r[k] == 1) + 1) / (sum(p for p, r in zip(post, rows) if r[k]) + 2) for k in range(4)]
        b = [(sum(1 - p for p, r in zip(post, rows) if r[k] == -1) + 1) / (sum(1 - p for p, r in zip(post, rows) if r[k]) + 2) for k in range(4)]
        b = [max(y, 1 - x) for x, y in zip(g, b)]
        if max(abs(x - y) for x, y in zip(old, (prior, *g, *b))) < quality_rules.TOLERANCE:
            break
    assert abs(got.prior - prior) < 1e-4 and all(abs(got.good[n] - g[k]) < 1e-4 and abs(got.bad[n] - b[k]) < 1e-4 for k, n in enumerate(names))
    assert prior == pytest.approx(0.7, abs=0.08)


def test_quality_of_no_documents(spark):
    out = quality_rules.judge_quality(spark.createDataFrame([], "doc_id long, text string"))
    assert out.count() == 0


# --- prefix trie ------------------------------------------------------------------
def _trie(rows):
    by = collections.defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            by[c].append((turn is not None, turn or 0, role or "", text or ""))
    by = {c: [(r, t) for _, _, r, t in sorted(v)] for c, v in by.items()}
    built = {}
    for c, own in by.items():
        h = zlib.crc32(str(c).encode()) % 6
        built[c] = by.get(c - c % 100, [])[:h] + own[h:]
    members = collections.defaultdict(list)
    for c in sorted(built):
        for d in range(len(built[c]) + 1):
            members[tuple(built[c][:d])].append(c)
    children = collections.Counter(p[:-1] for p in members if p)
    leaves, saved = collections.Counter(), collections.Counter()
    for p, m in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += children[p] == 0
            saved[p[:d]] += (len(m) - 1) * (len(p[-1][1]) if p else 0)
    return sorted((m[0], len(p), members[p[:-1]][0] if p else -1, len(m), children[p], leaves[p], saved[p],
                   hashlib.sha256(",".join(str(c) for c in m if len(built[c]) == len(p)).encode()).hexdigest()) for p, m in members.items())


def _rows(frame):
    return sorted(tuple(-1 if v is None else v for v in r) for r in frame.collect())


@pytest.mark.parametrize("band, segment, piece", [(2, 3, 2), (3, 4096, 4096), (32, 7, 3)])
def test_trie_matches_brute_force(spark, monkeypatch, band, segment, piece):
    for name, value in (("BAND", band), ("SEGMENT", segment), ("PIECE_IDS", piece)):
        monkeypatch.setattr(prefix_trie, name, value)
    rng = random.Random(band)
    rows = []
    for c in [*range(0, 14), *range(100, 112), 200, 305, 307]:
        n = 37 if c in (5, 8) else rng.choice([0, 1, 2, 6, 7, 9, 20])
        rows += [(c, t if rng.random() < 0.95 else None, rng.choice(["user", "assistant", None]), rng.choice(["a", "bé", "", None, "long text"])) for t in range(n)]
    for c in (400, 401, 402, 403):  # equal long conversations
        rows += [(c, t, "user", "same") for t in range(25)]
    rows += [(5, 3, "user", "tie"), (5, 3, "user", "tie"), (None, 0, "user", "no id")]
    rng.shuffle(rows)
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumns({"depth": F.lit(1), "conv": F.lit("x"), "n": F.lit(3)})
    got = prefix_trie.prefix_nodes(*prefix_trie.rebuild(frame))
    assert got.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert _rows(got) == _trie(rows)


def test_trie_of_no_conversations(spark):
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert prefix_trie.prefix_nodes(*prefix_trie.rebuild(empty)).count() == 0
