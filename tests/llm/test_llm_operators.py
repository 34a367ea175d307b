"""Brute-force and edge-case tests of the training-data operators, on small fixtures with small chunks."""

import collections
import hashlib
import itertools
import math
import random
import re
import types
import zlib

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from churnlake.llm import _tokens, chat_format, decontaminate, embedding_dedup, line_dedup, minhash_dedup, packing, queries, suffix_dedup, toxicity, warc, window_dedup
from churnlake.llm._common import connected_components
from conftest import SF_SMALL

WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def texts():
    """Copies, near copies, shared passages, repeated rows, empty, null and long texts; ids are not in order."""
    rng = random.Random(5)
    words = ["".join(rng.choice("aeiouxyzé") for _ in range(rng.randint(1, 5))) for _ in range(60)]
    passage = " ".join(rng.choice(words) for _ in range(60))
    out = []
    for i in range(60):
        body = [rng.choice(words) for _ in range(rng.choice([0, 1, 3, 40, 120]))]
        if i % 4 == 0:
            body[len(body) // 2 : len(body) // 2] = passage.split()
        out.append((i * 7 % 61, "\n".join(" ".join(body[k : k + 30]) for k in range(0, len(body), 30))))
    for i in range(12):
        source = out[5 * i % 60][1].split(" ")
        if source and i % 2:
            source[len(source) // 2] = "changed"
        out.append((100 + i, " ".join(source)))
    return [*out, (200, None), (201, ""), (202, "ab " * 3000), (None, "no id " * 30), (202, "ab " * 3000)]


@pytest.fixture(scope="module")
def docs(spark, texts):
    df = spark.createDataFrame(texts, "doc_id long, text string")
    return df.withColumn("chunk", F.lit(1)).withColumn("n_lines", F.lit("x")).withColumn("row", F.lit(2))


def test_windows_match_brute_force(docs, texts):
    got = collections.Counter((r.doc_id, r.n_words, r.n_removed, r.kept) for r in window_dedup.remove_repeated_windows(docs, window=10, chunk_bytes=2000).collect())
    every = [(i, WORD.findall(t or "")) for i, t in texts]
    count = collections.Counter(tuple(w[k : k + 10]) for _, w in every for k in range(len(w) - 9))
    want = collections.Counter()
    for i, w in every:
        gone = [False] * len(w)
        for k in range(len(w) - 9):
            if count[tuple(w[k : k + 10])] > 1:
                gone[k : k + 10] = [True] * 10
        want[(i, len(w), sum(gone), " ".join(x for x, g in zip(w, gone) if not g))] += 1
    assert got == want


@pytest.mark.parametrize("ranges", [suffix_dedup.MAX_RANGES, 3])
def test_bytes_match_brute_force(docs, texts, ranges, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "MAX_RANGES", ranges)
    got = collections.Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in suffix_dedup.remove_repeated_bytes(
        docs, length=50, chunk_bytes=2000, part_bytes=1500).collect())
    least = {}
    for i, t in texts:
        b = (t or "").encode()
        for k in range(len(b) - 49):
            if i is not None:
                least[b[k : k + 50]] = min(i, least.get(b[k : k + 50], i))
    want = collections.Counter()
    for i, t in texts:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for k in range(len(b) - 49):
            if i is not None and least[b[k : k + 50]] < i:
                gone[k : k + 50] = b"\1" * 50
        want[(i, len(b), sum(gone), len(re.findall(b"\1+", bytes(gone))), bytes(x for x, g in zip(b, gone) if not g))] += 1
    assert got == want


@pytest.mark.parametrize("size", [2, 5])
def test_near_duplicates_match_brute_force(docs, texts, size, monkeypatch):
    monkeypatch.setattr(minhash_dedup, "BLOCK_BYTES", 4000)
    got = {(r.doc_id, r.n_shingles): (r.component_id, r.kept) for r in minhash_dedup.near_duplicates(docs, size=size).collect() if r.doc_id is not None}
    sets = {}
    for i, t in texts:
        w = WORD.findall((t or "").lower())
        sets[i] = frozenset(tuple(w[k : k + size]) for k in range(len(w) - size + 1)) if len(w) >= size else frozenset([tuple(w)] if w else [])
    root = {i: i for i in sets if i is not None}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in root:
        for b in root:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    assert got == {(i, len(sets[i])): (find(i), find(i) == i) for i in root}


def _chain(spark, n):
    """Texts of 100 distinct words that share 67 with the next one, and so buckets but no link; every tenth has a near copy."""
    rows = [(i, " ".join(f"w{33 * i + k}" for k in range(100))) for i in range(n)]
    return spark.createDataFrame([*rows, *((n + i, t.replace(" ", " other ", 1)) for i, t in rows[::10])], "doc_id long, text string")


def test_a_chain_of_buckets_costs_what_its_buckets_hold(spark, monkeypatch):
    monkeypatch.setattr(minhash_dedup, "BLOCK_BYTES", 2000)
    met, meetings = [], minhash_dedup._meetings

    def counted(members, found):
        out = meetings(members, found)
        met.append((out.count(), members.count(), out.where("key <> 0").count()))
        return out

    monkeypatch.setattr(minhash_dedup, "_meetings", counted)
    for n in (100, 200):
        got = {r.doc_id: r.component_id for r in minhash_dedup.near_duplicates(_chain(spark, n), size=1).collect()}
        assert got == {i: i if i < n else i - n for i in got} and len(got) == n + n // 10
    # Blocks of the whole chain would meet each other: four times the rows for twice the documents.
    assert all(apart > 0 and rows <= 3 * shared for rows, shared, apart in met) and met[1][0] < 3 * met[0][0]


def test_rows_of_one_id_are_one_document(spark):
    x, y, z = (" ".join(f"{c}{k}" for k in range(60)) for c in "xyz")
    rows = [(3, x), (5, x), (5, y), (9, y + " end"), (5, ""), (12, z), (11, z), (9, z + " end"), (20, "alone"), (21, "one"), (21, ""), (None, x), (30, None)]
    got = collections.Counter((r.doc_id, r.component_id, r.kept) for r in minhash_dedup.near_duplicates(
        spark.createDataFrame(rows, "doc_id long, text string")).collect())
    component = {3: 3, 5: 3, 9: 3, 11: 3, 12: 3, 20: 20, 21: 21, 30: 30, None: None}
    assert got == collections.Counter((i, component[i], i in (3, 20, 21, 30, None)) for i, _ in rows)


def test_packing_places_every_piece_once(docs, texts):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_str(queries.tokenizer_json())
    rows = packing.pack_documents(docs, queries.tokenizer_json(), seq_len=64).collect()
    assert sum(r.length for r in rows) == sum(len(tokenizer.encode(t or "", add_special_tokens=False).ids) + 1 for _, t in texts)
    by_seq = collections.defaultdict(list)
    for r in rows:
        by_seq[r.sequence_id].append((r.offset, r.length))
    for parts in by_seq.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 64
    assert len(by_seq) <= 1.1 * sum(r.length for r in rows) / 64 + 1
    ids = tokenizer.encode(texts[1][1], add_special_tokens=False).ids + [0]
    for r in (r for r in rows if r.doc_id == texts[1][0]):
        assert r.ids_crc32 == zlib.crc32(np.array(ids[r.start : r.start + r.length], "<u4").tobytes())


def test_ids_are_those_of_whole_texts():
    from tokenizers import Tokenizer

    end, new = "<|endoftext|>", chr(0x10D41)  # a digit of Unicode 16
    rng = random.Random(8)
    pieces = [end, end[:-1], "|>", "<|", " ", "  ", "\n", "'re", "'s", "a", "word", "7", "é", new, "\u1c89", "\uffff", "\u0378", "!", "\x85", "世"]
    rows = ["hello <|endoftext|> world", end, end * 2, None, "", "a<|endof", "text|>b", f"1{new}2", f"x {end}{new} {end}  y"]
    rows += ["".join(rng.choice(pieces) for _ in range(rng.randint(0, 30))) for _ in range(1500)]
    tokenizer = Tokenizer.from_str(queries.tokenizer_json())
    want = [tokenizer.encode(t or "", add_special_tokens=False).ids + [0] for t in rows]
    assert want[0] == [31373, 220, 50256, 995, 0]
    stripping = queries.tokenizer_json().replace('"lstrip":false', '"lstrip":true').replace('"lstrip": false', '"lstrip": true')
    whole = Tokenizer.from_str(stripping)
    assert whole.encode(rows[0], add_special_tokens=False).ids + [0] != want[0]
    for source, expected in ((queries.tokenizer_json(), want), (stripping, [whole.encode(t or "", add_special_tokens=False).ids + [0] for t in rows])):
        for limit in (200, 1 << 21):
            got = []
            for _, _, ids, ends in _tokens.WordTokenizer(source).encode(pa.array(rows), 0, limit):
                got += [x.tolist() for x in np.split(ids, ends[:-1])]
            assert got == expected


def test_line_dedup_edges(spark):
    line = "This LINE is held by many documents, all of them."
    rows = [(i, f"  {line.lower()}\nown {i}\n{line}") for i in range(6)] + [(9, None), (10, ""), (None, line), (5, f"{line}\n")]
    got = {(r.doc_id, r.text): (r.n_lines, r.n_dropped) for r in line_dedup.dedup_lines(
        spark.createDataFrame(rows, "doc_id long, text string").withColumn("drop", F.lit(1)).withColumn("row", F.lit(1))).collect()}
    want = {(i, f"own {i}"): (3, 2) for i in range(5)} | {(5, rows[5][1]): (3, 0), (9, None): (1, 0), (10, ""): (1, 0), (None, line): (1, 0), (5, f"{line}\n"): (2, 0)}
    assert got == want


def test_chats_read_back(spark):
    nasty = "a\\<|end|><\\|next|>\\\\<|"
    rows = [(1, 2, "assistant", nasty), (1, 0, "user", None), (1, 1, "user", "<"), (1, 2, "assistant", nasty), (2, 0, None, "x<"), (None, 0, "assistant", "|")]
    out = {r.conv_id: r for r in chat_format.read_chats(chat_format.format_chats(
        spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("t", F.lit(1)))).collect()}
    assert [tuple(t) for t in out[1].turns] == [("user", ""), ("user", "<"), ("assistant", nasty), ("assistant", nasty)]
    assert out[1].loss_text == nasty * 2 and out[1].formatted.count("<|turn|>") == 2
    assert [tuple(t) for t in out[2].turns] == [("", "x<")] and out[2].loss_text == "" and out[None].loss_text == "|"


def test_byte_string_lengths_out_of_range_are_refused(docs):
    for length in (24, 57):
        with pytest.raises(ValueError, match="from 25 to 56"):
            suffix_dedup.remove_repeated_bytes(docs, length=length)


def test_splitters_come_from_all_texts(spark):
    """One long text and many short ones, a passage in all: every range gets about the same number of leads, no chunk matters more."""
    rng = np.random.default_rng(11)
    letters = np.frombuffer(b"abcdefghijklmnopqrstuvwxyz ", np.uint8)
    draw = lambda n: letters[rng.integers(0, len(letters), n)].tobytes().decode()
    common = draw(120)
    texts = [(0, draw(400_000)), *[(i, draw(200) + common + draw(200)) for i in range(1, 800)], (900, None), (901, "short")]
    rows, total = suffix_dedup.C.chunked(spark.createDataFrame(texts, "doc_id long, text string"), "doc_id", "text", 50_000)
    parts = total // 50_000
    cuts = suffix_dedup._splitters(rows, 50, parts, 4)
    assert parts // 2 < len(cuts) < parts and (cuts[1:] > cuts[:-1]).all()
    whole = suffix_dedup._Chunk(rows.select("doc_id", "mark", "text").toArrow(), 50)
    leads = np.array([whole.data[a : a + 24].tobytes() for a in whole.at.tolist()], "S24")
    distinct = np.unique(leads)
    share = np.bincount(np.searchsorted(cuts, distinct, "right"), minlength=len(cuts) + 1) / len(distinct)
    assert share.max() < 4 / parts
    assert len(suffix_dedup._splitters(rows.where("doc_id > 900"), 50, parts, 1)) == 0


def test_vectors_of_extreme_size_keep_their_cosine(spark):
    base = np.random.default_rng(5).standard_normal(8)
    rows = [(1, base.tolist(), 0), (2, (base * 1e300).tolist(), 0), (3, (base * 1e-300).tolist(), 0), (4, (-base * 1e300).tolist(), 0)]
    got = {r.vec_id: (r.n_links, r.component_id) for r in embedding_dedup.near_vectors(
        spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()}
    assert got == {1: (2, 1), 2: (2, 1), 3: (2, 1), 4: (0, 4)}


def test_embeddings_match_brute_force(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "LEAF", 64)
    monkeypatch.setattr(embedding_dedup, "BLOCK", 16)
    rng = np.random.default_rng(3)
    base = rng.standard_normal((150, 16))
    x = np.concatenate([base, base[:60] + 0.12 * rng.standard_normal((60, 16)), base[:20]])
    rows = [(i, v.tolist(), int(i % 3 == 0) if i < 220 else 0) for i, v in enumerate(x)]
    odd = [(500, None, 1), (501, [0.0] * 16, 1), (502, [float("nan")] * 16, 1), (503, [None] * 16, 1), (504, x[0].tolist(), None), (505, [], 1)]
    got = {r.vec_id: (r.n_links, r.component_id) for r in embedding_dedup.near_vectors(
        spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>, label int")).collect()}
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    label = np.array([r[2] for r in rows])
    link = (unit @ unit.T >= 0.93) & (label[:, None] == label)
    np.fill_diagonal(link, False)
    assert [got[i][0] for i in range(len(x))] == link.sum(1).tolist()
    assert all(got[i] == (0, i) for i, _, _ in odd)


def _links_and_components(x, label, ids, threshold=0.93):
    unit = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    link = (unit @ unit.T >= threshold) & (label[:, None] == label)
    np.fill_diagonal(link, False)
    least = ids.copy()
    while True:
        new = np.array([min(least[i], least[link[i]].min(initial=least[i])) for i in range(len(ids))])
        if (new == least).all():
            return {int(i): (int(n), int(c)) for i, n, c in zip(ids, link.sum(1), least, strict=True)}
        least = new


@pytest.mark.parametrize(("kind", "block", "leaf"), [("float", 400, 8), ("double", 60, 4), ("float", 25, 16)])
def test_embeddings_in_blocks_and_cells_match_brute_force(spark, monkeypatch, kind, block, leaf):
    """Labels of several blocks or many cells, fine cells within, clusters at the threshold, equal vectors in several batches."""
    monkeypatch.setattr(embedding_dedup, "BLOCK", block)
    monkeypatch.setattr(embedding_dedup, "LEAF", leaf)
    rng = np.random.default_rng(block)
    x = rng.standard_normal((1500, 24))
    x[600:900] = x[:300] + 0.33 * rng.standard_normal((300, 24))
    x[900:1100] = 3 * rng.standard_normal(24) + 0.9 * rng.standard_normal((200, 24))
    x[1300:1400] = x[1400:] = x[900:1000]
    x = x.astype(np.float32)
    label = np.where(np.arange(1500) % 4 == 0, 1, 0)
    label[1300:1400] = label[1400:] = label[900:1000]
    ids = rng.permutation(1500) * 3
    rows = spark.createDataFrame([(int(i), v.tolist(), int(k)) for i, v, k in zip(ids, x, label, strict=True)], f"vec_id long, embedding array<{kind}>, label int")
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in embedding_dedup.near_vectors(rows.repartition(5)).collect()}
    want = _links_and_components(x, label, ids)
    assert sum(n for n, _ in want.values()) > 4000
    assert got == {i: (n, c, c == i) for i, (n, c) in want.items()}


def _routed(x, total, monkeypatch=None):
    """What a task sends for vectors that are a sample of ``total`` of one label."""
    n = len(x)
    hashes = np.random.default_rng(0).integers(0, 2**62, (2, n))
    table = pa.table({"label": pa.array(np.zeros(n, np.int64)), "h1": pa.array(hashes[0]), "h2": pa.array(hashes[1]), "vec_id": pa.array(np.arange(n)),
                      "size": pa.array(np.full(n, x.shape[1], np.int32)), "vector": pa.array(x.tolist(), pa.list_(pa.float32()))})
    plans, groups = embedding_dedup._plan(table, n / total, 0.93, 4, np.float32)
    route = embedding_dedup._router(types.SimpleNamespace(value=(plans, dict(zip(groups, itertools.count())))), 0.93, np.float32)  # noqa: B905
    return groups, list(route(iter(table.drop(["size"]).to_batches(500))))


@pytest.mark.parametrize(("total", "copies"), [(60_000, 1.2), (1_500_000, 3.3), (15_000_000, 14)])
def test_vectors_travel_a_few_times_however_many_there_are(total, copies):
    """At 600,000 vectors and more the forest sent each vector to dozens of leaves, with kilobytes of leaf numbers each time."""
    rng = np.random.default_rng(4)
    x = rng.standard_normal((4000, 64)).astype(np.float32)
    x[:1000] = x[1000:2000] + 0.3 * rng.standard_normal((1000, 64)).astype(np.float32)
    groups, batches = _routed(x, total)
    assert max(b.nbytes for b in batches) < 16 << 20
    assert sum(b.nbytes for b in batches) < copies * 4000 * (64 * 4 + 50)
    rows = [r for b in batches for r in b.to_pylist()]
    assert sum(r["rows"] for r in rows if not r["guest"]) == 4000
    assert {(r["size"], r["label"], r["cell"], r["block"]) for r in rows} <= set(groups)
    assert len({r["spot"] for r in rows}) == len(groups)
    # All groups together find every link once.
    compare = embedding_dedup._comparer(0.93, np.float32, 16)
    rows.sort(key=lambda r: (r["cell"], r["block"], r["guest"]))
    sent = pa.RecordBatch.from_pylist([{k: v for k, v in r.items() if k != "spot"} for r in rows], pa.schema(
        [("size", pa.int32()), ("label", pa.int64()), ("cell", pa.int32()), ("block", pa.int32()), ("guest", pa.bool_()), ("rows", pa.int32()), ("data", pa.binary())]))
    links = collections.Counter()
    for batch in compare(iter([sent])):
        for r in batch.to_pylist():
            links[r["rep"]] += r["links"] or 0
    want = _links_and_components(x, np.zeros(4000), np.arange(4000))
    assert {i: n for i, n in links.items() if n and i is not None} == {i: n for i, (n, _) in want.items() if n}


def test_opposite_ends_of_a_tight_cluster_are_linked():
    """Pairs at the threshold on opposite sides of the mean of their group, in hundreds of cells."""
    rng = np.random.default_rng(6)
    centre, off = rng.standard_normal(64), rng.standard_normal((1500, 64))
    centre /= np.linalg.norm(centre)
    off -= (off @ centre)[:, None] * centre
    off *= 0.18 / np.linalg.norm(off, axis=1, keepdims=True)
    x = np.concatenate([centre + off, centre - off]).astype(np.float32)
    meta = {k: np.arange(3000).astype(t) for k, t in embedding_dedup.META} | {"n": np.ones(3000, np.int64)}
    homes = embedding_dedup._Rows(64, np.float32)
    for part in embedding_dedup._pack(meta, x, np.arange(3000)):
        homes.add(*part)
    group = embedding_dedup._Group((64, 0, 0, 0), homes, 0.93, 6)
    assert len(group.pivots) == 500
    assert (group.homes.links == 2999).all()


def test_parts_of_a_class_among_guests_count_once():
    x = np.random.default_rng(8).standard_normal((40, 16)).astype(np.float32)

    def rows(ids, own):
        out = embedding_dedup._Rows(16, np.float32)
        meta = {"id": np.array(ids), "h1": np.array(own), "h2": np.array(own) + 1, "n": np.ones(len(ids), np.int64),
                "cells": np.ones(len(ids), np.uint64), "home": np.zeros(len(ids), np.int16)}
        for part in embedding_dedup._pack(meta, x[own], np.arange(len(ids))):
            out.add(*part)
        return out

    homes = rows(range(40), range(40))
    group = embedding_dedup._Group((16, 0, 0, 0), homes, 0.93, 128)
    x[39] = x[0] * 2
    guest = embedding_dedup._Rows(16, np.float32)
    for ids in ([500, 501], [400]):  # the same vector, in two chunks of guests
        guest = rows(ids, [39] * len(ids))
        group.host(guest)
    found = [r for b in group.found() for r in b.to_pylist()]
    assert [(r["rep"], r["h1"], r["n"], r["links"]) for r in found if r["rep"] is not None] == [(500, 39, 0, 1), (0, 0, 1, 3)]
    assert [(r["h1"], r["other1"]) for r in found if r["rep"] is None] == [(0, 39), (0, 39)]


def _contaminated(rows, items, threshold=0.6, overlap=0.8):
    """Every passage of every text against every item, in plain Python."""
    words = lambda t: re.findall(r"[a-z0-9]+", t.lower())
    grams = lambda w: {tuple(w[k : k + 5]) for k in range(len(w) - 4)}
    every = [(i, t, words(t)) for i, t in items]
    mean = sum(len(w) for _, _, w in every) / len(every)
    df = collections.Counter(x for _, _, w in every for x in set(w))
    best = {}
    for item, text, own in every:
        weight = {x: math.log1p((len(every) - df[x] + 0.5) / (df[x] + 0.5)) * n * 2.2 / (n + 1.2 * (0.25 + 0.75 * len(own) / mean))
                  for x, n in collections.Counter(own).items()}
        question, answer = decontaminate.question_answer(text)
        question, answer = grams(words(question)), set(words(answer))
        step = 64
        while step < len(own):
            step *= 2
        for doc, body in rows:
            w = words(body or "")
            for k in range(0, max(1, len(w)), step):
                passage = w[k : k + 2 * step]
                score = sum(weight[x] for x in set(passage) & set(weight)) / sum(weight.values())
                q, a = len(question & grams(passage)) / len(question), len(answer & set(passage)) / len(answer) if answer else 1.0
                if score >= threshold - 1e-9 and q >= overlap and a >= overlap:
                    best[doc, item] = max(best.get((doc, item), (0,)), (round(score, 9), round(q, 9), round(a, 9)))
                if k + 2 * step >= len(w):
                    break
    return best


def test_decontamination_matches_brute_force(spark, monkeypatch):
    rng = np.random.default_rng(17)
    vocabulary = [f"w{k}" for k in range(400)]
    draw = lambda n: " ".join(rng.choice(vocabulary, n, p=(p := 1 / np.arange(1, 401)) / p.sum()))
    items = [(k, f"{draw(int(n))}.\n{draw(3)}") for k, n in enumerate(rng.integers(8, 40, 70))]
    items += [(100, draw(150) + ". " + draw(10)), (101, draw(400) + ".\n" + draw(4)), (102, items[0][1]), (103, items[5][1] + " more")]
    rows = []
    for doc in range(120):
        body = [draw(int(rng.integers(5, 300)))]
        for k in rng.choice(len(items), 2):
            w = items[k][1].split()
            keep = [x for x in w if rng.random() < (1, 0.97, 0.85, 0.6)[doc % 4]]
            body += [" ".join(keep), draw(int(rng.integers(0, 150)))]
        rows.append((doc, " ".join(body) if doc % 7 else body[1]))
    rows += [(500, None), (501, ""), (502, "w1 w2"), (503, " ".join(t for _, t in items))]
    want = _contaminated(rows, items)
    assert len(want) > 100 and {i for d, i in want if d == 503} == {i for i, _ in items}
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("item_id", F.lit(1)).withColumn("word", F.lit(2))
    bench = spark.createDataFrame(items, "item_id long, text string").withColumn("n", F.lit(1))
    for part_items, group_bytes, step in ((1024, 8 << 20, 1 << 20), (20, 6000, 64)):
        monkeypatch.setattr(decontaminate, "PART_ITEMS", part_items)
        monkeypatch.setattr(decontaminate, "GROUP_BYTES", group_bytes)
        monkeypatch.setattr(decontaminate, "STEP", step)
        got = {(r.doc_id, r.item_id): tuple(round(x, 9) for x in (r.score, r.question_overlap, r.answer_overlap))
               for r in decontaminate.contaminated(docs, bench).collect()}
        assert got.keys() == want.keys()
        assert all(got[k] == pytest.approx(want[k], abs=1e-8) for k in want)


def test_decontamination_scans_documents_once(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    items = spark.range(5000).select(F.col("id").alias("item_id"), F.concat_ws(" ", *[F.concat(F.lit("t"), F.col("id") % (7 + k), F.lit(f"x{k}")) for k in range(12)]).alias("text"))
    plan = decontaminate.contaminated(docs, items)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("Union") == 0


def test_decontamination_and_toxicity_edges(spark):
    item = "Which river runs through the quiet town of Xanthe in the north?\nThe river Oder runs there."
    docs = spark.createDataFrame([(1, "word " * 300 + item.upper() + " tail" * 300), (2, "word " * 500), (3, None), (4, ""), (None, "x")], "doc_id long, text string")
    items = spark.createDataFrame([(7, item), (8, None), (9, "unrelated words that nobody wrote anywhere else")], "item_id long, text string")
    assert [(r.doc_id, r.item_id) for r in decontaminate.contaminated(docs, items).collect()] == [(1, 7)]
    assert decontaminate.contaminated(docs.limit(0), items).count() == 0 and decontaminate.contaminated(docs, items.limit(0)).count() == 0
    model = toxicity.fit_toxicity(docs, spark.createDataFrame([], "doc_id long, toxic int"))
    assert toxicity.score_toxicity(docs, model).where("predicted = 0 AND score BETWEEN 0 AND 1").count() == 5


def test_toxic_words_are_learned(spark):
    rng = random.Random(1)
    words = ["".join(rng.choice("abcdefgh") for _ in range(4)) for _ in range(80)]
    rows = [(i, " ".join(rng.choice(words) for _ in range(60)) + (" vile scum rotten scum" if i % 5 == 0 else ""), int(i % 5 == 0)) for i in range(600)]
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    scored = toxicity.score_toxicity(df, toxicity.fit_toxicity(df, df.select("doc_id", "toxic"))).join(df, "doc_id")
    assert scored.where("predicted <> toxic").count() <= 6


def test_maximal_segments_are_the_best():
    rng = np.random.default_rng(2)
    for _ in range(50):
        gain = rng.normal(-0.3, 1, 30)
        total = np.concatenate([[0], np.cumsum(gain)])
        at = np.flatnonzero(gain > 0)
        best = max((total[j] - total[i] for i in range(30) for j in range(i + 1, 31)), default=0)
        found = toxicity.maximal_segments(at, gain[at], total[at])
        if len(at):
            assert max(s for _, _, s in found) == pytest.approx(best)


def test_warc_round_trip(spark, monkeypatch):
    monkeypatch.setattr(warc, "BLOCK_LINES", 3)
    big = "é" * 600
    rows = [(i, f"https://h{i % 2}.example.org/p?{i}\t", big if i % 3 == 0 else f"page {i}") for i in range(20)] + [(50, None, None), (51, "x", ""), (None, "http://n", big), (3, "https://h1.example.org/p?3\t", big)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    folder, captures = warc.write_archives(pages)
    got = collections.Counter((r.page_id, r.url, r.record_type, r.refers_to, r.payload_bytes, r.payload_digest) for r in warc.look_up(
        warc.page_keys(pages), warc.write_index(captures, folder)).collect())
    want = collections.Counter()
    for i, url, html in rows:
        b = (html or "").encode()
        old = len(b) >= 1000 and i is not None and i != 18
        want[(i, url, "revisit" if old else "response", 18 if old else None, len(b), hashlib.sha1(b).hexdigest())] += 1
    assert got == want


def test_components(spark):
    rng = random.Random(4)
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + rng.randint(1, 50)) for _ in range(60)] + [(7, 7)]
    got = {r.id: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got[i] == 0 for i in range(41)) and {v for k, v in got.items() if k >= 100} == {100}


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_matches_oracle(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "conversations", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    df = queries.QUERIES[name](spark, SF_SMALL)
    res = con.execute(queries.ORACLE[name])
    cols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(cols)
    assert sorted(map(str, (tuple(r) for r in df.select(*cols).collect()))) == sorted(map(str, res.fetchall()))


def test_pipeline_keeps_clean_documents(spark):
    import corpus_pipeline

    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "near_dedup", "decontamination", "packing"]
    rows = corpus_pipeline.run(spark, SF_SMALL)
    left = {r.doc_id for r in rows.select("doc_id").distinct().collect()}
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    assert left <= {r.doc_id for r in docs.select("doc_id").collect()} and len(left) > 0.6 * docs.count()
