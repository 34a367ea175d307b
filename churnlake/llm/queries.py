"""The registered queries of this package and the DuckDB SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnlake.llm._common import ship_code


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_code(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_json() -> str:
    """The vocabulary file's text; tasks get it by broadcast (1.6 MB, of fixed size)."""
    import public_tokenizers

    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as f:
        return f.read()


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    from churnlake.llm.decontaminate import contaminated

    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    from churnlake.llm.chat_format import chat_digests, format_chats

    said = "</s>[INST] ok [/INST]"
    probe = spark.range(0, 2, 1, 1).select(
        F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(said).alias("text"))
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(probe)
    return chat_digests(format_chats(rows))


def op3_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from churnlake.llm.embedding_dedup import near_vectors

    return near_vectors(table(spark, sf_dir, "embeddings"), 0.93)


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from churnlake.llm.warc import look_up, page_keys, write_archives, write_index

    pages = table(spark, sf_dir, "pages")
    folder, captures = write_archives(pages)
    records = look_up(page_keys(pages), write_index(captures, folder), with_payload=False)
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from churnlake.llm.packing import pack_documents

    return pack_documents(table(spark, sf_dir, "documents"), tokenizer_json())


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from churnlake.llm.suffix_dedup import remove_repeated_bytes

    out = remove_repeated_bytes(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from churnlake.llm.toxicity import fit_toxicity, held_out, score_toxicity

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = score_toxicity(docs, fit_toxicity(docs, table(spark, sf_dir, "labels").select("doc_id", "toxic")))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted", F.size("segments").cast("long").alias("n_segments"))


def op8_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from churnlake.llm.minhash_dedup import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents"), size=2, percent=80)


def op9_window_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from churnlake.llm.window_dedup import remove_repeated_windows

    out = remove_repeated_windows(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from churnlake.llm.line_dedup import dedup_lines, line_digests

    return line_digests(dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text")))


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    from churnlake.llm.filter_audit import audit, mask_counts

    return audit(mask_counts(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")))


def op12_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from churnlake.llm.quality_rules import judge_quality

    return judge_quality(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    from churnlake.llm.prefix_trie import prefix_nodes, rebuild

    return prefix_nodes(*rebuild(table(spark, sf_dir, "conversations")))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_decontaminate": op1_decontaminate,
    "op2_chat_format": op2_chat_format,
    "op3_embedding_dedup": op3_embedding_dedup,
    "op4_warc": op4_warc,
    "op5_best_fit_packing": op5_best_fit_packing,
    "op6_suffix_dedup": op6_suffix_dedup,
    "op7_toxicity": op7_toxicity,
    "op8_minhash_dedup": op8_minhash_dedup,
    "op9_window_dedup": op9_window_dedup,
    "op10_line_dedup": op10_line_dedup,
    "op11_filter_audit": op11_filter_audit,
    "op12_quality_rules": op12_quality_rules,
    "op13_prefix_trie": op13_prefix_trie,
    "pipeline": pipeline,
}

_OP2 = """
WITH rows_ AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
marked AS (
  SELECT *, role IS NOT DISTINCT FROM lag(role) OVER (PARTITION BY conv_id ORDER BY turn, role, text)
              AND row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) > 1 AS goes_on
  FROM rows_),
sized AS (
  SELECT *, CASE WHEN goes_on THEN length('<|next|>')
                 ELSE length('<|turn|>') + length(replace(replace(role, '\\', '\\\\'), '<|', '<\\|')) + length('<|text|>') + length('<|end|>') END
            + length(replace(replace(text, '\\', '\\\\'), '<|', '<\\|')) AS chars
  FROM marked)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       sum(chars)::BIGINT AS formatted_chars
FROM sized GROUP BY conv_id
"""

_OP10 = """
WITH lines AS (
  SELECT doc_id, u.line AS line, u.pos AS pos
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents),
       LATERAL (SELECT unnest(l) AS line, generate_subscripts(l, 1) AS pos) u),
keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines),
shared AS (
  SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
judged AS (
  SELECT k.doc_id, k.pos, k.line, s.key IS NOT NULL AND k.doc_id <> s.keeper AS dropped
  FROM keyed k LEFT JOIN shared s ON k.key = s.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE dropped) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT dropped), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""

_OP4 = """
WITH p AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
g AS (SELECT payload_digest, max(page_id) AS latest FROM p WHERE payload_bytes >= 1000 GROUP BY payload_digest)
SELECT p.page_id, p.payload_bytes, p.payload_digest,
       CASE WHEN g.latest <> p.page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN g.latest <> p.page_id THEN g.latest END AS refers_to
FROM p LEFT JOIN g ON p.payload_digest = g.payload_digest
"""

_OP11 = r"""
WITH marks AS (
  SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
  FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
texts AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
masks AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
         CASE WHEN len(w) < 200 THEN 1 ELSE 0 END
         + CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 2 ELSE 0 END
         + CASE WHEN 100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 3 * length(t) THEN 4 ELSE 0 END
         + CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 8 ELSE 0 END
         + CASE WHEN texts.doc_id > min(texts.doc_id) OVER (PARTITION BY t) THEN 16 ELSE 0 END AS mask
  FROM texts LEFT JOIN marks ON texts.doc_id = marks.doc_id),
counts AS (SELECT part, mask, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM masks GROUP BY ALL),
f AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f, unnest([1, 2, 4, 8, 16]) AS bit),
orders AS (
  SELECT a.f || b.f || c.f || d.f || e.f AS filter_order
  FROM f a, f b, f c, f d, f e WHERE a.bit + b.bit + c.bit + d.bit + e.bit = 31
    AND len(list_distinct([a.f, b.f, c.f, d.f, e.f])) = 5),
steps AS (
  SELECT filter_order, step, own.f AS own_f, own.bit AS own, coalesce(sum(before.bit), 0)::INT AS earlier
  FROM orders, (SELECT unnest([1, 2, 3, 4, 5])::INT AS step)
  JOIN f own ON own.f = substr(filter_order, step, 1)
  LEFT JOIN f before ON instr(filter_order, before.f) < step
  GROUP BY ALL),
audit AS (
  SELECT part, filter_order, step, own,
         coalesce(sum(n) FILTER (WHERE mask & own = 0 AND mask & earlier = 0), 0)::BIGINT AS kept,
         coalesce(sum(n) FILTER (WHERE mask & own <> 0 AND mask & earlier = 0), 0)::BIGINT AS removed,
         coalesce(sum(n) FILTER (WHERE mask & own <> 0 AND mask & earlier <> 0), 0)::BIGINT AS redundant,
         coalesce(sum(n) FILTER (WHERE mask = own), 0)::BIGINT AS unique_fails,
         coalesce(sum(good) FILTER (WHERE mask & own <> 0 AND mask & earlier = 0), 0)::BIGINT AS good_lost,
         coalesce(sum(toxic) FILTER (WHERE mask & own <> 0 AND mask & earlier = 0), 0)::BIGINT AS toxic_lost
  FROM counts, steps GROUP BY part, filter_order, step, own)
SELECT * EXCLUDE (own), sum(removed) OVER (PARTITION BY part, own)::BIGINT AS shapley FROM audit
"""

_OP13 = r"""
WITH RECURSIVE t AS (
  SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos,
         coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM conversations WHERE conv_id IS NOT NULL),
-- crc32 of the decimal id, bit by bit.
h AS (
  SELECT c, count(*) AS own, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(c::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
    lambda crc, b: list_reduce(list_prepend(xor(crc, b), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
      lambda r, k: CASE WHEN r & 1 = 1 THEN xor(r >> 1, 3988292384::BIGINT) ELSE r >> 1 END)), 4294967295::BIGINT) % 6 AS h
  FROM t GROUP BY c),
given AS (SELECT h.c, b.pos AS depth, b.role, b.text FROM h JOIN t b ON b.c = h.c - h.c % 100 AND b.pos <= h.h),
heads AS (SELECT c, count(*) AS n FROM given GROUP BY c),
rebuilt AS (
  SELECT * FROM given
  UNION ALL
  SELECT h.c, coalesce(heads.n, 0) + t.pos - h.h, t.role, t.text FROM h JOIN t ON t.c = h.c AND t.pos > h.h LEFT JOIN heads ON heads.c = h.c),
p AS (
  SELECT c, 0::BIGINT AS depth, '' AS key, NULL::VARCHAR AS parent, 0::BIGINT AS chars FROM h
  UNION ALL
  SELECT p.c, r.depth, md5(p.key || '/' || md5(r.role) || md5(r.text)), p.key, length(r.text)
  FROM p JOIN rebuilt r ON r.c = p.c AND r.depth = p.depth + 1),
ends AS (
  SELECT depth, key, string_agg(c::VARCHAR, ',' ORDER BY c) AS ids
  FROM (SELECT *, max(depth) OVER (PARTITION BY c) AS n FROM p) WHERE depth = n GROUP BY depth, key),
nodes AS (SELECT depth, key, min(parent) AS parent, min(c) AS rep, count(*) AS n, min(chars) AS chars FROM p GROUP BY depth, key),
children AS (SELECT depth - 1 AS depth, parent AS key, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY ALL),
totals AS (
  SELECT a.depth, a.key, count(*) FILTER (WHERE ch.n IS NULL) AS leaves, sum((x.n - 1) * x.chars) AS saved
  FROM nodes x JOIN p a ON a.c = x.rep AND a.depth <= x.depth
  LEFT JOIN children ch ON ch.depth = x.depth AND ch.key = x.key GROUP BY a.depth, a.key)
SELECT x.rep AS conv_id, x.depth, up.rep AS parent_conv_id, x.n AS n_convs, coalesce(ch.n, 0) AS n_children, totals.leaves AS n_leaves,
       totals.saved::BIGINT AS saved_tokens, sha256(coalesce(ends.ids, '')) AS ends_sha256
FROM nodes x JOIN totals ON totals.depth = x.depth AND totals.key = x.key
LEFT JOIN children ch ON ch.depth = x.depth AND ch.key = x.key
LEFT JOIN ends ON ends.depth = x.depth AND ends.key = x.key
LEFT JOIN nodes up ON up.depth = x.depth - 1 AND up.key = x.parent
"""

ORACLE: dict[str, str] = {"op4_warc": _OP4, "op2_chat_format": _OP2, "op10_line_dedup": _OP10, "op11_filter_audit": _OP11, "op13_prefix_trie": _OP13}
