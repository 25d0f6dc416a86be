"""Queries of the training-data operators: production parameters, whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bucket_of, load


def op1_sentence_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .spans import drop_repeats
    kept = drop_repeats(load(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("own.doc_id", "n_sentences", "n_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"), "text")


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .toxicity import fit, with_score
    docs = load(spark, sf_dir, "documents")
    model = fit(docs, load(spark, sf_dir, "labels"), bucket_of(F.col("labelled_id"), 5) != 0)
    return with_score(docs.select("doc_id", "text"), model).select(
        "doc_id", (bucket_of(F.col("doc_id"), 5) == 0).alias("held_out"), "score",
        F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))


def op3_impact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .topk import scaled, top_k
    vectors = load(spark, sf_dir, "embeddings").select("vec_id", scaled(F.col("embedding")).alias("v"))
    return top_k(vectors, F.col("vec_id") % 50 == 0).select(
        F.col("query_id"), F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def op4_language_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .langid import fit, label_spans
    docs = load(spark, sf_dir, "documents")
    model = fit(docs, bucket_of(F.col("doc_id"), 4) != 2)
    return label_spans(docs, model).select(
        "doc_id", (bucket_of(F.col("doc_id"), 4) == 2).alias("held_out"), "lang_pred", "score",
        F.size("spans").alias("n_spans"))


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .urls import judge_urls
    return judge_urls(load(spark, sf_dir, "pages")).drop("score")


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .decontam import find_leaks, report
    return report(find_leaks(load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark")))


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from .bpe import digests, encode_decode
    return digests(encode_decode(load(spark, sf_dir, "documents"),
                                 public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN))


def op8_best_fit_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .sharding import shard_documents
    return shard_documents(load(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .suffix_dedup import cut_repeats, report
    return report(cut_repeats(load(spark, sf_dir, "documents")))


def op10_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .ngram_join import link_components
    return link_components(load(spark, sf_dir, "documents")).drop("row")


def op11_bin_slack_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from .packing import pack_documents
    return pack_documents(load(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .manifest import prove_documents
    return prove_documents(load(spark, sf_dir, "documents"))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .conversations import repair
    return repair(load(spark, sf_dir, "conversations"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_sentence_spans": op1_sentence_spans,
    "op2_toxicity": op2_toxicity,
    "op3_impact_topk": op3_impact_topk,
    "op4_language_spans": op4_language_spans,
    "op5_url_filter": op5_url_filter,
    "op6_decontamination": op6_decontamination,
    "op7_byte_bpe": op7_byte_bpe,
    "op8_best_fit_shards": op8_best_fit_shards,
    "op9_suffix_dedup": op9_suffix_dedup,
    "op10_ngram_join": op10_ngram_join,
    "op11_bin_slack_packing": op11_bin_slack_packing,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_conversation_repair": op13_conversation_repair,
}

def _crc32_sql(text: str) -> str:
    """CRC-32 of an ASCII string, a bit at a time."""
    bits = f"flatten(list_transform(string_split({text}, ''), lambda c: list_transform(range(8), lambda b: CAST((ascii(c) >> b) & 1 AS BIGINT))))"
    return f"""xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), {bits}),
        lambda r, b: xor(r >> 1, 3988292384 * (xor(r, b) & 1))), 4294967295)"""


def _leaf_sql(text: str) -> str:
    fields = ["CAST(doc_id AS VARCHAR)", "source", "lang", "CAST(n_chars AS VARCHAR)", text]
    return "sha256(" + " || ".join(f"CASE WHEN {f} IS NULL THEN '-' ELSE CAST(strlen({f}) AS VARCHAR) || ':' || {f} END" for f in fields) + ")"


#: DuckDB SQL of the queries that SQL can express.
SQL: dict[str, str] = {
    "op3_impact_topk": """
WITH v AS (
  SELECT vec_id, row_number() OVER () AS row, list_transform(embedding, lambda e: floor(256 * CAST(e AS DOUBLE))) AS x
  FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
    AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0),
scored AS (
  SELECT q.row AS query_row, q.vec_id AS query_id, c.vec_id, c.row,
         CAST(list_inner_product(q.x, c.x) AS BIGINT) AS score
  FROM v q JOIN v c ON q.row <> c.row WHERE q.vec_id % 50 = 0),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_row ORDER BY score DESC, vec_id, row) AS rank FROM scored)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 5""",
    "op6_decontamination": r"""
WITH w AS (
  SELECT 'd' AS kind, doc_id AS id, row_number() OVER () AS row,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents
  UNION ALL
  SELECT 'b', item_id, row_number() OVER (),
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') FROM benchmark),
sizes AS (SELECT DISTINCT least(10, len(ws)) AS m FROM w WHERE kind = 'b' AND len(ws) > 0),
item_windows AS (
  SELECT DISTINCT id, least(10, len(ws)) AS m, list_slice(ws, i, i + least(10, len(ws)) - 1) AS g
  FROM (SELECT id, ws, unnest(range(1, len(ws) - least(10, len(ws)) + 2)) AS i FROM w WHERE kind = 'b' AND len(ws) > 0)),
doc_windows AS (
  SELECT row, m, i, list_slice(ws, i, i + m - 1) AS g
  FROM (SELECT row, ws, m, unnest(range(1, len(ws) - m + 2)) AS i FROM w, sizes WHERE kind = 'd' AND len(ws) >= m)),
met AS (SELECT row, d.m, i, id FROM doc_windows d JOIN item_windows USING (m, g)),
hit AS (SELECT row, count(DISTINCT p) AS n_hit FROM (SELECT row, unnest(range(i, i + m)) AS p FROM met) GROUP BY row),
items AS (SELECT row, count(DISTINCT id) AS n_items,
                 string_agg(DISTINCT CAST(id AS VARCHAR), ',' ORDER BY CAST(id AS VARCHAR)) AS ids FROM met GROUP BY row)
SELECT w.id AS doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM w LEFT JOIN hit USING (row) LEFT JOIN items USING (row) WHERE kind = 'd'""",
    "op10_ngram_join": r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (
  SELECT DISTINCT doc_id, list_slice(ws, i, i + least(5, len(ws)) - 1) AS g
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - least(5, len(ws)) + 2)) AS i FROM w WHERE len(ws) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
o AS (SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS o FROM s a JOIN s b USING (g) WHERE a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (SELECT u, v FROM o JOIN n a ON a.doc_id = u JOIN n b ON b.doc_id = v WHERE 100 * o >= 80 * (a.n + b.n - o)),
reach AS (SELECT doc_id AS node, doc_id AS seen FROM w UNION SELECT node, v FROM reach JOIN links ON u = seen)
SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, component_id
FROM w LEFT JOIN n USING (doc_id) JOIN (SELECT node, min(seen) AS component_id FROM reach GROUP BY node) ON node = w.doc_id""",
    "op12_merkle_manifest": f"""
WITH RECURSIVE leaves AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce('=' || lang, '') AS grp, {_leaf_sql("text")} AS leaf,
         CASE WHEN doc_id IS NOT NULL AND {_crc32_sql("CAST(doc_id AS VARCHAR)")} % 3 = 0
              THEN {_leaf_sql("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} END AS now FROM documents),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY grp ORDER BY doc_id NULLS FIRST, leaf, rid) - 1 AS idx,
         count(*) OVER (PARTITION BY grp) AS n FROM leaves),
nodes AS (
  SELECT grp, 0 AS level, idx, leaf AS node, n FROM placed
  UNION ALL
  SELECT grp, level + 1, idx // 8, sha256(string_agg(node, '' ORDER BY idx)), (any_value(n) + 7) // 8
  FROM nodes WHERE n > 1 GROUP BY grp, level, idx // 8),
subroots AS (
  SELECT grp, node AS subroot, row_number() OVER (ORDER BY grp) - 1 AS gidx, count(*) OVER () AS n FROM nodes WHERE n = 1),
tops AS (
  SELECT 0 AS level, gidx AS idx, subroot AS node, n FROM subroots
  UNION ALL
  SELECT level + 1, idx // 8, sha256(string_agg(node, '' ORDER BY idx)), (any_value(n) + 7) // 8
  FROM tops WHERE n > 1 GROUP BY level, idx // 8),
met AS (
  SELECT rid, level, s.idx, s.node, p.idx // CAST(8 ** level AS BIGINT) AS own
  FROM placed p JOIN nodes s ON s.grp = p.grp AND s.n > 1 AND s.idx // 8 = p.idx // CAST(8 ** (level + 1) AS BIGINT)
  UNION ALL
  SELECT rid, 1000 + level, s.idx, s.node, g.gidx // CAST(8 ** level AS BIGINT)
  FROM placed p JOIN subroots g USING (grp) JOIN tops s ON s.n > 1 AND s.idx // 8 = g.gidx // CAST(8 ** (level + 1) AS BIGINT)),
steps AS (
  SELECT rid, row_number() OVER (PARTITION BY rid ORDER BY level) - 1 AS k, before, after FROM (
    SELECT rid, level, coalesce(string_agg(node, '' ORDER BY idx) FILTER (idx < own), '') AS before,
           coalesce(string_agg(node, '' ORDER BY idx) FILTER (idx > own), '') AS after FROM met GROUP BY rid, level)),
folded AS (
  SELECT rid, 0 AS k, coalesce(now, leaf) AS node FROM placed
  UNION ALL
  SELECT rid, f.k + 1, sha256(before || node || after) FROM folded f JOIN steps USING (rid, k)),
proofs AS (SELECT rid, sha256(string_agg(before || after, '' ORDER BY k)) AS proof FROM steps GROUP BY rid)
SELECT doc_id, leaf, subroot, t.node AS root, coalesce(proof, sha256('')) AS proof_sha256, f.node AS folded_root, f.node = t.node AS verified
FROM placed JOIN subroots USING (grp) JOIN (SELECT rid, arg_max(node, k) AS node FROM folded GROUP BY rid) f USING (rid)
LEFT JOIN proofs USING (rid) CROSS JOIN (SELECT node FROM tops WHERE n = 1) t""",
    "op13_conversation_repair": rf"""
WITH RECURSIVE given AS (
  SELECT dense_rank() OVER (ORDER BY conv_id NULLS FIRST) AS g, conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         {_crc32_sql("coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')")} % 20 AS kind FROM conversations),
damaged AS (
  SELECT g, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
         CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(CASE WHEN kind = 3 THEN [0, 1] ELSE [0] END) AS copy FROM given WHERE kind <> 0),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY g ORDER BY turn NULLS FIRST, role, text, copy) AS i FROM damaged),
marked AS (
  SELECT *, left(role, 1) AS initial, left(role, 1) || lead(left(role, 1)) OVER (PARTITION BY g ORDER BY i) AS pair,
         CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank'
              WHEN row_number() OVER (PARTITION BY g, role, text ORDER BY i) > 1 THEN 'duplicate'
              WHEN regexp_extract(text, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*$', 1) NOT IN ('.', '!', '?') THEN 'truncated'
              ELSE '' END AS fault FROM ranked),
roles(initial, q, r) AS (VALUES ('s', 0, 1), ('u', 0, 2), ('u', 1, 2), ('u', 3, 2), ('a', 2, 3)),
inserts(q, r, letters, cost) AS (
  SELECT range, range, '', 0 FROM range(4)
  UNION ALL SELECT * FROM (VALUES (0, 2, 'I', 5), (1, 2, 'I', 5), (2, 3, 'I', 5), (3, 2, 'I', 5), (0, 3, 'II', 10), (1, 3, 'II', 10))),
edits AS (
  SELECT g, i, range AS q, range AS r, 'D' AS letter, 2 AS cost FROM marked, range(4)
  UNION ALL
  SELECT g, i, q, r, 'K', CASE fault WHEN 'truncated' THEN 5 ELSE 0 END FROM marked JOIN roles USING (initial) WHERE fault IN ('', 'truncated')
  UNION ALL
  SELECT g, i, q, r, 'R', CASE fault WHEN 'truncated' THEN 6 ELSE 1 END FROM marked, roles e WHERE e.initial <> 's' AND fault IN ('', 'truncated')),
best AS (
  SELECT DISTINCT g, CAST(0 AS BIGINT) AS i, CAST(0 AS BIGINT) AS q, {{'cost': CAST(0 AS BIGINT), 'audit': ''}} AS x FROM marked
  UNION ALL
  SELECT b.g, b.i + 1, CAST(e.r AS BIGINT), min({{'cost': CAST(x.cost + n.cost + e.cost AS BIGINT), 'audit': x.audit || n.letters || e.letter}})
  FROM best b JOIN inserts n ON n.q = b.q JOIN edits e ON e.g = b.g AND e.i = b.i + 1 AND e.q = n.r GROUP BY b.g, b.i, e.r),
chosen AS (
  SELECT g, min({{'cost': CAST(x.cost + n.cost AS BIGINT), 'audit': x.audit || n.letters}}) AS x
  FROM best b JOIN (SELECT g, max(i) AS i FROM marked GROUP BY g) USING (g, i) JOIN inserts n ON n.q = b.q AND n.r IN (0, 3) GROUP BY g),
letters AS (
  SELECT g, k, x.audit[k] AS letter, length(replace(x.audit[1:k], 'I', '')) AS i
  FROM (SELECT g, x, unnest(range(1, length(x.audit) + 1)) AS k FROM chosen)),
lines AS (
  SELECT l.g, k, letter, CASE letter WHEN 'I' THEN '' ELSE text END AS text, role, row_number() OVER (PARTITION BY l.g ORDER BY k) AS p,
         first_value(letter = 'K' AND initial = 's') OVER (PARTITION BY l.g ORDER BY k) AS has_system
  FROM letters l LEFT JOIN marked m ON m.g = l.g AND m.i = l.i WHERE letter <> 'D'),
repaired AS (
  SELECT g, sha256(string_agg(CASE WHEN letter = 'K' THEN role WHEN (p - CAST(has_system AS INT)) % 2 = 1 THEN 'user' ELSE 'assistant' END
                              || ':' || text, chr(10) ORDER BY k)) AS h FROM lines GROUP BY g),
counts AS (
  SELECT g, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
         count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
         count(*) FILTER (pair IS NOT NULL AND pair NOT IN ('su', 'ua', 'au')) AS illegal FROM marked GROUP BY g)
SELECT conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(x.cost, 0) AS cost, coalesce(x.audit, '') AS audit,
       coalesce(h, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT g, conv_id FROM given) LEFT JOIN counts USING (g) LEFT JOIN chosen USING (g) LEFT JOIN repaired USING (g)""",
}
