"""The registered query of each operator: it applies the operator with its
production parameters to the whole of its table and returns the full result.
``ORACLE`` holds the DuckDB SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (byte_bpe, co_training, divergence, language_id, line_dedup, merkle, mixing, near_duplicates, personal_data,
               quality_rules, topk_search, vantage_trees, warc)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def _query(sql: str | None = None):
    def deco(fn):
        QUERIES[fn.__name__] = fn
        if sql:
            ORACLE[fn.__name__] = sql
        return fn
    return deco


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@_query("""
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS e FROM embeddings
           WHERE embedding IS NOT NULL AND NOT list_contains(list_transform(embedding, lambda x: x IS NULL OR NOT isfinite(x)), true)),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e)::BIGINT AS score
      FROM v q JOIN v c ON c.vec_id <> q.vec_id WHERE q.vec_id % 100 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM r WHERE rank <= 10""")
def op1_topk_search(spark, sf_dir):
    return topk_search.top_k(_table(spark, sf_dir, "embeddings"), F.col("id") % 100 == 0, k=10, scale=1024)


@_query(r"""
WITH lines AS (
  SELECT doc_id, i, parts[i] AS line,
         translate(trim(parts[i], chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM (SELECT doc_id, parts, unnest(range(1, len(parts) + 1)) AS i
        FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents))),
common AS (SELECT k, min(doc_id) AS first_doc FROM lines WHERE length(k) >= 10
           GROUP BY k HAVING count(DISTINCT doc_id) >= 2),
marked AS (SELECT l.*, coalesce(l.doc_id <> c.first_doc, false) AS dropped FROM lines l LEFT JOIN common c ON l.k = c.k)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT dropped), '')) AS kept_sha256
FROM marked GROUP BY doc_id""")
def op2_line_dedup(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.dedup_lines(docs, min_docs=2, min_chars=10).select(
        "doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


@_query(r"""
WITH RECURSIVE units AS (
  SELECT doc_id, source, copies,
         copies * greatest(len(regexp_extract_all(t, '[^\x20\x09-\x0D]+')), 1)::BIGINT AS n
  FROM (SELECT doc_id, source, coalesce(text, '') AS t, count(*) AS copies FROM documents GROUP BY ALL)),
src AS (SELECT source, sum(n)::BIGINT AS tokens FROM units GROUP BY source),
shares AS (SELECT source, tokens, tokens::DOUBLE / (SELECT sum(tokens) FROM src)::DOUBLE AS p FROM src),
bisect(i, lo, hi) AS (
  SELECT 0, 0.0::DOUBLE, 1.0::DOUBLE
  UNION ALL
  SELECT i + 1, CASE WHEN r <= 2.0 THEN lo ELSE mid END, CASE WHEN r <= 2.0 THEN mid ELSE hi END
  FROM (SELECT i, lo, hi, (lo + hi) / 2 AS mid,
               (SELECT max(pow(p, (lo + hi) / 2 - 1)) / min(pow(p, (lo + hi) / 2 - 1)) FROM shares) AS r
        FROM bisect WHERE i < 40)),
a AS (SELECT hi AS a FROM bisect WHERE i = 40),
w AS (SELECT source, tokens, greatest(round(pow(p, a) / (SELECT sum(pow(p, a)) FROM shares, a) * 1000000000)::BIGINT, 1) AS w
      FROM shares, a),
b AS (SELECT max(tokens::HUGEINT * 1000000000 // w) + 1 AS budget FROM w),
t AS (SELECT source, tokens, w, (w::HUGEINT * budget // 1000000000)::BIGINT AS target FROM w, b),
laid AS (SELECT u.doc_id, u.source, u.copies, u.n, t.tokens, t.w, t.target, e.epoch,
                md5('17:' || e.epoch || ':' || u.doc_id) AS h
         FROM units u JOIN t ON u.source IS NOT DISTINCT FROM t.source,
              LATERAL (SELECT unnest(range(0, greatest(0, (target - 1) // tokens) + 1)) AS epoch) e),
placed AS (SELECT *, epoch * tokens + coalesce(sum(n) OVER (PARTITION BY source, epoch ORDER BY h, doc_id
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start FROM laid),
blocked AS (SELECT *, (start::HUGEINT * 1000000000 // (w::HUGEINT * 1000000))::BIGINT AS block FROM placed WHERE start < target)
SELECT doc_id, source, copies, n AS n_tokens, epoch::BIGINT AS mix_epoch, block AS mix_block,
       row_number() OVER (PARTITION BY block ORDER BY md5('block:17:' || epoch || ':' || doc_id), epoch, doc_id) AS mix_rank
FROM blocked""")
def op4_source_mixing(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mixing.mixing_plan(docs, max_epochs=2.0, block_tokens=1_000_000, seed=17).select(
        "doc_id", "source", "copies", "n_tokens", "mix_epoch", "mix_block", "mix_rank")


@_query()
def op3_warc_derivatives(spark, sf_dir):
    records = warc.derive(warc.responses(_table(spark, sf_dir, "pages")))
    return records.select("page_id", "kind", "record_id", "refers_to", "target_uri", "source_payload_digest", "block_digest",
                          "content_length", F.sha2(F.col("block").cast("binary"), 256).alias("block_sha256"),
                          F.sha2(warc.record(records).cast("binary"), 256).alias("record_sha256"))


@_query()
def op5_co_training(spark, sf_dir):
    return co_training.co_train(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")).select(
        "doc_id", "text_score", "meta_score", "score", "kept")


@_query()
def op6_byte_bpe(spark, sf_dir):
    import public_tokenizers
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return byte_bpe.byte_bpe(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


@_query()
def op7_language_id(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return language_id.identify(docs).select("doc_id", "held_out", "lang_pred", "score")


@_query()
def op8_near_duplicates(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return near_duplicates.near_duplicates(docs, width=2, share=80)


@_query()
def op9_quality_rules(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality_rules.judge_quality(docs, _table(spark, sf_dir, "labels")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "rule")


@_query()
def op10_personal_data(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = personal_data.find_personal_data(docs)
    counts = [F.expr(f"CAST(size(filter(base, s -> s.kind = '{k}')) AS BIGINT)").alias(f"n_{k}")
              for k in personal_data.KINDS]
    return found.select("doc_id", *counts, F.sha2(personal_data.spelled(F.col("base")).cast("binary"), 256).alias("base_sha256"),
                        personal_data.spelled(F.col("spans")).alias("spans"))


@_query(r"""
WITH d AS (SELECT row_number() OVER () AS rid, coalesce(text, '') AS text, coalesce(lang, '') AS lang, coalesce(source, '') AS source
           FROM documents),
w AS (SELECT rid, lang, source, unnest(regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS n FROM w GROUP BY lang, term HAVING count(DISTINCT rid) >= 30),
voc AS (SELECT lang, count(*) AS v, sum(n)::BIGINT AS total FROM kept GROUP BY lang),
groups AS (SELECT DISTINCT lang, source FROM d),
found AS (SELECT w.lang, w.source, w.term, count(*) AS n FROM w JOIN kept USING (lang, term) GROUP BY ALL),
totals AS (SELECT lang, source, sum(n)::BIGINT AS total FROM found GROUP BY ALL),
shares AS (
  SELECT g.lang, g.source, k.term, coalesce(f.n, 0) AS n,
         (1 + 1000000000::HUGEINT * (coalesce(f.n, 0) + 5) // (coalesce(t.total, 0) + 5 * v.v))::BIGINT AS p,
         (1 + 1000000000::HUGEINT * (k.n + 5) // (v.total + 5 * v.v))::BIGINT AS q
  FROM groups g JOIN kept k USING (lang) JOIN voc v USING (lang)
  LEFT JOIN totals t USING (lang, source) LEFT JOIN found f USING (lang, source, term)),
apart AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p))::BIGINT AS value
          FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
parts AS (
  SELECT g.lang, g.source, 'pair' AS part, h.source AS item, coalesce(a.value, 0) AS value
  FROM groups g JOIN groups h ON g.lang = h.lang AND g.source <> h.source
  LEFT JOIN apart a ON a.lang = g.lang AND a.source = g.source AND a.item = h.source
  UNION ALL SELECT lang, source, 'term', term, p - q FROM shares WHERE n > 0 AND p > q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM parts)
SELECT lang, source, part, item, value, rank::INTEGER AS rank FROM ranked WHERE part = 'pair' OR rank <= 50""")
def op11_source_divergence(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents").select("text", "lang", "source")
    return divergence.audit(docs, min_docs=30, top=50)


@_query(r"""
WITH RECURSIVE d AS (
  SELECT *, list_reduce([4294967295::BIGINT] || list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT),
           lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: xor(x >> 1, (x & 1) * 3988292384))) AS crc
  FROM documents),
written AS (
  SELECT doc_id, coalesce('=' || lang, '') AS g, coalesce(xor(crc, 4294967295) % 3 = 0, false) AS forge,
         coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
         || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS head,
         coalesce(strlen(text) || ':', '-') AS size, coalesce(text, '') AS text
  FROM d),
leaves AS (
  SELECT doc_id, g, sha256(head || size || text) AS leaf,
         CASE WHEN forge THEN sha256(head || size || translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'))
              ELSE sha256(head || size || text) END AS forged
  FROM written),
numbered AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx,
                    count(*) OVER (PARTITION BY g) AS n FROM leaves),
tree(g, level, idx, n, h) AS (
  SELECT g, 0, idx, n, leaf FROM numbered
  UNION ALL
  SELECT g, max(level) + 1, idx // 8, (max(n) + 7) // 8, sha256(string_agg(h, '' ORDER BY idx)) FROM tree WHERE n > 1 GROUP BY g, idx // 8),
subroots AS (SELECT g, h AS subroot, row_number() OVER (ORDER BY g) - 1 AS idx, count(*) OVER () AS n FROM tree WHERE n = 1),
top(level, idx, n, h) AS (
  SELECT 0, idx, n, subroot FROM subroots
  UNION ALL
  SELECT max(level) + 1, idx // 8, (max(n) + 7) // 8, sha256(string_agg(h, '' ORDER BY idx)) FROM top WHERE n > 1 GROUP BY idx // 8),
sides AS (
  SELECT g, level, idx, n, coalesce(string_agg(h, '') OVER (a ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
         coalesce(string_agg(h, '') OVER (a ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r
  FROM tree WINDOW a AS (PARTITION BY g, level, idx // 8 ORDER BY idx)),
top_sides AS (
  SELECT level, idx, n, coalesce(string_agg(h, '') OVER (a ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
         coalesce(string_agg(h, '') OVER (a ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r
  FROM top WINDOW a AS (PARTITION BY level, idx // 8 ORDER BY idx)),
climb(g, leaf_idx, level, idx, proof, cur) AS (
  SELECT g, idx, 0, idx, '', forged FROM numbered
  UNION ALL
  SELECT c.g, c.leaf_idx, c.level + 1, c.idx // 8, c.proof || s.l || s.r, sha256(s.l || c.cur || s.r)
  FROM climb c JOIN sides s ON s.g = c.g AND s.level = c.level AND s.idx = c.idx WHERE s.n > 1),
arrived AS (SELECT c.* FROM climb c JOIN sides s ON s.g = c.g AND s.level = c.level AND s.idx = c.idx WHERE s.n = 1),
rise(g, leaf_idx, level, idx, proof, cur) AS (
  SELECT a.g, a.leaf_idx, 0, s.idx, a.proof, a.cur FROM arrived a JOIN subroots s USING (g)
  UNION ALL
  SELECT c.g, c.leaf_idx, c.level + 1, c.idx // 8, c.proof || s.l || s.r, sha256(s.l || c.cur || s.r)
  FROM rise c JOIN top_sides s ON s.level = c.level AND s.idx = c.idx WHERE s.n > 1),
done AS (SELECT r.* FROM rise r JOIN top_sides s ON s.level = r.level AND s.idx = r.idx WHERE s.n = 1)
SELECT n.doc_id, n.leaf, s.subroot, t.h AS root, sha256(x.proof) AS proof_sha256, x.cur AS folded_root, x.cur = t.h AS verified
FROM numbered n JOIN done x ON x.g = n.g AND x.leaf_idx = n.idx JOIN subroots s ON s.g = n.g, (SELECT h FROM top WHERE n = 1) t""")
def op12_merkle_manifest(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents").select(*merkle.LEAF_COLUMNS)
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    return merkle.manifest(docs, fanout=8, tampered=tampered).drop("above")


@_query()
def op13_nearest_neighbours(spark, sf_dir):
    return vantage_trees.nearest(_table(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0, k=20, recall=0.97)
