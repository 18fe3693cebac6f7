"""Registered queries of the subpackage, one per operator, with their oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from techmine.llm import (circulant_minhash, fill_middle, host_rules, html_wrappers,
                          mixing, pii_surrogates, quotient_dedup, residual_packing, secret_scan, sentencepiece_codec, suffix_dedup, token_store,
                          whitening)
from techmine.llm.common import prepare, stored
from techmine.sources.tables import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE_SQL[name] = sql.strip()
        return fn
    return deco


def _documents(spark: SparkSession, sf_dir: str, *cols: str) -> DataFrame:
    return table(prepare(spark), sf_dir, "documents").select(*cols)


@query("op6_quotient_dedup", """
WITH n AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
           FROM documents),
g AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM n GROUP BY t)
SELECT n.doc_id, g.keep_id, g.group_size, n.doc_id = g.keep_id AS kept, sha256(n.t) AS text_sha256
FROM n JOIN g ON n.t = g.t
""")
def op6_quotient_dedup(spark, sf_dir):
    return quotient_dedup.classes(_documents(spark, sf_dir, "doc_id", "text"))


@query("op8_host_rules", r"""
WITH w AS (
  SELECT doc_id, coalesce(source, '') AS host, coalesce(text, '') AS t,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws,
         list_filter(string_split(coalesce(text, ''), chr(10)),
                     lambda x: regexp_replace(x, '[\x20\x09-\x0D]+', '', 'g') <> '') AS ls
  FROM documents),
tri AS (
  SELECT doc_id, i, [ws[i], ws[i + 1], ws[i + 2]] AS g
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 1)) AS i FROM w WHERE len(ws) >= 3)),
rep AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS c FROM tri) WHERE c > 1),
cov AS (
  SELECT doc_id, sum(least(3, coalesce(nxt - i, 3))) AS n
  FROM (SELECT doc_id, i, lead(i) OVER (PARTITION BY doc_id ORDER BY i) AS nxt FROM rep) GROUP BY doc_id),
f AS (
  SELECT w.doc_id, host, len(ws)::BIGINT AS n_words,
         length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
         (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
         len(ls) AS n_lines, (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines,
         coalesce(cov.n, 0)::BIGINT AS n_repeat_words
  FROM w LEFT JOIN cov ON w.doc_id = cov.doc_id),
r AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
         100 * n_symbols > 20 * n_words AS f1, 100 * n_dup_lines > 30 * n_lines AS f2,
         word_chars < 2 * n_words OR word_chars > 12 * n_words AS f3
  FROM f),
h AS (
  SELECT host, count(*) AS d, sum(f1::INT) AS k1, sum(f2::INT) AS k2, sum(f3::INT) AS k3 FROM r GROUP BY host),
p AS (
  SELECT avg(k1 / d) AS m1, var_pop(k1 / d) AS v1, avg(k2 / d) AS m2, var_pop(k2 / d) AS v2,
         avg(k3 / d) AS m3, var_pop(k3 / d) AS v3 FROM h),
s AS (
  SELECT m1, m2, m3,
         CASE WHEN v1 > 0 THEN greatest(1.0, least(1e6, m1 * (1 - m1) / v1 - 1)) ELSE 1e6 END AS s1,
         CASE WHEN v2 > 0 THEN greatest(1.0, least(1e6, m2 * (1 - m2) / v2 - 1)) ELSE 1e6 END AS s2,
         CASE WHEN v3 > 0 THEN greatest(1.0, least(1e6, m3 * (1 - m3) / v3 - 1)) ELSE 1e6 END AS s3 FROM p),
q AS (
  SELECT host, (k1 + m1 * s1) / (d + s1) > m1 + 2 * sqrt(m1 * (1 - m1) / (s1 + 1)) AS b1,
         (k2 + m2 * s2) / (d + s2) > m2 + 2 * sqrt(m2 * (1 - m2) / (s2 + 1)) AS b2,
         (k3 + m3 * s3) / (d + s3) > m3 + 2 * sqrt(m3 * (1 - m3) / (s3 + 1)) AS b3 FROM h, s)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT ((f1 AND b1) OR (f2 AND b2) OR (f3 AND b3)) AS kept
FROM r JOIN q ON r.host = q.host
""")
def op8_host_rules(spark, sf_dir):
    docs = _documents(spark, sf_dir, "doc_id", "text", "source")
    out = host_rules.with_quality(docs, carry=["doc_id"])
    figures = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    return out.select("doc_id", *[F.col(f"__llm_{c}").alias(c) for c in figures])


@query("op5_circulant_minhash", r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws
  FROM documents),
s AS (
  SELECT DISTINCT doc_id, g FROM (
    SELECT doc_id, unnest(CASE WHEN len(ws) < 2 THEN [ws]
                               ELSE list_transform(range(1, len(ws)), lambda i: [ws[i], ws[i + 1]]) END) AS g
    FROM w WHERE len(ws) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
c AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k FROM s x JOIN s y ON x.g = y.g AND x.doc_id <> y.doc_id
      GROUP BY ALL),
e AS MATERIALIZED (
  SELECT a, b FROM c JOIN n x ON a = x.doc_id JOIN n y ON b = y.doc_id WHERE 100 * k >= 80 * (x.n + y.n - k)),
r(node, seen) AS (SELECT doc_id, doc_id FROM n UNION SELECT r.node, e.b FROM r JOIN e ON r.seen = e.a),
m AS (SELECT node, min(seen) AS component_id FROM r GROUP BY node)
SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(m.component_id, w.doc_id) AS component_id,
       coalesce(m.component_id, w.doc_id) = w.doc_id AS kept
FROM w LEFT JOIN n ON w.doc_id = n.doc_id LEFT JOIN m ON w.doc_id = m.node
""")
def op5_circulant_minhash(spark, sf_dir):
    return circulant_minhash.near_classes(_documents(spark, sf_dir, "doc_id", "text"), width=2)


# Start, kind and end of every match of one expression, from the pieces between matches.
_SPANS_SQL = r"""
  SELECT doc_id, '{kind}' AS kind, {rank} AS rank, m[i] AS hit, regexp_extract(m[i], '{expr}', 2) AS val,
         list_sum(list_transform(p[:i], lambda x: length(x))) +
         coalesce(list_sum(list_transform(m[:i - 1], lambda x: length(x))), 0) AS pos
  FROM (SELECT doc_id, m, p, unnest(range(1, len(m) + 1)) AS i
        FROM (SELECT doc_id, regexp_extract_all(t, '{expr}') AS m, regexp_split_to_array(t, '{expr}') AS p FROM d))
"""
_ASSIGN_SQL = r"""((?i:password|passwd|secret|token|api_?key))["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)"""


@query("op7_secret_scan", f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
a AS ({_SPANS_SQL.format(kind="assign", rank=0, expr=_ASSIGN_SQL)}),
b AS ({_SPANS_SQL.format(kind="access", rank=1, expr="(AKIA)([A-Z0-9]+)")}),
c AS ({_SPANS_SQL.format(kind="hex", rank=2, expr="()([0-9a-f]+)")}),
k AS (SELECT * FROM a WHERE length(val) >= 12 UNION ALL SELECT * FROM b WHERE length(hit) >= 18
      UNION ALL SELECT * FROM c WHERE length(hit) >= 16),
g AS (SELECT doc_id, sum((kind = 'assign')::INT)::BIGINT AS n_assign, sum((kind = 'access')::INT)::BIGINT AS n_access,
             sum((kind = 'hex')::INT)::BIGINT AS n_hex,
             string_agg(kind || ':' || pos::BIGINT || ':' || (pos + length(hit))::BIGINT, ',' ORDER BY pos, rank) AS spans
      FROM k GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(spans, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN g ON d.doc_id = g.doc_id
""")
def op7_secret_scan(spark, sf_dir):
    found = secret_scan.scan(_documents(spark, sf_dir, "doc_id", "text"))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id", *[count(k).alias(f"n_{k}") for k in secret_scan.BASE_KINDS],
        F.sha2(secret_scan.span_text("spans", secret_scan.BASE_KINDS), 256).alias("base_sha256"),
        secret_scan.span_text("spans").alias("spans"))


@query("op10_residual_packing")
def op10_residual_packing(spark, sf_dir):
    return residual_packing.pack_documents(_documents(spark, sf_dir, "doc_id", "text"),
                                           public_tokenizers.path("word_bpe_49k.json"))


@query("op3_token_store")
def op3_token_store(spark, sf_dir):
    docs = _documents(spark, sf_dir, "doc_id", "text")
    store = token_store.write_store(docs, public_tokenizers.path("word_bpe_49k.json"))
    places = stored(token_store.look_up(store, token_store.keys_of(docs)), "places")
    read = token_store.read_payload(store, places)
    return read.select(F.col("id").alias("doc_id"), "start", "n_tokens", "ids_crc32")


@query("op9_sentencepiece")
def op9_sentencepiece(spark, sf_dir):
    return sentencepiece_codec.encoded(_documents(spark, sf_dir, "doc_id", "text"),
                                       public_tokenizers.path("piece_bpe_32k.model"), with_ids=False)


@query("op1_html_wrappers")
def op1_html_wrappers(spark, sf_dir):
    pages = table(prepare(spark), sf_dir, "pages").select("page_id", "url", "html")
    out = html_wrappers.extracted(pages).withColumnRenamed("__llm_text", "text")
    return out.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))


# Key of the registered query; a real run passes its own.
PII_KEY = "registered query"


@query("op2_pii_surrogates")
def op2_pii_surrogates(spark, sf_dir):
    out = pii_surrogates.surrogated(_documents(spark, sf_dir, "doc_id", "text"), PII_KEY)
    return out.select("doc_id", "text", F.size("__llm_types").cast("long").alias("n_entities"),
                      F.array_join("__llm_types", ",").alias("types"))


@query("op4_suffix_dedup")
def op4_suffix_dedup(spark, sf_dir):
    out = suffix_dedup.repeated_strings(_documents(spark, sf_dir, "doc_id", "text"), length=100)
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


@query("op13_fill_middle", """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
u AS (
  SELECT doc_id, t, length(t)::BIGINT AS n, ('0x' || substr(h, 1, 8))::BIGINT AS h1,
         ('0x' || substr(h, 9, 8))::BIGINT AS h2, ('0x' || substr(h, 17, 8))::BIGINT AS h3,
         ('0x' || substr(h, 25, 8))::BIGINT AS h4 FROM d),
f AS (
  SELECT *, CASE WHEN n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90
                 THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form,
         least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b FROM u),
p AS (SELECT *, substr(t, 1, a) AS pre, substr(t, a + 1, b - a) AS mid, substr(t, b + 1) AS suf FROM f)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
              ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM p
""")
def op13_fill_middle(spark, sf_dir):
    out = fill_middle.transformed(_documents(spark, sf_dir, "doc_id", "text"), with_output=False)
    return out.select("doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256")


@query("op12_source_mix")
def op12_source_mix(spark, sf_dir):
    plan = mixing.planned(_documents(spark, sf_dir, "doc_id", "text", "source"))
    return plan.select("doc_id", "size", "source_size", "target", mixing.taken().alias("taken"))


@query("op11_whitening")
def op11_whitening(spark, sf_dir):
    vectors = table(prepare(spark), sf_dir, "embeddings").select("vec_id", "embedding")
    return whitening.whitened(vectors)
