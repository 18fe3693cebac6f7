"""Graph queries: triples families (GR1-GR5), QRY1/QRY2 through ``match``
(GR6), N-Triples round trip (SNK6 + SRC7) and Turtle blocks (SNK5)."""

from __future__ import annotations

from pyspark.sql import functions as F

from techmine.operators import graph as G
from techmine.operators.hierarchy import build_hierarchy, ensure_base_topics
from techmine.plans import standins as S
from techmine.plans.registry import query
from techmine.session import shared_dir
from techmine.sinks.rdf import turtle_blocks, write_ntriples
from techmine.sources.rdf import read_ntriples

OA = G.OPENALEX


def _v(col: str) -> str:
    return f"CAST({col} AS VARCHAR)"


# --- SQL pieces shared by the oracle statements -----------------------------

WORK_SQL = f"""
SELECT o_orderkey AS id, '10.5555/' || {_v('o_orderkey')} AS doi,
       'https://example.org/pdf/' || {_v('o_orderkey')} || '.pdf' AS source_url,
       o_orderpriority AS title, CAST(NULL AS VARCHAR) AS abstract,
       strftime(o_orderdate, '%Y-%m-%d') AS published, o_orderstatus AS language,
       CAST(floor(o_totalprice / 1000) AS BIGINT) AS citations, o_totalprice AS fwci,
       c_nationkey AS topic_id
FROM orders LEFT JOIN customer ON o_custkey = c_custkey
"""


def _lit_row(s, p, o, kind="literal", dt=None):
    dts = f"'{dt}'" if dt else "CAST(NULL AS VARCHAR)"
    return f"SELECT {s} AS s, '{p}' AS p, CAST({o} AS VARCHAR) AS o, '{kind}' AS o_kind, {dts} AS datatype"


def _t(kind, col):
    return f"'{OA}{kind}_' || {_v(col)}"


TOPIC_TRIPLES_SQL = f"""
{_lit_row(_t('tematica', 'n_nationkey'), G.RDF_TYPE, f"'{G.SKOS_CONCEPT}'", 'iri')} FROM nation
UNION ALL {_lit_row(_t('tematica', 'n_nationkey'), G.SKOS_PREF_LABEL, 'n_name')} FROM nation
  WHERE n_name IS NOT NULL AND n_name <> ''
"""

TECH_TRIPLES_SQL = f"""
{_lit_row(_t('tecnologia', 'p_partkey'), G.RDF_TYPE, f"'{G.SOFTWARE_APPLICATION}'", 'iri')} FROM part
UNION ALL {_lit_row(_t('tecnologia', 'p_partkey'), G.SCHEMA + 'name', 'p_name')} FROM part
  WHERE p_name IS NOT NULL AND p_name <> ''
UNION ALL {_lit_row(_t('tecnologia', 'p_partkey'), G.SCHEMA + 'applicationCategory', 'p_type')} FROM part
  WHERE p_type IS NOT NULL AND p_type <> ''
"""

S_ = G.SCHEMA
WORK_TRIPLES_SQL = f"""
{_lit_row(_t('obra', 'id'), G.RDF_TYPE, f"'{G.SCHOLARLY_ARTICLE}'", 'iri')} FROM w
UNION ALL {_lit_row(_t('obra', 'id'), S_ + 'identifier', 'doi')} FROM w WHERE doi IS NOT NULL AND doi <> ''
UNION ALL {_lit_row(_t('obra', 'id'), S_ + 'url', 'source_url')} FROM w WHERE source_url IS NOT NULL AND source_url <> ''
UNION ALL {_lit_row(_t('obra', 'id'), S_ + 'name', 'title')} FROM w WHERE title IS NOT NULL AND title <> ''
UNION ALL {_lit_row(_t('obra', 'id'), S_ + 'abstract', 'abstract')} FROM w WHERE abstract IS NOT NULL AND abstract <> ''
UNION ALL {_lit_row(_t('obra', 'id'), S_ + 'datePublished', 'published', 'literal', G.XSD_DATE)} FROM w
  WHERE published IS NOT NULL AND published <> ''
UNION ALL {_lit_row(_t('obra', 'id'), S_ + 'inLanguage', 'language')} FROM w WHERE language IS NOT NULL AND language <> ''
UNION ALL {_lit_row(_t('obra', 'id'), S_ + 'citationCount', 'citations', 'literal', G.XSD_INTEGER)} FROM w
  WHERE citations IS NOT NULL
UNION ALL {_lit_row(_t('obra', 'id'), S_ + 'metric', 'fwci', 'literal', G.XSD_FLOAT)} FROM w WHERE fwci IS NOT NULL
UNION ALL {_lit_row(_t('obra', 'id'), S_ + 'about', _t('tematica', 'topic_id'), 'iri')} FROM w
  WHERE topic_id IS NOT NULL AND topic_id <> 0
"""

MENTION_TRIPLES_SQL = f"""
{_lit_row(_t('obra', 'l_orderkey'), S_ + 'mentions', _t('tecnologia', 'l_partkey'), 'iri')} FROM lineitem
  WHERE l_orderkey <> 0 AND l_partkey <> 0
"""

HI1_EDGES_SQL = """
WITH m AS (SELECT CAST(max(n_nationkey) AS BIGINT) AS m FROM nation),
e AS (SELECT m + 1 AS parent_id, m + 2 AS child_id FROM m
      UNION SELECT m + 2, m + 3 FROM m
      UNION SELECT m.m + 3, CAST(n_nationkey AS BIGINT) FROM nation CROSS JOIN m)
SELECT CAST(row_number() OVER (ORDER BY parent_id, child_id) AS BIGINT) AS id, parent_id, child_id FROM e
"""

EDGE_TRIPLES_SQL = f"""
WITH e AS ({HI1_EDGES_SQL})
SELECT DISTINCT * FROM (
{_lit_row(_t('tematica', 'parent_id'), G.SKOS_NARROWER, _t('tematica', 'child_id'), 'iri')} FROM e
  WHERE parent_id <> 0 AND child_id <> 0
UNION ALL {_lit_row(_t('tematica', 'child_id'), G.SKOS_BROADER, _t('tematica', 'parent_id'), 'iri')} FROM e
  WHERE parent_id <> 0 AND child_id <> 0)
"""

ENTITY_TRIPLES_SQL = f"""
WITH w AS ({WORK_SQL})
SELECT DISTINCT * FROM ({TOPIC_TRIPLES_SQL} UNION ALL {TECH_TRIPLES_SQL} UNION ALL {WORK_TRIPLES_SQL})
"""


def _topics_with_base(spark, base):
    return ensure_base_topics(S.topic(spark, base))


def _edges(spark, base):
    return build_hierarchy(_topics_with_base(spark, base))


@query("entity_triples", ENTITY_TRIPLES_SQL)
def entity_triples(spark, base):
    return G.graph(topic=S.topic(spark, base), technology=S.technology(spark, base, "p_name"),
                   work=S.work(spark, base))


@query("triple_dedupe", f"SELECT DISTINCT * FROM ({MENTION_TRIPLES_SQL})")
def triple_dedupe(spark, base):
    return G.graph(mention=S.mention(spark, base))


@query("inverse_edges", EDGE_TRIPLES_SQL)
def inverse_edges(spark, base):
    return G.graph(edge=_edges(spark, base))


def _stored_graph(spark, base, tech_name: str):
    """Export the whole graph once (partitioned by predicate) and read it back,
    as a graph store would hold it; pattern scans then prune by ``p``."""
    path = shared_dir(spark, "graph")
    G.write_triples(_whole_graph(spark, base, tech_name), path)
    return G.read_triples(spark, path)


def topic_tech_counts_from_graph(triples):
    """QRY1 as the graph query: BGP + OPTIONAL labels + FILTER(BOUND) + COUNT DISTINCT."""
    b = G.match(triples,
                [("?work", S_ + "about", "?topic"), ("?work", S_ + "mentions", "?technology")],
                optional=[[("?topic", G.SKOS_PREF_LABEL, "?topicName")],
                          [("?technology", S_ + "name", "?techName")]],
                filters=[G.bound("topicName", "techName")])
    return (b.groupBy(F.col("topicName").alias("topic_name"), F.col("techName").alias("tech_name"))
             .agg(F.countDistinct("work").alias("shared_works")))


def tech_pairs_from_graph(triples, top=None):
    """QRY2 as the graph query, reduced to (topic, name, n, i) before the self-join."""
    from techmine.plans.reports import shared_group_pairs
    b = G.match(triples, [("?work", S_ + "mentions", "?tech"), ("?work", S_ + "about", "?topic"),
                          ("?tech", S_ + "name", "?name")])
    return shared_group_pairs(b, "topic", "tech", "name", top=top)


TRUTHY_QRY1_SQL = """
SELECT n_name AS topic_name, p_brand AS tech_name, count(DISTINCT o_orderkey) AS shared_works
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
JOIN customer ON o_custkey = c_custkey
JOIN nation ON c_nationkey = n_nationkey
JOIN part ON l_partkey = p_partkey
WHERE n_name <> '' AND p_brand <> '' AND o_orderkey <> 0 AND l_partkey <> 0 AND c_nationkey <> 0
GROUP BY n_name, p_brand
"""


@query("topic_tech_counts_triples", TRUTHY_QRY1_SQL)
def topic_tech_counts_triples(spark, base):
    return topic_tech_counts_from_graph(_stored_graph(spark, base, "p_brand"))


TRUTHY_QRY2_SQL = """
WITH m AS (SELECT DISTINCT c_nationkey AS topic, l_partkey AS iri, p_name AS nm
           FROM lineitem JOIN orders ON l_orderkey = o_orderkey
           JOIN customer ON o_custkey = c_custkey
           JOIN part ON l_partkey = p_partkey
           WHERE p_name <> '' AND o_orderkey <> 0 AND l_partkey <> 0 AND c_nationkey <> 0),
     g AS (SELECT topic, nm, count(DISTINCT iri) AS n, min(iri) AS i FROM m GROUP BY topic, nm)
SELECT a.nm AS tech_a, b.nm AS tech_b, count(*) AS common_topics
FROM g a JOIN g b ON a.topic = b.topic AND NOT (a.n = 1 AND b.n = 1 AND a.i = b.i)
GROUP BY a.nm, b.nm
"""


@query("tech_pairs_shared_topics_triples", TRUTHY_QRY2_SQL)
def tech_pairs_shared_topics_triples(spark, base):
    return tech_pairs_from_graph(_stored_graph(spark, base, "p_name"))


WHOLE_GRAPH_SQL = f"""
WITH w AS ({WORK_SQL})
SELECT DISTINCT * FROM ({TOPIC_TRIPLES_SQL} UNION ALL {TECH_TRIPLES_SQL} UNION ALL {WORK_TRIPLES_SQL}
  UNION ALL {MENTION_TRIPLES_SQL} UNION ALL SELECT * FROM ({EDGE_TRIPLES_SQL}))
"""


def _whole_graph(spark, base, tech_name: str = "p_name"):
    """All five families."""
    return G.graph(topic=S.topic(spark, base), edge=_edges(spark, base),
                   technology=S.technology(spark, base, tech_name), work=S.work(spark, base),
                   mention=S.mention(spark, base))


@query("ntriples_roundtrip", WHOLE_GRAPH_SQL)
def ntriples_roundtrip(spark, base):
    g = _whole_graph(spark, base)
    path = shared_dir(spark, "ntriples")
    write_ntriples(g, path, compression="gzip")  # lines repeat their prefixes
    return read_ntriples(spark, path)


def _short_sql(x: str) -> str:
    cases = " ".join(
        f"WHEN starts_with({x}, '{ns}') AND regexp_matches(substr({x}, {len(ns) + 1}), "
        f"'^[A-Za-z_][A-Za-z0-9_-]*\\z') THEN '{p}:' || substr({x}, {len(ns) + 1})"
        for p, ns in G.PREFIXES.items())
    return f"(CASE {cases} ELSE '<' || {x} || '>' END)"


def _esc_sql(x: str) -> str:
    out = f"replace({x}, '\\', '\\\\')"
    for raw, esc in (("'\"'", "'\\\"'"), ("chr(10)", "'\\n'"), ("chr(13)", "'\\r'"), ("chr(9)", "'\\t'")):
        out = f"replace({out}, {raw}, {esc})"
    return out


TURTLE_SQL = f"""
WITH t AS ({WHOLE_GRAPH_SQL}),
po AS (SELECT s, p, o,
         (CASE WHEN p = '{G.RDF_TYPE}' THEN 'a' ELSE {_short_sql('p')} END) || ' ' ||
         (CASE WHEN o_kind = 'iri' THEN {_short_sql('o')}
               ELSE '"' || {_esc_sql('o')} || '"' ||
                    (CASE WHEN datatype IS NOT NULL THEN '^^' || {_short_sql('datatype')} ELSE '' END)
          END) AS x
       FROM t)
SELECT s, {_short_sql('s')} || ' ' || string_agg(x, ' ;' || chr(10) || '    ' ORDER BY p, o) || ' .' AS block
FROM po GROUP BY s
"""


@query("turtle_blocks", TURTLE_SQL)
def turtle_blocks_query(spark, base):
    return turtle_blocks(_whole_graph(spark, base))


@query("patterns_in_any_order", """
SELECT n_name AS name, count(*) AS n_mentions
FROM (SELECT DISTINCT l_orderkey, l_partkey FROM lineitem WHERE l_orderkey <> 0 AND l_partkey <> 0)
JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
JOIN nation ON c_nationkey = n_nationkey
WHERE n_nationkey <> 0 GROUP BY n_name
""")
def patterns_in_any_order(spark, base):
    """GR6: three patterns of which the first two share no variable, over a graph
    where a literal has the text of every topic's IRI; it must not join as one."""
    g = G.graph(topic=S.topic(spark, base), work=S.work(spark, base), mention=S.mention(spark, base))
    fake = S.topic(spark, base).select(G.iri("fake", "id").alias("s"), F.lit(S_ + "about").alias("p"),
                                       G.iri(G.KIND_TOPIC, "id").alias("o"), F.lit("literal").alias("o_kind"),
                                       F.lit(None).cast("string").alias("datatype"))
    said = fake.select("s", F.lit(S_ + "mentions").alias("p"), F.lit(G.OPENALEX + "tecnologia_1").alias("o"),
                       F.lit("iri").alias("o_kind"), "datatype")
    path = shared_dir(spark, "graph-with-literals")
    G.write_triples(g.unionByName(fake).unionByName(said), path)
    got = G.match(G.read_triples(spark, path), [("?t", G.SKOS_PREF_LABEL, "?name"), ("?w", S_ + "mentions", "?tech"),
                                                ("?w", S_ + "about", "?t")])
    return got.groupBy("name").agg(F.count(F.lit(1)).alias("n_mentions"))


@query("notebook_profile_counts", """
WITH w AS (SELECT o_orderkey AS id, o_orderpriority AS title, o_orderstatus AS lang, o_orderdate AS d,
                  floor(o_totalprice / 1000) AS cites, o_totalprice AS fwci, c_nationkey AS t
           FROM orders LEFT JOIN customer ON o_custkey = c_custkey)
SELECT p, n FROM (
  SELECT 'type' AS p, count(*) AS n FROM w UNION ALL SELECT 'sameAs', count(*) FROM w UNION ALL SELECT 'url', count(*) FROM w
  UNION ALL SELECT 'name', count(*) FROM w WHERE title <> '' UNION ALL SELECT 'inLanguage', count(*) FROM w WHERE lang <> ''
  UNION ALL SELECT 'datePublished', count(*) FROM w WHERE d IS NOT NULL
  UNION ALL SELECT 'citationCount', count(*) FROM w WHERE cites <> 0 UNION ALL SELECT 'metric', count(*) FROM w WHERE fwci <> 0
  UNION ALL SELECT 'about', count(*) FROM w WHERE t <> 0) WHERE n > 0
""")
def notebook_profile_counts(spark, base):
    """GR4, notebook profile: triples per predicate of the works."""
    t = G.work_triples(S.work(spark, base), profile="notebook")
    return t.groupBy(F.regexp_extract("p", r"([^/#]*)$", 1).alias("p")).agg(F.count(F.lit(1)).alias("n"))


@query("turtle_triples_per_subject", """
WITH w AS (SELECT o_orderkey AS id, o_orderpriority AS title, o_orderstatus AS lang, o_orderdate AS d, o_totalprice AS f,
                  c_nationkey AS t FROM orders LEFT JOIN customer ON o_custkey = c_custkey),
m AS (SELECT l_orderkey AS id, count(DISTINCT l_partkey) AS n FROM lineitem WHERE l_orderkey <> 0 AND l_partkey <> 0 GROUP BY 1)
SELECT 'openalex:obra_' || coalesce(w.id, m.id) AS subject,
       (CASE WHEN w.id IS NULL THEN 0 ELSE 5 + (title <> '')::INT + (lang <> '')::INT + (d IS NOT NULL)::INT
             + (coalesce(t, 0) <> 0)::INT - (f IS NULL)::INT END + coalesce(m.n, 0))::BIGINT AS n_triples
FROM w FULL JOIN m ON w.id = m.id
""")
def turtle_triples_per_subject(spark, base):
    """SNK5 over works and mentions: the triples that the Turtle blocks of each
    subject state, counted in the written blocks."""
    g = G.graph(work=S.work(spark, base), mention=S.mention(spark, base))
    blocks = turtle_blocks(g, block_triples=4)  # most works take several blocks
    lines = F.size(F.split("block", " ;\n"))
    return blocks.groupBy(F.substring_index("block", " ", 1).alias("subject")).agg(
        F.sum(lines).cast("long").alias("n_triples"))
