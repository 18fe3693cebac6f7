"""Name curation queries (CAN1-CAN3) and the load from response pages to the
graph (SRC1, SNK4, GR1-GR5 end to end).  part stands for technologies, lineitem
for mentions; variants of brand names are spelled differently by container."""

from __future__ import annotations

from pyspark.sql import functions as F

from techmine.operators import aliases as AL
from techmine.operators import variants as VA
from techmine.plans.registry import query
from techmine.sources.tables import table


def _variants(spark, base):
    """Brand names as technologies: the size parity decides the spelling."""
    p = table(spark, base, "part").select("p_partkey", "p_brand", "p_size")
    name = F.when(F.col("p_size") % 3 == 0, F.upper("p_brand")).when(
        F.col("p_size") % 3 == 1, F.replace("p_brand", F.lit("#"), F.lit("-# "))).otherwise(F.col("p_brand"))
    return p.select(F.col("p_partkey").alias("id"), name.alias("name"))


VARIANTS_SQL = """
v AS (SELECT p_partkey AS id, CASE WHEN p_size % 3 = 0 THEN upper(p_brand)
             WHEN p_size % 3 = 1 THEN replace(p_brand, '#', '-# ') ELSE p_brand END AS name FROM part),
u AS (SELECT name, count(*) AS n FROM lineitem JOIN v ON l_partkey = id GROUP BY name),
d AS (SELECT DISTINCT v.name, trim(regexp_replace(lower(v.name), '[\\s._\\-]+', ' ', 'g')) AS form, coalesce(u.n, 0) AS n
      FROM v LEFT JOIN u ON v.name = u.name),
a AS (SELECT name AS variant, first_value(name) OVER (PARTITION BY form ORDER BY n DESC, name) AS canonical, form FROM d)
"""


def _uses(spark, base, names):
    li = table(spark, base, "lineitem").select(F.col("l_partkey").alias("id"))
    return li.join(names, "id").groupBy("name").agg(F.count(F.lit(1)).alias("n_uses"))


@query("name_aliases", f"WITH {VARIANTS_SQL} SELECT variant, canonical, form FROM a WHERE variant <> canonical")
def name_aliases(spark, base):
    v = _variants(spark, base)
    return AL.propose_aliases(v, _uses(spark, base, v))


@query("canonical_names", f"""
WITH {VARIANTS_SQL} SELECT v.id, coalesce(a.canonical, v.name) AS name FROM v LEFT JOIN a ON v.name = a.variant
""")
def canonical_names(spark, base):
    v = _variants(spark, base)
    return AL.apply_aliases(v, AL.propose_aliases(v, _uses(spark, base, v)))


@query("derived_links", """
SELECT DISTINCT l_orderkey AS work_id, l_partkey - l_partkey % 4 AS technology_id FROM lineitem
""")
def derived_links(spark, base):
    """Part k derives from part k - 1 unless k is divisible by 4 (chains of up to
    three steps)."""
    p = table(spark, base, "part").select(F.col("p_partkey").alias("id"), F.col("p_name").alias("name"))
    derived = p.where("id % 4 <> 0").select(
        F.col("id").alias("derived_id"), (F.col("id") - 1).alias("base_id"))
    li = table(spark, base, "lineitem").select(F.col("l_orderkey").alias("work_id"), F.col("l_partkey").alias("technology_id"))
    return AL.replace_derived(p, li, derived)[1]


@query("kept_technologies", "SELECT p_partkey AS id, p_name AS name FROM part WHERE p_partkey % 4 = 0")
def kept_technologies(spark, base):
    p = table(spark, base, "part").select(F.col("p_partkey").alias("id"), F.col("p_name").alias("name"))
    derived = p.where("id % 4 <> 0").select(
        F.col("id").alias("derived_id"), (F.col("id") - 1).alias("base_id"))
    li = table(spark, base, "lineitem").select(F.col("l_orderkey").alias("work_id"), F.col("l_partkey").alias("technology_id"))
    return AL.replace_derived(p, li, derived)[0]


@query("listed_technologies", f"""
WITH {VARIANTS_SQL} SELECT id, name, regexp_matches(name, '# ?1') AS listed FROM v
""")
def listed_technologies(spark, base):
    """Technologies split by the list of all brands of the ten and teens."""
    v = _variants(spark, base)
    brands = table(spark, base, "part").where(F.col("p_brand").rlike("#1")).select(F.col("p_brand").alias("name"))
    spelled = brands.select("name").unionByName(brands.select(F.replace("name", F.lit("#"), F.lit("-# ")).alias("name")))
    yes, no = AL.split_by_list(v, spelled.distinct())
    return yes.withColumn("listed", F.lit(True)).unionByName(no.withColumn("listed", F.lit(False)))


# Part names as written in texts: with other spaces, a letter doubled or dropped, or a word in front.
_SPELLED = """
p AS (SELECT DISTINCT p_name AS b FROM part),
s AS (SELECT b AS name FROM p UNION SELECT replace(b, ' ', '') FROM p UNION SELECT replace(b, ' ', '-') FROM p
      UNION SELECT b || substr(b, length(b), 1) FROM p UNION SELECT substr(b, 1, 3) || substr(b, 5) FROM p
      UNION SELECT 'Featherweight ' || b FROM p UNION SELECT split_part(b, ' ', 2) FROM p),
f AS (SELECT name, trim(regexp_replace(lower(name), '[\\s._\\-]+', ' ', 'g')) AS form FROM s)
"""


def _spelled(spark, base):
    b = F.col("b")
    p = table(spark, base, "part").select(F.col("p_name").alias("b")).distinct()
    forms = F.array(b, F.replace(b, F.lit(" "), F.lit("")), F.replace(b, F.lit(" "), F.lit("-")),
                    F.concat(b, F.substring(b, F.char_length(b), F.lit(1))),
                    F.concat(F.substring(b, 1, 3), F.substring(b, F.lit(5), F.char_length(b))),
                    F.concat(F.lit("Featherweight "), b), F.split_part(b, F.lit(" "), F.lit(2)))
    return p.select(F.explode(forms).alias("name")).distinct()


@query("spelling_variants", f"""
WITH {_SPELLED}, l AS (SELECT name, replace(form, ' ', '') AS w FROM f),
x AS (SELECT name, w, CASE WHEN length(w) >= 9 THEN 2 WHEN length(w) >= 5 THEN 1 ELSE 0 END AS t FROM l WHERE w <> '')
SELECT a.name AS "left", b.name AS "right", levenshtein(a.w, b.w)::INT AS edits
FROM x a JOIN x b ON a.name < b.name AND abs(length(a.w) - length(b.w)) <= 2
WHERE levenshtein(a.w, b.w) <= least(a.t, b.t)
""")
def spelling_variants(spark, base):
    """CAN1: names that are the same but for spaces or a few letters."""
    return VA.spelling_variants(_spelled(spark, base))


@query("derived_names", f"""
WITH {_SPELLED}, g AS (SELECT form, min(name) AS base FROM f WHERE form <> '' GROUP BY form),
h AS (SELECT f.name AS derived, g.base, g.form,
             row_number() OVER (PARTITION BY f.name ORDER BY len(string_split(g.form, ' ')) DESC, length(g.form) DESC, g.form) AS r
      FROM f JOIN g ON f.form <> g.form AND contains(' ' || f.form || ' ', ' ' || g.form || ' '))
SELECT derived, base FROM h WHERE r = 1
""")
def derived_names(spark, base):
    """CAN2: names that hold another name as whole words."""
    return VA.derived_names(_spelled(spark, base))


@query("derived_links_by_name", """
WITH n AS (SELECT p_partkey AS id, CASE WHEN p_partkey % 2 = 0 THEN p_name ELSE split_part(p_name, ' ', 2) END AS name FROM part),
b AS (SELECT name, min(id) AS id FROM n GROUP BY name),
d AS (SELECT n.id, coalesce(b.id, n.id) AS to_id FROM n LEFT JOIN b ON contains(n.name, ' ') AND split_part(n.name, ' ', 2) = b.name)
SELECT DISTINCT l_orderkey AS work_id, d.to_id AS technology_id FROM lineitem JOIN d ON l_partkey = d.id
""")
def derived_links_by_name(spark, base):
    """CAN2 end to end: derived technologies found by name, links moved to their
    base.  Every second part is known by the last word of its name."""
    name = F.when(F.col("p_partkey") % 2 == 0, F.col("p_name")).otherwise(F.split_part("p_name", F.lit(" "), F.lit(2)))
    t = table(spark, base, "part").select(F.col("p_partkey").alias("id"), name.alias("name"))
    li = table(spark, base, "lineitem").select(F.col("l_orderkey").alias("work_id"), F.col("l_partkey").alias("technology_id"))
    return AL.replace_derived(t, li, VA.derived_ids(t))[1]


@query("json_load_graph_counts", """
WITH f AS (SELECT doc_id, text, source, lang FROM documents
           WHERE source NOT IN ('src0', 'src1', 'src2', 'src3') AND lang = 'en'),
t AS (SELECT DISTINCT 'Topic ' || source AS name FROM f),
n AS (SELECT count(*) AS works, count(*) FILTER (doc_id % 3 <> 0) AS dois,
             count(*) FILTER (len(list_filter(regexp_split_to_array(text, '[\\s]+'), lambda x: x <> '')) > 0) AS abstracts
      FROM f),
c AS (
  SELECT 'about' AS p, works AS n FROM n UNION ALL SELECT 'abstract', abstracts FROM n
  UNION ALL SELECT 'citationCount', works FROM n UNION ALL SELECT 'identifier', dois FROM n
  UNION ALL SELECT 'inLanguage', works FROM n UNION ALL SELECT 'metric', works FROM n
  UNION ALL SELECT 'name', works FROM n UNION ALL SELECT 'url', works FROM n
  UNION ALL SELECT 'prefLabel', count(*) FROM t
  UNION ALL SELECT 'type', works + (SELECT count(*) FROM t) FROM n)
SELECT p, n FROM c WHERE n > 0
""")
def json_load_graph_counts(spark, base):
    """Response pages with missing dois -> works and topics -> checked load of
    the stored tables -> triples per predicate."""
    from techmine.operators import graph as G
    from techmine.plans.q_sources import DOCUMENT_ORDER, _documents_with_texts, _records_from_documents
    from techmine.session import shared_dir
    from techmine.sinks.tables import MODEL_SCHEMAS, committed_tables, load_committed
    from techmine.sources import works_json as WJ
    gone = F.regexp_extract("id", "W([0-9]+)$", 1).cast("long") % 3 == 0
    landing = shared_dir(spark, "pages-to-load")
    WJ.write_pages_of(_documents_with_texts(spark, base),
                      lambda d: _records_from_documents(d).withColumn("doi", F.when(~gone, F.col("doi"))),
                      landing, DOCUMENT_ORDER)
    works, topics = WJ.works_and_topics(WJ.read_pages(spark, landing).where(WJ.selection()))
    incoming = {t: spark.createDataFrame([], s) for t, s in MODEL_SCHEMAS.items()}
    incoming |= {"topic": topics, "work": works.select(*MODEL_SCHEMAS["work"].fieldNames())}
    root = shared_dir(spark, "loaded")
    load_committed(spark, root, incoming)
    read = committed_tables(spark, root)
    triples = G.graph(topic=read["topic"], work=read["work"])
    return triples.groupBy(F.regexp_extract("p", r"([^/#]*)$", 1).alias("p")).agg(F.count(F.lit(1)).alias("n"))
