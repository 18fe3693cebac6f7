"""Queries over the relational model: hierarchy (HI1-HI4), ids and
registration (WIN1, AG3, AG7, REG1-REG3), loading (SNK3, SNK4, INC1) and
constraints (CON1-CON8)."""

from __future__ import annotations

from pyspark.sql import functions as F

from techmine.operators import constraints as C
from techmine.operators import dimensions as D
from techmine.operators import hierarchy as H
from techmine.operators.ids import dense_ids, next_id, next_id_from_lines
from techmine.operators.pages import with_row_count
from techmine.plans import standins as S
from techmine.plans.q_graph import HI1_EDGES_SQL
from techmine.plans.registry import query
from techmine.session import shared_dir
from techmine.sinks import tables as T
from techmine.sinks.tables import commit_state
from techmine.sources.tables import table

BASE_VALUES = ", ".join(f"({i + 1}, '{n}')" for i, n in enumerate(H.BASE_TOPICS))

TOPICS_WITH_BASE_SQL = f"""
SELECT CAST(n_nationkey AS BIGINT) AS id, n_name AS name FROM nation
UNION ALL
SELECT CAST(m.m + row_number() OVER (ORDER BY k) AS BIGINT) AS id, nm AS name
FROM (VALUES {BASE_VALUES}) v(k, nm) CROSS JOIN (SELECT max(n_nationkey) AS m FROM nation) m
WHERE nm NOT IN (SELECT trim(n_name) FROM nation)
"""


def _topics(spark, base):
    return H.ensure_base_topics(S.topic(spark, base))


@query("ensure_base_members", TOPICS_WITH_BASE_SQL)
def ensure_base_members(spark, base):
    return _topics(spark, base)


@query("hierarchy_build", HI1_EDGES_SQL)
def hierarchy_build(spark, base):
    return H.build_hierarchy(_topics(spark, base))


CLOSURE_SQL = f"""
WITH RECURSIVE e AS ({HI1_EDGES_SQL}),
c(ancestor_id, descendant_id, depth, path) AS (
  SELECT parent_id, child_id, 1, CAST(parent_id AS VARCHAR) || '/' || CAST(child_id AS VARCHAR) FROM e
  UNION
  SELECT c.ancestor_id, e.child_id, c.depth + 1, c.path || '/' || CAST(e.child_id AS VARCHAR)
  FROM c JOIN e ON c.descendant_id = e.parent_id)
"""


@query("topic_closure", CLOSURE_SQL + """
SELECT ancestor_id, descendant_id, CAST(min(depth) AS INTEGER) AS depth FROM c GROUP BY 1, 2
""")
def topic_closure(spark, base):
    return H.closure(H.build_hierarchy(_topics(spark, base)), paths=False)


@query("topic_paths", CLOSURE_SQL + """
SELECT ancestor_id, descendant_id, CAST(depth AS INTEGER) AS depth, path FROM c
""")
def topic_paths(spark, base):
    return H.closure(H.build_hierarchy(_topics(spark, base))).select(
        "ancestor_id", "descendant_id", "depth", F.array_join("path", "/").alias("path"))


@query("topic_paths_after_new_edges", CLOSURE_SQL + """
SELECT ancestor_id, descendant_id, CAST(depth AS INTEGER) AS depth, path FROM c
""")
def topic_paths_after_new_edges(spark, base):
    """HI4 kept up to date: a third of the edges come later and are added to the
    closure of the others, once as many edges and once as few."""
    edge = H.build_hierarchy(_topics(spark, base)).checkpoint(eager=True)
    third = F.pmod(F.xxhash64("id"), F.lit(3))
    closed = H.closure(edge.where(third == 0))
    for k in (1, 2):
        closed = H.extended_closure(closed, edge.where(third == k)).checkpoint(eager=True)
    return closed.select("ancestor_id", "descendant_id", "depth", F.array_join("path", "/").alias("path"))


@query("topic_rollup", CLOSURE_SQL + """,
pairs AS (SELECT ancestor_id, descendant_id FROM c
          UNION SELECT x, x FROM (SELECT ancestor_id AS x FROM c UNION SELECT descendant_id FROM c))
SELECT ancestor_id AS topic_id, count(DISTINCT o_orderkey) AS n_works
FROM orders JOIN customer ON o_custkey = c_custkey JOIN pairs ON descendant_id = c_nationkey
GROUP BY ancestor_id
""")
def topic_rollup(spark, base):
    cl = H.closure(H.build_hierarchy(_topics(spark, base)), paths=False)
    return H.rollup(S.work(spark, base), cl)


@query("leaf_topics", f"""
WITH t AS ({TOPICS_WITH_BASE_SQL}), e AS ({HI1_EDGES_SQL})
SELECT id, name FROM t WHERE id NOT IN (SELECT parent_id FROM e)
""")
def leaf_topics(spark, base):
    t = _topics(spark, base)
    return H.leaf_topics(t, H.build_hierarchy(t))


# ------------------------------------------------------------ ids and registration

@query("work_ids_by_rank", """
SELECT CAST(row_number() OVER (ORDER BY floor(o_totalprice / 1000) DESC, o_orderkey) AS BIGINT) AS id,
       o_orderkey AS source_id, CAST(floor(o_totalprice / 1000) AS BIGINT) AS citations
FROM orders
""")
def work_ids_by_rank(spark, base):
    w = S.work(spark, base).select(F.col("id").alias("source_id"), "citations")
    return D.rank_ids(w, [F.desc("citations"), F.asc("source_id")]).select("id", "source_id", "citations")


@query("first_seen_ids", """
WITH w AS (SELECT row_number() OVER (ORDER BY floor(o_totalprice / 1000) DESC, o_orderkey) AS seq, n_name
           FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey),
f AS (SELECT n_name, min(seq) AS first FROM w GROUP BY n_name)
SELECT CAST(row_number() OVER (ORDER BY first, n_name) AS BIGINT) AS id, n_name AS name FROM f
""")
def first_seen_ids(spark, base):
    w = S.work(spark, base).select(F.col("id").alias("source_id"), "citations", "topic_id")
    ranked = D.rank_ids(w, [F.desc("citations"), F.asc("source_id")], id_col="seq")
    named = ranked.join(S.topic(spark, base).select(F.col("id").alias("topic_id"), "name"), "topic_id")
    empty = named.sparkSession.createDataFrame([], "id long, name string")
    return D.register_names(empty, named, "name", ["seq"])


def _brand_dimension(spark, base):
    brands = table(spark, base, "part").select(F.col("p_brand").alias("name")).distinct()
    return dense_ids(brands, ["name"]).select("id", "name")


def _name_stream(spark, base):
    li = table(spark, base, "lineitem").select(F.col("l_orderkey").alias("work_id"), "l_partkey")
    p = table(spark, base, "part").select(F.col("p_partkey").alias("l_partkey"), F.col("p_name").alias("name"))
    return li.join(p, "l_partkey").select("work_id", "name")


REGISTER_SQL = """
WITH ex AS (SELECT CAST(row_number() OVER (ORDER BY p_brand) AS BIGINT) AS id, p_brand AS name
            FROM (SELECT DISTINCT p_brand FROM part)),
inc AS (SELECT l_orderkey AS w, p_name AS name FROM lineitem JOIN part ON l_partkey = p_partkey),
f AS (SELECT name, min(w) AS fw FROM inc WHERE name NOT IN (SELECT name FROM ex) GROUP BY name)
SELECT id, name FROM ex
UNION ALL
SELECT CAST((SELECT max(id) FROM ex) + row_number() OVER (ORDER BY fw, name) AS BIGINT) AS id, name FROM f
"""


@query("register_new_names", REGISTER_SQL)
def register_new_names(spark, base):
    return D.with_registered(_brand_dimension(spark, base), _name_stream(spark, base), "name", ["work_id"])


@query("bridge_rows", f"""
WITH dim AS ({REGISTER_SQL}),
wn AS (SELECT DISTINCT l_orderkey AS work_id, p_name AS name FROM lineitem JOIN part ON l_partkey = p_partkey)
SELECT CAST(row_number() OVER (ORDER BY wn.work_id, wn.name) AS BIGINT) AS id, wn.work_id, dim.id AS technology_id
FROM wn JOIN dim ON wn.name = dim.name
""")
def bridge_rows(spark, base):
    dim = register_new_names(spark, base)
    per_work = D.languages_per_work(_name_stream(spark, base), "work_id", "name")
    work_names = per_work.select("work_id", F.explode("languages").alias("name"))
    no_links = spark.createDataFrame([], "id long, work_id long, technology_id long")
    return D.bridge_rows(work_names, dim, no_links)


# ------------------------------------------------------------ loading

MENTION_ROWS_SQL = """
SELECT l_orderkey * 10 + l_linenumber AS id, l_orderkey AS work_id, l_partkey AS technology_id,
       l_quantity AS quantity
FROM lineitem
"""


def _mention_rows(spark, base):
    return table(spark, base, "lineitem").select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).cast("long").alias("id"),
        F.col("l_orderkey").alias("work_id"), F.col("l_partkey").alias("technology_id"),
        F.col("l_quantity").alias("quantity"), "l_returnflag")


@query("insert_ignore", f"""
WITH inc AS ({MENTION_ROWS_SQL}),
ex AS (SELECT DISTINCT l_orderkey * 10 + l_linenumber AS id FROM lineitem WHERE l_returnflag = 'R')
SELECT id, work_id, technology_id, quantity FROM inc
WHERE id NOT IN (SELECT id FROM ex)
QUALIFY row_number() OVER (PARTITION BY id ORDER BY work_id, technology_id, quantity) = 1
""")
def insert_ignore(spark, base):
    rows = _mention_rows(spark, base)
    stored = rows.where(F.col("l_returnflag") == "R").select("id")
    incoming = rows.drop("l_returnflag")
    return T.insert_ignore(stored, incoming, "id", ["work_id", "technology_id", "quantity"])


@query("append_unseen", """
WITH ex AS (SELECT DISTINCT p_brand AS name FROM part),
inc AS (SELECT l_orderkey * 10 + l_linenumber AS seq, p_brand AS name FROM lineitem JOIN part ON l_partkey = p_partkey
        UNION ALL
        SELECT l_orderkey * 10 + l_linenumber AS seq, p_name AS name FROM lineitem JOIN part ON l_partkey = p_partkey)
SELECT seq, name FROM inc WHERE name NOT IN (SELECT name FROM ex)
QUALIFY row_number() OVER (PARTITION BY name ORDER BY seq) = 1
""")
def append_unseen(spark, base):
    li = table(spark, base, "lineitem").select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).cast("long").alias("seq"), "l_partkey")
    p = table(spark, base, "part").select(F.col("p_partkey").alias("l_partkey"), "p_brand", "p_name")
    j = li.join(p, "l_partkey")
    incoming = (j.select("seq", F.col("p_brand").alias("name"))
                 .unionByName(j.select("seq", F.col("p_name").alias("name"))))
    stored = p.select(F.col("p_brand").alias("name"))
    return T.append_unseen(stored, incoming, "name", ["seq"]).select("seq", "name")


@query("resume_unprocessed", """
SELECT o_orderkey AS id FROM orders
WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_linestatus = 'F')
""")
def resume_unprocessed(spark, base):
    done = (table(spark, base, "lineitem").where(F.col("l_linestatus") == "F")
            .select(F.col("l_orderkey").alias("work_id")))
    return T.resume_unprocessed(S.work(spark, base).select("id"), done)


# ------------------------------------------------------------ constraints

@query("pk_violations", """
SELECT l_orderkey * 10 + l_linenumber AS key, count(*) AS n_rows FROM lineitem
GROUP BY 1 HAVING count(*) > 1
""")
def pk_violations(spark, base):
    return C.pk_violations(S.mention_with_id(spark, base))


@query("unique_violations", """
SELECT text AS value, count(*) AS n_rows FROM documents WHERE text IS NOT NULL
GROUP BY text HAVING count(*) > 1
""")
def unique_violations(spark, base):
    return C.unique_violations(table(spark, base, "documents").select("doc_id", "text"), "text")


@query("null_violations", """
SELECT 'source_url' AS "column", o_orderkey AS key FROM orders WHERE o_orderkey IS NULL
UNION ALL SELECT 'title', o_orderkey FROM orders WHERE o_orderpriority IS NULL
UNION ALL SELECT 'topic_id', o_orderkey FROM orders LEFT JOIN customer ON o_custkey = c_custkey
  WHERE c_nationkey IS NULL
""")
def null_violations(spark, base):
    return C.null_violations(S.work(spark, base), ["source_url", "title", "topic_id"])


@query("check_violations", """
SELECT l_orderkey * 10 + l_linenumber AS key, CAST(s_nationkey AS BIGINT) AS value
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
WHERE s_nationkey = c_nationkey
""")
def check_violations(spark, base):
    li = table(spark, base, "lineitem").select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).cast("long").alias("id"),
        F.col("l_orderkey").alias("o_orderkey"), F.col("l_suppkey").alias("s_suppkey"))
    sup = table(spark, base, "supplier").select("s_suppkey", "s_nationkey")
    w = S.work(spark, base).select(F.col("id").alias("o_orderkey"), "topic_id")
    edge = (li.join(sup, "s_suppkey").join(w, "o_orderkey")
              .select("id", F.col("s_nationkey").cast("long").alias("parent_id"),
                      F.col("topic_id").alias("child_id")))
    return C.check_violations(edge)


@query("fk_violations", f"""
WITH e AS ({HI1_EDGES_SQL})
SELECT 'edge.parent' AS "check", id AS key, parent_id AS ref FROM e
  WHERE parent_id NOT IN (SELECT n_nationkey FROM nation)
UNION ALL SELECT 'edge.child', id, child_id FROM e WHERE child_id NOT IN (SELECT n_nationkey FROM nation)
UNION ALL SELECT 'labels.doc', doc_id, doc_id FROM labels WHERE doc_id NOT IN (SELECT doc_id FROM documents)
UNION ALL SELECT 'mention.work', l_orderkey * 10 + l_linenumber, l_orderkey FROM lineitem
  WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)
UNION ALL SELECT 'mention.technology', l_orderkey * 10 + l_linenumber, l_partkey FROM lineitem
  WHERE l_partkey NOT IN (SELECT p_partkey FROM part)
UNION ALL SELECT 'work.topic', o_orderkey, CAST(c_nationkey AS BIGINT) FROM orders JOIN customer ON o_custkey = c_custkey
  WHERE c_nationkey NOT IN (SELECT n_nationkey FROM nation)
""")
def fk_violations(spark, base):
    topic = S.topic(spark, base)
    edge = H.build_hierarchy(_topics(spark, base))
    labels = table(spark, base, "labels").select(F.col("doc_id").alias("id"), "doc_id")
    docs = table(spark, base, "documents").select(F.col("doc_id").alias("id"))
    mention = S.mention_with_id(spark, base)
    work = S.work(spark, base)
    checks = [
        ("edge.parent", C.fk_violations(edge, "parent_id", topic)),
        ("edge.child", C.fk_violations(edge, "child_id", topic)),
        ("labels.doc", C.fk_violations(labels, "doc_id", docs)),
        ("mention.work", C.fk_violations(mention, "work_id", work.select("id"))),
        ("mention.technology", C.fk_violations(mention, "technology_id", S.technology(spark, base))),
        ("work.topic", C.fk_violations(work, "topic_id", topic)),
    ]
    out = None
    for name, df in checks:
        part = df.select(F.lit(name).alias("check"), F.col("key").cast("long"), F.col("ref").cast("long"))
        out = part if out is None else out.unionByName(part)
    return out


@query("delete_cascade", """
SELECT l_orderkey AS work_id, l_partkey AS technology_id FROM lineitem
WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')
""")
def delete_cascade(spark, base):
    gone = table(spark, base, "orders").where(F.col("o_orderstatus") == "F").select(F.col("o_orderkey").alias("id"))
    return C.delete_cascade(S.mention(spark, base), "work_id", gone)


@query("delete_set_null", """
SELECT o_orderkey AS id,
       CASE WHEN c_nationkey IN (SELECT n_nationkey FROM nation WHERE n_regionkey = 0) THEN NULL
            ELSE CAST(c_nationkey AS BIGINT) END AS topic_id
FROM orders LEFT JOIN customer ON o_custkey = c_custkey
""")
def delete_set_null(spark, base):
    gone = (table(spark, base, "nation").where(F.col("n_regionkey") == 0)
            .select(F.col("n_nationkey").cast("long").alias("id")))
    return C.delete_set_null(S.work(spark, base).select("id", "topic_id"), "topic_id", gone)


@query("update_cascade", """
WITH m AS (SELECT CAST(n_nationkey AS BIGINT) AS old_id,
                  CAST(n_nationkey + (SELECT max(n_nationkey) + 1 FROM nation) AS BIGINT) AS new_id FROM nation)
SELECT o_orderkey AS id, coalesce(m.new_id, CAST(c_nationkey AS BIGINT)) AS topic_id
FROM orders LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN m ON c_nationkey = m.old_id
""")
def update_cascade(spark, base):
    n = table(spark, base, "nation").select(F.col("n_nationkey").cast("long").alias("old_id"))
    top = n.agg((F.max("old_id") + 1).alias("shift"))
    mapping = (n.withColumn("__k", F.lit(1)).join(F.broadcast(top.withColumn("__k", F.lit(1))), "__k")
                .select("old_id", (F.col("old_id") + F.col("shift")).alias("new_id")))
    return C.update_keys(S.work(spark, base).select("id", "topic_id"), "topic_id", mapping)


# ------------------------------------------------------------ all rules, one job

def _model_tables(spark, base):
    from techmine.plans.q_graph import _edges
    topic = _topics(spark, base)
    tech = S.technology(spark, base, "p_name")
    return topic, _edges(spark, base), S.work(spark, base), tech, S.mention_with_id(spark, base)


CONSTRAINT_REPORT_SQL = f"""
WITH t AS ({TOPICS_WITH_BASE_SQL}),
e AS ({HI1_EDGES_SQL}),
w AS (SELECT o_orderkey AS id, '10.5555/' || CAST(o_orderkey AS VARCHAR) AS doi,
             'https://example.org/pdf/' || CAST(o_orderkey AS VARCHAR) || '.pdf' AS source_url,
             o_orderpriority AS title, CAST(c_nationkey AS BIGINT) AS topic_id
      FROM orders LEFT JOIN customer ON o_custkey = c_custkey),
te AS (SELECT p_partkey AS id, p_name AS name FROM part),
m AS (SELECT l_orderkey * 10 + l_linenumber AS id, l_orderkey AS work_id, l_partkey AS technology_id FROM lineitem)
SELECT 'topic.pk' AS "check", (SELECT count(*) FROM (SELECT id FROM t GROUP BY id HAVING count(*) > 1 OR id IS NULL)) AS n
UNION ALL SELECT 'edge.pk', (SELECT count(*) FROM (SELECT id FROM e GROUP BY id HAVING count(*) > 1 OR id IS NULL))
UNION ALL SELECT 'work.pk', (SELECT count(*) FROM (SELECT id FROM w GROUP BY id HAVING count(*) > 1 OR id IS NULL))
UNION ALL SELECT 'technology.pk', (SELECT count(*) FROM (SELECT id FROM te GROUP BY id HAVING count(*) > 1 OR id IS NULL))
UNION ALL SELECT 'mention.pk', (SELECT count(*) FROM (SELECT id FROM m GROUP BY id HAVING count(*) > 1 OR id IS NULL))
UNION ALL SELECT 'work.doi.unique', (SELECT count(*) FROM (SELECT doi FROM w WHERE doi IS NOT NULL GROUP BY doi HAVING count(*) > 1))
UNION ALL SELECT 'topic.not_null', (SELECT count(*) FROM t WHERE name IS NULL)
UNION ALL SELECT 'technology.not_null', (SELECT count(*) FROM te WHERE name IS NULL)
UNION ALL SELECT 'work.not_null', (SELECT count(*) FROM w WHERE source_url IS NULL) + (SELECT count(*) FROM w WHERE title IS NULL)
UNION ALL SELECT 'mention.not_null', (SELECT count(*) FROM m WHERE work_id IS NULL) + (SELECT count(*) FROM m WHERE technology_id IS NULL)
UNION ALL SELECT 'edge.not_null', (SELECT count(*) FROM e WHERE parent_id IS NULL) + (SELECT count(*) FROM e WHERE child_id IS NULL)
UNION ALL SELECT 'edge.check', (SELECT count(*) FROM e WHERE parent_id = child_id)
UNION ALL SELECT 'work.topic.fk', (SELECT count(*) FROM w WHERE topic_id IS NOT NULL AND topic_id NOT IN (SELECT id FROM t))
UNION ALL SELECT 'mention.work.fk', (SELECT count(*) FROM m WHERE work_id IS NOT NULL AND work_id NOT IN (SELECT id FROM w))
UNION ALL SELECT 'mention.technology.fk', (SELECT count(*) FROM m WHERE technology_id IS NOT NULL AND technology_id NOT IN (SELECT id FROM te))
UNION ALL SELECT 'edge.parent.fk', (SELECT count(*) FROM e WHERE parent_id IS NOT NULL AND parent_id NOT IN (SELECT id FROM t))
UNION ALL SELECT 'edge.child.fk', (SELECT count(*) FROM e WHERE child_id IS NOT NULL AND child_id NOT IN (SELECT id FROM t))
"""


@query("constraint_report", CONSTRAINT_REPORT_SQL)
def constraint_report(spark, base):
    """Every key, not-null, check and reference rule of the five tables,
    counted together (the report the checked load runs before writing)."""
    # The inputs (a hierarchy, a join) are built once; each rule reads them stored.
    from techmine.session import shared_dir
    root = shared_dir(spark, "model-to-check")
    names = ("topic", "edge", "work", "technology", "mention")
    columns = (["id", "name"], ["id", "parent_id", "child_id"], ["id", "doi", "source_url", "title", "topic_id"],
               ["id", "name"], ["id", "work_id", "technology_id"])
    stored = {}
    for name, cols, df in zip(names, columns, _model_tables(spark, base), strict=True):
        df.select(*cols).write.parquet(f"{root}/{name}")
        stored[name] = spark.read.parquet(f"{root}/{name}")
    return T.model_report(**stored)


@query("null_violations_of_joined", """
WITH j AS (SELECT o_orderkey AS id, c_name AS name, c_nationkey AS nation
           FROM orders LEFT JOIN customer ON o_custkey = c_custkey + 7)
SELECT 'name' AS "column", id AS key FROM j WHERE name IS NULL
UNION ALL SELECT 'nation', id FROM j WHERE nation IS NULL
""")
def null_violations_of_joined(spark, base):
    """CON3 on a join with misses, so that nulls occur."""
    c = table(spark, base, "customer").select((F.col("c_custkey") + 7).alias("o_custkey"), F.col("c_name").alias("name"),
                                              F.col("c_nationkey").alias("nation"))
    j = table(spark, base, "orders").select(F.col("o_orderkey").alias("id"), "o_custkey").join(c, "o_custkey", "left")
    return C.null_violations(j, ["name", "nation"])


@query("default_zero_of_joined", """
SELECT o_orderkey AS id, coalesce(c_nationkey, 0) AS nation FROM orders LEFT JOIN customer ON o_custkey = c_custkey + 7
""")
def default_zero_of_joined(spark, base):
    """CON6: a missing value takes the default 0."""
    c = table(spark, base, "customer").select((F.col("c_custkey") + 7).alias("o_custkey"), F.col("c_nationkey").alias("nation"))
    j = table(spark, base, "orders").select(F.col("o_orderkey").alias("id"), "o_custkey").join(c, "o_custkey", "left")
    return C.default_zero(j.select("id", "nation"), "nation")


@query("restricted_deletes", """
SELECT r_regionkey AS key, count(n_nationkey) AS n_children
FROM region LEFT JOIN nation ON n_regionkey = r_regionkey GROUP BY r_regionkey
""")
def restricted_deletes(spark, base):
    """CON7 RESTRICT as a report: how many rows keep each parent from being
    deleted (0: it may go)."""
    return C.restricting_rows(table(spark, base, "nation").select(F.col("n_nationkey").alias("id"), "n_regionkey"),
                              "n_regionkey", table(spark, base, "region").select(F.col("r_regionkey").alias("id")))


@query("checked_load", f"""
WITH t AS ({TOPICS_WITH_BASE_SQL}), e AS ({HI1_EDGES_SQL})
SELECT 'topic' AS "table", (SELECT count(DISTINCT id) FROM t) AS n_rows
UNION ALL SELECT 'edge', (SELECT count(DISTINCT id) FROM e)
UNION ALL SELECT 'work', (SELECT count(DISTINCT o_orderkey) FROM orders)
UNION ALL SELECT 'technology', (SELECT count(DISTINCT p_partkey) FROM part)
UNION ALL SELECT 'mention', (SELECT count(DISTINCT l_orderkey * 10 + l_linenumber) FROM lineitem)
""")
def checked_load(spark, base):
    """SNK4 end to end: insert-ignore of the five stand-in tables into empty
    stored tables, every rule checked first, then appended in FK order; the
    result counts what was written, read back from the written tables."""
    from techmine.session import shared_dir
    topic, edge, work, tech, mention = _model_tables(spark, base)
    incoming = {"topic": topic, "edge": edge, "work": work, "technology": tech, "mention": mention}
    stored = {k: v.limit(0) for k, v in incoming.items()}
    root = shared_dir(spark, "model")
    paths = {k: f"{root}/{k}" for k in incoming}
    T.load_tables(stored, incoming, paths)
    parts = [spark.read.parquet(p).agg(F.count(F.lit(1)).alias("n_rows"))
             .select(F.lit(k).alias("table"), "n_rows") for k, p in paths.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@query("delete_through_tables", """
WITH topic AS (SELECT CAST(n_nationkey AS BIGINT) AS id, n_name AS name FROM nation
               UNION ALL SELECT CAST(1000 + r_regionkey AS BIGINT), r_name FROM region),
edge AS (SELECT CAST(1000 + n_regionkey AS BIGINT) AS p, CAST(n_nationkey AS BIGINT) AS c FROM nation),
gone AS (SELECT id FROM topic WHERE id = 1000 OR name LIKE '%A'),
w AS (SELECT o_orderkey AS id, CAST(c_nationkey AS BIGINT) AS topic_id FROM orders LEFT JOIN customer ON o_custkey = c_custkey
      WHERE o_orderstatus <> 'F')
SELECT 'topic' AS "table", id AS a, CAST(NULL AS BIGINT) AS b FROM topic WHERE id NOT IN (SELECT id FROM gone)
UNION ALL SELECT 'edge', p, c FROM edge WHERE p NOT IN (SELECT id FROM gone) AND c NOT IN (SELECT id FROM gone)
UNION ALL SELECT 'work', id, CASE WHEN topic_id IN (SELECT id FROM gone) THEN NULL ELSE topic_id END FROM w
UNION ALL SELECT 'mention', l_orderkey, l_partkey FROM lineitem
          WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')
UNION ALL SELECT 'technology', p_partkey, NULL FROM part WHERE p_partkey NOT IN (
            SELECT p_partkey FROM part WHERE p_size = 1 AND p_partkey NOT IN (
              SELECT l_partkey FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')))
""")
def delete_through_tables(spark, base):
    """CON7 over the five tables in one commit: some topics, all finished works, and
    the technologies that only those works mention go."""
    nation, region = table(spark, base, "nation"), table(spark, base, "region")
    long = lambda c: F.col(c).cast("long")
    topic = nation.select(long("n_nationkey").alias("id"), F.col("n_name").alias("name")).unionByName(
        region.select((long("r_regionkey") + 1000).alias("id"), F.col("r_name").alias("name")))
    edge = nation.select(long("n_nationkey").alias("id"), (long("n_regionkey") + 1000).alias("parent_id"),
                         long("n_nationkey").alias("child_id"))
    tables = {"topic": topic, "edge": edge, "work": S.work(spark, base).select("id", "topic_id"),
              "technology": table(spark, base, "part").select(F.col("p_partkey").alias("id"), "p_size"),
              "mention": S.mention_with_id(spark, base)}
    works = table(spark, base, "orders").where(F.col("o_orderstatus") == "F").select(F.col("o_orderkey").alias("id"))
    staying = C.delete_cascade(tables["mention"], "work_id", works).select(F.col("technology_id").alias("id"))
    unused = tables["technology"].where("p_size = 1").join(staying, "id", "left_anti")
    doomed = {"topic": topic.where((F.col("id") == 1000) | F.col("name").endswith("A")), "work": works, "technology": unused}
    left = commit_state(spark, shared_dir(spark, "model-state"), C.delete_through(tables, doomed))
    shown = {"topic": ("id", None), "edge": ("parent_id", "child_id"), "work": ("id", "topic_id"),
             "mention": ("work_id", "technology_id"), "technology": ("id", None)}
    parts = [left[t].select(F.lit(t).alias("table"), F.col(a).cast("long").alias("a"),
                            (F.col(b) if b else F.lit(None)).cast("long").alias("b")) for t, (a, b) in shown.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@query("indexed_loads", """
SELECT l_orderkey * 10 + l_linenumber AS id, min(l_orderkey) AS work_id, min(l_partkey) AS technology_id
FROM lineitem GROUP BY 1
""")
def indexed_loads(spark, base):
    """SNK4 with a key index: works and mentions land in two loads, the second of which
    has all rows again; then a load with a mention of no technology is refused."""
    from techmine.sinks import key_index as K
    topic, edge, work, tech, mention = _model_tables(spark, base)
    root = shared_dir(spark, "indexed-model")
    even = F.pmod("work_id", F.lit(2)) == 0
    K.load_indexed(spark, root, {"topic": topic, "edge": edge, "technology": tech,
                                 "work": work.where(F.pmod("id", F.lit(2)) == 0), "mention": mention.where(even)})
    none = {t: spark.createDataFrame([], schema) for t, schema in T.MODEL_SCHEMAS.items()}
    K.load_indexed(spark, root, none | {"work": work, "mention": mention})
    dangling = mention.agg(F.max("id").alias("id"), F.max("work_id").alias("work_id")).select(
        (F.col("id") + 1).alias("id"), "work_id", F.lit(-1).cast("long").alias("technology_id"))
    try:
        K.load_indexed(spark, root, none | {"mention": dangling})
    except C.ConstraintError:
        return K.indexed_tables(spark, root)["mention"]
    raise AssertionError("a load with a dangling reference was taken")


@query("next_ids", """
SELECT 'work' AS "table", max(o_orderkey) + 1 AS next_id, max(o_orderkey) + 1 AS next_id_of_lines FROM orders
UNION ALL SELECT 'technology', max(p_partkey) + 1, max(p_partkey) + 1 FROM part
UNION ALL SELECT 'mention', max(l_orderkey * 10 + l_linenumber) + 1, max(l_orderkey * 10 + l_linenumber) + 1 FROM lineitem
""")
def next_ids(spark, base):
    """SC16: the id after the largest of each table, and the same from its rows as the
    text lines of a damaged file (a header, an id that is no number, an empty line)."""
    out = []
    for name, df in (("work", S.work(spark, base)), ("technology", S.technology(spark, base)),
                     ("mention", S.mention_with_id(spark, base))):
        damaged = spark.createDataFrame([("id,name",), ("12x4,broken",), ("",)], "value string")
        lines = df.select(F.concat_ws(",", F.col("id").cast("string"), F.lit('a "name", cut')).alias("value"))
        out.append((name, next_id(df), next_id_from_lines(lines.unionByName(damaged))))
    return spark.createDataFrame(out, "table string, next_id long, next_id_of_lines long")


@query("rows_written", """
SELECT 'work' AS "table", count(*) AS n_rows FROM orders UNION ALL SELECT 'technology', count(*) FROM part
UNION ALL SELECT 'mention', count(*) FROM lineitem
""")
def rows_written(spark, base):
    """AG4: rows counted while each table is written, without a job of their own."""
    out = []
    for name, df in (("work", S.work(spark, base)), ("technology", S.technology(spark, base)),
                     ("mention", S.mention(spark, base))):
        df, seen = with_row_count(df, f"rows of {name}")
        df.write.mode("overwrite").parquet(f"{shared_dir(spark, 'counted')}/{name}")
        out.append((name, seen.get["rows"]))
    return spark.createDataFrame(out, "table string, n_rows long")
