"""Report queries QRY1-QRY5 on the driver tables (work = orders, topic = nation,
technology = part, mention = lineitem)."""

from __future__ import annotations

from techmine.plans import reports, standins as S
from techmine.plans.registry import query

QRY1_SQL = """
SELECT n_name AS topic_name, p_brand AS tech_name, count(DISTINCT o_orderkey) AS shared_works
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
JOIN customer ON o_custkey = c_custkey
JOIN nation ON c_nationkey = n_nationkey
JOIN part ON l_partkey = p_partkey
WHERE n_name <> '' AND p_brand <> ''
GROUP BY n_name, p_brand
"""


@query("topic_tech_counts", QRY1_SQL)
def topic_tech_counts(spark, base):
    return reports.topic_tech_counts(S.work(spark, base), S.mention(spark, base),
                                     S.topic(spark, base), S.technology(spark, base, "p_brand"))


QRY2_SQL = """
WITH m AS (SELECT DISTINCT c_nationkey AS topic, l_partkey AS iri, p_name AS nm
           FROM lineitem JOIN orders ON l_orderkey = o_orderkey
           JOIN customer ON o_custkey = c_custkey
           JOIN part ON l_partkey = p_partkey
           WHERE p_name <> ''),
     g AS (SELECT topic, nm, count(DISTINCT iri) AS n, min(iri) AS i FROM m GROUP BY topic, nm)
SELECT a.nm AS tech_a, b.nm AS tech_b, count(*) AS common_topics
FROM g a JOIN g b ON a.topic = b.topic AND NOT (a.n = 1 AND b.n = 1 AND a.i = b.i)
GROUP BY a.nm, b.nm
"""


@query("tech_pairs_shared_topics", QRY2_SQL)
def tech_pairs_shared_topics(spark, base):
    return reports.tech_pairs_shared_topics(S.work(spark, base), S.mention(spark, base),
                                            S.technology(spark, base, "p_name"))


@query("tech_pairs_shared_topics_top10",
       QRY2_SQL + "ORDER BY common_topics DESC, tech_a, tech_b LIMIT 10")
def tech_pairs_shared_topics_top10(spark, base):
    return reports.tech_pairs_shared_topics(S.work(spark, base), S.mention(spark, base),
                                            S.technology(spark, base, "p_name"), top=10)


@query("tech_pairs_same_work", """
WITH wn AS (SELECT DISTINCT l_orderkey AS w, p_name AS nm
            FROM lineitem JOIN part ON l_partkey = p_partkey WHERE p_name <> '')
SELECT a.nm AS tech_a, b.nm AS tech_b, count(*) AS shared_works
FROM wn a JOIN wn b ON a.w = b.w AND a.nm < b.nm
GROUP BY a.nm, b.nm
""")
def tech_pairs_same_work(spark, base):
    return reports.tech_pairs_same_work(S.mention(spark, base), S.technology(spark, base, "p_name"))


@query("tech_ranking", """
SELECT p_name AS tech_name, count(DISTINCT l_orderkey) AS n_works
FROM lineitem JOIN part ON l_partkey = p_partkey
WHERE p_name <> ''
GROUP BY p_name
""")
def tech_ranking(spark, base):
    return reports.tech_ranking(S.mention(spark, base), S.technology(spark, base, "p_name"))


@query("tech_ranking_top10", """
SELECT p_name AS tech_name, count(DISTINCT l_orderkey) AS n_works
FROM lineitem JOIN part ON l_partkey = p_partkey
WHERE p_name <> ''
GROUP BY p_name
ORDER BY n_works DESC, tech_name LIMIT 10
""")
def tech_ranking_top10(spark, base):
    return reports.tech_ranking(S.mention(spark, base), S.technology(spark, base, "p_name"), top=10)


@query("topic_tech_share", f"""
WITH c AS ({QRY1_SQL})
SELECT topic_name, tech_name, shared_works,
       CAST(sum(shared_works) OVER (PARTITION BY topic_name) AS BIGINT) AS topic_total,
       CAST(shared_works AS DOUBLE) / CAST(sum(shared_works) OVER (PARTITION BY topic_name) AS DOUBLE) AS share
FROM c
""")
def topic_tech_share(spark, base):
    return reports.topic_tech_share(S.work(spark, base), S.mention(spark, base),
                                    S.topic(spark, base), S.technology(spark, base, "p_brand"))
