"""QRY1 and QRY2 as three drops leave them stored: works land by year of publication,
their links by line, so links come before and after their works and come again."""

from __future__ import annotations

from pyspark.sql import functions as F

from techmine.plans import standins as S
from techmine.plans.q_reports import QRY1_SQL, QRY2_SQL
from techmine.plans.registry import query
from techmine.session import shared_dir
from techmine.sources.tables import table
from techmine.streaming import kept_reports as K

# Lower bounds of the second and third drop: year of publication, line of a work.
LATER = ((1994, 1997), (3, 5))


def _landed(spark, base, tech_name: str) -> str:
    root = shared_dir(spark, "kept")
    work, topic, technology = S.work(spark, base), S.topic(spark, base), S.technology(spark, base, tech_name)
    lines = table(spark, base, "lineitem").select(F.col("l_orderkey").alias("work_id"),
                                                  F.col("l_partkey").alias("technology_id"), "l_linenumber")

    def drop(value, bounds):
        value = F.coalesce(value, F.lit(0))
        return sum(((value >= b).cast("int") for b in bounds), F.lit(0))

    for k in range(3):
        K.land(spark, root, f"drop {k}", work.where(drop(F.substring("published", 1, 4).cast("int"), LATER[0]) == k),
               lines.where(drop(F.col("l_linenumber"), LATER[1]) == k), topic, technology)
    return root


@query("topic_tech_counts_kept", QRY1_SQL)
def topic_tech_counts_kept(spark, base):
    return K.kept_topic_tech_counts(spark, _landed(spark, base, "p_brand"))


@query("tech_pairs_shared_topics_kept", QRY2_SQL)
def tech_pairs_shared_topics_kept(spark, base):
    return K.kept_tech_pairs(spark, _landed(spark, base, "p_name"))
