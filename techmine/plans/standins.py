"""The driver's tables in the roles of the data model.

work = orders (topic reached through customer), topic = nation,
parent topic = region, technology = part, mention = lineitem.
Only the columns a role needs are selected, so scans stay pruned.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from techmine.sources.tables import table


def work(spark: SparkSession, base: str) -> DataFrame:
    """orders as works: id, doi, source_url, title, abstract, published,
    language, citations, fwci, topic_id (the customer's nation)."""
    o = table(spark, base, "orders").select("o_orderkey", "o_custkey", "o_orderpriority",
                                            "o_orderdate", "o_totalprice", "o_orderstatus")
    c = table(spark, base, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    return (o.join(c, "o_custkey", "left")
             .select(F.col("o_orderkey").alias("id"),
                     F.concat(F.lit("10.5555/"), F.col("o_orderkey").cast("string")).alias("doi"),
                     F.concat(F.lit("https://example.org/pdf/"), F.col("o_orderkey").cast("string"),
                              F.lit(".pdf")).alias("source_url"),
                     F.col("o_orderpriority").alias("title"),
                     F.lit(None).cast("string").alias("abstract"),
                     F.date_format("o_orderdate", "yyyy-MM-dd").alias("published"),
                     F.col("o_orderstatus").alias("language"),
                     F.floor(F.col("o_totalprice") / 1000).cast("long").alias("citations"),
                     F.col("o_totalprice").alias("fwci"),
                     F.col("c_nationkey").cast("long").alias("topic_id")))


def topic(spark: SparkSession, base: str) -> DataFrame:
    return table(spark, base, "nation").select(F.col("n_nationkey").cast("long").alias("id"),
                                               F.col("n_name").alias("name"))


def technology(spark: SparkSession, base: str, name_col: str = "p_name") -> DataFrame:
    return table(spark, base, "part").select(F.col("p_partkey").alias("id"),
                                             F.col(name_col).alias("name"),
                                             F.col("p_type").alias("kind"),
                                             F.lit(None).cast("string").alias("version"))


def mention(spark: SparkSession, base: str) -> DataFrame:
    """lineitem as work-technology links (duplicate links occur)."""
    return table(spark, base, "lineitem").select(F.col("l_orderkey").alias("work_id"),
                                                 F.col("l_partkey").alias("technology_id"))


def mention_with_id(spark: SparkSession, base: str) -> DataFrame:
    """lineitem links with a stored id = orderkey * 10 + linenumber (not unique:
    (l_orderkey, l_linenumber) repeats, which the key checks must report)."""
    return table(spark, base, "lineitem").select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).cast("long").alias("id"),
        F.col("l_orderkey").alias("work_id"),
        F.col("l_partkey").alias("technology_id"))
