"""Plan-shape checks: the scale properties the design relies on, read from
``explain("formatted")`` so a regression in the physical plan fails a test."""

import contextlib
import io

from pyspark.sql import functions as F

import __spark_entry__ as E
from conftest import SF001
from techmine.operators.ids import dense_ids


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_qry1_scans_are_pruned(spark):
    text = plan(E.queries()["topic_tech_counts"](spark, SF001))
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint>" in text
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint>" in text
    assert "PushedFilters: [IsNotNull(p_brand), Not(EqualTo(p_brand,))" in text


def test_graph_patterns_prune_predicates(spark):
    text = plan(E.queries()["topic_tech_counts_triples"](spark, SF001))
    assert "PartitionFilters: [isnotnull(p#" in text
    assert "= https://schema.org/about)" in text and "= https://schema.org/mentions)" in text


def test_large_dense_ids_avoid_single_partition(spark):
    df = spark.range(0, 1000).select((F.col("id") * 37 % 1000).alias("k"))
    text = plan(dense_ids(df, ["k"]))
    # The only single-partition exchange carries the per-partition counts
    # (one row per partition) for the offsets, never the data rows.
    sections = [sec for sec in text.split("\n\n") if "Arguments: SinglePartition" in sec]
    assert sections
    for sec in sections:
        cols = sec.split("Input [", 1)[1].split("\n", 1)[0]
        assert "__tm_pid" in cols and "__tm_n" in cols and "k#" not in cols


def test_ids_by_key_sort_no_wide_column(spark):
    from techmine.operators.ids import dense_ids_by_key
    df = spark.range(100).select("id", (F.col("id") % 7).alias("k"), F.lit("long text").alias("abstract"))
    df = df.withColumnRenamed("id", "row")
    text = plan(dense_ids_by_key(df, [("k", False), ("row", True)], "row"))
    assert "rangepartitioning" not in text  # sorted and checkpointed before, key columns only
    assert [r["id"] for r in dense_ids_by_key(df, [("k", False), ("row", True)], "row").orderBy(
        F.desc("k"), "row").collect()] == list(range(1, 101))


def test_pairs_join_is_salted(spark):
    text = plan(E.queries()["tech_pairs_same_work"](spark, SF001))
    assert "__tm_salt" in text
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
