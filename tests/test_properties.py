"""Property tests (hypothesis): the reduced pair query equals the literal
self-join, N-Triples output reads back to the same triples, and registration
keeps ids stable across batches."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import rows
from techmine.operators import dimensions as D
from techmine.plans import reports
from techmine.sinks.rdf import ntriples_lines
from techmine.sources.rdf import parse_ntriples

FAST = settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))

names = st.sampled_from(["A", "B", "C", "a", "Java Card"])


@FAST
@given(st.lists(st.tuples(st.integers(1, 6), st.integers(1, 3)), min_size=1, max_size=25),
       st.lists(st.tuples(st.integers(1, 6), names), min_size=1, max_size=6, unique_by=lambda t: t[0]),
       st.lists(st.tuples(st.integers(1, 8), st.integers(1, 6)), min_size=1, max_size=40))
def test_pairs_reduced_equals_naive(spark, works, techs, mentions):
    work = spark.createDataFrame(works, "id long, topic_id long").dropDuplicates(["id"])
    tech = spark.createDataFrame(techs, "id long, name string")
    mention = spark.createDataFrame(mentions, "work_id long, technology_id long")
    m = (mention.join(work.select(F.col("id").alias("work_id"), "topic_id"), "work_id")
         .join(tech.select(F.col("id").alias("technology_id"), "name"), "technology_id"))
    a = m.select(F.col("topic_id").alias("t"), F.col("technology_id").alias("ia"), F.col("name").alias("na"))
    b = m.select(F.col("topic_id").alias("t"), F.col("technology_id").alias("ib"), F.col("name").alias("nb"))
    naive = (a.join(b, "t").where(F.col("ia") != F.col("ib"))
             .groupBy(F.col("na").alias("tech_a"), F.col("nb").alias("tech_b"))
             .agg(F.countDistinct("t").alias("common_topics")))
    assert rows(reports.tech_pairs_shared_topics(work, mention, tech)) == rows(naive)


literal = st.text(alphabet=st.characters(blacklist_categories=("Cs",)), max_size=30)


@FAST
@given(st.lists(st.tuples(literal, st.booleans()), min_size=1, max_size=20))
def test_ntriples_roundtrip_any_text(spark, objs):
    data = [("http://x/s%d" % i, "http://x/p", o, "literal", "http://x/dt" if typed else None)
            for i, (o, typed) in enumerate(objs)]
    t = spark.createDataFrame(data, "s string, p string, o string, o_kind string, datatype string")
    assert rows(parse_ntriples(ntriples_lines(t))) == rows(t)


@FAST
@given(st.lists(st.tuples(st.integers(1, 30), names), min_size=1, max_size=30),
       st.lists(st.tuples(st.integers(31, 60), names), min_size=1, max_size=30))
def test_registration_stable_across_batches(spark, first, second):
    empty = spark.createDataFrame([], "id long, name string")
    b1 = spark.createDataFrame(first, "work_id long, name string")
    b2 = spark.createDataFrame(second, "work_id long, name string")
    dim1 = D.with_registered(empty, b1, "name", ["work_id"])
    dim2 = D.with_registered(dim1, b2, "name", ["work_id"])
    got1, got2 = dict((n, i) for i, n in rows(dim1)), dict((n, i) for i, n in rows(dim2))
    assert all(got2[n] == i for n, i in got1.items())            # stored ids never change
    assert sorted(got2.values()) == list(range(1, len(got2) + 1))  # dense, gap-free
    # one pass over both batches gives the same ids (batches are in work order)
    both = D.with_registered(empty, b1.unionByName(b2), "name", ["work_id"])
    assert rows(both) == rows(dim2)
    assert D.register_names(dim2, b1.unionByName(b2), "name", ["work_id"]).count() == 0
