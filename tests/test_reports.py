from pyspark.sql import functions as F

from conftest import rows
from techmine.operators.ids import dense_ids, next_id
from techmine.operators.joins import pairs_within_groups
from techmine.plans import reports


def _model(spark):
    topic = spark.createDataFrame([(1, "AI"), (2, "DB"), (3, "")], "id long, name string")
    tech = spark.createDataFrame(
        [(10, "Python"), (11, "Java"), (12, "Python"), (13, "C"), (14, None)],
        "id long, name string")
    work = spark.createDataFrame([(100, 1), (101, 1), (102, 2), (103, 3), (104, None)],
                                 "id long, topic_id long")
    mention = spark.createDataFrame(
        [(100, 10), (100, 11), (100, 11), (101, 12), (101, 13), (102, 11), (102, 13),
         (103, 10), (104, 10), (100, 14)],
        "work_id long, technology_id long")
    return work, mention, topic, tech


def test_topic_tech_counts(spark):
    work, mention, topic, tech = _model(spark)
    out = reports.topic_tech_counts(work, mention, topic, tech)
    # empty topic name and null tech name have no label -> dropped
    assert rows(out) == [("AI", "C", 1), ("AI", "Java", 1), ("AI", "Python", 2),
                         ("DB", "C", 1), ("DB", "Java", 1)]


def _naive_pairs(work, mention, tech):
    m = (mention.join(work.select(F.col("id").alias("work_id"), "topic_id"), "work_id")
         .where(F.col("topic_id").isNotNull())
         .join(tech.where(F.col("name").isNotNull() & (F.col("name") != ""))
               .select(F.col("id").alias("technology_id"), "name"), "technology_id"))
    a = m.select(F.col("topic_id").alias("t"), F.col("technology_id").alias("ia"), F.col("name").alias("na"))
    b = m.select(F.col("topic_id").alias("t"), F.col("technology_id").alias("ib"), F.col("name").alias("nb"))
    return (a.join(b, "t").where(F.col("ia") != F.col("ib"))
             .groupBy(F.col("na").alias("tech_a"), F.col("nb").alias("tech_b"))
             .agg(F.countDistinct("t").alias("common_topics")))


def test_pairs_reduced_equals_naive(spark):
    work, mention, topic, tech = _model(spark)
    fast = reports.tech_pairs_shared_topics(work, mention, tech)
    assert rows(fast) == rows(_naive_pairs(work, mention, tech))
    got = {(a, b): n for a, b, n in rows(fast)}
    # two ids share the name Python inside topic AI -> (Python, Python) appears
    assert got[("Python", "Python")] == 1
    assert got[("Java", "Python")] == got[("Python", "Java")]


def test_pairs_split_hot_group(spark):
    items = spark.createDataFrame([(1, f"n{i}") for i in range(40)] + [(2, "a"), (2, "b")],
                                  "g long, k string")
    p = pairs_within_groups(items, "g", "k", bucket_rows=7)
    assert p.count() == 40 * 40 + 4
    assert p.where("g = 1").select("l_k", "r_k").distinct().count() == 1600


def test_top10_order(spark):
    work, mention, topic, tech = _model(spark)
    top = reports.tech_pairs_shared_topics(work, mention, tech, top=3).collect()
    assert [tuple(r) for r in top] == [("C", "Java", 2), ("Java", "C", 2), ("C", "Python", 1)]


def test_same_work_and_ranking(spark):
    work, mention, topic, tech = _model(spark)
    assert rows(reports.tech_pairs_same_work(mention, tech)) == [
        ("C", "Java", 1), ("C", "Python", 1), ("Java", "Python", 1)]
    assert rows(reports.tech_ranking(mention, tech)) == [("C", 2), ("Java", 2), ("Python", 4)]


def test_share_sums_to_one(spark):
    work, mention, topic, tech = _model(spark)
    out = reports.topic_tech_share(work, mention, topic, tech)
    sums = {t: s for t, s in rows(out.groupBy("topic_name").agg(F.sum("share")))}
    assert abs(sums["AI"] - 1.0) < 1e-12 and abs(sums["DB"] - 1.0) < 1e-12


def test_dense_ids_global_order(spark):
    df = spark.range(0, 5000).select((F.col("id") * 7919 % 5000).alias("k"),
                                     (F.col("id") % 13).alias("c"))
    out = dense_ids(df, [F.desc("c"), F.asc("k")], partitions=7)
    got = [tuple(r) for r in out.orderBy("id").select("c", "k").collect()]
    want = sorted([tuple(r) for r in df.select("c", "k").collect()], key=lambda r: (-r[0], r[1]))
    assert got == want
    ids = [r[0] for r in out.select("id").collect()]
    assert sorted(ids) == list(range(1, 5001))


def test_next_id(spark):
    empty = spark.createDataFrame([], "id string")
    assert next_id(empty) == 1
    base = spark.createDataFrame([("3",), ("x",), ("7",)], "id string")
    assert next_id(base) == 8


def test_same_work_pairs_with_a_hot_work(spark):
    tech = spark.createDataFrame([(i, f"t{i:03d}") for i in range(600)], "id long, name string")
    mention = spark.createDataFrame([(1, i) for i in range(600)] + [(2, 1), (2, 2), (3, 5), (3, 1)],
                                    "work_id long, technology_id long")
    fast = reports.tech_pairs_same_work(mention, tech)
    m = mention.join(tech.select(F.col("id").alias("technology_id"), "name"), "technology_id")
    a = m.select("work_id", F.col("name").alias("tech_a"))
    b = m.select("work_id", F.col("name").alias("tech_b"))
    naive = (a.join(b, "work_id").where(F.col("tech_a") < F.col("tech_b"))
              .groupBy("tech_a", "tech_b").agg(F.countDistinct("work_id").alias("shared_works")))
    assert fast.count() == 600 * 599 // 2
    assert fast.exceptAll(naive).count() == 0 and naive.exceptAll(fast).count() == 0
    assert rows(fast.where("tech_a = 't001' AND tech_b IN ('t002', 't005')")) == [
        ("t001", "t002", 2), ("t001", "t005", 2)]


def test_one_iri_with_two_names_gives_no_pair(spark):
    work = spark.createDataFrame([(1, 10)], "id long, topic_id long")
    tech = spark.createDataFrame([(5, "A"), (5, "B"), (6, "C")], "id long, name string")
    mention = spark.createDataFrame([(1, 5)], "work_id long, technology_id long")
    assert rows(reports.tech_pairs_shared_topics(work, mention, tech)) == []
    both = spark.createDataFrame([(1, 5), (1, 6)], "work_id long, technology_id long")
    assert rows(reports.tech_pairs_shared_topics(work, both, tech)) == rows(_naive_pairs(work, both, tech))
