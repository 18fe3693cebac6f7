"""Report queries (QRY1-QRY5) over the relational model.

Inputs use the English table shapes of ``techmine.schemas``:
work(id, topic_id, ...), mention(work_id, technology_id), topic(id, name),
technology(id, name).  Grouping is by *name* (equal names merge across ids),
identity by id, everything case-sensitive.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from techmine.operators.joins import pairs_within_groups
from techmine.session import written


def _named(df: DataFrame, id_alias: str, name_alias: str) -> DataFrame:
    # A missing or empty name has no label in the graph (FIL9/FIL10).
    return (df.where(F.col("name").isNotNull() & (F.col("name") != ""))
              .select(F.col("id").alias(id_alias), F.col("name").alias(name_alias)))


def topic_tech_counts(work: DataFrame, mention: DataFrame, topic: DataFrame,
                      technology: DataFrame) -> DataFrame:
    """QRY1: distinct works per (topic name, technology name).

    The (work, topic name) of works and the (work, technology name) of mentions are made
    distinct first, so their join has each (topic, technology, work) once and the counts
    are sums: no task holds a table of all triples that it has seen.
    """
    w = (work.where(F.col("topic_id").isNotNull()).select(F.col("id").alias("work_id"), "topic_id")
             .join(_named(topic, "topic_id", "topic_name"), "topic_id").select("work_id", "topic_name").distinct())
    # One shuffle by work serves the distinct rows and the join.
    m = (mention.where(F.col("work_id").isNotNull()).select("work_id", F.col("technology_id").alias("tech_id"))
                .join(_named(technology, "tech_id", "tech_name"), "tech_id").select("work_id", "tech_name")
                .repartition("work_id").groupBy("work_id").agg(F.collect_set("tech_name").alias("names")))
    rows = m.join(w, "work_id").select("topic_name", F.explode("names").alias("tech_name"))
    return rows.groupBy("topic_name", "tech_name").agg(F.count(F.lit(1)).alias("shared_works"))


def order_by_count(df: DataFrame, count_col: str, *names: str) -> DataFrame:
    """SRT2: count descending, names break ties (the reference leaves them open)."""
    return df.orderBy(F.desc(count_col), *[F.asc(n) for n in names])


def shared_group_pairs(rows: DataFrame, group: str, iri: str, name: str,
                       top: int | None = None) -> DataFrame:
    """QRY2 core on (group, iri, name) rows: name pairs by distinct shared groups.

    Same answer as the literal self-join on ``group`` with ``a.iri != b.iri``,
    but the join input is first reduced to one row per (group, name) carrying
    n = distinct iris under that name and i = the smallest iri.  A pair (A, B)
    is valid unless both names denote the same single iri.  The join size is
    then bounded by the names per group, not by the number of rows.
    """
    rows = (rows.where(F.col(group).isNotNull() & F.col(name).isNotNull())
                .select(group, F.col(name).alias("nm"), F.col(iri).alias("iri")))
    if isinstance(rows.schema["iri"].dataType, StringType):
        g = _single_iris(rows, group)
    else:
        g = rows.groupBy(group, "nm").agg(F.countDistinct("iri").alias("n"), F.min("iri").alias("i"))
    if top is not None:
        return _top_pairs(g, group, top)
    return _scored(pairs_within_groups(g, group, "nm"))


def _single_iris(rows: DataFrame, group: str) -> DataFrame:
    """(group, nm, n, i) of rows (group, nm, iri) with text iris; n is 2, and i null,
    for more than one iri.

    Iris of unequal hashes differ, so most names need only the hashes' bounds, which are
    summed up where the rows are, without a sort of texts.  Only the names whose iris
    all have one hash are looked at again, by the iris themselves.
    """
    rows = written(rows, "group-iris")  # read twice
    h = F.when(F.col("iri").isNotNull(), F.xxhash64("iri"))
    bounds = written(rows.groupBy(group, "nm").agg(F.min(h).alias("low"), F.max(h).alias("high")), "iri-bounds")
    many = bounds.where("low != high").select(group, "nm", F.lit(2).cast("long").alias("n"),
                                              F.lit(None).cast("string").alias("i"))
    one_hash = bounds.where("low = high").select(group, "nm")
    none = bounds.where("low IS NULL").select(group, "nm", F.lit(0).cast("long").alias("n"),
                                              F.lit(None).cast("string").alias("i"))
    exact = rows.join(one_hash, [group, "nm"], "left_semi").groupBy(group, "nm").agg(
        F.countDistinct("iri").alias("n"), F.min("iri").alias("i"))
    return many.unionByName(none).unionByName(exact)


def _scored(pairs: DataFrame) -> DataFrame:
    valid = pairs.where(~((F.col("l_n") == 1) & (F.col("r_n") == 1) & (F.col("l_i") == F.col("r_i"))))
    return (valid.groupBy(F.col("l_nm").alias("tech_a"), F.col("r_nm").alias("tech_b"))
                 .agg(F.count(F.lit(1)).alias("common_topics")))


# Names that are paired first, times ``top``, to learn what the last place takes.
FIRST_NAMES = 4


def _top_pairs(g: DataFrame, group: str, top: int) -> DataFrame:
    """The first ``top`` pairs by count, then names, without pairing all names.

    A pair shares at most as many groups as the rarer of its names has.  The pairs
    among the most frequent names give ``top`` candidates; the last one (count ``low``,
    first name ``last``) bounds all others: a pair that comes before it has two names
    with more than ``low`` groups, or two with at least ``low`` and a first name up to
    ``last``.  Only those are paired, so the answer is exact.
    """
    sizes = g.groupBy("nm").agg(F.count(F.lit(1)).alias("c"))
    g = g.join(sizes, "nm").checkpoint(eager=True)
    first = sizes.orderBy(F.desc("c"), "nm").limit(FIRST_NAMES * top).select("nm")
    seeds = _scored(pairs_within_groups(g.join(F.broadcast(first), "nm", "left_semi"), group, "nm"))
    best = order_by_count(seeds, "common_topics", "tech_a", "tech_b").limit(top).collect()  # ``top`` rows
    if len(best) < top:  # too few pairs to bound the others
        pairs = pairs_within_groups(g, group, "nm")
    else:
        low, last = best[-1]["common_topics"], best[-1]["tech_a"]
        pairs = pairs_within_groups(g.where(F.col("c") >= low), group, "nm",
                                    left_where=(F.col("c") > low) | (F.col("nm") <= last))
        pairs = pairs.where((F.least("l_c", "r_c") > low) | (F.col("l_nm") <= last))
    return order_by_count(_scored(pairs), "common_topics", "tech_a", "tech_b").limit(top)


def tech_pairs_shared_topics(work: DataFrame, mention: DataFrame,
                             technology: DataFrame, top: int | None = None) -> DataFrame:
    """QRY2: technology-name pairs by the number of topics where both occur."""
    m = mention.select("work_id", F.col("technology_id").alias("tech_id"))
    w = work.where(F.col("topic_id").isNotNull()).select(F.col("id").alias("work_id"), "topic_id")
    names = _named(technology, "tech_id", "nm")
    rows = m.join(w, "work_id").join(names, "tech_id").select("topic_id", "tech_id", "nm")
    return shared_group_pairs(rows, "topic_id", "tech_id", "nm", top=top)


def tech_pairs_same_work(mention: DataFrame, technology: DataFrame) -> DataFrame:
    """QRY3: unordered technology-name pairs by the number of works naming both."""
    m = mention.select("work_id", F.col("technology_id").alias("tech_id"))
    wn = (m.join(_named(technology, "tech_id", "nm"), "tech_id")
           .select("work_id", "nm").distinct())
    pairs = pairs_within_groups(wn, "work_id", "nm")
    return (pairs.where(F.col("l_nm") < F.col("r_nm"))
                 .groupBy(F.col("l_nm").alias("tech_a"), F.col("r_nm").alias("tech_b"))
                 .agg(F.count(F.lit(1)).alias("shared_works")))


def tech_ranking(mention: DataFrame, technology: DataFrame, top: int | None = None) -> DataFrame:
    """QRY4: distinct works per technology name, most used first."""
    m = mention.select("work_id", F.col("technology_id").alias("tech_id"))
    out = (m.join(_named(technology, "tech_id", "tech_name"), "tech_id")
            .groupBy("tech_name").agg(F.countDistinct("work_id").alias("n_works")))
    if top is not None:
        out = order_by_count(out, "n_works", "tech_name").limit(top)
    return out


def topic_tech_share(work: DataFrame, mention: DataFrame, topic: DataFrame,
                     technology: DataFrame) -> DataFrame:
    """QRY5: QRY1 plus each technology's share of the topic's (work, tech) counts."""
    counts = topic_tech_counts(work, mention, topic, technology)
    total = F.sum("shared_works").over(Window.partitionBy("topic_name"))
    return (counts.withColumn("topic_total", total.cast("long"))
                  .withColumn("share", F.col("shared_works") / F.col("topic_total")))
