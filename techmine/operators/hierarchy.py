"""Topic hierarchy: build (HI1), leaves (HI2), transitive closure and roll-up
(HI3), listing with depth and path (HI4).

The closure doubles its reach in each round: the pairs at the largest distance
are joined with all pairs and those not seen before are kept (anti-join), so it
ends on cyclic input too, and a hierarchy of depth d takes about log2(d) rounds.
Each round's result is checkpointed to the shared checkpoint folder to cut lineage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from techmine.functions.text import strip_ws
from techmine.operators.ids import dense_ids
from techmine.operators.joins import broadcast_if_small

# The three base topics, root first, in list order.
BASE_TOPICS = ["Physical Sciences", "Computer Science", "Artificial Intelligence"]


def _trim_ws(c):
    return strip_ws(c)


def ensure_base_topics(topic: DataFrame, base: list[str] = BASE_TOPICS) -> DataFrame:
    """REG2: append base names missing from ``topic`` (matched after trimming),
    ids continuing after the largest id, in list order.  Existing ids stay."""
    spark = topic.sparkSession
    wanted = spark.createDataFrame([(i, n) for i, n in enumerate(base)], "ord int, name string")
    present = topic.select(_trim_ws(F.col("name")).alias("name"))
    missing = wanted.join(present, "name", "left_anti")
    top = topic.agg(F.max("id")).first()[0] or 0  # one number
    added = missing.select((F.lit(int(top)) + F.row_number().over(_by_ord())).cast("long").alias("id"), "name")
    return topic.select(F.col("id").cast("long"), "name").unionByName(added)


def _by_ord():
    from pyspark.sql import Window
    # At most len(base) rows: a one-partition window over a fixed-size list.
    return Window.orderBy("ord")


def build_hierarchy(topic: DataFrame, base: list[str] = BASE_TOPICS) -> DataFrame:
    """HI1: root -> ... -> last base topic chain, and the last base topic is
    parent of every other topic.  Topics are keyed by trimmed name; of two
    names equal after trimming the larger id (the later row) is used.  Edge
    ids follow (parent, child) order.  Returns (id, parent_id, child_id)."""
    by_name = (topic.groupBy(_trim_ws(F.col("name")).alias("name"))
                    .agg(F.max("id").cast("long").alias("tid")))
    spark = topic.sparkSession
    chain = spark.createDataFrame(
        [(base[i], base[i + 1]) for i in range(len(base) - 1)], "pn string, cn string")
    ids = by_name.where(F.col("name").isin(base))  # at most len(base) rows
    ids_b = F.broadcast(ids)
    base_edges = (chain.join(ids_b.withColumnRenamed("name", "pn").withColumnRenamed("tid", "parent_id"), "pn")
                       .join(ids_b.withColumnRenamed("name", "cn").withColumnRenamed("tid", "child_id"), "cn")
                       .select("parent_id", "child_id"))
    last = ids.where(F.col("name") == base[-1]).first()  # one row
    others = (by_name.where(~F.col("name").isin(base) & F.lit(last is not None))
                     .select(F.lit(last["tid"] if last else None).cast("long").alias("parent_id"),
                             F.col("tid").alias("child_id")))
    edges = base_edges.unionByName(others).distinct()
    return dense_ids(edges, ["parent_id", "child_id"]).select("id", "parent_id", "child_id")


def leaf_topics(topic: DataFrame, edge: DataFrame) -> DataFrame:
    """HI2: topics that are nobody's parent."""
    return topic.join(edge.select(F.col("parent_id").alias("id")), "id", "left_anti")


def closure(edge: DataFrame, paths: bool = True) -> DataFrame:
    """HI3/HI4: (ancestor_id, descendant_id, depth, path) over parent->child
    edges; depth is the shortest distance, path the smallest id path (root
    side first) among shortest ones.  ``paths=False`` leaves the paths out."""
    e = (edge.select(F.col("parent_id").cast("long").alias("ancestor_id"), F.col("child_id").cast("long").alias("descendant_id"))
             .where(F.col("ancestor_id").isNotNull() & F.col("descendant_id").isNotNull()).distinct())
    found = e.withColumn("depth", F.lit(1))
    if paths:
        found = found.withColumn("path", F.array("ancestor_id", "descendant_id"))
    found = found.checkpoint(eager=True)
    reach = 1
    while True:
        new = _doubled(found, reach).checkpoint(eager=True)
        deepest = new.agg(F.max("depth")).first()[0]
        if deepest is None:
            return found
        found = found.unionByName(new)
        reach *= 2
        if deepest < reach:
            return found


def _doubled(found: DataFrame, reach: int) -> DataFrame:
    """The pairs at distances from ``reach`` + 1 to twice ``reach``, from all those up
    to ``reach``: each has a node at distance ``reach`` on every shortest path, and
    the smallest shortest path is made of smallest ones."""
    left = found.where(F.col("depth") == reach).withColumnsRenamed({"descendant_id": "__mid", "path": "__path"}).drop("depth")
    step = left.join(found.withColumnRenamed("ancestor_id", "__mid"), "__mid").withColumn("depth", F.col("depth") + reach)
    return _shortest(_path_joined(step).join(found.select(*PAIR), PAIR, "left_anti"))


PAIR = ["ancestor_id", "descendant_id"]


def _path_joined(step: DataFrame) -> DataFrame:
    if "__path" not in step.columns:
        return step.select(*PAIR, "depth")
    tail = F.slice("path", F.lit(2), F.size("path") - 1)
    return step.select(*PAIR, "depth", F.concat("__path", tail).alias("path"))


def _shortest(pairs: DataFrame) -> DataFrame:
    """Per pair the smallest depth and, of equal ones, the smallest path."""
    rest = [c for c in pairs.columns if c not in PAIR]
    return pairs.groupBy(*PAIR).agg(F.min(F.struct(*rest)).alias("b")).select(*PAIR, *[F.col(f"b.{c}") for c in rest])


def extended_closure(closed: DataFrame, new_edges: DataFrame) -> DataFrame:
    """The closure (with paths) after adding ``new_edges``, from the closure before.

    Pairs that use one new edge come from what reaches its parent and what its child
    reaches; these are joined with each other until no pair improves, which takes as
    many rounds as the logarithm of the new edges on a path.  Old pairs away from the
    new edges are only read."""
    e = (new_edges.select(F.col("parent_id").cast("long").alias("__p"), F.col("child_id").cast("long").alias("__c"))
                  .where(F.col("__p").isNotNull() & F.col("__c").isNotNull()).distinct().checkpoint(eager=True))

    def with_self(node: str) -> DataFrame:
        one = e.select(F.col(node).alias("ancestor_id")).distinct()
        return one.select("ancestor_id", F.col("ancestor_id").alias("descendant_id"), F.lit(0).alias("depth"),
                          F.array("ancestor_id").alias("path"))

    above = closed.join(e.select(F.col("__p").alias("descendant_id")).distinct(), "descendant_id", "left_semi")
    below = closed.join(e.select(F.col("__c").alias("ancestor_id")).distinct(), "ancestor_id", "left_semi")
    above = above.unionByName(with_self("__p")).select("ancestor_id", F.col("descendant_id").alias("__p"),
                                                       F.col("depth").alias("__up"), F.col("path").alias("__path"))
    below = below.unionByName(with_self("__c")).withColumnRenamed("ancestor_id", "__c")
    through = _shortest(e.join(above, "__p").join(below, "__c").select(
        *PAIR, (F.col("__up") + 1 + F.col("depth")).alias("depth"), F.concat("__path", "path").alias("path")))
    through = through.checkpoint(eager=True)
    while True:
        left = through.withColumnsRenamed({"descendant_id": "__mid", "path": "__path", "depth": "__up"})
        step = left.join(through.withColumnRenamed("ancestor_id", "__mid"), "__mid").withColumn(
            "depth", F.col("__up") + F.col("depth"))
        better = _shortest(_path_joined(step).unionByName(through)).checkpoint(eager=True)
        if better.join(through, [*PAIR, "depth", "path"], "left_anti").isEmpty():
            break
        through = better
    return _shortest(closed.select(*PAIR, "depth", "path").unionByName(through))


def cycles(closure_df: DataFrame) -> DataFrame:
    """Topics that are their own ancestor (the DDL only forbids self edges)."""
    return closure_df.where(F.col("ancestor_id") == F.col("descendant_id"))


def rollup(work: DataFrame, closure_df: DataFrame, include_self: bool = True) -> DataFrame:
    """HI3: distinct works per topic counting the works of all descendants.

    The closure is bounded by topics x depth and is broadcast after a size
    check; countDistinct's first phase is keyed by (ancestor, work), so the
    root (which sees every work) is still spread over tasks.
    """
    pairs = closure_df.select("ancestor_id", "descendant_id")
    if include_self:
        selfs = (closure_df.select(F.col("ancestor_id").alias("x"))
                 .unionByName(closure_df.select(F.col("descendant_id").alias("x"))).distinct()
                 .select(F.col("x").alias("ancestor_id"), F.col("x").alias("descendant_id")))
        pairs = pairs.unionByName(selfs)
    w = work.where(F.col("topic_id").isNotNull()).select(F.col("id").alias("work_id"),
                                                         F.col("topic_id").alias("descendant_id"))
    return (w.join(broadcast_if_small(pairs), "descendant_id")
             .groupBy(F.col("ancestor_id").alias("topic_id"))
             .agg(F.countDistinct("work_id").alias("n_works")))
