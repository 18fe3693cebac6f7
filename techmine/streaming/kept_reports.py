"""QRY1 and QRY2 kept up to date: every drop of works and mentions changes the stored
results by what it adds, without reading old mentions again.

A drop may bring mentions of works that landed before, links that are stored already,
and mentions whose work lands later.  Links and works are stored by blocks of work ids;
a drop opens the blocks of its own works alone and there looks at these works only.  It
then knows which (work, name) are counted for the first time (QRY1) and which
technologies a topic has not had (QRY2).  New technologies of a topic change pairs only
with names of that topic, so only these are paired again.

Stored results are as large as the answers, not as the mentions; each drop writes them
anew, with its links and works, as one entry of a commit log.  Drops that are in the log
are not done again, folders without an entry are never read, and of two drops that land at
once the second one starts over from the new state.

Rules: of a work id the first drop counts (in it, the smallest topic); null ids make no link; a work without a topic is
counted nowhere; every technology and topic that is referred to must be there with its
name when its links land (else ``ConstraintError``), and names do not change.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from techmine.operators.constraints import ConstraintError
from techmine.operators.joins import pairs_within_groups
from techmine.session import written
from techmine.streaming.commit_log import CommitLog

WORK_BLOCK = 1 << 20
# Blocks that are named in the scan's partition filter; a drop that touches more reads all.
LISTED_BLOCKS = 10_000
# Stored by work block, one part per drop.
PARTS = {"works": "work_id long, topic_id long, drop string, block long",
         "links": "work_id long, tech_id long, nm string, drop string, block long"}
# Stored whole, a new version per drop.
RESULTS = {"counts": "topic_name string, tech_name string, shared_works long",
           "members": "topic_id long, tech_id long, nm string",
           "groups": "topic_id long, nm string, n long, i long",
           "pairs": "tech_a string, tech_b string, common_topics long"}


def _block(c: str) -> Column:
    return F.floor(F.col(c) / WORK_BLOCK).cast("long")


def _part(log: CommitLog, name: str, folder: str) -> str:
    return f"{log.root}/{name}/drop={folder.rsplit('/', 1)[1]}"


def _stored_part(log: CommitLog, name: str, entries: list[dict], touched: Column) -> DataFrame:
    """Rows of all drops in the blocks of ``touched``."""
    spark, columns = log.spark, [c.split()[0] for c in PARTS[name].split(", ")][:-2]
    if not entries:
        return spark.createDataFrame([], PARTS[name]).select(*columns)
    return (spark.read.schema(PARTS[name]).option("basePath", f"{log.root}/{name}")
                 .parquet(*[_part(log, name, e["folder"]) for e in entries]).where(touched).select(*columns))


def _result(log: CommitLog, name: str, entries: list[dict]) -> DataFrame:
    if not entries:
        return log.spark.createDataFrame([], RESULTS[name])
    return log.spark.read.schema(RESULTS[name]).parquet(f"{entries[-1]['folder']}/{name}")


def _touched_blocks(works: DataFrame) -> Column:
    found = works.select(_block("work_id").alias("b")).distinct().limit(LISTED_BLOCKS + 1).collect()
    return F.col("block").isin(sorted(r["b"] for r in found)) if len(found) <= LISTED_BLOCKS else F.lit(True)


def _require_there(rows: DataFrame, key: str, dimension: DataFrame, what: str) -> None:
    lost = rows.join(dimension.select(F.col("id").alias(key)), key, "left_anti").select(key).limit(1).collect()
    if lost:
        raise ConstraintError(f"{what} {lost[0][0]} is not there")


def _valid(n: str, i: str) -> Column:
    """Whether a pair of names counts in a topic: not if both are one single technology."""
    one = (F.col(f"l_{n}") == 1) & (F.col(f"r_{n}") == 1) & (F.col(f"l_{i}") == F.col(f"r_{i}"))
    return F.when(F.col(f"l_{n}").isNull() | F.col(f"r_{n}").isNull() | one, 0).otherwise(1)


def changed_pairs(groups: DataFrame) -> DataFrame:
    """(tech_a, tech_b, change) from (topic_id, nm, n, i, old_n, old_i) of the topics that
    changed; names without a change are paired with changed ones only."""
    changed = ~(F.col("n").eqNullSafe(F.col("old_n")) & F.col("i").eqNullSafe(F.col("old_i")))
    items = groups.withColumn("new", changed)
    change = (_valid("n", "i") - _valid("old_n", "old_i")).cast("long").alias("change")
    pairs = pairs_within_groups(items, "topic_id", "nm", left_where=F.col("new")).select("l_nm", "r_nm", "r_new", change)
    pairs = pairs.where(F.col("change") != 0)
    # Both orders of a pair change alike.
    sides = F.when(F.col("r_new"), F.array(F.struct(F.col("l_nm").alias("a"), F.col("r_nm").alias("b")))).otherwise(
        F.array(F.struct(F.col("l_nm").alias("a"), F.col("r_nm").alias("b")),
                F.struct(F.col("r_nm").alias("a"), F.col("l_nm").alias("b"))))
    return (pairs.select(F.explode(sides).alias("p"), "change").groupBy(F.col("p.a").alias("tech_a"), F.col("p.b").alias("tech_b"))
                 .agg(F.sum("change").alias("change")))


def _added(stored: DataFrame, delta: DataFrame, keys: list[str], value: str) -> DataFrame:
    return (stored.unionByName(delta.withColumnRenamed("change", value)).groupBy(*keys)
                  .agg(F.sum(value).alias(value)).where(F.col(value) != 0))


def land(spark: SparkSession, root: str, drop_id: str, work: DataFrame, mention: DataFrame, topic: DataFrame,
         technology: DataFrame) -> bool:
    """Add a drop of works (id, topic_id) and mentions (work_id, technology_id) to the
    results stored below ``root``.  False if the drop is in the log already."""
    log = CommitLog(spark, root)
    names = technology.where(F.col("name").isNotNull()).select(F.col("id").alias("tech_id"), F.col("name").alias("nm"))
    came_works = written(work.where(F.col("id").isNotNull()).groupBy(F.col("id").cast("long").alias("work_id"))
                             .agg(F.min("topic_id").cast("long").alias("topic_id")), "came-works")
    came_links = written(mention.select(F.col("work_id").cast("long").alias("work_id"), F.col("technology_id").cast("long")
                                        .alias("tech_id")).dropna().distinct(), "came-links")
    _require_there(came_links, "tech_id", technology, "technology")
    _require_there(came_works.where(F.col("topic_id").isNotNull()), "topic_id", topic, "topic")
    own = written(came_works.select("work_id").union(came_links.select("work_id")).distinct(), "own")
    blocks = _touched_blocks(own)
    while True:
        entries = log.entries()
        if any(e["batch"] == drop_id for e in entries):
            return False
        seq = len(entries)
        folder = f"{log.root}/data/{seq:012d}-{uuid.uuid4().hex[:12]}"
        old_works, old_links = (written(_stored_part(log, t, entries, blocks).join(own, "work_id", "left_semi"), f"old-{t}")
                                for t in ("works", "links"))
        works = came_works.join(old_works, "work_id", "left_anti")
        links = written(came_links.join(old_links, ["work_id", "tech_id"], "left_anti").join(names, "tech_id")
                                  .select("work_id", "tech_id", "nm"), "new-links")
        for name, rows in (("works", works), ("links", links)):
            (rows.withColumn("block", _block("work_id")).repartition("block", F.pmod(F.xxhash64("work_id"), F.lit(8)))
                 .write.partitionBy("block").parquet(_part(log, name, folder)))

        there = old_works.unionByName(works).where(F.col("topic_id").isNotNull())
        now = written(old_links.unionByName(links).where(F.col("nm") != "").join(there, "work_id"), "now")
        before = old_links.join(old_works.where(F.col("topic_id").isNotNull()), "work_id").select("work_id", "nm")
        counted = now.select("work_id", "topic_id", "nm").distinct().join(before, ["work_id", "nm"], "left_anti")
        titles = topic.where(F.col("name") != "").select(F.col("id").cast("long").alias("topic_id"),
                                                         F.col("name").alias("topic_name"))
        delta = (counted.groupBy("topic_id", "nm").agg(F.count(F.lit(1)).alias("change")).join(titles, "topic_id")
                        .select("topic_name", F.col("nm").alias("tech_name"), "change"))
        _added(_result(log, "counts", entries), delta, ["topic_name", "tech_name"], "shared_works").write.parquet(
            f"{folder}/counts")

        members = _result(log, "members", entries)
        fresh = written(now.select("topic_id", "tech_id", "nm").distinct()
                           .join(members, ["topic_id", "tech_id"], "left_anti"), "fresh")
        members.unionByName(fresh).write.parquet(f"{folder}/members")
        more = fresh.groupBy("topic_id", "nm").agg(F.count(F.lit(1)).alias("more"), F.min("tech_id").alias("least"))
        groups = written(_result(log, "groups", entries).withColumnsRenamed({"n": "old_n", "i": "old_i"})
                  .join(more, ["topic_id", "nm"], "full")
                  .select("topic_id", "nm", (F.coalesce("old_n", F.lit(0)) + F.coalesce("more", F.lit(0))).alias("n"),
                          F.least("old_i", "least").alias("i"), "old_n", "old_i"), "groups")
        groups.select("topic_id", "nm", "n", "i").write.parquet(f"{folder}/groups")
        moved = groups.join(fresh.select("topic_id").distinct(), "topic_id", "left_semi")
        _added(_result(log, "pairs", entries), changed_pairs(moved), ["tech_a", "tech_b"], "common_topics").write.parquet(
            f"{folder}/pairs")
        if log.append({"seq": seq, "batch": drop_id, "folder": folder, "first_name": 0, "n_names": 0, "first_link": 0,
                       "n_links": links.count()}):
            return True
        # Another drop landed first: what it brought counts as stored now.


def kept_topic_tech_counts(spark: SparkSession, root: str) -> DataFrame:
    """QRY1 as stored by the last drop."""
    log = CommitLog(spark, root)
    return _result(log, "counts", log.entries())


def kept_tech_pairs(spark: SparkSession, root: str) -> DataFrame:
    """QRY2 as stored by the last drop."""
    log = CommitLog(spark, root)
    return _result(log, "pairs", log.entries())
