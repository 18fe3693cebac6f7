"""SNK4 with a stored key index: a load checks the rows that it adds, not what is stored.

Every committed load has, beside its part of the five tables, the keys that it added:
the ids of each table and the dois of works, written by kind and block.  Ids go to
blocks of ``ID_BLOCK`` numbers, so that a load with new ids and references to some old
rows opens those blocks alone; dois go to ``VALUE_BLOCKS`` blocks by hash.  The keys are
whole, so the check is exact.

What is stored keeps every rule (each load was checked), so a load breaks one exactly if
its added rows do: among themselves, or against known keys.  The report therefore
equals ``model_report`` over the stored and added rows together.

A load is one entry of a commit log.  Of two loads that were checked against the same
state one is refused.  Folders without an entry are never read.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from techmine.operators import constraints as C
from techmine.session import written
from techmine.sinks.tables import MODEL_SCHEMAS, first_rows, row_counts
from techmine.streaming.commit_log import CommitLog

ID_BLOCK = 1 << 20
VALUE_BLOCKS = 256
# Blocks that are named in the scan's partition filter; a load that touches more reads all.
LISTED_BLOCKS = 10_000
KEYS = "kind string, block long, k string"
UNIQUE = (("work", "doi"),)


def _key_rows(df: DataFrame, column: str, kind: str) -> DataFrame:
    c = F.col(column)
    block = F.floor(c.cast("long") / ID_BLOCK) if kind.endswith(".id") else F.pmod(F.xxhash64(c), F.lit(VALUE_BLOCKS))
    return df.where(c.isNotNull()).select(F.lit(kind).alias("kind"), block.cast("long").alias("block"),
                                          c.cast("string").alias("k"))


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def own_keys(tables: dict[str, DataFrame]) -> DataFrame:
    """(kind, block, k): the ids and unique values of the rows of ``tables``."""
    return _union([_key_rows(df, "id", f"{t}.id") for t, df in tables.items()]
                  + [_key_rows(tables[t], c, f"{t}.{c}") for t, c in UNIQUE])


def _asked_keys(tables: dict[str, DataFrame]) -> DataFrame:
    refs = [_key_rows(tables[child], fk, f"{parent}.id") for child, fk, parent, _ in C.REFERENCES]
    return _union([own_keys(tables), *refs]).distinct()


def stored_keys(spark: SparkSession, root: str) -> DataFrame:
    """The key index of all committed loads."""
    log = CommitLog(spark, root)
    loads = [_keys_of(log, e["folder"]) for e in log.entries()]
    if not loads:
        return spark.createDataFrame([], KEYS)
    return (spark.read.schema("k string, load string, kind string, block long").option("basePath", f"{log.root}/keys")
                 .parquet(*loads).select("kind", "block", "k"))


def _keys_of(log: CommitLog, folder: str) -> str:
    """Where the keys of the load in ``folder`` are; all loads share one partitioned root."""
    return f"{log.root}/keys/load={folder.rsplit('/', 1)[1]}"


def _in_blocks(asked: DataFrame) -> Column:
    """The partitions of the index that ``asked`` touches, as a filter."""
    pairs = asked.select("kind", "block").distinct().limit(LISTED_BLOCKS + 1).collect()
    if len(pairs) > LISTED_BLOCKS:
        return F.lit(True)
    kinds: dict[str, list[int]] = {}
    for r in pairs:
        kinds.setdefault(r["kind"], []).append(r["block"])
    out = F.lit(False)
    for kind, blocks in sorted(kinds.items()):
        out = out | ((F.col("kind") == kind) & F.col("block").isin(sorted(blocks)))
    return out


def known_keys(index: DataFrame, asked: DataFrame) -> DataFrame:
    """(kind, k): the asked keys that are stored, read from the touched blocks."""
    return index.where(_in_blocks(asked)).join(asked, ["kind", "block", "k"], "left_semi").select("kind", "k")


def additions_report(added: dict[str, DataFrame], known: DataFrame) -> DataFrame:
    """(check, n) as ``model_report`` gives it, from the added rows and known keys."""
    def keys(kind: str) -> DataFrame:
        return known.where(F.col("kind") == kind).select("k")

    more = {}
    for t, c in UNIQUE:
        held = (added[t].where(F.col(c).isNotNull()).groupBy(F.col(c).alias("k")).agg(F.count(F.lit(1)).alias("n"))
                        .join(keys(f"{t}.{c}").withColumn("taken", F.lit(True)), "k", "left"))
        more[f"{t}.{c}.unique"] = held.where((F.col("n") > 1) | F.col("taken"))
    for child, fk, parent, _ in C.REFERENCES:
        there = keys(f"{parent}.id").union(added[parent].select(F.col("id").cast("string")))
        ref = added[child].where(F.col(fk).isNotNull()).select(F.col(fk).cast("string").alias("k"))
        more[f"{child}.{fk.removesuffix('_id')}.fk"] = ref.join(there, "k", "left_anti")
    return _union([C.count_violations(more), *row_counts(added)])


def load_indexed(spark: SparkSession, root: str, incoming: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Insert-ignore of the five tables in one commit, checked through the key index.

    Returns the added rows.  Raises ``ConstraintError``, and nothing counts, if a rule
    breaks or another load was committed meanwhile."""
    log = CommitLog(spark, root)
    seq = len(log.entries())
    firsts = {t: written(first_rows(incoming[t]), f"first-{t}") for t in MODEL_SCHEMAS}
    known = written(known_keys(stored_keys(spark, root), written(_asked_keys(firsts), "asked-keys")), "known-keys")
    added = {}
    for t, df in firsts.items():
        there = known.where(F.col("kind") == f"{t}.id").select(F.col("k").cast("long").alias("id"))
        added[t] = df.join(there, "id", "left_anti").select(*MODEL_SCHEMAS[t].fieldNames())
    C.require_clean(additions_report(added, known))
    folder = f"{log.root}/data/{seq:012d}-{uuid.uuid4().hex[:12]}"
    for t, df in added.items():
        df.write.parquet(f"{folder}/{t}")
    rows = {t: spark.read.schema(s).parquet(f"{folder}/{t}") for t, s in MODEL_SCHEMAS.items()}
    (own_keys(rows).repartition("kind", "block").sortWithinPartitions("kind", "block", "k")
                      .write.partitionBy("kind", "block").parquet(_keys_of(log, folder)))
    if not log.append({"seq": seq, "batch": f"load {seq}", "folder": folder, "first_name": 0, "n_names": 0,
                       "first_link": 0, "n_links": 0}):
        raise C.ConstraintError("another load was committed meanwhile")
    return rows


def indexed_tables(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """The five tables over all committed loads below ``root``."""
    folders = [e["folder"] for e in CommitLog(spark, root).entries()]
    return {t: spark.read.schema(s).parquet(*[f"{f}/{t}" for f in folders]) if folders else spark.createDataFrame([], s)
            for t, s in MODEL_SCHEMAS.items()}
