"""Table sinks: overwrite (SNK1), append (SNK2), append-unseen (SNK3) and the
checked insert-ignore load of the five tables (SNK4), plus resume (INC1)."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from techmine import schemas as SC
from techmine.operators import constraints as C
from techmine.session import shared_dir, written
from techmine.sources.csv_tables import POSITION

# The five stored tables, in the order they are loaded.
MODEL_SCHEMAS = {"topic": SC.TOPIC, "edge": SC.TOPIC_EDGE, "work": SC.WORK, "technology": SC.TECHNOLOGY,
                 "mention": SC.MENTION}


def first_per_key(df: DataFrame, key: str, order_cols: list[str]) -> DataFrame:
    """WIN2: the first row per key in ``order_cols`` order.

    ``min`` over a struct led by the order columns is a partial aggregate: a
    key repeated in a third of the rows is combined map-side, not sorted in
    one task as a per-key window would.
    """
    rest = [c for c in df.columns if c not in order_cols]
    firsts = (df.groupBy(F.col(key).alias("__key"))
                .agg(F.min(F.struct(*order_cols, *rest)).alias("__row")))
    return firsts.select(*[F.col(f"__row.{c}").alias(c) for c in df.columns])


def first_rows(incoming: DataFrame, key: str = "id", order_cols: list[str] | None = None) -> DataFrame:
    """The row per key that an insert takes: the first by ``order_cols``."""
    order_cols = order_cols or ([POSITION] if POSITION in incoming.columns else list(incoming.columns))
    return first_per_key(incoming, key, order_cols).drop(POSITION)


def insert_ignore(existing: DataFrame, incoming: DataFrame, key: str = "id",
                  order_cols: list[str] | None = None) -> DataFrame:
    """SNK4 per table: INSERT ... ON CONFLICT (key) DO NOTHING.

    Returns the rows that the insert adds: the first incoming row per key,
    minus keys already stored.  "First" is by ``order_cols``: the position in the
    input files where the reader carried it (``POSITION``), else all columns.  A
    null key stays in the result, so that the key check (CON1) reports it.
    """
    return first_rows(incoming, key, order_cols).join(existing.select(key), key, "left_anti")


def append_unseen(existing: DataFrame, incoming: DataFrame, key: str,
                  order_cols: list[str]) -> DataFrame:
    """SNK3: rows whose key is not stored yet; of repeated keys in the batch
    only the first is appended (each append sees the earlier ones)."""
    firsts = first_per_key(incoming, key, order_cols)
    return firsts.join(existing.select(key).distinct(), key, "left_anti")


def resume_unprocessed(works: DataFrame, done: DataFrame, key: str = "id",
                       done_key: str = "work_id") -> DataFrame:
    """INC1: works not recorded as processed (processed includes works that
    yielded no technology)."""
    return works.join(done.select(F.col(done_key).alias(key)), key, "left_anti")


def overwrite(df: DataFrame, path: str, fmt: str = "parquet", **opts) -> None:
    """SNK1: replace a table.  Refuses a target that ``df`` itself reads
    (overwriting would delete the input before it is read); the check lists
    input files only, no job runs."""
    target = _norm(path).rstrip("/")
    if any(_norm(f).startswith(target + "/") for f in df.inputFiles()):
        raise ValueError(f"refusing to overwrite {path}: the DataFrame reads from it")
    df.write.mode("overwrite").format(fmt).options(**opts).save(path)


def _norm(p: str) -> str:
    """``file:/x``, ``file:///x`` and ``/x`` name the same local path."""
    return re.sub(r"^file:/+", "/", p)


def append(df: DataFrame, path: str, fmt: str = "parquet", **opts) -> None:
    """SNK2: plain append, no uniqueness."""
    df.write.mode("append").format(fmt).options(**opts).save(path)


def model_checks(topic: DataFrame, edge: DataFrame, work: DataFrame,
                 technology: DataFrame, mention: DataFrame) -> dict[str, DataFrame]:
    """Every CON1-CON5 rule of the five tables, as violation DataFrames."""
    return {
        "topic.pk": C.pk_violations(topic),
        "edge.pk": C.pk_violations(edge),
        "work.pk": C.pk_violations(work),
        "technology.pk": C.pk_violations(technology),
        "mention.pk": C.pk_violations(mention),
        "work.doi.unique": C.unique_violations(work, "doi"),
        "topic.not_null": C.null_violations(topic, ["name"]),
        "technology.not_null": C.null_violations(technology, ["name"]),
        "work.not_null": C.null_violations(work, ["source_url", "title"]),
        "mention.not_null": C.null_violations(mention, ["work_id", "technology_id"]),
        "edge.not_null": C.null_violations(edge, ["parent_id", "child_id"]),
        "edge.check": C.check_violations(edge),
        "work.topic.fk": C.fk_violations(work, "topic_id", topic),
        "mention.work.fk": C.fk_violations(mention, "work_id", work),
        "mention.technology.fk": C.fk_violations(mention, "technology_id", technology),
        "edge.parent.fk": C.fk_violations(edge, "parent_id", topic),
        "edge.child.fk": C.fk_violations(edge, "child_id", topic),
    }


# Row-local rules of each table: (check, condition that breaks it).
ROW_RULES = {
    "topic": [("topic.not_null", ["name"])],
    "technology": [("technology.not_null", ["name"])],
    "work": [("work.not_null", ["source_url", "title"])],
    "mention": [("mention.not_null", ["work_id", "technology_id"])],
    "edge": [("edge.not_null", ["parent_id", "child_id"])],
}


def _counts(df: DataFrame, counts: dict) -> DataFrame:
    """One row (check, n) per named aggregate of ``df``, in one pass."""
    row = df.agg(*[F.coalesce(c, F.lit(0)).cast("long").alias(f"c{k}") for k, c in enumerate(counts.values())])
    pairs = ", ".join(f"'{name}', c{k}" for k, name in enumerate(counts))
    return row.select(F.expr(f"stack({len(counts)}, {pairs}) AS (check, n)"))


def row_counts(tables: dict[str, DataFrame]) -> list[DataFrame]:
    """(check, n) of the key and row-local rules of each table, one pass each."""
    parts = []
    for t, df in tables.items():
        nulls = {name: sum((F.col(c).isNull().cast("long") for c in cols), F.lit(0)) for name, cols in ROW_RULES[t]}
        if t == "edge":
            nulls["edge.check"] = F.coalesce((F.col("parent_id") == F.col("child_id")).cast("long"), F.lit(0))
        by_key = df.groupBy("id").agg(F.count(F.lit(1)).alias("k"),
                                      *[F.sum(c).alias(f"r{i}") for i, c in enumerate(nulls.values())])
        parts.append(_counts(by_key, {
            f"{t}.pk": F.sum((F.col("id").isNull() | (F.col("k") > 1)).cast("long")),
            **{name: F.sum(f"r{i}") for i, name in enumerate(nulls)}}))
    return parts


def model_report(topic: DataFrame, edge: DataFrame, work: DataFrame,
                 technology: DataFrame, mention: DataFrame) -> DataFrame:
    """(check, n): the violations of every CON1-CON5 rule, as ``model_checks``
    counts them.  A table's keys and all its row-local rules are one pass (an
    aggregate by key, then over the keys); only unique values and references
    read a table again."""
    tables = {"topic": topic, "edge": edge, "work": work, "technology": technology, "mention": mention}
    more = {"work.doi.unique": C.unique_violations(work, "doi"),
            "work.topic.fk": C.fk_violations(work, "topic_id", topic),
            "mention.work.fk": C.fk_violations(mention, "work_id", work),
            "mention.technology.fk": C.fk_violations(mention, "technology_id", technology),
            "edge.parent.fk": C.fk_violations(edge, "parent_id", topic),
            "edge.child.fk": C.fk_violations(edge, "child_id", topic)}
    out = C.count_violations(more)
    for p in row_counts(tables):
        out = out.unionByName(p)
    return out


def _additions(existing: DataFrame, incoming: DataFrame, key: str = "id") -> DataFrame:
    """``insert_ignore`` over rows that are stored first: only those whose key comes
    again, or is there already, are grouped and joined.  The others do not move."""
    rows = written(incoming, "incoming", compression="zstd")
    there = existing.select(key).distinct().withColumn("__there", F.lit(True))
    taken = written(rows.groupBy(key).agg(F.count(F.lit(1)).alias("__n")).join(there, key, "left")
                        .where((F.col("__n") > 1) | F.col("__there")).select(F.col(key).alias("__key")), "taken-keys")
    same = F.col(key).eqNullSafe(F.col("__key"))  # null keys are one key here, as in the insert
    return rows.join(taken, same, "left_anti").drop(POSITION).unionByName(
        insert_ignore(existing, rows.join(taken, same, "left_semi"), key))


def checked_additions(stored: dict[str, DataFrame], incoming: dict[str, DataFrame],
                      folder: str | None = None) -> dict[str, DataFrame]:
    """The rows that an insert-ignore of the five tables adds, written once to
    ``folder`` (a new one of the checkpoint folder by default); raises if stored and
    added rows together break a rule."""
    spark = stored["topic"].sparkSession
    folder, added = folder or shared_dir(spark, "additions"), {}
    for t in MODEL_SCHEMAS:
        # Materialised once, so the rows that are checked are the rows written.
        rows = _additions(stored[t], incoming[t]).select(*stored[t].columns)
        rows.write.option("compression", "zstd").parquet(f"{folder}/{t}")
        added[t] = spark.read.schema(rows.schema).parquet(f"{folder}/{t}")
    after = {t: stored[t].unionByName(added[t]) for t in MODEL_SCHEMAS}
    C.require_clean(model_report(**after))
    return added


def load_tables(stored: dict[str, DataFrame], incoming: dict[str, DataFrame],
                paths: dict[str, str]) -> dict[str, DataFrame]:
    """SNK4: insert-ignore all five tables as one unit.

    The would-be tables (stored + inserted rows) are checked first; if any
    rule fails nothing is written.  Then each table's new rows are appended,
    topic -> edge -> work -> technology -> mention.  ``load_committed`` does the
    same with one commit for all five.
    """
    added = checked_additions(stored, incoming)
    for t in MODEL_SCHEMAS:
        append(added[t], paths[t])
    return added


# A load is a folder with a part of every table; it counts once this file exists.
COMMITTED = "_COMMITTED"


def _hadoop(spark, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def committed_tables(spark, root: str) -> dict[str, DataFrame]:
    """The five tables over all committed loads below ``root``."""
    pattern, fs = _hadoop(spark, f"{root}/load-*/{COMMITTED}")
    loads = [str(s.getPath().getParent()) for s in fs.globStatus(pattern) or []]
    return {t: spark.read.schema(s).parquet(*[f"{p}/{t}" for p in loads]) if loads else spark.createDataFrame([], s)
            for t, s in MODEL_SCHEMAS.items()}


def load_committed(spark, root: str, incoming: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """SNK4 in one commit: the added rows of all five tables are written to a new
    load folder and checked there, then one file makes them count.  A load that
    stops half-way leaves a folder that no reader sees, one that breaks a rule none."""
    load = f"{root}/load-{uuid.uuid4().hex}"
    try:
        added = checked_additions(committed_tables(spark, root), incoming, load)
    except C.ConstraintError:
        p, fs = _hadoop(spark, load)
        fs.delete(p, True)
        raise
    mark, fs = _hadoop(spark, f"{load}/{COMMITTED}")
    fs.create(mark, False).close()
    return added


def commit_state(spark, root: str, tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Replace all tables below ``root`` in one commit and return them as stored.

    They are written to a new folder; a log entry that two writers cannot both
    place makes it the current state.  Raises if another state was committed
    meanwhile, and nothing changes."""
    from techmine.streaming.commit_log import CommitLog
    log = CommitLog(spark, root)
    seq = len(log.entries())
    folder = f"{log.root}/data/{seq:012d}-{uuid.uuid4().hex[:12]}"
    for t, df in tables.items():
        df.write.parquet(f"{folder}/{t}")
    if not log.append({"seq": seq, "batch": f"state {seq}", "folder": folder, "first_name": 0, "n_names": 0,
                       "first_link": 0, "n_links": 0}):
        raise C.ConstraintError("another state was committed meanwhile")
    return {t: spark.read.schema(df.schema).parquet(f"{folder}/{t}") for t, df in tables.items()}


def current_state(spark, root: str, schemas: dict) -> dict[str, DataFrame]:
    """The tables of the last ``commit_state``; empty ones before the first."""
    from techmine.streaming.commit_log import CommitLog
    entries = CommitLog(spark, root).entries()
    if not entries:
        return {t: spark.createDataFrame([], s) for t, s in schemas.items()}
    return {t: spark.read.schema(s).parquet(f"{entries[-1]['folder']}/{t}") for t, s in schemas.items()}
