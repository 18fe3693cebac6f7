"""Key and reference rules of the relational model, checked as Spark jobs
(CON1-CON5), and the referential actions of deletes and key changes
(CON6-CON8).  Spark enforces no keys, so a load first runs every check and
writes nothing when any check reports a row."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def pk_violations(df: DataFrame, key: str = "id") -> DataFrame:
    """CON1: keys that are null or occur more than once -> (key, n_rows)."""
    return (df.groupBy(F.col(key).alias("key"))
              .agg(F.count(F.lit(1)).alias("n_rows"))
              .where(F.col("key").isNull() | (F.col("n_rows") > 1)))


def unique_violations(df: DataFrame, col: str) -> DataFrame:
    """CON2: non-null values held by more than one row -> (value, n_rows).
    Nulls may repeat."""
    return (df.where(F.col(col).isNotNull())
              .groupBy(F.col(col).alias("value"))
              .agg(F.count(F.lit(1)).alias("n_rows"))
              .where(F.col("n_rows") > 1))


def null_violations(df: DataFrame, cols: list[str], key: str = "id") -> DataFrame:
    """CON3: (column, key) for every null in a NOT NULL column."""
    parts = [df.where(F.col(c).isNull()).select(F.lit(c).alias("column"), F.col(key).alias("key"))
             for c in cols]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def check_violations(edge: DataFrame, a: str = "parent_id", b: str = "child_id",
                     key: str = "id") -> DataFrame:
    """CON4: rows breaking CHECK (a <> b)."""
    return edge.where(F.col(a) == F.col(b)).select(F.col(key).alias("key"), F.col(a).alias("value"))


def fk_violations(child: DataFrame, fk: str, parent: DataFrame, pk: str = "id",
                  key: str = "id") -> DataFrame:
    """CON5 / JN11: child rows whose non-null reference has no parent row."""
    return (child.where(F.col(fk).isNotNull())
                 .join(parent.select(F.col(pk).alias(fk)), fk, "left_anti")
                 .select(F.col(key).alias("key"), F.col(fk).alias("ref")))


def count_violations(checks: dict[str, DataFrame]) -> DataFrame:
    """One row per check with its violation count (all checks in one job)."""
    parts = [df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("check"), "n")
             for name, df in checks.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


class ConstraintError(ValueError):
    pass


def require_clean(report: DataFrame) -> None:
    """Raise if any check of a report (check, n) has a violation; one row per
    check comes to the driver."""
    bad = [(r["check"], r["n"]) for r in report.collect() if r["n"]]
    if bad:
        raise ConstraintError(f"constraint violations: {bad}")


# ------------------------------------------------------------ referential actions

def default_zero(df: DataFrame, col: str) -> DataFrame:
    """CON6: DEFAULT 0 for a missing value."""
    return df.withColumn(col, F.coalesce(F.col(col), F.lit(0).cast(df.schema[col].dataType)))


def delete_cascade(child: DataFrame, fk: str, deleted_keys: DataFrame, key: str = "id") -> DataFrame:
    """ON DELETE CASCADE: child rows pointing at a deleted parent go too."""
    return child.join(deleted_keys.select(F.col(key).alias(fk)), fk, "left_anti")


def delete_set_null(child: DataFrame, fk: str, deleted_keys: DataFrame, key: str = "id") -> DataFrame:
    """ON DELETE SET NULL: references to a deleted parent become null."""
    gone = deleted_keys.select(F.col(key).alias(fk), F.lit(True).alias("__gone")).distinct()
    return (child.join(gone, fk, "left")
                 .withColumn(fk, F.when(F.col("__gone"), F.lit(None).cast(child.schema[fk].dataType))
                                  .otherwise(F.col(fk)))
                 .drop("__gone")
                 .select(*child.columns))


def delete_restrict(child: DataFrame, fk: str, deleted_keys: DataFrame, key: str = "id") -> None:
    """ON DELETE RESTRICT: refuse when any child still points at a deleted parent."""
    used = child.join(deleted_keys.select(F.col(key).alias(fk)), fk, "left_semi")
    if not used.isEmpty():
        raise ConstraintError(f"delete restricted: rows still reference {fk}")


def restricting_rows(child: DataFrame, fk: str, parent: DataFrame, key: str = "id") -> DataFrame:
    """ON DELETE RESTRICT as a report: (key, n_children) of every parent row."""
    n = child.where(F.col(fk).isNotNull()).groupBy(F.col(fk).alias("key")).agg(F.count(F.lit(1)).alias("n_children"))
    return (parent.select(F.col(key).alias("key")).join(n, "key", "left")
                  .select("key", F.coalesce("n_children", F.lit(0)).alias("n_children")))


def delete_rows(parent: DataFrame, deleted_keys: DataFrame, key: str = "id") -> DataFrame:
    return parent.join(deleted_keys.select(key), key, "left_anti")


def update_keys(df: DataFrame, col: str, mapping: DataFrame) -> DataFrame:
    """CON8 ON UPDATE CASCADE: replace ``col`` by ``new_id`` where a mapping
    (old_id, new_id) exists; other values stay."""
    m = mapping.select(F.col("old_id").alias(col), F.col("new_id").alias("__new"))
    return (df.join(m, col, "left")
              .withColumn(col, F.coalesce(F.col("__new"), F.col(col)).cast(df.schema[col].dataType))
              .drop("__new")
              .select(*df.columns))


# The references of the five tables: (child, column, parent, action on delete).
REFERENCES = (("work", "topic_id", "topic", "set null"), ("mention", "work_id", "work", "cascade"),
              ("mention", "technology_id", "technology", "restrict"),
              ("edge", "parent_id", "topic", "cascade"), ("edge", "child_id", "topic", "cascade"))


def keys_gone(tables: dict[str, DataFrame], doomed: dict[str, DataFrame], references=REFERENCES,
              key: str = "id") -> dict[str, DataFrame]:
    """Keys of all rows that go with the ``doomed`` keys (per table, column ``key``):
    CASCADE references are followed until no further row is found, also around
    cycles and within one table."""
    gone = {t: d.select(key).where(F.col(key).isNotNull()).distinct().checkpoint(eager=True) for t, d in doomed.items()}
    new = dict(gone)
    while new:
        hits: dict[str, DataFrame] = {}
        for child, fk, parent, action in references:
            if action == "cascade" and parent in new:
                hit = tables[child].join(new[parent].select(F.col(key).alias("__gone")), F.col(fk) == F.col("__gone"),
                                         "left_semi").select(key)
                hits[child] = hits[child].union(hit) if child in hits else hit
        new = {}
        for child, keys in hits.items():
            keys = keys.where(F.col(key).isNotNull()).distinct()
            if child in gone:
                keys = keys.join(gone[child], key, "left_anti")
            keys = keys.checkpoint(eager=True)
            if not keys.isEmpty():
                new[child] = keys
                gone[child] = gone[child].union(keys).checkpoint(eager=True) if child in gone else keys
    return gone


def delete_through(tables: dict[str, DataFrame], doomed: dict[str, DataFrame], references=REFERENCES,
                   key: str = "id") -> dict[str, DataFrame]:
    """CON7 over all tables: the tables after deleting the ``doomed`` keys with every
    referential action, transitively.  A RESTRICT reference from a row that stays
    refuses the whole delete; rows that go by a cascade restrict nothing."""
    gone = keys_gone(tables, doomed, references, key)

    def without(df: DataFrame, column: str, table: str) -> DataFrame:
        return df.join(gone[table].select(F.col(key).alias("__gone")), F.col(column) == F.col("__gone"), "left_anti")

    left = {}
    for t, df in tables.items():
        left[t] = without(df, key, t) if t in doomed else df
        # By reference, not by key: rows whose keys repeat are told apart.
        for child, fk, parent, action in references:
            if child == t and action == "cascade" and parent in gone:
                left[t] = without(left[t], fk, parent)
    for child, fk, parent, action in references:
        if action == "restrict" and parent in gone:
            delete_restrict(left[child], fk, gone[parent], key)
    for child, fk, parent, action in references:
        if action == "set null" and parent in gone:
            left[child] = delete_set_null(left[child], fk, gone[parent], key)
    return left
