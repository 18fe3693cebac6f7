"""Stable-id dimensions: ranking (WIN1), first-seen ids (AG7), registration of
unseen names (REG1) and bridge rows with continuing ids (REG3).

Ids are handed out by ``dense_ids`` (range partitioned, no one-task window).
Existing ids never change; re-running a registration with the same input adds
nothing because every step starts with an anti-join against what is stored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from techmine.operators.ids import dense_ids, next_id


def rank_ids(df: DataFrame, order_by: list, id_col: str = "id", start: int = 1) -> DataFrame:
    """WIN1 + SRT1: dense ids 1..n in the given total order (e.g. citations
    desc, source id asc)."""
    return dense_ids(df, order_by, id_col=id_col, start=start)


def first_seen(names: DataFrame, name_col: str, order_cols: list[str]) -> DataFrame:
    """AG7: one row per name with its first position (smallest order struct).

    ``min`` of a struct is a partial (map-side) aggregate, so a name that occurs
    in a third of the rows costs no more than any other.
    """
    return (names.where(F.col(name_col).isNotNull())
                 .groupBy(name_col)
                 .agg(F.min(F.struct(*order_cols)).alias("__first")))


def register_names(existing: DataFrame, names: DataFrame, name_col: str,
                   order_cols: list[str]) -> DataFrame:
    """REG1: ids for names not yet in ``existing(id, name)``.

    New ids are ``max(existing.id) + 1 ...`` in first-seen order (ties broken by
    name).  Returns only the new rows (id, name); append them to the stored
    dimension.  Matching is exact and case-sensitive.
    """
    unseen = names.join(existing.select(F.col("name").alias(name_col)), name_col, "left_anti")
    firsts = first_seen(unseen, name_col, order_cols)
    return (dense_ids(firsts, [F.col("__first"), F.col(name_col)], start=next_id(existing))
            .select("id", F.col(name_col).alias("name")))


def with_registered(existing: DataFrame, names: DataFrame, name_col: str,
                    order_cols: list[str]) -> DataFrame:
    """The stored dimension plus the newly registered names."""
    return existing.select("id", "name").unionByName(
        register_names(existing, names, name_col, order_cols))


def bridge_rows(work_names: DataFrame, dimension: DataFrame, existing_links: DataFrame,
                work_col: str = "work_id", name_col: str = "name") -> DataFrame:
    """REG3: one link per (work, name) with ids continuing after the stored
    links, in (work, name) order.  Names are looked up exactly in
    ``dimension(id, name)``; rows whose name is unknown are not linked.
    Returns (id, work_id, technology_id)."""
    dim = dimension.select(F.col("id").alias("technology_id"), F.col("name").alias(name_col))
    linked = work_names.select(work_col, name_col).join(dim, name_col)
    numbered = dense_ids(linked, [work_col, name_col], start=next_id(existing_links))
    return numbered.select("id", F.col(work_col).alias("work_id"), "technology_id")


def languages_per_work(df: DataFrame, work_col: str, name_col: str) -> DataFrame:
    """SC15 per work: sorted distinct names (code-point order, case-sensitive)."""
    return (df.where(F.col(name_col).isNotNull())
              .groupBy(work_col)
              .agg(F.sort_array(F.collect_set(name_col)).alias("languages")))
