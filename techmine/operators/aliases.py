"""Name curation by reviewable tables (CAN1-CAN3): variants of a name become its
canonical name, technologies derived from another one are replaced by it, and a
vocabulary is split by a supplied list.  Every step is a join with a table that
a person can read and edit; nothing is guessed at write time."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from techmine.operators.joins import broadcast_if_small


def name_form(c):
    """The form under which variants of a name meet: lower case, runs of white
    space, hyphens, underscores and dots as one space, trimmed."""
    return F.btrim(F.regexp_replace(F.lower(c), r"[\s._\-]+", " "))


def propose_aliases(technology: DataFrame, uses: DataFrame, name_col: str = "name") -> DataFrame:
    """CAN1: (variant, canonical, form) for names that share a form; the most
    used name is canonical, ties by name.  ``uses`` has (name, n_uses)."""
    names = (technology.where(F.col(name_col).isNotNull()).select(F.col(name_col).alias("variant")).distinct()
                       .withColumn("form", name_form(F.col("variant"))))
    counted = names.join(uses.select(F.col("name").alias("variant"), "n_uses"), "variant", "left")
    # The best of a form as a partial aggregate: a form with many variants
    # costs one row per task.
    best = counted.groupBy("form").agg(F.min(F.struct(
        (-F.coalesce("n_uses", F.lit(0))).alias("k"), F.col("variant").alias("canonical"))).alias("b"))
    return (counted.join(best.select("form", "b.canonical"), "form")
                   .where(F.col("variant") != F.col("canonical")).select("variant", "canonical", "form"))


def apply_aliases(names: DataFrame, aliases: DataFrame, name_col: str = "name") -> DataFrame:
    """``names`` with variants replaced by their canonical names."""
    a = aliases.select(F.col("variant").alias(name_col), F.col("canonical").alias("__canonical"))
    return (names.join(broadcast_if_small(a), name_col, "left")
                 .withColumn(name_col, F.coalesce("__canonical", name_col)).select(*names.columns))


def replace_derived(technology: DataFrame, mention: DataFrame, derived: DataFrame):
    """CAN2: drop technologies that derive from another one and point their links
    to it, without repeated links.

    ``derived`` (derived_id, base_id) may chain (A from B from C); chains are
    followed to their end first, rows of a cycle are left as they are.  Returns
    (technology, links (work_id, technology_id)).
    """
    pairs = derived.select(F.col("derived_id").cast("long"), F.col("base_id").cast("long")).distinct()
    end = pairs.groupBy("derived_id").agg(F.min("base_id").alias("base_id")).checkpoint(eager=True)
    for _ in range(end.count().bit_length() + 1):  # pointer jumping: the chains halve each round
        hop = end.select(F.col("derived_id").alias("base_id"), F.col("base_id").alias("__next"))
        end = end.join(hop, "base_id", "left").select(
            "derived_id", F.coalesce("__next", "base_id").alias("base_id"),
            F.col("__next").isNotNull().alias("__moved")).checkpoint(eager=True)
        if end.where("__moved").isEmpty():
            break
    # What still moves after that many rounds runs into a cycle.
    end = end.where(~F.col("__moved")).select(
        "derived_id", "base_id")
    end = broadcast_if_small(end)
    links = (mention.select("work_id", F.col("technology_id").alias("derived_id")).join(end, "derived_id", "left")
                    .select("work_id", F.coalesce("base_id", "derived_id").alias("technology_id")).distinct())
    kept = technology.join(end.select(F.col("derived_id").alias("id")), "id", "left_anti")
    return kept, links


def split_by_list(technology: DataFrame, listed: DataFrame, name_col: str = "name"):
    """CAN3: (listed, others): technologies whose name form is in the supplied
    list (column ``name``), and the rest."""
    forms = broadcast_if_small(listed.where(F.col("name").isNotNull())
                               .select(name_form(F.col("name")).alias("__form")).distinct())
    keyed = technology.withColumn("__form", name_form(F.col(name_col)))
    return (keyed.join(forms, "__form", "left_semi").select(*technology.columns),
            keyed.join(forms, "__form", "left_anti").select(*technology.columns))
