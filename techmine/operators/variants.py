"""Name variants and derived names found by name alone (CAN1, CAN2).

``spelling_variants`` joins names whose letters differ by at most one or two edits,
spaces and punctuation between words not counted: ``Java Script`` / ``JavaScript``,
``C ++`` / ``C++``.  Candidates come from a prefix filter: names within t edits
share one of their first q t + 1 pieces of q letters, rarest first, at positions at
most t apart; so no pair is formed that shares nothing rare, and every candidate is
verified by its edit distance.

``derived_names`` finds names that hold another one as a run of whole words
(``Featherweight Java``, ``Java-K``): the runs of a name are joined with the names
themselves.  Both only propose; ``aliases`` applies what a person keeps.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from techmine.functions.text import let
from techmine.operators.aliases import name_form

Q = 2
# Letters from which a name may differ by that many edits (shorter ones: none).
EDITS = ((5, 1), (9, 2))


def squeezed(c: Column) -> Column:
    """The letters and signs of a name: lower case, nothing between words."""
    return F.replace(name_form(c), F.lit(" "), F.lit(""))


def edits_allowed(length: Column) -> Column:
    out = F.lit(0)
    for least, edits in EDITS:
        out = F.when(length >= least, F.lit(edits)).otherwise(out)
    return out


def _pieces(letters: Column) -> Column:
    """(at, piece) of every run of Q letters; the name is closed by a mark, so that
    names shorter than Q have one, too."""
    closed = F.concat(letters, F.lit("\x00" * (Q - 1)))
    return F.transform(F.sequence(F.lit(1), F.char_length(letters)), lambda i: F.struct(
        i.alias("at"), F.substring(closed, i, F.lit(Q)).alias("piece")))


def spelling_variants(names: DataFrame, name_col: str = "name") -> DataFrame:
    """(left, right, edits): pairs of distinct names, left < right, that are the same
    letters (edits 0) or within the edits that the shorter one allows.

    Null names and names without a letter or sign have no variants.  Names of the
    same letters meet through one representative in the edit join, and are paired
    in the end.
    """
    distinct = (names.where(F.col(name_col).isNotNull()).select(F.col(name_col).alias("name")).distinct()
                     .withColumn("letters", squeezed(F.col("name"))).where("letters <> ''"))
    distinct = distinct.checkpoint(eager=True)
    forms = distinct.select("letters").distinct().withColumn("size", F.char_length("letters")).withColumn(
        "most", edits_allowed(F.col("size")))
    pieces = forms.select("letters", "size", "most", F.explode(_pieces(F.col("letters"))).alias("p")).select(
        "letters", "size", "most", "p.at", "p.piece")
    counts = pieces.groupBy("piece").agg(F.count(F.lit(1)).alias("n"))
    # The prefix of a name: its rarest pieces, as many as edits could destroy, plus one.
    # The larger of the two names' edits can apply only where both allow it.
    ranked = pieces.join(counts, "piece").groupBy("letters", "size", "most").agg(
        F.sort_array(F.collect_list(F.struct("n", "piece", "at"))).alias("all"))
    prefix = ranked.where("most > 0").select("letters", "size", "most", F.explode(
        F.slice("all", F.lit(1), F.lit(Q) * F.col("most") + 1)).alias("p")).select(
        "letters", "size", "most", "p.piece", "p.at").checkpoint(eager=True)
    y = prefix.select("piece", *[F.col(c).alias(f"{c}2") for c in ("letters", "size", "most", "at")])
    t = F.least("most", "most2")
    # A longer name's prefix is for more edits than the pair allows: still a superset.
    close = prefix.join(y, "piece").where(
        (F.col("letters") < F.col("letters2")) & (F.abs(F.col("size") - F.col("size2")) <= t)
        & (F.abs(F.col("at") - F.col("at2")) <= t)).select("letters", "letters2", t.alias("t")).distinct()
    edits = F.levenshtein("letters", "letters2")
    close = close.withColumn("edits", edits).where("edits <= t").select("letters", "letters2", "edits")
    same = distinct.select("letters").distinct().select("letters", F.col("letters").alias("letters2"), F.lit(0).alias("edits"))
    a = distinct.select("letters", F.col("name").alias("a"))
    b = distinct.select(F.col("letters").alias("letters2"), F.col("name").alias("b"))
    pairs = same.unionByName(close).join(a, "letters").join(b, "letters2")
    # Of two spellings of the same letters each pair comes twice.
    pairs = pairs.where((F.col("letters") != F.col("letters2")) | (F.col("a") < F.col("b")))
    return pairs.select(F.least("a", "b").alias("left"), F.greatest("a", "b").alias("right"), "edits")


def _runs(words: Column) -> Column:
    """All shorter runs of whole words, with blanks between."""
    n = F.size(words)
    return F.flatten(F.transform(F.sequence(F.lit(1), n), lambda i: F.transform(
        F.sequence(F.lit(1), n - i + 1), lambda k: F.array_join(F.slice(words, i, k), " "))))


def derived_names(names: DataFrame, name_col: str = "name") -> DataFrame:
    """(derived, base): names that hold another name's form as a run of whole words,
    with the longest such base (of equally long forms the smallest, and of a form the
    smallest name).

    Names of the same form are variants, not derived.  A name of n words has
    n (n + 1) / 2 runs; the join is on the run, so nothing is paired that does not
    match.
    """
    forms = (names.where(F.col(name_col).isNotNull()).select(F.col(name_col).alias("name")).distinct()
                  .withColumn("form", name_form(F.col("name"))).where("form <> ''"))
    bases = forms.groupBy("form").agg(F.min("name").alias("base"))
    runs = forms.withColumn("run", F.explode(let(F.split("form", " "), lambda w: F.array_distinct(_runs(w))))).where(
        F.col("run") != F.col("form"))
    found = runs.join(bases.withColumnRenamed("form", "run"), "run")
    best = found.groupBy("name").agg(F.min(F.struct(
        (-F.size(F.split("run", " "))).alias("k"), (-F.char_length("run")).alias("l"), "run", "base")).alias("b"))
    return best.select(F.col("name").alias("derived"), F.col("b.base").alias("base"))


def derived_ids(technology: DataFrame, id_col: str = "id", name_col: str = "name") -> DataFrame:
    """(derived_id, base_id) for ``aliases.replace_derived``, found by name: a
    derived name's ids point to the smallest id of its base."""
    pairs = derived_names(technology, name_col)
    ids = technology.select(F.col(id_col).alias("derived_id"), F.col(name_col).alias("derived"))
    base = technology.groupBy(F.col(name_col).alias("base")).agg(F.min(id_col).alias("base_id"))
    return ids.join(pairs, "derived").join(base, "base").select("derived_id", "base_id")
