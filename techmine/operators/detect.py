"""Technology detection in work texts.

DET2 ``vocabulary_mentions``: which dictionary names occur in a text.  Texts
are cut at the references heading, split into whitespace tokens (outer
punctuation stripped) and every 1..n-gram is exploded and equi-joined with the
vocabulary in the same token form (broadcast after a size check).  Among
matches of one text, a match whose token span lies strictly inside another
match's span is dropped (``Java Card`` hides the ``Java`` inside it).  Case is
exact.

DET1 ``detect_from_replies``: the blocked-content gate, then stored model
replies joined by work id and parsed (native or strict JSON).

UDF1 ``detect_with_callable``: a user function text -> names, run on Arrow
batches after the same gate.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from techmine.functions import text as TX
from techmine.functions.strict import detector_udf, parse_languages_strict
from techmine.operators.joins import broadcast_if_small, ensure_parallelism


def vocabulary_forms(vocabulary: DataFrame, name_col: str = "name") -> DataFrame:
    """(name, form, n, first): each name in token form, its token count and first
    token."""
    toks = TX.tokens(F.col(name_col))
    return (vocabulary.where(F.col(name_col).isNotNull())
                      .select(F.col(name_col).alias("name"), F.array_join(toks, " ").alias("form"),
                              F.size(toks).alias("n"), F.get(toks, 0).alias("first"))
                      .where(F.col("form") != "")
                      .distinct())


def vocabulary_mentions(docs: DataFrame, vocabulary: DataFrame, id_col: str = "doc_id",
                        text_col: str = "text", headings=TX.REFERENCE_HEADINGS,
                        max_tokens: int | None = None) -> DataFrame:
    """DET2 -> distinct (id, name) pairs."""
    forms = vocabulary_forms(vocabulary).checkpoint(eager=True)
    body = TX.cut_references(F.col(text_col), headings) if headings else F.col(text_col)
    # Positions whose token starts a name, then one gram per length of the names
    # that start with it: most tokens give no gram at all.
    starts = forms.groupBy("first").agg(F.sort_array(F.collect_set("n")).alias("lengths"))
    if max_tokens is not None:
        starts = starts.withColumn("lengths", F.filter("lengths", lambda n: n <= max_tokens))
    toks = ensure_parallelism(docs).select(F.col(id_col).alias("__id"), TX.tokens(body).alias("toks"))
    exploded = (_starting(toks, starts).select("__id", "s", "toks3", F.explode("lengths").alias("n"))
                    .where(F.col("n") <= F.size("toks3"))
                    .select("__id", "s", "n", F.array_join(F.slice("toks3", 1, F.col("n")), " ").alias("form")))
    hits = (exploded.join(broadcast_if_small(forms.select("name", "form", "n")), ["form", "n"])
                    .select("__id", "s", (F.col("s") + F.col("n")).alias("e"), "name"))
    before = Window.partitionBy("__id").orderBy("s").rangeBetween(Window.unboundedPreceding, -1)
    same = Window.partitionBy("__id", "s")
    flagged = (hits.withColumn("__prev_e", F.max("e").over(before))
                   .withColumn("__same_e", F.max("e").over(same)))
    inside = (F.coalesce(F.col("__prev_e"), F.lit(-1)) >= F.col("e")) | (F.col("__same_e") > F.col("e"))
    return (flagged.where(~inside)
                   .select(F.col("__id").alias(id_col), "name")
                   .distinct())


def _starting(toks: DataFrame, starts: DataFrame) -> DataFrame:
    """(id, s, toks3, lengths) for every position ``s`` whose token is the first
    of a name; ``toks3`` are the tokens from there, as many as a name can have.

    While the vocabulary has at most ``FIRST_TOKENS`` first tokens, the other
    positions are dropped inside the row, by a hash set; beyond that all tokens
    are exploded.  The equi-join with the first tokens (broadcast after a size
    check) follows either way, so no gram is built for any other position."""
    longest = starts.agg(F.max(F.array_max("lengths"))).first()[0] or 1
    some = [r[0] for r in starts.select("first").limit(FIRST_TOKENS + 1).collect()]

    def windows(t):
        at = F.sequence(F.lit(0), F.size(t) - 1)
        if len(some) <= FIRST_TOKENS:
            at = F.filter(at, lambda i: F.get(t, i).isin(some))
        return F.transform(at, lambda i: F.struct(F.get(t, i).alias("first"), (i + 1).alias("s"),
                                                  F.slice(t, i + 1, longest).alias("toks3")))

    windows = F.when(F.size("toks") > 0, TX.let(F.col("toks"), windows))
    rows = toks.select("__id", F.explode(windows).alias("w")).select("__id", "w.first", "w.s", "w.toks3")
    return rows.join(broadcast_if_small(starts), "first")


# First tokens of a vocabulary that are tested inside the row.
FIRST_TOKENS = 20_000


# Instruction placed in front of each text when requests for an external
# model are written out (the model call itself is not part of this engine).
DEFAULT_INSTRUCTIONS = ("Identify the programming languages used in the following article text. "
                        "Ignore everything after a References or Bibliography heading. "
                        'Answer only with JSON of the form {"programming_languages": ["..."]}.')


def model_requests(docs: DataFrame, id_col: str = "work_id", text_col: str = "text",
                   instructions: str = DEFAULT_INSTRUCTIONS, phrases=TX.BLOCKED_PHRASES) -> DataFrame:
    """SC21: one prompt per work that passes the gate, ready for a batch
    inference service; its replies come back as the ``model_reply`` table of
    ``detect_from_replies``."""
    g = gate(docs.select(id_col, text_col), text_col, phrases).where(~F.col("blocked"))
    return g.select(id_col, F.format_string("%s\n\nText:\n%s", F.lit(instructions), F.col(text_col))
                    .alias("prompt"))


def gate(docs: DataFrame, text_col: str = "text", phrases=TX.BLOCKED_PHRASES) -> DataFrame:
    """FIL5 + FIL7 ahead of any detection: rows with text, flagged ``blocked``."""
    return (docs.where(TX.has_text(F.col(text_col)))
                .withColumn("blocked", TX.blocked(F.col(text_col), phrases)))


def detect_from_replies(docs: DataFrame, replies: DataFrame, id_col: str = "work_id",
                        text_col: str = "text", strict: bool = True,
                        phrases=TX.BLOCKED_PHRASES) -> DataFrame:
    """DET1: (id, languages).  Blocked texts and works without a reply get [];
    of several replies for a work the smallest text counts.  ``strict=False``
    parses natively, which accepts some replies that are no valid JSON."""
    g = gate(docs.select(id_col, text_col), text_col, phrases).select(id_col, "blocked")
    r = replies.groupBy(F.col("work_id").alias(id_col)).agg(F.min("raw").alias("raw"))
    parse = parse_languages_strict if strict else TX.parse_languages
    j = g.join(r, id_col, "left")
    langs = F.when(F.col("blocked") | F.col("raw").isNull(), F.array().cast("array<string>")) \
             .otherwise(parse(F.col("raw")))
    return j.select(id_col, langs.alias("languages"))


def detect_with_callable(docs: DataFrame, fn, id_col: str = "work_id", text_col: str = "text",
                         phrases=TX.BLOCKED_PHRASES) -> DataFrame:
    """UDF1: (id, languages) from a user callable; the gate runs first so
    blocked texts never reach Python."""
    g = gate(docs.select(id_col, text_col), text_col, phrases)
    run = detector_udf(fn)
    # The wrapper gives [] for null, so one scan serves blocked texts too.
    return g.select(id_col, TX.sorted_distinct(run(F.when(~F.col("blocked"), F.col(text_col)))).alias("languages"))
