"""Host-level quality rules with shrunken failure rates (native: no Python in tasks).

Every document is measured by per-row expressions over its whole text.  Three
rules look at these figures; their failures are counted per host, each host's
rate is shrunk towards an empirical beta prior fitted on all hosts, and the
host verdicts are joined back.  A document goes if it fails the base rules, or
if it fails a rule that its own host fails habitually: a document with no
failure always stays, whatever its host.

Defined results: a null text has no words (and so fails the base rules); a null
host is the host ''.  Equal rows are judged alike and each returned.  An empty
table gives an empty result.  Only the id, text and host columns are read;
columns of other names pass through ``with_quality`` untouched (its own column
names start with ``__llm_``).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from techmine.llm.common import prepare, small_side, stored, text_or_empty

# Word separators of the contract: space and \t \n \v \f \r.
WORD_GAP = r"[\x20\x09-\x0D]+"
GAP_CHARS = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"

MIN_WORDS = 50
MAX_REPEAT_PCT = 50          # base: words in repeated 3-word windows
MAX_SYMBOLS_PER_100 = 20     # rule symbols: symbol characters per 100 words
MAX_DUP_LINES_PCT = 30       # rule dup_lines: repeated lines per 100 lines
WORD_CHARS = (2, 12)         # rule word_chars: mean code points of a word
HOST_DEVIATIONS = 2.0        # a host fails a rule habitually this far above the prior's mean, in its deviations
PRIOR_STRENGTH = (1.0, 1e6)  # bounds of alpha + beta of the fitted prior

RULES = ("symbols", "dup_lines", "word_chars")


def _words(t: Column) -> Column:
    return F.filter(F.split(t, WORD_GAP, -1), lambda w: w != "")


def _repeat_candidates(words: Column, n: Column) -> Column:
    """Start positions of 3-word windows whose hash occurs twice or more: a
    superset of the repeated ones.  Hash and position share one long, so that
    the sort is primitive; the position gets as many low bits as it needs."""
    bits = F.length(F.bin(n)).cast("int")
    return bits, F.transform(
        F.sequence(F.lit(0), n - 3),
        lambda i: F.call_function("shiftleft", F.xxhash64(F.get(words, i), F.get(words, i + 1),
                                                         F.get(words, i + 2)), bits).bitwiseOR(i.cast("long")))


def measured(docs: DataFrame, text: str = "text", carry: list[str] | None = None) -> DataFrame:
    """The ``carry`` columns of ``docs`` (default all) with the figures of each
    whole text in ``__llm_*`` columns."""
    c = F.col
    df = docs.withColumn("__llm_t", text_or_empty(text)).withColumn("__llm_w", _words(c("__llm_t")))
    df = df.withColumn("__llm_n", F.size("__llm_w"))
    bits, packed = _repeat_candidates(c("__llm_w"), c("__llm_n"))
    # Fewer than four words hold one window at most.
    df = df.withColumn("__llm_bits", bits)
    df = df.withColumn("__llm_h", F.when(c("__llm_n") >= 4, F.sort_array(packed)))
    part = lambda x: F.call_function("shiftrightunsigned", x, c("__llm_bits"))
    mask = F.call_function("shiftleft", F.lit(1).cast("long"), c("__llm_bits")) - 1
    h = c("__llm_h")
    twice = F.filter(h, lambda x, j: ((j > 0) & (part(x) == part(F.get(h, F.greatest(j - 1, F.lit(0))))))
                     | F.coalesce(part(x) == part(F.get(h, j + 1)), F.lit(False)))
    df = df.withColumn("__llm_c", F.transform(twice, lambda x: x.bitwiseAND(mask).cast("int")))
    # The candidates are compared word by word: hashes decide nothing.
    w = c("__llm_w")
    df = df.withColumn("__llm_c", F.sort_array(F.transform("__llm_c", lambda i: F.struct(
        F.get(w, i).alias("a"), F.get(w, i + 1).alias("b"), F.get(w, i + 2).alias("c"), i.alias("i")))))
    k = c("__llm_c")
    same = lambda x, y: (x["a"] == y["a"]) & (x["b"] == y["b"]) & (x["c"] == y["c"])
    df = df.withColumn("__llm_p", F.sort_array(F.transform(
        F.filter(k, lambda x, j: ((j > 0) & same(x, F.get(k, F.greatest(j - 1, F.lit(0)))))
                 | F.coalesce(same(x, F.get(k, j + 1)), F.lit(False))), lambda x: x["i"])))
    p = c("__llm_p")
    # A window covers three words, or those up to the next repeated window.
    covered = F.aggregate(F.transform(p, lambda x, j: F.least(F.lit(3), F.coalesce(F.get(p, j + 1) - x, F.lit(3)))),
                          F.lit(0).cast("long"), lambda acc, x: acc + x)
    t = c("__llm_t")
    df = df.withColumn("__llm_l", F.filter(F.split(t, "\n", -1), lambda x: F.translate(x, GAP_CHARS, "") != ""))
    size = F.size("__llm_l")
    df = df.select(
        *(docs.columns if carry is None else carry),
        c("__llm_n").cast("long").alias("__llm_n_words"),
        F.char_length(F.translate(t, GAP_CHARS, "")).cast("long").alias("__llm_word_chars"),
        (F.char_length(t) - F.char_length(F.translate(t, SYMBOLS, ""))).cast("long").alias("__llm_n_symbols"),
        size.cast("long").alias("__llm_n_lines"),
        (size - F.size(F.array_distinct("__llm_l"))).cast("long").alias("__llm_n_dup_lines"),
        F.coalesce(covered, F.lit(0)).cast("long").alias("__llm_n_repeat_words"))
    n, r = c("__llm_n_words"), c("__llm_n_repeat_words")
    return (df.withColumn("__llm_base_failed", (n < MIN_WORDS) | (100 * r > MAX_REPEAT_PCT * n))
              .withColumn("__llm_f_symbols", 100 * c("__llm_n_symbols") > MAX_SYMBOLS_PER_100 * n)
              .withColumn("__llm_f_dup_lines", 100 * c("__llm_n_dup_lines") > MAX_DUP_LINES_PCT * c("__llm_n_lines"))
              .withColumn("__llm_f_word_chars", (c("__llm_word_chars") < WORD_CHARS[0] * n)
                          | (c("__llm_word_chars") > WORD_CHARS[1] * n)))


def host_rates(figures: DataFrame, host: str) -> DataFrame:
    """One row per host: documents, shrunken rate and verdict of each rule.

    The prior of a rule is beta(m s, (1 - m) s) with m and v the mean and
    variance of the hosts' raw rates and s = m (1 - m) / v - 1, kept within
    ``PRIOR_STRENGTH``; the shrunken rate is (failures + m s) / (documents + s).  A
    host fails a rule habitually if this rate lies ``HOST_DEVIATIONS`` standard
    deviations of the prior, sqrt(m (1 - m) / (s + 1)), above its mean.
    """
    counts = figures.groupBy(F.coalesce(F.col(host).cast("string"), F.lit("")).alias("__llm_host")).agg(
        F.count(F.lit(1)).alias("__llm_docs"),
        *[F.sum(F.col(f"__llm_f_{r}").cast("long")).alias(f"__llm_k_{r}") for r in RULES])
    counts = stored(counts, "host-counts")
    rate = lambda r: F.col(f"__llm_k_{r}") / F.col("__llm_docs")
    # Two numbers per rule for all hosts together.
    moments = counts.agg(*[a for r in RULES for a in (F.avg(rate(r)).alias(f"m_{r}"),
                                                      F.var_pop(rate(r)).alias(f"v_{r}"))]).first()
    out = counts
    for r in RULES:
        m, v = moments[f"m_{r}"] or 0.0, moments[f"v_{r}"] or 0.0
        low, high = PRIOR_STRENGTH
        s = max(low, min(high, m * (1 - m) / v - 1)) if v > 0 else high
        rate_r = (F.col(f"__llm_k_{r}") + m * s) / (F.col("__llm_docs") + s)
        limit = m + HOST_DEVIATIONS * math.sqrt(m * (1 - m) / (s + 1))
        out = out.withColumn(f"__llm_rate_{r}", rate_r).withColumn(f"__llm_bad_{r}", rate_r > limit)
    return out.select("__llm_host", "__llm_docs", *[f"__llm_{k}_{r}" for k in ("rate", "bad") for r in RULES])


def with_quality(docs: DataFrame, text: str = "text", host: str = "source",
                 carry: list[str] | None = None) -> DataFrame:
    """The ``carry`` columns of ``docs`` (default all) and the host, with figures, rule failures, host rates and ``__llm_kept``.

    The measured rows are stored once; host counts are pre-aggregated per
    partition, so a hot host costs one row per task in the shuffle.
    """
    prepare(docs.sparkSession)
    carry = docs.columns if carry is None else [*carry, *[host] * (host not in carry)]
    figures = stored(measured(docs, text, carry), "host-figures")
    rates = small_side(stored(host_rates(figures, host), "host-rates"))
    key = F.coalesce(F.col(host).cast("string"), F.lit(""))
    out = figures.join(rates, key == F.col("__llm_host"), "left")
    habitual = F.lit(False)
    for r in RULES:
        habitual = habitual | (F.col(f"__llm_f_{r}") & F.col(f"__llm_bad_{r}"))
    return (out.withColumn("__llm_host_failed", habitual)
               .withColumn("__llm_kept", ~F.col("__llm_base_failed") & ~habitual))


def quality_filter(docs: DataFrame, text: str = "text", host: str = "source") -> DataFrame:
    """The rows of ``docs`` that pass, with the columns of ``docs``."""
    return with_quality(docs, text, host).where("__llm_kept").select(*docs.columns)
