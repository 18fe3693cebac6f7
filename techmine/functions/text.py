"""Native column functions for text: abstracts, trimming, casts, previews,
gates, model-reply parsing and reference cutting.

All of these are Catalyst expressions (whole-stage codegen, no Python).
Regular expressions use explicit character classes rather than ``\\s`` /
``\\b`` so that their meaning does not depend on the regex engine.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Whitespace as Python's str.strip / str.split see it.
WS_CLASS = (r"[\t\n\x{0B}\f\r \x{1C}-\x{1F}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
            r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]")

# Gate phrases of the reference (lower case).
BLOCKED_PHRASES = ["enable javascript and cookies to continue", "access denied", "not found",
                   "error 404"]
SOFT_ERROR_PHRASES = ["not found", "error 404", "no encontrado", "access denied"]

# Section headings after which text is ignored.
REFERENCE_HEADINGS = ["references", "bibliography"]

PREVIEW_CHARS = 300


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_ws(c) -> Column:
    """SC5: remove leading and trailing whitespace (all kinds, like str.strip)."""
    return F.regexp_replace(_c(c), f"^{WS_CLASS}+|{WS_CLASS}+$", "")


def na_to_null(c, na_values=("",)) -> Column:
    """SC7: text values that mean "missing" become null (default: empty only)."""
    col = _c(c)
    return F.when(col.isin(list(na_values)), F.lit(None).cast("string")).otherwise(col)


def int_or(c, default) -> Column:
    """SC6: integer parse with a default for null/empty/bad text (ANSI casts
    would throw); ``malformed`` reports the bad values."""
    return F.coalesce(_c(c).try_cast("bigint"), F.lit(default).cast("bigint"))


def float_or(c, default) -> Column:
    return F.coalesce(_c(c).try_cast("double"), F.lit(default).cast("double"))


def malformed(c, to: str) -> Column:
    """True for non-empty text that does not parse as ``to`` (the reference
    would stop on it; we report it)."""
    col = _c(c)
    s = strip_ws(col)
    return col.isNotNull() & (s != "") & s.try_cast(to).isNull()


def preview(c, n: int = PREVIEW_CHARS) -> Column:
    """SC10: first ``n`` characters with newlines as spaces."""
    return F.replace(F.substring(_c(c), 1, n), F.lit("\n"), F.lit(" "))


def preview_display(c, n: int = PREVIEW_CHARS) -> Column:
    """SC10 for display: trimmed preview plus ``...`` when the text is longer."""
    col = _c(c)
    return F.concat(strip_ws(preview(col, n)),
                    F.when(F.length(col) > n, F.lit("...")).otherwise(F.lit("")))


def contains_any(c, phrases) -> Column:
    """SC11: lower-cased text contains any of the (lower-case) phrases."""
    low = F.lower(_c(c))
    cond = F.lit(False)
    for p in phrases:
        cond = cond | low.contains(p.lower())
    return cond


def blocked(text, phrases=BLOCKED_PHRASES, n: int = PREVIEW_CHARS) -> Column:
    """FIL5: blocked-content gate on the preview of the first ``n`` characters."""
    return contains_any(preview(text, n), phrases)


def soft_error(page_text, phrases=SOFT_ERROR_PHRASES) -> Column:
    """FIL6: soft-404 gate on a whole page text."""
    return contains_any(page_text, phrases)


def has_text(c) -> Column:
    """FIL7: non-null, non-empty (whitespace-only text passes, as in the reference)."""
    col = _c(c)
    return col.isNotNull() & (F.length(col) > 0)


def is_pdf_link(c) -> Column:
    """SC12: case-sensitive ``.pdf`` suffix."""
    return _c(c).endswith(".pdf")


def sorted_distinct(c) -> Column:
    """SC15: distinct values in code-point order (case-sensitive)."""
    return F.sort_array(F.array_distinct(_c(c)))


LANGS_SCHEMA = T.StructType([T.StructField("programming_languages", T.ArrayType(T.StringType()))])


def json_slice(raw) -> Column:
    """SC14 step 1: from the first ``{`` to the last ``}`` ('' when there is none)."""
    return F.regexp_extract(_c(raw), r"(?s)\{.*\}", 0)


def parse_languages(raw) -> Column:
    """SC14 + SC15, native path: the ``programming_languages`` list of the JSON
    object in a model reply, sorted and distinct; any failure gives ``[]``.

    Spark's JSON reader is more lenient than a strict parser in a few cases
    (trailing text after the object, single quotes, numbers in the list);
    ``techmine.functions.strict.parse_languages_strict`` is the exact one.
    """
    parsed = F.from_json(json_slice(raw), LANGS_SCHEMA,
                         {"allowSingleQuotes": "false", "mode": "PERMISSIVE"})
    langs = parsed["programming_languages"]
    ok = langs.isNotNull() & F.forall(langs, lambda x: x.isNotNull())
    return F.when(ok, sorted_distinct(langs)).otherwise(F.array().cast("array<string>"))


def cut_references(text, headings=REFERENCE_HEADINGS) -> Column:
    """SC20: drop everything from the first line that starts with a heading
    word (optionally numbered, any case), e.g. ``7. References``."""
    alts = "|".join(h for h in headings)
    pattern = (rf"(?is)(^|\n){WS_CLASS}*(?:[0-9]+\.?{WS_CLASS}*)?(?:{alts})"
               rf"(?:[^A-Za-z0-9_].*)?$")
    return F.regexp_replace(_c(text), pattern, "")


# Whitespace outside ASCII that str.split also splits on.
RARE_WS = "\x1c\x1d\x1e\x1f\x85\xa0\u1680" + "".join(chr(c) for c in range(0x2000, 0x200B)) \
    + "\u2028\u2029\u202f\u205f\u3000"
ASCII_WS_RUN = r"[\t\n\x0B\f\r ]+"
TOKEN_EDGE = '.,;:()"'


def split_ws(text) -> Column:
    """Split on runs of whitespace (same set as ``WS_CLASS``).  Rare Unicode
    spaces are first mapped to a space by ``translate`` (a char scan), so the
    regex is a plain ASCII class."""
    return F.split(F.translate(_c(text), RARE_WS, " " * len(RARE_WS)), ASCII_WS_RUN, -1)


def words(text) -> Column:
    """Non-empty whitespace tokens."""
    return F.filter(split_ws(text), lambda t: t != "")


def has_word(text) -> Column:
    """Whether ``words`` finds any; stops at the first character that is no whitespace."""
    return _c(text).rlike(f"[^{WS_CLASS[1:]}")


def tokens(text) -> Column:
    """Whitespace tokens with outer ``.,;:()"`` stripped (``+#`` and inner
    punctuation stay, so ``C++``, ``C#`` and ``CLP(R)`` keep their form).
    Tokens that were only punctuation stay as empty tokens, so positions and
    n-grams do not close over them."""
    return F.transform(split_ws(text), lambda t: F.btrim(t, F.lit(TOKEN_EDGE)))


def inverted_index(text) -> Column:
    """map<word, array<position>> of one text, built inside the row: the
    (word, position) pairs are sorted once, group starts are found in one
    pass, and each group's positions are sliced out.  No shuffle; the cost is
    O(n log n) in the text's own length."""
    def by_sorted(s):
        n = F.size(s)
        starts_of = F.filter(F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0))),
                             lambda j: (j == 0) | (F.get(s, j)["w"] != F.get(s, j - 1)["w"]))

        def by_starts(st):
            k = F.size(st)
            keys = F.transform(st, lambda x: F.get(s, x)["w"])
            vals = F.transform(st, lambda x, i: F.transform(
                F.sequence(x, F.coalesce(F.get(st, i + 1), n) - 1), lambda j: F.get(s, j)["p"].cast("long")))
            return F.when(k > 0, F.map_from_arrays(keys, vals))
        return let(starts_of, by_starts)

    pairs = F.sort_array(F.transform(words(text), lambda w, i: F.struct(w.alias("w"), i.alias("p"))))
    empty = F.create_map().cast("map<string,array<bigint>>")
    return F.coalesce(let(pairs, by_sorted), empty)


ENTRY_BITS = 24  # up to 16M distinct words per index; positions below 2^39


def reconstruct_abstract(index) -> Column:
    """SC1: rebuild text from an inverted index map<word, array<position>>.

    Each word is placed at each of its positions; when two words claim one
    position the later map entry wins; positions are read in order and joined
    with one space (gaps close up).  Null or empty map -> ''.

    Every (position, entry) pair is packed into one long,
    ``position << 24 | (2^24 - 1 - entry)``, so a primitive sort orders by
    position and puts the later entry first; the first code of each position
    wins (they are told apart only where a position comes twice) and its low bits
    give back the word.  Indexes out of that range (more
    than 2^24 words, negative positions or positions from 2^39) sort structs
    instead.
    """
    mask = (1 << ENTRY_BITS) - 1

    def from_map(m):
        return let(F.map_keys(m), lambda keys: from_keys(m, keys))

    def positions(m):
        return F.transform(F.map_values(m), lambda ps: F.coalesce(ps, F.array().cast("array<bigint>")))

    def from_keys(m, keys):
        return let(F.flatten(positions(m)), lambda flat: from_positions(m, keys, flat))

    def from_positions(m, keys, flat):
        fits = ((F.size(keys) <= mask) & (F.coalesce(F.array_min(flat), F.lit(0)) >= 0)
                & (F.coalesce(F.array_max(flat), F.lit(0)) < (1 << (63 - ENTRY_BITS))))
        once = F.size(F.array_distinct(flat)) == F.size(flat)
        return F.when(fits, packed(m, keys, once)).otherwise(structs(m, keys))

    def structs(m, keys):
        pairs = F.flatten(F.transform(positions(m), lambda ps, i: F.transform(
            ps, lambda p: F.struct(p.cast("long").alias("p"), (-i).alias("e")))))

        def pick(s):
            first = F.filter(s, lambda c, j: (j == 0) | (c["p"] != F.get(s, j - 1)["p"]))
            return F.transform(first, lambda c: F.get(keys, -c["e"]))
        return F.array_join(let(F.sort_array(pairs), pick), " ")

    def packed(m, keys, once):
        codes = F.flatten(F.transform(F.map_values(m), lambda ps, i: F.transform(
            F.coalesce(ps, F.array().cast("array<bigint>")),
            lambda p: F.shiftleft(p.cast("long"), ENTRY_BITS) + (F.lit(mask) - i))))

        def firsts(sorted_codes):
            return F.when(once, sorted_codes).otherwise(F.filter(sorted_codes, lambda c, j: (j == 0) | (
                F.shiftright(c, ENTRY_BITS) != F.shiftright(F.get(sorted_codes, j - 1), ENTRY_BITS))))
        words_of = F.transform(let(F.sort_array(codes), firsts),
                               lambda c: F.get(keys, F.lit(mask) - (c.bitwiseAND(F.lit(mask)))))
        return F.array_join(words_of, " ")

    return F.coalesce(let(_c(index), from_map), F.lit(""))


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once and pass it to ``body`` (a one-element
    ``transform`` acts as a let-binding; Catalyst does not share repeated
    subexpressions inside lambda functions)."""
    return F.get(F.transform(F.array(value), body), 0)
