"""Surrogates for personal data (native: no Python in tasks).

Expressions find e-mail addresses, IPv4 addresses, payment cards (Luhn), social
security numbers, phone numbers and names behind a form of address.  Every
distinct entity of the corpus gets one keyed surrogate of its own type and
shape: letters become letters of the same script, case and kind (vowel or
consonant), digits become digits, separators stay; a card keeps its issuer digit
and a valid check digit, an address its private or public range, a domain its
top level, a phone number its country code, a name the gender that the form of
address tells (in its last letter).

Entities are compared in a normal form (letters lower-case, separators of
numbers dropped; the country code of a phone number is known from its digits,
numbers written in the national form 3-3-4 have code 1, a trunk zero in
parentheses does not count), so mentions in several formats, and full and short names,
keep pointing to the same person.  Candidates that equal an entity of the corpus
or another surrogate are drawn again with the next attempt, until all are
distinct.

Defined results: a null text stays null and has no entities; repeated rows get
equal results; an empty table gives an empty result.  Other columns, whatever
their names, pass through untouched.  The key is a parameter: the same key gives
the same surrogates for the same corpus.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from techmine.llm.common import prepare, small_side, stored

TYPES = ("email", "ip", "ssn", "phone", "run", "name")

# Forms of address: gender -> words.
ADDRESS = {"m": ("Mr", "Herr", "Herrn", "Señor", "Sr", "Monsieur", "Г-н", "Господин", "Κύριος"),
           "f": ("Mrs", "Ms", "Miss", "Frau", "Señora", "Sra", "Madame", "Mme", "Г-жа", "Госпожа", "Κυρία")}
_ADDRESS = "|".join(sorted((w for ws in ADDRESS.values() for w in ws), key=lambda w: -len(w)))
# Words inside family names that are not capitalised.
_PARTICLES = "|".join(("de", "del", "della", "da", "das", "di", "do", "dos", "du", "la", "las", "los", "le", "van", "von",
                       "der", "den", "ten", "ter", "zu", "zum", "zur", "bin", "ibn", "al", "el", "y", "e"))
_OCTET = r"(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"

_NATIONAL = r"(?<![0-9+])[0-9]{3}[.\-][0-9]{3}[.\-][0-9]{4}(?![0-9])"
_DOTTED = r"(?<![0-9+])[0-9]{3}(?:\.[0-9]{3}[.\-]|-[0-9]{3}\.)[0-9]{4}(?![0-9])"
_EMAIL = r"(?<![\p{L}\p{N}._%+\-])[\p{L}\p{N}._%+\-]++@[\p{L}\p{N}\-]++(?:\.[\p{L}\p{N}\-]++)*+(?<=\.\p{L}{2,24})"
_IP = rf"(?<![0-9.])(?:{_OCTET}\.){{3}}{_OCTET}(?![0-9]|\.[0-9])"
_SSN = r"(?<![0-9\-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9\-])"
_FOURS = r"[0-9]{4}(?:(?:[ \-][0-9]{4}){2}[ \-][0-9]{1,4}|[ \-][0-9]{6}[ \-][0-9]{4,5})(?![0-9])"
# What ends a phone number (behind a space) or a run of digits that goes on there.  Behind a
# hyphen, a number with hyphens alone can still be part of a card: that is decided inside the run.
_NEXT = f"(?!{_EMAIL}|{_IP}|{_SSN}|{_NATIONAL}|{_FOURS})"
_OTHER = f"(?!{_EMAIL}|{_IP}|{_SSN}|{_DOTTED}|(?<!-){_NATIONAL})"

PATTERNS = {
    "email": _EMAIL,
    "ip": _IP,
    "ssn": _SSN,
    "phone": r"(?<![0-9+])(?:\+1[ .\-]?(?:\([0-9]{3}\)|[0-9]{3})[ .\-]?[0-9]{3}[ .\-]?[0-9]{4}(?![0-9])"
             r"|\+[0-9]{1,3}[ .\-]?(?:\([0-9]{1,4}\)[ .\-]?)?[0-9](?:[ .\-]?[0-9]){5}"
             rf"(?:(?:[ ]{_NEXT}|[.\-])?[0-9]){{0,7}}"
             rf"|\([0-9]{{3}}\)[ .\-]?[0-9]{{3}}[ .\-][0-9]{{4}}|{_NATIONAL})(?![0-9])",
    # Digits with single spaces or hyphens, as far as they go: cards are looked for inside.
    "run": rf"(?<![0-9]){_OTHER}[0-9](?:[ \-]?{_OTHER}[0-9]){{12,}}+",
    "name": rf"(?<![\p{{L}}])(?:{_ADDRESS})\.?[ ]\p{{Lu}}\p{{Ll}}+(?:[ \-](?:(?:{_PARTICLES})[ ])*\p{{Lu}}\p{{Ll}}+)*+",
}
# Groups of digits as cards are usually written.
CARD_GROUPS = "^(?:1[3-9]|4-4-4-4(?:-3)?|4-4-4-1|4-4-5|4-6-[45]|4-5-6|4-3-3-3|6-13)$"
CARD_DIGITS = (13, 19)
# Country codes; none starts another.
COUNTRY = "^(?:1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|[0-9]{3})"
ANY = "|".join(f"(?:{PATTERNS[t]})" for t in TYPES)

# Every match holds one of these: an at sign, seven digits with at most two other
# characters between them, four numbers with dots, or a form of address.
MAYBE = (r"@|[0-9](?:[ .()\-]{0,2}[0-9]){6}|[0-9]\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]"
         rf"|(?=[{''.join(sorted({w[0] for ws in ADDRESS.values() for w in ws}))}])(?:{_ADDRESS})\.?[ ]\p{{Lu}}")

# Alphabets by script: vowels and consonants (lower case).  Letters beyond them are drawn
# from the first consonants of their script.
SCRIPTS = (("aeiou", "bcdfghjklmnpqrstvwxyz"), ("àáâãäåæèéêëìíîïòóôõöøùúûüýÿāăąēęěīįōőūůű", "çćčďđğłñńňřśşšßťźżž"),
           ("аеиоуыэюя", "бвгджзйклмнпрстфхцчшщъь"), ("αεηιουωάέήίόύώ", "βγδζθκλμνξπρσςτφχψ"))
OTHERS = ((r"\p{IsCyrillic}", SCRIPTS[2][1]), (r"\p{IsGreek}", SCRIPTS[3][1]), (r"\p{L}", SCRIPTS[0][1]))
FIRST_OCTETS = (11, 126)     # public surrogates
PRIVATE = r"^(?:10\.|127\.|192\.168\.|172\.(?:1[6-9]|2[0-9]|3[01])\.)"
GROW_EVERY = 4               # attempts after which a surrogate with letters gets one more


def _digits(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


def _luhn_sum(digits: Column) -> Column:
    """Luhn sum of a digit string with a check digit."""
    def step(d, i):
        twice = d.cast("int") * 2
        return F.when(i % 2 == 0, d.cast("int")).otherwise(F.when(twice > 9, twice - 9).otherwise(twice))
    return F.aggregate(F.transform(F.split(F.reverse(digits), ""), step), F.lit(0),
                       lambda a, x: a + F.coalesce(x, F.lit(0)))


def _type(m: Column) -> Column:
    """Type of a match; ``run`` for digits in which cards are looked for."""
    kind = F.when(m.contains("@"), "email").when(m.rlike(rf"^{_OCTET}(?:\.{_OCTET}){{3}}$"), "ip")
    kind = kind.when(m.rlike(f"^(?:{PATTERNS['ssn']})$"), "ssn").when(m.rlike(r"^\p{L}"), "name")
    return kind.when(m.rlike(f"^(?:{PATTERNS['phone']})$"), "phone").otherwise("run")


def _let(c: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.get(F.transform(F.array(c), body), F.lit(0))


def _marked(run: Column) -> Column:
    """A run of digits with ``<`` and ``>`` around its cards: groups next to each
    other whose digits have a valid check digit.

    From left to right the longest card is taken; groups as cards are usually
    written come before others, which must not reach into them."""
    low, high = CARD_DIGITS

    def longest(groups, i, more):
        """Number of groups from ``i`` on that are a card, 0 if none."""
        def card(k):
            some = F.slice(groups, i + 1, k)
            return _let(F.array_join(some, ""), lambda d: F.length(d).between(low, high) & more(some, k) & (
                _luhn_sum(d) % 10 == 0))
        sizes = F.sequence(F.lit(1), F.least(F.lit(high), F.size(groups) - i))
        return F.coalesce(F.array_max(F.filter(sizes, card)), F.lit(0))

    def usual(some, k):
        return F.array_join(F.transform(some, lambda g: F.length(g).cast("string")), "-").rlike(CARD_GROUPS)

    def scan(units, groups, firsts):
        def step(a, i):
            first = F.get(firsts, i)
            free = lambda some, k: ~F.exists(F.slice(firsts, i + 2, k - 1), lambda x: x > 0)
            take = F.when(i < a["end"], 0).when(first > 0, first).otherwise(longest(groups, i, free))
            return _let(take, lambda t: _let(F.when(t > 0, i + t).otherwise(a["end"]), lambda end: F.struct(
                end.alias("end"),
                F.concat(a["out"], F.translate(F.get(units, i), "0123456789", ""), F.when(t > 0, "<").otherwise(""),
                         F.get(groups, i), F.when(end == i + 1, ">").otherwise("")).alias("out"))))
        start = F.struct(F.lit(0).alias("end"), F.lit("").alias("out"))
        return F.aggregate(F.sequence(F.lit(0), F.size(groups) - 1), start, step, lambda a: a["out"])

    def with_groups(units, groups):
        firsts = F.transform(groups, lambda g, i: longest(groups, i, usual))
        return _let(firsts, lambda x: scan(units, groups, x))

    units = F.regexp_extract_all(run, F.lit("[ -]?[0-9]+"), F.lit(0))
    return _let(units, lambda u: _let(F.transform(u, lambda x: F.translate(x, " -", "")), lambda g: with_groups(u, g)))


def _pieces(kind: Column, m: Column) -> Column:
    """The typed pieces of a match, with the text before them and behind the
    last: the match itself, or the cards and other numbers inside a run."""
    inner = f"<[^>]*>|{PATTERNS['ssn']}|{PATTERNS['phone']}"

    def piece(before, kind, value, after):
        return F.struct(before.alias("before"), kind.alias("type"), value.alias("value"), after.alias("after"))

    def of(marked):
        hits, gaps = F.regexp_extract_all(marked, F.lit(inner), F.lit(0)), F.split(marked, inner, -1)
        return _let(F.struct(hits.alias("hits"), gaps.alias("gaps")), lambda x: F.transform(x["hits"], lambda h, i: piece(
            F.get(x["gaps"], i),
            F.when(h.startswith("<"), "card").when(h.rlike(f"^(?:{PATTERNS['ssn']})$"), "ssn").otherwise("phone"),
            F.translate(h, "<>", ""),
            F.when(i == F.size(x["hits"]) - 1, F.get(x["gaps"], i + 1)).otherwise(""))))

    return F.when(kind == "run", _let(_marked(m), of)).otherwise(F.array(piece(F.lit(""), kind, m, F.lit(""))))


def _keyed(key: str, *parts: Column) -> Column:
    """Keyed hash (nested, so that lengths can't be extended): 128 hex digits."""
    return F.sha2(F.concat(F.lit(key), F.sha2(F.concat_ws("\x1f", F.lit(key), *parts), 512)), 512)


def _draw(hashed: Column, i: Column, n: int) -> Column:
    """The i-th number below ``n`` of a hash."""
    at = (i * 3) % 123 + 1
    return F.pmod(F.conv(F.substring(hashed, at, 4), 16, 10).cast("int") + i, F.lit(n))


def _letter(ch: Column, hashed: Column, i: Column) -> Column:
    """A character of the same script, case and kind; others stay."""
    out = F.when(ch.rlike("[0-9]"), _draw(hashed, i, 10).cast("string"))
    for pair in SCRIPTS:
        for alphabet in pair:
            pick = F.substring(F.lit(alphabet), _draw(hashed, i, len(alphabet)) + 1, F.lit(1))
            out = out.when(F.lit(alphabet).contains(ch), pick)
    for letters, alphabet in OTHERS:
        out = out.when(ch.rlike(letters), F.substring(F.lit(alphabet), _draw(hashed, i, len(alphabet)) + 1, F.lit(1)))
    return out.otherwise(ch)


def _shaped(text: Column, hashed: Column) -> Column:
    """``text`` (lower-case) with every letter and digit drawn anew."""
    return F.array_join(F.transform(F.split(text, ""), lambda ch, i: F.when(ch == "", ch).otherwise(
        _letter(ch, hashed, i))), "")


def _grown(attempt: Column, hashed: Column) -> Column:
    """One more letter for every few attempts, where shapes are too few."""
    more = F.floor(attempt / GROW_EVERY).cast("int")
    return F.when(more > 0, F.translate(F.substring(hashed, F.lit(60), more), "0123456789", "ghjkmnpqrs")).otherwise("")


def candidate(kind: Column, norm: Column, gender: Column, attempt: Column, key: str) -> Column:
    """The surrogate, in normal form, that an attempt draws for an entity."""
    h = _keyed(key, kind, norm, attempt.cast("string"))
    local, domain = F.substring_index(norm, "@", 1), F.substring_index(norm, "@", -1)
    top = F.regexp_extract(domain, r"\.[^.]*$", 0)
    # Addresses of one domain keep one domain.
    host = F.substring(domain, F.lit(1), F.length(domain) - F.length(top))
    email = F.concat(_shaped(local, h), _grown(attempt, h), F.lit("@"),
                     _shaped(host, _keyed(key, F.lit("domain"), domain)), top)
    octet = lambda i: (_draw(h, F.lit(i), 254) + 1).cast("string")
    low, high = FIRST_OCTETS
    first = F.when(norm.rlike(PRIVATE), F.lit("10")).otherwise(
        (_draw(h, F.lit(7), high - low + 1) + low).cast("string"))
    ip = F.concat_ws(".", first, octet(1), octet(2), octet(3))
    size = F.length(norm)
    body = F.concat(F.substring(norm, 1, 1), F.substring(_shaped(norm, h), F.lit(2), size - 2))
    card = F.concat(body, F.pmod(10 - _luhn_sum(F.concat(body, F.lit("0"))) % 10, F.lit(10)).cast("string"))
    # The normal form of a phone number has its country code before a colon.
    code = F.substring_index(norm, ":", 1)
    phone = F.concat(code, F.lit(":"), _shaped(F.substring_index(norm, ":", -1), h))
    last = F.substring(norm, -1, 1)
    name = F.concat(_shaped(F.substring(norm, F.lit(1), size - 1), h), _grown(attempt, h))
    script = F.when(last.rlike(r"\p{IsCyrillic}"), "cyrillic").when(last.rlike(r"\p{IsGreek}"), "greek").otherwise("latin")
    ending = (F.when(gender == "f", F.when(script == "cyrillic", "а").when(script == "greek", "α").otherwise("a"))
               .when(gender == "m", F.when(script == "cyrillic", "н").when(script == "greek", "ς").otherwise("n"))
               .otherwise(_letter(last, h, size)))
    return (F.when(kind == "email", email).when(kind == "ip", ip).when(kind == "card", card)
             .when(kind == "phone", phone).when(kind == "name", F.concat(name, ending)).otherwise(_shaped(norm, h)))


def surrogates(entities: DataFrame, key: str) -> DataFrame:
    """(type, norm, surrogate) of the distinct ``entities`` (type, norm, gender).

    Every round draws candidates for the entities still open; one that equals an
    entity or a surrogate already given is out, and of equal ones the smallest
    entity keeps it.  Both checks are joins on (type, value), whose keys are
    distinct on the side that is looked up.
    """
    entities = stored(entities, "entities")
    real = entities.select("type", F.col("norm").alias("surrogate"))
    given = None
    open_ = entities.withColumn("attempt", F.lit(0))
    while True:
        drawn = stored(open_.withColumn("surrogate", candidate(
            F.col("type"), F.col("norm"), F.col("gender"), F.col("attempt"), key)), "drawn")
        taken = real if given is None else real.union(given.select("type", "surrogate"))
        first = drawn.groupBy("type", "surrogate").agg(F.min("norm").alias("norm"))
        fresh = stored(first.join(taken, ["type", "surrogate"], "left_anti").select("type", "norm", "surrogate"), "given")
        given = fresh if given is None else given.unionByName(fresh)
        open_ = drawn.join(fresh, ["type", "norm"], "left_anti").withColumn("attempt", F.col("attempt") + 1).select(
            "type", "norm", "gender", "attempt")
        open_ = stored(open_, "open")
        if open_.isEmpty():
            return given


def _entities_of(kind: Column, m: Column) -> Column:
    """The entities of a match: itself, or the words of a name."""
    gender = F.when(m.rlike(f"^(?:{'|'.join(ADDRESS['m'])})[. ]"), "m").otherwise("f")
    words = F.split(F.regexp_replace(m, rf"^(?:{_ADDRESS})\.?[ ]", ""), "[ -]")
    n = F.size(words)
    # The last word is the family name unless it is the only one; it has no gender.
    named = F.transform(words, lambda w, i: F.struct(
        w.alias("value"), F.lower(w).alias("norm"), F.when(i < n - 1, gender).otherwise("").alias("gender")))
    digits = _digits(m)
    dialled = F.when(m.startswith("+"), _digits(F.replace(m, F.lit("(0)"), F.lit("")))).otherwise(F.concat(F.lit("1"), digits))
    code = F.regexp_extract(dialled, COUNTRY, 0)
    phone = F.concat(code, F.lit(":"), F.substring(dialled, F.length(code) + 1, F.length(dialled)))
    norm = F.when(kind.isin("card", "ssn"), digits).when(kind == "phone", phone).otherwise(F.lower(m))
    whole = F.array(F.struct(m.alias("value"), norm.alias("norm"), F.lit("").alias("gender")))
    return F.when(kind == "name", named).otherwise(whole)


def _like(value: Column, surrogate: Column) -> Column:
    """``surrogate`` (normal form) written as ``value`` is: its separators, its
    case (all capitals, or capitals in their places)."""
    # A number without its country code, and a trunk zero, are written so again.
    digits = F.split(_digits(F.when(value.startswith("+"), surrogate).otherwise(F.substring_index(surrogate, ":", -1))), "")
    trunk = F.when(value.startswith("+"), F.replace(value, F.lit("(0)"), F.lit("(o)"))).otherwise(value)
    spread = F.array_join(F.aggregate(
        F.split(trunk, ""), F.struct(F.lit(0).alias("i"), F.array().cast("array<string>").alias("out")),
        lambda a, ch: F.struct(
            (a["i"] + ch.rlike("^[0-9]$").cast("int")).alias("i"),
            F.concat(a["out"], F.array(F.when(ch.rlike("^[0-9]$"), F.get(digits, a["i"])).otherwise(ch))).alias("out")),
        lambda a: a["out"]), "")
    spread = F.replace(spread, F.lit("(o)"), F.lit("(0)"))
    letters = F.split(value, "")
    cased = F.array_join(F.transform(F.split(surrogate, ""), lambda ch, i: F.when(
        F.coalesce(F.get(letters, i).rlike(r"^\p{Lu}$"), F.lit(False)), F.upper(ch)).otherwise(ch)), "")
    return F.when(value.rlike(r"^[0-9 .()+\-]+$") & ~value.rlike(r"\."), spread).when(
        value.rlike(rf"^{_OCTET}(?:\.{_OCTET}){{3}}$"), surrogate).when(
        value.rlike(r"^[0-9 .()+\-]+$"), spread).otherwise(cased)


def surrogated(docs: DataFrame, key: str, text: str = "text") -> DataFrame:
    """``docs`` with surrogates in ``text``, and in columns ``__llm_types`` the
    type of every entity in order (an empty array if none).

    Rows without a match go straight through.  The others are stored with a row
    number; their matches are exploded, meet the surrogates by (type, normal
    form), and are gathered per row again.
    """
    prepare(docs.sparkSession)
    columns = docs.columns
    # The cheap test first: few texts hold anything the whole expression must look at.
    matches = F.when(F.col(text).rlike(MAYBE), F.regexp_extract_all(F.col(text), F.lit(ANY), F.lit(0)))
    found = docs.withColumn("__llm_m", F.coalesce(matches, F.array().cast("array<string>")))
    plain = found.where(F.size("__llm_m") == 0).select(
        *columns, F.array().cast("array<string>").alias("__llm_types"))
    rows = stored(found.where(F.size("__llm_m") > 0).withColumn("__llm_row", F.monotonically_increasing_id()), "pii-rows")
    mentions = rows.select("__llm_row", F.posexplode("__llm_m").alias("pos", "match"))
    mentions = mentions.select("__llm_row", "pos", F.posexplode(_pieces(_type(F.col("match")), F.col("match"))).alias("piece", "p"))
    mentions = mentions.select("__llm_row", "pos", "piece", "p.before", "p.type", F.col("p.value").alias("match"), "p.after")
    parts = mentions.withColumn("parts", _entities_of(F.col("type"), F.col("match")))
    where = ("__llm_row", "pos", "piece", "before", "type", "match", "after")
    parts = stored(parts.select(*where, F.posexplode("parts").alias("part", "e"))
                        .select(*where, "part", "e.value", "e.norm", "e.gender"), "pii-parts")
    # A word seen with and without a gender is one entity.
    entities = parts.groupBy("type", "norm").agg(F.max("gender").alias("gender"))
    given = small_side(stored(surrogates(entities, key), "pii-surrogates"))
    done = parts.join(given, ["type", "norm"]).withColumn("new", _like(F.col("value"), F.col("surrogate")))
    # One exchange for the three steps from parts to rows.
    per_piece = done.repartition("__llm_row").groupBy("__llm_row", "pos", "piece").agg(
        *[F.first(c).alias(c) for c in ("before", "type", "match", "after")],
        F.sort_array(F.collect_list(F.struct("part", "value", "new"))).alias("parts"))
    # A name's words are replaced behind its form of address.
    address = F.regexp_extract("match", rf"^(?:{_ADDRESS})\.?[ ]", 0)
    gaps = F.regexp_extract_all(F.regexp_replace("match", rf"^(?:{_ADDRESS})\.?[ ]", ""), F.lit("[ -]"), F.lit(0))
    named = F.concat(address, F.array_join(F.transform("parts", lambda p, i: F.concat(
        p["new"], F.coalesce(F.get(gaps, i), F.lit("")))), ""))
    new = F.when(F.col("type") == "name", named).otherwise(F.get("parts", F.lit(0))["new"])
    per_piece = per_piece.withColumn("new", F.concat("before", new, "after"))
    per_match = per_piece.groupBy("__llm_row", "pos").agg(F.sort_array(F.collect_list(F.struct("piece", "type", "new"))).alias("p"))
    per_row = per_match.groupBy("__llm_row").agg(
        F.map_from_entries(F.collect_list(F.struct("pos", F.array_join("p.new", "").alias("new")))).alias("__llm_new"),
        F.flatten(F.transform(F.sort_array(F.collect_list(F.struct("pos", F.col("p.type").alias("types")))),
                              lambda x: x["types"])).alias("__llm_types"))
    joined = rows.join(per_row, "__llm_row", "left")
    between = F.split(F.col(text), ANY, -1)
    rebuilt = F.array_join(F.transform(between, lambda part, i: F.concat(part, F.coalesce(
        F.element_at("__llm_new", i), F.get("__llm_m", i), F.lit("")))), "")
    changed = joined.withColumn("__llm_types", F.coalesce("__llm_types", F.array().cast("array<string>")))
    changed = changed.withColumn(text, F.when(F.size("__llm_types") > 0, rebuilt).otherwise(F.col(text)))
    return plain.unionByName(changed.select(*columns, "__llm_types"))
