"""Relational tables -> RDF triples, and basic-graph-pattern matching.

A graph is a DataFrame ``(s, p, o, o_kind, datatype)`` with set semantics
(``dropDuplicates`` over all five columns).  Subjects and IRI objects are full
IRIs; literal objects hold the lexical form.  Every family is a narrow
``explode`` of an array of optional structs, so building a graph shuffles only
once (the dedupe).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Namespaces and vocabulary of the exported graph.
SCHEMA = "https://schema.org/"
OPENALEX = "https://openalex.org/"
SKOS = "http://www.w3.org/2004/02/skos/core#"
RDF = "http://www.w3.org/1999/02/22-rdf-syntax-ns#"
XSD = "http://www.w3.org/2001/XMLSchema#"
PREFIXES = {"schema": SCHEMA, "skos": SKOS, "openalex": OPENALEX, "rdf": RDF, "xsd": XSD}

RDF_TYPE = RDF + "type"
SKOS_CONCEPT = SKOS + "Concept"
SKOS_PREF_LABEL = SKOS + "prefLabel"
SKOS_NARROWER = SKOS + "narrower"
SKOS_BROADER = SKOS + "broader"
SOFTWARE_APPLICATION = SCHEMA + "SoftwareApplication"
SCHOLARLY_ARTICLE = SCHEMA + "ScholarlyArticle"
TECH_ARTICLE = SCHEMA + "TechArticle"
XSD_DATE = XSD + "date"
XSD_INTEGER = XSD + "integer"
XSD_FLOAT = XSD + "float"

# IRI kinds (local-name prefixes) of the three entity tables.
KIND_TOPIC = "tematica"
KIND_TECHNOLOGY = "tecnologia"
KIND_WORK = "obra"

# Files of predicates that a writing task keeps open; with more it sorts.
WRITERS = "spark.sql.maxConcurrentOutputFileWriters"
OPEN_PREDICATES = 16

TRIPLE_COLS = ["s", "p", "o", "o_kind", "datatype"]


def iri(kind: str, id_col) -> Column:
    """SC8: ``openalex:{kind}_{id}`` as a full IRI."""
    c = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.concat(F.lit(f"{OPENALEX}{kind}_"), c.cast("string"))


def truthy(c: Column, numeric: bool = False) -> Column:
    """Non-null and non-empty (strings) / non-zero (numbers)."""
    return c.isNotNull() & ((c != 0) if numeric else (c.cast("string") != ""))


def plain_double(c: Column) -> Column:
    """Lexical form of a double: plain digits from 1e-4 to below 1e16, else the
    shortest digits with a signed exponent of two digits or more."""
    # Short on purpose: it is evaluated inside the one generated method per work.
    s, size = c.cast("double").cast("string"), F.abs(c.cast("double"))
    # 17 digits before the point and 21 behind hold every shortest form of the range.
    plain = F.regexp_replace(s.try_cast("decimal(38,21)").cast("string"), r"(\.[0-9]+?)0+$", "$1")
    scientific = s
    for form, to in ((r"\.0E", "E"), ("E([0-9])", r"e+$1"), ("E-([0-9])$", r"e-0$1"), ("E-", "e-")):
        scientific = F.regexp_replace(scientific, form, to)
    return F.when(~s.contains("E"), s).when((size >= 1e-4) & (size < 1e16), plain).otherwise(scientific)


def _t(pred: str, obj: Column, kind: str, datatype: str | None = None) -> Column:
    return F.struct(F.lit(pred).alias("p"), obj.cast("string").alias("o"),
                    F.lit(kind).alias("o_kind"), F.lit(datatype).cast("string").alias("datatype"))


def _family(df: DataFrame, subject: Column, emits: list[tuple[Column, Column]]) -> DataFrame:
    """Explode (condition, triple-struct) pairs per row; false conditions emit nothing."""
    arr = F.array(*[F.when(cond, t) for cond, t in emits])
    return (df.select(subject.alias("s"), F.explode(arr).alias("t"))
              .where(F.col("t").isNotNull())
              .select("s", "t.p", "t.o", "t.o_kind", "t.datatype"))


def topic_triples(topic: DataFrame) -> DataFrame:
    """GR1: every topic is a skos:Concept; a truthy name becomes its prefLabel."""
    name = F.col("name")
    return _family(topic, iri(KIND_TOPIC, "id"), [
        (F.lit(True), _t(RDF_TYPE, F.lit(SKOS_CONCEPT), "iri")),
        (truthy(name), _t(SKOS_PREF_LABEL, name, "literal")),
    ])


def edge_triples(edge: DataFrame) -> DataFrame:
    """GR2: each parent->child edge gives narrower and its inverse broader."""
    ok = truthy(F.col("parent_id"), True) & truthy(F.col("child_id"), True)
    e = edge.where(ok)
    down = e.select(iri(KIND_TOPIC, "parent_id").alias("s"), F.lit(SKOS_NARROWER).alias("p"),
                    iri(KIND_TOPIC, "child_id").alias("o"))
    up = e.select(iri(KIND_TOPIC, "child_id").alias("s"), F.lit(SKOS_BROADER).alias("p"),
                  iri(KIND_TOPIC, "parent_id").alias("o"))
    return (down.unionByName(up)
                .withColumn("o_kind", F.lit("iri"))
                .withColumn("datatype", F.lit(None).cast("string")))


def technology_triples(technology: DataFrame) -> DataFrame:
    """GR3: type, plus name / applicationCategory / softwareVersion when truthy."""
    c = F.col
    return _family(technology, iri(KIND_TECHNOLOGY, "id"), [
        (F.lit(True), _t(RDF_TYPE, F.lit(SOFTWARE_APPLICATION), "iri")),
        (truthy(c("name")), _t(SCHEMA + "name", c("name"), "literal")),
        (truthy(c("kind")), _t(SCHEMA + "applicationCategory", c("kind"), "literal")),
        (truthy(c("version")), _t(SCHEMA + "softwareVersion", c("version"), "literal")),
    ])


def work_triples(work: DataFrame, profile: str = "default") -> DataFrame:
    """GR4: work triples.  ``profile="notebook"`` is the notebook variant:
    TechArticle, sameAs for the doi, and citations / metric only when truthy."""
    c = F.col
    nb = profile == "notebook"
    cites_ok = truthy(c("citations"), True) if nb else c("citations").isNotNull()
    fwci_ok = truthy(c("fwci"), True) if nb else c("fwci").isNotNull()
    return _family(work, iri(KIND_WORK, "id"), [
        (F.lit(True), _t(RDF_TYPE, F.lit(TECH_ARTICLE if nb else SCHOLARLY_ARTICLE), "iri")),
        (truthy(c("doi")), _t(SCHEMA + ("sameAs" if nb else "identifier"), c("doi"), "literal")),
        (truthy(c("source_url")), _t(SCHEMA + "url", c("source_url"), "literal")),
        (truthy(c("title")), _t(SCHEMA + "name", c("title"), "literal")),
        (truthy(c("abstract")), _t(SCHEMA + "abstract", c("abstract"), "literal")),
        (truthy(c("published")), _t(SCHEMA + "datePublished", c("published"), "literal", XSD_DATE)),
        (truthy(c("language")), _t(SCHEMA + "inLanguage", c("language"), "literal")),
        (cites_ok, _t(SCHEMA + "citationCount", c("citations").cast("long"), "literal", XSD_INTEGER)),
        (fwci_ok, _t(SCHEMA + "metric", plain_double(c("fwci")), "literal", XSD_FLOAT)),
        (truthy(c("topic_id"), True), _t(SCHEMA + "about", iri(KIND_TOPIC, "topic_id"), "iri")),
    ])


def mention_triples(mention: DataFrame) -> DataFrame:
    """GR5: work schema:mentions technology (both ids truthy).  Duplicate links
    collapse: the dedupe runs on the two id columns, before IRIs are minted."""
    ok = truthy(F.col("work_id"), True) & truthy(F.col("technology_id"), True)
    return (mention.where(ok).select("work_id", "technology_id").distinct()
                   .select(iri(KIND_WORK, "work_id").alias("s"), F.lit(SCHEMA + "mentions").alias("p"),
                           iri(KIND_TECHNOLOGY, "technology_id").alias("o"),
                           F.lit("iri").alias("o_kind"), F.lit(None).cast("string").alias("datatype")))


def distinct_triples(*families: DataFrame) -> DataFrame:
    """SET1 + SET2 + AG5: union of arbitrary families with set semantics."""
    out = families[0].select(*TRIPLE_COLS)
    for f in families[1:]:
        out = out.unionByName(f.select(*TRIPLE_COLS))
    return out.dropDuplicates(TRIPLE_COLS)


def ids_unique(df: DataFrame, key: str = "id") -> bool:
    """True when no key value repeats (a partial aggregate over the key column
    only)."""
    return not repeated_keys({"t": df}, key)


def repeated_keys(tables: dict[str, DataFrame], key: str = "id") -> set[str]:
    """Names of the tables whose key repeats, checked in one job over the key
    columns only."""
    parts = [df.select(F.lit(name).alias("__t"), F.col(key).alias("__k")) for name, df in tables.items()]
    keys = parts[0]
    for p in parts[1:]:
        keys = keys.unionByName(p)
    dup = (keys.groupBy("__t", "__k").agg(F.count(F.lit(1)).alias("n"))
               .where(F.col("n") > 1).select("__t").distinct())
    return {r[0] for r in dup.collect()}  # at most len(tables) rows


def graph(topic: DataFrame | None = None, edge: DataFrame | None = None,
          technology: DataFrame | None = None, work: DataFrame | None = None,
          mention: DataFrame | None = None, profile: str = "default") -> DataFrame:
    """The whole export with set semantics.

    The families never share a (subject kind, predicate) pair, so the union of
    per-family sets is a set.  An entity family emits each (subject,
    predicate) at most once per row, so it is a set when its ids are unique
    (checked for all entity tables in one job; a table with repeated ids gets
    a dedupe of its own triples).  Edges and mentions are deduplicated on
    their id pairs before IRIs are minted.  The triples themselves are never
    shuffled.
    """
    entities = {k: v for k, v in (("topic", topic), ("technology", technology), ("work", work))
                if v is not None}
    repeated = repeated_keys(entities) if entities else set()
    builders = {"topic": topic_triples, "technology": technology_triples,
                "work": lambda w: work_triples(w, profile)}
    fams = []
    for name, df in entities.items():
        fam = builders[name](df.where(F.col("id").isNotNull()))
        fams.append(fam.dropDuplicates(TRIPLE_COLS) if name in repeated else fam)
    if edge is not None:
        fams.append(edge_triples(edge.select("parent_id", "child_id").distinct()))
    if mention is not None:
        fams.append(mention_triples(mention))
    out = fams[0].select(*TRIPLE_COLS)
    for f in fams[1:]:
        out = out.unionByName(f.select(*TRIPLE_COLS))
    return out


def write_triples(triples: DataFrame, path: str) -> None:
    """Persist a graph partitioned by predicate, so pattern scans prune partitions.

    The ``rebalance`` hint lets adaptive execution cluster rows by predicate
    and cut them into advisory-size partitions: a large predicate (mentions)
    is split over many files, small ones are merged, so the folder holds
    neither one giant file nor tasks x predicates small ones.  A task keeps the
    files of its few predicates open, so it need not sort its triples by them.
    """
    conf = triples.sparkSession.conf
    before = conf.get(WRITERS)
    conf.set(WRITERS, str(max(int(before), OPEN_PREDICATES)))
    try:
        (triples.select(*TRIPLE_COLS).hint("rebalance", "p")
                .write.mode("overwrite").partitionBy("p").parquet(path))
    finally:
        conf.set(WRITERS, before)


def read_triples(spark, path: str) -> DataFrame:
    return spark.read.parquet(path).select(*TRIPLE_COLS)


# ---------------------------------------------------------------- matching

_KIND = "__kind_"


def _is_var(term) -> bool:
    return isinstance(term, str) and term.startswith("?")


def _pattern(triples: DataFrame, pat: tuple) -> DataFrame:
    """One triple pattern -> filtered, pruned scan with one column per variable."""
    s, p, o = pat
    df = triples
    cols = {}
    for term, col in ((s, "s"), (p, "p"), (o, "o")):
        if _is_var(term):
            name = term[1:]
            if name in cols:  # same variable twice in one pattern
                df = df.where(F.col(cols[name]) == F.col(col))
                if col == "o":
                    df = df.where(F.col("o_kind") == "iri")
            else:
                cols[name] = col
        else:
            df = df.where(F.col(col) == F.lit(term))
    kind = {"s": F.lit("iri"), "p": F.lit("iri"),
            "o": F.concat_ws("^", "o_kind", F.coalesce("datatype", F.lit("")))}
    kind["o"] = F.when(F.col("o_kind") == "iri", F.lit("iri")).otherwise(kind["o"])
    return df.select(*[F.col(c).alias(v) for v, c in cols.items()],
                     *[kind[c].alias(_KIND + v) for v, c in cols.items()])


def _join_all(parts: list[DataFrame]) -> DataFrame:
    """Join patterns in any order: next is always one that shares a variable."""
    out, left = parts[0], list(parts[1:])
    while left:
        part = next((p for p in left if _shared(out, p)), None)
        if part is None:
            raise ValueError("patterns share no variable: refusing a cross product")
        left = [p for p in left if p is not part]
        out = _joined(out, part)
    return out


def _shared(a: DataFrame, b: DataFrame) -> list[str]:
    return [c for c in b.columns if c in a.columns and not c.startswith(_KIND)]


def _joined(a: DataFrame, b: DataFrame, how: str = "inner") -> DataFrame:
    """Join on the shared variables; the kind of a term (IRI, or literal with its
    datatype) must be equal too."""
    keys = _shared(a, b)
    return a.join(b, keys + [_KIND + k for k in keys], how)


def match(triples: DataFrame, patterns: list[tuple], optional: list[list[tuple]] = (),
          filters: list[Column] = ()) -> DataFrame:
    """GR6: basic graph pattern + OPTIONAL groups + FILTERs as DataFrame joins.

    ``patterns`` are (s, p, o) with ``?name`` variables and constant IRIs or
    literal lexical forms; the result has one column per variable (no ``?``).
    Each OPTIONAL group is left-joined on its shared variables; a FILTER that
    requires optional variables to be bound lets Catalyst turn the left join
    into an inner one.
    """
    out = _join_all([_pattern(triples, p) for p in patterns])
    for group in optional:
        g = _join_all([_pattern(triples, p) for p in group])
        if not _shared(out, g):
            raise ValueError("optional group shares no variable with the pattern")
        out = _joined(out, g, "left")
    for f in filters:
        out = out.where(f)
    return out.select(*[c for c in out.columns if not c.startswith(_KIND)])


def bound(*names: str) -> Column:
    """SPARQL BOUND over one or more variables."""
    cond = F.lit(True)
    for n in names:
        cond = cond & F.col(n).isNotNull()
    return cond
