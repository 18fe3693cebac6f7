"""Text queries on ``documents``, ``conversations``, ``events`` and ``pages``:
previews and gates (SC10-SC12, FIL5-FIL7), trimming and casts (SC5-SC7),
model-reply parsing (SC14-SC16, DET1), abstracts (SC1), ordered page
concatenation (AG6), vocabulary detection (DET2, SC20), user detectors
(UDF1), HTML extraction (SC13, SC17-SC19) and content resolution (RES1).

The driver data contains none of the reference's gate phrases or reference
headings, so the registered queries pass phrases and headings that do occur
in the data; unit tests use the reference's own lists.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from techmine.functions import text as TX
from techmine.functions.html import extract_html
from techmine.operators import detect as DT
from techmine.operators.inverted_index import inverted_index
from techmine.operators.pages import join_pages
from techmine.operators.resolve import resolve_text
from techmine.plans.registry import query
from techmine.sources.tables import table

WS = TX.WS_CLASS
STRIP_SQL = f"'^{WS}+|{WS}+$'"

# Parameters of the registered queries (words that occur in the driver data).
GATE_PHRASES = ["in the", "de la", "und der"]
SOFT_PHRASES = ["que la", "of the"]
HEADINGS = ["the", "und"]
VOCABULARY = ["the", "The", "of the", "in the", "de", "la", "de la", "der", "die", "und",
              "que", "a", "is", "C++", "Scratch Jr."]
DETECT_WORDS = ["the", "de", "der", "que", "und"]


def _sql_list(words):
    return ", ".join("'" + w.replace("'", "''") + "'" for w in words)


def _contains_any_sql(expr, phrases):
    return "(" + " OR ".join(f"contains(lower({expr}), '{p}')" for p in phrases) + ")"


def _preview_sql(expr, n=TX.PREVIEW_CHARS):
    return f"replace(substr({expr}, 1, {n}), chr(10), ' ')"


def _strip_sql(expr):
    return f"regexp_replace({expr}, {STRIP_SQL}, '', 'g')"


@query("text_preview", f"""
SELECT doc_id, {_preview_sql('text')} AS preview,
       {_strip_sql(_preview_sql('text'))} || CASE WHEN length(text) > 300 THEN '...' ELSE '' END AS display,
       CAST(length(text) AS BIGINT) AS text_chars
FROM documents
""")
def text_preview(spark, base):
    d = table(spark, base, "documents").select("doc_id", "text")
    return d.select("doc_id", TX.preview("text").alias("preview"), TX.preview_display("text").alias("display"),
                    F.length("text").cast("long").alias("text_chars"))


@query("blocked_gate", f"""
SELECT doc_id, {_contains_any_sql(_preview_sql('text'), GATE_PHRASES)} AS blocked,
       (text IS NOT NULL AND length(text) > 0) AS has_text
FROM documents
""")
def blocked_gate(spark, base):
    d = table(spark, base, "documents").select("doc_id", "text")
    return d.select("doc_id", TX.blocked("text", GATE_PHRASES).alias("blocked"),
                    TX.has_text("text").alias("has_text"))


@query("soft_error_gate", f"""
SELECT doc_id, {_contains_any_sql('text', SOFT_PHRASES)} AS soft_error FROM documents
""")
def soft_error_gate(spark, base):
    d = table(spark, base, "documents").select("doc_id", "text")
    return d.select("doc_id", TX.soft_error(F.col("text"), SOFT_PHRASES).alias("soft_error"))


@query("trim_and_defaults", f"""
SELECT conv_id, turn, {_strip_sql('text')} AS text_stripped,
       coalesce(CASE WHEN role IN ('') THEN NULL ELSE role END, 'unknown') AS role_or_default,
       coalesce(TRY_CAST(CAST(turn AS VARCHAR) AS BIGINT), 0) AS turn_number,
       coalesce(TRY_CAST(role AS BIGINT), 0) AS role_number,
       (role IS NOT NULL AND {_strip_sql('role')} <> '' AND TRY_CAST({_strip_sql('role')} AS BIGINT) IS NULL)
         AS role_malformed
FROM conversations
""")
def trim_and_defaults(spark, base):
    c = table(spark, base, "conversations").select("conv_id", "turn", "role", "text")
    return c.select("conv_id", "turn", TX.strip_ws("text").alias("text_stripped"),
                    F.coalesce(TX.na_to_null("role"), F.lit("unknown")).alias("role_or_default"),
                    TX.int_or(F.col("turn").cast("string"), 0).alias("turn_number"),
                    TX.int_or("role", 0).alias("role_number"),
                    TX.malformed("role", "bigint").alias("role_malformed"))


def _reply_spark(event_type, props):
    return F.when(F.col(event_type) == "error",
                  F.concat(F.lit('{"programming_languages": ["'), F.col(event_type), F.lit('"')))\
            .otherwise(F.concat(F.lit('Answer: {"programming_languages": ["'), F.col(event_type),
                                F.lit('", "'), F.upper(F.substring(event_type, 1, 1)), F.lit('", "'),
                                F.col(event_type), F.lit('"], "meta": '), F.col(props), F.lit("} end")))


REPLY_SQL = """CASE WHEN event_type = 'error' THEN '{"programming_languages": ["' || event_type || '"'
  ELSE 'Answer: {"programming_languages": ["' || event_type || '", "' || upper(substr(event_type, 1, 1))
       || '", "' || event_type || '"], "meta": ' || props || '} end' END"""


def _parse_sql(raw):
    sl = f"regexp_extract({raw}, '(?s)\\{{.*\\}}', 0)"
    return (f"CASE WHEN {sl} <> '' AND json_valid({sl}) THEN coalesce(list_sort(list_distinct("
            f"from_json({sl}, '{{\"programming_languages\": [\"VARCHAR\"]}}').programming_languages)), "
            f"CAST([] AS VARCHAR[])) ELSE CAST([] AS VARCHAR[]) END")


@query("parse_model_json", f"""
SELECT event_id, {_parse_sql(REPLY_SQL)} AS languages FROM events
""")
def parse_model_json(spark, base):
    e = table(spark, base, "events").select("event_id", "event_type", "props")
    return e.select("event_id", TX.parse_languages(_reply_spark("event_type", "props")).alias("languages"))


@query("inverted_index_rebuild", f"""
SELECT doc_id, array_to_string(list_filter(regexp_split_to_array(text, '{WS}+'), lambda x: x <> ''), ' ') AS text
FROM documents
WHERE len(list_filter(regexp_split_to_array(text, '{WS}+'), lambda x: x <> '')) > 0
""")
def inverted_index_rebuild(spark, base):
    d = table(spark, base, "documents").select("doc_id", "text")
    return inverted_index(d, "doc_id", "text").select("doc_id", TX.reconstruct_abstract("index").alias("text"))


@query("page_text_concat", f"""
SELECT conv_id, nullif({_strip_sql("string_agg(text, chr(10) || chr(10) ORDER BY turn)")}, '') AS text
FROM conversations GROUP BY conv_id
""")
def page_text_concat(spark, base):
    c = table(spark, base, "conversations").select("conv_id", "turn", "text")
    return join_pages(c, "conv_id", "turn", "text")


def _tok_sql(expr):
    return (f"list_transform(regexp_split_to_array({expr}, '{WS}+'), "
            f"lambda t: regexp_replace(t, '^[.,;:()\"]+|[.,;:()\"]+$', '', 'g'))")


def _cut_sql(expr, headings):
    alts = "|".join(headings)
    return (f"regexp_replace({expr}, '(?is)(^|\\n){WS}*(?:[0-9]+\\.?{WS}*)?(?:{alts})"
            f"(?:[^A-Za-z0-9_].*)?$', '')")


VOCAB_SQL = f"""
WITH v AS (SELECT unnest([{_sql_list(VOCABULARY)}]) AS name),
vt AS (SELECT DISTINCT name, array_to_string({_tok_sql('name')}, ' ') AS form, len({_tok_sql('name')}) AS n
       FROM v),
vt2 AS (SELECT * FROM vt WHERE form <> ''),
d AS (SELECT doc_id, {_tok_sql(_cut_sql('text', TX.REFERENCE_HEADINGS))} AS toks FROM documents),
p AS (SELECT doc_id, toks, unnest(range(1, len(toks) + 1)) AS s FROM d),
g AS (SELECT doc_id, s, k.n, array_to_string(toks[s:s + k.n - 1], ' ') AS form
      FROM p CROSS JOIN (SELECT DISTINCT n FROM vt2) k WHERE s + k.n - 1 <= len(toks)),
m AS (SELECT doc_id, s, s + g.n AS e, name FROM g JOIN vt2 ON g.form = vt2.form AND g.n = vt2.n),
x AS (SELECT *, max(e) OVER (PARTITION BY doc_id ORDER BY s RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
                AS prev_e,
             max(e) OVER (PARTITION BY doc_id, s) AS same_e FROM m)
SELECT DISTINCT doc_id, name FROM x WHERE NOT (coalesce(prev_e, -1) >= e OR same_e > e)
"""


@query("vocabulary_mentions", VOCAB_SQL)
def vocabulary_mentions(spark, base):
    d = table(spark, base, "documents").select("doc_id", "text")
    vocab = spark.createDataFrame([(w,) for w in VOCABULARY], "name string")
    return DT.vocabulary_mentions(d, vocab)


@query("detection_links", f"""
WITH mm AS ({VOCAB_SQL}),
dim AS (SELECT CAST(row_number() OVER (ORDER BY fw, name) AS BIGINT) AS id, name
        FROM (SELECT name, min(doc_id) AS fw FROM mm GROUP BY name))
SELECT CAST(row_number() OVER (ORDER BY mm.doc_id, mm.name) AS BIGINT) AS id, mm.doc_id AS work_id,
       dim.id AS technology_id
FROM mm JOIN dim ON mm.name = dim.name
""")
def detection_links(spark, base):
    """Detect -> register -> link, the detection loop end to end: names found
    in each text (DET2) get ids in first-seen order (REG1) and every
    (work, name) becomes a link row with continuing ids (REG3)."""
    from techmine.operators import dimensions as D
    d = table(spark, base, "documents").select("doc_id", "text")
    vocab = spark.createDataFrame([(w,) for w in VOCABULARY], "name string")
    found = DT.vocabulary_mentions(d, vocab).checkpoint(eager=True)
    empty_dim = spark.createDataFrame([], "id long, name string")
    dim = D.with_registered(empty_dim, found, "name", ["doc_id"])
    no_links = spark.createDataFrame([], "id long, work_id long, technology_id long")
    return D.bridge_rows(found.withColumnRenamed("doc_id", "work_id"), dim, no_links)


@query("references_cut", f"""
SELECT doc_id, {_cut_sql('text', HEADINGS)} AS text FROM documents
""")
def references_cut(spark, base):
    d = table(spark, base, "documents").select("doc_id", "text")
    return d.select("doc_id", TX.cut_references("text", HEADINGS).alias("text"))


def _doc_replies(docs):
    return docs.select(F.col("doc_id").alias("work_id"),
                       F.concat(F.lit('Result: {"programming_languages": ["'), F.col("lang"), F.lit('", "'),
                                F.col("source"), F.lit('", "'), F.col("lang"), F.lit('"]} done')).alias("raw"))


DETECT_REPLIES_SQL = f"""
SELECT doc_id AS work_id,
  CASE WHEN {_contains_any_sql(_preview_sql('text'), GATE_PHRASES)} THEN CAST([] AS VARCHAR[])
       ELSE {_parse_sql("'Result: {\"programming_languages\": [\"' || lang || '\", \"' || source || '\", \"' || lang || '\"]} done'")}
  END AS languages
FROM documents WHERE text IS NOT NULL AND length(text) > 0
"""


@query("detect_from_replies", DETECT_REPLIES_SQL)
def detect_from_replies(spark, base):
    d = table(spark, base, "documents").select("doc_id", "text", "lang", "source")
    return DT.detect_from_replies(d.select(F.col("doc_id").alias("work_id"), "text"), _doc_replies(d),
                                  strict=False, phrases=GATE_PHRASES)


@query("model_requests", f"""
SELECT doc_id AS work_id, '{DT.DEFAULT_INSTRUCTIONS.replace("'", "''")}' || chr(10) || chr(10) || 'Text:' || chr(10) || text AS prompt
FROM documents
WHERE text IS NOT NULL AND length(text) > 0 AND NOT {_contains_any_sql(_preview_sql('text'), GATE_PHRASES)}
""")
def model_requests(spark, base):
    d = table(spark, base, "documents").select(F.col("doc_id").alias("work_id"), "text")
    return DT.model_requests(d, phrases=GATE_PHRASES)


@query("detect_from_replies_strict", DETECT_REPLIES_SQL)
def detect_from_replies_strict(spark, base):
    """DET1 with the strict JSON parser (Arrow batches) instead of the native one."""
    d = table(spark, base, "documents").select("doc_id", "text", "lang", "source")
    return DT.detect_from_replies(d.select(F.col("doc_id").alias("work_id"), "text"), _doc_replies(d),
                                  strict=True, phrases=GATE_PHRASES)


def _word_detector(words):
    wanted = frozenset(words)

    def detect(text):
        return [w for w in set(text.split()) if w in wanted]
    return detect


@query("detect_with_callable", f"""
SELECT doc_id AS work_id,
  CASE WHEN {_contains_any_sql(_preview_sql('text'), GATE_PHRASES)} THEN CAST([] AS VARCHAR[])
       ELSE list_sort(list_distinct(list_filter(regexp_split_to_array(text, '{WS}+'),
                                                lambda x: x IN ({_sql_list(DETECT_WORDS)}))))
  END AS languages
FROM documents WHERE text IS NOT NULL AND length(text) > 0
""")
def detect_with_callable(spark, base):
    d = table(spark, base, "documents").select(F.col("doc_id").alias("work_id"), "text")
    return DT.detect_with_callable(d, _word_detector(DETECT_WORDS), phrases=GATE_PHRASES)


# ------------------------------------------------------------ HTML (rows only)

@query("html_visible_text")
def html_visible_text(spark, base):
    p = table(spark, base, "pages").select("page_id", "url", "html")
    return extract_html(p, "html", ["page_id"]).select("page_id", "visible_text")


@query("viewer_text")
def viewer_text(spark, base):
    p = table(spark, base, "pages").select("page_id", "html")
    return extract_html(p, "html", ["page_id"]).select("page_id", "viewer_text")


@query("html_links")
def html_links(spark, base):
    from techmine.functions.html import first_pdf_link
    from techmine.functions.strict import resolve_url
    p = table(spark, base, "pages").select("page_id", "url", "html")
    x = extract_html(p, "html", ["page_id", "url"])
    links = x.select("page_id", "url", F.posexplode("links").alias("ord", "href"))
    first_pdf = x.select("page_id", first_pdf_link("links", "url").alias("first_pdf"))
    return (links.select("page_id", "ord", "href", resolve_url(F.col("url"), F.col("href")).alias("resolved"))
                 .join(first_pdf, "page_id", "left"))


@query("resolve_chain")
def resolve_chain(spark, base):
    """Pages are the works' landing URLs; documents stand for the PDFs the
    open-access lookup points to (doi of page k -> PDF of document k)."""
    pages = table(spark, base, "pages").select("page_id", "url", "html")
    docs = table(spark, base, "documents").select("doc_id", "text")
    pdf_url = F.concat(F.lit("https://example.org/pdf/"), F.col("doc_id").cast("string"), F.lit(".pdf"))
    responses = (pages.select("url", F.lit(200).alias("status"), F.lit("text/html; charset=utf-8").alias("content_type"),
                              F.col("html").alias("body_text"), F.lit(None).cast("array<string>").alias("page_texts"))
                 .unionByName(docs.select(pdf_url.alias("url"), F.lit(200).alias("status"),
                                          F.lit("application/pdf").alias("content_type"),
                                          F.lit(None).cast("string").alias("body_text"),
                                          F.split("text", "\n\n").alias("page_texts"))))
    works = pages.select(F.col("page_id").alias("work_id"), "url",
                         F.concat(F.lit("10.5555/"), F.col("page_id").cast("string")).alias("doi"))
    oa = docs.select(F.concat(F.lit("10.5555/"), F.col("doc_id").cast("string")).alias("doi"),
                     pdf_url.alias("url_for_pdf"))
    probe = spark.createDataFrame([], "url string, status int, content_type string")
    return resolve_text(works, responses, oa, probe)


# Responses whose markup is stated here, so that SQL can state every outcome:
# the rule of a work is its document number modulo 8.
RESOLVE_RULES_SQL = f"""
WITH d AS (SELECT doc_id AS k, doc_id % 8 AS rule, 'http://site.example/' || doc_id AS u,
                  nullif({_strip_sql('text')}, '') AS body FROM documents)
SELECT k AS work_id,
  CASE WHEN k % 40 = 39 THEN NULL WHEN rule = 0 THEN body WHEN rule = 1 THEN 'open ' || k WHEN rule = 3 THEN 'viewer ' || k
       WHEN rule = 4 THEN 'linked ' || k WHEN rule = 6 THEN 'probed ' || k END AS text,
  CASE WHEN k % 40 = 39 THEN NULL WHEN rule = 0 AND body IS NOT NULL THEN u WHEN rule = 1 THEN 'http://oa.example/' || k || '.pdf'
       WHEN rule = 3 THEN u WHEN rule = 4 THEN 'http://site.example/files/' || k || '.pdf'
       WHEN rule = 6 THEN 'https://dl.acm.org/doi/pdf/10.5555/' || k END AS final_url,
  CASE WHEN k % 40 = 39 THEN 0 WHEN rule IN (1, 4, 6) THEN 2 ELSE 1 END AS hops
FROM d
"""


@query("resolve_rules", RESOLVE_RULES_SQL)
def resolve_rules(spark, base):
    """RES1 with every rule reached: 0 PDF, 1 blank PDF and open-access copy,
    2 soft 404 without doi, 3 viewer text, 4 relative .pdf link, 5 link to
    itself, 6 soft 404 and probe 200, 7 soft 404 and probe 404; every fortieth
    work has no URL."""
    d = table(spark, base, "documents").select(F.col("doc_id").alias("k"), "text")
    k, rule = F.col("k").cast("string"), F.col("k") % 8
    site = F.concat(F.lit("http://site.example/"), k)
    url = F.when(rule == 5, F.concat(site, F.lit(".pdf"))).otherwise(site)
    doi = F.when(rule == 2, "").when(rule != 5, F.concat(F.lit("10.5555/"), k))
    works = d.select(F.col("k").alias("work_id"), F.when(F.col("k") % 40 != 39, url).alias("url"), doi.alias("doi"))
    none, no_pages = F.lit(None).cast("string"), F.lit(None).cast("array<string>")

    def response(rows, address, kind, body=none, pages=no_pages):
        return rows.select(address.alias("url"), F.lit(200).alias("status"), F.lit(kind).alias("content_type"),
                           body.alias("body_text"), pages.alias("page_texts"))

    def pdf_of(r, prefix, word, suffix=".pdf"):
        return response(d.where(rule == r), F.concat(F.lit(prefix), k, F.lit(suffix)), "application/pdf",
                        pages=F.array(F.concat(F.lit(word + " "), k)))

    soft = F.lit("<html><body><h1>Error 404</h1><p>gone</p></body></html>")
    body = (F.when(rule == 3, F.concat(F.lit('<div class="textLayer">viewer '), k, F.lit("</div><p>rest</p>")))
             .when(rule == 4, F.concat(F.lit('<a href="x.html">a</a><a href="files/'), k, F.lit('.pdf">b</a>')))
             .when(rule == 5, F.concat(F.lit('<a href="/'), k, F.lit('.pdf">c</a>'))).otherwise(soft))
    parts = [response(d.where(rule == 0), url, "application/pdf", pages=F.array("text")),
             response(d.where(rule == 1), url, "application/pdf", pages=F.array(F.lit(" "))),
             response(d.where(rule >= 2), url, "text/html; charset=utf-8", body=body),
             pdf_of(1, "http://oa.example/", "open"), pdf_of(4, "http://site.example/files/", "linked"),
             pdf_of(6, "https://dl.acm.org/doi/pdf/10.5555/", "probed", "")]
    responses = parts[0]
    for p in parts[1:]:
        responses = responses.unionByName(p)
    oa = d.where(rule == 1).select(doi.alias("doi"), F.concat(F.lit("http://oa.example/"), k, F.lit(".pdf")).alias("url_for_pdf"))
    probe = d.where(rule >= 6).select(F.concat(F.lit("https://dl.acm.org/doi/pdf/10.5555/"), k).alias("url"),
                                      F.when(rule == 6, 200).otherwise(404).alias("status"),
                                      F.lit("application/pdf").alias("content_type"))
    return resolve_text(works, responses, oa, probe)


@query("html_rules", """
SELECT doc_id, source || ' ' || lang || ' a<5 in L M base' AS visible_text, 'in ' AS viewer_text,
       ['/f/' || doc_id || '.pdf', 'x.html'] AS links, 'http://h.example/f/' || doc_id || '.pdf' AS first_pdf
FROM documents
""")
def html_rules(spark, base):
    """SC17-SC19 on pages whose markup is stated here: stray "<", comment,
    script, void and nested viewer elements, ruby, links."""
    from techmine.functions.html import first_pdf_link
    d = table(spark, base, "documents").select("doc_id", "source", "lang")
    k = F.col("doc_id").cast("string")
    html = F.concat(F.lit("<html><head><title>"), F.col("source"), F.lit("</title><script>var a = '<p>';</script></head><body><p>"),
                    F.col("lang"), F.lit(' a<5 </p><!-- none --><div id="textLayer"><div>in</div></div><img class="textLayer">'
                                         '<a href="/f/'), k,
                    F.lit('.pdf">L</a><a href="x.html">M</a><ruby>base<rp>(</rp><rt>up</rt><rp>)</rp></ruby></body></html>'))
    pages = d.select("doc_id", F.lit("http://h.example/dir/page").alias("url"), html.alias("html"))
    x = extract_html(pages, "html", ["doc_id", "url"])
    return x.select("doc_id", "visible_text", "viewer_text", "links", first_pdf_link("links", "url").alias("first_pdf"))
