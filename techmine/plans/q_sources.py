"""Source and sink queries: landed JSON response pages -> works (SRC1,
SC1-SC4, SC7, FIL1-FIL4, WIN1, AG7, JN1), CSV table round trip (SRC2, SRC3,
SNK1, SNK2, AG4, SC21) and the incremental registration stream (INC2)."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from techmine.functions.text import WS_CLASS, has_word
from techmine.operators.inverted_index import inverted_index
from techmine.plans.registry import query
from techmine.session import shared_dir, written
from techmine.sources import works_json as WJ
from techmine.sources.csv_tables import read_csv, write_csv
from techmine.sources.tables import table
from techmine.streaming import commit_log as CL
from techmine.streaming.incremental import run_registration_stream


# Where a document, and the document whose text it has, lie in the table's files:
# with the record id, a total order that is the same whenever the table is read.
DOCUMENT_ORDER = ["id", "__file", "__at", "__text_file", "__text_at"]


def _documents_with_texts(spark, base):
    """``documents`` with the record id and the columns of ``DOCUMENT_ORDER``, as a left
    join with the texts by ``doc_id``: documents that share an id have each other's
    texts, one without an id has none.  Only rows whose id repeats are joined."""
    d = table(spark, base, "documents").select(
        "doc_id", "lang", "source", "n_chars", "text", F.xxhash64("_metadata.file_path").alias("__file"),
        F.col("_metadata.row_index").alias("__at"))
    again = written(d.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"))
                     .where("n > 1").select("doc_id"), "repeated-documents")
    once = d.join(again, "doc_id", "left_anti").withColumn("text", F.when(F.col("doc_id").isNotNull(), F.col("text")))
    if not again.isEmpty():
        shared = d.join(again, "doc_id", "left_semi")
        texts = shared.where(has_word("text")).select("doc_id", "text", F.col("__file").alias("__text_file"),
                                                      F.col("__at").alias("__text_at"))
        once = once.unionByName(shared.drop("text").join(texts, "doc_id", "left"), allowMissingColumns=True)
    else:
        once = once.withColumns({c: F.lit(None).cast("bigint") for c in ("__text_file", "__text_at")})
    return once.withColumn("id", F.concat(F.lit("https://openalex.org/W"), F.col("doc_id").cast("string")))


def _records_from_documents(d):
    """Work records in the API's shape, derived from ``_documents_with_texts``:
    src0 has no PDF URL, src1 no primary topic, src2 is not open access,
    src3 carries a keyword outside the selection; publication date and fwci
    are absent so the defaults apply.  Columns that begin with ``__`` stay."""
    own = [c for c in d.columns if c.startswith("__")]
    idx = inverted_index(d, "doc_id", "text", keep=["id", "lang", "source", "n_chars", *own])
    sid = F.col("doc_id").cast("string")
    return (idx.select(
        *own,
        "id",
        F.concat(F.lit("https://doi.org/10.5555/"), sid).alias("doi"),
        F.col("source").alias("title"),
        F.lit(None).cast("string").alias("publication_date"),
        F.col("lang").alias("language"),
        F.col("n_chars").alias("cited_by_count"),
        F.lit(None).cast("double").alias("fwci"),
        F.col("index").alias("abstract_inverted_index"),
        F.struct(F.when(F.col("source") != "src0",
                        F.concat(F.lit("https://example.org/pdf/"), sid, F.lit(".pdf"))).alias("pdf_url"),
                 F.lit(True).alias("is_accepted")).alias("best_oa_location"),
        F.when(F.col("source") != "src1",
               F.struct(F.concat(F.lit("Topic "), F.col("source")).alias("display_name"),
                        F.struct(F.lit("https://openalex.org/subfields/1702").alias("id")).alias("subfield"))
               ).alias("primary_topic"),
        F.struct((F.col("source") != "src2").alias("is_oa")).alias("open_access"),
        F.struct(F.lit(True).alias("pdf")).alias("has_content"),
        F.array(F.struct(F.concat(F.lit("https://openalex.org/keywords/"),
                                  F.when(F.col("source") == "src3", F.lit("ruby")).otherwise(F.lit("python")))
                         .alias("id"))).alias("keywords")))


WORKS_JSON_SQL = f"""
WITH r AS (
  SELECT 'https://openalex.org/W' || CAST(doc_id AS VARCHAR) AS rid,
         'https://doi.org/10.5555/' || CAST(doc_id AS VARCHAR) AS doi,
         source AS title, lang AS language, n_chars AS citations,
         CASE WHEN source <> 'src0' THEN 'https://example.org/pdf/' || CAST(doc_id AS VARCHAR) || '.pdf' END AS pdf_url,
         CASE WHEN source <> 'src1' THEN 'Topic ' || source END AS topic_name,
         source <> 'src2' AS is_oa,
         CASE WHEN source = 'src3' THEN 'ruby' ELSE 'python' END AS kw,
         array_to_string(list_filter(regexp_split_to_array(text, '{WS_CLASS}+'), lambda x: x <> ''), ' ') AS abstract
  FROM documents),
f AS (SELECT * FROM r WHERE is_oa AND language = 'en' AND kw IN ({", ".join(f"'{k}'" for k in WJ.KEYWORDS)})
      AND pdf_url IS NOT NULL AND pdf_url <> '' AND topic_name IS NOT NULL),
w AS (SELECT *, CAST(row_number() OVER (ORDER BY citations DESC, rid) AS BIGINT) AS id FROM f),
t AS (SELECT topic_name, CAST(row_number() OVER (ORDER BY min(id), topic_name) AS BIGINT) AS topic_id
      FROM w GROUP BY topic_name)
SELECT id, pdf_url AS source_url, title, abstract, '' AS published, language, citations,
       CAST(0 AS DOUBLE) AS fwci, topic_id, doi
FROM w JOIN t USING (topic_name)
"""


@query("works_from_json", WORKS_JSON_SQL)
def works_from_json(spark, base):
    landing = shared_dir(spark, "response-pages")
    WJ.write_pages_of(_documents_with_texts(spark, base), _records_from_documents, landing, DOCUMENT_ORDER)
    records = WJ.read_pages(spark, landing).where(WJ.selection())
    works, _topics = WJ.works_and_topics(records)
    return works


@query("table_roundtrip", """
SELECT conv_id AS id, role AS name, text AS kind, CAST(turn AS VARCHAR) AS version FROM conversations
""")
def table_roundtrip(spark, base):
    """Conversations as a technology table, written and read by the CSV sink and
    source; texts with quotes, newlines and outer spaces come back whole."""
    src = table(spark, base, "conversations").select(
        F.col("conv_id").cast("string").alias("id"), F.col("role").alias("nombre"),
        F.col("text").alias("tipo"), F.col("turn").cast("string").alias("version"))
    path = shared_dir(spark, "csv-roundtrip")
    write_csv(src, path)
    raw = read_csv(spark, path, "technology")
    return raw.select(F.col("id").cast("long"), F.col("nombre").alias("name"), F.col("tipo").alias("kind"), "version")


STREAM_SCHEMA = T.StructType([
    T.StructField("work_id", T.LongType()),
    T.StructField("o_orderdate", T.TimestampType()),
    T.StructField("name", T.StringType()),
])


@query("incremental_stream", """
WITH s AS (SELECT l_orderkey AS w, o_orderdate AS d, p_brand || ' ' || p_name AS name
           FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey),
f AS (SELECT name, d, w FROM s QUALIFY row_number() OVER (PARTITION BY name ORDER BY d, w) = 1)
SELECT CAST(row_number() OVER (ORDER BY d, w, name) AS BIGINT) AS id, name FROM f
""")
def incremental_stream(spark, base):
    """One drop per order year lands, oldest first, and the stream runs after
    each; the result is the technology dimension it built.  The joined rows are
    written once, partitioned by year; a drop reads its own partition."""
    rows = _mentioned_names(spark, base).withColumn("drop", F.year("o_orderdate"))
    dim_path, _links = _run_drops(spark, rows)
    return spark.read.parquet(dim_path)


def _mentioned_names(spark, base):
    li = table(spark, base, "lineitem").select(F.col("l_orderkey").alias("work_id"), "l_partkey", "l_linenumber")
    o = table(spark, base, "orders").select(F.col("o_orderkey").alias("work_id"), "o_orderdate")
    p = table(spark, base, "part").select(F.col("p_partkey").alias("l_partkey"),
                                          F.concat_ws(" ", "p_brand", "p_name").alias("name"))
    return li.join(o, "work_id").join(p, "l_partkey").select("work_id", "o_orderdate", "name", "l_linenumber")


def _run_drops(spark, rows):
    """Land the rows of every ``drop`` value in order, running the stream after each."""
    staging, landing = f"{shared_dir(spark, 'staging')}/t", shared_dir(spark, "landing")
    rows.select("work_id", "o_orderdate", "name", "drop").write.partitionBy("drop").parquet(staging)
    staged = spark.read.parquet(staging)
    drops = [r[0] for r in staged.select("drop").distinct().orderBy("drop").collect()]  # a few
    dim_path, links_path = shared_dir(spark, "dimension"), shared_dir(spark, "links")
    done_path, checkpoint = shared_dir(spark, "done"), shared_dir(spark, "stream-checkpoint")
    for d in drops:
        staged.where(F.col("drop") == d).drop("drop").write.mode("append").parquet(landing)
        run_registration_stream(spark, landing, STREAM_SCHEMA, dim_path, links_path, checkpoint,
                                ["o_orderdate", "work_id"], files_per_batch=None, done_path=done_path)
    return dim_path, links_path


@query("incremental_links", """
WITH s AS (SELECT DISTINCT l_orderkey AS w, o_orderdate AS d, p_brand || ' ' || p_name AS name, l_linenumber % 2 AS k
           FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey),
f AS (SELECT name, d, w, k FROM s QUALIFY row_number() OVER (PARTITION BY name ORDER BY k, d, w) = 1),
dim AS (SELECT CAST(row_number() OVER (ORDER BY k, d, w, name) AS BIGINT) AS technology_id, name FROM f),
p AS (SELECT w, name, min(k) AS k FROM s GROUP BY w, name)
SELECT CAST(row_number() OVER (ORDER BY k, w, name) AS BIGINT) AS id, w AS work_id, technology_id
FROM p JOIN dim USING (name)
""")
def incremental_links(spark, base):
    """The links the stream wrote when the names of a work come in two drops
    (lines with even numbers first)."""
    rows = _mentioned_names(spark, base).withColumn("drop", F.col("l_linenumber") % 2)
    _dim, links_path = _run_drops(spark, rows)
    return spark.read.parquet(links_path)


@query("committed_ranges", """
WITH s AS (SELECT DISTINCT l_orderkey AS w, p_brand || ' ' || p_name AS name, l_linenumber % 2 AS k
           FROM lineitem JOIN part ON l_partkey = p_partkey),
n AS (SELECT k, count(*) AS n FROM (SELECT name, min(k) AS k FROM s GROUP BY name) GROUP BY k),
p AS (SELECT k, count(*) AS n FROM (SELECT w, name, min(k) AS k FROM s GROUP BY w, name) GROUP BY k),
d AS (SELECT DISTINCT k FROM s),
a AS (SELECT CAST(d.k AS BIGINT) AS seq, coalesce(n.n, 0) AS n_names, coalesce(p.n, 0) AS n_links
      FROM d LEFT JOIN n ON d.k = n.k LEFT JOIN p ON d.k = p.k)
SELECT seq, CAST(1 + sum(n_names) OVER (ORDER BY seq) - n_names AS BIGINT) AS first_name, n_names,
       CAST(1 + sum(n_links) OVER (ORDER BY seq) - n_links AS BIGINT) AS first_link, n_links FROM a
""")
def committed_ranges(spark, base):
    """INC2 by the commit log: id ranges of the commits when the names of a work come
    in two drops; each drop is registered twice, as after a replay."""
    rows = _mentioned_names(spark, base).withColumn("drop", F.col("l_linenumber") % 2)
    root = shared_dir(spark, "commit-log")
    for d in (0, 1):
        batch = rows.where(F.col("drop") == d).select("work_id", "o_orderdate", "name")
        for _ in range(2):
            CL.register_batch(spark, root, f"drop {d}", batch, ["o_orderdate", "work_id"])
    return CL.CommitLog(spark, root).table().select("seq", "first_name", "n_names", "first_link", "n_links")


@query("committed_links", """
WITH s AS (SELECT DISTINCT l_orderkey AS w, o_orderdate AS d, p_brand || ' ' || p_name AS name
           FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey),
f AS (SELECT name, d, w FROM s QUALIFY row_number() OVER (PARTITION BY name ORDER BY d, w) = 1),
dim AS (SELECT CAST(row_number() OVER (ORDER BY d, w, name) AS BIGINT) AS technology_id, name FROM f)
SELECT CAST(row_number() OVER (ORDER BY year(s.d), s.w, s.name) AS BIGINT) AS id, s.w AS work_id, technology_id
FROM (SELECT w, name, min(d) AS d FROM s GROUP BY w, name) s JOIN dim USING (name)
""")
def committed_links(spark, base):
    """INC2 by the commit log, fed by the stream: one drop per order year lands,
    oldest first; the result is the links of all commits."""
    rows = _mentioned_names(spark, base).withColumn("drop", F.year("o_orderdate"))
    staging, landing = f"{shared_dir(spark, 'staging')}/t", shared_dir(spark, "landing")
    rows.select("work_id", "o_orderdate", "name", "drop").write.partitionBy("drop").parquet(staging)
    staged = spark.read.parquet(staging)
    root, checkpoint = shared_dir(spark, "commit-log"), shared_dir(spark, "stream-checkpoint")
    for r in staged.select("drop").distinct().orderBy("drop").collect():  # a few years
        staged.where(F.col("drop") == r[0]).drop("drop").write.mode("append").parquet(landing)
        CL.run_stream(spark, landing, STREAM_SCHEMA, root, checkpoint, ["o_orderdate", "work_id"])
    return CL.CommitLog(spark, root).read("links")


@query("pages_kept_and_bad", """
SELECT doc_id, CASE WHEN doc_id % 10 = 3 THEN 'cut' WHEN doc_id % 10 = 7 THEN 'type' ELSE 'kept' END AS outcome FROM documents
""")
def pages_kept_and_bad(spark, base):
    """SRC1 with faults: every document as a page of one record; some pages are cut
    short, in some the results are no list.  All others load."""
    d = table(spark, base, "documents").select("doc_id", "text", "source")
    whole = F.to_json(F.struct(F.array(F.struct(F.concat(F.lit("W"), "doc_id").alias("id"), F.col("text").alias("title"))
                                       ).alias("results")))
    wrong = F.concat(F.lit('{"results": {"W": "W'), "doc_id", F.lit('"}, "meta": 5}'))
    line = F.when(F.col("doc_id") % 10 == 3, F.substring(whole, F.lit(1), F.char_length(whole) - 3)).when(
        F.col("doc_id") % 10 == 7, wrong).otherwise(whole)
    landing = f"{shared_dir(spark, 'pages-with-faults')}/t"
    d.select(line.alias("value")).write.text(landing)
    records, bad = WJ.read_pages_kept(spark, landing)
    number = lambda c: F.regexp_extract(c, "W([0-9]+)", 1).cast("long").alias("doc_id")
    why = F.when(F.col("page").endswith("}"), "type").otherwise("cut")
    return records.select(number("id"), F.lit("kept").alias("outcome")).unionByName(
        bad.select(number("page"), why.alias("outcome")))
