"""SRC1: landed scholarly-API response pages -> work rows.

Pages are JSON objects ``{"results": [...], "meta": {"count": n}}`` read with
a declared schema; a page without ``results`` contributes nothing.  The
selection the API applied server-side (FIL1, FIL2) is applied here as
ordinary predicates, then the per-record projection of the extractor:
PDF URL and primary topic required (FIL3, FIL4), defaults for missing fields
(SC2), nested access (SC3), abstract rebuilt from the inverted index (SC1),
dense ids in citation order (WIN1, SRT1) and topic ids in first-seen order
(AG7, JN1).
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from techmine.functions.text import let, reconstruct_abstract
from techmine.operators.dimensions import register_names
from techmine.operators.ids import dense_ids, dense_ids_by_key
from techmine.schemas import RESPONSE_PAGE
from techmine.session import written

# The extractor's selection (keyword ids, subfield, language)
# and its defaults.
KEYWORDS = ["python", "c-programming-language", "javascript", "java", "java-programming-language",
            "sql", "dart", "swift", "cobol", "fortran", "matlab", "prolog", "lisp", "haskell", "rust",
            "perl", "scala", "html", "html5"]
SUBFIELD_ID = "subfields/1702"
LANGUAGE = "languages/en"
UNKNOWN_TOPIC = "Unknown Topic"
PAGE_SIZE = 200
# Pages repeat their names in every record; the fast level is over three times as fast as the usual one.
LANDED = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED"}
# Times keep their microseconds as text.
EXACT = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}
PART, SEQ = "__part", "__seq"
BAD_PAGE = "__bad_page"


def read_pages(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """One row per work record of every landed page: one page per line, or, with
    ``multi_line``, one (pretty-printed) page per file.  Text that is no page
    fails the read instead of adding no rows."""
    pages = (spark.read.schema(RESPONSE_PAGE).option("mode", "FAILFAST")
                  .option("multiLine", str(multi_line).lower()).json(path))
    return pages.select(F.explode("results").alias("w")).select("w.*")


def read_pages_kept(spark: SparkSession, path: str, multi_line: bool = False) -> tuple[DataFrame, DataFrame]:
    """(records, bad): the work records of all pages that can be read, and of every
    other page its file and its text.  One broken page costs no other page; a page
    without ``results`` is no fault.  Both are lazy reads of the same files, and
    ``bad`` is usually written to a side table, from which pages are landed anew
    once mended."""
    schema = T.StructType([*RESPONSE_PAGE.fields, T.StructField(BAD_PAGE, T.StringType())])
    # Parsed as text: the reader would not look at fields that a query leaves out.
    text = spark.read.text(path, wholetext=multi_line).select(
        "value", F.col("_metadata.file_path").alias("file")).where(F.btrim("value", F.lit(" \t\r\n")) != "")
    page = F.from_json("value", schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": BAD_PAGE})
    # Exploded, so that every use of the page shares one parse.
    pages = text.select("value", "file", F.explode(F.array(page)).alias("page"))
    fault = F.col("page").isNull() | F.col(f"page.{BAD_PAGE}").isNotNull()
    records = pages.where(~fault).select(F.explode("page.results").alias("w")).select("w.*")
    return records, pages.where(fault).select("file", F.col("value").alias("page"))


def last_part(c: Column) -> Column:
    """Ids arrive as URLs; compare on the last path part."""
    return F.regexp_extract(c, r"([^/]*)$", 1)


def selection(subfield: str = SUBFIELD_ID, language: str = LANGUAGE,
              keywords=KEYWORDS) -> Column:
    """FIL1 (comma = AND) and FIL2 (| = OR) as one predicate on a record."""
    kw = [k for k in keywords]
    return (F.coalesce(F.col("open_access.is_oa"), F.lit(False))
            & F.coalesce(F.col("has_content.pdf"), F.lit(False))
            & (last_part(F.col("primary_topic.subfield.id")) == subfield.rsplit("/", 1)[-1])
            & F.coalesce(F.col("best_oa_location.is_accepted"), F.lit(False))
            & (last_part(F.col("language")) == language.rsplit("/", 1)[-1])
            & F.exists(F.coalesce(F.col("keywords"), F.array()), lambda k: last_part(k["id"]).isin(kw)))


def project(records: DataFrame) -> DataFrame:
    """FIL3 + FIL4 + SC2-SC4 + SC1: candidate rows before ids are handed out."""
    pdf_url = F.col("best_oa_location.pdf_url")
    return (records.where(pdf_url.isNotNull() & (pdf_url != "") & F.col("primary_topic").isNotNull())
                   .select(F.col("id").alias("source_id"),
                           pdf_url.alias("source_url"),
                           F.coalesce("title", F.lit("")).alias("title"),
                           reconstruct_abstract("abstract_inverted_index").alias("abstract"),
                           F.coalesce("publication_date", F.lit("")).alias("published"),
                           F.coalesce("language", F.lit(LANGUAGE)).alias("language"),
                           F.coalesce("cited_by_count", F.lit(0)).cast("long").alias("citations"),
                           F.coalesce("fwci", F.lit(0.0)).alias("fwci"),
                           F.coalesce("primary_topic.display_name", F.lit(UNKNOWN_TOPIC)).alias("topic_name"),
                           # A missing doi is null: blanks would count as repeated values.
                           F.when(F.col("doi") != "", F.col("doi")).alias("doi")))


def works_and_topics(records: DataFrame, existing_topics: DataFrame | None = None):
    """Work rows (id, source_url, title, abstract, published, language,
    citations, fwci, topic_id, doi) and the topic dimension (id, name).

    Ids follow citations descending, record id ascending; topic ids follow the
    first work (in that order) naming the topic, after any stored topics.
    """
    # The rows are stored once, with a row number as key; only (key, citations,
    # source id, topic) are sorted and joined for the ids, abstracts move in the last join alone.
    rows = written(project(records).withColumn("__row", F.monotonically_increasing_id()), "candidate-works",
                   compression="zstd")
    ranked = dense_ids_by_key(rows.select("__row", "citations", "source_id", "topic_name"),
                              [("citations", False), ("source_id", True), ("__row", True)], "__row")
    spark = records.sparkSession
    stored = existing_topics if existing_topics is not None else spark.createDataFrame([], "id long, name string")
    new_topics = register_names(stored, ranked.select(F.col("topic_name").alias("name"), "id"), "name", ["id"])
    topics = stored.select("id", "name").unionByName(new_topics)
    ids = (ranked.join(topics.select(F.col("id").alias("topic_id"), F.col("name").alias("topic_name")), "topic_name")
                 .select("__row", "id", "topic_id"))
    works = (rows.join(ids, "__row")
                 .select("id", "source_url", "title", "abstract", "published", "language", "citations",
                         "fwci", "topic_id", "doi"))
    return works, topics


def write_pages(records: DataFrame, path: str, order_col: str, page_size: int = PAGE_SIZE) -> None:
    """Land records as response pages (``page_size`` records per page, in
    ``order_col`` order), the shape the API returns."""
    # Records become JSON and are stored once; they move once, to their pages.
    rows = written(records.select(F.col(order_col).alias("__order"), F.to_json(F.struct(*records.columns)).alias("__json"))
                          .withColumn("__row", F.monotonically_increasing_id()), "records", compression="zstd")
    dealt, total = _dealt_to_pages(rows, ["__order", "__row"], page_size)
    _land(dealt, total, path, page_size)


def write_pages_of(rows: DataFrame, records_of: Callable[[DataFrame], DataFrame], path: str, order: list[str],
                   page_size: int = PAGE_SIZE) -> None:
    """``write_pages`` for records that are larger than what they are made from:
    ``rows`` move to their pages, then ``records_of`` turns them into records, row by
    row; it keeps the columns ``__part`` and ``__seq``.  ``order`` tells all rows apart
    and is the same whenever ``rows`` are read (they are read more than once)."""
    dealt, total = _dealt_to_pages(rows, order, page_size)
    records = records_of(dealt.drop(*[c for c in order if c.startswith("__")]))
    fields = [c for c in records.columns if c not in (PART, SEQ)]
    _land(records.select(PART, SEQ, F.to_json(F.struct(*fields)).alias("__json")), total, path, page_size)


def _dealt_to_pages(rows: DataFrame, order: list[str], page_size: int) -> tuple[DataFrame, int]:
    """(rows, how many): ``rows`` moved once, to parts of whole pages.  ``__part`` is the
    part, ``__seq`` the place in it in ``order``, from 0; every part but the last has
    the same number of rows, a multiple of ``page_size``.

    Only the ``order`` columns are sorted over all rows, which gives the first row of
    every part; there are as many parts as shuffle partitions at most.  A row finds its
    part among these firsts, in two steps as they come in groups."""
    spark = rows.sparkSession
    keys = dense_ids(rows.select(*order), order, id_col=SEQ, start=0)
    total = keys.count()
    slots = int(spark.conf.get("spark.sql.shuffle.partitions"))
    size = max(1, math.ceil(total / (page_size * slots))) * page_size
    parts = max(1, math.ceil(total / size))
    group = math.isqrt(parts) + 1
    number, key = (F.col(SEQ) / size).cast("long"), F.struct(*order)
    firsts = (keys.where((F.col(SEQ) > 0) & (F.col(SEQ) % size == 0))
                  .groupBy(F.floor((number - 1) / group).alias("g")).agg(F.sort_array(F.collect_list(key)).alias("ks"))
                  .agg(F.sort_array(F.collect_list("ks")).alias("gs")))
    text = firsts.select(F.to_json(F.struct("gs"), EXACT)).first()[0]
    gs = F.from_json(F.lit(text), firsts.schema, EXACT)["gs"]  # a constant, parsed once
    part = let(F.size(F.filter(gs, lambda ks: F.get(ks, F.lit(0)) <= key)),
               lambda n: F.when(n > 0, (n - 1) * group + F.size(F.filter(F.get(gs, n - 1), lambda k: k <= key)))
                          .otherwise(0))
    place = F.row_number().over(Window.partitionBy(PART).orderBy(*order)) - 1
    return rows.withColumn(PART, part).repartitionById(parts, PART).withColumn(SEQ, place), total


def _land(rows: DataFrame, total: int, path: str, page_size: int) -> None:
    """Write (part, place in it, record as JSON) as pages; a part is a whole task's."""
    pages = (rows.groupBy(PART, F.floor(F.col(SEQ) / page_size).alias("page"))
                 .agg(F.sort_array(F.collect_list(F.struct(SEQ, "__json"))).alias("rs")))
    results = F.array_join(F.transform("rs", lambda x: x["__json"]), ",")
    page = F.concat(F.lit('{"results":['), results, F.lit(f'],"meta":{{"count":{total}}}}}'))
    pages.select(page.alias("value")).write.mode("overwrite").options(**LANDED).text(path)
