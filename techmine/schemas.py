"""Declared schemas of the data model (never inferred)."""

from pyspark.sql import types as T

# Relational tables, English names.  Ids are LongType throughout.
TOPIC = T.StructType([
    T.StructField("id", T.LongType(), False),
    T.StructField("name", T.StringType(), True),
])

TECHNOLOGY = T.StructType([
    T.StructField("id", T.LongType(), False),
    T.StructField("name", T.StringType(), True),
    T.StructField("kind", T.StringType(), True),
    T.StructField("version", T.StringType(), True),
])

WORK = T.StructType([
    T.StructField("id", T.LongType(), False),
    T.StructField("doi", T.StringType(), True),
    T.StructField("source_url", T.StringType(), True),
    T.StructField("title", T.StringType(), True),
    T.StructField("abstract", T.StringType(), True),
    T.StructField("published", T.StringType(), True),
    T.StructField("language", T.StringType(), True),
    T.StructField("citations", T.LongType(), True),
    T.StructField("fwci", T.DoubleType(), True),
    T.StructField("topic_id", T.LongType(), True),
])

MENTION = T.StructType([
    T.StructField("id", T.LongType(), False),
    T.StructField("work_id", T.LongType(), False),
    T.StructField("technology_id", T.LongType(), False),
])

TOPIC_EDGE = T.StructType([
    T.StructField("id", T.LongType(), False),
    T.StructField("parent_id", T.LongType(), False),
    T.StructField("child_id", T.LongType(), False),
])

# CSV forms as written by the original cache files (header names kept).
CSV_TOPIC = T.StructType([
    T.StructField("id", T.StringType(), True),
    T.StructField("nombre_campo", T.StringType(), True),
])
CSV_TOPIC_EDGE = T.StructType([
    T.StructField("id", T.StringType(), True),
    T.StructField("id_padre", T.StringType(), True),
    T.StructField("id_hijo", T.StringType(), True),
])
CSV_TECHNOLOGY = T.StructType([
    T.StructField("id", T.StringType(), True),
    T.StructField("nombre", T.StringType(), True),
    T.StructField("tipo", T.StringType(), True),
    T.StructField("version", T.StringType(), True),
])
CSV_WORK = T.StructType([
    T.StructField("id", T.StringType(), True),
    T.StructField("direccion_fuente", T.StringType(), True),
    T.StructField("titulo", T.StringType(), True),
    T.StructField("abstract", T.StringType(), True),
    T.StructField("fecha_publicacion", T.StringType(), True),
    T.StructField("idioma", T.StringType(), True),
    T.StructField("num_citas", T.StringType(), True),
    T.StructField("fwci", T.StringType(), True),
    T.StructField("tematica_id", T.StringType(), True),
    T.StructField("doi", T.StringType(), True),
])
CSV_MENTION = T.StructType([
    T.StructField("id", T.StringType(), True),
    T.StructField("obra_id", T.StringType(), True),
    T.StructField("tecnologia_id", T.StringType(), True),
])

# Landed scholarly-API response page: {"results": [...], "meta": {"count": n}}.
WORK_RECORD = T.StructType([
    T.StructField("id", T.StringType(), True),
    T.StructField("doi", T.StringType(), True),
    T.StructField("title", T.StringType(), True),
    T.StructField("publication_date", T.StringType(), True),
    T.StructField("language", T.StringType(), True),
    T.StructField("cited_by_count", T.LongType(), True),
    T.StructField("fwci", T.DoubleType(), True),
    T.StructField("abstract_inverted_index",
                  T.MapType(T.StringType(), T.ArrayType(T.LongType())), True),
    T.StructField("best_oa_location", T.StructType([
        T.StructField("pdf_url", T.StringType(), True),
        T.StructField("is_accepted", T.BooleanType(), True),
    ]), True),
    T.StructField("primary_topic", T.StructType([
        T.StructField("display_name", T.StringType(), True),
        T.StructField("subfield", T.StructType([
            T.StructField("id", T.StringType(), True),
        ]), True),
    ]), True),
    T.StructField("open_access", T.StructType([
        T.StructField("is_oa", T.BooleanType(), True),
    ]), True),
    T.StructField("has_content", T.StructType([
        T.StructField("pdf", T.BooleanType(), True),
    ]), True),
    T.StructField("keywords", T.ArrayType(T.StructType([
        T.StructField("id", T.StringType(), True),
    ])), True),
])

RESPONSE_PAGE = T.StructType([
    T.StructField("results", T.ArrayType(WORK_RECORD), True),
    T.StructField("meta", T.StructType([
        T.StructField("count", T.LongType(), True),
    ]), True),
])

# Content resolution inputs.
RESPONSES = T.StructType([
    T.StructField("url", T.StringType(), False),
    T.StructField("status", T.IntegerType(), True),
    T.StructField("content_type", T.StringType(), True),
    T.StructField("body_text", T.StringType(), True),
    T.StructField("page_texts", T.ArrayType(T.StringType()), True),
])
OA_LOCATION = T.StructType([
    T.StructField("doi", T.StringType(), False),
    T.StructField("url_for_pdf", T.StringType(), True),
])
HEAD_PROBE = T.StructType([
    T.StructField("url", T.StringType(), False),
    T.StructField("status", T.IntegerType(), True),
    T.StructField("content_type", T.StringType(), True),
])
MODEL_REPLY = T.StructType([
    T.StructField("work_id", T.LongType(), False),
    T.StructField("raw", T.StringType(), True),
])

# Graph: one row per triple.  o_kind is 'iri' or 'literal'; datatype only for
# typed literals.
TRIPLES = T.StructType([
    T.StructField("s", T.StringType(), False),
    T.StructField("p", T.StringType(), False),
    T.StructField("o", T.StringType(), False),
    T.StructField("o_kind", T.StringType(), False),
    T.StructField("datatype", T.StringType(), True),
])
