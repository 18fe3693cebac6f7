"""SRC2: the checkpoint CSV tables (header, RFC-4180 quoting, LF or CRLF,
optional last newline) read with declared schemas, and their conversion to
the model tables with the load rules of SC5-SC7 (trim, defaults, casts).

``multiLine`` is required for quoted newlines (abstracts) and stops Spark
from splitting a file, so large CSVs should be converted to Parquet once
(``to_parquet``) and read from there.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from techmine import schemas as SC
from techmine.functions.text import float_or, int_or, malformed, na_to_null, strip_ws

CSV_OPTIONS = {"header": "true", "multiLine": "true", "escape": '"', "quote": '"',
               "encoding": "UTF-8", "mode": "PERMISSIVE"}

CSV_SCHEMAS = {
    "topic": SC.CSV_TOPIC,
    "topic_edge": SC.CSV_TOPIC_EDGE,
    "technology": SC.CSV_TECHNOLOGY,
    "work": SC.CSV_WORK,
    "mention": SC.CSV_MENTION,
}


# Position of a row in the files read: (file name, place in it).  The loader
# keeps the first row of a repeated key by it.
POSITION = "__position"


def read_csv(spark: SparkSession, path: str, kind: str, position: bool = False) -> DataFrame:
    """Raw string columns of one CSV table.  Columns missing from the file's
    header (e.g. ``tipo`` in the technology file) come back null.  A file is read
    by one task (``multiLine``), so row numbers within a file ascend."""
    header = spark.read.options(**CSV_OPTIONS).csv(path).columns
    schema = CSV_SCHEMAS[kind]
    df = spark.read.options(**CSV_OPTIONS).schema(
        _subset(schema, header)).csv(path)
    for f in schema.fields:
        if f.name not in df.columns:
            df = df.withColumn(f.name, F.lit(None).cast("string"))
    # CRLF files leave a carriage return on the last field of each line.
    place = [F.struct(F.input_file_name().alias("file"), F.monotonically_increasing_id().alias("row")).alias(POSITION)]
    return df.select(*[F.regexp_replace(F.col(f.name), "\r$", "").alias(f.name) for f in schema.fields],
                     *place * position)


def _subset(schema, names):
    from pyspark.sql import types as T
    by = {f.name: f for f in schema.fields}
    return T.StructType([by[n] if n in by else T.StructField(n, T.StringType()) for n in names])


def _txt(c, na_values):
    return strip_ws(na_to_null(F.col(c), na_values))


def to_model(df: DataFrame, kind: str, na_values=("",)) -> DataFrame:
    """Typed model table from raw CSV strings (the loader's casts and trims); the
    position, if read, is kept."""
    return _to_model(df, kind, na_values, [F.col(POSITION)] * (POSITION in df.columns))


def _to_model(df: DataFrame, kind: str, na_values, place: list) -> DataFrame:
    if kind == "topic":
        return df.select(F.col("id").try_cast("long").alias("id"), _txt("nombre_campo", na_values).alias("name"), *place)
    if kind == "topic_edge":
        return df.select(F.col("id").try_cast("long").alias("id"),
                         F.col("id_padre").try_cast("long").alias("parent_id"),
                         F.col("id_hijo").try_cast("long").alias("child_id"), *place)
    if kind == "technology":
        return df.select(F.col("id").try_cast("long").alias("id"), _txt("nombre", na_values).alias("name"),
                         _txt("tipo", na_values).alias("kind"), _txt("version", na_values).alias("version"),
                         *place)
    if kind == "work":
        return df.select(
            F.col("id").try_cast("long").alias("id"),
            _txt("doi", na_values).alias("doi"),
            _txt("direccion_fuente", na_values).alias("source_url"),
            _txt("titulo", na_values).alias("title"),
            _txt("abstract", na_values).alias("abstract"),
            na_to_null(F.col("fecha_publicacion"), na_values).alias("published"),  # not trimmed
            _txt("idioma", na_values).alias("language"),
            int_or(F.col("num_citas"), 0).alias("citations"),
            float_or(F.col("fwci"), 0.0).alias("fwci"),
            F.col("tematica_id").try_cast("long").alias("topic_id"), *place)
    if kind == "mention":
        return df.select(F.col("id").try_cast("long").alias("id"),
                         F.col("obra_id").try_cast("long").alias("work_id"),
                         F.col("tecnologia_id").try_cast("long").alias("technology_id"), *place)
    raise ValueError(kind)


# Columns the loader casts, with their target types, per table.
CAST_COLUMNS = {
    "topic": {"id": "bigint"},
    "topic_edge": {"id": "bigint", "id_padre": "bigint", "id_hijo": "bigint"},
    "technology": {"id": "bigint"},
    "work": {"id": "bigint", "num_citas": "bigint", "fwci": "double", "tematica_id": "bigint"},
    "mention": {"id": "bigint", "obra_id": "bigint", "tecnologia_id": "bigint"},
}


def malformed_values(raw: DataFrame, kind: str) -> DataFrame:
    """SC6: (column, value, n_rows) for non-empty text that does not parse as
    its column's type.  The loader would turn these into defaults; a load
    should stop on them, as the original cast would have."""
    parts = [raw.where(malformed(F.col(c), t)).select(F.lit(c).alias("column"), F.col(c).alias("value"))
             for c, t in CAST_COLUMNS[kind].items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n_rows"))


def read_model_table(spark: SparkSession, path: str, kind: str, na_values=("",),
                     position: bool = False) -> DataFrame:
    """Typed table of CSV files; stops on values that do not parse (SC6)."""
    raw = read_csv(spark, path, kind, position)
    bad = malformed_values(raw, kind).limit(5).collect()  # a few, for the message
    if bad:
        raise ValueError(f"{kind}: values that do not parse: {[(r['column'], r['value']) for r in bad]}")
    return to_model(raw, kind, na_values)


def to_parquet(spark: SparkSession, csv_path: str, kind: str, out_path: str) -> None:
    """Convert a CSV table to Parquet once, so later scans split and prune."""
    read_csv(spark, csv_path, kind).write.mode("overwrite").parquet(out_path)


def write_csv(df: DataFrame, path: str) -> None:
    """SNK1 for CSV consumers: header plus RFC-4180 quoting; spaces stay."""
    df.write.mode("overwrite").options(header="true", escape='"', quote='"', ignoreLeadingWhiteSpace="false",
                                       ignoreTrailingWhiteSpace="false").csv(path)
