"""SRC7: read an N-Triples export back into a triples DataFrame.

Each line is parsed with native regular expressions; literal escapes are
undone by splitting on escaped backslashes first, so ``\\\\n`` (a backslash
followed by ``n``) and ``\\n`` (a newline) stay distinct.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from techmine.operators.graph import TRIPLE_COLS

# DOTALL: literals may hold NEL, LS or PS, which a plain '.' does not match.
_LINE = r'(?s)^<([^>]*)> <([^>]*)> (.*) \.$'
_LIT = r'(?s)^"(.*)"(?:\^\^<([^>]*)>)?$'


def unescape_literal(c: Column) -> Column:
    def piece(p):
        out = p
        for esc, raw in (('\\"', '"'), ("\\n", "\n"), ("\\r", "\r"), ("\\t", "\t")):
            out = F.replace(out, F.lit(esc), F.lit(raw))
        return out
    return F.array_join(F.transform(F.split(c, r"\\\\", -1), piece), "\\")


def parse_ntriples(lines: DataFrame, col: str = "value") -> DataFrame:
    v = F.col(col)
    parsed = (lines.where(F.trim(v) != "")
                   .select(F.regexp_extract(v, _LINE, 1).alias("s"),
                           F.regexp_extract(v, _LINE, 2).alias("p"),
                           F.regexp_extract(v, _LINE, 3).alias("obj")))
    is_iri = F.col("obj").startswith("<")
    return parsed.select(
        "s", "p",
        F.when(is_iri, F.expr("substring(obj, 2, length(obj) - 2)"))
         .otherwise(unescape_literal(F.regexp_extract("obj", _LIT, 1))).alias("o"),
        F.when(is_iri, F.lit("iri")).otherwise(F.lit("literal")).alias("o_kind"),
        F.when(is_iri, F.lit(None).cast("string"))
         .otherwise(F.nullif(F.regexp_extract("obj", _LIT, 2), F.lit(""))).alias("datatype"),
    ).select(*TRIPLE_COLS)


def read_ntriples(spark, path: str) -> DataFrame:
    return parse_ntriples(spark.read.text(path))
