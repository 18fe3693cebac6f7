"""AG6: ordered concatenation of a document's page texts.

Pages are collected per document (a document's pages are bounded by that
document), sorted by page number and joined by a blank line; the result is
trimmed and a blank result counts as no text (null).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from techmine.functions.text import strip_ws


def join_pages(pages: DataFrame, doc_col: str, page_col: str, text_col: str,
               out_col: str = "text") -> DataFrame:
    joined = (pages.groupBy(doc_col)
                   .agg(F.sort_array(F.collect_list(F.struct(F.col(page_col).alias("n"),
                                                             F.col(text_col).alias("t")))).alias("ps"))
                   .select(doc_col, strip_ws(F.array_join(F.transform("ps", lambda x: x["t"]), "\n\n"))
                           .alias("__t")))
    return joined.select(doc_col, F.nullif(F.col("__t"), F.lit("")).alias(out_col))


def with_row_count(df: DataFrame, name: str):
    """AG4: count rows as a side effect of the next action (no extra job).
    Returns (df, observation); read ``observation.get["rows"]`` after the action."""
    from pyspark.sql import Observation
    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias("rows")), obs
