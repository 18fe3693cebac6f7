"""Inverted index of a text column: map<word, array<position>> per row.

The index is the input shape of the abstract rebuild (SC1).  Words are
whitespace tokens (empty tokens skipped), positions 0-based and sorted
(SRT4).  It is a per-row expression (``techmine.functions.text.inverted_index``):
each text's index is built where the text is, with no shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from techmine.functions.text import has_word, inverted_index as index_of
from techmine.operators.joins import ensure_parallelism


def inverted_index(df: DataFrame, id_col: str, text_col: str, keep: list[str] | None = None) -> DataFrame:
    """(id, index) for every row whose text has at least one word.

    With ``keep``, all rows with these columns too; without a word the index is null.
    Nothing moves, so ``df`` need not be joined with its own index."""
    if keep is not None:
        return df.select(id_col, *keep, F.when(has_word(text_col), index_of(F.col(text_col))).alias("index"))
    # Rows are chosen by their text: a filter on the index would compute it once more.
    return (ensure_parallelism(df).where(has_word(text_col))
              .select(id_col, index_of(F.col(text_col)).alias("index")))
