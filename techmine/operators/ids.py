"""Dense, gap-free sequential ids in a global order without a one-partition window.

``row_number() over (order by ...)`` moves every row into one task.  Here the
rows are range-partitioned on the order keys and sorted inside each partition;
each row gets its position inside its partition, the per-partition row counts
(one row per partition, a bounded table) give every partition its starting
offset, and a broadcast join of those offsets finishes the id.  The tagged rows
are checkpointed to the shared checkpoint folder before the counts are taken,
so the two uses see the same partitioning even if a task is retried on
another executor.

The order must be total: callers pass a unique tie-break column last.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from techmine.session import ensure_checkpoint_dir

_PID = "__tm_pid"
_POS = "__tm_pos"


def _as_cols(cols):
    return [F.col(c) if isinstance(c, str) else c for c in cols]


def dense_ids(df: DataFrame, order_by: list, id_col: str = "id",
              start: int = 1, partitions: int | None = None) -> DataFrame:
    """Add ``id_col`` = start + 0-based rank of each row in ``order_by`` order."""
    spark = df.sparkSession
    order = _as_cols(order_by)
    ensure_checkpoint_dir(spark)
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    tagged = (df.repartitionByRange(n, *order)
                .sortWithinPartitions(*order)
                .withColumn(_PID, F.spark_partition_id())
                # monotonically_increasing_id = (partition << 33) + position
                .withColumn(_POS, F.monotonically_increasing_id()
                            - F.shiftleft(F.col(_PID).cast("long"), 33))
                .checkpoint(eager=True))
    counts = tagged.groupBy(_PID).agg(F.count(F.lit(1)).alias("__tm_n"))
    # One row per partition: a bounded table; the window over it is tiny.
    offsets = counts.select(
        _PID,
        (F.sum("__tm_n").over(Window.orderBy(_PID)) - F.col("__tm_n")).alias("__tm_off"))
    out = (tagged.join(F.broadcast(offsets), _PID)
                 .withColumn(id_col, (F.col("__tm_off") + F.col(_POS)).cast("long") + F.lit(int(start)))
                 .drop(_PID, _POS, "__tm_off"))
    return out


def dense_ids_by_key(df: DataFrame, order: list[tuple[str, bool]], key: str, id_col: str = "id",
                     start: int = 1) -> DataFrame:
    """Like ``dense_ids`` for rows with a unique, non-null ``key``; ``order`` has
    (column, ascending) pairs.  Only the key and the order columns are sorted and
    checkpointed; the ids are joined back, so wide columns (texts) move once."""
    names = list(dict.fromkeys([key, *[c for c, _ in order]]))
    sort = [F.col(c).asc() if up else F.col(c).desc() for c, up in order]
    ids = dense_ids(df.select(*names), sort, id_col=id_col, start=start).select(key, id_col)
    return df.join(ids, key)


def dense_ids_after(df: DataFrame, order_by: list, base: DataFrame,
                    id_col: str = "id", base_id_col: str = "id") -> DataFrame:
    """Dense ids continuing after ``max(base.id)`` (1 for an empty base)."""
    return dense_ids(df, order_by, id_col=id_col, start=next_id(base, base_id_col))


def next_id(base: DataFrame, id_col: str = "id") -> int:
    """max(id) + 1 of a stored table, or 1 when it is empty (one scalar).

    Ids are parsed tolerantly: values that are not integers are skipped.
    """
    row = base.agg(F.max(F.expr(f"try_cast({id_col} as bigint)")).alias("m")).first()
    return (row["m"] or 0) + 1


def next_id_from_lines(lines: DataFrame, col: str = "value") -> int:
    """SC16 fallback for a damaged table file read as text lines: the first
    comma field of each line, parsed tolerantly (header and bad lines are
    skipped); max + 1, or 1 when nothing parses."""
    first = F.trim(F.split(F.col(col), ",", 2).getItem(0))
    row = lines.agg(F.max(first.try_cast("bigint")).alias("m")).first()
    return (row["m"] or 0) + 1
