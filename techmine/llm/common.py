"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from techmine.session import ensure_checkpoint_dir, ship_package

# Broadcast bounds: a side is hinted only after both are proven by a count.
BROADCAST_ROWS = 500_000
BROADCAST_BYTES = 32 << 20

# Rows of one Arrow batch; a row can be a whole document of 100 KB and more.
ARROW_ROWS = 256

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def prepare(spark: SparkSession) -> SparkSession:
    """Shared folder set, package on the workers, Arrow batches small enough for
    whole texts."""
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    return spark


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared checkpoint folder; nothing is created."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm/{name}-{uuid.uuid4().hex[:12]}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back: cuts the
    lineage, and lost executors cost no recomputation of what came before."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def partitions(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def _width(f: T.StructField) -> Column:
    if isinstance(f.dataType, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(f.name), F.lit(0)) + 16
    if isinstance(f.dataType, T.ArrayType):  # of numbers, or of structs of a few
        return F.coalesce(F.size(f.name), F.lit(0)) * 64 + 16
    return F.lit(16)


def small_side(df: DataFrame) -> DataFrame:
    """``df`` (a stored, narrow table: numbers, strings, binaries, arrays of numbers)
    hinted for broadcast if its rows and bytes are proven under the bounds;
    otherwise unchanged, so that the join shuffles and AQE splits hot keys."""
    width = sum((_width(f) for f in df.schema.fields), F.lit(0))
    n, size = df.agg(F.count(F.lit(1)), F.coalesce(F.sum(width), F.lit(0))).first()
    return F.broadcast(df) if n <= BROADCAST_ROWS and size <= BROADCAST_BYTES else df


def text_or_empty(c: str = "text") -> Column:
    return F.coalesce(F.col(c), F.lit(""))


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z only; all other characters stay."""
    ascii_only = F.octet_length(c) == F.char_length(c)
    return F.when(ascii_only, F.lower(c)).otherwise(F.translate(c, UPPER, UPPER.lower()))
