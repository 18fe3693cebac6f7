"""Parquet table scans.  Column selection happens in the callers so the scan's
ReadSchema only carries the columns a plan needs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

DRIVER_TABLES = ("region", "nation", "customer", "supplier", "part", "orders",
                 "lineitem", "events", "documents", "embeddings", "pages",
                 "benchmark", "labels", "conversations")


def table(spark: SparkSession, base_dir: str, name: str) -> DataFrame:
    """One parquet table of a folder (``{base_dir}/{name}.parquet``)."""
    return spark.read.parquet(f"{base_dir.rstrip('/')}/{name}.parquet")


def register_views(spark: SparkSession, base_dir: str, names=DRIVER_TABLES) -> None:
    """Expose the tables of a folder as temp views for SQL users."""
    for n in names:
        table(spark, base_dir, n).createOrReplaceTempView(n)
