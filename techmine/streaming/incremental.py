"""INC2: registration fed by newly landed files (Structured Streaming).

A file source over the landing folder, ``trigger(availableNow=True)``, and a
``foreachBatch`` sink that, per micro-batch:

  1. registers names not in the stored dimension (REG1: ids continue after
     the stored maximum, in first-seen order of the batch),
  2. appends one link per (work, name) that is not stored yet, with continuing
     ids (REG3); a work may bring further names in later files,
  3. records the batch's works as done (INC1), those without names included.

Every step anti-joins what is stored, so a replayed batch (after a failure
between the write and the commit of the stream's offsets) adds nothing.  Ids
come from max + rank, so there must be one writer per dimension: this stream.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from techmine.operators.dimensions import bridge_rows, register_names
from techmine.session import written


def _stored(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The table at ``path``, empty while no file was written there.  Any other
    failure to read is an error: an unreadable table is not an empty one."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path + "/*.parquet")
    found = where.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(where)
    if found is None or not len(found):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def register_batch(spark: SparkSession, batch: DataFrame, dim_path: str, links_path: str,
                   order_cols: list[str], work_col: str = "work_id", name_col: str = "name",
                   done_path: str | None = None) -> None:
    dim = _stored(spark, dim_path, "id long, name string")
    links = _stored(spark, links_path, "id long, work_id long, technology_id long")
    batch = written(batch, "batch")
    new = written(register_names(dim, batch, name_col, order_cols), "new-names")
    if not new.isEmpty():
        new.write.mode("append").parquet(dim_path)
    dim_now = dim.unionByName(new)
    pairs = batch.where(F.col(name_col).isNotNull()).select(work_col, name_col).distinct()
    # Only links of the batch's works are looked at.
    linked = links.join(batch.select(F.col(work_col).alias("work_id")).distinct(), "work_id", "left_semi")
    linked = linked.join(dim_now.select(F.col("id").alias("technology_id"), F.col("name").alias(name_col)),
                         "technology_id").select(F.col("work_id").alias(work_col), name_col)
    added = bridge_rows(pairs.join(linked, [work_col, name_col], "left_anti"), dim_now, links,
                        work_col=work_col, name_col=name_col)
    added.write.mode("append").parquet(links_path)
    if done_path is not None:
        done = _stored(spark, done_path, "work_id long")
        works = batch.select(F.col(work_col).cast("long").alias("work_id")).distinct()
        works.join(done, "work_id", "left_anti").write.mode("append").parquet(done_path)


def run_registration_stream(spark: SparkSession, landing: str, schema: T.StructType, dim_path: str,
                            links_path: str, checkpoint: str, order_cols: list[str],
                            files_per_batch: int | None = 1, done_path: str | None = None) -> None:
    """Process every file landed so far, then stop; ``files_per_batch`` files per
    micro-batch, None: all that have landed since the last run as one."""
    stream = spark.readStream.schema(schema)
    if files_per_batch is not None:
        stream = stream.option("maxFilesPerTrigger", files_per_batch)
    stream = stream.parquet(landing)

    def each(batch_df, _epoch):
        register_batch(spark, batch_df, dim_path, links_path, order_cols, done_path=done_path)

    q = (stream.writeStream.foreachBatch(each)
               .option("checkpointLocation", checkpoint)
               .trigger(availableNow=True)
               .start())
    q.awaitTermination()
