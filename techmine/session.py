"""Session construction and the shared scratch folder.

On a cluster the checkpoint folder is named by ``spark.checkpoint.dir`` and is
shared by all executors; we only ever read it from the session.  A private
folder is created only when the setting is missing *and* Spark runs in local
mode (tests, the bench), never on a cluster.
"""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

# Settings the engine relies on: adaptive execution (runtime broadcast with a
# measured size, partition coalescing, skew-join splitting) and ANSI-safe casts.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Arrow batches carry whole texts and pages; keep a batch to a few MB.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "512",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, app: str = "techmine",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the engine's defaults."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ship_package(spark: SparkSession) -> None:
    """Send this package to the workers (once per application), so that functions
    running there can import it from any working folder."""
    sc = spark.sparkContext
    if getattr(sc, "_techmine_shipped", False):
        return
    here = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="techmine-zip-"), "techmine.zip")  # the driver serves it
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(here):
            for n in names:
                if n.endswith(".py"):
                    full = os.path.join(folder, n)
                    z.write(full, os.path.join("techmine", os.path.relpath(full, here)))
    sc.addPyFile(path)
    sc._techmine_shipped = True


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting a private one only in local mode."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = sc.getConf().get("spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir()
    if not _is_local(spark):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    local = tempfile.mkdtemp(prefix="techmine-ckpt-")
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir()


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder for written tables."""
    base = ensure_checkpoint_dir(spark)
    path = f"{base.rstrip('/')}/tables/{name}-{uuid.uuid4().hex[:12]}"
    if path.startswith("file:"):
        os.makedirs(path[len("file:"):], exist_ok=True)
    elif path.startswith("/"):
        os.makedirs(path, exist_ok=True)
    return path


def written(df: DataFrame, name: str, **options) -> DataFrame:
    """``df`` written to the shared folder and read back: cuts the lineage as a checkpoint
    does, but in compressed columns, of which later steps read only theirs.  ``options``
    go to the writer, such as ``compression`` for rows with whole texts."""
    path = f"{shared_dir(df.sparkSession, name)}/t"
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
