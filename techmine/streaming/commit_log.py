"""INC2 with fenced commits: one log that every registration run appends to.

A commit is a folder with new names, links and finished works, and a log entry that
reserves their id ranges.  Entries are numbered without gaps; an entry is put in
place by a rename that fails if the number is taken, so of two runs that commit at
once one wins, and the other sees the new state and numbers its rows again.  Ids
come from the last entry, not from a scan of what is stored.  A batch that is in
the log is not done again: a run that stopped between any two writes, or a stream
that replays a batch, gives out no id twice.

Readers see the folders of the log's entries; folders of lost races and of runs
that stopped half-way are never read.  The rename is atomic on stores whose rename
is (HDFS); on others one writer at a time is needed.
"""

from __future__ import annotations

import json
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from techmine.operators.dimensions import first_seen
from techmine.operators.ids import dense_ids

TABLES = {"names": "id long, name string", "links": "id long, work_id long, technology_id long",
          "done": "work_id long"}
ENTRY = ("seq long, batch string, folder string, first_name long, n_names long, first_link long, n_links long")


class CommitLog:
    """The log below ``root``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _hadoop(self, path: str):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p, p.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def table(self) -> DataFrame:
        """The entries, one row each."""
        pattern, fs = self._hadoop(f"{self.root}/log/*.json")
        found = fs.globStatus(pattern)
        if found is None or not len(found):
            return self.spark.createDataFrame([], ENTRY)
        return self.spark.read.schema(ENTRY).option("mode", "FAILFAST").json(f"{self.root}/log/*.json")

    def entries(self) -> list[dict]:
        """One small record per commit, in order."""
        return [r.asDict() for r in self.table().orderBy("seq").collect()]

    def append(self, entry: dict) -> bool:
        """Put ``entry`` in its place; False if its number is taken."""
        jvm = self.spark._jvm
        staged, fs = self._hadoop(f"{self.root}/staged/{uuid.uuid4().hex}.json")
        out = fs.create(staged, False)
        out.write(bytearray(json.dumps(entry).encode()))
        out.close()
        place, _ = self._hadoop(f"{self.root}/log/{entry['seq']:012d}.json")
        fs.mkdirs(place.getParent())
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), self.spark._jsc.hadoopConfiguration())
        options = self.spark._sc._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
        try:
            context.rename(staged, place, options)
        except Py4JJavaError as e:
            if "FileAlreadyExistsException" in e.java_exception.getClass().getName():
                return False
            raise
        return True

    def read(self, name: str, entries: list[dict] | None = None) -> DataFrame:
        """A table over all commits (or those of ``entries``)."""
        entries = self.entries() if entries is None else entries
        if not entries:
            return self.spark.createDataFrame([], TABLES[name])
        return self.spark.read.schema(TABLES[name]).parquet(*[f"{e['folder']}/{name}" for e in entries])


def _write(df: DataFrame, path: str) -> None:
    df.write.parquet(path)


def register_batch(spark: SparkSession, root: str, batch_id: str, batch: DataFrame, order_cols: list[str],
                   work_col: str = "work_id", name_col: str = "name") -> bool:
    """Register the names of ``batch``, link its works, record them as done, as one
    commit.  False if the batch is in the log already.

    New names get ids in first-seen order, new links in (work, name) order, both
    after the ranges of the last entry.  Null names make no link.
    """
    log = CommitLog(spark, root)
    batch = batch.checkpoint(eager=True)
    while True:
        entries = log.entries()
        if any(e["batch"] == batch_id for e in entries):
            return False
        last = entries[-1] if entries else {"seq": -1, "first_name": 1, "n_names": 0, "first_link": 1, "n_links": 0}
        entry = {"seq": last["seq"] + 1, "batch": batch_id, "first_name": last["first_name"] + last["n_names"],
                 "first_link": last["first_link"] + last["n_links"]}
        entry["folder"] = f"{log.root}/data/{entry['seq']:012d}-{uuid.uuid4().hex[:12]}"
        stored, links, done = (log.read(t, entries) for t in ("names", "links", "done"))
        known = batch.where(F.col(name_col).isNotNull())
        unseen = known.join(stored.select(F.col("name").alias(name_col)), name_col, "left_anti")
        new = dense_ids(first_seen(unseen, name_col, order_cols), [F.col("__first"), F.col(name_col)],
                        start=entry["first_name"])
        _write(new.select("id", F.col(name_col).alias("name")), f"{entry['folder']}/names")
        new = spark.read.schema(TABLES["names"]).parquet(f"{entry['folder']}/names")
        ids = stored.unionByName(new).select(F.col("id").alias("technology_id"), F.col("name").alias(name_col))
        pairs = known.select(F.col(work_col).cast("long").alias("work_id"), name_col).distinct().join(ids, name_col)
        fresh = pairs.join(links.select("work_id", "technology_id"), ["work_id", "technology_id"], "left_anti")
        numbered = dense_ids(fresh, ["work_id", name_col], start=entry["first_link"])
        _write(numbered.select("id", "work_id", "technology_id"), f"{entry['folder']}/links")
        works = batch.select(F.col(work_col).cast("long").alias("work_id")).distinct()
        _write(works.join(done, "work_id", "left_anti"), f"{entry['folder']}/done")
        entry["n_names"] = new.count()
        entry["n_links"] = spark.read.schema(TABLES["links"]).parquet(f"{entry['folder']}/links").count()
        if log.append(entry):
            return True
        # Another run committed first: its names and ranges count, number again.


def run_stream(spark: SparkSession, landing: str, schema: T.StructType, root: str, checkpoint: str,
               order_cols: list[str], files_per_batch: int | None = None) -> None:
    """Commit every file landed so far, then stop.  A batch is known by the stream's
    checkpoint folder and its number, so a replay after a failure is recognised."""
    stream = spark.readStream.schema(schema)
    if files_per_batch is not None:
        stream = stream.option("maxFilesPerTrigger", files_per_batch)

    def each(batch: DataFrame, number: int) -> None:
        register_batch(spark, root, f"{checkpoint}#{number}", batch, order_cols)

    (stream.parquet(landing).writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
           .trigger(availableNow=True).start().awaitTermination())
