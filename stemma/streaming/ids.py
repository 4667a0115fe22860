"""Incremental ids over micro-batches, and windowed counts of events."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stemma.operators.identity import numbered_by


class IdTable:
    """hash -> id in a shared folder, a sub-folder for each micro-batch; a batch that comes again is written over with the same rows.

    Beside it, ``<folder>-counts`` has for each batch of ``add_new`` its first number and how many it took. A table is
    filled by ``add`` or by ``add_new``, not by both.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder, self.counts = spark, folder, f"{folder}-counts"

    def exists(self, folder: str) -> bool:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(folder)
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path)

    def known(self, before: int | None = None) -> DataFrame:
        schema = "hash string, id long, batch long"
        if not self.exists(self.folder):
            return self.spark.createDataFrame([], schema)
        rows = self.spark.read.schema(schema).option("basePath", self.folder).parquet(f"{self.folder}")
        return rows if before is None else rows.where(F.col("batch") < before)

    def add(self, entries: DataFrame, batch: int) -> None:
        """Ids for the hashes of a micro-batch that none before had; for ``foreachBatch``."""
        known = self.known(batch)
        new = entries.select("hash").where("hash is not null").distinct().join(known.select("hash"), "hash", "left_anti")
        first = known.agg(F.coalesce(F.max("id"), F.lit(0)) + 1).first()[0]
        numbered_by(new, "hash", first).select("hash", F.col("number").alias("id")).write.mode("overwrite").parquet(f"{self.folder}/batch={batch}")


    def add_new(self, new: DataFrame, batch: int) -> None:
        """Ids for hashes, each once, that no batch had before; for ``foreachBatch`` behind a stream that knows which are new.

        Its work is that of the batch: numbers go on from the count of the batch before, and earlier ids aren't read.
        """
        first = self._next(batch)
        numbered_by(new, "hash", first).select("hash", F.col("number").alias("id")).write.mode("overwrite").parquet(f"{self.folder}/batch={batch}")
        n = self.spark.read.parquet(f"{self.folder}/batch={batch}").count()
        self.spark.createDataFrame([(first, n)], "first long, n long").coalesce(1).write.mode("overwrite").parquet(f"{self.counts}/batch={batch}")

    def _next(self, batch: int) -> int:
        if self.exists(f"{self.counts}/batch={batch - 1}"):
            before = self.spark.read.schema("first long, n long").parquet(f"{self.counts}/batch={batch - 1}")
        elif self.exists(self.counts):  # batches without rows may be left out
            before = self.spark.read.schema("first long, n long, batch long").parquet(self.counts).where(F.col("batch") < batch)
        else:
            return 1
        return before.agg(F.coalesce(F.max(F.col("first") + F.col("n")), F.lit(1))).first()[0]


def assign(stream: DataFrame, table: IdTable, checkpoint: str):
    """Start a query that gives ids to the stream's hashes; null hashes get none, and repeated and late ones keep theirs.

    Which hashes are new is in the stream's state, by hash, so a batch meets its own keys there and not all earlier ids. Only
    a table that was filled otherwise before is joined with each batch.
    """
    if table.exists(table.folder) and not table.exists(table.counts):
        out = stream.writeStream.foreachBatch(table.add)
    else:
        out = stream.select("hash").where("hash is not null").dropDuplicates(["hash"]).writeStream.foreachBatch(table.add_new)
    return out.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def windowed_counts(events: DataFrame, window: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """Events and their value by type and window of event time; rows later than the watermark are left out of a stream."""
    return events.withWatermark("ts", late).groupBy(F.window("ts", window), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("value"))


def run_windowed(events: DataFrame, spark: SparkSession) -> DataFrame:
    """Run windowed counts over all that a finite stream has, into memory; for tests."""
    name = f"windowed_{uuid.uuid4().hex}"
    q = windowed_counts(events).writeStream.outputMode("complete").format("memory").queryName(name).start()
    q.processAllAvailable()
    q.stop()
    return spark.table(name)
