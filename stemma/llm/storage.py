"""Materialisation, bounded Arrow batches and gapless numbering shared by the operators."""

from __future__ import annotations

import math
import tempfile
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stemma.joins import keyed, private

__all__ = ["BROADCAST_ROWS", "BYTES_PER_BATCH", "ROWS_PER_BUCKET", "crc_of_id", "cut", "in_batches", "keyed", "numbered", "private", "shared_folder", "sliced", "small", "summed_vectors", "text_bytes", "without"]

#: Bytes of text that a worker works on at once; one longer text is a batch by itself.
BYTES_PER_BATCH = 2 << 20
#: Most rows of a table that is sent to every executor.
BROADCAST_ROWS = 1_000_000
#: Rows numbered by one window.
ROWS_PER_BUCKET = 20_000


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it from there, so lost executors cost no recomputation.

    The folder is the one named by ``spark.checkpoint.dir``; a temporary one is used only where a local session sets none.
    """
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_folder(spark))
    return df.checkpoint(eager=True)


def shared_folder(spark: SparkSession) -> str:
    """The folder that the driver and all executors share; a temporary one only where a local session names none."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="checkpoints-")
    spark.sparkContext.setCheckpointDir(folder)
    return spark.sparkContext.getCheckpointDir()


def small(df: DataFrame, rows: int, bound: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` marked for broadcast if its counted ``rows`` are within ``bound``; beyond it the join shuffles."""
    return F.broadcast(df) if rows <= bound else df


def without(docs: DataFrame, keys: DataFrame, rows: int) -> DataFrame:
    """The rows of ``docs`` whose (doc_id, hash of the text) isn't among the ``rows`` rows of ``keys`` (doc_id, text_key), with the columns of ``docs``.

    Nulls are equal to nulls. Two texts of one doc_id and one 64-bit hash are the same row here.
    """
    k = small(keys.select(F.col("doc_id").alias("__lost_id"), F.col("text_key").alias("__lost_key")), rows)
    return docs.join(k, docs["doc_id"].eqNullSafe(k["__lost_id"]) & (F.xxhash64(docs["text"]) == k["__lost_key"]), "left_anti")


def text_bytes(name: str = "text") -> Column:
    """UTF-8 bytes of a text column, empty for null."""
    return F.coalesce(F.col(name).cast("string"), F.lit("")).cast("binary")


def crc_of_id(name: str = "doc_id") -> Column:
    """crc32 of the id written as text; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(name).cast("string"), F.lit("")).cast("binary"))


def in_batches(df: DataFrame, work: Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """Apply ``work`` to Arrow batches whose last column (binary) holds at most about BYTES_PER_BATCH bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in sliced(batches):
            yield from work(part)

    return df.mapInArrow(run, schema)


def sliced(batches: Iterator[pa.RecordBatch], most: int = BYTES_PER_BATCH, column: int = -1) -> Iterator[pa.RecordBatch]:
    """Batches of about ``most`` bytes in ``column`` (binary), by default the last."""
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        sizes = pc.binary_length(batch.columns[column]).to_numpy(zero_copy_only=False).astype(np.int64)
        part = np.cumsum(sizes) // most
        edges = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), n]
        for a, b in zip(edges, edges[1:]):
            if b > a:
                yield batch.slice(a, b - a)


def summed_vectors(df: DataFrame, length: int) -> dict[int, np.ndarray]:
    """Sum int64 vectors of a fixed ``length`` by key over all partitions.

    ``df`` has ``key int, salt int, data binary`` (zlib of little-endian int64). Each worker folds its rows one at a
    time; a first round sums within (key, salt), a second the few salted sums of each key. Keys and length are bounded
    by the caller, so the sums that come to the driver are too.
    """
    import zlib

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            for key, salt, data in zip(*(c.to_pylist() for c in batch.columns)):
                vector = np.frombuffer(zlib.decompress(data), dtype="<i8")
                at = sums.get((key, salt))
                if at is None:
                    sums[key, salt] = vector.copy()
                else:
                    at += vector
        for (key, salt), vector in sums.items():
            yield pa.record_batch([pa.array([key], pa.int32()), pa.array([salt], pa.int32()), pa.array([zlib.compress(vector.tobytes(), 1)], pa.binary())], ["key", "salt", "data"])

    schema = "key int, salt int, data binary"
    first = df.repartition("key", "salt").mapInArrow(fold, schema)
    last = first.withColumn("salt", F.lit(0)).repartition("key").mapInArrow(fold, schema)
    return {r.key: np.frombuffer(zlib.decompress(r.data), dtype="<i8") for r in last.collect()} if length else {}


def numbered(df: DataFrame, group: list[str], order: list[str], rows: int, name: str) -> DataFrame:
    """Add ``name``: a gapless number from 0 within ``group``, without ever bringing a group into one task.

    Rows are dealt by a hash of ``order`` into buckets of about ROWS_PER_BUCKET rows, numbered there, and moved up by
    the counts of the buckets before. ``df`` must be materialised, as it is read twice; ``rows`` is its row count.
    Rows equal in all of ``order`` share a bucket and are numbered in any order.
    """
    n = max(1, math.ceil(rows / ROWS_PER_BUCKET))
    df = df.withColumn("__bucket", F.pmod(F.xxhash64(*order), F.lit(n)))
    keys = [*group, "__bucket"]
    before = Window.partitionBy(*group).orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    base = df.groupBy(*keys).agg(F.count("*").alias("__n")).withColumn("__base", F.coalesce(F.sum("__n").over(before), F.lit(0))).drop("__n")
    inside = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    out = df.withColumn("__rn", inside).join(small(base, n * 64), keys)
    return out.withColumn(name, F.col("__base") + F.col("__rn") - 1).drop("__bucket", "__base", "__rn")
