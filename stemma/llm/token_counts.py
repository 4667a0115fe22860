"""Token counts as delta-maintained rollups: signed changes update additive totals; a batch counts once however often it is committed."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stemma.llm.bpe import encoder
from stemma.llm.storage import in_batches, private, shared_folder, text_bytes

KEYS = ["source", "lang", "tokenizer_version"]


class Rollup:
    """Totals by source, language and tokenizer version in a shared folder.

    Each committed batch is one folder ``batch=<id>`` of its own summed deltas, written by Spark's committer, whose
    ``_SUCCESS`` marks it as committed. A commit of a batch that has the mark does nothing; one that was broken off is
    written over. Totals are the sums over the committed batches, so the order of commits doesn't matter.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def _path(self, batch: str) -> str:
        return f"{self.folder}/batch={batch}"

    def committed(self, batch: str) -> bool:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self._path(batch)}/_SUCCESS")
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path)

    def commit(self, batch: str, changes: DataFrame) -> bool:
        """Add changes (``sign`` 1 or -1, the keys, ``n_tokens``) once; False if this batch was there already.

        Null keys are a group of their own; a null count is 0 tokens, a null sign no change. An empty batch is
        committed and adds nothing. A batch is known by its id alone, so an id must not be used for other changes, and one
        batch has one writer at a time: of two at once, both write the same sums to the same folder.
        """
        if self.committed(batch):
            return False
        sign = F.coalesce(F.col("sign"), F.lit(0)).cast("long")
        sums = changes.groupBy(*KEYS).agg(F.sum(sign).alias("docs"), F.sum(sign * F.coalesce(F.col("n_tokens"), F.lit(0))).alias("tokens"))
        sums.write.mode("overwrite").parquet(self._path(batch))
        return True

    def totals(self, batches: list[str]) -> DataFrame:
        """Current totals over the given batches, as far as they are committed; groups without documents and tokens go."""
        paths = [self._path(b) for b in dict.fromkeys(batches) if self.committed(b)]
        schema = "source string, lang string, tokenizer_version string, docs long, tokens long"
        rows = self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)
        return rows.groupBy(*KEYS).agg(F.sum("docs").alias("n_docs"), F.sum("tokens").alias("n_tokens")).where("n_docs <> 0 or n_tokens <> 0")


def inserts(counts: DataFrame) -> DataFrame:
    """The counts as additions, a row for each row: repeated rows, nulls and an empty table stay as they are."""
    return counts.withColumn("sign", F.lit(1))


def deletes(counts: DataFrame) -> DataFrame:
    """The counts as removals, a row for each row: repeated rows, nulls and an empty table stay as they are."""
    return counts.withColumn("sign", F.lit(-1))


def revisions(old: DataFrame, new: DataFrame) -> DataFrame:
    """Counts that take the place of others: the old ones with sign -1, the new ones with sign 1.

    Both are counts of rows: a document that is only in one of them is removed or added. The columns must be the same.
    """
    return deletes(old).unionByName(inserts(new))


def counted(docs: DataFrame, versions: dict[str, str], keep: list[str]) -> DataFrame:
    """Columns ``keep`` and one ``n_<version>`` for each tokenizer (version -> vocabulary file), for every row; null text has 0 tokens."""
    data = private(docs, "bytes")
    source = docs.select(*keep, text_bytes().alias(data))
    schema = source.drop(data).schema
    for version in versions:
        schema = schema.add(f"n_{version}", "long")

    def work(part: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        texts = [x.decode() for x in part.columns[-1].to_pylist()]
        found = [pa.array([len(encode(x)) // 4 for x in texts], pa.int64()) for encode in map(encoder, versions.values())]
        yield pa.RecordBatch.from_arrays([*part.columns[:-1], *found], names=schema.names)

    return in_batches(source, work, schema)


def long_counts(counts: DataFrame, versions: dict[str, str]) -> DataFrame:
    """One row for each document and tokenizer version: the keys and n_tokens; repeated rows and nulls stay, other columns go."""
    rows = F.explode(F.array(*[F.struct(F.lit(v).alias("tokenizer_version"), F.col(f"n_{v}").alias("n_tokens")) for v in versions]))
    return counts.select("doc_id", "source", "lang", rows.alias("__x")).select("doc_id", "source", "lang", "__x.*")


def new_rollup(spark: SparkSession) -> Rollup:
    return Rollup(spark, f"{shared_folder(spark)}/rollup-{uuid.uuid4().hex}")
