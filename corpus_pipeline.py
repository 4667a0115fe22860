"""The pipeline that prepares a corpus: toxicity, near duplicates, benchmark decontamination, secrets, packing."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stemma.llm import decontaminate, jaccard_join, packing, secrets, toxicity
from stemma.llm.storage import crc_of_id, private, shared_folder

#: SQL can't express the learnt classifier and the tokenizer; tests hold the stages against brute-force versions.
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score under the threshold; the model is learnt as in the operator's query, from the rows that came.

    Null and empty texts score as the model's bias; without labels nothing goes. Repeated rows stay or go together.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = toxicity.fit(docs, labels.where(F.pmod(crc_of_id(), F.lit(4)) != 2))
    score = private(docs, "toxicity")
    scored = toxicity.score(docs, model, docs.columns, score)
    return scored.where(F.col(score) < toxicity.THRESHOLD).select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of similar documents, the one with the smallest doc_id, null being the largest.

    Rows without words are similar to nothing and stay; of repeated rows one stays.
    """
    return jaccard_join.deduplicated(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold too little of the benchmark to be contaminated.

    Null and empty texts stay, as all do without benchmark items; repeated rows stay or go together.
    """
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with their secrets masked; null and empty texts and repeated rows stay as they are."""
    return secrets.redacted(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents; null and empty texts are the end id alone, repeated rows are packed each for itself."""
    return packing.digest(packing.pack(docs))


STAGES = [("toxicity", drop_toxic), ("near copies", drop_near_copies), ("decontamination", drop_contaminated), ("secrets", mask_secrets), ("packing", pack)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to the documents of ``sf_dir``; each one's rows are written to the shared folder and read by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for k, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
    return docs
