"""The queries opN_<name> of this subpackage, with their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stemma.llm import alignment, decontaminate, fingerprint, jaccard_join, language_id, lm, oracles, packing, secrets, sharding, spelling, token_counts, topk, toxicity
from stemma.llm.storage import crc_of_id, cut, keyed


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score every document, by a model learnt from labelled documents outside the held-out quarter."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = toxicity.fit(docs, labels.where(F.pmod(crc_of_id(), F.lit(4)) != 2))
    out = toxicity.score(docs.withColumn("held_out", F.pmod(crc_of_id(), F.lit(4)) == 2), model, ["doc_id", "held_out"])
    return out.withColumn("predicted", (F.col("score") >= toxicity.THRESHOLD).cast("int"))


def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predict the language of every document, by a model learnt outside the held-out third."""
    docs = table(spark, sf_dir, "documents")
    model = language_id.fit(docs.where(F.pmod(crc_of_id(), F.lit(3)) != 1))
    return language_id.predict(docs.withColumn("held_out", F.pmod(crc_of_id(), F.lit(3)) == 1), model, ["doc_id", "held_out"])


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place every document in one of eight shards; the law is that of equal row counts."""
    placed = sharding.shard_documents(table(spark, sf_dir, "documents"))
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op5_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score every document by the base and by the model, both learnt outside the held-out tenth."""
    docs = table(spark, sf_dir, "documents")
    model, counts = lm.fit(docs.where(F.pmod(crc_of_id(), F.lit(10)) != 0))
    return lm.score(docs.withColumn("held_out", F.pmod(crc_of_id(), F.lit(10)) == 0), model, counts, ["doc_id", "held_out"])


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pack all documents; a row for each piece."""
    return packing.digest(packing.pack(table(spark, sf_dir, "documents")))


def op7_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint every document and its edited text."""
    return fingerprint.scan(table(spark, sf_dir, "documents"))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals after four commits over all documents: all inserted, later copies deleted, the rest revised, the first batch again.

    A copy is a document whose text another document with a smaller id has. The revision counts an end token for each
    document that is left. The last commit repeats the first batch and changes nothing.
    """
    versions = {v: public_tokenizers.path(f) for v, f in (("byte_bpe_50k", "byte_bpe_50k.json"), ("byte_bpe_multi_50k", "byte_bpe_multi_50k.tiktoken"))}
    docs = table(spark, sf_dir, "documents")
    docs = docs.withColumns({"same": F.xxhash64("text"), "same2": F.coalesce(F.crc32(F.col("text").cast("binary")), F.lit(-1))})
    counts = cut(token_counts.counted(docs, versions, ["doc_id", "source", "lang", "same", "same2"]))
    first = counts.groupBy("same", "same2").agg(F.min("doc_id").alias("first"), F.count("*").alias("n")).where("n > 1")
    marked = keyed(counts, first, ["same", "same2"], "n", counts.count(), "left")
    marked = marked.withColumn("copy", F.col("n").isNotNull() & ~F.col("doc_id").eqNullSafe(F.col("first")))
    copies, kept = (token_counts.long_counts(marked.where(x), versions) for x in ("copy", "not copy"))
    rollup = token_counts.new_rollup(spark)
    everything = token_counts.inserts(token_counts.long_counts(counts, versions))
    rollup.commit("insert", everything)
    rollup.commit("delete", token_counts.deletes(copies))
    rollup.commit("revise", token_counts.revisions(kept, kept.withColumn("n_tokens", F.col("n_tokens") + 1)))
    rollup.commit("insert", everything)
    return rollup.totals(["insert", "delete", "revise"])


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hold every document against every window of the benchmark."""
    found = decontaminate.scan(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    out = found.select("doc_id", "n_words", decontaminate.n_hit(F.col("hits")).alias("n_hit"), F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"))
    return out.withColumn("contaminated", decontaminate.contaminated(F.col("n_hit"), F.col("n_words")))


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Link all documents whose sets of three-word shingles are similar by nine tenths, and give the components."""
    return jaccard_join.join(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id", "class_size")


def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Find the secrets of every document."""
    found = secrets.scan(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")
    of = lambda k: F.size(F.filter("secret_spans", lambda x: x["kind"] == k)).cast("long").alias(f"n_{secrets.KINDS[k]}")
    base = F.filter("secret_spans", lambda x: x["kind"] < 3)
    return found.select("doc_id", of(0), of(1), of(2), F.sha2(secrets.written(base), 256).alias("base_sha256"), secrets.written(F.col("secret_spans")).alias("spans"))


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Group the spelling variants among the words of all documents."""
    return spelling.variants(table(spark, sf_dir, "documents"))


def op12_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best rows for each hundredth vector, among all vectors."""
    return topk.search(table(spark, sf_dir, "embeddings")).select("query_id", "rank", "vec_id", "score")


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Align the two tokenizations of every document, with the pair counts of all documents."""
    return alignment.align(table(spark, sf_dir, "documents"), digested=True).withColumnRenamed("groups", "groups_sha256")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {x.__name__: x for x in (op1_toxicity, op2_decontamination, op3_language, op4_sharding, op5_lm_scoring, op6_packing, op7_fingerprints, op8_token_counts, op9_jaccard_join, op10_secrets, op11_spelling, op12_topk, op13_alignment)}
SQL: dict[str, str] = {"op2_decontamination": oracles.DECONTAMINATION, "op11_spelling": oracles.SPELLING, "op12_topk": oracles.TOPK}
