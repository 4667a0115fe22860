"""Queries on stable ids: splits, merges, assignment, constraints."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stemma.model import ENTRIES_SQL, part_entries
from stemma.operators import identity, resolve
from stemma.plans.registry import query, table

_E = f"WITH {ENTRIES_SQL}"
_COLUMNS = "e.filename, e.bibkey, e.refid, e.hash"
#: Steps 1 to 5 with the tie rules alone.
STEPS_SQL = """
s AS (SELECT refid, min(hash) AS stays FROM entry WHERE refid IS NOT NULL GROUP BY refid HAVING count(DISTINCT hash) > 1),
a AS (SELECT e.*, CASE WHEN s.stays IS NULL OR e.hash = s.stays THEN e.refid END AS srefid FROM entry e LEFT JOIN s USING (refid)),
m AS (SELECT hash, max(srefid) AS stays FROM a WHERE srefid IS NOT NULL GROUP BY hash HAVING count(DISTINCT srefid) > 1),
b AS (SELECT a.*, CASE WHEN srefid IS NOT NULL THEN coalesce(m.stays, srefid) END AS id3 FROM a LEFT JOIN m USING (hash)),
g AS (SELECT hash, max(id3) AS known FROM b GROUP BY hash),
c AS (SELECT b.*, CASE WHEN refid IS NULL AND id3 IS NULL THEN g.known ELSE id3 END AS id4 FROM b JOIN g USING (hash)),
n AS (SELECT hash, (SELECT coalesce(max(refid), 0) FROM entry) + row_number() OVER (ORDER BY hash) AS fresh FROM (SELECT DISTINCT hash FROM c WHERE id4 IS NULL)),
assigned AS (SELECT c.filename, c.bibkey, c.refid, c.hash, c.srefid, coalesce(n.fresh, c.id4) AS id FROM c LEFT JOIN n USING (hash))"""
ASSIGN_SQL = f"{_E}, {STEPS_SQL}"


@query(f"{_E} SELECT {_COLUMNS} FROM entry e WHERE EXISTS (SELECT 1 FROM entry o WHERE o.refid = e.refid AND o.hash <> e.hash)")
def splits(spark: SparkSession, folder: str) -> DataFrame:
    return identity.splits(part_entries(spark, folder))


@query(f"{_E} SELECT {_COLUMNS} FROM entry e WHERE EXISTS (SELECT 1 FROM entry o WHERE o.hash = e.hash AND o.refid <> e.refid)")
def merges(spark: SparkSession, folder: str) -> DataFrame:
    return identity.merges(part_entries(spark, folder))


@query(f"""{_E} SELECT {_COLUMNS} FROM entry e WHERE EXISTS (SELECT 1 FROM entry o WHERE o.hash = e.hash AND o.refid IS NULL)
AND EXISTS (SELECT 1 FROM entry o WHERE o.hash = e.hash AND o.refid IS NOT NULL) ORDER BY e.hash, e.refid IS NOT NULL, e.refid, e.filename, e.bibkey""")
def identified(spark: SparkSession, folder: str) -> DataFrame:
    return identity.identified(part_entries(spark, folder)).orderBy("hash", F.col("refid").isNotNull(), "refid", "filename", "bibkey")


@query(f"""{_E} SELECT {_COLUMNS} FROM entry e WHERE refid IS NULL
AND EXISTS (SELECT 1 FROM entry o WHERE o.hash = e.hash AND o.refid IS NULL AND (o.filename <> e.filename OR o.bibkey <> e.bibkey))""")
def combined(spark: SparkSession, folder: str) -> DataFrame:
    return identity.combined(part_entries(spark, folder))


@query(f"{ASSIGN_SQL} SELECT * FROM assigned")
def assign_ids(spark: SparkSession, folder: str) -> DataFrame:
    """Stable ids where ties alone decide."""
    return identity.assign_ids(part_entries(spark, folder))


@query()
def resolve_ids(spark: SparkSession, folder: str) -> DataFrame:
    """Stable ids where the most similar group wins; the similarity is a matching of strings that SQL can't express."""
    p = table(spark, folder, "part")
    entries = part_entries(spark, folder)
    fields = {"title": F.col("p_name"), "publisher": F.col("p_brand"), "note": F.col("p_type"), "year": F.col("p_size")}
    values = resolve.part_values(p, fields)
    files = entries.select("filename").distinct().withColumn("priority", F.regexp_extract("filename", r"(\d)", 1).cast("long"))
    return resolve.resolved(entries, values, files)


@query(f"{ASSIGN_SQL} SELECT refid AS id, id AS replacement FROM assigned WHERE id <> refid ORDER BY 1, 2")
def id_replacements(spark: SparkSession, folder: str) -> DataFrame:
    return identity.replacements(identity.assign_ids(part_entries(spark, folder)))


@query(f"""{ASSIGN_SQL} SELECT filename, CAST(sum((refid IS NULL)::INT) AS BIGINT) AS added, CAST(sum((refid IS NOT NULL)::INT) AS BIGINT) AS changed FROM assigned
WHERE id IS DISTINCT FROM refid GROUP BY filename""")
def changed_files(spark: SparkSession, folder: str) -> DataFrame:
    return identity.changed_files(identity.assign_ids(part_entries(spark, folder)))


@query(f"""{_E}, n AS (SELECT DISTINCT hash FROM entry WHERE refid IS NULL)
SELECT hash, (SELECT coalesce(max(refid), 0) FROM entry) + row_number() OVER (ORDER BY hash) AS number FROM n""")
def new_ids(spark: SparkSession, folder: str) -> DataFrame:
    """Consecutive new ids for the hashes of entries without one."""
    e = part_entries(spark, folder)
    first = e.agg(F.coalesce(F.max("refid"), F.lit(0)) + 1).first()[0]
    return identity.numbered_by(e.where("refid is null"), "hash", first)


@query(f"""{_E} SELECT 'hash' AS kind, hash AS key, count(DISTINCT refid) AS n FROM entry GROUP BY hash HAVING count(DISTINCT refid) > 1
UNION ALL SELECT 'id', CAST(refid AS VARCHAR), count(DISTINCT hash) FROM entry WHERE refid IS NOT NULL GROUP BY refid HAVING count(DISTINCT hash) > 1""")
def one_to_one_violations(spark: SparkSession, folder: str) -> DataFrame:
    return identity.one_to_one_violations(part_entries(spark, folder).withColumnRenamed("refid", "id"))


@query("""SELECT n_nationkey AS nationkey, n_name AS name FROM nation WHERE NOT EXISTS (SELECT 1 FROM supplier WHERE s_nationkey = n_nationkey AND s_acctbal > 5000)""")
def unregistered_files(spark: SparkSession, folder: str) -> DataFrame:
    """Rows without a partner: left anti."""
    rich = table(spark, folder, "supplier").where("s_acctbal > 5000")
    n = table(spark, folder, "nation")
    return n.join(rich, n.n_nationkey == rich.s_nationkey, "left_anti").select(F.col("n_nationkey").alias("nationkey"), F.col("n_name").alias("name"))


@query(f"""{ASSIGN_SQL} SELECT 'all-hash' AS invariant, CAST(count(*) AS BIGINT) AS violations FROM assigned WHERE hash IS NULL
UNION ALL SELECT 'all-id', count(*) FROM assigned WHERE id IS NULL
UNION ALL SELECT 'no-splits', count(*) FROM (SELECT srefid FROM assigned WHERE srefid IS NOT NULL GROUP BY srefid HAVING count(DISTINCT hash) > 1)
UNION ALL SELECT 'no-merges', count(*) FROM (SELECT hash FROM assigned GROUP BY hash HAVING count(DISTINCT id) > 1)
UNION ALL SELECT 'one-to-one', count(*) FROM (SELECT id FROM assigned GROUP BY id HAVING count(DISTINCT hash) > 1)""")
def invariants(spark: SparkSession, folder: str) -> DataFrame:
    """How many violations each invariant of assigned ids has."""
    a = identity.assign_ids(part_entries(spark, folder))
    plain = a.agg(F.count_if(F.col("hash").isNull()).alias("all-hash"), F.count_if(F.col("id").isNull()).alias("all-id"))
    out = plain.select(F.explode(F.create_map(F.lit("all-hash"), "`all-hash`", F.lit("all-id"), "`all-id`")).alias("invariant", "violations"))
    for name, key, of in (("no-splits", "srefid", "hash"), ("no-merges", "hash", "id"), ("one-to-one", "id", "hash")):
        bad = a.where(F.col(key).isNotNull()).groupBy(key).agg(F.countDistinct(of).alias("n")).agg(F.count_if(F.col("n") > 1).alias("violations"))
        out = out.unionByName(bad.select(F.lit(name).alias("invariant"), "violations"))
    return out


_DOCS = "doc AS (SELECT source || '.bib' AS filename, doc_id AS id, md5(text) AS hash FROM documents)"


def _docs(spark: SparkSession, folder: str) -> DataFrame:
    d = table(spark, folder, "documents")
    return d.select(F.concat("source", F.lit(".bib")).alias("filename"), F.col("doc_id").alias("id"), F.md5(F.col("text").cast("binary")).alias("hash"))


@query(f"WITH {_DOCS} SELECT count(DISTINCT hash) AS n_distinct, count(hash) AS n_total FROM doc")
def hash_stats(spark: SparkSession, folder: str) -> DataFrame:
    d = _docs(spark, folder).groupBy("hash").agg(F.count("*").alias("n")).where("hash is not null")
    return d.agg(F.count("*").alias("n_distinct"), F.coalesce(F.sum("n"), F.lit(0)).alias("n_total"))


@query(f"""WITH {_DOCS}, u AS (SELECT hash FROM doc GROUP BY hash HAVING count(DISTINCT filename) = 1)
SELECT filename, count(hash) AS n_total, count(DISTINCT hash) AS n_distinct, count(DISTINCT CASE WHEN hash IN (SELECT hash FROM u) THEN hash END) AS n_unique FROM doc GROUP BY filename""")
def hash_file_stats(spark: SparkSession, folder: str) -> DataFrame:
    """All, distinct and unshared hashes of each file."""
    pairs = _docs(spark, folder).where("hash is not null").groupBy("filename", "hash").agg(F.count("*").alias("n"))
    alone = pairs.groupBy("hash").agg(F.count("*").alias("files"), F.min("filename").alias("filename")).where("files = 1").groupBy("filename").agg(F.count("*").alias("n_unique"))
    each = pairs.groupBy("filename").agg(F.sum("n").alias("n_total"), F.count("*").alias("n_distinct"))
    return each.join(alone, "filename", "left").select("filename", "n_total", "n_distinct", F.coalesce("n_unique", F.lit(0)).alias("n_unique"))


@query(f"WITH {_DOCS} SELECT hash, count(DISTINCT filename) AS n_files FROM doc GROUP BY hash HAVING count(DISTINCT filename) > 1")
def multi_file_hashes(spark: SparkSession, folder: str) -> DataFrame:
    return _docs(spark, folder).select("hash", "filename").distinct().groupBy("hash").agg(F.count("*").alias("n_files")).where("n_files > 1")


@query(f"{_E} SELECT n, count(*) AS hashes FROM (SELECT hash, count(DISTINCT refid) AS n FROM entry GROUP BY hash) GROUP BY n")
def hash_id_histogram(spark: SparkSession, folder: str) -> DataFrame:
    """How many hashes have how many ids."""
    pairs = part_entries(spark, folder).select("hash", "refid").distinct()
    return pairs.groupBy("hash").agg(F.count("refid").alias("n")).groupBy("n").agg(F.count("*").alias("hashes"))


@query(f"{_E} SELECT n, count(*) AS ids FROM (SELECT refid, count(DISTINCT hash) AS n FROM entry WHERE refid IS NOT NULL GROUP BY refid) GROUP BY n")
def id_hash_histogram(spark: SparkSession, folder: str) -> DataFrame:
    """How many ids have how many hashes."""
    pairs = part_entries(spark, folder).where("refid is not null").select("hash", "refid").distinct()
    return pairs.groupBy("refid").agg(F.count("hash").alias("n")).groupBy("n").agg(F.count("*").alias("ids"))
