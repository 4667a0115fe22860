"""Queries on tables that are kept up to date, and on files that are written and read."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stemma.lineage import shared_folder
from stemma.operators.incremental import State
from stemma.plans.annotation import HASH_SQL, people
from stemma.plans.identity import STEPS_SQL
from stemma.plans.registry import query, table
from stemma.sources import bibtex_blocks

_ENTRY = "entry AS (SELECT 'f' || (p_size % 5) || '.bib' AS filename, 'p' || key AS bibkey, CASE WHEN key % 7 <> 0 THEN key // 4 END AS refid, hash FROM hashed JOIN people USING (key))"


def people_entries(spark: SparkSession, folder: str) -> DataFrame:
    """The people of parts as entries of five files, some with an id of an earlier run."""
    p = people(spark, folder).withColumn("ref_id", F.when(F.col("key") % 7 != 0, F.floor(F.col("key") / 4)))
    names = [c for c in p.columns if c not in ("key", "p_size")]
    fields = F.map_filter(F.create_map(*[x for c in names for x in (F.lit(c), F.col(c).cast("string"))]), lambda _, v: v.isNotNull())
    return p.select(F.concat(F.lit("f"), F.col("p_size") % 5, F.lit(".bib")).alias("filename"), F.concat(F.lit("p"), "key").alias("bibkey"), F.lit("misc").alias("entrytype"), fields.alias("fields"), "key")


def earlier(entries: DataFrame) -> DataFrame:
    """The same entries before two of the files were edited: titles, years and ids were others, some entries weren't there and some were elsewhere."""
    k, edited = F.col("key"), F.col("filename").isin("f1.bib", "f3.bib")
    put = lambda name, value: F.map_concat(F.map_filter("fields", lambda f, _: f != name), F.create_map(F.lit(name), value))
    old = F.when(k % 11 == 0, put("title", F.lit("plated steel of another age"))).when(k % 11 == 1, put("ref_id", (k % 40).cast("string"))).when(k % 11 == 2, put("year", F.lit("1850"))).otherwise(F.col("fields"))
    file = F.when((k % 13 == 0) & (F.col("filename") == "f1.bib"), F.lit("f3.bib")).otherwise(F.col("filename"))
    return entries.where(~edited | (k % 9 != 0)).withColumn("fields", F.when(edited, old).otherwise(F.col("fields"))).withColumn("filename", file)


@query(f"""WITH {HASH_SQL}, {_ENTRY}, {STEPS_SQL},
src AS (SELECT id, string_agg(DISTINCT split_part(filename, '.bib', 1) || '#' || bibkey, ', ' ORDER BY split_part(filename, '.bib', 1) || '#' || bibkey) AS srctrickle FROM assigned GROUP BY id)
SELECT filename, bibkey, refid, hash, srefid, assigned.id, srctrickle FROM assigned JOIN src USING (id)""")
def incremental_build(spark: SparkSession, folder: str) -> DataFrame:
    """Keys, ids and sources of the records after a build of the earlier state and an update of the two files that were edited."""
    now = people_entries(spark, folder)
    files = spark.createDataFrame([(f"f{k}.bib", k) for k in range(5)], "filename string, priority long")
    state = State(spark, f"{shared_folder(spark)}/state-{uuid.uuid4().hex}", similar=False)
    state.build(earlier(now), files)
    names = files.where(F.col("filename").isin("f1.bib", "f3.bib"))
    state.update(now.where(F.col("filename").isin("f1.bib", "f3.bib")), names, files)
    return state.assigned().join(state.table("records").select("id", F.col("fields")["srctrickle"].alias("srctrickle")), "id")


@query("""SELECT o_orderkey % 2 || '' AS file, 'o' || o_orderkey AS bibkey, 'misc' AS entrytype, 'Order {of} ' || c_name AS title, 'The ' || o_orderkey || ' orders' AS series, CAST(o_custkey AS VARCHAR) AS number,
row_number() OVER (PARTITION BY o_orderkey % 2 ORDER BY o_orderkey) - 1 AS entry_pos FROM orders JOIN customer ON o_custkey = c_custkey""")
def bibtex_in_blocks(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as entries of two BibTeX files with a name for a text at their beginnings, read block by block of 64 KB."""
    o = table(spark, folder, "orders").join(table(spark, folder, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    head = spark.createDataFrame([(str(k), -1, "@string{the = \"The \"}\n@comment{none}\n") for k in range(2)], "file string, place long, value string")
    text = F.format_string("@misc{o%d,\n  title = {Order {of}\n %s},\n  series = the # { %d } # \"orders\",\n  number = %d\n}\n", "o_orderkey", "c_name", "o_orderkey", "o_custkey")
    rows = o.select((F.col("o_orderkey") % 2).cast("string").alias("file"), F.col("o_orderkey").alias("place"), text.alias("value")).unionByName(head)
    at = f"{shared_folder(spark)}/bib-{uuid.uuid4().hex}"
    # A file for each of the two, so that there are large ones; a task writes one.
    rows.repartition(2, "file").sortWithinPartitions("file", "place").select("file", "value").write.partitionBy("file").text(at)
    found = bibtex_blocks.read(spark, f"{at}/file=*", block=1 << 16)
    key = F.col("fields")["title"]
    return found.select((F.substring("bibkey", 2, 20).cast("long") % 2).cast("string").alias("file"), "bibkey", "entrytype", key.alias("title"), F.col("fields")["series"].alias("series"), F.col("fields")["number"].alias("number"), "entry_pos")
