"""The data model: entries as (filename, bibkey) with fields, their long form, and views of the driver's tables in that form."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stemma.plans.registry import table

#: Fields whose distinct values are all kept when records merge, and fields left out of merged records. Fixed values.
UNION_FIELDS = ["fn", "asjp_name", "isbn"]
IGNORE_FIELDS = ["crossref", "numnote", "glotto_id"]

ENTRY = T.StructType().add("filename", "string").add("bibkey", "string").add("entrytype", "string").add("fields", T.MapType(T.StringType(), T.StringType()))
#: Reads as SQL what ``values_of`` reads as a DataFrame; ``files`` are their priorities.
EAV_SQL = """eav AS (
  SELECT 'customer.bib' AS filename, 'c' || c_custkey AS bibkey, c_custkey % 100 AS id,
         unnest(['ENTRYTYPE', 'title', 'year', 'publisher', 'isbn']) AS field,
         unnest(['book', c_name, CAST(c_nationkey AS VARCHAR), c_mktsegment, c_mktsegment]) AS value FROM customer
  UNION ALL
  SELECT 'supplier.bib', 's' || s_suppkey, s_suppkey % 100,
         unnest(['ENTRYTYPE', 'title', 'year', 'isbn']),
         unnest(['misc', s_name, CAST(s_nationkey AS VARCHAR), 'N' || s_nationkey]) FROM supplier),
files(filename, priority) AS (VALUES ('customer.bib', 0), ('supplier.bib', 10))"""
#: The same for ``part_entries``.
ENTRIES_SQL = """entry AS (
  SELECT 'f' || (p_size % 5) || '.bib' AS filename, 'p' || p_partkey AS bibkey,
         CASE WHEN p_partkey % 7 = 0 THEN NULL ELSE p_partkey // 4 END AS refid,
         p_name || '|' || p_brand || '|' || p_type AS hash FROM part)"""


def long_form(df: DataFrame, filename: str, bibkey: Column, id_: Column, fields: dict[str, Column]) -> DataFrame:
    """One row for each field that isn't null: filename, bibkey, id, field, value."""
    pairs = F.explode(F.map_filter(F.create_map(*[x for k, v in fields.items() for x in (F.lit(k), v.cast("string"))]), lambda _, v: v.isNotNull()))
    return df.select(F.lit(filename).alias("filename"), bibkey.alias("bibkey"), id_.alias("id"), pairs.alias("field", "value"))


def wide_form(values: DataFrame) -> DataFrame:
    """Entries from their long form; the entry type is the field ENTRYTYPE."""
    fields = F.map_from_entries(F.collect_list(F.struct("field", "value")))
    wide = values.groupBy("filename", "bibkey").agg(fields.alias("fields"))
    return wide.select("filename", "bibkey", F.try_element_at("fields", F.lit("ENTRYTYPE")).alias("entrytype"), F.map_filter("fields", lambda k, _: k != "ENTRYTYPE").alias("fields"))


def values_of(spark: SparkSession, folder: str) -> DataFrame:
    """customer and supplier as two sources; entries with the same key modulo 100 are one record."""
    c, s = table(spark, folder, "customer"), table(spark, folder, "supplier")
    a = long_form(c, "customer.bib", F.concat(F.lit("c"), "c_custkey"), F.col("c_custkey") % 100, {"ENTRYTYPE": F.lit("book"), "title": F.col("c_name"), "year": F.col("c_nationkey"), "publisher": F.col("c_mktsegment"), "isbn": F.col("c_mktsegment")})
    b = long_form(s, "supplier.bib", F.concat(F.lit("s"), "s_suppkey"), F.col("s_suppkey") % 100, {"ENTRYTYPE": F.lit("misc"), "title": F.col("s_name"), "year": F.col("s_nationkey"), "isbn": F.concat(F.lit("N"), "s_nationkey")})
    return a.unionByName(b)


def files_of(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([("customer.bib", 0), ("supplier.bib", 10)], "filename string, priority long")


def part_entries(spark: SparkSession, folder: str) -> DataFrame:
    """part as entries with an id of an earlier run (refid) and a match key (hash)."""
    p = table(spark, folder, "part")
    refid = F.when(F.col("p_partkey") % 7 != 0, F.floor(F.col("p_partkey") / 4).cast("long"))
    return p.select(F.concat(F.lit("f"), F.col("p_size") % 5, F.lit(".bib")).alias("filename"), F.concat(F.lit("p"), "p_partkey").alias("bibkey"), refid.alias("refid"), F.concat_ws("|", "p_name", "p_brand", "p_type").alias("hash"))
