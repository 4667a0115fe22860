"""Queries on files that are written in a source's form and read again by its reader."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stemma.lineage import shared_folder
from stemma.plans.registry import query, table
from stemma.sources import files, sinks

_LANGUOIDS = """l AS (SELECT c_name AS name, printf('%04x', c_custkey // 10000) || lpad(CAST(c_custkey % 10000 AS VARCHAR), 4, '0') AS id, CASE WHEN c_custkey % 3 = 0 THEN 'abc' ELSE '' END AS iso,
CASE WHEN c_custkey % 5 = 0 THEN 'spoken' ELSE '' END AS status, CASE WHEN c_nationkey > 0 THEN r_name || ' [regi000' || r_regionkey || '], ' || n_name || ' [nati' || lpad(CAST(n_nationkey AS VARCHAR), 4, '0') || ']' END AS lineage
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""


def languoids(spark: SparkSession, folder: str) -> DataFrame:
    """Customers as languoids under their region and nation; those of one nation are isolates."""
    n = table(spark, folder, "nation").join(F.broadcast(table(spark, folder, "region")), F.col("n_regionkey") == F.col("r_regionkey"))
    step = lambda name, kind, key: F.struct(F.col(name).alias("name"), F.concat(F.lit(kind), F.lpad(F.col(key).cast("string"), 4, "0")).alias("id"), F.lit("family").alias("level"))
    path = F.array(step("r_name", "regi", "r_regionkey"), step("n_name", "nati", "n_nationkey"))
    c, k = table(spark, folder, "customer").join(F.broadcast(n.select("n_nationkey", path.alias("path"))), F.col("c_nationkey") == F.col("n_nationkey")), F.col("c_custkey")
    code = F.format_string("%04x%04d", F.floor(k / 10_000), k % 10_000)
    lineage = F.when(F.col("c_nationkey") > 0, F.col("path")).otherwise(F.slice("path", 1, 0))
    return c.select(F.col("c_name").alias("name"), code.alias("id"), F.when(k % 3 == 0, "abc").alias("iso"), F.when(k % 5 == 0, "spoken").alias("status"), F.lit("language").alias("level"), lineage.alias("lineage"))


@query(f"""WITH {_LANGUOIDS}, g AS (SELECT coalesce(lineage, name || ' [-isolate-]') AS "group", * FROM l)
SELECT 'language' AS level, "group", 0 AS place, "group" AS value FROM g GROUP BY "group"
UNION ALL SELECT 'language', "group", 1, '    ' || name || ' [' || id || '][' || iso || ']' || CASE WHEN status <> '' THEN ' ' || status ELSE '' END FROM g""")
def languoid_lines(spark: SparkSession, folder: str) -> DataFrame:
    """The lines of a flat file, headings before their members."""
    return sinks.flat_languoids(languoids(spark, folder))


@query(f"WITH {_LANGUOIDS} SELECT name, id, iso, status, coalesce(lineage, '') AS lineage FROM l")
def languoid_file(spark: SparkSession, folder: str) -> DataFrame:
    """Languoids as they are after they were written as one flat file and read again."""
    at = f"{shared_folder(spark)}/flat-{uuid.uuid4().hex}"
    lines = sinks.flat_languoids(languoids(spark, folder))
    # It is one file by its form, so one task writes it.
    lines.repartition(1).sortWithinPartitions("level", "group", "place", "value").select("value").write.text(at)
    found = files.flat_languoids(files.whole(spark, f"{at}/part-*"), "language")
    return found.select("name", "id", "iso", "status", F.array_join(F.transform("lineage", lambda x: F.format_string("%s [%s]", x["name"], x["id"])), ", ").alias("lineage"))


@query("SELECT r_name || ', ' || n_name AS path, c_name AS name, CAST(c_custkey AS VARCHAR) AS code FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey")
def path_file(spark: SparkSession, folder: str) -> DataFrame:
    """Members of a classification as they are after it was written as one file of paths and members and read again."""
    n = table(spark, folder, "nation").join(F.broadcast(table(spark, folder, "region")), F.col("n_regionkey") == F.col("r_regionkey"))
    own = table(spark, folder, "customer").join(F.broadcast(n), F.col("c_nationkey") == F.col("n_nationkey")).select(F.concat_ws(", ", "r_name", "n_name").alias("path"), F.format_string("   %s [%s]", "c_name", "c_custkey").alias("value"))
    lines = own.select("path", F.lit(1).alias("place"), "value").unionByName(own.select("path").distinct().select("path", F.lit(0).alias("place"), F.col("path").alias("value")))
    at = f"{shared_folder(spark)}/paths-{uuid.uuid4().hex}"
    lines.repartition(1).sortWithinPartitions("path", "place", "value").select("value").write.text(at)
    return files.path_members(files.whole(spark, f"{at}/part-*")).select(F.array_join("path", ", ").alias("path"), "name", "code")


@query("""SELECT p_partkey AS key, lower(p_brand) AS brand, CAST(p_size + 0.5 AS DOUBLE) AS latitude, CAST(-1.25 * p_size AS DOUBLE) AS longitude, 'a ' || p_type || '|b' AS names, 'Here|There ' || p_size AS location, p_name AS comments FROM part""")
def record_texts(spark: SparkSession, folder: str) -> DataFrame:
    """Parts as texts of keyed records, four newlines between two, read and typed."""
    p = table(spark, folder, "part")
    text = F.format_string("Name: %s\nBrand: %s\nCoordinates: (%s, %s)\nAlternate Names: a %s, b\nLocations: Here. There %s\nno pair\nComments: %s\n\n\n\nName: none", F.col("p_partkey").cast("string"), F.lower("p_brand"), (F.col("p_size") + 0.5).cast("string"), (F.col("p_size") * -1.25).cast("string"), "p_type", F.col("p_size").cast("string"), "p_name")
    found = files.keyed_records(p.select(F.lit("parts").alias("filename"), text.alias("text"))).where("record_no = 0")
    typed = found.select(F.col("fields")["name"].cast("long").alias("key"), F.col("fields")["brand"].alias("brand"), *files.typed_record(F.col("fields")))
    joined = lambda c: F.array_join(c, "|")
    return typed.select("key", "brand", "coordinates.latitude", "coordinates.longitude", joined("alternate_names").alias("names"), joined("location").alias("location"), joined("comments").alias("comments"))


@query("""SELECT CAST(o_orderkey AS VARCHAR) AS key, 'say "' || o_orderpriority || '", ' || chr(10) || 'then; ' || o_orderstatus AS text FROM orders""")
def delimited_file(spark: SparkSession, folder: str) -> DataFrame:
    """Rows with quotes, commas and line breaks in them as they are after they were written as CSV and read with their header checked."""
    rows = table(spark, folder, "orders").select(F.col("o_orderkey").cast("string").alias("key"), F.format_string('say "%s", \nthen; %s', "o_orderpriority", "o_orderstatus").alias("text"))
    at = f"{shared_folder(spark)}/csv-{uuid.uuid4().hex}"
    sinks.delimited(rows, at, ",", ["key"])
    return files.delimited(spark, at, ["key", "text"])
