"""Queries on sets of keys and single entries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stemma.model import EAV_SQL, values_of
from stemma.operators import sets
from stemma.plans.registry import query, table
from stemma.sources import files


def _nations(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    n = table(spark, folder, "nation").select(F.col("n_nationkey").alias("key"))
    c = table(spark, folder, "customer").where("c_acctbal < 0").select(F.col("c_nationkey").alias("key"))
    s = table(spark, folder, "supplier").where("s_acctbal < 0").select(F.col("s_nationkey").alias("key"))
    return n, c, s


_C, _S = "SELECT c_nationkey AS key FROM customer WHERE c_acctbal < 0", "SELECT s_nationkey AS key FROM supplier WHERE s_acctbal < 0"


@query(f"SELECT n_nationkey AS key FROM nation INTERSECT {_C} INTERSECT {_S}")
def set_intersection(spark: SparkSession, folder: str) -> DataFrame:
    return sets.intersection(list(_nations(spark, folder)), ["key"])


@query(f"SELECT n_nationkey AS key FROM nation EXCEPT {_S}")
def set_complement(spark: SparkSession, folder: str) -> DataFrame:
    n, _, s = _nations(spark, folder)
    return sets.complement(n, s, ["key"])


@query(f"SELECT key, 'left' AS side FROM ({_C} EXCEPT {_S}) UNION ALL SELECT key, 'right' FROM ({_S} EXCEPT {_C})")
def set_difference(spark: SparkSession, folder: str) -> DataFrame:
    _, c, s = _nations(spark, folder)
    return sets.symmetric_difference(c, s, ["key"])


@query("SELECT p_brand AS brand, string_agg(DISTINCT p_type, ',' ORDER BY p_type) AS types FROM part GROUP BY p_brand")
def grouped_values(spark: SparkSession, folder: str) -> DataFrame:
    pairs = table(spark, folder, "part").select(F.col("p_brand").alias("brand"), F.col("p_type").alias("type"))
    return sets.grouped_values(pairs, "brand", "type").select("brand", F.array_join("values", ",").alias("types"))


@query("SELECT p_brand AS brand, p_type AS type, count(*) AS n FROM part GROUP BY ALL")
def nested_counts(spark: SparkSession, folder: str) -> DataFrame:
    pairs = table(spark, folder, "part").select(F.col("p_brand").alias("brand"), F.col("p_type").alias("type"))
    return sets.nested_counts(pairs, "brand", "type")


@query(f"WITH {EAV_SQL} SELECT field, value FROM eav WHERE filename = 'customer.bib' AND bibkey = 'c7'")
def raw_entry(spark: SparkSession, folder: str) -> DataFrame:
    """One entry by its key."""
    c = values_of(spark, folder).where((F.col("filename") == "customer.bib") & (F.col("bibkey") == "c7"))
    return c.select("field", "value")


@query("SELECT user_id, event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS r FROM events) WHERE r = 1")
def last_by_key(spark: SparkSession, folder: str) -> DataFrame:
    """The last row of each key."""
    e = table(spark, folder, "events").select("user_id", "event_id", "event_type")
    return files.last_by_key(e, "user_id", "event_id")
