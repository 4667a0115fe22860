"""Comparison of two versions of the same entries, and freshness of sources."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stemma.functions import names


def differences(left: DataFrame, right: DataFrame, key: list[str], value: str) -> DataFrame:
    """Keys that only one side has, and keys whose values differ: key, side, left, right."""
    a = left.select(*key, F.col(value).alias("left"), F.lit(True).alias("__a"))
    b = right.select(*key, F.col(value).alias("right"), F.lit(True).alias("__b"))
    j = a.join(b, key, "full_outer")
    side = F.when(F.col("__b").isNull(), "left only").when(F.col("__a").isNull(), "right only").when(~F.col("left").eqNullSafe(F.col("right")), "differ")
    return j.withColumn("side", side).where("side is not null").select(*key, "side", "left", "right")


def equal(left: DataFrame, right: DataFrame) -> bool:
    """Have both the same rows, as often?"""
    return left.exceptAll(right).isEmpty() and right.exceptAll(left).isEmpty()


def stale(manifest: DataFrame, found: DataFrame) -> DataFrame:
    """Files whose name, size or time isn't that of the manifest."""
    a, b = manifest.select("name", F.struct("size", "mtime").alias("v")), found.select("name", F.struct("size", "mtime").alias("v"))
    return differences(a, b, ["name"], "v").select("name", "side")


_READ = T.ArrayType(T.StructType().add("last", "string").add("first", "string"))


@F.pandas_udf(_READ)
def _by_forms(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: None if t is None else [(a["lastname"], a.get("firstname", "")) for a in names.authors(t)])


@F.pandas_udf(_READ)
def _by_rules(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: None if t is None else [(" ".join(x for x in (n.prelast, n.last) if x), n.given) for n in names.bibtex_names(t)])


def name_readings(rows: DataFrame, key: list[str], text: str) -> DataFrame:
    """Lists of names that the two name readers part differently: key, text, by_forms, by_rules (last and first names). Null lists don't differ."""
    read = rows.select(*key, F.col(text).alias("text"), _by_forms(text).alias("by_forms"), _by_rules(text).alias("by_rules"))
    return read.where(~F.col("by_forms").eqNullSafe(F.col("by_rules")))
