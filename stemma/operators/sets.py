"""Sets of keys as DataFrames of one or more key columns."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def intersection(sets: list[DataFrame], key: list[str]) -> DataFrame:
    """Keys that are in all sets; a chain of semi joins from the first."""
    return reduce(lambda a, b: a.join(b.select(*key), key, "left_semi"), sets[1:], sets[0].select(*key).distinct())


def complement(every: DataFrame, some: DataFrame, key: list[str]) -> DataFrame:
    return every.select(*key).distinct().join(some.select(*key), key, "left_anti")


def symmetric_difference(left: DataFrame, right: DataFrame, key: list[str]) -> DataFrame:
    """Keys that are on one side only, with that side."""
    a, b = left.select(*key).distinct().withColumn("__a", F.lit(True)), right.select(*key).distinct().withColumn("__b", F.lit(True))
    j = a.join(b, key, "full_outer").where("__a is null or __b is null")
    return j.select(*key, F.when(F.col("__a"), "left").otherwise("right").alias("side"))


def grouped_values(pairs: DataFrame, key: str, value: str) -> DataFrame:
    """Each key with its distinct values in order."""
    return pairs.select(key, value).distinct().groupBy(key).agg(F.array_sort(F.collect_list(value)).alias("values"))


def nested_counts(pairs: DataFrame, key: str, value: str) -> DataFrame:
    """Each key with how often it has each value, as rows; ``as_maps`` makes a map of them."""
    return pairs.groupBy(key, value).agg(F.count("*").alias("n"))


def as_maps(counts: DataFrame, key: str, value: str) -> DataFrame:
    return counts.groupBy(key).agg(F.map_from_entries(F.collect_list(F.struct(value, "n"))).alias("counts"))
