"""Merging of records by source priority, with their provenance.

All of it is summed by (record, field, value) before a record's rows meet, so what is shuffled is bounded by the
distinct values of a record, not by the entries that have them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stemma.joins import few
from stemma.model import IGNORE_FIELDS, UNION_FIELDS


def stem(filename: Column) -> Column:
    """A source's name up to its first ``.bib``."""
    return F.substring_index(filename, ".bib", 1)


def with_priority(values: DataFrame, files: DataFrame, overrides: DataFrame | None = None) -> DataFrame:
    """Values with their priority: that of (filename, field), if overridden, else that of the file. Values of unknown files go."""
    out = values.join(few(files.select("filename", "priority")), "filename")
    if overrides is None:
        return out
    own = overrides.select("filename", "field", F.col("priority").alias("__own"))
    return out.join(few(own), ["filename", "field"], "left").withColumn("priority", F.coalesce("__own", "priority")).drop("__own")


def _rank() -> Column:
    return F.struct((-F.col("priority")).alias("p"), "filename", "bibkey")


def first_values(ranked: DataFrame, key: str = "id") -> DataFrame:
    """The value of each field by highest priority, then filename, then bibkey: key, field, value."""
    return ranked.groupBy(key, "field").agg(F.min_by("value", _rank()).alias("value"))


def joined_values(ranked: DataFrame, key: str = "id") -> DataFrame:
    """All distinct values of each field, in order of their first one's rank: key, field, value."""
    distinct = ranked.groupBy(key, "field", "value").agg(F.min(_rank()).alias("rank"))
    in_order = F.transform(F.array_sort(F.collect_list(F.struct("rank", "value"))), lambda x: x["value"])
    return distinct.groupBy(key, "field").agg(F.array_join(in_order, ", ").alias("value"))


def provenance(values: DataFrame, key: str = "id") -> DataFrame:
    """src, the sorted sources of a record, and srctrickle, its sorted entries."""
    one = values.select(key, stem(F.col("filename")).alias("s"), "bibkey").distinct()
    listed = lambda c: F.array_join(F.array_sort(F.collect_set(c)), ", ")
    return one.groupBy(key).agg(listed(F.col("s")).alias("src"), listed(F.concat_ws("#", "s", "bibkey")).alias("srctrickle"))


def merged(values: DataFrame, files: DataFrame, key: str = "id", overrides: DataFrame | None = None, union: list[str] = UNION_FIELDS, ignore: list[str] = IGNORE_FIELDS) -> DataFrame:
    """Records: key, entrytype and fields (a map with src and srctrickle). Provenance counts ignored fields, too."""
    ranked = with_priority(values, files, overrides)
    shown = ranked.where(~F.col("field").isin(ignore))
    fields = first_values(shown.where(~F.col("field").isin(union)), key).unionByName(joined_values(shown.where(F.col("field").isin(union)), key))
    maps = fields.groupBy(key).agg(F.map_from_entries(F.collect_list(F.struct("field", "value"))).alias("m"))
    own = provenance(ranked, key).join(maps, key, "left")
    m = F.coalesce("m", F.create_map().cast("map<string,string>"))
    kept = F.map_filter(m, lambda k, _: ~k.isin("ENTRYTYPE", "src", "srctrickle"))
    return own.select(key, F.try_element_at(m, F.lit("ENTRYTYPE")).alias("entrytype"), F.map_concat(kept, F.create_map(F.lit("src"), "src", F.lit("srctrickle"), "srctrickle")).alias("fields"))


def conflicts(values: DataFrame, files: DataFrame, key: str = "id", union: list[str] = UNION_FIELDS) -> DataFrame:
    """The first value of each field against each later one that differs by more than case."""
    ranked = with_priority(values, files).where(~F.col("field").isin(union))
    first = ranked.groupBy(key, "field").agg(F.min(F.struct((-F.col("priority")).alias("p"), "filename", "bibkey", "value")).alias("f"))
    both = ranked.join(first, [key, "field"]).where((F.col("filename") != F.col("f.filename")) | (F.col("bibkey") != F.col("f.bibkey")))
    both = both.where(F.lower("value") != F.lower("f.value"))
    return both.select(key, "field", F.col("f.filename").alias("file1"), F.col("f.bibkey").alias("bibkey1"), F.col("filename").alias("file2"), F.col("bibkey").alias("bibkey2"), F.col("f.value").alias("value1"), F.col("value").alias("value2"))


def conflict_matrix(found: DataFrame) -> DataFrame:
    """How many conflicts two different files have."""
    return found.where("file1 <> file2").groupBy("file1", "file2").agg(F.count("*").alias("n"))
