"""Languoids: sources joined by code, records enriched, and the flat form of a classification."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stemma.joins import few

TOLERANCE = 0.001


def full_join(sources: list[DataFrame], key: str) -> DataFrame:
    """All sources by ``key``, each row of any of them; keys are unique in each source."""
    return reduce(lambda a, b: a.join(b, key, "full_outer"), sources)


def enriched(records: DataFrame, other: DataFrame, key: str, columns: list[str], suffix: str = "-gl") -> DataFrame:
    """Records with the other source's values beside them where they differ, and in their place where they are missing.

    ``note`` says which records the other source doesn't have.
    """
    b = other.select(key, *[F.col(c).alias(f"__{c}") for c in columns], F.lit(True).alias("__there"))
    j = records.join(b, key, "left")
    out = [F.when(F.col(c).isNull(), F.col(f"__{c}")).otherwise(F.col(c)).alias(c) for c in columns]
    differ = [F.when(F.col(c).isNotNull() & F.col(f"__{c}").isNotNull() & (F.col(c) != F.col(f"__{c}")), F.col(f"__{c}")).alias(f"{c}{suffix}") for c in columns]
    rest = [c for c in records.columns if c not in columns]
    return j.select(*rest, *out, *differ, F.when(F.col("__there").isNull(), F.lit("not in other source")).alias("note"))


def far_apart(records: DataFrame, other: DataFrame, key: str, columns: list[str], tolerance: float = TOLERANCE) -> DataFrame:
    """Records whose coordinates differ from the other source's by more than the tolerance."""
    a, b = records.select(key, *columns), other.select(key, *[F.col(c).alias(f"{c}_other") for c in columns])
    apart = [F.abs(F.col(c) - F.col(f"{c}_other")) > tolerance for c in columns]
    return a.join(b, key).where(reduce(lambda x, y: x | y, apart))


def equal_sets(a: Column, b: Column) -> Column:
    """Are two lists equal as sets, remarks in brackets aside?"""
    bare = lambda x: F.array_sort(F.array_distinct(F.transform(x, lambda v: F.trim(F.regexp_replace(v, r"\s*\[[^\]]*\]$", "")))))
    return bare(a) == bare(b)


def lineage_by_code(classification: DataFrame, names: DataFrame) -> DataFrame:
    """hid and the names of its ancestors, farthest first, from arrays of keys that begin with the own one."""
    each = classification.select("hid", F.posexplode("pks").alias("i", "pk")).where("i > 0").join(few(names), "pk")
    return each.groupBy("hid").agg(F.transform(F.reverse(F.array_sort(F.collect_list(F.struct("i", "name")))), lambda x: x["name"]).alias("lineage"))


def group_heading(level: Column, name: Column, lineage: Column) -> Column:
    """The heading of a languoid in the flat form: ``Name [id]`` of its ancestors, for dialects those after the families."""
    shown = F.when(level == "dialect", F.filter(lineage, lambda x: x["level"] != "family")).otherwise(lineage)
    return F.when(F.size(shown) > 0, F.array_join(F.transform(shown, lambda x: F.format_string("%s [%s]", x["name"], x["id"])), ", ")).otherwise(F.concat(name, F.lit(" [-isolate-]")))


def language_line(name: Column, code: Column, iso: Column, status: Column) -> Column:
    """A languoid's line in the flat form."""
    ending = F.when(status.isNotNull() & (status != ""), F.concat(F.lit(" "), status)).otherwise(F.lit(""))
    return F.concat(F.lit("    "), name, F.lit(" ["), code, F.lit("]["), F.coalesce(iso, F.lit("")), F.lit("]"), ending)


def parsed_line(line: Column) -> Column:
    """struct(name, id, iso, status) of such a line."""
    at = lambda k: F.regexp_extract(line, r"^\s*(.*?) \[([a-z0-9]{4}[0-9]{4})\]\[([^\]]*)\]\s*(.*)$", k)
    return F.struct(at(1).alias("name"), at(2).alias("id"), at(3).alias("iso"), at(4).alias("status"))


def parsed_path(line: Column) -> Column:
    """Array of struct(name, id) of a heading."""
    return F.transform(F.split(F.trim(line), r"(?<=\]), "), lambda x: F.struct(F.regexp_extract(x, r"^(.*?) \[([^\]]+)\]$", 1).alias("name"), F.regexp_extract(x, r"^(.*?) \[([^\]]+)\]$", 2).alias("id")))


def line_errors(flat: DataFrame, known: DataFrame) -> DataFrame:
    """Lines whose id is unknown or whose level differs from the known one: id, problem."""
    k = known.select(F.col("id").alias("__id"), F.col("level").alias("__level"))
    j = flat.join(k, flat["id"] == F.col("__id"), "left")
    return j.select("id", F.when(F.col("__id").isNull(), "unknown id").when(F.col("level") != F.col("__level"), "other level").alias("problem")).where("problem is not null")


def full_lineages(dialects: DataFrame, languages: DataFrame) -> DataFrame:
    """``dialects``, whose lineage begins with their language, with the lineage of that language (``languages``: id, lineage) put before it.

    Dialects without a lineage are attached to nothing and left out; one whose language isn't there raises. Of languages
    that repeat an id, the one of the largest lineage counts.
    """
    own = languages.groupBy(F.col("id").alias("__language")).agg(F.max("lineage").alias("__before"))
    told = dialects.where(F.size("lineage") > 0).join(own, F.get("lineage", F.lit(0))["id"] == F.col("__language"), "left")
    before = F.when(F.col("__language").isNull(), F.raise_error(F.concat(F.lit("no language of dialect "), "id"))).otherwise(F.col("__before"))
    return told.withColumn("lineage", F.concat(before, "lineage")).select(*dialects.columns)
