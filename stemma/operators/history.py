"""Identifiers over versions: tables of (filename, bibkey, version, id)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KEY = ["filename", "bibkey"]


def accepted(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows of the versions whose (filename, bibkey) are unique, and the versions that are refused."""
    bad = rows.groupBy("version", *KEY).count().where("count > 1").select("version").distinct()
    return rows.join(bad, "version", "left_anti"), bad


def normalised(rows: DataFrame) -> DataFrame:
    """File names in lower case without ``.bib``."""
    return rows.withColumn("filename", F.regexp_replace(F.lower("filename"), r"\.bib$", ""))


def id_history(rows: DataFrame) -> DataFrame:
    """The ids that an entry had, by the first version of each, for entries with more than one: KEY, history."""
    first = rows.groupBy(*KEY, "id").agg(F.min("version").alias("version"))
    listed = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("version", "id"))), lambda x: F.concat_ws(":", x["version"], x["id"])), ", ")
    return first.groupBy(*KEY).agg(F.count("*").alias("n"), listed.alias("history")).where("n > 1")


def replaced(rows: DataFrame, old, new) -> DataFrame:
    """Ids of version ``old`` that became one other id in version ``new``, for all entries whose id changed."""
    a = rows.where(F.col("version") == old).select(*KEY, F.col("id").alias("id"))
    b = rows.where(F.col("version") == new).select(*KEY, F.col("id").alias("new"))
    changed = a.join(b, KEY).where("id <> new").groupBy("id").agg(F.min("new").alias("replacement"), F.max("new").alias("__other"))
    return changed.where("replacement = __other").drop("__other")


def without_specials(rows: DataFrame, special: str) -> DataFrame:
    """Origins of merged entries one by one (filename, bibkey, id), from ``srctrickle`` and ``id``; rows without id and the special origin go."""
    each = rows.where("id is not null").select("id", F.explode(F.split("srctrickle", ", ")).alias("o"))
    parts = each.select(F.substring_index("o", "#", 1).alias("filename"), F.substring_index("o", "#", -1).alias("bibkey"), "id")
    return parts.where(F.col("filename") != special)


def key_ids(entries: DataFrame, id_field: str) -> DataFrame:
    """bibkey and id of the entries (bibkey, fields) of a file that have a number in ``id_field``."""
    number = F.try_element_at("fields", F.lit(id_field)).try_cast("long")
    return entries.select("bibkey", number.alias("id")).where("id is not null")


def opened(rows: DataFrame, version) -> DataFrame:
    """The intervals of a first version: KEY, id, first, last (versions), open. A row holds while an entry keeps an id from one version to the next."""
    own = rows.where(F.col("version") == version).select(*KEY, "id").distinct()
    return own.select("*", F.lit(version).alias("first"), F.lit(version).alias("last"), F.lit(True).alias("open"))


def with_version(intervals: DataFrame, snapshot: DataFrame, version) -> DataFrame:
    """``intervals`` with one more version, later than all that they have: ``snapshot`` (KEY, id).

    Only the open intervals, as many as the last version has rows, meet the snapshot; closed ones don't move. An entry that
    is missing in a version, or has another id, closes its interval; entries without an id are entries, too. Rows that a
    snapshot repeats count once.
    """
    names = [*KEY, "id"]
    now = snapshot.select(*[F.col(c).alias(f"__{c}") for c in names], F.lit(True).alias("__here")).distinct()
    same = [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in names]
    met = intervals.where("open").join(now, same, "full_outer")
    value, here = F.lit(version).cast(intervals.schema["first"].dataType), F.col("__here").isNotNull()
    own = [F.when(F.col("first").isNull(), F.col(f"__{c}")).otherwise(F.col(c)).alias(c) for c in names]
    after = met.select(*own, F.coalesce("first", value).alias("first"), F.when(here, value).otherwise(F.col("last")).alias("last"), here.alias("open"))
    return intervals.where("not open").select(*after.columns).unionByName(after)


def history_of(intervals: DataFrame) -> DataFrame:
    """``id_history`` from intervals."""
    return id_history(intervals.select(*KEY, "id", F.col("first").alias("version")))


def replaced_by_intervals(intervals: DataFrame, old, new) -> DataFrame:
    """``replaced`` from intervals; entries whose id held over both versions are left out before anything is joined."""
    at = lambda v: (F.col("first") <= F.lit(v)) & (F.col("last") >= F.lit(v))
    changed = intervals.where(at(old) != at(new))
    rows = changed.select(*KEY, "id", F.when(at(old), F.lit(old)).otherwise(F.lit(new)).alias("version"))
    return replaced(rows, old, new)
