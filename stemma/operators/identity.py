"""Stable identifiers: how groups split and merged since an earlier run, and which id each entry gets.

Entries have ``hash`` (the match key now), ``refid`` (the id of the earlier run or null).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stemma.joins import told
from stemma.lineage import cut

KEY = ["filename", "bibkey"]


def _flag(entries: DataFrame, key: str, cond: Column) -> DataFrame:
    """Rows whose group by ``key`` meets a condition on aggregates; the groups are summed before the rows join them."""
    groups = entries.where(F.col(key).isNotNull()).groupBy(key).agg(cond.alias("__yes")).where("__yes").select(key)
    return entries.join(groups, key, "left_semi").select(*entries.columns)


def splits(entries: DataFrame) -> DataFrame:
    """Entries of one earlier id with more than one hash."""
    return _flag(entries, "refid", F.min("hash") != F.max("hash"))


def merges(entries: DataFrame, ref: str = "refid") -> DataFrame:
    """Entries of one hash with more than one earlier id, as far as they have one."""
    return _flag(entries.where(F.col(ref).isNotNull()), "hash", F.min(ref) != F.max(ref))


def identified(entries: DataFrame) -> DataFrame:
    """Entries of hashes that have both rows with and rows without an earlier id."""
    return _flag(entries, "hash", (F.count("refid") > 0) & (F.count("refid") < F.count("*")))


def combined(entries: DataFrame) -> DataFrame:
    """Entries without an earlier id that share a hash with another one without."""
    return _flag(entries.where("refid is null"), "hash", F.count("*") > 1)


def one_to_one_violations(entries: DataFrame) -> DataFrame:
    """Hashes with several ids and ids with several hashes: kind, key, n. An OR of two joins, as two aggregates."""
    by = lambda kind, a, b: entries.where(F.col(a).isNotNull()).groupBy(F.col(a).cast("string").alias("key")).agg(F.countDistinct(b).alias("n")).where("n > 1").select(F.lit(kind).alias("kind"), "key", "n")
    return by("hash", "hash", "id").unionByName(by("id", "id", "hash"))


def numbered_by(values: DataFrame, column: str, first: int, partitions: int = 0) -> DataFrame:
    """Distinct ``column`` with ``number``: consecutive from ``first`` in order, numbered by ranges, not in one task."""
    distinct = values.select(column).distinct()
    ranged = distinct.repartitionByRange(partitions, column) if partitions else distinct.repartitionByRange(column)
    ranged = ranged.sortWithinPartitions(column).withColumn("__at", F.monotonically_increasing_id())
    # Read twice, so it is cut: both readings must have the same ranges.
    ranged = cut(ranged).withColumn("__part", F.shiftright("__at", 33)).withColumn("__place", F.col("__at").bitwiseAND(F.lit((1 << 33) - 1)))
    # Counts by range are as few as the ranges, so their running sum is a small window.
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = ranged.groupBy("__part").agg(F.count("*").alias("__n")).withColumn("__before", F.coalesce(F.sum("__n").over(before), F.lit(0)))
    return ranged.join(F.broadcast(sizes), "__part").select(column, (F.col("__before") + F.col("__place") + F.lit(first)).cast("long").alias("number"))


Pick = Callable[[DataFrame], DataFrame]


def least_hash(pairs: DataFrame) -> DataFrame:
    """Of the hashes of a split id, the smallest stays: the tie rule alone."""
    return pairs.groupBy("refid").agg(F.min("hash").alias("hash"))


def largest_ref(pairs: DataFrame) -> DataFrame:
    """Of the ids of a merged hash, the largest stays: the tie rule alone."""
    return pairs.groupBy("hash").agg(F.max("srefid").alias("srefid"))


def separated(entries: DataFrame, pick_hash: Pick = least_hash) -> DataFrame:
    """Step 1 of ``assign_ids``: entries with ``srefid``, the earlier id that is left to them."""
    pairs = cut(splits(entries).select("refid", "hash").distinct())
    chosen = pick_hash(pairs).select("refid", F.col("hash").alias("__stays"))
    e = told(entries.select(*KEY, "refid", "hash"), chosen, "refid")
    return e.withColumn("srefid", F.when(F.col("__stays").isNull() | (F.col("hash") == F.col("__stays")), F.col("refid"))).drop("__stays")


def settled(e: DataFrame, pick_ref: Pick = largest_ref) -> DataFrame:
    """Steps 2 to 4 of ``assign_ids`` for separated entries, which are read twice: with ``id``, and ``fresh`` where the hash gets a new number."""
    left = cut(merges(e, "srefid").select("hash", "srefid").distinct())
    stays = pick_ref(left).select("hash", F.col("srefid").alias("__stays"))
    e = told(e, stays, "hash")
    e = cut(e.withColumn("id", F.when(F.col("srefid").isNotNull(), F.coalesce("__stays", "srefid"))).drop("__stays"))
    groups = e.where("hash is not null").groupBy("hash").agg(F.max("id").alias("__known"), F.count_if(F.col("id").isNull() & F.col("refid").isNotNull()).alias("__apart"))
    e = told(e, groups, "hash").withColumn("fresh", F.col("hash").isNotNull() & ((F.col("__apart") > 0) | F.col("__known").isNull()))
    return e.select(*KEY, "refid", "hash", "srefid", F.when(~F.col("fresh"), F.coalesce("id", "__known")).alias("id"), "fresh")


def assign_ids(entries: DataFrame, pick_hash: Pick = least_hash, pick_ref: Pick = largest_ref) -> DataFrame:
    """Entries with ``srefid`` and ``id``, by set equations over the groups.

    1. An earlier id with several hashes keeps the hash that ``pick_hash`` chooses of (refid, hash); rows of the others
    are separated. 2. A hash with several ids left keeps the one that ``pick_ref`` chooses of (hash, srefid); rows with
    another get it. 3. Rows with a srefid keep it. 4. Rows without any earlier id get the id of their hash, if it has
    one. 5. Each hash with a row that still has no id, as separated rows of step 1 have, gets a new number for all its
    rows, in order of the hashes, after the largest earlier id.

    Rows without a hash match nothing, not even one another: they keep what step 1 leaves of their earlier id, or get none.
    """
    e = cut(settled(cut(separated(entries, pick_hash)), pick_ref))
    return renumbered(e, entries.agg(F.coalesce(F.max("refid"), F.lit(0)) + 1).first()[0]).drop("fresh")


def renumbered(e: DataFrame, first: int) -> DataFrame:
    """Settled entries, which are read twice, with the numbers of their fresh hashes from ``first`` on, in order of the hashes."""
    new = numbered_by(e.where("fresh"), "hash", first)
    fresh = e.where("fresh").join(new, "hash").withColumn("id", F.col("number")).select(*e.columns)
    return e.where("not fresh").unionByName(fresh)


def replacements(assigned: DataFrame) -> DataFrame:
    """Earlier ids and the ids that took their place; rows without an earlier id drop out."""
    return assigned.where("id <> refid").select(F.col("refid").alias("id"), F.col("id").alias("replacement")).orderBy("id", "replacement")


def changed_files(assigned: DataFrame) -> DataFrame:
    """For each file with a changed id: how many ids are added and how many changed."""
    changed = assigned.where(~F.col("id").eqNullSafe(F.col("refid")))
    return changed.groupBy("filename").agg(F.count_if(F.col("refid").isNull()).alias("added"), F.count_if(F.col("refid").isNotNull()).alias("changed"))
