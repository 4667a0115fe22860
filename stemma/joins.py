"""Joins by keys of which one may have a large part of all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Most rows and bytes of a table that is sent to all executors.
FEW_ROWS, FEW_BYTES = 500_000, 32 << 20
#: A key with more rows than this, or than one HOT_KEYS-th of all if that is more, is hot; so there are HOT_KEYS hot keys at most.
HOT_ROWS, HOT_KEYS = 1_000, 512


def private(df: DataFrame, name: str) -> str:
    """A column name that ``df`` doesn't have."""
    taken, out = {c.lower() for c in df.columns}, f"__{name}"
    while out in taken:
        out = f"_{out}"
    return out


def keyed(left: DataFrame, right: DataFrame, key: list[str], size: str, rows: int, how: str = "inner") -> DataFrame:
    """Join ``left`` with ``right`` by ``key``, without bringing the rows of a hot key into one task.

    ``right`` has one row for each key, never null, and in ``size`` the count of the key's rows in a table of ``rows``
    rows. The rows of hot keys are sent to all executors, HOT_KEYS at most, as their sizes sum to no more than ``rows``;
    only the others are shuffled. ``left`` is read twice. ``how`` is inner or left.
    """
    limit = max(HOT_ROWS, rows // HOT_KEYS)
    hot, rest = private(left, "hot"), [c for c in right.columns if c not in key]
    head = F.broadcast(right.where(F.col(size) > limit).select(*key, F.struct(*rest).alias(hot)))
    told = left.join(head, key, "left")
    first = told.where(F.col(hot).isNotNull()).select(*left.columns, f"{hot}.*")
    second = told.where(F.col(hot).isNull()).drop(hot).join(right.where(F.col(size) <= limit), key, how)
    return first.unionByName(second.select(*left.columns, *rest))


def told(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Left join by ``key``; rows with a null key, which meet nothing, are not shuffled with it."""
    rest = [F.lit(None).cast(f.dataType).alias(f.name) for f in right.schema.fields if f.name != key]
    known = left.where(F.col(key).isNotNull()).join(right, key, "left")
    return known.unionByName(left.where(F.col(key).isNull()).select("*", *rest))


def few(keys: DataFrame) -> DataFrame:
    """``keys``, marked to be sent to all executors if their counted rows and bytes are within bounds; beyond them they are shuffled.

    It reads ``keys`` once more, so they should be cut.
    """
    size = sum((F.coalesce(F.length(F.col(c).cast("string").cast("binary")), F.lit(0)) + 16 for c, kind in keys.dtypes if not kind.startswith(("array", "map", "struct"))), F.lit(0))
    rows, size = keys.agg(F.count("*"), F.coalesce(F.sum(size), F.lit(0))).first()
    return F.broadcast(keys) if rows <= FEW_ROWS and size <= FEW_BYTES else keys
