"""References in comments: what they point to, which are unknown, and their translation to ids."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stemma.functions.text import REFERENCE, reference_keys
from stemma.joins import private
from stemma.lineage import cut


def extracted(rows: DataFrame, key: str, text: str) -> DataFrame:
    """key, place, ref, pages of each reference."""
    return rows.select(key, F.posexplode(reference_keys(F.col(text))).alias("place", "x")).select(key, "place", F.col("x.key").alias("ref"), F.col("x.pages").alias("pages"))


def unknown(found: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """References to none of the known keys (``ref``), each once."""
    return found.join(known.select("ref"), "ref", "left_anti").select(key, "ref").distinct()


def translated(rows: DataFrame, text: str, ids: DataFrame, strict: bool = False) -> DataFrame:
    """``rows`` with ids in place of the keys of the references in their ``text`` column (``ids``: ref, id, each ref once).

    Unknown keys stay, or raise if ``strict``. Null texts stay null, and equal rows stay as many as they are. The
    references meet the ids by a join, and are put back between the pieces of the text in their order.
    """
    row, ref, found = (private(rows, x) for x in ("row", "ref", "ids"))
    # Cut, as a row's number must be the same wherever it is read.
    own = cut(rows.withColumn(row, F.monotonically_increasing_id()))
    each = own.select(row, F.posexplode(F.regexp_extract_all(text, F.lit(REFERENCE), F.lit(1))).alias("i", ref))
    new = each.join(ids.select(F.col("ref").alias(ref), F.col("id").cast("string").alias("id")), ref, "left")
    lost = F.raise_error(F.concat(F.lit("unknown reference "), F.col(ref))).cast("string") if strict else F.col(ref)
    new = new.groupBy(row).agg(F.array_sort(F.collect_list(F.struct("i", F.coalesce("id", lost).alias("id")))).alias(found))
    tails = F.transform(F.split(text, REFERENCE, -1), lambda x, i: F.when(i == 0, x).otherwise(F.concat(F.lit("**"), F.get(found, i - 1)["id"], F.lit("**"), x)))
    out = own.join(new, row, "left").withColumn(text, F.when(F.col(found).isNull(), F.col(text)).otherwise(F.array_join(tails, "")))
    return out.select(*rows.columns)
