"""Places within groups of any size, counted over ranges of rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stemma.joins import private
from stemma.lineage import cut


def placed(rows: DataFrame, group: list[str], order: list[Column], out: str = "place", partitions: int = 0) -> DataFrame:
    """``rows`` with ``out``: the place from 1 within their group, in the order of ``order``; rows equal in it have places of either order.

    Rows are dealt to ranges of group and order, numbered in each, and moved up by the counts of the ranges before. Only
    groups in more than one range have such counts: two rows for each border at most, which are sent to all tasks.
    """
    part, own, base = (private(rows, x) for x in ("part", "own", "base"))
    by = [*[F.col(c).asc() for c in group], *order]
    ranged = cut((rows.repartitionByRange(partitions, *by) if partitions else rows.repartitionByRange(*by)).withColumn(part, F.spark_partition_id()))
    over = Window.partitionBy(*group)
    sizes = ranged.groupBy(*group, part).agg(F.count("*").alias(base)).withColumn(own, F.count("*").over(over)).where(F.col(own) > 1)
    before = F.coalesce(F.sum(base).over(over.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    moved = F.broadcast(sizes.select(*[F.col(c).alias(f"{own}{i}") for i, c in enumerate(group)], F.col(part).alias(own), before.alias(base)))
    same = reduce(lambda a, b: a & b, (F.col(c).eqNullSafe(F.col(f"{own}{i}")) for i, c in enumerate(group)), F.col(part) == F.col(own))
    inside = F.row_number().over(Window.partitionBy(*group, part).orderBy(*order))
    numbered = ranged.withColumn(out, inside).join(moved, same, "left")
    return numbered.withColumn(out, (F.col(out) + F.coalesce(base, F.lit(0))).cast("int")).select(*[c for c in rows.columns if c != out], out)
