"""Classifications as paths: rows of (path array<string>, name, code), one for each member of a path."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stemma.joins import private
from stemma.lineage import cut

ROOT = ""


def walk_routes(paths: DataFrame) -> DataFrame:
    """For each two places on a path, root included: ``frm``, ``to`` and ``route``, the places between; each once."""
    p = paths.select("path").distinct().select(F.concat(F.array(F.lit(ROOT)), "path").alias("p"))
    a = p.select("p", F.posexplode("p").alias("i", "frm"))
    b = a.select("p", "i", "frm", F.explode(F.when(F.col("i") + 1 < F.size("p"), F.sequence(F.col("i") + 1, F.size("p") - 1)).otherwise(F.array().cast("array<int>"))).alias("j"))
    return b.select("frm", F.get("p", F.col("j")).alias("to"), F.slice("p", F.col("i") + 2, F.col("j") - F.col("i") - 1).alias("route")).distinct()


def ambiguous_routes(paths: DataFrame) -> DataFrame:
    return walk_routes(paths).groupBy("frm", "to").agg(F.count("*").alias("routes")).where("routes > 1")


def member_paths(members: DataFrame) -> DataFrame:
    """name, code, and how many paths a member is under."""
    return members.select("path", "name", "code").distinct().groupBy("name", "code").agg(F.count("*").alias("paths"))


def paths_of(members: DataFrame) -> DataFrame:
    """name, code, and the sorted paths that a member is under: as many as the classification has places for it."""
    return members.select("path", "name", "code").distinct().groupBy("name", "code").agg(F.array_sort(F.collect_list("path")).alias("paths"))


def edges(paths: DataFrame) -> DataFrame:
    """Each place on a path with the one before it, the root's for the first: parent, child; each once."""
    p = paths.select("path").distinct().select(F.concat(F.array(F.lit(ROOT)), "path").alias("p"))
    pairs = F.transform(F.slice("p", 2, F.size("p") - 1), lambda child, i: F.struct(F.get("p", i).alias("parent"), child.alias("child")))
    return p.select(F.explode(pairs).alias("e")).select("e.*").distinct()


def several_parents(paths: DataFrame) -> DataFrame:
    """Places that come after different places: child. Only these make routes ambiguous, as two routes to a place part at the last place that they share."""
    return edges(paths).groupBy("child").agg(F.count("*").alias("parents")).where("parents > 1").select("child")


def is_tree(members: DataFrame) -> DataFrame:
    """One row: whether no route is ambiguous and no member has two paths, with the counts of both.

    The routes themselves are listed for paths through places with several parents alone, so for a tree there are none.
    """
    paths = members.select("path").distinct()
    through = paths.select("path", F.explode("path").alias("child")).join(several_parents(paths), "child", "left_semi").select("path").distinct()
    routes = ambiguous_routes(through).agg(F.count("*").alias("ambiguous"))
    twice = member_paths(members).agg(F.count_if(F.col("paths") > 1).alias("multiple"))
    return routes.crossJoin(F.broadcast(twice)).select("ambiguous", "multiple", ((F.col("ambiguous") == 0) & (F.col("multiple") == 0)).alias("is_tree"))


def prefixes(path: Column) -> Column:
    """All beginnings of a path, itself included."""
    return F.transform(F.sequence(F.lit(1), F.size(path)), lambda n: F.slice(path, 1, n))


def extents(members: DataFrame) -> DataFrame:
    """Each beginning of a path with the codes of the members under it, in rows: prefix, code."""
    return members.select(F.explode(prefixes(F.col("path"))).alias("prefix"), "code").distinct()


def extent_lists(members: DataFrame) -> DataFrame:
    """The same with sorted lists, for classifications whose largest class fits into a row."""
    return extents(members).groupBy("prefix").agg(F.array_sort(F.collect_list("code")).alias("codes"))


def member_triples(members: DataFrame) -> DataFrame:
    """path, name, code of each member, the path as text."""
    return members.select(F.array_join("path", ", ").alias("path"), "name", "code")


def carried_forward(lines: DataFrame, group: list[str], order: str, value: str, out: str, partitions: int = 0) -> DataFrame:
    """The last value that isn't null up to each line of its group; of lines equal in ``order``, which comes first is open.

    Lines are dealt to ranges of (group, order), so a group of any size is spread over several tasks. Within a range the
    value is carried by a window; what a range takes over from the ones before is carried over the ranges' last values, of
    which only groups in more than one range have any: two rows for each border at most, which are sent to all tasks.
    """
    part, last, own = (private(lines, x) for x in ("part", "last", "own"))
    by = [*group, order]
    ranged = lines.repartitionByRange(partitions, *by) if partitions else lines.repartitionByRange(*by)
    ranged = cut(ranged.withColumn(part, F.spark_partition_id()))
    ends = ranged.groupBy(*group, part).agg(F.max_by(value, F.when(F.col(value).isNotNull(), F.col(order))).alias(last))
    over = Window.partitionBy(*group)
    several = ends.withColumn(own, F.count("*").over(over)).where(F.col(own) > 1)
    before = F.last(last, ignorenulls=True).over(over.orderBy(part).rowsBetween(Window.unboundedPreceding, -1))
    taken = F.broadcast(several.select(*[F.col(c).alias(f"{own}{i}") for i, c in enumerate(group)], F.col(part).alias(own), before.alias(last)))
    same = reduce(lambda a, b: a & b, (F.col(c).eqNullSafe(F.col(f"{own}{i}")) for i, c in enumerate(group)), F.col(part) == F.col(own))
    inside = F.last(value, ignorenulls=True).over(Window.partitionBy(*group, part).orderBy(order).rowsBetween(Window.unboundedPreceding, 0))
    filled = ranged.withColumn(out, inside).join(taken, same, "left")
    return filled.withColumn(out, F.coalesce(out, last)).select(*lines.columns, out)
