"""Stable ids where similarity decides: of the candidates of a split or merge, the record most like the old or new one wins."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from difflib import SequenceMatcher
from os.path import commonprefix

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stemma.joins import private
from stemma.lineage import cut
from stemma.operators import identity, merge

#: Weights of fields in a comparison; all others weigh 1. Fixed values.
WEIGHTS = {"author": 3, "year": 3, "title": 3, "ENTRYTYPE": 2}
#: From this length of the second text on, SequenceMatcher leaves out its popular characters.
POPULAR = 200
#: Candidates of a record that are compared in one task; more are dealt out, each share with a copy of the record.
SHARE = 4096


def distance(left: dict[str, str], right: dict[str, str]) -> float:
    """1 less the weighted mean similarity of the fields that both have; 0 for two empty records, 1 without a common field."""
    if not left and not right:
        return 0.0
    common = sorted(left.keys() & right.keys())
    if not common:
        return 1.0
    total = sum(WEIGHTS.get(k, 1) for k in common)
    return 1 - sum(WEIGHTS.get(k, 1) * SequenceMatcher(None, left[k], right[k]).ratio() for k in common) / total


def matched(left: str, right: str) -> int:
    """How many characters are in the matching blocks that SequenceMatcher finds for a ``right`` shorter than POPULAR.

    The longest common part, the first in ``left`` and then in ``right``, then the same on both sides of it. Parts of
    the short text are sought in the long one, so a long ``left`` is only scanned by ``str.find``.
    """
    total, todo = 0, [(0, len(left), 0, len(right))]
    while todo:
        a, a_end, b, b_end = todo.pop()
        size, starts = 0, []
        for j in range(b, b_end):
            if j + size > b_end:
                break
            if size and left.find(right[j : j + size], a, a_end) < 0:
                continue
            longer = size
            while j + longer < b_end and left.find(right[j : j + longer + 1], a, a_end) >= 0:
                longer += 1
            if longer > size:
                size, starts = longer, []
            if size:
                starts.append(j)
        if not size:
            continue
        i, j = min((left.find(right[j : j + size], a, a_end), j) for j in starts)
        total += size
        if a < i and b < j:
            todo.append((a, i, b, j))
        if i + size < a_end and j + size < b_end:
            todo.append((i + size, a_end, j + size, b_end))
    return total


class Held:
    """A record that many others are compared with, as ``distance`` does with it on the left or right; equal texts are compared once."""

    def __init__(self, fields: dict[str, str], left: bool):
        self.fields, self.left, self.known, self.matchers = fields, left, {}, {}

    def _ratio(self, field: str, text: str) -> float:
        ratio = self.known.get((field, text))
        if ratio is None:
            a, b = (self.fields[field], text) if self.left else (text, self.fields[field])
            if len(b) < POPULAR:
                ratio = 2.0 * matched(a, b) / (len(a) + len(b)) if a or b else 1.0
            else:
                # The matcher keeps the places of its second text's characters, which stays the same if it is the held one.
                matcher = self.matchers.setdefault(field, SequenceMatcher(None))
                if matcher.b != b:
                    matcher.set_seq2(b)
                if matcher.b2j:
                    matcher.set_seq1(a)
                    ratio = matcher.ratio()
                else:
                    # All characters are popular, so the only block is what both begin with.
                    ratio = 2.0 * len(commonprefix([a, b])) / (len(a) + len(b))
            self.known[field, text] = ratio
        return ratio

    def distance(self, other: dict[str, str], most: Callable[[float], bool] | None = None) -> float | None:
        """``distance``, or None as soon as ``most`` denies one that it can't be below.

        At first a text counts as like as the lengths allow, and the cheapest comparisons come first. Rounding keeps
        order, so bounds that are summed in the same order hold to the last bit.
        """
        if not self.fields and not other:
            return 0.0
        common = sorted(self.fields.keys() & other.keys())
        if not common:
            return 1.0
        weights = [WEIGHTS.get(k, 1) for k in common]
        total = sum(weights)
        if most is None:
            return 1 - sum(w * self._ratio(k, other[k]) for w, k in zip(weights, common)) / total
        sizes = [(len(self.fields[k]), len(other[k])) for k in common]
        likeness = [2.0 * min(x) / sum(x) if any(x) else 1.0 for x in sizes]
        least = lambda: 1 - sum(w * x for w, x in zip(weights, likeness)) / total
        for _, n in sorted((x * y, n) for n, (x, y) in enumerate(sizes)):
            if not most(least()):
                return None
            likeness[n] = self._ratio(common[n], other[common[n]])
        return least()


@F.pandas_udf(T.DoubleType())
def distance_of(pairs: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    for left, right in pairs:
        yield pd.Series([distance(dict(a or {}), dict(b or {})) for a, b in zip(left, right)], dtype=float)


def _shared(a: Column, b: Column) -> Column:
    """How many characters two texts have in common, each as often as both have it."""
    times = lambda text, c: F.length(text) - F.length(F.replace(text, c, F.lit("")))
    return F.aggregate(F.array_distinct(F.split(a, "")), F.lit(0), lambda n, c: n + F.when(c == "", 0).otherwise(F.least(times(a, c), times(b, c))))


def least_distance(left: Column, right: Column) -> Column:
    """A distance that isn't above ``distance`` of two records: a text's likeness is bounded by the characters that both sides have in any order."""
    names = F.array_intersect(F.map_keys(left), F.map_keys(right))
    weight = lambda k: F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for pair in WEIGHTS.items() for x in pair]), k), F.lit(1))

    def most(k: Column) -> Column:
        a, b = F.try_element_at(left, k), F.try_element_at(right, k)
        both = F.length(a) + F.length(b)
        return weight(k) * F.when(both == 0, 1.0).otherwise(2.0 * _shared(a, b) / F.greatest(both, F.lit(1)))

    total = F.aggregate(names, F.lit(0), lambda n, k: n + weight(k))
    likeness = F.aggregate(names, F.lit(0.0), lambda n, k: n + most(k))
    return F.when((F.size(F.map_keys(left)) == 0) & (F.size(F.map_keys(right)) == 0), 0.0).when(total == 0, 1.0).otherwise(1 - likeness / F.greatest(total, F.lit(1)))


def contenders(pairs: DataFrame, group: str, one: str, other: str) -> DataFrame:
    """Of ``pairs`` (``group`` and the records ``one`` and ``other``) those that can be the nearest of their group.

    The pair with the least bound is compared; what has a bound above its distance can't be nearer. Groups of one pair,
    where nothing is to be decided, stay without a comparison.
    """
    bound, place, best, size = (private(pairs, x) for x in ("bound", "place", "best", "size"))
    over = Window.partitionBy(group)
    ranked = pairs.withColumn(bound, least_distance(F.col(one), F.col(other)))
    ranked = cut(ranked.withColumn(place, F.row_number().over(over.orderBy(bound))).withColumn(size, F.count("*").over(over)))
    first = ranked.where((F.col(place) == 1) & (F.col(size) > 2)).select(group, distance_of(one, other).alias(best))
    # A millionth above the distance, as the bound is summed in another order.
    return ranked.join(first, group, "left").where(F.col(best).isNull() | (F.col(bound) <= F.col(best) + 1e-6)).select(*pairs.columns)


def measured(pairs: DataFrame, held: DataFrame, others: DataFrame, by: str, other: str, held_left: bool, nearest: bool = False) -> DataFrame:
    """``pairs`` (``by``, ``other``), which are read twice, with ``d``, the distance of their records.

    A record of ``held`` (``by``, fields) goes once to a task that streams its candidates of ``others`` (``other``, fields),
    so what is shuffled is the candidates, however long the held records are. ``nearest`` leaves the nearest candidate
    of each share, of several the largest, and compares the others only as far as it takes to know that they aren't.
    """
    share, kept, shares = "__share", "__held", "__shares"
    schema = T.StructType([pairs.schema[by], pairs.schema[other], T.StructField("d", T.DoubleType())])
    many = pairs.where(F.col(by).isNotNull()).groupBy(by).agg(F.ceil(F.count("*") / SHARE).cast("int").alias(shares))
    first = held.join(many, by).select(by, F.explode(F.sequence(F.lit(0), F.col(shares) - 1)).alias(share), F.lit(True).alias(kept), F.lit(0).cast(schema[other].dataType).alias(other), "fields")
    rest = pairs.join(others, other).join(many, by).select(by, F.pmod(F.xxhash64(other), F.col(shares)).cast("int").alias(share), F.lit(False).alias(kept), other, "fields")
    dealt = first.unionByName(rest).repartition(by, share).sortWithinPartitions(by, share, F.col(kept).desc())

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        record, best = None, None
        for frame in frames:
            out = []
            for key, is_held, name, fields in zip(frame[by], frame[kept], frame[other], frame["fields"]):
                if is_held:
                    if best:
                        out.append(best)
                    record, best = Held(dict(fields), held_left), None
                elif not nearest:
                    out.append((key, name, record.distance(dict(fields))))
                else:
                    wins = lambda d: best is None or (d, -name) < (best[2], -best[1])  # noqa: B023, E731
                    d = record.distance(dict(fields), wins)
                    if d is not None and wins(d):
                        best = (key, name, d)
            yield pd.DataFrame(out, columns=[by, other, "d"])
        if best:
            yield pd.DataFrame([best], columns=[by, other, "d"])

    return dealt.mapInPandas(run, schema)


def part_values(parts: DataFrame, fields: dict[str, Column]) -> DataFrame:
    """The fields of parts as values of their entries."""
    pairs = F.explode(F.create_map(*[x for k, v in ({"ENTRYTYPE": F.lit("part")} | fields).items() for x in (F.lit(k), v.cast("string"))]))
    return parts.select(F.concat(F.lit("f"), F.col("p_size") % 5, F.lit(".bib")).alias("filename"), F.concat(F.lit("p"), "p_partkey").alias("bibkey"), pairs.alias("field", "value"))


def _records(entries: DataFrame, values: DataFrame, files: DataFrame, key: str) -> DataFrame:
    """Merged records by ``key``, the entry type and the provenance among their fields."""
    own = values.join(entries.where(F.col(key).isNotNull()).select("filename", "bibkey", key), ["filename", "bibkey"])
    out = merge.merged(own, files, key)
    typed = F.when(F.col("entrytype").isNotNull(), F.map_concat("fields", F.create_map(F.lit("ENTRYTYPE"), "entrytype"))).otherwise(F.col("fields"))
    return out.select(key, typed.alias("fields"))


def picks(entries: DataFrame, values: DataFrame, files: DataFrame) -> tuple[identity.Pick, identity.Pick]:
    """How a split and a merge are decided: by the least distance; ties go to the smallest hash, or the largest earlier id.

    Records of an earlier id hold all rows that had it, also those that were separated. Only records of contested
    groups are merged, once for both decisions.
    """
    made: dict[str, DataFrame] = {}

    def records(key: str) -> DataFrame:
        if not made:
            contested = cut(identity.splits(entries).unionByName(identity.merges(entries)).select("refid", "hash").distinct())
            for k in ("refid", "hash"):
                made[k] = cut(_records(entries.join(contested.select(k).distinct(), k, "left_semi"), values, files, k))
        return made[key]

    def pick_hash(pairs: DataFrame) -> DataFrame:
        scored = measured(pairs, records("hash"), records("refid"), "hash", "refid", held_left=False)
        return scored.groupBy("refid").agg(F.min_by("hash", F.struct("d", "hash")).alias("hash"))

    def pick_ref(pairs: DataFrame) -> DataFrame:
        scored = measured(pairs, records("hash"), records("refid").withColumnRenamed("refid", "srefid"), "hash", "srefid", held_left=True, nearest=True)
        return scored.groupBy("hash").agg(F.min_by("srefid", F.struct("d", (-F.col("srefid")).alias("r"))).alias("srefid"))

    return pick_hash, pick_ref


def resolved(entries: DataFrame, values: DataFrame, files: DataFrame) -> DataFrame:
    """``identity.assign_ids`` with the ``picks`` of all entries."""
    return identity.assign_ids(entries, *picks(entries, values, files))
