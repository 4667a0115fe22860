"""Classifications: carrying values over ranges of lines, and routes of places with several parents."""

import random

import pytest

from pyspark.sql import functions as F

from stemma.operators import trees
from stemma.operators.ranges import placed


@pytest.mark.parametrize("partitions", [1, 7, 40])
def test_values_are_carried_over_ranges(spark, partitions):
    """One group of most lines, groups of one line, a null group; values that are far apart or never come."""
    draw = random.Random(2)
    rows = [("big", k, f"v{k}" if k in (5, 6, 200, 900) else None, "x") for k in range(1_000)] + [(f"g{k % 9}", k, f"w{k}" if draw.random() < 0.2 else None, None) for k in range(90)]
    rows += [(None, k, "n" if k == 3 else None, "y") for k in range(8)] + [("none", k, None, "z") for k in range(20)]
    draw.shuffle(rows)
    df = spark.createDataFrame(rows, "g string, line long, own string, __own string")
    got = {(r.g, r.line): r.at for r in trees.carried_forward(df, ["g"], "line", "own", "at", partitions).collect()}
    last = {}
    for g, line, own, _ in sorted(rows, key=lambda x: (str(x[0]), x[1])):
        last[g] = own if own is not None else last.get(g)
        assert got.pop((g, line)) == last[g]
    assert not got
    assert trees.carried_forward(df.limit(0), ["g"], "line", "own", "at", partitions).count() == 0


def plain_is_tree(members):
    routes, of = {}, {}
    for path, name, code in members:
        p = ["", *path]
        for i in range(len(p)):
            for j in range(i + 1, len(p)):
                routes.setdefault((p[i], p[j]), set()).add(tuple(p[i + 1 : j]))
        of.setdefault((name, code), set()).add(tuple(path))
    return sum(len(r) > 1 for r in routes.values()), sum(len(p) > 1 for p in of.values())


@pytest.mark.parametrize("seed", range(4))
def test_routes_of_trees_and_others(spark, seed):
    draw = random.Random(seed)
    tree = [(["A"], "m", 0), (["A", "B"], "n", 1), (["A", "C", "D"], "o", 2)]
    if seed:
        tree += [([draw.choice("ABCDE") for _ in range(draw.randint(1, 4))], draw.choice("mno"), draw.randint(0, 3)) for _ in range(2 * seed)]
    tree += [([], "root", 9)]
    got = trees.is_tree(spark.createDataFrame(tree, "path array<string>, name string, code long")).first()
    assert (got.ambiguous, got.multiple) == plain_is_tree(tree) and got.is_tree == (plain_is_tree(tree) == (0, 0))


def test_a_deep_path_is_a_tree(spark):
    """2,000 places, of which the routes would be 2,000,000."""
    deep = spark.createDataFrame([([f"p{k}" for k in range(2_000)], "m", 1)], "path array<string>, name string, code long")
    assert trees.is_tree(deep).first().is_tree


@pytest.mark.parametrize("partitions", [1, 9])
def test_places_in_groups_of_any_size(spark, partitions):
    draw = random.Random(3)
    rows = [("big", draw.randint(0, 50), k) for k in range(400)] + [(f"g{k % 5}", None if k % 4 == 0 else k % 7, 1_000 + k) for k in range(60)] + [(None, 1, 5_000), (None, 2, 5_001)]
    df = spark.createDataFrame(rows, "g string, score int, k int")
    got = {r.k: r.place for r in placed(df, ["g"], [F.desc("score"), F.asc("k")], partitions=partitions).collect()}
    for g in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == g), key=lambda r: (r[1] is None, -(r[1] or 0), r[2]))
        assert [got[r[2]] for r in own] == list(range(1, len(own) + 1))
    assert placed(df.limit(0), ["g"], [F.desc("score")], partitions=partitions).count() == 0
