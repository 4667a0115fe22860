"""Intervals against the versions that they were made of, and the choice among many candidates."""

import random

from pyspark.sql import functions as F

from stemma.lineage import cut
from stemma.operators import history, resolve


def test_intervals_are_as_versions(spark):
    """Entries that come, go, come again and change their ids, or have none."""
    draw = random.Random(6)
    rows = [("f.bib", f"k{k}", v, draw.choice([1, 2, 3, 4, None])) for k in range(60) for v in range(6) if draw.random() < 0.8]
    df = spark.createDataFrame(rows, "filename string, bibkey string, version long, id long")
    spans = history.opened(df, 0)
    for v in range(1, 6):
        spans = cut(history.with_version(spans, df.where(F.col("version") == v), v))
    got = sorted((r.bibkey, v, str(r.id)) for r in spans.collect() for v in range(r.first, r.last + 1))
    assert got == sorted((k, v, str(i)) for _, k, v, i in rows)
    assert {(r.bibkey, r.open) for r in spans.where("last = 5").collect()} == {(k, True) for _, k, v, _ in rows if v == 5}
    key = lambda d: sorted(tuple(r) for r in d.collect())
    known, whole = spans.where("id is not null"), df.where("id is not null")
    assert key(history.history_of(known)) == key(history.id_history(whole))
    for old, new in ((0, 1), (1, 4), (2, 3)):
        assert key(history.replaced_by_intervals(known, old, new)) == key(history.replaced(whole, old, new))


def test_contenders_hold_the_nearest(spark):
    """Bounds that are never above the distance, the nearest always kept, and most pairs left out."""
    draw = random.Random(9)
    word = lambda: "".join(draw.choices("abcdefghij é", k=draw.randint(0, 14)))
    record = lambda: {f: word() for f in ("author", "title", "year", "ENTRYTYPE", "note") if draw.random() < 0.8}
    rows = []
    for g in range(12):
        own = record()
        near = [{f: v + draw.choice(["", "x"]) for f, v in own.items()}] + [record() for _ in range(15)]
        rows += [(g, k, own, other) for k, other in enumerate(near)]
    rows += [(50, 0, {}, {}), (51, 0, {"a": "x"}, {"b": "y"}), (51, 1, {"a": "x"}, {"a": ""}), (52, 0, {"a": ""}, {"a": ""})]
    pairs = spark.createDataFrame(rows, "g long, k long, one map<string,string>, other map<string,string>")
    bounds = {(r.g, r.k): r.b for r in pairs.select("g", "k", resolve.least_distance(F.col("one"), F.col("other")).alias("b")).collect()}
    exact = {(g, k): resolve.distance(a, b) for g, k, a, b in rows}
    assert all(bounds[key] <= d + 1e-9 for key, d in exact.items())
    left = {(r.g, r.k) for r in resolve.contenders(pairs, "g", "one", "other").collect()}
    for g in {g for g, *_ in rows}:
        best = min(d for (h, _), d in exact.items() if h == g)
        assert {key for key, d in exact.items() if key[0] == g and d == best} <= left
    assert len(left) < len(rows) / 3
