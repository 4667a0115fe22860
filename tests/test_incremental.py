"""A state that was updated after edits against one that is built anew."""

import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from stemma.joins import few
from stemma.operators import keyid
from stemma.operators.incremental import State

FILES = [f"f{k}.bib" for k in range(4)]
WORDS = ["stone", "river", "grammar", "the", "of", "language", "tale", "north", "red", "old"]
SCHEMA = "filename string, bibkey string, entrytype string, fields map<string,string>"


def entry(draw):
    fields = {"author": draw.choice(["Ann Lee", "Bo Ray", "Cy Fox"]), "year": draw.choice(["1900", "1901"]), "title": " ".join(draw.choices(WORDS, range(1, 11), k=draw.randint(1, 4)))}
    if draw.random() < 0.7:
        fields["ref_id"] = draw.choice([str(draw.randint(1, 12)), "none"]) if draw.random() < 0.2 else str(draw.randint(1, 12))
    if draw.random() < 0.2:
        fields["isbn"] = str(draw.randint(1, 5))
    for f in ("author", "title"):
        if draw.random() < 0.08:
            del fields[f]
    return fields


def frame(spark, data):
    return spark.createDataFrame([(f, k, "misc", v) for (f, k), v in sorted(data.items())], SCHEMA)


def files(spark, order, names=FILES):
    return spark.createDataFrame([(f, order[f]) for f in names], "filename string, priority long")


def rows(state):
    ids = sorted(map(str, (tuple(r) for r in state.assigned().select("filename", "bibkey", "refid", "hash", "srefid", "id").collect())))
    records = sorted((r.id, r.entrytype, tuple(sorted(r.fields.items()))) for r in state.table("records").collect())
    return ids, records, sorted((r.word, r.n) for r in state.table("words").collect())


@pytest.mark.parametrize("seed, similar", [(2, True)])
def test_updates_are_as_a_new_build(spark, tmp_path, seed, similar):
    """Two rounds of edits: changed, new, removed and moved entries, a file that goes, another order of the files."""
    draw = random.Random(seed)
    data = {(draw.choice(FILES), f"k{k}"): entry(draw) for k in range(30)}
    order = {f: k for k, f in enumerate(FILES)}
    state = State(spark, f"file://{tmp_path}/state", similar)
    assert state.generation() is None
    state.build(frame(spark, data), files(spark, order))
    for step in range(2):
        names = draw.sample(FILES, 2)
        for key in [k for k in data if k[0] in names]:
            chance = draw.random()
            if chance < 0.15:
                data[key] = entry(draw)
            elif chance < 0.25 or (step == 1 and key[0] == names[0]):
                del data[key]
            elif chance < 0.3:
                data[names[1], key[1] + "m"] = data.pop(key)
        data |= {(names[1], f"n{step}{k}"): entry(draw) for k in range(3)}
        if step == 1:
            order[FILES[0]], order[FILES[3]] = 3, 0
        changed = frame(spark, {k: v for k, v in data.items() if k[0] in names})
        state.update(changed, spark.createDataFrame([(n,) for n in names], "filename string"), files(spark, order))
        anew = State(spark, f"file://{tmp_path}/anew{step}", similar)
        anew.build(frame(spark, data), files(spark, order))
        got, want = rows(state), rows(anew)
        assert [sorted(set(map(str, a)) ^ set(map(str, b))) for a, b in zip(got, want)] == [[], [], []]
        assert got == want and state.generation() == step + 2
    with pytest.raises(ValueError):
        state.update(changed, spark.createDataFrame([(names[0],)], "filename string"), files(spark, order, []))


def test_an_update_without_changes(spark, tmp_path):
    draw = random.Random(7)
    data = {(f, "k"): entry(draw) for f in FILES}
    state = State(spark, f"file://{tmp_path}/s", False)
    state.build(frame(spark, data), files(spark, {f: 1 for f in FILES}))
    before = rows(state)
    state.update(frame(spark, data), spark.createDataFrame([(f,) for f in FILES], "filename string"), files(spark, {f: 1 for f in FILES}))
    assert rows(state) == before


@pytest.mark.parametrize("buckets", [1, 7, 1 << 12])
def test_rarest_words_by_a_summary(spark, buckets):
    """With any number of buckets the summary only leaves out words that can't be among the rarest."""
    draw = random.Random(5)
    titles = [(k, " ".join(draw.choices([*WORDS, "ab", "b", "c1"], range(1, 14), k=draw.randint(0, 9)))) for k in range(300)] + [(300, None), (301, "the of"), (302, "the")]
    df = spark.createDataFrame(titles, "key long, title string")
    frequencies = keyid.word_frequencies(df)
    of = {r.word: r.n for r in frequencies.collect()}
    got = {r.key: [(x["i"], x["word"]) for x in r.best] for r in keyid.ranked(df, "key", frequencies, 2, complete=True, buckets=buckets).collect()}
    for key, title in titles:
        types = [w for w in dict.fromkeys((title or "").split()) if len(w) > 1]
        best = sorted(enumerate(types), key=lambda x: (of[x[1]], x[0]))[:2]
        assert sorted(got.get(key, [])) == sorted(best)
    assert {r.key: sorted((x["i"], x["word"]) for x in r.best) for r in keyid.ranked(df, "key", frequencies, 2).collect()} == {k: sorted(v) for k, v in got.items()}


def test_few_rows_are_sent(spark):
    small = spark.range(10).withColumn("s", F.lit("x"))
    joined = spark.range(10).join(few(small), "id")
    assert "Broadcast" in joined._jdf.queryExecution().executedPlan().toString()
    long = spark.range(40).withColumn("s", F.repeat(F.lit("x"), 1 << 20))
    assert few(long) is long


def test_places_of_a_batch_stay_flat():
    """The places of words that can be among the rarest, as a plain walk tells them, without Python objects or copies of a batch's buckets."""
    draw = random.Random(5)
    lo = [draw.randint(1, 30) for _ in range(64)]
    known = np.array([(a, a + draw.randint(0, 9)) for a in lo])
    titles = [draw.choices(range(64), k=n) for n in (0, 1, 2, 3, 9, 40)] + [None]
    want = [[i for i, b in enumerate(t or []) if len(t) <= 2 or known[b, 0] <= sorted(known[t, 1])[1]] for t in titles]
    batch = pa.array(titles, pa.list_(pa.int32()))
    assert keyid.possible_places(batch, known, 2).to_pylist() == want and keyid.possible_places(batch[3:], known, 2).to_pylist() == want[3:]
    long = pa.ListArray.from_arrays(pa.array(np.arange(0, 2_000_001, 1_000, np.int32)), pa.array(np.tile(np.arange(64, dtype=np.int32), 31_250)))
    tracemalloc.start()
    keyid.possible_places(long, known, 2)
    assert tracemalloc.get_traced_memory()[1] < 4_000_000
    tracemalloc.stop()
