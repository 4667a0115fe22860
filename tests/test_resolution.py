"""Ids by similarity, null keys, hot keys, references, marking and names, against plain Python."""

import os
import random

import pytest
from pyspark.sql import functions as F

from stemma import joins, lineage
from stemma.functions import names
from stemma.functions import text as fn
from stemma.operators import annotate, compare, history, identity, pipeline, references, resolve
from stemma.sources import bibtex, files, sinks

ENTRY = "filename string, bibkey string, refid long, hash string"


def resolved_in_python(rows, by_ref, by_hash):
    """The steps row by row; ``by_ref`` and ``by_hash`` are the merged records of the earlier ids and of the hashes."""
    rows = [dict(r, srefid=r["refid"], id=None) for r in rows]
    for ref in {r["refid"] for r in rows} - {None}:
        stays = min({r["hash"] for r in rows if r["refid"] == ref}, key=lambda h: (resolve.distance(by_ref[ref], by_hash[h]), h))
        for r in rows:
            if r["refid"] == ref and r["hash"] != stays:
                r["srefid"] = None
    for h in {r["hash"] for r in rows}:
        refs = {r["srefid"] for r in rows if r["hash"] == h} - {None}
        if len(refs) > 1:
            old = min(refs, key=lambda x: (resolve.distance(by_hash[h], by_ref[x]), -x))
            for r in rows:
                if r["hash"] == h and r["srefid"] not in (None, old):
                    r["id"] = old
    for r in rows:
        r["id"] = r["srefid"] if r["id"] is None else r["id"]
    for h in {r["hash"] for r in rows}:
        known = [r["id"] for r in rows if r["hash"] == h and r["id"] is not None]
        for r in rows:
            if r["hash"] == h and r["refid"] is None and known:
                r["id"] = known[0]
    n = max([r["refid"] for r in rows if r["refid"] is not None], default=0)
    for h in sorted({r["hash"] for r in rows if r["id"] is None}):
        n += 1
        for r in rows:
            if r["hash"] == h:
                r["id"] = n
    return {r["bibkey"]: r["id"] for r in rows}


@pytest.mark.parametrize("seed", range(3))
def test_resolved_as_in_python(spark, seed):
    rng = random.Random(seed)
    rows = [{"filename": f"f{i % 3}.bib", "bibkey": f"k{i}", "refid": rng.choice([None, 1, 2, 3]), "hash": rng.choice("abcde")} for i in range(14)]
    values = [(r["filename"], r["bibkey"], f, v) for r in rows for f, v in (("title", rng.choice(["one", "two words", "three more words"])), ("year", rng.choice(["1901", "1902"])), ("ENTRYTYPE", "book"))]
    df = spark.createDataFrame([tuple(r.values()) for r in rows], ENTRY)
    v = spark.createDataFrame(values, "filename string, bibkey string, field string, value string")
    files = spark.createDataFrame([("f0.bib", 5), ("f1.bib", 9), ("f2.bib", 1)], "filename string, priority long")
    records = lambda key: {r[key]: dict(r.fields) for r in resolve._records(df, v, files, key).collect()}
    assert {r.bibkey: r.id for r in resolve.resolved(df, v, files).collect()} == resolved_in_python(rows, records("refid"), records("hash"))


def test_held_records_are_compared_as_by_difflib():
    """Texts of all lengths about the one from which characters are popular, on both sides, to the last bit; what is given up can't win."""
    rng = random.Random(5)
    text = lambda: "".join(rng.choices(rng.choice(["ab", "0123456789#fp, ", "é€a😀", "abcdefghijklmnop"]), k=rng.choice([0, 1, 5, 40, 199, 200, 400])))
    record = lambda: {f: text() for f in ("author", "title", "year", "note", "srctrickle") if rng.random() < 0.8}
    for _ in range(40):
        own, others = record(), [record() for _ in range(6)]
        for left in (True, False):
            held = resolve.Held(own, left)
            exact = [resolve.distance(own, o) if left else resolve.distance(o, own) for o in others]
            assert [held.distance(o) for o in others] == exact
            limit = sorted(exact)[2]
            kept = [resolve.Held(own, left).distance(o, lambda d: d <= limit) for o in others]
            assert all(k == d if d <= limit else k in (None, d) for k, d in zip(kept, exact))


def copies(n):
    """``n`` earlier ids with four entries each, of seven hashes: rows and values."""
    rng = random.Random(n)
    rows = [{"filename": f"f{rng.randrange(3)}.bib", "bibkey": f"k{i}", "refid": i // 4 if i % 9 else None, "hash": f"h{rng.randrange(7)}"} for i in range(4 * n)]
    return rows, [(r["filename"], r["bibkey"], f, v) for r in rows for f, v in (("title", r["hash"] * 3), ("year", rng.choice(["1901", "1902"])), ("ENTRYTYPE", "book"))]


def resolved_copies(spark, n):
    rows, values = copies(n)
    df, v = spark.createDataFrame([tuple(r.values()) for r in rows], ENTRY), spark.createDataFrame(values, "filename string, bibkey string, field string, value string")
    return rows, df, v, spark.createDataFrame([("f0.bib", 5), ("f1.bib", 9), ("f2.bib", 1)], "filename string, priority long")


def test_candidates_in_shares(spark, monkeypatch):
    """Records that list hundreds of entries, whose candidates are compared in several shares."""
    monkeypatch.setattr(resolve, "SHARE", 5)
    rows, df, v, files = resolved_copies(spark, 60)
    records = lambda key: {r[key]: dict(r.fields) for r in resolve._records(df, v, files, key).collect()}
    assert {r.bibkey: r.id for r in resolve.resolved(df, v, files).collect()} == resolved_in_python(rows, records("refid"), records("hash"))


def test_long_records_dont_go_with_each_candidate(spark):
    """A hash's record lists its entries, so if each candidate had one, what is stored would grow with the square of the copies."""
    folder = lineage.shared_folder(spark).removeprefix("file://")
    stored = lambda: sum(os.path.getsize(f"{at}/{x}") for at, _, names in os.walk(folder) for x in names)
    sizes = []
    for n in (100, 800):
        _, df, v, files = resolved_copies(spark, n)
        before = stored()
        resolve.resolved(df, v, files).count()
        sizes.append(stored() - before)
    assert sizes[1] < 10 * sizes[0]


def test_entries_without_hash_are_kept(spark):
    rows = [("f", "a", 1, "x"), ("f", "b", None, None), ("f", "c", 2, None), ("f", "d", None, "x"), ("f", "e", None, "y"), ("f", "g", None, None)]
    out = {r.bibkey: r.id for r in identity.assign_ids(spark.createDataFrame(rows, ENTRY)).collect()}
    assert out == {"a": 1, "b": None, "c": 2, "d": 1, "e": 3, "g": None}


def test_numbers_are_gapless(spark):
    out = identity.numbered_by(spark.range(5000).select((F.col("id") % 1237).alias("x")), "x", 10, partitions=7).collect()
    assert sorted((r.x, r.number) for r in out) == [(k, k + 10) for k in range(1237)]


def test_hot_and_null_keys(spark, monkeypatch):
    monkeypatch.setattr(joins, "HOT_ROWS", 5)
    left = spark.createDataFrame([(k, "hot" if k < 20 else None if k < 25 else f"k{k % 4}") for k in range(40)], "n int, key string")
    right = left.where("key is not null").groupBy("key").agg(F.count("*").alias("size"), F.max("n").alias("most"))
    for how in ("inner", "left"):
        want = sorted(map(tuple, left.join(right, "key", how).select("n", "key", "size", "most").collect()), key=repr)
        got = joins.keyed(left, right, ["key"], "size", 35, how)
        assert sorted(map(tuple, got.select("n", "key", "size", "most").collect()), key=repr) == want
    assert sorted(map(tuple, joins.told(left, right, "key").select("n", "key", "size", "most").collect()), key=repr) == want


def test_translated_rows(spark):
    rows = spark.createDataFrame([(1, "a **k**:3 b"), (1, "x"), (2, None), (2, "**k****l** **none**"), (1, "x"), (3, "a ** b **")], "key int, text string")
    ids = spark.createDataFrame([("k", 7), ("l", 8)], "ref string, id long")
    want = [(1, "a **7**:3 b"), (1, "x"), (1, "x"), (2, None), (2, "**7****8** **none**"), (3, "a ** b **")]
    assert sorted(map(tuple, references.translated(rows, "text", ids).collect()), key=repr) == sorted(want, key=repr)
    with pytest.raises(Exception, match="unknown reference none"):
        references.translated(rows, "text", ids, strict=True).collect()


def test_translated_table(spark, tmp_path):
    rows = spark.createDataFrame([("Fam", "**k**:2", "c1"), ("Abc", "**l**", "c2")], "name string, refs string, comment string")
    ids = spark.createDataFrame([("k", 7), ("l", 8)], "ref string, id long")
    sinks.translated_table(rows, "refs", ids, f"{tmp_path}/x.tab", ["name"])
    text = "".join(sorted(p.read_text() for p in (tmp_path / "x-ids.tab").glob("part-*")))
    assert text.splitlines() == ["Abc\t**8**\tc2", "Fam\t**7**:2\tc1"]


def test_conservative_marking(spark):
    rules = spark.createDataFrame(annotate.rule_rows({("hhtype", "grammar", 3): [[(True, "grammar")]], ("hhtype", "text", 1): [[(False, "grammar")]]}), annotate.RULES)
    rows = [("r1", {"lgcode": "abc", "hhtype": "wordlist", "title": "a grammar"}), ("n1", {"lgcode": "abc", "title": "a Grammar"}), ("n2", {"lgcode": "xyz", "title": "grammar"}), ("n3", {"lgcode": "abc", "title": "stories"}), ("n4", {})]
    df = spark.createDataFrame(rows, "key string, fields map<string,string>")
    marked = annotate.marked(df, rules, fn.words)
    types = spark.createDataFrame([("text", 1), ("wordlist", 2), ("grammar", 3)], "kind string, place int")
    part = lambda name: lambda f: F.filter(F.array(F.substring_index(F.try_element_at(f, F.lit(name)), " ", 1)), lambda x: x.isNotNull())
    out, log = annotate.conservative(marked, df.where("key = 'r1'"), part("lgcode"), part("hhtype"), types, "hhtype")
    kinds = {r.key: r.fields.get("hhtype") for r in out.collect()}
    assert kinds == {"r1": "wordlist", "n1": None, "n2": 'grammar (computerized assignment from "grammar")', "n3": 'text (computerized assignment from "not grammar")', "n4": 'text (computerized assignment from "not grammar")'}
    assert [tuple(r) for r in log.collect()] == [("abc", "wordlist", "grammar", 'grammar (computerized assignment from "grammar")', "n1")]


def test_many_rules_are_joined(spark, monkeypatch):
    """Rules by their rarest word, and a dictionary by a join, against the ways for few of them."""
    draw = random.Random(11)
    names = [f"w{k}" for k in range(25)]
    docs = spark.createDataFrame([(k, draw.choices(names, range(1, 26), k=draw.randint(0, 9))) for k in range(150)] + [(900, None), (901, [])], "k int, ws array<string>")
    rules = {("kind", f"l{k % 7}", k % 7): [[(draw.random() < 0.6, w) for w in draw.sample([*names, "never"], draw.randint(1, 3))] for _ in range(4)] for k in range(30)}
    table = spark.createDataFrame(annotate.rule_rows(rules), annotate.RULES).distinct()
    dictionary = spark.createDataFrame([(w, f"l{k % 3}") for k, w in enumerate(names[:12])] + [("w3", "other")], "word string, label string")
    rows = lambda d: sorted(tuple(r) for r in d.collect())
    want, labels = rows(annotate.fired(docs, "k", "ws", table)), rows(annotate.unique_label(docs, "k", "ws", dictionary))
    assert rows(annotate.fired_by_index(docs, "k", "ws", table, lot=5)) == want and labels
    monkeypatch.setattr(annotate, "RULE_TERMS", 1)
    assert rows(annotate.fired(docs, "k", "ws", table)) == want
    assert rows(annotate.unique_label(docs, "k", "ws", dictionary)) == labels


def test_labels_of_ambiguous_words(spark):
    docs = spark.createDataFrame([(1, ["a", "b"]), (2, ["a", "c"]), (3, ["d"]), (4, None), (5, [])], "k int, ws array<string>")
    words = spark.createDataFrame([("a", "x"), ("b", "x"), ("c", "y"), ("d", "x"), ("d", "y")], "word string, label string")
    assert [tuple(r) for r in annotate.unique_label(docs, "k", "ws", words).collect()] == [(1, "x")]


@pytest.mark.parametrize(
    ("text", "small", "rest"),
    [("van der Berg", ["van", "der"], ["Berg"]), ("d'Angelo", ["d'"], ["Angelo"]), ("Nd'Angelo x", [], ["N", "d'", "Angelo", "x"]), ("d'angelo", ["d'angelo"], []), ("  [Anon]  of", [], ["[Anon]", "of"]), ("", [], [])],
)
def test_parted_names(text, small, rest):
    assert names.parted(text) == (small, rest)


def test_name_readings(spark):
    rows = spark.createDataFrame([(1, "{The Board}"), (2, "Li, Wei and Jo Na"), (3, None)], "k int, author string")
    assert [r.k for r in compare.name_readings(rows, ["k"], "author").collect()] == [1]


def test_latex_writer(spark):
    fields = spark.createDataFrame([({"title": "Ünïcode ß", "url": "http://é"},), (None,)], "f map<string,string>")
    out = [r.x for r in fields.select(bibtex.escaped(F.col("f"), "latex").alias("x")).collect()]
    assert out[0]["title"].isascii() and out[0]["url"] == "http://é" and out[1] is None
    with pytest.raises(ValueError):
        bibtex.escaped(F.col("f"), "ebcdic")


def test_key_ids(spark):
    entries = spark.createDataFrame([("a", {"ref_id": "5"}), ("b", {"ref_id": "x"}), ("c", {}), ("d", None)], "bibkey string, fields map<string,string>")
    assert [tuple(r) for r in history.key_ids(entries, "ref_id").collect()] == [("a", 5)]


def test_a_shared_folder_is_needed_off_a_local_session(monkeypatch):
    class Context:
        master = "yarn"
        getCheckpointDir = staticmethod(lambda: None)

    class Conf:
        get = staticmethod(lambda name, default: default)

    class Frame:
        sparkSession = type("S", (), {"sparkContext": Context, "conf": Conf})

    with pytest.raises(RuntimeError):
        lineage.cut(Frame)


def test_whole_batch(spark, tmp_path):
    rows = [
        ("a.bib", 0, "r", "book", {"author": "Roe, Ann", "title": "Wordlist of Abc", "year": "1990", "lgcode": "Abc [abc]", "hhtype": "wordlist", "ref_id": "4"}),
        ("b.bib", 0, "x", "book", {"author": "Moe, Bob", "title": "A grammar of Abc", "year": "1991", "lgcode": "Abc [abc]"}),
        ("b.bib", 1, "y", "book", {"author": "Doe, Cy", "title": "Une grammar", "year": "1992", "lgcode": "xyz"}),
        ("b.bib", 2, "z", "misc", {"author": "Poe, Di", "title": "Stories in Foo", "year": "1993"}),
    ]
    entries = spark.createDataFrame(rows, "filename string, entry_pos long, bibkey string, entrytype string, fields map<string,string>")
    files_ = spark.createDataFrame([("a.bib", 2), ("b.bib", 1)], "filename string, priority long")
    rules = lambda found: spark.createDataFrame(annotate.rule_rows(found), annotate.RULES)
    by = pipeline.Annotation(
        spark.createDataFrame([("abc", "Africa"), ("xyz", None)], "code string, area string"),
        rules({("hhtype", "grammar", 2): [[(True, "grammar")]]}),
        rules({("lgcode", "Foo [foo]", 1): [[(True, "foo")]]}),
        spark.createDataFrame([("une", "French [fra]")], "word string, label string"),
        spark.createDataFrame([("wordlist", 1), ("grammar", 2)], "kind string, place int"),
    )
    built, changes = pipeline.run(entries, files_, "a.bib", by, str(tmp_path / "out"), similar=False)
    assert {r.filename: (r.added, r.changed) for r in changes.collect()} == {"b.bib": (3, 0)}
    parsed = bibtex.parsed(spark.read.text(str(tmp_path / "out" / "merged"), wholetext=True).select(F.lit("m").alias("filename"), F.col("value").alias("text")))
    got = {r.fields["srctrickle"]: dict(r.fields) for r in parsed.collect()}
    shown = {k: tuple(f.get(n) for n in ("macro_area", "hhtype", "lgcode", "inlg")) for k, f in got.items()}
    grammar = 'grammar (computerized assignment from "grammar")'
    assert shown == {
        "a#r": ("Africa", "wordlist", "Abc [abc]", None),
        "b#x": ("Africa", None, "Abc [abc]", None),
        "b#y": (None, grammar, "xyz", "French [fra]"),
        "b#z": (None, None, 'Foo [foo] (computerized assignment from "foo")', None),
    }
    assert got["a#r"]["ref_id"] == "4" and sorted(f["ref_id"] for f in got.values()) == ["4", "5", "6", "7"]
    log = spark.read.option("header", True).option("sep", "\t").option("escape", '"').csv(str(tmp_path / "out" / "log")).collect()
    assert [(r.step, r.language, r.before, r.after, r.value) for r in log] == [("hhtype", "abc", "wordlist", "grammar", grammar)]
    assert spark.read.option("header", True).csv(str(tmp_path / "out" / "ids")).count() == 4
    assert spark.read.schema("id long, replacement long").json(str(tmp_path / "out" / "replacements")).count() == 0
    with pytest.raises(ValueError):
        pipeline.run(entries.withColumn("fields", F.map_concat(F.map_filter("fields", lambda k, _: k != "ref_id"), F.create_map(F.lit("ref_id"), F.lit("x")))), files_, "a.bib", by, str(tmp_path / "none"))


def test_languoids_of_five_tables(spark):
    table = lambda rows, columns: spark.createDataFrame(rows, ", ".join(f"{c} string" for c in columns.split()))
    tables = [
        table([("h1", "1.5", "-2")], "hid longitude latitude"),
        table([("h1", "A; B"), ("h2", "C")], "hid string_agg"),
        table([("h3", "Africa")], "hid string_agg"),
        table([("1", "aaaa1111", "Own"), ("2", "bbbb2222", "Near"), ("3", "cccc3333", "Far")], "pk id name"),
        table([("h1", "aaaa1111", "Own", "[1, 2, 3]"), ("h2", "cccc3333", "Far", "[3]")], "hid id name array_agg"),
    ]
    got = {r.hid: tuple(r)[1:] for r in files.languoids(*tables).collect()}
    assert got == {
        "h1": (1.5, -2.0, ["A", "B"], None, "aaaa1111", "Own", ["Far [cccc3333]", "Near [bbbb2222]"]),
        "h2": (None, None, ["C"], None, "cccc3333", "Far", None),
        "h3": (None, None, None, "Africa", None, None, None),
    }
    assert files.languoids(*[t.limit(0) for t in tables]).isEmpty()
    with pytest.raises(Exception, match="no name of 9"):
        files.languoids(*tables[:4], table([("h1", "a", "b", "[1, 9]")], "hid id name array_agg")).collect()
    with pytest.raises(Exception, match="several areas"):
        files.languoids(*tables[:2], table([("h3", "Africa, Asia")], "hid string_agg"), *tables[3:]).collect()


def test_snapshots_in_natural_order(spark, tmp_path):
    for name in ("s10.bib", "s9.bib", "s9.csv", "s11.csv"):
        (tmp_path / name).write_text("")
    found = files.snapshots(spark, f"file://{tmp_path}/*.bib", f"file://{tmp_path}/*.csv")
    assert [x.rsplit("/", 1)[1] for x in found] == ["s9.bib", "s10.bib", "s11.csv"]
    assert files.snapshots(spark, f"file://{tmp_path}/none/*.bib") == []


def test_parts_are_trimmed(spark):
    row = spark.range(1).select(
        fn.split_trimmed(F.lit("0a0; b ;1c1;; d"), ";").alias("parts"),
        fn.language_codes(F.lit("abc , xyz")).alias("codes"),
        files.typed_record(F.create_map(F.lit("alternate_names"), F.lit("Foo 0, Bar , 2 Baz 2")))[1],
    ).first()
    assert row.parts == ["0a0", "b", "1c1", "d"] and row.codes == ["abc", "xyz"] and row.alternate_names == ["Foo 0", "Bar", "2 Baz 2"]
