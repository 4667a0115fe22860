"""Operators against plain Python and cases derived by hand."""

import random

import pytest
from pyspark.sql import functions as F

from stemma.operators import annotate, compare, history, identity, languoids, merge, pipeline, references, trees
from stemma.sources import bibtex, files, ini, sinks
from stemma.streaming import ids

VALUE = "filename string, bibkey string, id long, field string, value string"


def assigned_in_python(rows):
    """The steps one after another, row by row; ties alone decide."""
    rows = [dict(r, srefid=r["refid"], id=None) for r in rows]
    for ref in {r["refid"] for r in rows} - {None}:
        stays = min(r["hash"] for r in rows if r["refid"] == ref)
        for r in rows:
            if r["refid"] == ref and r["hash"] != stays:
                r["srefid"] = None
    for h in {r["hash"] for r in rows}:
        refs = {r["srefid"] for r in rows if r["hash"] == h} - {None}
        if len(refs) > 1:
            for r in rows:
                if r["hash"] == h and r["srefid"] is not None and r["srefid"] != max(refs):
                    r["id"] = max(refs)
    for r in rows:
        if r["id"] is None:
            r["id"] = r["srefid"]
    for h in {r["hash"] for r in rows}:
        known = [r["id"] for r in rows if r["hash"] == h and r["id"] is not None]
        for r in rows:
            if r["hash"] == h and r["refid"] is None and r["id"] is None and known:
                r["id"] = known[0]
    n = max([r["refid"] for r in rows if r["refid"] is not None], default=0)
    for h in sorted({r["hash"] for r in rows if r["id"] is None}):
        n += 1
        for r in rows:
            if r["hash"] == h:
                r["id"] = n
    return {r["bibkey"]: r["id"] for r in rows}


@pytest.mark.parametrize("seed", range(4))
def test_assign_ids_as_in_python(spark, seed):
    rng = random.Random(seed)
    rows = [{"filename": "f", "bibkey": f"k{i}", "refid": rng.choice([None, 1, 2, 3, 4]), "hash": rng.choice("abcdef")} for i in range(14)]
    df = spark.createDataFrame([tuple(r.values()) for r in rows], "filename string, bibkey string, refid long, hash string")
    got = {r.bibkey: r.id for r in identity.assign_ids(df).collect()}
    assert got == assigned_in_python(rows)


def test_assign_ids_of_an_empty_table(spark):
    assert identity.assign_ids(spark.createDataFrame([], "filename string, bibkey string, refid long, hash string")).count() == 0


def test_merge(spark):
    rows = [("a.bib", "k", 1, "title", "X"), ("b.bib", "k", 1, "title", "Y"), ("a.bib", "k", 1, "isbn", "2"), ("b.bib", "k", 1, "isbn", "1"), ("c.bib", "k", 1, "isbn", "1"), ("a.bib", "k", 1, "crossref", "z")]
    files_ = spark.createDataFrame([("a.bib", 0), ("b.bib", 100), ("c.bib", -1)], "filename string, priority long")
    values = spark.createDataFrame(rows, VALUE)
    fields = merge.merged(values, files_).first().fields
    assert fields == {"title": "Y", "isbn": "1, 2", "src": "a, b, c", "srctrickle": "a#k, b#k, c#k"}
    own = spark.createDataFrame([("a.bib", "title", 200)], "filename string, field string, priority long")
    assert merge.merged(values, files_, overrides=own).first().fields["title"] == "X"


def test_trees(spark):
    m = spark.createDataFrame([(["A"], "x", 1), (["A", "B"], "y", 2)], "path array<string>, name string, code long")
    routes = {(r.frm, r.to): r.route for r in trees.walk_routes(m.where("code = 2")).collect()}
    assert routes == {("", "A"): [], ("", "B"): ["A"], ("A", "B"): []}
    assert trees.is_tree(m).first().is_tree
    assert {tuple(r.prefix): r.codes for r in trees.extent_lists(m).collect()} == {("A",): [1, 2], ("A", "B"): [2]}
    twice = m.unionByName(spark.createDataFrame([(["C"], "y", 2)], m.schema))
    assert not trees.is_tree(twice).first().is_tree


def test_rules_with_only_negative_words(spark):
    rules = spark.createDataFrame(annotate.rule_rows({("c", "l", 1): [[(False, "no")]], ("c", "m", 2): [[(True, "yes"), (False, "no")]]}), annotate.RULES)
    docs = spark.createDataFrame([(1, ["yes"]), (2, ["no", "yes"]), (3, ["other"]), (4, [])], "k int, ws array<string>")
    found = annotate.fired(docs, "k", "ws", rules)
    assert {(r.k, r.label) for r in found.collect()} == {(1, "l"), (1, "m"), (3, "l"), (4, "l")}
    assert {r.k: r.value for r in annotate.annotated(found, "k").collect()}[1] == 'm (computerized assignment from "not no and yes")'


def test_history(spark):
    rows = spark.createDataFrame([("a.bib", "k", 1, 5), ("a.bib", "k", 2, 6), ("a.bib", "l", 1, 7), ("a.bib", "l", 2, 7)], "filename string, bibkey string, version int, id long")
    assert [r.history for r in history.id_history(rows).collect()] == ["1:5, 2:6"]
    assert [tuple(r) for r in history.replaced(rows, 1, 2).collect()] == [(5, 6)]
    good, bad = history.accepted(rows.unionByName(rows.where("version = 2")))
    assert {r.version for r in bad.collect()} == {2} and good.count() == 2
    origin = spark.createDataFrame([("a#k, old#x", 3), ("b#c", None)], "srctrickle string, id long")
    assert [tuple(r) for r in history.without_specials(origin, "old").collect()] == [("a", "k", 3)]


def test_references(spark):
    rows = spark.createDataFrame([(1, "see **a:b**:12-13 and **c** or none"), (2, "nothing")], "k int, text string")
    ids_ = spark.createDataFrame([("a:b", 7)], "ref string, id long")
    assert [(r.ref, r.pages) for r in references.extracted(rows, "k", "text").orderBy("place").collect()] == [("a:b", ":12-13 "), ("c", "")]
    assert {r.k: r.text for r in references.translated(rows, "text", ids_).collect()} == {1: "see **7**:12-13 and **c** or none", 2: "nothing"}


def test_languoids(spark):
    flat = "# comment\nFam [fami1234]\n    Lang One [lang1234][abc] spoken\nLone [-isolate-]\n    Lone [lone1234][]\nUnclassified\n    Odd [oddd1234][]\n"
    texts = spark.createDataFrame([("lff.txt", flat)], "filename string, text string")
    out = files.flat_languoids(texts, "language")
    assert {r.id: (r.name, r.iso, r.status, [x.id for x in r.lineage]) for r in out.collect()} == {"lang1234": ("Lang One", "abc", "spoken", ["fami1234"]), "lone1234": ("Lone", "", "", [])}
    full = out.withColumn("lineage", F.transform("lineage", lambda x: F.struct(x["name"].alias("name"), x["id"].alias("id"), F.lit("family").alias("level"))))
    lines = [r.value for r in sinks.flat_languoids(full).collect()]
    assert lines == ["Fam [fami1234]", "    Lang One [lang1234][abc] spoken", "Lone [-isolate-]", "    Lone [lone1234][]"]
    assert {r.path for r in sinks.languoid_tree(out).collect()} == {"fam.fami1234/langone.lang1234/langone.lang1234.ini", "lone.lone1234/lone.lone1234.ini"}
    known = spark.createDataFrame([("lang1234", "dialect")], "id string, level string")
    assert {(r.id, r.problem) for r in languoids.line_errors(out, known).collect()} == {("lang1234", "other level"), ("lone1234", "unknown id")}


def test_languoid_directory(spark, tmp_path):
    texts = spark.createDataFrame([("f", "Fam [fami1234]\n    Lang [lang1234][abc]\n")], "filename string, text string")
    sinks.write_files(sinks.languoid_tree(files.flat_languoids(texts, "language")), f"file://{tmp_path}/tree")
    got = files.languoid_directory(spark, f"{tmp_path}/tree").first()
    assert (got.name, got.id, got.level, got.iso, got.status, got.ancestors) == ("Lang", "lang1234", "language", "abc", None, ["fami1234"])


def test_classification_and_records(spark):
    texts = spark.createDataFrame([("c", "A, B\n  x [1]\n  y [2]\nC\n  z [3]\n"), ("d", "  lost [4]\n")], "filename string, text string")
    assert {(tuple(r.path), r.code) for r in files.path_members(texts.where("filename = 'c'")).collect()} == {(("A", "B"), "1"), (("A", "B"), "2"), (("C",), "3")}
    assert [r.line for r in files.path_errors(texts).collect()] == ["  lost [4]"]
    records = spark.createDataFrame([("h", "Name: X\nLocations: a. b\nCoordinates: 1.5, -2\n\n\n\nName: Y\nName: Z\n")], "filename string, text string")
    got = files.keyed_records(records)
    assert [dict(r.fields) for r in got.orderBy("record_no").collect()] == [{"name": "X", "location": "a. b", "coordinates": "1.5, -2"}, {"name": "Z"}]
    assert tuple(got.select(*files.typed_record(F.col("fields"))).first().coordinates) == (1.5, -2.0)


def test_settings(spark):
    text = "﻿[DEFAULT]\nencoding = utf-8\n[a.bib]\npriority = 3\nsortkey = none\nname = A\n[other]\nx = 1\n[b.bib]\nsortkey = bibkey\nstrict = no\n"
    catalog = ini.Catalog(text)
    assert [s.filename for s in catalog] == ["a.bib", "b.bib"] and catalog["a.bib"].priority == 3 and catalog["a.bib"].sortkey is None and not catalog[1].strict
    rules = ini.rules("[lg, English {eng}]\ntriggers = in english\n  a AND NOT b\n[lg, None]\n", curly_to_square=True)
    assert rules == {("lg", "English [eng]"): [[(True, "in english")], [(True, "a"), (False, "b")]]}


BIB = """% comment
@string{pub = "A House"}
@Book{g:X, Author = {M{\\"u}ller, A.}, title = "Two  {Words}" # { more}, publisher = pub, year = 1990, month = jan,}
@article(y, title = {An @ inside})
"""


def test_bibtex(spark, tmp_path):
    (tmp_path / "a.bib").write_text(BIB)
    bibtex.register(spark)
    got = spark.read.format("bibtex").option("encoding", "latex").load(str(tmp_path)).orderBy("entry_pos").collect()
    assert [(r.bibkey, r.entrytype, dict(r.fields)) for r in got] == [("g:X", "book", {"author": "Müller, A.", "title": "Two {Words} more", "publisher": "A House", "year": "1990", "month": "January"}), ("y", "article", {"title": "An @ inside"})]
    assert bibtex.read(spark, str(tmp_path / "a.bib")).count() == 2
    entries = bibtex.read(spark, str(tmp_path / "a.bib"))
    bibtex.write(entries, str(tmp_path / "out"), "authorbibkey")
    again = bibtex.parsed(spark.read.text(str(tmp_path / "out"), wholetext=True).select(F.lit("a.bib").alias("filename"), F.col("value").alias("text")))
    pairs = lambda d: d.select("bibkey", "entrytype", F.array_sort(F.map_entries("fields")).alias("f"))
    assert compare.equal(pairs(entries), pairs(again))


def test_bibtex_modes(spark):
    broken = "@a{k1, title = {x}}\n@b{k2, title = {x}\n@c{k3, title = {z}}"
    assert [r[2] for r in bibtex.rows("f", broken, "lenient", "utf-8")] == ["k1", "k3"]
    found = list(bibtex.rows("f", broken, "permissive", "utf-8"))
    assert found[0][2] == "k1" and found[-1][5]
    with pytest.raises(bibtex.SyntaxProblem):
        list(bibtex.rows("f", broken, "failfast", "utf-8"))


def entries_of(spark):
    rows = [("a.bib", 0, "k1", "book", {"author": "Adams, Ann", "title": "Grammar of Foo", "year": "1990", "ref_id": "1"}), ("a.bib", 1, "k2", "book", {"author": "Bee, Cee", "title": "Words of Bar", "year": "1991", "ref_id": "1"}), ("b.bib", 0, "k1", "article", {"author": "Adams, Ann", "title": "Grammar of Foo", "year": "1990"}), ("b.bib", 1, "k3", "misc", {"title": "No names", "ref_id": "x9"})]
    return spark.createDataFrame(rows, "filename string, entry_pos long, bibkey string, entrytype string, fields map<string,string>")


def test_build(spark, tmp_path):
    entries = entries_of(spark)
    files_ = spark.createDataFrame([("a.bib", 1), ("b.bib", 2)], "filename string, priority long")
    built = pipeline.build(entries, files_)
    got = {(r.filename, r.bibkey): r.id for r in built.assigned.collect()}
    assert got["a.bib", "k1"] == got["b.bib", "k1"] and len(set(got.values())) == 3
    assert [r.value for r in built.rejected.collect()] == ["x9"]
    assert built.raw("a.bib", "k2")["title"] == "Words of Bar"
    with pytest.raises(KeyError):
        built.raw("a.bib", "none")
    assert built.record(1)["src"] == "a" and built.records("hash").count() == 3
    changes = {r.filename: (r.added, r.changed) for r in sinks.write_back(entries.withColumn("fields", F.map_filter("fields", lambda k, v: v != "x9")), built.assigned, str(tmp_path / "back")).collect()}
    assert sum(a for a, _ in changes.values()) == 2
    sinks.mapping(built.assigned, str(tmp_path / "map"))
    assert spark.read.option("header", True).csv(str(tmp_path / "map")).count() == 4
    entry, names = sinks.contributor_tables(entries)
    assert entry.count() == 4 and names.count() == 3


def test_cache(spark, tmp_path):
    made = []
    make = lambda: made.append(1) or spark.range(3)
    manifest = lambda size: spark.createDataFrame([("a.bib", size, 0)], "name string, size long, mtime long")
    folder = str(tmp_path / "cache")
    for size in (1, 1, 2):
        assert pipeline.cached(spark, folder, manifest(size), make).count() == 3
    assert len(made) == 2


def test_stream_of_ids(spark, tmp_path):
    source = tmp_path / "in"
    for k, hashes in enumerate((["a", "b"], ["b", "c"])):
        spark.createDataFrame([(h,) for h in hashes], "hash string").coalesce(1).write.mode("append").parquet(str(source))
        table = ids.IdTable(spark, str(tmp_path / "ids"))
        stream = spark.readStream.schema("hash string").parquet(str(source))
        ids.assign(stream, table, str(tmp_path / "state")).awaitTermination()
    got = {r.hash: r.id for r in table.known().collect()}
    assert set(got) == {"a", "b", "c"} and sorted(got.values()) == [1, 2, 3] and got["c"] == 3


def test_ids_of_a_stream_over_restarts(spark, tmp_path):
    """Null, repeated and late hashes, batches that bring nothing new, and a batch that was broken off before it was committed."""
    source, folder, expected = tmp_path / "in", str(tmp_path / "ids"), {}
    for k, hashes in enumerate((["a", "a", None, "b"], ["b", "a"], ["d", "c", "b", None, "c"], ["a", "e"])):
        spark.createDataFrame([(h,) for h in hashes], "hash string").repartition(2).write.mode("append").parquet(str(source))
        table = ids.IdTable(spark, folder)
        if k == 3:  # its ids were written, but neither its count nor the stream's commit
            table.add_new(spark.createDataFrame([("e",)], "hash string"), 3)
        ids.assign(spark.readStream.schema("hash string").option("maxFilesPerTrigger", 1000).parquet(str(source)), table, str(tmp_path / "state")).awaitTermination()
        got = {r.hash: r.id for r in table.known().collect()}
        assert expected.items() <= got.items() and sorted(got.values()) == list(range(1, len(got) + 1)) and table.known().count() == len(got)
        expected = got
    assert set(expected) == set("abcde") and expected["e"] == 5


def test_ids_of_batches(spark, tmp_path):
    table = ids.IdTable(spark, str(tmp_path / "ids"))
    for batch, hashes in ((0, "ba"), (1, "bc"), (1, "bc")):
        table.add(spark.createDataFrame([(h,) for h in hashes], "hash string"), batch)
    assert {r.hash: r.id for r in table.known().collect()} == {"a": 1, "b": 2, "c": 3}
    source = tmp_path / "in"
    spark.createDataFrame([("c",), ("d",)], "hash string").coalesce(1).write.parquet(str(source))
    late = ids.IdTable(spark, str(tmp_path / "other"))
    late.add(spark.createDataFrame([("c",)], "hash string"), -1)
    stream = spark.readStream.schema("hash string").parquet(str(source))
    ids.assign(stream.withColumn("n", F.lit(1)), late, str(tmp_path / "state")).awaitTermination()
    assert {r.hash: r.id for r in late.known().collect()} == {"c": 1, "d": 2}
