"""Characters, LaTeX that is left in texts, and lineages of dialects."""

import pytest
from pyspark.sql import functions as F

from stemma.functions import text
from stemma.operators import characters, languoids


def test_characters(spark):
    df = spark.createDataFrame([("aé\n",), (None,), ("",), ("éé😀 b",)], "text string").repartition(3)
    assert {r.c: r.n for r in characters.histogram(df).collect()} == {"a": 1, "é": 3, "\n": 1, "😀": 1, " ": 1, "b": 1}
    assert [(r.n, r.c, r.name) for r in characters.table(df).collect()] == [(3, "é", "LATIN SMALL LETTER E WITH ACUTE"), (1, "\n", ""), (1, "😀", "GRINNING FACE")]
    assert characters.table(df, plain=True).count() == 6


def test_latex_that_is_left(spark):
    """A case of each kind, and texts that have none."""
    rows = [(1, r"Fa\c{c}ade"), (2, r"M\"{u}ller"), (3, r"\'et"), (4, r"\textit{two words}"), (5, r"\o x"), (6, "plain {text} 50\\% a_b"), (7, None)]
    df = spark.createDataFrame(rows, "k int, t string").select("k", text.latex_remains(F.col("t")).alias("found"))
    got = {r.k: {(x.kind, x.command, x.argument) for x in r.found or []} for r in df.collect()}
    assert ("command with a letter", "c", "c") in got[1] and ("accent with a braced letter", '"', "u") in got[2] and ("accent with a letter", "'", "e") in got[3]
    assert ("command with a text", "textit", "two words") in got[4] and ("command with a blank", "o", " ") in got[5]
    assert got[6] == got[7] == set()


def test_lineages_of_dialects(spark):
    schema = "id string, name string, lineage array<struct<name:string,id:string>>, level string"
    languages = spark.createDataFrame([("lang1", "L", [("F", "fami1"), ("G", "fami2")], "language"), ("lone1", "I", [], "language")], schema)
    dialects = spark.createDataFrame([("d1", "D", [("L", "lang1")], "dialect"), ("d2", "E", [("L", "lang1"), ("D", "d1")], "dialect"), ("d3", "H", [("I", "lone1")], "dialect"), ("d4", "none", [], "dialect")], schema)
    got = {r.id: [x.id for x in r.lineage] for r in languoids.full_lineages(dialects, languages).collect()}
    assert got == {"d1": ["fami1", "fami2", "lang1"], "d2": ["fami1", "fami2", "lang1", "d1"], "d3": ["lone1"]}
    with pytest.raises(Exception, match="no language of dialect d1"):
        languoids.full_lineages(dialects, languages.where("id = 'lone1'")).collect()
