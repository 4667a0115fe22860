"""Scalar functions on cases derived by hand."""

import pytest
from pyspark.sql import functions as F

from stemma.functions import names, scalar
from stemma.functions import text as fn
from stemma.operators import keyid
from stemma.operators.resolve import distance


def values(spark, function, cases):
    df = spark.createDataFrame([(i, c) for i, c in enumerate(cases)], "i int, x string")
    return [r.y for r in df.select("i", function(F.col("x")).alias("y")).orderBy("i").collect()]


@pytest.mark.parametrize(
    "function, cases",
    [
        (fn.year, {"1895-1896": "1895-1896", "1895-7": "1895-1897", "[1950] 1952": "1950", "in press": "in-press", "[nd]": "nd", "": "[nd]"}),
        (fn.year_key, {"in press": "in-p", "1895-7": "1895", None: "nd"}),
        (fn.page_count, {"xxxiv+254": "34+254", "167 pp.": "167", "253-67": "15", "": ""}),
        (fn.language_codes, {"Indonesian [ind], Standard Malay [zsm]": ["ind", "zsm"], "ind, zsm": ["ind", "zsm"], "ind, Malay": []}),
        (fn.type_names, {'grammar (computerized assignment from "x")': ["grammar"], "grammar;dictionary, text": ["grammar", "dictionary", "text"]}),
        (fn.words, {"A manual of the So:ra: (or Savara) language": ["a", "manual", "of", "the", "so", "ra", "or", "savara", "language"], "": []}),
        (fn.name_turned, {"Smith, John": "John Smith", "John": "John"}),
        (fn.unbraced, {"{a}": "a", "a": "a"}),
        (fn.roman_value, {"viv": 9, "iv": 4, "xl": 40}),
        (fn.valid_id, {"abcd1234": True, "abcd12345": False, "xabcd1234": False}),
    ],
)
def test_expressions(spark, function, cases):
    assert values(spark, function, cases) == list(cases.values())


def test_page_value(spark):
    assert values(spark, fn.page_value, ["34+254", "", "7"]) == [288, 0, 7]


def test_natural_order(spark):
    df = spark.createDataFrame([("v10",), ("v9",), ("v9a2",)], "x string").orderBy(fn.natural_key(F.col("x")))
    assert [r.x for r in df.collect()] == ["v9", "v9a2", "v10"]


def test_python_forms():
    assert [scalar.to_roman(n) for n in (9, 4, 40, 900)] == ["viv", "iv", "xl", "dcd"]
    assert scalar.roman("vol 4") == "VOL IV"
    assert scalar.u_unescape("Pras?[\\u257]d") == "Prasād" and scalar.u_unescape(scalar.u_escape("Prasād")) == "Prasād"
    assert scalar.undiacritic("Prasād") == "Prasad" and scalar.undiacritic(r"G\'{e}r\"ard {\oslash} \textopeno{}") == "Gerard o o"
    assert scalar.from_latex(r"\'{e}t\"a {x}") == "étä x" and scalar.from_latex(scalar.to_latex("Müller")) == "Müller"


def test_names():
    assert names.name_parts("Ramamurti, Rao Sahib G.V.") == {"lastname": "Ramamurti", "firstname": "Rao Sahib G.V."}
    assert names.name_parts("Jan van der Berg")["lastname"].endswith("Berg")
    assert names.author_key("Smith, John and Adams, Ann") == "Adams-Smith"
    assert names.bibtex_name("Ludwig van Beethoven") == ("van", "Beethoven", "Ludwig", "")
    assert names.bibtex_name("von Berlichingen zu Hornberg, Götz") == ("von Berlichingen zu", "Hornberg", "Götz", "")
    assert names.bibtex_name("King, Jr., Martin Luther") == ("", "King", "Martin Luther", "Jr.")
    assert names.bibtex_name("a, b, c, d") is None


def test_match_key(spark):
    fields = {"author": "Ramamurti, Rao Sahib G.V.", "title": "A manual of the So:ra: (or Savara) language", "year": "1931", "extra_hash": "grammar"}
    assert keyid.key_of(fields) == "ramamurti_manual-of1931grammar"
    assert keyid.key_of({"title": "X y"}).startswith("__missingcontrib__")
    cases = [fields, {"author": "Adams, Ann", "title": "Grammar of Grammar", "year": "1895-7", "volume": "9"}, {"editor": "Bee, C.", "title": "The long way", "journal": "J", "volume": "2"}, {"title": "Nobody wrote it", "year": "1900"}]
    columns = sorted({k for c in cases for k in c})
    df = spark.createDataFrame([(str(i), *[c.get(k) for k in columns]) for i, c in enumerate(cases)], "k string, " + ", ".join(f"{c} string" for c in columns))
    counts = {r.word: r.n for r in keyid.word_frequencies(df).collect()}
    got = {int(r.k): r.hash for r in keyid.keyed(df, "k").collect()}
    assert got == {i: keyid.key_of(c, counts) for i, c in enumerate(cases)}


def test_distance():
    assert distance({}, {}) == 0.0 and distance({"a": "x"}, {"b": "x"}) == 1.0 and distance({"a": "x", "title": "t"}, {"a": "x", "title": "t"}) == 0.0
    assert 0 < distance({"title": "abcd"}, {"title": "abce"}) < 1
