"""Text functions as expressions of built-in functions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Letters with diacritics and what they fold to, one by one; longer folds. Fixed values.
_ACCENTED = "áàâäãåāăąçćčďéèêëēėęěíìîïīįñńňóòôöõøōőřśšťúùûüūůűýÿźżž"
_PLAIN = "aaaaaaaaacccdeeeeeeeeiiiiiinnnoooooooorsstuuuuuuuyyzzz"
_LONG = {"ß": "ss", "æ": "ae", "œ": "oe"}
#: What parts words of a title. Fixed value.
WORD_BREAK = r"[()\[\]:,.\s\-?!;/~=]+"
#: What parts the years of a range, and a reference to a key. Fixed values.
_YEAR_BREAK = r"[,\-/\s\[\]]+"
REFERENCE = r"\*\*([^*]+)\*\*"
_ROMAN = {"m": 1000, "d": 500, "c": 100, "l": 50, "x": 10, "v": 5, "i": 1}


def folded(text: Column) -> Column:
    """Lower-case text without diacritics and braces; text without LaTeX commands is folded like by ``scalar.undiacritic``."""
    plain = F.translate(F.lower(text), _ACCENTED, _PLAIN)
    plain = reduce(lambda c, x: F.replace(c, F.lit(x[0]), F.lit(x[1])), _LONG.items(), plain)
    return F.regexp_replace(plain, r"[{}]", "")


def words(text: Column) -> Column:
    """The words of a title, in order."""
    bare = F.replace(F.replace(folded(text), F.lit("'"), F.lit("")), F.lit('"'), F.lit(""))
    return F.array_remove(F.split(bare, WORD_BREAK), "")


def title_types(title: Column) -> Column:
    """Distinct words of a title that begin with a letter and have two characters or more, in order."""
    return F.array_distinct(F.filter(words(title), lambda w: F.regexp_like(w, F.lit(r"^[a-zA-Z]."))))


def range_completed(incomplete: Column, complete: Column) -> Column:
    """``7`` after ``1895`` is ``1897``."""
    short = F.length(complete) - F.length(incomplete)
    return F.when(short > 0, F.concat(F.substring(complete, F.lit(1), short), incomplete)).otherwise(incomplete)


def year(text: Column) -> Column:
    """A year or a range of years; one in brackets comes first; ``[nd]`` if there is none."""
    bracketed = F.regexp_extract(text, r"\[([\d,\-/]+)\]", 1)
    parts = F.filter(F.split(F.when(bracketed != "", bracketed).otherwise(text), _YEAR_BREAK), lambda x: F.trim(x) != "")
    first, last = F.get(parts, F.lit(0)), F.get(parts, F.size(parts) - 1)
    return F.when(F.size(parts) == 0, "[nd]").when(F.size(parts) == 1, first).otherwise(F.concat_ws("-", first, range_completed(last, first)))


def year_key(text: Column) -> Column:
    """The four characters of a match key; a missing year gives ``nd``."""
    return F.substring(year(F.coalesce(text, F.lit("[nd]"))), 1, 4)


def roman_value(text: Column) -> Column:
    """The value of a lower-case Roman numeral: a digit after a smaller one takes the smaller one away twice."""
    value = F.create_map(*[F.lit(x) for kv in _ROMAN.items() for x in kv])
    start = F.struct(F.lit(0).alias("sum"), F.lit(10_000).alias("before"))
    step = lambda a, c: F.struct((a["sum"] + value[c] - F.when(value[c] > a["before"], 2 * a["before"]).otherwise(0)).alias("sum"), value[c].alias("before"))
    return F.aggregate(F.filter(F.split(text, ""), lambda c: c != ""), start, step, lambda a: a["sum"])


def page_sums(text: Column) -> tuple[Column, Column]:
    """Pages in Roman and in Arabic numbers, ranges counted with both ends."""
    def total(pattern: str, value) -> Column:
        found = F.arrays_zip(F.regexp_extract_all(text, F.lit(pattern), F.lit(1)).alias("a"), F.regexp_extract_all(text, F.lit(pattern), F.lit(2)).alias("b"))
        one = lambda x: F.when(x["b"] != "", value(x["b"], x["a"]) - value(x["a"], x["a"]) + 1).otherwise(value(x["a"], x["a"]))
        return F.aggregate(F.transform(found, one), F.lit(0).cast("long"), lambda s, n: s + n.cast("long"))

    return total(r"([xivmcl]+)-?([xivmcl]*)", lambda x, _: roman_value(x)), total(r"(\d+)-?(\d*)", lambda x, full: range_completed(x, full).cast("long"))


def page_count(text: Column) -> Column:
    """``r+n`` if there are Roman and Arabic pages, else their sum, or nothing."""
    r, n = page_sums(text)
    return F.when((r != 0) & (n != 0), F.concat_ws("+", r.cast("string"), n.cast("string"))).when((r == 0) & (n == 0), "").otherwise((r + n).cast("string"))


def page_value(count: Column) -> Column:
    """The number that a page count stands for; sums are added, never evaluated."""
    return F.aggregate(F.split(count, r"\+"), F.lit(0).cast("long"), lambda s, x: s + F.coalesce(x.try_cast("long"), F.lit(0).cast("long")))


def trimmed(parts: Column) -> Column:
    """Strings of an array without blanks around them. ``F.trim`` itself would get the place as the characters to trim."""
    return F.transform(parts, lambda x: F.trim(x))


def language_codes(text: Column) -> Column:
    """Codes in brackets, or else the parts between commas and slashes, if every one is a code."""
    bracketed = F.regexp_extract_all(text, F.lit(r"\[([a-z][a-z][a-z]|NOCODE_[A-Z][^\s\]]+)\]"), F.lit(1))
    parts = trimmed(F.split(text, r"[,/]\s?"))
    codes = F.forall(parts, lambda p: F.regexp_like(p, F.lit(r"^(?:[a-z][a-z][a-z]$|NOCODE_[A-Z][^\s\]]+$)")))
    return F.when(F.size(bracketed) > 0, bracketed).when(codes, parts).otherwise(F.array().cast("array<string>"))


def type_names(text: Column) -> Column:
    """The types that a field lists, without remarks in parentheses."""
    return F.split(F.regexp_replace(text, r" \([^)]*\)", ""), r"[;,]\s?")


def reference_keys(text: Column) -> Column:
    """Array of struct(key, pages) of the references ``**key**:pages`` in a text."""
    pattern = F.lit(REFERENCE + r"(:[\d,\s\-]+)?")
    return F.arrays_zip(F.regexp_extract_all(text, pattern, F.lit(1)).alias("key"), F.regexp_extract_all(text, pattern, F.lit(2)).alias("pages"))


def name_turned(name: Column) -> Column:
    """``A, B`` as ``B A``."""
    parts = F.split(name, ",", 2)
    return F.when(F.size(parts) == 2, F.concat_ws(" ", F.trim(parts[1]), F.trim(parts[0]))).otherwise(name)


def split_trimmed(text: Column, separator: str, limit: int = -1) -> Column:
    """Parts without blanks around them, without empty ones."""
    return F.filter(trimmed(F.split(text, separator, limit)), lambda x: x != "")


def unbraced(text: Column) -> Column:
    """Without one pair of braces around all of it."""
    return F.when(F.regexp_like(text, F.lit(r"(?s)^\{.*\}$")), F.substring(text, F.lit(2), F.length(text) - 2)).otherwise(text)


def slug(name: Column) -> Column:
    return F.regexp_replace(folded(name), "[^a-z0-9]", "")


def valid_id(code: Column) -> Column:
    return F.regexp_like(code, F.lit("^[a-z0-9]{4}[0-9]{4}$"))


def natural_key(name: Column) -> Column:
    """A sort key by which runs of digits compare as numbers (up to 18 digits)."""
    return F.transform(F.regexp_extract_all(name, F.lit(r"(\d+|\D+)"), F.lit(1)), lambda x: F.when(F.regexp_like(x, F.lit(r"^\d")), F.lpad(x, 18, "0")).otherwise(x))


#: What LaTeX a text still has, by kind. Fixed values.
LATEX_KINDS = {
    "command with a letter": r"\\([^%'`^~=_\"\s{]+)\{([a-zA-Z]?)\}",
    "accent with a braced letter": r"\\(['`^~=_\"]+?)\{([a-zA-Z])\}",
    "accent with a letter": r"\\([^a-zA-Z\s%_])([a-zA-Z])",
    "accents with a letter": r"\\([^a-zA-Z\s%{_]+)([a-zA-Z])",
    "command with a text": r"\\([^{%_]+)\{([^}]+)\}",
    "command with a blank": r"\\([^{_\\\s%]+)(\s)",
}


def latex_remains(text: Column) -> Column:
    """LaTeX that is left in a text: array of struct(kind, command, argument), by kind and then by place; one place can be of several kinds."""
    def of(kind: str, pattern: str) -> Column:
        parts = F.arrays_zip(*[F.regexp_extract_all(text, F.lit(pattern), F.lit(k)).alias(n) for k, n in ((1, "command"), (2, "argument"))])
        return F.transform(parts, lambda x: F.struct(F.lit(kind).alias("kind"), x["command"].alias("command"), x["argument"].alias("argument")))

    return F.concat(*[of(kind, pattern) for kind, pattern in LATEX_KINDS.items()])
