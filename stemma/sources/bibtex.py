"""BibTeX as a source and a sink: a tokenizer, a Spark data source ``bibtex``, and the writer's text as expressions."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import MapType, StringType

from stemma.functions import scalar
from stemma.operators.keyid import FIELD_ORDER

#: Fields that are written as they are. Fixed values.
VERBATIM = ["doi", "eprint", "file", "url", "pdf", "fn", "fnnote"]
SCHEMA = "filename string, entry_pos long, bibkey string, entrytype string, fields map<string,string>, error string"
_NAME = re.compile(r"[^\s\"#%'(),={}]+")
MONTHS = dict(zip("jan feb mar apr may jun jul aug sep oct nov dec".split(), "January February March April May June July August September October November December".split()))


class SyntaxProblem(ValueError):
    """Text that is no BibTeX, with the place where."""


class _Scanner:
    def __init__(self, text: str):
        self.text, self.at, self.macros = text, 0, dict(MONTHS)
        #: The definitions of names for texts, as they are written.
        self.strings: list[str] = []

    def blank(self) -> None:
        while self.at < len(self.text) and self.text[self.at].isspace():
            self.at += 1

    def peek(self) -> str:
        self.blank()
        return self.text[self.at : self.at + 1]

    def take(self, wanted: str) -> str:
        c = self.peek()
        if not c or c not in wanted:
            line = self.text.count("\n", 0, self.at) + 1
            raise SyntaxProblem(f"line {line}: expected one of {wanted!r}, found {self.text[self.at:self.at + 20]!r}")
        self.at += 1
        return c

    def name(self, what: str) -> str:
        self.blank()
        found = _NAME.match(self.text, self.at)
        if not found:
            raise SyntaxProblem(f"line {self.text.count(chr(10), 0, self.at) + 1}: expected {what}")
        self.at = found.end()
        return found[0]

    def braced(self, end: str) -> str:
        """Text up to ``end`` outside braces; the opening has been taken."""
        start, depth = self.at, 0
        while self.at < len(self.text):
            c = self.text[self.at]
            self.at += 1
            if c == "\\":
                self.at += 1
            elif c == end and depth == 0:
                return self.text[start : self.at - 1]
            elif c == "{":
                depth += 1
            elif c == "}":
                depth -= 1
        raise SyntaxProblem(f"line {self.text.count(chr(10), 0, start) + 1}: {end!r} is missing")

    def value(self) -> str:
        parts = []
        while True:
            c = self.peek()
            if c in ('"', "{") and c:
                self.at += 1
                parts.append(self.braced('"' if c == '"' else "}"))
            else:
                word = self.name("a value")
                parts.append(word if word.isdigit() else self.macros.get(word.lower(), word))
            if self.peek() != "#":
                return " ".join("".join(parts).split())
            self.at += 1

    def entries(self) -> Iterator[tuple[str, str, dict[str, str]]]:
        while (at := self.text.find("@", self.at)) >= 0:
            self.at = at + 1
            kind = self.name("an entry type").lower()
            if kind == "comment":
                continue
            close = {"{": "}", "(": ")"}[self.take("{(")]
            if kind == "preamble":
                self.value()
                self.take(close)
                continue
            if kind == "string":
                name = self.name("a name").lower()
                self.take("=")
                self.macros[name] = self.value()
                self.take(close)
                self.strings.append(self.text[at : self.at])
                continue
            self.blank()
            found = re.compile(r"[^\s,}]*").match(self.text, self.at)
            key, self.at = found[0], found.end()
            fields: dict[str, str] = {}
            while self.take("," + close) == ",":
                if self.peek() == close:
                    continue
                field = self.name("a field").lower()
                self.take("=")
                fields.setdefault(field, self.value())
            yield key, kind, fields


def entries(text: str, given: str = "") -> Iterator[tuple[str, str, dict[str, str]]]:
    """(key, type, fields) of a text, strictly: a syntax problem raises. ``given`` are definitions from before it."""
    scanner = _Scanner(text)
    if given:
        earlier = _Scanner(given)
        list(earlier.entries())
        scanner.macros = earlier.macros
    return scanner.entries()


def definitions(text: str) -> str:
    """The names for texts that a text defines, as they are written; what comes after a syntax problem is left out."""
    scanner = _Scanner(text)
    try:
        list(scanner.entries())
    except SyntaxProblem:
        pass
    return "\n".join(scanner.strings)


def lenient_entries(text: str) -> Iterator[tuple[str, str, dict[str, str]]]:
    """The entries that can be read; after a problem, reading goes on at the next ``@`` that begins a line."""
    for block in re.split(r"(?m)^(?=\s*@[A-Za-z])", text):
        try:
            yield from entries(block)
        except SyntaxProblem:
            continue


def decoded(fields: dict[str, str], encoding: str) -> dict[str, str]:
    """Fields with LaTeX or ``?[\\u...]`` read as Unicode, as the source's encoding says; verbatim fields stay."""
    read = {"latex": scalar.from_latex, "u_escape": scalar.u_unescape}.get(encoding)
    return {k: v if read is None or k in VERBATIM else read(v) for k, v in fields.items()}


def rows(filename: str, text: str, mode: str, encoding: str, given: str = "") -> Iterator[tuple]:
    """Rows of SCHEMA; ``given`` are definitions from before the text, for strict reading. ``failfast`` raises a problem, ``permissive`` gives it as a last row, ``lenient`` skips what is broken."""
    at = 0
    try:
        for at, (key, kind, fields) in enumerate(lenient_entries(text) if mode == "lenient" else entries(text, given)):
            yield filename, at, key, kind, decoded(fields, encoding), None
    except SyntaxProblem as problem:
        if mode == "failfast":
            raise
        yield filename, at + 1, None, None, None, str(problem)


class _File(InputPartition):
    def __init__(self, path: str):
        self.path = path


class _Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.options = options

    def partitions(self) -> list[InputPartition]:
        import glob
        import os

        path = self.options["path"].removeprefix("file://")
        found = sorted(glob.glob(os.path.join(path, "*.bib"))) if os.path.isdir(path) else sorted(glob.glob(path))
        return [_File(x) for x in found]

    def read(self, partition: _File) -> Iterator[tuple]:
        import os

        with open(partition.path, encoding=self.options.get("charset", "utf-8-sig"), newline="") as file:
            yield from rows(os.path.basename(partition.path), file.read(), self.options.get("mode", "failfast").lower(), self.options.get("encoding", "utf-8"))


class BibtexSource(DataSource):
    """``spark.read.format("bibtex")``: options path, charset, encoding (utf-8, latex, u_escape), mode. For files that executors can open."""

    @classmethod
    def name(cls) -> str:
        return "bibtex"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return _Reader(dict(self.options))


def register(spark: SparkSession) -> None:
    spark.dataSource.register(BibtexSource)


def parsed(texts: DataFrame, mode: str = "failfast", encoding: str = "utf-8") -> DataFrame:
    """Entries of whole texts (``filename``, ``text``): rows of SCHEMA."""

    def read(batches):
        import pandas as pd

        names = ["filename", "entry_pos", "bibkey", "entrytype", "fields", "error"]
        for batch in batches:
            out = [r for f, t in zip(batch["filename"], batch["text"]) for r in rows(f, t or "", mode, encoding)]
            yield pd.DataFrame(out, columns=names)

    return texts.select("filename", "text").mapInPandas(read, SCHEMA)


def read(spark: SparkSession, path: str, mode: str = "failfast", encoding: str = "utf-8") -> DataFrame:
    """Entries of files in any store that Spark reads, with file size and time left in ``_metadata`` of the scan."""
    texts = spark.read.text(path, wholetext=True).select(F.element_at(F.split(F.input_file_name(), "/"), -1).alias("filename"), F.col("value").alias("text"))
    return parsed(texts, mode, encoding)


def ordered_fields(fields: Column) -> Column:
    """Fields as pairs: the known ones in their order, then the others by name."""
    place = lambda k: F.coalesce(F.array_position(F.array(*map(F.lit, FIELD_ORDER)), k).cast("int"), F.lit(0))
    keyed = F.transform(F.map_entries(fields), lambda e: F.struct(F.when(place(e["key"]) > 0, place(e["key"])).otherwise(1000).alias("p"), e["key"].alias("key"), e["value"].alias("value")))
    return F.array_sort(keyed)


def entry_text(entrytype: Column, bibkey: Column, fields: Column) -> Column:
    """An entry as BibTeX."""
    lines = F.transform(ordered_fields(fields), lambda e: F.concat(F.lit("    "), e["key"], F.lit(" = {"), e["value"], F.lit("}")))
    return F.concat(F.lit("@"), entrytype, F.lit("{"), bibkey, F.lit(",\n"), F.array_join(lines, ",\n"), F.lit("\n}\n"))


@F.pandas_udf(MapType(StringType(), StringType()))
def latex_fields(fields: pd.Series) -> pd.Series:
    """Values with LaTeX commands for letters that aren't ASCII, but for verbatim fields."""
    one = lambda k, v: v if v is None or k in VERBATIM else scalar.to_latex(v)
    return fields.map(lambda m: None if m is None else {k: one(k, v) for k, v in dict(m).items()})


def escaped(fields: Column, encoding: str) -> Column:
    """Field values for a source's encoding; verbatim fields stay as they are."""
    if encoding in ("utf-8", ""):
        return fields
    if encoding == "u_escape":
        one = lambda v: F.array_join(F.transform(F.split(v, ""), lambda c: F.when(F.ascii(c) > 127, F.concat(F.lit("?[\\u"), F.ascii(c), F.lit("]"))).otherwise(c)), "")
        return F.transform_values(fields, lambda k, v: F.when(k.isin(VERBATIM), v).otherwise(one(v)))
    if encoding == "latex":
        return latex_fields(fields)
    raise ValueError(f"no writer for {encoding}")


def sort_columns(sortkey: str | None) -> list[Column]:
    """Order of entries in a file: by key, or by author and then the key with its halves around a colon changed."""
    if sortkey == "bibkey":
        return [F.lower("bibkey")]
    if sortkey == "authorbibkey":
        turned = F.when(F.instr("bibkey", ":") > 0, F.concat(F.expr("substring(bibkey, instr(bibkey, ':') + 1)"), F.lit(":"), F.substring_index("bibkey", ":", 1))).otherwise(F.col("bibkey"))
        return [F.concat(F.coalesce(F.try_element_at("fields", F.lit("author")), F.lit("")), turned)]
    if sortkey is None:
        return [F.col("entry_pos")]
    raise ValueError(f"unknown sort key {sortkey}")


def write(entries_: DataFrame, path: str, sortkey: str | None = "bibkey", encoding: str = "utf-8") -> None:
    """Entries as BibTeX text in a new folder, sorted over all its parts; entries without an order need a sort key."""
    if sortkey is None and "entry_pos" not in entries_.columns:
        raise ValueError("entries have no order: give a sort key")
    text = entry_text(F.col("entrytype"), F.col("bibkey"), escaped(F.col("fields"), encoding))
    entries_.orderBy(*sort_columns(sortkey)).select(text.alias("value")).write.text(path)
