"""Settings files: the catalog of sources, word rules, and ranks of types. They are small and are read on the driver."""

from __future__ import annotations

import configparser
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from stemma.operators.annotate import RULES, rule_rows

Rules = dict[tuple[str, str], list[list[tuple[bool, str]]]]


def parser(text: str) -> configparser.ConfigParser:
    out = configparser.ConfigParser(interpolation=None)
    out.read_string(text.removeprefix("﻿"))
    return out


def text_of(spark: SparkSession, path: str) -> str:
    """A settings file's text, from any store that Spark reads."""
    return spark.read.text(path, wholetext=True).first()[0]


@dataclass(frozen=True)
class Source:
    """One source of a catalog and how it is read and written."""

    filename: str
    encoding: str = "utf-8"
    sortkey: str | None = None
    strict: bool = True
    priority: int = 0
    name: str = ""
    title: str = ""
    description: str = ""
    abbr: str = ""


class Catalog(list):
    """Sources in order, found by place or by filename."""

    def __init__(self, text: str, ending: str = ".bib", strict_key: str = "strict"):
        c = parser(text)
        for section in c.sections():
            if section.endswith(ending):
                s = c[section]
                sortkey = s.get("sortkey", "none")
                self.append(Source(section, s.get("encoding", "utf-8"), None if sortkey.lower() == "none" else sortkey, s.getboolean(strict_key, True), s.getint("priority", 0), *(s.get(k, "") for k in ("name", "title", "description", "abbr"))))

    def __getitem__(self, key):
        if isinstance(key, str):
            found = next((s for s in self if s.filename == key), None)
            if found is None:
                raise KeyError(key)
            return found
        return super().__getitem__(key)

    def files(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame([(s.filename, s.priority) for s in self], "filename string, priority long")

    def read(self, spark: SparkSession, folder: str, mode: str = "failfast") -> DataFrame:
        """The entries of all sources as one DataFrame."""
        from functools import reduce

        from stemma.sources import bibtex

        own = [bibtex.read(spark, f"{folder}/{s.filename}", mode, s.encoding) for s in self]
        return reduce(DataFrame.unionByName, own) if own else spark.createDataFrame([], bibtex.SCHEMA)


def rules(text: str, curly_to_square: bool = False) -> Rules:
    """Word rules: sections ``class, label``; each line of ``triggers`` is a conjunction of words, `` AND `` between, ``NOT `` before those that may not be there."""
    c, out = parser(text), {}
    for section in c.sections():
        name = section.replace("{", "[").replace("}", "]") if curly_to_square else section
        lines = [x for x in c[section].get("triggers", "").strip().splitlines() if x.strip()]
        if lines:
            kind, _, label = name.partition(", ")
            terms = lambda line: [(not w.startswith("NOT "), w.removeprefix("NOT ").strip()) for w in line.strip().split(" AND ")]
            out[kind, label] = [terms(x) for x in lines]
    return out


def rules_table(spark: SparkSession, text: str, ranks: dict[str, int] | None = None, curly_to_square: bool = False) -> DataFrame:
    """The rules as rows, a label's rank being that of ``ranks`` or 0."""
    every = {(k, label, (ranks or {}).get(label, 0)): v for (k, label), v in rules(text, curly_to_square).items()}
    return spark.createDataFrame(rule_rows(every), RULES)


def type_ranks(spark: SparkSession, text: str) -> DataFrame:
    """Ranks of types: id, rank, expl, abbv, bibabbv; sections are ``class, explanation``."""
    c = parser(text)
    found = [(c[s].get("id"), c[s].getint("rank"), s.partition(", ")[2], c[s].get("abbv"), c[s].get("bibabbv")) for s in c.sections() if c[s].get("id")]
    return spark.createDataFrame(found, "id string, rank int, expl string, abbv string, bibabbv string")
