"""Line- and record-based sources: classifications, flat languoid files, languoid directories, keyed records, delimited tables."""

from __future__ import annotations

import os
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stemma.functions.text import split_trimmed
from stemma.operators.languoids import full_join, parsed_line, parsed_path
from stemma.operators.trees import carried_forward

_MEMBER = r"^\s+(.*?)\s*\[([^\]]*)\]\s*$"
#: The heading of languoids without a class. Fixed value.
UNCLASSIFIED = "Unclassified"


def numbered_lines(texts: DataFrame) -> DataFrame:
    """filename, line_no, line of whole texts (filename, text)."""
    return texts.select("filename", F.posexplode(F.split("text", r"\r?\n")).alias("line_no", "line"))


def whole(spark: SparkSession, path: str, encoding: str | None = None) -> DataFrame:
    """filename, text of each file; other encodings than UTF-8 are decoded from the bytes."""
    name = F.element_at(F.split("path", "/"), -1).alias("filename")
    data = spark.read.format("binaryFile").load(path)
    return data.select(name, "path", "length", F.col("modificationTime").alias("mtime"), F.decode("content", encoding or "UTF-8").alias("text"))


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """name, size, mtime of files, without their contents."""
    return spark.read.format("binaryFile").load(path).select(F.element_at(F.split("path", "/"), -1).alias("name"), F.col("length").alias("size"), F.col("modificationTime").alias("mtime"))


def path_members(texts: DataFrame) -> DataFrame:
    """filename, path, name, code of a classification: a line without indent is a path, indented ones are its members."""
    lines = numbered_lines(texts).where(F.trim("line") != "")
    own = lines.withColumn("own", F.when(~F.regexp_like("line", F.lit(r"^\s")), F.trim("line")))
    placed = carried_forward(own, ["filename"], "line_no", "own", "at").where("own is null")
    return placed.select("filename", F.split("at", ", ").alias("path"), F.regexp_extract("line", _MEMBER, 1).alias("name"), F.regexp_extract("line", _MEMBER, 2).alias("code"))


def path_errors(texts: DataFrame) -> DataFrame:
    """Indented lines that are no members, and members before any path."""
    lines = numbered_lines(texts).where(F.trim("line") != "")
    own = lines.withColumn("own", F.when(~F.regexp_like("line", F.lit(r"^\s")), F.trim("line")))
    placed = carried_forward(own, ["filename"], "line_no", "own", "at").where("own is null")
    return placed.where(F.col("at").isNull() | ~F.regexp_like("line", F.lit(_MEMBER))).select("filename", "line_no", "line")


def flat_languoids(texts: DataFrame, level: str) -> DataFrame:
    """Languoids of a flat file: name, id, iso, status, level, lineage (array of name and id). Comments and the unclassified are left out."""
    lines = numbered_lines(texts).where(~F.regexp_like("line", F.lit(r"^\s*(#|$)")))
    own = lines.withColumn("own", F.when(~F.regexp_like("line", F.lit(r"^\s")), F.trim("line")))
    placed = carried_forward(own, ["filename"], "line_no", "own", "at").where("own is null").where(~F.col("at").startswith(UNCLASSIFIED))
    none = "array<struct<name:string,id:string>>"
    lineage = F.when(F.col("at").endswith("[-isolate-]"), F.array().cast(none)).otherwise(parsed_path(F.col("at")))
    return placed.select(parsed_line(F.col("line")).alias("x"), F.lit(level).alias("level"), lineage.alias("lineage")).select("x.*", "level", "lineage")


def languoid_directory(spark: SparkSession, root: str, code_key: str = "code") -> DataFrame:
    """Languoids of a tree of folders ``slug.id``, each with an INI: name, id, level, iso, status, ancestors (ids, farthest first)."""
    data = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.ini").load(root)
    text = F.decode("content", "UTF-8")
    value = lambda key: F.nullif(F.trim(F.regexp_extract(text, rf"(?m)^{key}\s*[=:]\s*(.*)$", 1)), F.lit(""))
    folders = F.filter(F.split("path", "/"), lambda x: F.regexp_like(x, F.lit(r"\.[a-z0-9]{4}[0-9]{4}$")))
    ids = F.transform(folders, lambda x: F.substring_index(x, ".", -1))
    return data.select(value("name").alias("name"), value(code_key).alias("id"), value("level").alias("level"), value("iso639-3").alias("iso"), value("classification_status").alias("status"), F.slice(ids, F.lit(1), F.size(ids) - 1).alias("ancestors"))


def keyed_records(texts: DataFrame) -> DataFrame:
    """Records that four newlines part, of lines ``Key: value``: filename, record_no, fields (keys in lower case, ``_`` for blanks, ``location`` for ``locations``)."""
    each = texts.select("filename", F.posexplode(F.split(F.regexp_replace("text", r"\r\n", "\n"), r"\n\n\n\n")).alias("record_no", "record"))
    lines = F.filter(F.split("record", "\n"), lambda x: F.instr(x, ":") > 0)
    key = lambda x: F.replace(F.lower(F.trim(F.substring_index(x, ":", 1))), F.lit(" "), F.lit("_"))
    pair = lambda x: F.struct(F.when(key(x) == "locations", "location").otherwise(key(x)).alias("k"), F.trim(F.regexp_replace(x, r"^[^:]*:", "")).alias("v"))
    pairs = F.transform(lines, pair)
    last = F.filter(pairs, lambda p, i: ~F.exists(F.slice(pairs, i + 2, F.size(pairs)), lambda q: q["k"] == p["k"]))
    return each.where(F.trim("record") != "").select("filename", "record_no", F.map_from_entries(last).alias("fields"))


def typed_record(fields: Column) -> list[Column]:
    """The typed columns of a record: coordinates, lists parted by ``,`` ``;`` or ``.``, countries. Text is parsed, never evaluated."""
    at = lambda k: F.try_element_at(fields, F.lit(k))
    number = lambda i: F.regexp_extract(at("coordinates"), r"(-?\d+(?:\.\d+)?)\D+?(-?\d+(?:\.\d+)?)", i).try_cast("double")
    listed = lambda k, s: split_trimmed(at(k), s).alias(k)
    return [F.struct(number(1).alias("latitude"), number(2).alias("longitude")).alias("coordinates"), listed("alternate_names", ","), listed("dialects", ","), listed("comments", ";"), listed("location", r"\.(?:\s|$)"), listed("country", ",")]


def delimited(spark: SparkSession, path: str, columns: list[str] | None = None, sep: str = ",", header: bool = True) -> DataFrame:
    """A delimited table; with ``columns``, its header has to be just these, or it has none."""
    reader = spark.read.option("sep", sep).option("quote", '"').option("escape", '"').option("multiLine", "true")
    if columns is None:
        return reader.option("header", "true").csv(path)
    if header:
        found = reader.option("header", "true").csv(path).columns
        if found != columns:
            raise ValueError(f"header {found} instead of {columns}")
    return reader.option("header", str(header).lower()).schema(", ".join(f"`{c}` string" for c in columns)).csv(path)


def last_by_key(rows: DataFrame, key: str, order: str) -> DataFrame:
    """One row for each key, the last in order; a key's rows are summed before they meet."""
    last = rows.groupBy(key).agg(F.max_by(F.struct(*rows.columns), F.struct(order)).alias("__last"))
    return last.select("__last.*")


def natural_sorted(paths: list[str]) -> list[str]:
    """Paths in an order in which digits compare as numbers."""
    return sorted(paths, key=lambda p: [int(x) if x.isdigit() else x for x in re.split(r"(\d+)", p)])


def matching(spark: SparkSession, pattern: str) -> list[str]:
    """Files of a pattern in any store that Spark reads."""
    path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path)
    return [x.getPath().toString() for x in found or []]


def snapshots(spark: SparkSession, pattern: str, also: str | None = None) -> list[str]:
    """Files of a pattern in natural order, with those of another pattern that no file of the first has the stem of."""
    stem = lambda path: os.path.splitext(os.path.basename(path))[0]
    found = matching(spark, pattern)
    stems = {stem(x) for x in found}
    return natural_sorted(found + [x for x in (matching(spark, also) if also else []) if stem(x) not in stems])


def languoids(coordinates: DataFrame, countries: DataFrame, areas: DataFrame, names: DataFrame, classification: DataFrame) -> DataFrame:
    """One row for each ``hid`` of four tables: longitude, latitude, countries, macroarea, glottocode, name, classification.

    The tables are those of ``delimited`` with their columns hid, longitude, latitude; hid, string_agg (twice); pk, id,
    name; and hid, id, name, array_agg. ``array_agg`` lists the keys of the languoid and its ancestors, nearest first;
    the result names the ancestors from the farthest as ``name [id]``, null where there are none. An area with a comma
    raises, as do ancestors without a name, a key that is no number, and coordinates that are none. Of rows that repeat
    an ``hid``, one stays: the largest by its values.
    """
    one = lambda df, *values: df.groupBy("hid").agg(F.max(F.struct(*values)).alias("x")).select("hid", "x.*")
    number = lambda c: F.col(c).cast("double").alias(c)
    single = F.when(F.instr("string_agg", ",") > 0, F.raise_error(F.concat(F.lit("several areas: "), "string_agg"))).otherwise(F.col("string_agg"))
    listed = split_trimmed(F.col("string_agg"), ";")
    own = one(classification, "id", "name", "array_agg").select("hid", F.col("id").alias("glottocode"), "name", F.regexp_extract_all("array_agg", F.lit(r"([^\[\]\s,]+)"), F.lit(1)).cast("array<long>").alias("pks"))
    labelled = names.select(F.col("pk").cast("long").alias("pk"), F.concat("name", F.lit(" ["), "id", F.lit("]")).alias("label"))
    each = own.select("hid", F.posexplode("pks").alias("i", "pk")).where("i > 0").join(labelled, "pk", "left")
    known = F.when(F.col("label").isNull(), F.raise_error(F.concat(F.lit("no name of "), F.col("pk").cast("string")))).otherwise(F.col("label"))
    lineage = each.withColumn("label", known).groupBy("hid").agg(F.transform(F.sort_array(F.collect_list(F.struct("i", "label")), asc=False), lambda x: x["label"]).alias("classification"))
    parts = [one(coordinates, number("longitude"), number("latitude")), one(countries, listed.alias("countries")), one(areas, single.alias("macroarea")), own.drop("pks").join(lineage, "hid", "left")]
    return full_join(parts, "hid")
