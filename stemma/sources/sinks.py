"""Sinks. Each writes a new folder and never over its sources."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stemma.joins import few
from stemma.operators import references
from stemma.operators.languoids import group_heading, language_line
from stemma.sources import bibtex, text_files


def mapping(assigned: DataFrame, path: str) -> None:
    """filename, bibkey, hash, id as CSV in order of the lower-case names."""
    ordered = assigned.select("filename", "bibkey", "hash", F.col("id").cast("string").alias("id")).orderBy(F.lower("filename"), F.lower("bibkey"))
    ordered.write.option("header", "true").csv(path)


def replacement_pairs(pairs: DataFrame, path: str) -> None:
    """id, replacement as JSON, one object a line, in order of the ids."""
    pairs.orderBy("id").write.json(path)


def replacement_array(pairs: DataFrame) -> DataFrame:
    """The same as one JSON array; for lists that fit into a row."""
    return pairs.agg(F.to_json(F.array_sort(F.collect_list(F.struct("id", "replacement")))).alias("value"))


def delimited(rows: DataFrame, path: str, sep: str = ",", order: list[str] | None = None) -> None:
    out = rows.orderBy(*[F.lower(c) for c in order]) if order else rows
    out.write.option("header", "true").option("sep", sep).option("quote", '"').option("escape", '"').csv(path)


def versions(rows: DataFrame, path: str) -> None:
    """Entries by version, a folder for each."""
    rows.write.partitionBy("version").parquet(path)


def written_back(entries: DataFrame, assigned: DataFrame, field: str = "ref_id") -> DataFrame:
    """The entries of files with a changed id, with the new id in ``field``; the old one has to be what the entry has.

    Columns: filename, entry_pos, bibkey, entrytype, fields, conflict (the entry's id isn't the earlier one).
    """
    delta = assigned.where(~F.col("id").eqNullSafe(F.col("refid"))).select("filename", "bibkey", "refid", "id")
    touched = entries.join(few(delta.select("filename").distinct()), "filename", "left_semi")
    j = touched.join(delta, ["filename", "bibkey"], "left")
    rest = F.map_filter("fields", lambda k, _: k != field)
    new = F.when(F.col("id").isNull(), F.col("fields")).otherwise(F.map_concat(rest, F.create_map(F.lit(field), F.col("id").cast("string"))))
    conflict = F.col("id").isNotNull() & ~F.try_element_at("fields", F.lit(field)).try_cast("long").eqNullSafe(F.col("refid"))
    return j.select("filename", "entry_pos", "bibkey", "entrytype", new.alias("fields"), conflict.alias("conflict"))


def write_back(entries: DataFrame, assigned: DataFrame, path: str, field: str = "ref_id") -> DataFrame:
    """Write the changed files as BibTeX, a folder for each, and return how many ids were added and changed; conflicts raise."""
    out = written_back(entries, assigned, field)
    if not out.where("conflict").isEmpty():
        raise ValueError("entries have other ids than the earlier ones")
    text = out.select("filename", "entry_pos", bibtex.entry_text(F.col("entrytype"), F.col("bibkey"), F.col("fields")).alias("value"))
    # Hashing by file alone would bring a large file's text into one task; a range of places keeps its order over several.
    text.repartitionByRange("filename", "entry_pos").sortWithinPartitions("filename", "entry_pos").drop("entry_pos").write.partitionBy("filename").text(path)
    changed = assigned.where(~F.col("id").eqNullSafe(F.col("refid")))
    return changed.groupBy("filename").agg(F.count_if(F.col("refid").isNull()).alias("added"), F.count_if(F.col("refid").isNotNull()).alias("changed"))


def contributor_tables(entries: DataFrame, field: str = "ref_id") -> tuple[DataFrame, DataFrame]:
    """Tables for a relational store: entries with their fields as JSON, and one row for each name with its role and place from 1."""
    import pandas as pd

    from stemma.functions.names import bibtex_names

    at = lambda k: F.try_element_at("fields", F.lit(k)).alias(k)
    entry = entries.select("filename", "bibkey", "entrytype", F.to_json("fields").alias("fields"), F.try_element_at("fields", F.lit(field)).try_cast("long").alias("ref_id"), at("author"), at("editor"), at("year"), at("title"))
    roles = F.map_filter("fields", lambda k, _: k.isin("author", "editor"))

    def parted(batches):
        for batch in batches:
            out = [(f, b, r, i, *n) for f, b, r, text in zip(batch["filename"], batch["bibkey"], batch["role"], batch["names"]) for i, n in enumerate(bibtex_names(text), 1)]
            yield pd.DataFrame(out, columns=["filename", "bibkey", "role", "index", "prelast", "last", "given", "lineage"])

    names = entries.select("filename", "bibkey", F.explode(roles).alias("role", "names"))
    return entry, names.mapInPandas(parted, "filename string, bibkey string, role string, index long, prelast string, last string, given string, lineage string")


def jdbc(df: DataFrame, url: str, name: str, **options: str) -> None:
    """Load a table into a relational store, where its driver is on the class path."""
    df.write.format("jdbc").options(url=url, dbtable=name, **options).mode("append").save()


def flat_languoids(languoids: DataFrame) -> DataFrame:
    """Lines of the flat form (level, group, place, value), headings before their members; columns name, id, iso, status, level, lineage."""
    group = group_heading(F.col("level"), F.col("name"), F.col("lineage"))
    own = languoids.select("level", group.alias("group"), F.lit(1).alias("place"), language_line(F.col("name"), F.col("id"), F.col("iso"), F.col("status")).alias("value"))
    heads = own.select("level", "group").distinct().select("level", "group", F.lit(0).alias("place"), F.col("group").alias("value"))
    return heads.unionByName(own).orderBy("level", "group", "place", "value")


def languoid_tree(flat: DataFrame, code_key: str = "code") -> DataFrame:
    """Target folder and INI text of each languoid of a flat file: path, value."""
    from stemma.functions.text import slug

    step = lambda name, code: F.concat(slug(name), F.lit("."), code)
    folders = F.concat(F.transform("lineage", lambda x: step(x["name"], x["id"])), F.array(step(F.col("name"), F.col("id"))))
    lines = F.array_compact(F.array(F.lit("[core]"), F.concat(F.lit("name = "), "name"), F.concat(F.lit(f"{code_key} = "), "id"), F.concat(F.lit("level = "), "level"), F.when(F.coalesce("iso", F.lit("")) != "", F.concat(F.lit("iso639-3 = "), "iso")), F.when(F.coalesce("status", F.lit("")) != "", F.concat(F.lit("classification_status = "), "status"))))
    last = step(F.col("name"), F.col("id"))
    return flat.select(F.concat(F.array_join(folders, "/"), F.lit("/"), last, F.lit(".ini")).alias("path"), F.concat(F.array_join(lines, "\n"), F.lit("\n")).alias("value"))


def write_files(files: DataFrame, root: str) -> None:
    """Write rows (path, value) as files under ``root``, each by the task that has its row."""
    text_files.write(files, root)


def translated_table(rows: DataFrame, text: str, ids: DataFrame, path: str, order: list[str]) -> None:
    """A table of justifications with ids in place of the keys of its references, as TSV beside the original: ``x.tab`` becomes ``x-ids.tab``. Unknown keys raise."""
    stem, dot, end = path.rpartition(".")
    out = references.translated(rows, text, ids, strict=True).orderBy(*order)
    out.write.option("sep", "\t").option("header", "false").csv(f"{stem}-ids{dot}{end}" if dot else f"{path}-ids")
