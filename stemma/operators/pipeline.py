"""The batch from sources to merged, annotated and written records: match keys, stable ids, priority merge, cached by the sources' manifest."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stemma.functions import text
from stemma.lineage import cut
from stemma.operators import annotate, compare, identity, keyid, merge, resolve
from stemma.sources import bibtex, sinks

#: The field that keeps an entry's id between runs; a parameter of what reads and writes it.
ID_FIELD = "ref_id"


@dataclass
class Build:
    """Tables of one run; lookups are functions of them."""

    values: DataFrame
    files: DataFrame
    assigned: DataFrame
    rejected: DataFrame

    def raw(self, filename: str, bibkey: str) -> dict[str, str]:
        """One entry's fields; KeyError if there is none."""
        got = {r.field: r.value for r in self.values.where((F.col("filename") == filename) & (F.col("bibkey") == bibkey)).collect()}
        if not got:
            raise KeyError((filename, bibkey))
        return got

    def records(self, by: str = "id") -> DataFrame:
        """Merged records by ``id``, by ``refid`` (the earlier grouping) or by ``hash`` (the present one)."""
        own = self.values.join(self.assigned.where(F.col(by).isNotNull()).select("filename", "bibkey", by), ["filename", "bibkey"])
        return merge.merged(own, self.files, by)

    def record(self, key: int | str) -> dict[str, str]:
        """The merged fields of an earlier id (int) or a hash (str)."""
        by = "refid" if isinstance(key, int) else "hash"
        of = self.assigned.where(F.col(by) == key).select("filename", "bibkey", by)
        row = merge.merged(self.values.join(F.broadcast(of), ["filename", "bibkey"]), self.files, by).first()
        if row is None:
            raise KeyError(key)
        return dict(row.fields) | ({"ENTRYTYPE": row.entrytype} if row.entrytype is not None else {})


def values_of(entries: DataFrame) -> DataFrame:
    """The long form of entries, the entry type as a field."""
    pairs = F.map_concat(F.map_filter("fields", lambda k, _: k != "ENTRYTYPE"), F.create_map(F.lit("ENTRYTYPE"), "entrytype"))
    return entries.select("filename", "bibkey", F.explode(pairs).alias("field", "value"))


def entry_key() -> Column:
    """An entry's file and key in one value."""
    return F.concat_ws("\u0000", "filename", "bibkey")


def wide(entries: DataFrame, *more: Column) -> DataFrame:
    """Entries with the fields of match keys as columns: __key, filename, bibkey, ``more``, and the fields."""
    names = ["author", "editor", "title", "year", "volume", "journal", "booktitle", "series", "extra_hash"]
    names += [f for f in keyid.FIELD_ORDER if f not in names]
    return entries.select(entry_key().alias("__key"), "filename", "bibkey", *more, *[_at(n).alias(n) for n in names])


def build(entries: DataFrame, files: DataFrame, similar: bool = True, id_field: str = ID_FIELD) -> Build:
    """Keys, ids and values of all entries. Earlier ids that are no numbers are rejected and count as none."""
    unknown = entries.select("filename").distinct().join(files, "filename", "left_anti")
    if not unknown.isEmpty():
        raise ValueError("entries of files without a priority")
    keyed = keyid.keyed(wide(entries, _at(id_field).alias("__ref")), "__key")
    refid = F.col("__ref").try_cast("long")
    own = cut(keyed.select("filename", "bibkey", "__ref", refid.alias("refid"), "hash"))
    rejected = own.where("__ref is not null and refid is null").select("filename", "bibkey", F.col("__ref").alias("value"))
    values = values_of(entries)
    plain = own.select("filename", "bibkey", "refid", "hash")
    assigned = cut(resolve.resolved(plain, values, files) if similar else identity.assign_ids(plain))
    return Build(values, files, assigned, rejected)


def cached(spark: SparkSession, folder: str, found: DataFrame, make) -> DataFrame:
    """The table in ``folder``, made anew by ``make()`` if the manifest there isn't that of the files found (name, size, mtime)."""
    try:
        if compare.stale(spark.read.parquet(f"{folder}/manifest"), found).isEmpty():
            return spark.read.parquet(f"{folder}/table")
    except Exception as problem:  # noqa: BLE001
        if "PATH_NOT_FOUND" not in str(problem):
            raise
    make().write.mode("overwrite").parquet(f"{folder}/table")
    found.write.mode("overwrite").parquet(f"{folder}/manifest")
    return spark.read.parquet(f"{folder}/table")


def with_priorities(files: DataFrame, new: DataFrame) -> DataFrame:
    """New priorities for the same files; other files raise."""
    if not compare.equal(files.select("filename"), new.select("filename")):
        raise ValueError("other files than before")
    return new


@dataclass
class Annotation:
    """Configuration that merged records are annotated by."""

    #: code, area
    areas: DataFrame
    #: Rules (annotate.RULES) that give a type, class ``hhtype``.
    kinds: DataFrame
    #: Rules that give language codes, class ``lgcode``.
    codes: DataFrame
    #: word, label: the languages that titles are in.
    labels: DataFrame
    #: kind, place: the highest type has the largest.
    types: DataFrame


def _at(name: str) -> Column:
    return F.try_element_at("fields", F.lit(name))


def _with_field(records: DataFrame, values: DataFrame, name: str) -> DataFrame:
    """``records`` with the values (key, value) in the field ``name``, in place of an earlier one."""
    rest = F.map_filter("fields", lambda k, _: k != name)
    new = F.when(F.col("value").isNull(), F.col("fields")).otherwise(F.map_concat(rest, F.create_map(F.lit(name), "value")))
    return records.join(values.select("key", "value"), "key", "left").withColumn("fields", new).drop("value")


def with_areas(records: DataFrame, areas: DataFrame) -> DataFrame:
    """``records`` (key, fields) with ``macro_area`` from their language codes, where these have areas."""
    codes = F.coalesce(text.language_codes(_at("lgcode")), F.array().cast("array<string>"))
    found = annotate.looked_up(records.select("key", codes.alias("codes")), "key", "codes", areas, "code", "area")
    return _with_field(records, found.withColumnRenamed("areas", "value"), "macro_area")


def with_title_language(records: DataFrame, labels: DataFrame) -> DataFrame:
    """``records`` (key, fields) with ``inlg`` where the words of title and book title have one label; records that have ``inlg`` or no title stay."""
    free = records.where(_at("title").isNotNull() & _at("inlg").isNull())
    ws = F.concat(text.words(_at("title")), text.words(F.coalesce(_at("booktitle"), F.lit(""))))
    found = annotate.unique_label(free.select("key", ws.alias("ws")), "key", "ws", labels)
    return _with_field(records, found.withColumnRenamed("label", "value"), "inlg")


def annotated(records: DataFrame, reference: DataFrame, by: Annotation) -> tuple[DataFrame, DataFrame]:
    """Records (key, fields, others) with areas, types, codes and title languages, and the log of what was taken back.

    In this order: areas of the codes that are there; types by rules; codes by rules; languages of titles. After types
    and after codes, the type of each record goes that would raise a language over its status in ``reference`` (key,
    fields); the log has a row for each: step, language, before, after, value, key. Null fields are no fields.
    """
    empty = F.create_map().cast("map<string,string>")
    languages = lambda fields: F.coalesce(text.language_codes(F.try_element_at(fields, F.lit("lgcode"))), F.array().cast("array<string>"))
    kinds = lambda fields: F.coalesce(text.type_names(F.try_element_at(fields, F.lit("hhtype"))), F.array().cast("array<string>"))
    own = cut(with_areas(records.withColumn("fields", F.coalesce("fields", empty)), by.areas))
    logs = []
    for step, rules in (("hhtype", by.kinds), ("lgcode", by.codes)):
        # Both the records and their witnesses are read from it.
        marked = cut(annotate.marked(own, rules, text.words))
        own, log = annotate.conservative(marked, reference, languages, kinds, by.types, "hhtype")
        logs.append(log.select(F.lit(step).alias("step"), "*"))
        own = cut(own)
    return with_title_language(own, by.labels), logs[0].unionByName(logs[1])


def run(entries: DataFrame, files: DataFrame, reference: str, by: Annotation, folder: str, similar: bool = True, id_field: str = ID_FIELD) -> tuple[Build, DataFrame]:
    """The whole batch into a new ``folder``; the build, and how many ids were added and changed in each file.

    ``entries`` are (filename, entry_pos, bibkey, entrytype, fields), ``files`` (filename, priority); ``reference`` is
    the file whose types no rule may raise. The folder gets ``ids`` (mapping as CSV), ``replacements`` (JSON),
    ``entries`` (changed files as BibTeX), ``log`` (types taken back, TSV) and ``merged`` (BibTeX by match key, with the
    id in ``id_field``). An entry whose earlier id is no number raises before anything is written.
    """
    built = build(entries, files, similar, id_field)
    if not built.rejected.isEmpty():
        raise ValueError("entries with earlier ids that are no numbers")
    keys = built.assigned.where("id is not null").groupBy("id").agg(F.min("hash").alias("hash"))
    named = F.map_concat(F.map_filter("fields", lambda k, _: k != id_field), F.create_map(F.lit(id_field), F.col("id").cast("string")))
    records = built.records("id").join(keys, "id").select(F.coalesce("hash", F.col("id").cast("string")).alias("key"), "entrytype", named.alias("fields"))
    model = entries.where(F.col("filename") == reference).select(F.col("bibkey").alias("key"), "fields")
    out, log = annotated(records, model, by)
    sinks.mapping(built.assigned, f"{folder}/ids")
    sinks.replacement_pairs(identity.replacements(built.assigned), f"{folder}/replacements")
    changes = sinks.write_back(entries, built.assigned, f"{folder}/entries", id_field)
    sinks.delimited(log, f"{folder}/log", "\t")
    bibtex.write(out.withColumnRenamed("key", "bibkey"), f"{folder}/merged")
    return built, changes
