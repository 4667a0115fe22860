"""A build that is kept up to date: only what a change reaches is hashed, numbered and merged anew.

A state has generations of four tables in a shared folder: ``entries`` (with match keys and ids), ``words`` (their
frequencies in titles), ``records`` (merged by id) and ``files`` (with priorities). A change of some files goes through them
like this: entries whose content differs; words whose frequency differs; entries of other files whose rarest words these
decide; the groups by match key and earlier id of all entries whose key or content is another now; the groups that share
entries with these; the new numbers; the ids whose entries or numbers changed; their records. Each step joins the stored
tables with the keys of the step before, which are sent to all executors where they are few, so the stored rows don't
move. A generation counts once its commit is written, so one that was broken off is never read.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stemma.functions import text
from stemma.joins import few
from stemma.lineage import cut
from stemma.operators import identity, keyid, merge, pipeline, resolve

KEY = ["filename", "bibkey"]
#: Columns of entries as they are read, those that make up the match key, and those of the ids.
_READ = [*KEY, "entrytype", "fields", "content", "refid"]
_KEYED = ["types", "chosen", "last", "hash"]
_IDS = ["srefid", "id", "fresh"]


def some(df: DataFrame, keys: DataFrame, on: list[str]) -> DataFrame:
    """The rows of ``df`` whose key is among ``keys``."""
    return df.join(few(keys.select(*on)), on, "left_semi")


def others(df: DataFrame, keys: DataFrame, on: list[str]) -> DataFrame:
    """The rows of ``df`` whose key isn't among ``keys``; keys and rows without nulls."""
    return df.join(few(keys.select(*on)), on, "left_anti")


def _keys(column: str, *tables: tuple[DataFrame, str]) -> DataFrame:
    """The distinct values of columns of several tables, without null."""
    out = None
    for df, name in tables:
        one = df.select(F.col(name).alias(column)).where(F.col(column).isNotNull())
        out = one if out is None else out.unionByName(one)
    return cut(out.distinct())


def read_entries(entries: DataFrame, id_field: str) -> DataFrame:
    """Entries (filename, bibkey, entrytype, fields) with a digest of their content and their earlier id, null if it is no number."""
    fields = F.coalesce("fields", F.create_map().cast("map<string,string>"))
    digest = F.sha2(F.to_json(F.struct(F.col("entrytype"), F.array_sort(F.map_entries(fields)).alias("fields"))), 256)
    return entries.select(*KEY, "entrytype", fields.alias("fields"), digest.alias("content"), F.try_element_at(fields, F.lit(id_field)).try_cast("long").alias("refid"))


def hashed(read: DataFrame, frequencies: DataFrame) -> DataFrame:
    """Read entries with their match key and what decides it: the distinct words of the title, those chosen, and the frequency of the last chosen."""
    wide = cut(pipeline.wide(read))
    best = keyid.ranked(wide.withColumn("title", F.coalesce("title", F.lit("no.title"))), "__key", frequencies, complete=True)
    own = keyid.keyed(wide, "__key", best=best).select("__key", "hash").join(best, "__key", "left")
    own = own.select("__key", "hash", F.coalesce(F.transform("best", lambda x: x["word"]), F.array().cast("array<string>")).alias("chosen"), F.coalesce(F.array_max(F.transform("best", lambda x: x["n"])), F.lit(keyid.UNKNOWN)).alias("last"))
    types = F.coalesce(text.title_types(F.try_element_at("fields", F.lit("title"))), F.array().cast("array<string>"))
    return read.withColumn("__key", pipeline.entry_key()).join(own, "__key").select(*_READ, types.alias("types"), "chosen", "last", "hash")


def title_words(read: DataFrame) -> DataFrame:
    """word, n of the titles of read entries."""
    return keyid.word_frequencies(read.select(F.try_element_at("fields", F.lit("title")).alias("title")))


@dataclass
class State:
    """The generations in ``folder``; with ``similar``, splits and merges are decided by likeness, else by the tie rules."""

    spark: SparkSession
    folder: str
    similar: bool = True
    id_field: str = pipeline.ID_FIELD

    def generation(self) -> int | None:
        """The last one that was committed, None if there is none."""
        root = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/commits")
        if not root.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(root):
            return None
        return self.spark.read.schema("generation long, place string").json(f"{self.folder}/commits").agg(F.max("generation")).first()[0]

    def table(self, name: str) -> DataFrame:
        """A table of the last generation: entries, words, records or files."""
        commits = self.spark.read.schema("generation long, place string").json(f"{self.folder}/commits")
        place = commits.agg(F.max_by("place", "generation")).first()[0]
        return self.spark.read.parquet(f"{self.folder}/{place}/{name}")

    def assigned(self) -> DataFrame:
        return self.table("entries").select(*KEY, "refid", "hash", "srefid", "id")

    def _commit(self, entries: DataFrame, words: DataFrame, files: DataFrame, records) -> None:
        place, number = uuid.uuid4().hex, (self.generation() or 0) + 1
        at = f"{self.folder}/{place}"
        entries.select(*_READ, *_KEYED, *_IDS).write.parquet(f"{at}/entries")
        words.write.parquet(f"{at}/words")
        files.select("filename", "priority").write.parquet(f"{at}/files")
        records(self.spark.read.parquet(f"{at}/entries"), self.spark.read.parquet(f"{at}/files")).write.parquet(f"{at}/records")
        self.spark.createDataFrame([(number, place)], "generation long, place string").coalesce(1).write.mode("append").json(f"{self.folder}/commits")

    def _picks(self, entries: DataFrame, files: DataFrame) -> tuple[identity.Pick, identity.Pick]:
        if not self.similar:
            return identity.least_hash, identity.largest_ref
        return resolve.picks(entries.select(*KEY, "refid", "hash"), pipeline.values_of(entries), files)

    def build(self, entries: DataFrame, files: DataFrame) -> None:
        """A generation made from all entries. A key (filename, bibkey) has one entry."""
        read = cut(read_entries(entries, self.id_field))
        words = cut(title_words(read))
        own = cut(hashed(read, words))
        pick_hash, pick_ref = self._picks(own, files)
        settled = cut(identity.settled(cut(identity.separated(own, pick_hash)), pick_ref))
        ids = identity.renumbered(settled, _first(own))
        self._commit(own.join(ids.select(*KEY, *_IDS), KEY), words, files, _records_of)

    def update(self, entries: DataFrame, names: DataFrame, files: DataFrame) -> None:
        """A generation after a change: ``entries`` is all that the files ``names`` (filename) have now, ``files`` the priorities of all files now.

        A file of ``names`` without entries is gone, or empty. Files whose priority is another one are merged anew, and
        entries of files that ``files`` doesn't have are an error, as in a build.
        """
        before, words, records, ranks = (self.table(x) for x in ("entries", "words", "records", "files"))
        names = cut(names.select("filename").distinct())
        read = cut(some(read_entries(entries, self.id_field), names, ["filename"]))
        held = some(before, names, ["filename"])
        both = held.select(*KEY, F.col("content").alias("was")).join(read.select(*KEY, "content"), KEY, "full_outer")
        changed = cut(both.where(~F.col("was").eqNullSafe(F.col("content"))).select(*KEY))
        gone, come = cut(some(before, changed, KEY)), cut(some(read, changed, KEY))
        present = others(before.select("filename").distinct(), names, ["filename"]).unionByName(read.select("filename").distinct())
        if not present.join(files, "filename", "left_anti").isEmpty():
            raise ValueError("entries of files without a priority")

        # Words, and the entries whose rarest words they decide.
        delta = title_words(come).unionByName(title_words(gone).withColumn("n", -F.col("n"))).groupBy("word").agg(F.sum("n").alias("by")).where(F.col("by") != 0)
        delta = cut(delta)
        delta = cut(delta.join(cut(some(words, delta, ["word"])), "word", "left").select("word", "by", (F.coalesce("n", F.lit(0)) + F.col("by")).alias("n")))
        words = others(words, delta, ["word"]).unionByName(delta.where("n > 0").select("word", "n"))
        kept = others(before, changed, KEY)
        told = kept.where(F.col("last") < keyid.UNKNOWN).select(*KEY, "chosen", "last", F.explode("types").alias("word")).join(few(delta), "word")
        chosen = F.array_contains("chosen", F.col("word"))
        reached = cut(told.where((chosen & (F.col("by") > 0)) | (~chosen & (F.col("by") < 0) & (F.col("n") <= F.col("last")))).select(*KEY).distinct())
        again = cut(come.unionByName(some(kept, reached, KEY).select(*_READ)))
        asked = _keys("word", (again.select(F.explode(text.title_types(F.try_element_at("fields", F.lit("title")))).alias("word")), "word"))
        keyed = hashed(again, cut(some(words, asked, ["word"])))
        old = cut(some(before, again, KEY).select(*KEY, F.col("content").alias("was"), F.col("hash").alias("was_hash"), *_IDS))
        keyed = cut(keyed.join(old, KEY, "left").withColumn("new", ~F.col("content").eqNullSafe(F.col("was")) | ~F.col("hash").eqNullSafe(F.col("was_hash"))))
        # What an entry was given before its content or key changed doesn't stand.
        given = [F.when(~F.col("new"), F.col(c)).alias(c) for c in _IDS]
        now = others(kept, reached, KEY).unionByName(keyed.select(*_READ, *_KEYED, *given))

        # The groups that these entries were and are in, and those that share entries with them.
        moved = ranks.join(files.withColumnRenamed("priority", "now"), "filename").where("priority <> now").select("filename")
        other = some(now, cut(moved), ["filename"])
        left = some(before, keyed.where("new"), KEY).unionByName(others(gone, keyed, KEY))
        dirty = [keyed.where("new"), left, other]
        hashes = _keys("hash", *[(d, "hash") for d in dirty])
        refs = _keys("refid", *[(d, "refid") for d in dirty], (some(now, hashes, ["hash"]), "refid"))
        hashes = _keys("hash", (hashes, "hash"), (some(now, refs, ["refid"]), "hash"))
        near = _keys("refid", (refs, "refid"), (some(now, hashes, ["hash"]), "refid"))
        marks = [few(k.select(c, F.lit(True).alias(m))) for k, c, m in ((hashes, "hash", "of_hash"), (near, "refid", "of_near"), (refs, "refid", "of_ref"))]
        context = now
        for c, m in zip(("hash", "refid", "refid"), marks):
            context = context.join(m, c, "left")
        context = cut(context.where("of_hash or of_near"))

        # Their ids. The earlier ids left to entries of other groups stand.
        pick_hash, pick_ref = self._picks(context, files)
        parted = identity.separated(cut(context.where("of_ref").select(*KEY, "refid", "hash")), pick_hash)
        stand = context.where("of_hash and of_ref is null").select(*KEY, "refid", "hash", "srefid")
        settled = cut(identity.settled(cut(parted.unionByName(stand)), pick_ref))
        payload = context.select(*_READ, "types", "chosen", "last", "hash")
        touched = cut(payload.join(settled.select(*KEY, *_IDS), KEY))
        rest = others(now, touched, KEY)
        after = rest.unionByName(touched.select(*rest.columns))
        waiting = cut(after.where("fresh").select(*KEY, "hash", "id"))
        numbers = cut(identity.numbered_by(waiting, "hash", _first(after)))
        renamed = cut(waiting.join(numbers, "hash").where(~F.col("id").eqNullSafe(F.col("number"))).select(*KEY, "id", "number"))
        after = after.join(few(renamed.select(*KEY, "number")), KEY, "left").withColumn("id", F.coalesce("number", "id")).drop("number")
        ids = _keys("id", (touched, "id"), (some(before, touched, KEY), "id"), (gone, "id"), (renamed, "id"), (renamed, "number"))
        self._commit(after, words, files, lambda e, f: others(records, ids, ["id"]).unionByName(_records_of(some(e, ids, ["id"]), f)))


def _first(entries: DataFrame) -> int:
    return entries.agg(F.coalesce(F.max("refid"), F.lit(0)) + 1).first()[0]


def _records_of(entries: DataFrame, files: DataFrame) -> DataFrame:
    """Merged records of entries with ids: id, entrytype, fields."""
    own = pipeline.values_of(entries).join(entries.where("id is not null").select(*KEY, "id"), KEY)
    return merge.merged(own, files)
