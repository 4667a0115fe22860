"""Match keys: names of the authors, the rarest words of the title, volume and year."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import SparkContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stemma.functions import names, scalar
from stemma.functions import text as fn
from stemma.joins import HOT_KEYS, HOT_ROWS
from stemma.lineage import cut

#: The order of fields in an entry. Fixed values.
FIELD_ORDER = ["author", "editor", "title", "booktitle", "journal", "school", "publisher", "address", "series", "volume", "number", "pages", "year", "issn", "url"]
#: Buckets of the summary of word frequencies, 16 MB, and the frequency of a word that has none.
BUCKETS, UNKNOWN = 1 << 20, 2**62
_PLAIN_FIELDS = ["author", "editor", "title", "year", "volume", "journal", "booktitle", "series", "extra_hash"]


def word_frequencies(entries: DataFrame, title: str = "title") -> DataFrame:
    """word, n: how often each word occurs in titles."""
    return entries.select(F.explode(fn.words(F.col(title))).alias("word")).groupBy("word").agg(F.count("*").alias("n"))


def bucket_ranges(frequencies: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """The least and the largest frequency of the words of each bucket of their hashes: ``buckets`` rows, whatever there are of words."""
    out = np.full((buckets, 2), UNKNOWN)
    found = frequencies.groupBy(_bucket(F.col("word"), buckets).alias("bucket")).agg(F.min("n").alias("lo"), F.max("n").alias("hi"))
    table = found.toArrow()
    out[table["bucket"].to_numpy()] = np.column_stack([table["lo"].to_numpy(), table["hi"].to_numpy()])
    return out


def _bucket(word: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(word), F.lit(buckets)).cast("int")


def possible_places(titles: pa.Array, known: np.ndarray, count: int) -> pa.Array:
    """Of each title's buckets the places of ``_possible``. A batch stays one flat array; a title's ranges are taken alone."""
    ends = np.cumsum(pc.fill_null(pc.list_value_length(titles), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    flat, out, start = titles.flatten().to_numpy(), [], 0
    for end in ends:
        lo, hi = known[flat[start:end]].T
        out.append((np.flatnonzero(lo <= np.partition(hi, count - 1)[count - 1]) if len(lo) > count else np.arange(len(lo))).astype(np.int32))
        start = end
    offsets = np.cumsum([0, *map(len, out)], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([np.zeros(0, np.int32), *out])))


def _possible(context: SparkContext, ranges: np.ndarray, count: int):
    """A function of a title's buckets: the places of words that can be among the ``count`` rarest, by the ranges of their buckets."""
    shared = context.broadcast(ranges)

    def places(titles: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in titles:
            yield possible_places(batch, shared.value, count)

    return F.arrow_udf(places, T.ArrayType(T.IntegerType()))


def ranked(entries: DataFrame, key: str, frequencies: DataFrame, count: int = 2, title: str = "title", complete: bool = False, buckets: int = BUCKETS) -> DataFrame:
    """key, best: the ``count`` rarest distinct words of a title as (n, i, word), of equally rare ones the earlier.

    Words without a frequency are the most frequent ones. If ``complete``, all words have one; then a summary of the
    frequencies of a fixed size, which goes to all tasks, tells which words of a title can be among its rarest, and only those
    are joined with their frequencies. The rows of very frequent words among them, HOT_KEYS words at most, don't move, nor do
    those of titles of ``count`` words or fewer, where nothing is to be decided: their words have UNKNOWN as n. Titles
    without words have no row.
    """
    frequencies = cut(frequencies.where("word is not null"))
    limit = max(HOT_ROWS, frequencies.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0] // HOT_KEYS)
    types = entries.select(key, fn.title_types(F.col(title)).alias("types")).withColumn("few", F.size("types") <= count)
    if complete:
        can = _possible(entries.sparkSession.sparkContext, bucket_ranges(frequencies, buckets), count)
        types = types.withColumn("places", can(F.transform("types", lambda w: _bucket(w, buckets))))
        each = types.select(key, "few", "types", F.explode("places").alias("i")).select(key, "few", "i", F.get("types", F.col("i")).alias("word"))
    else:
        each = types.select(key, "few", F.posexplode("types").alias("i", "word"))
    # The words' own rows are spread where they are told by all executors, as they meet nothing in the other join.
    hot = F.broadcast(frequencies.where(F.col("n") > limit).select("word", F.col("n").alias("hot")))
    salt = F.when(F.col("hot").isNull() & ~F.col("few"), F.lit(0)).otherwise(1 + F.pmod(F.xxhash64(key, "i"), F.lit(1 << 16))).cast("long")
    each = each.join(hot, "word", "left").withColumn("salt", salt)
    rest = frequencies.where(F.col("n") <= limit).withColumn("salt", F.lit(0).cast("long"))
    told = each.join(rest, ["word", "salt"], "left").withColumn("n", F.when(F.col("few"), F.lit(UNKNOWN)).otherwise(F.coalesce("hot", "n", F.lit(UNKNOWN))))
    # The window's rank is cut off before and after the shuffle, so no more than these rows of a title meet.
    told = told.withColumn("rank", F.row_number().over(Window.partitionBy(key).orderBy("n", "i"))).where(F.col("rank") <= count)
    return told.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("n", "i", "word"))).alias("best"))


def in_title_order(best: str = "best") -> Column:
    """The words of ``best`` in the order of the title."""
    return F.transform(F.array_sort(F.transform(best, lambda x: F.struct(x["i"].alias("i"), x["word"].alias("word")))), lambda x: x["word"])


def rarest(entries: DataFrame, key: str, frequencies: DataFrame, count: int = 2, title: str = "title", complete: bool = False) -> DataFrame:
    """key, rarest: the ``count`` rarest distinct words of a title, as ``ranked`` gives them, in title order; titles without words have no row."""
    return ranked(entries, key, frequencies, count, title, complete).select(key, in_title_order().alias("rarest"))


@F.pandas_udf(T.StringType())
def author_key_of(values: pd.Series) -> pd.Series:
    return values.map(lambda x: None if x is None else names.author_key(x))


def keyed(entries: DataFrame, key: str, frequencies: DataFrame | None = None, best: DataFrame | None = None) -> DataFrame:
    """``entries`` with ``hash``; columns that aren't there count as missing fields. ``best`` are the rarest words, as ``ranked`` gives them, if known.

    A missing title is ``no.title``. The volume counts only outside journals, books and series. Entries with neither
    author nor editor get a key of all their values in field order, which matches only its like.
    """
    have = entries.select("*", *[F.lit(None).cast("string").alias(x) for x in _PLAIN_FIELDS if x not in entries.columns])
    titled = have.withColumn("title", F.coalesce("title", F.lit("no.title")))
    if best is None and frequencies is None:
        best = ranked(titled, key, word_frequencies(have), complete=True)
    elif best is None:
        best = ranked(titled, key, frequencies)
    out = titled.join(best.select(key, in_title_order().alias("rarest")), key, "left")
    volume = F.when(F.coalesce("journal", "booktitle", "series").isNull(), scalar.roman_of("volume"))
    contributor = F.coalesce("author", "editor")
    text = F.concat(author_key_of(contributor), F.lit("_"), F.coalesce(F.array_join("rarest", "-"), F.lit("")), F.coalesce(volume, F.lit("")), fn.year_key(F.col("year")), F.coalesce("extra_hash", F.lit("")))
    values = F.concat_ws("", *[F.col(x) for x in FIELD_ORDER if x in entries.columns])
    missing = F.concat(F.lit("__missingcontrib__"), F.regexp_replace(F.lower(values), r"[^a-z\d\-_\[\]]", "_"))
    known = F.regexp_replace(F.lower(text), r"[^a-z\d\-_\[\]]", "")
    return out.select(*entries.columns, F.when(contributor.isNull(), missing).otherwise(known).alias("hash"))


def key_of(fields: dict[str, str], frequencies: dict[str, int] | None = None, count: int = 2, id_field: str = "ref_id") -> str:
    """The same key of one entry's fields, in Python; for checks and small sets."""
    strip = lambda c, x: re.sub(r"[^a-z\d\-_\[\]]", c, x.lower())
    who = fields.get("author", fields.get("editor"))
    if who is None:
        order = sorted((f for f in fields if f != id_field), key=lambda f: (FIELD_ORDER.index(f) if f in FIELD_ORDER else len(FIELD_ORDER), f))
        return "__missingcontrib__" + strip("_", "".join(fields[f] for f in order))
    bare = scalar.undiacritic(fields.get("title", "no.title").lower()).replace("'", "").replace('"', "")
    types = list(dict.fromkeys(w for w in re.split(fn.WORD_BREAK, bare) if re.match(r"[a-zA-Z].", w)))
    rank = lambda w: ((frequencies or {}).get(w, float("inf")), types.index(w))
    chosen = sorted(sorted(types, key=rank)[:count], key=types.index)
    plain = not {"journal", "booktitle", "series"} & fields.keys()
    volume = scalar.roman(fields["volume"]) if "volume" in fields and plain else ""
    return strip("", names.author_key(who) + "_" + "-".join(chosen) + volume + _year(fields.get("year", "[nd]"))[:4] + fields.get("extra_hash", ""))


def _year(text: str) -> str:
    found = re.search(r"\[([\d,\-/]+)\]", text)
    parts = [x for x in re.split(r"[,\-/\s\[\]]+", found[1] if found else text) if x.strip()]
    if len(parts) < 2:
        return parts[0] if parts else "[nd]"
    first, last = parts[0], parts[-1]
    return f"{first}-{first[: max(0, len(first) - len(last))]}{last}"
