"""Benchmark decontamination with DataFrame functions alone: a prefix-filtered containment join of item windows and texts.

A window is WINDOW consecutive words of an item (all words of a shorter one), seen as the set of its SHINGLE-word
shingles. A text holds a window only if it holds every one of its shingles, so the necessary prefix is one shingle: the
rarest, by how many windows hold it and how rare its rarest word is among the items. Neighbouring windows mostly have
the same prefix. Texts are probed for the prefix shingles alone: a table of bits of a fixed size lets through the places
whose shingle may be one, with the words around them; these places are joined with the prefixes by the shingle's hash;
places where the window doesn't fit into the text (position and length bounds) go; and the rest are verified word for
word.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stemma.llm.storage import cut, small, without

WINDOW = 13
SHINGLE = 5
#: Most bits of the table that texts are probed with; with more prefixes than this it lets more places through, and none less.
BITS = 1 << 22
_PARTING = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words(text: Column) -> Column:
    """Words of a text, A-Z lower-cased; none for null."""
    t = F.coalesce(text.cast("string"), F.lit(""))
    low = F.when(F.octet_length(t) == F.char_length(t), F.lower(t)).otherwise(F.translate(t, _UPPER, _LOWER))
    return F.array_remove(F.split(low, _PARTING), "")


def _key(w: Column, i: Column, size: int) -> Column:
    """Hash of the ``size`` words from place ``i``."""
    return F.xxhash64(*[F.get(w, i + k) for k in range(size)])


def windows(items: DataFrame, window: int = WINDOW, shingle: int = SHINGLE) -> DataFrame:
    """Distinct windows: ``window`` (its words, blank-joined), ``v`` (its words), ``len``, ``size`` of its shingles, ``items`` (sorted ids as strings, a null id as the empty one)."""
    w = items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), words(F.col("text")).alias("w")).withColumn("n", F.size("w")).where("n > 0")
    starts = F.sequence(F.lit(0), F.greatest(F.col("n") - window, F.lit(0)))
    each = w.select("item", F.least("n", F.lit(window)).alias("len"), F.explode(F.transform(starts, lambda s: F.slice("w", s + 1, window))).alias("v"))
    each = each.groupBy(F.array_join("v", " ").alias("window"), "len").agg(F.array_sort(F.collect_set("item")).alias("items"), F.first("v").alias("v"))
    return each.select("window", "v", "len", F.least(F.lit(shingle), F.col("len")).alias("size"), "items")


def prefixes(wins: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """The rarest shingle of each window: window, len, items, size, key (its hash) and offset."""
    key = F.when(F.col("size") == 1, _key(F.col("v"), F.col("offset"), 1))
    for k in range(2, shingle + 1):
        key = key.when(F.col("size") == k, _key(F.col("v"), F.col("offset"), k))
    parts = wins.select("window", "v", "size", F.explode(F.sequence(F.lit(0), F.col("len") - F.col("size"))).alias("offset")).withColumn("key", key)
    held = parts.groupBy("size", "key").agg(F.count("*").alias("held"))
    counts = wins.select(F.explode("v").alias("word")).groupBy("word").agg(F.count("*").alias("n"))
    each = parts.select("window", "offset", F.explode(F.slice("v", F.col("offset") + 1, F.col("size"))).alias("word")).join(counts, "word")
    rarest = each.groupBy("window", "offset").agg(F.min("n").alias("rarest"))
    ranked = parts.join(held, ["size", "key"]).join(rarest, ["window", "offset"])
    best = ranked.groupBy("window").agg(F.min(F.struct("held", "rarest", "key", "offset")).alias("b")).select("window", "b.key", "b.offset")
    return wins.drop("v").join(best, "window")


def _bits(prefix: DataFrame, rows: int) -> tuple[int, Column]:
    """How many bits the table of the ``rows`` prefixes has, 32 for each up to BITS, and the table as an array of 64-bit numbers."""
    size = min(BITS, 1 << max(10, (32 * rows).bit_length()))
    at = F.pmod("key", F.lit(size))
    found = prefix.select(F.floor(at / 64).alias("cell"), F.call_function("shiftleft", F.lit(1).cast("long"), (at % 64).cast("int")).alias("bit")).groupBy("cell").agg(F.bit_or("bit").alias("bit"))
    cells = [0] * (size // 64)
    for r in found.collect():
        cells[r.cell] = r.bit
    # Folded into one constant, whose size BITS bounds.
    return size, F.split(F.lit(",".join(map(str, cells))), ",").cast("array<bigint>")


def scan(docs: DataFrame, items: DataFrame, window: int = WINDOW, shingle: int = SHINGLE) -> DataFrame:
    """For every row of ``docs``: doc_id, text_key, n_words, hits (array of start and end word, sorted) and items (sorted ids).

    Null and empty texts have no words and no hits; items without words are left out, a null item_id is an item written as
    the empty string; without items nothing is hit. Rows with the same doc_id are told apart by text_key, a hash of the
    text; repeated rows get the same result. A null doc_id is an id. Columns other than doc_id, text, item_id are not
    read. A text of any length is one row; a prefix table too large to send to all executors is joined by a shuffle of
    the places that the bits let through.
    """
    prefix = cut(prefixes(cut(windows(items, window, shingle)), shingle))
    n_prefix = prefix.count()
    sizes = sorted(r.size for r in prefix.select("size").distinct().collect())
    before = window - 1
    n_bits, table = _bits(prefix, n_prefix)

    def of_size(s: Column, k: int) -> Column:
        w, bits = s["w"], s["bits"]
        places = F.transform(F.sequence(F.lit(0), F.size(w) - k), lambda i: F.struct(i.alias("pos"), _key(w, i, k).alias("key")))
        at = lambda x: F.pmod(x["key"], F.lit(n_bits))
        passed = F.filter(places, lambda x: F.getbit(F.get(bits, F.floor(at(x) / 64).cast("int")), (at(x) % 64).cast("int")) == 1)
        found = F.transform(passed, lambda x: F.struct(x["pos"].alias("pos"), F.lit(k).alias("size"), x["key"].alias("key"), F.size(w).alias("n"), F.slice(w, F.greatest(x["pos"] - before, F.lit(0)) + 1, 2 * window).alias("around")))
        return F.when(F.size(w) >= k, found).otherwise(F.array().cast(_PLACES))

    def rows(s: Column) -> Column:
        # The head has the number of words; its size is none that a prefix has, and its key deals it out if the join shuffles.
        head = F.array(F.struct(F.lit(-1).alias("pos"), F.lit(0).alias("size"), s["text_key"].alias("key"), F.size(s["w"]).alias("n"), F.array().cast("array<string>").alias("around")))
        return F.concat(head.cast(_PLACES), *[of_size(s, k) for k in sizes])

    own = docs.select("doc_id", F.xxhash64("text").alias("text_key"), words(F.col("text")).alias("w"))
    own = own.select("doc_id", "text_key", F.get(F.transform(F.array(F.struct("w", "text_key", table.alias("bits"))), rows), F.lit(0)).alias("r"))
    tried = own.select("doc_id", "text_key", F.inline("r")).join(small(prefix, n_prefix), ["size", "key"], "left").withColumn("start", F.col("pos") - F.col("offset"))
    first = F.greatest(F.col("pos") - before, F.lit(0))
    fits = (F.col("start") >= 0) & (F.col("start") + F.col("len") <= F.col("n"))
    same = F.array_join(F.slice("around", F.col("start") - first + 1, F.col("len")), " ") == F.col("window")
    stood = cut(tried.where((F.col("pos") < 0) | F.when(fits, same)).select("doc_id", "text_key", "pos", "n", "start", "len", "items"))
    texts = stood.where("pos < 0").select("doc_id", "text_key", F.col("n").cast("long").alias("n_words"))
    stands = stood.where("pos >= 0")
    found = stands.groupBy("doc_id", "text_key").agg(
        F.array_sort(F.collect_set(F.struct("start", (F.col("start") + F.col("len")).alias("end")))).alias("hits"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
    )
    f = found.select(F.col("doc_id").alias("__id"), F.col("text_key").alias("__key"), "hits", "items")
    joined = texts.join(f, texts.doc_id.eqNullSafe(F.col("__id")) & (texts.text_key == F.col("__key")), "left")
    none = "array<struct<start:int,end:int>>"
    return joined.select("doc_id", "text_key", "n_words", F.coalesce("hits", F.array().cast(none)).alias("hits"), F.coalesce("items", F.array().cast("array<string>")).alias("items"))


_PLACES = "array<struct<pos:int,size:int,key:bigint,n:int,around:array<string>>>"


def n_hit(hits: Column) -> Column:
    """How many words the sorted spans cover."""
    start = F.struct(F.lit(0).alias("to"), F.lit(0).cast("long").alias("n"))
    step = lambda a, x: F.struct(F.greatest(a["to"], x["end"]).alias("to"), (a["n"] + F.greatest(F.lit(0), x["end"] - F.greatest(x["start"], a["to"]))).alias("n"))
    return F.aggregate(hits, start, step, lambda a: a["n"])


def contaminated(hit: Column, n_words: Column) -> Column:
    return (hit > 0) & (20 * hit >= n_words)


def clean(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of ``docs`` that aren't contaminated, with their columns.

    Null and empty texts stay, rows of one id and text stay or go together, and without items all rows stay. Null items have
    no windows.
    """
    found = scan(docs, items)
    bad = cut(found.where(contaminated(n_hit(F.col("hits")), F.col("n_words"))).select("doc_id", "text_key").distinct())
    return without(docs, bad, bad.count())
