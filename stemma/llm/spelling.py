"""Spelling variants: words at an edit distance of one, found by their rarest positional bigrams, and grouped by frequency.

The bigrams of all words are put in one order, by the number of words that hold them. One inserted, deleted or replaced
character touches two bigrams at most, so of two near words' three rarest bigrams (in that order, then by position) at
least one is common to both and untouched. The edit lies wholly behind or wholly before that bigram. Behind it, both
words begin alike up to the bigram's end; before it, they end alike from its beginning on. So words are joined by the
bigram with its place counted from the untouched end and with that end itself, for equal lengths and for lengths that
differ by one. Pairs are then compared by the parities of their characters, and those left by their edit distance.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stemma.llm.storage import cut, in_batches, text_bytes

#: Code points of the shortest word, its least count, and how many times as frequent a word's form is.
SHORTEST, LEAST, RATIO = 6, 5, 5
#: Bigrams joined for each word: those that one edit can touch, and one more.
RAREST = 3
#: One run of this many, by its hash, loses a code point.
EVERY = 199
#: Words that a worker counts before it hands them on.
COUNTED = 200_000
_RUN = re.compile("[A-Za-zÀ-ÿ]{%d,}" % SHORTEST)
#: Letters of words: a to z and U+00C0 to U+00FF.
LETTERS = 26 + 64


def word_counts(docs: DataFrame, every: int = EVERY) -> DataFrame:
    """The words of ``docs`` (doc_id, text) that occur at least LEAST times: word, n.

    Runs of letters (A-Z, a-z, U+00C0 to U+00FF) are lower-cased in A-Z alone. A run whose crc32, of ``doc_id:run``, is
    divisible by ``every`` loses the code point at that crc32 modulo its length. Null and empty texts have no words, a
    null doc_id is written as nothing, repeated rows count each. Other columns are not read.
    """

    def work(part: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        total: Counter[str] = Counter()
        for doc_id, text in zip(part.columns[0].to_pylist(), part.columns[1].to_pylist()):
            seed = zlib.crc32(f"{doc_id or ''}:".encode())
            for run, n in Counter(_RUN.findall(text.lower().decode())).items():
                h = zlib.crc32(run.encode(), seed)
                if h % every == 0:
                    at = h % len(run)
                    run = run[:at] + run[at + 1 :]
                    if len(run) < SHORTEST:
                        continue
                total[run] += n
            if len(total) > COUNTED:
                yield _counted(total)
                total.clear()
        if total:
            yield _counted(total)

    read = docs.select(F.col("doc_id").cast("string"), text_bytes().alias("text"))
    return in_batches(read, work, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST)


def _counted(total: Counter[str]) -> pa.RecordBatch:
    return pa.record_batch([pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())], ["word", "n"])


def _bigrams(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each bigram of each word: its number, the word's row and its position, in order."""
    points = np.frombuffer("".join(words).encode("utf-32-le"), "<u4").astype(np.int64)
    letter = np.where(points < 128, points - ord("a"), points - 0xC0 + 26)
    size = np.fromiter(map(len, words), np.int64, len(words))
    row = np.repeat(np.arange(len(words)), size)
    at = np.arange(len(points)) - np.repeat(np.cumsum(size) - size, size)
    inner = row[:-1] == row[1:]
    return (letter[:-1] * LETTERS + letter[1:])[inner], row[:-1][inner], at[:-1][inner]


def bigram_order(words: DataFrame) -> np.ndarray:
    """The rank of every bigram by the number of ``words`` that hold it; there are LETTERS squared, 8,100, at most."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(LETTERS**2, np.int64)
        for batch in batches:
            if batch.num_rows:
                number, row, _ = _bigrams(batch.column(0).to_pylist())
                total += np.bincount(np.unique(row * LETTERS**2 + number) % LETTERS**2, minlength=LETTERS**2)
        held = np.flatnonzero(total)
        yield pa.record_batch([pa.array(held.astype(np.int32)), pa.array(total[held])], ["bigram", "n"])

    total = np.zeros(LETTERS**2, np.int64)
    for r in words.select("word").mapInArrow(count, "bigram int, n long").groupBy("bigram").agg(F.sum("n").alias("n")).collect():
        total[r.bigram] = r.n
    rank = np.empty(LETTERS**2, np.int64)
    rank[np.lexsort((np.arange(LETTERS**2), total))] = np.arange(LETTERS**2)
    return rank


def postings(words: DataFrame, rank: np.ndarray) -> DataFrame:
    """For each of a word's RAREST bigrams the word's beginning up to its end, and the word's end from it on.

    Columns: part, length, word, n, letters; ``letters`` has a bit for each letter (modulo 64) that occurs an odd number of times.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            words, n = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            number, row, at = _bigrams(words)
            order = np.lexsort((at, rank[number], row))
            size = np.bincount(row, minlength=len(words))
            place = np.arange(len(order)) - np.repeat(np.cumsum(size) - size, size)
            chosen = order[place < RAREST]
            bits = [_odd(w) for w in words]
            out: list[list] = [[], [], [], [], []]
            for k, i in zip(row[chosen].tolist(), at[chosen].tolist()):
                w = words[k]
                for part in (f"^{w[: i + 2]}", f"{w[i:]}$"):
                    for column, value in zip(out, (part, len(w), w, n[k], bits[k])):
                        column.append(value)
            kinds = (pa.string(), pa.int32(), pa.string(), pa.int64(), pa.int64())
            yield pa.record_batch([pa.array(c, t) for c, t in zip(out, kinds)], ["part", "length", "word", "n", "letters"])

    return words.select("word", "n").mapInArrow(work, "part string, length int, word string, n long, letters long")


def _odd(word: str) -> int:
    bits = 0
    for c in word:
        bits ^= 1 << (ord(c) & 63)
    return bits - (1 << 64) if bits >> 63 else bits


def near_pairs(words: DataFrame) -> DataFrame:
    """All ordered pairs of ``words`` (word, n) at an edit distance of one, once each: word, n, near, near_n.

    ``words`` is read three times and has each word once, of at least SHORTEST letters as ``word_counts`` gives them.
    """
    rows = postings(words, bigram_order(words))
    one, other = rows.alias("one"), rows.withColumn("own", F.col("length")).withColumn("length", F.explode(F.array("length", F.col("length") + 1))).alias("other")
    near = (
        (F.col("one.part") == F.col("other.part"))
        & (F.col("one.length") == F.col("other.length"))
        & ((F.col("one.length") > F.col("other.own")) | (F.col("one.word") < F.col("other.word")))
        & (F.bit_count(F.col("one.letters").bitwiseXOR(F.col("other.letters"))) <= 2)
        & (F.levenshtein(F.col("one.word"), F.col("other.word"), 1) == 1)
    )
    found = one.join(other, near).select(*(F.col(f"{side}.{c}").alias(f"{side}_{c}") for side in ("one", "other") for c in ("word", "n")))
    ways = [F.struct(F.col(f"{a}_word").alias("word"), F.col(f"{a}_n").alias("n"), F.col(f"{b}_word").alias("near"), F.col(f"{b}_n").alias("near_n")) for a, b in (("one", "other"), ("other", "one"))]
    return found.select(F.explode(F.array(*ways)).alias("way")).select("way.*").repartition("word").dropDuplicates(["word", "near"])


def roots(forms: DataFrame) -> DataFrame:
    """The last form of each word of ``forms`` (word, form), which have each word once and no circles: word, root.

    Every round doubles the steps that are behind a root, so there are about as many as the logarithm of the longest chain.
    """
    now = cut(forms.select("word", F.col("form").alias("root")))
    while True:
        further = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        then = cut(now.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        if then.where("moved").isEmpty():
            return then.select("word", "root")
        now = then.select("word", "root")


def variants(docs: DataFrame, every: int = EVERY) -> DataFrame:
    """Every word of ``word_counts`` with the word that it is a variant of: word, n, n_near, form, form_n, root.

    A word's form is its near word of the largest count, the first in code-point order of several, if that count is at
    least RATIO times the word's own; else form and form_n are null. The root is the end of the chain of forms. Counts
    grow along a chain, so it has no circles. Without words the table is empty.
    """
    words = cut(word_counts(docs, every))
    best = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("near"))).alias("best")
    near = near_pairs(words).groupBy("word").agg(F.count("*").alias("n_near"), best)
    told = words.join(near, "word", "left").withColumn("is_variant", F.coalesce(-F.col("best.less") >= RATIO * F.col("n"), F.lit(False)))
    pick = lambda x: F.when(F.col("is_variant"), x)
    out = cut(told.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), pick(F.col("best.near")).alias("form"), pick(-F.col("best.less")).alias("form_n")))
    last = roots(out.where(F.col("form").isNotNull()))
    return out.join(last, "word", "left").withColumn("root", F.coalesce("root", "word"))
