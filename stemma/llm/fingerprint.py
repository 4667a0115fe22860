"""Document fingerprints by locally consistent parsing with deterministic coin tossing.

A text is a row of symbols, at first its code points. At each level, runs of one symbol become one symbol; the rest is
labelled by deterministic coin tossing: a symbol's label is twice the lowest bit where it differs from the symbol
before, plus its own bit there. ROUNDS tosses bring 64-bit names down to labels under 8 that differ from neighbour to
neighbour. A symbol whose label is a local maximum begins a phrase, so phrases are 2 to about 14 symbols long and their
borders hang on a few neighbours alone: equal substrings get equal phrases, but for their ends, wherever they stand. A
phrase's name is a hash of its symbols, and the names are the symbols of the next level. The fingerprint is a sketch of
the names of all phrases from level FIRST on: the KEPT smallest by a second hash.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stemma.llm.storage import BYTES_PER_BATCH, text_bytes
from stemma.llm.textkit import distinct, mix

ROUNDS = 3
#: The first level whose phrases count, and how many names a fingerprint keeps.
FIRST, KEPT = 2, 64
#: Rows that a block of neighbouring doc_ids has about.
BLOCK_ROWS = 1_000
BLOCKS = 20_000
_U = np.uint64


def _toss(label: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """One round: labels from those of the symbol and its left neighbour; a first symbol is tossed against 0's complement."""
    left = np.empty_like(label)
    left[1:] = label[:-1]
    left[begins] = ~label[begins]
    differ = label ^ left
    if label.dtype == np.uint8:
        low = _LOW[differ]
        return 2 * low + (label >> low & np.uint8(1))
    low = differ & (~differ + _U(1))
    bit = (np.frexp(low.astype(np.float64))[1] - 1).astype(np.uint8)
    return 2 * bit + ((label & low) != 0)


def phrases(symbol: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One level: the names of the phrases and the texts' rows, both in order. ``doc`` is sorted."""
    n = len(symbol)
    fresh = np.ones(n, bool)
    fresh[1:] = (symbol[1:] != symbol[:-1]) | (doc[1:] != doc[:-1])
    at = np.flatnonzero(fresh)
    run = np.diff(np.append(at, n))
    s, d = symbol[at], doc[at]
    long = run > 1
    s[long] = mix(s[long] + mix(run[long].astype(np.uint64) * _U(0x9E3779B97F4A7C15)))
    m = len(s)
    begins = np.ones(m, bool)
    begins[1:] = d[1:] != d[:-1]
    label = _toss(s, begins)
    for _ in range(ROUNDS - 1):
        label = _toss(label, begins)
    left, right = np.full(m, -1, np.int16), np.full(m, -1, np.int16)
    wide = label.astype(np.int16)
    left[1:], right[:-1] = wide[:-1], wide[1:]
    left[begins] = -1
    right[:-1][begins[1:]] = -1
    start = begins | ((wide > left) & (wide > right) & (right >= 0))
    start[1:] &= ~start[:-1] | begins[1:]
    first = np.flatnonzero(start)
    place = np.arange(m) - np.repeat(first, np.diff(np.append(first, m)))
    weight = _POWER[np.minimum(place, len(_POWER) - 1)] + (place >= len(_POWER)).astype(np.uint64) * place.astype(np.uint64)
    return mix(np.add.reduceat(mix(s) * (weight | _U(1)), first)), d[first]


_LOW = np.array([(x & -x).bit_length() - 1 if x else 0 for x in range(256)], np.uint8)
_POWER = mix(np.arange(1, 65, dtype=np.uint64) * _U(0xD1342543DE82EF95))


def sketches(texts: list[str]) -> list[np.ndarray]:
    """The sorted sketch of each text: at most KEPT 32-bit values, one at least."""
    symbol = mix(np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64) + _U(1))
    doc = np.repeat(np.arange(len(texts)), [len(x) for x in texts])
    empty = np.array([k for k, x in enumerate(texts) if not x], np.int64)
    names, docs = [np.zeros(len(empty), np.uint64)], [empty]
    level = 0
    while len(symbol):
        count = np.bincount(doc, minlength=len(texts))
        alone = count[doc] == 1
        use = alone if level < FIRST else np.ones(len(symbol), bool)
        names.append(symbol[use])
        docs.append(doc[use])
        symbol, doc = symbol[~alone], doc[~alone]
        if len(symbol):
            symbol, doc = phrases(symbol, doc)
        level += 1
    name, doc = mix(np.concatenate(names) ^ _U(0xA5A5A5A5A5A5A5A5)) >> _U(32), np.concatenate(docs).astype(np.uint64)
    both = distinct(doc << _U(32) | name)
    edges = np.searchsorted(both >> _U(32), np.arange(len(texts) + 1, dtype=np.uint64))
    return [(both[a : min(b, a + KEPT)] & _U(0xFFFFFFFF)).astype(">u4") for a, b in zip(edges, edges[1:])]


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Estimated share of their phrases that two texts have in common: twice the common ones by the sum of both (Dice).

    The Jaccard similarity J is estimated from the KEPT smallest names of the union, and the share is 2J / (1 + J).
    """
    every = np.sort(np.concatenate([a, b]).astype(np.uint32))
    twice = every[1:] == every[:-1]
    union = every[np.concatenate([[True], ~twice])][:KEPT]
    common = int((every[1:][twice] <= union[-1]).sum())
    return 2 * common / (len(union) + common)


def edited(text: str, following: str) -> str:
    """``text`` with its last third replaced by as many first characters of ``following``, or all of them."""
    n = len(text) // 3
    return text[: len(text) - n] + following[:n]


def scan(docs: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """For every row: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    Null texts are empty, and an empty text has a fingerprint of its own. The next document is the next row by
    descending doc_id (of any type that has an order), after the last one the first; rows of equal doc_id follow one
    another by a hash of their text, null ids come last. A single row is its own next. Other columns are not read.

    Rows go to blocks of neighbours in that order, borders being rows picked by their hash (one in ``block_rows``, or
    fewer, so that there are about BLOCKS at most), and the rows of a border go to the block before as well, so each block
    knows its last row's next. So texts are shuffled once, a block is read as a sorted stream, not as a group in memory,
    and neither null ids nor one id with many texts meet in one task.
    """
    spark = docs.sparkSession
    keys = docs.select("doc_id", F.xxhash64(text_bytes()).alias("key"))
    n = docs.count()
    one_in = max(block_rows, n // BLOCKS)
    picked = keys.where(F.pmod(F.xxhash64("doc_id", "key"), F.lit(one_in)) == 0).distinct().collect()
    top = keys.orderBy(F.desc_nulls_last("doc_id"), "key").limit(1).collect()
    # In ascending order, the reverse of that of the rows; nulls are first.
    borders = sorted({(r.doc_id is not None, r.doc_id if r.doc_id is not None else 0, -r.key) for r in [*picked, *top]})
    nulls = sum(not b[0] for b in borders)
    sent = spark.sparkContext.broadcast((borders, nulls, pd.Series([b[1] for b in borders[nulls:]], dtype=None if borders[nulls:] else object).to_numpy()))

    @F.pandas_udf("long")
    def block_of(doc_id: pd.Series, key: pd.Series) -> pd.Series:
        """Twice the number of the row's block, plus 1 if it is the block's border."""
        borders, nulls, ids = sent.value
        known = doc_id.notna().to_numpy()
        low, high = np.zeros(len(key), np.int64), np.full(len(key), nulls)
        if known.any():
            own = doc_id[known].to_numpy(ids.dtype)
            low[known], high[known] = nulls + np.searchsorted(ids, own, "left"), nulls + np.searchsorted(ids, own, "right")
        out = 2 * (len(borders) - 1 - low)
        # Borders of the row's own id: its place among them is told by the hash of its text.
        for k in np.flatnonzero(high > low):
            row = (bool(known[k]), doc_id.iat[k] if known[k] else 0, -int(key.iat[k]))
            at = bisect_left(borders, row, int(low[k]), int(high[k]))
            out[k] = 2 * (len(borders) - 1 - at) + (at < len(borders) and borders[at] == row)
        return pd.Series(out)

    blocks = max(len(borders), 1)
    code = F.col("code")
    own = F.struct(F.floor(code / 2).alias("block"), F.lit(0).alias("ahead"))
    before = F.struct(F.floor((F.floor(code / 2) + blocks - 1) % blocks).alias("block"), F.lit(1).alias("ahead"))
    sides = F.when((code % 2 == 1) & F.lit(blocks > 1), F.array(own, before)).otherwise(F.array(own))
    rows = docs.select("doc_id", text_bytes().alias("text")).withColumn("key", F.xxhash64("text"))
    rows = rows.withColumn("code", block_of("doc_id", "key"))
    rows = rows.select("doc_id", "key", F.explode(sides).alias("x"), "text").select("doc_id", "key", "x.block", "x.ahead", "text")
    dealt = rows.repartition("block").sortWithinPartitions("block", "ahead", F.desc_nulls_last("doc_id"), "key")
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return dealt.select("doc_id", "block", "ahead", "text").mapInArrow(_marked, schema)


def _marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for pairs, kind in _paired(batches):
        ids, texts, after = [p[0] for p in pairs], [p[1] for p in pairs], [p[2] for p in pairs]
        changed = [edited(a, b) for a, b in zip(texts, after)]
        # Mostly, a text's next is the text of the row after it.
        own = sketches([*texts, after[-1]])
        ahead = [own[k + 1] if after[k] is texts[k + 1] else None for k in range(len(texts) - 1)] + [own[-1]]
        if lone := [k for k, x in enumerate(ahead) if x is None]:
            for k, x in zip(lone, sketches([after[k] for k in lone])):
                ahead[k] = x
        new = sketches(changed)
        written = lambda x: x.tobytes().hex()
        columns = [
            pa.array(ids, kind),
            pa.array(map(len, texts), pa.int64()),
            pa.array([sha256(x.encode()).hexdigest() for x in changed]),
            pa.array(map(written, own[:-1])),
            pa.array(map(written, new)),
            pa.array([likeness(a, b) for a, b in zip(own, new)]),
            pa.array([likeness(a, b) for a, b in zip(own, ahead)]),
        ]
        yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])


def _paired(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[tuple], pa.DataType]]:
    """Lists of (id, text, next text) of about BYTES_PER_BATCH, from rows sorted by block, rows ahead last."""
    out, size, first, last, closed, kind, block = [], 0, None, None, False, pa.int64(), None
    for batch in batches:
        kind = batch.schema.field(0).type
        for doc_id, of, ahead, data in zip(*(c.to_pylist() for c in batch.columns)):
            text = data.decode()
            if of != block:
                if last is not None and not closed:
                    out.append((*last, first))
                block, first, last, closed = of, text, None, False
            if closed:
                continue
            if last is not None:
                out.append((*last, text))
                size += len(text)
            last, closed = (doc_id, text), bool(ahead)
            if size > BYTES_PER_BATCH:
                yield out, kind
                out, size = [], 0
    if last is not None and not closed:
        out.append((*last, first))
    if out:
        yield out, kind
