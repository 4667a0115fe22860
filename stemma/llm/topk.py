"""Exact top-k inner products by pruning blocks, the best-bounded first.

Vectors are integers. They are put in an order that brings like ones together (by their two best pivots of a bounded
sample, then by id) and cut into blocks of BLOCK rows; BLOCKS blocks are a range, which is a row of the index with the
vectors of its blocks (their forward index) and the largest and smallest value of each component in each block. A term is
a component with a sign, its maximum in a block one of these two values, and the sum of a query's weights times them bounds
all scores in the block.

A query is first asked in its own range, which gives a k-th score to begin with. It then goes to the ranges whose bounds
reach that score, and there through the blocks in the order of their bounds until one falls below the k-th score found.
Bounds that equal the k-th score are followed while the block has an id small enough to win the tie. Queries and ranges
meet in pages of both, so none is sent whole to all tasks.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stemma.llm.storage import cut

#: Vectors are scaled by this and rounded down.
SCALE = 1024.0
K = 10
#: Rows of a block, blocks of a range, ranges that one task packs, and queries or ranges of a page.
BLOCK, BLOCKS, PACKED, PAGE = 128, 32, 16, 1_024
#: Bound on the sample that rows are ordered by, a documented parameter; all rows are indexed.
PIVOTS = 256
#: A score that isn't there, and the place of a null id: behind all others.
NONE, LAST = np.iinfo(np.int64).min, np.iinfo(np.int64).max
#: Integers below this are exact in double precision.
_EXACT = 2**53


def quantised(df: DataFrame, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """floor(1024 x) of all components, as doubles that hold integers: vec_id, data.

    Null vectors and those with a component that is null or not finite take no part. An empty vector does, with the score 0.
    """
    scaled = F.transform(vector, lambda x: F.floor(F.lit(SCALE) * x.cast("double")).cast("double"))
    sound = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    return df.where(F.col(vector).isNotNull() & F.coalesce(sound, F.lit(False))).select(F.col(key).cast("long").alias("vec_id"), scaled.alias("data"))


def product(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """All inner products of two arrays of integers in double precision, as 64-bit integers; those beyond are the nearest that fit."""
    if not queries.size or not rows.size:
        return np.zeros((len(queries), len(rows)), np.int64)
    if (np.abs(queries).max(axis=0) @ np.abs(rows).max(axis=0)) < _EXACT:
        return (queries @ rows.T).astype(np.int64)
    whole = np.frompyfunc(int, 1, 1)
    return np.clip(whole(queries) @ whole(rows).T, NONE + 1, LAST).astype(np.int64)


def bounds(queries: np.ndarray, most: np.ndarray, least: np.ndarray) -> np.ndarray:
    """For each query and block the sum of weights times the terms' maxima."""
    signed = np.hstack([np.maximum(queries, 0), np.minimum(queries, 0)])
    return product(signed, np.hstack([most, least]))


def merged(scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k best of each row, by score and then by the smaller id."""
    order = np.lexsort((ids, -1 - scores), axis=1)[:, :k]  # -1 - x turns the order round for every integer
    return np.take_along_axis(scores, order, 1), np.take_along_axis(ids, order, 1)


def _alive(bound: np.ndarray, first: np.ndarray, score: np.ndarray, ident: np.ndarray) -> np.ndarray:
    """Whether a block of that bound and that first id may hold a row better than or equal to (score, ident)."""
    return (bound > score) | ((bound == score) & (first <= ident))


class Range:
    """The blocks of one range of rows."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray, block: int = BLOCK):
        self.ids, self.rows, self.block = ids, rows, block
        starts = range(0, len(ids), block)
        self.most = np.array([rows[i : i + block].max(axis=0) for i in starts])
        self.least = np.array([rows[i : i + block].min(axis=0) for i in starts])
        self.first = np.array([ids[i : i + block].min() for i in starts])

    def search(self, own: np.ndarray, queries: np.ndarray, score: np.ndarray, ident: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """The k best rows for each query, of those no worse than its (score, ident); NONE where there are fewer."""
        queries = padded(queries, self.rows.shape[1])
        best, found = np.full((len(own), k), NONE), np.full((len(own), k), LAST)
        by_first = np.argsort(self.first, kind="stable")
        bound = bounds(queries, self.most, self.least)[:, by_first]
        order = np.argsort(-1 - bound, axis=1, kind="stable")
        bound, order = np.take_along_axis(bound, order, 1), by_first[order]
        left = np.arange(len(own))
        for step in range(len(self.first)):
            better = (best[left, -1] > score[left]) | ((best[left, -1] == score[left]) & (found[left, -1] < ident[left]))
            s, i = np.where(better, best[left, -1], score[left]), np.where(better, found[left, -1], ident[left])
            left = left[_alive(bound[left, step], self.first[order[left, step]], s, i)]
            if not len(left):
                break
            for b in np.unique(order[left, step]):
                at, of = left[order[left, step] == b], slice(b * self.block, (b + 1) * self.block)
                scores = product(queries[at], self.rows[of])
                ids = np.broadcast_to(self.ids[of], scores.shape)
                scores[ids == own[at][:, None]] = NONE
                best[at], found[at] = merged(np.hstack([best[at], scores]), np.hstack([found[at], ids]), k)
        return best, found


def padded(rows: np.ndarray, width: int) -> np.ndarray:
    """Rows with zeros behind their components, or without components behind ``width``, where one side has only zeros."""
    n = rows.shape[1]
    return rows[:, :width] if n >= width else np.hstack([rows, np.zeros((len(rows), width - n))])


def _stacked(column: pa.Array) -> np.ndarray:
    """A list column as an array, shorter lists with zeros at their end."""
    values = column.flatten().to_numpy(zero_copy_only=False)
    size = np.diff(column.offsets.to_numpy())
    width = int(size.max()) if len(size) else 0
    if len(size) and (size == width).all():
        return values.reshape(len(size), width)
    out = np.zeros((len(size), width))
    out[np.arange(width) < size[:, None]] = values
    return out


def _longs(data: bytes) -> np.ndarray:
    return np.frombuffer(data, "<i8")


def _doubles(data: bytes, rows: int) -> np.ndarray:
    return np.frombuffer(data, "<f8").reshape(rows, -1) if rows else np.zeros((0, 0))


def _row(schema: str, *values: object) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    names = [c.split() for c in schema.split(", ")]
    return pa.record_batch([pa.array([v], kinds[t]) for v, (_, t) in zip(values, names)], [n for n, _ in names])


_INDEX = "part long, n int, ids binary, data binary, most binary, least binary, first long"
_QUERY = "query_id long, word long, data binary, score long, ident long"
_ASKED = "part long, m int, queries binary, words binary, weights binary, scores binary, idents binary"
_FOUND = "query_id long, word long, vec_id long, score long"


def index(vectors: DataFrame, block: int = BLOCK, blocks: int = BLOCKS) -> DataFrame:
    """Ranges of blocks over all of ``vectors`` (vec_id, data). Ranges hold ``blocks`` blocks of ``block`` rows or fewer."""
    vectors = cut(vectors)
    rows = vectors.count()
    sample = vectors.orderBy(F.xxhash64("vec_id", "data")).limit(PIVOTS).collect()
    width = max((len(r.data) for r in sample), default=0)
    pivots = np.zeros((len(sample), width))
    for k, r in enumerate(sample):
        pivots[k, : len(r.data)] = r.data

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                likeness = padded(_stacked(batch.column(1)), width) @ pivots.T
                two = np.argsort(-likeness, axis=1, kind="stable")[:, :2]
                cell = two[:, 0] * PIVOTS + two[:, -1]
                yield pa.record_batch([pa.array(cell), batch.column(0), batch.column(1)], ["cell", "vec_id", "data"])

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        at, size = TaskContext.get().partitionId() << 32, block * blocks
        waiting: list[pa.RecordBatch] = []

        def made(table: pa.Table, number: int) -> pa.RecordBatch:
            table = table.combine_chunks()
            ids = table.column(0).combine_chunks().fill_null(LAST).to_numpy(zero_copy_only=False)
            r = Range(ids, _stacked(table.column(1).combine_chunks()), block)
            return _row(_INDEX, number, len(ids), ids.astype("<i8").tobytes(), *(x.astype("<f8").tobytes() for x in (r.rows, r.most, r.least)), int(r.first.min()))

        for batch in batches:
            waiting.append(batch)
            while sum(b.num_rows for b in waiting) >= size:
                table = pa.Table.from_batches(waiting)
                yield made(table.slice(0, size), at)
                waiting, at = table.slice(size).to_batches(), at + 1
        if sum(b.num_rows for b in waiting):
            yield made(pa.Table.from_batches(waiting), at)

    tasks = max(1, math.ceil(rows / (block * blocks * PACKED)))
    dealt = vectors.mapInArrow(placed, "cell long, vec_id long, data array<double>").repartitionByRange(tasks, "cell", "vec_id").sortWithinPartitions("cell", "vec_id")
    return cut(dealt.select("vec_id", "data").mapInArrow(packed, _INDEX))


def _range(r: dict, block: int) -> Range:
    return Range(_longs(r["ids"]), _doubles(r["data"], r["n"]), block)


def begun(ranges: DataFrame, every: int, k: int, block: int = BLOCK) -> DataFrame:
    """The queries, rows whose id ``every`` divides, once each, with their k-th best row in their own range (NONE if it has fewer).

    ``word`` is a hash of the vector, so rows of one id and different vectors are different queries.
    """
    import hashlib

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                part = _range(r, block)
                at = np.flatnonzero((part.ids % every == 0) & (part.ids != LAST))
                if len(at):
                    least = np.full(len(at), NONE)
                    best, found = part.search(part.ids[at], part.rows[at], least, np.full(len(at), LAST), k)
                    data = [np.trim_zeros(part.rows[i], "b").astype("<f8").tobytes() for i in at]
                    word = [int.from_bytes(hashlib.blake2b(d, digest_size=8).digest(), "little", signed=True) for d in data]
                    yield pa.record_batch([pa.array(part.ids[at]), pa.array(word, pa.int64()), pa.array(data, pa.binary()), pa.array(best[:, -1]), pa.array(found[:, -1])], [c.split()[0] for c in _QUERY.split(", ")])

    best = F.min(F.struct((-1 - F.col("score")).alias("less"), F.col("ident").alias("ident"))).alias("best")
    out = ranges.mapInArrow(work, _QUERY).groupBy("query_id", "word").agg(F.first("data").alias("data"), best)
    return out.select("query_id", "word", "data", (-1 - F.col("best.less")).alias("score"), F.col("best.ident").alias("ident"))


def routed(queries: DataFrame, ranges: DataFrame, n_ranges: int, block: int = BLOCK) -> DataFrame:
    """For each range the queries, in lots of PAGE at most, whose bounds there reach their k-th score."""
    pages = max(1, math.ceil(n_ranges / PAGE))

    def lots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, PAGE):
                ids, word, data, score, ident = (c.to_pylist() for c in batch.slice(i, PAGE).columns)
                rows = [np.frombuffer(d, "<f8") for d in data]
                weights = np.zeros((len(rows), max(map(len, rows))))
                for k, r in enumerate(rows):
                    weights[k, : len(r)] = r
                yield _row(_ASKED, 0, len(ids), *(np.array(x, "<i8").tobytes() for x in (ids, word)), weights.astype("<f8").tobytes(), *(np.array(x, "<i8").tobytes() for x in (score, ident)))

    def paged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["page", "part", "most", "least", "first"]
        for batch in batches:
            out: list[list] = [[], [], [], [], []]
            for r in batch.to_pylist():
                n = math.ceil(r["n"] / block)
                most, least = _doubles(r["most"], n).max(axis=0), _doubles(r["least"], n).min(axis=0)
                for column, value in zip(out, (hash(r["part"]) % pages, r["part"], most.tobytes(), least.tobytes(), r["first"])):
                    column.append(value)
            yield pa.record_batch([pa.array(c, t) for c, t in zip(out, (pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.int64()))], names)

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                weights = _doubles(r["weights"], r["m"])
                score, ident, ids, word = (_longs(r[x]) for x in ("scores", "idents", "queries", "words"))
                for p in r["ranges"]:
                    most, least = (np.frombuffer(p[x], "<f8")[None, :] for x in ("most", "least"))
                    at = np.flatnonzero(_alive(bounds(padded(weights, most.shape[1]), most, least)[:, 0], np.int64(p["first"]), score, ident))
                    if len(at):
                        yield _row(_ASKED, p["part"], len(at), ids[at].tobytes(), word[at].tobytes(), weights[at].tobytes(), score[at].tobytes(), ident[at].tobytes())

    asked = queries.mapInArrow(lots, _ASKED).drop("part").withColumn("page", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(pages - 1).cast("long"))))
    summed = ranges.select("part", "n", "most", "least", "first").mapInArrow(paged, "page long, part long, most binary, least binary, first long")
    summed = summed.groupBy("page").agg(F.collect_list(F.struct("part", "most", "least", "first")).alias("ranges"))
    return asked.join(summed, "page").drop("page").mapInArrow(route, _ASKED)


def search(df: DataFrame, every: int = 100, k: int = K, key: str = "vec_id", vector: str = "embedding", block: int = BLOCK, blocks: int = BLOCKS) -> DataFrame:
    """The ``k`` rows of the highest integer inner product for each row whose ``key`` is divisible by ``every``: query_id, word, rank, vec_id, score.

    Candidates are all rows but those of the query's id. Ties go to the smaller id, a null id last; rows of a null id
    are never queries. Vectors of different lengths are compared with zeros at the end of the shorter. Rows that repeat
    an id are candidates each; as queries, those of one id and vector are asked once, and those of different vectors are
    told apart by ``word``. Without rows, queries or candidates there are no results. Other columns are not read.
    """
    ranges = index(quantised(df, key, vector), block, blocks)
    queries = cut(begun(ranges, every, k, block))
    asked = routed(queries, ranges, ranges.count(), block)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                ids, word, score, ident = (_longs(r[x]) for x in ("queries", "words", "scores", "idents"))
                best, found = _range(r, block).search(ids, _doubles(r["weights"], r["m"]), score, ident, k)
                at, place = np.nonzero(best != NONE)
                near = found[at, place]
                yield pa.record_batch([pa.array(ids[at]), pa.array(word[at]), pa.array(near, mask=near == LAST), pa.array(best[at, place])], [c.split()[0] for c in _FOUND.split(", ")])

    met = asked.join(ranges.select("part", "n", "ids", "data"), "part").mapInArrow(work, _FOUND)
    order = Window.partitionBy("query_id", "word").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    return met.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "word", "rank", "vec_id", "score")
