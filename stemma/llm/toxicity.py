"""Toxicity scores: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Features of a text are the distinct words, adjacent pairs and pairs with one word between, hashed into 2**BITS
coordinates. Training follows McMahan et al. (2013): each coordinate has its own learning rate, and L1 keeps at exactly
zero all weights without enough evidence, so the model that goes to the executors is a short list of weights.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stemma.llm import textkit
from stemma.llm.storage import in_batches, private, sliced, small, text_bytes

BITS = 20
#: A document is toxic from this score on.
THRESHOLD = 0.3
#: The bias of a model without labels.
UNLABELLED = -35.0
#: Bound on the labelled documents that a model is fitted on, a documented parameter: if there are more, those with the smallest id hashes.
TRAIN_DOCS = 10_000


@dataclass
class Model:
    index: np.ndarray
    weight: np.ndarray
    bias: float


def features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct (text row, coordinate) pairs."""
    t = textkit.tokenise(texts, textkit.ALNUM)
    found = [textkit.grams(t, gaps) for gaps in ((), (1,), (2,))]
    doc = np.concatenate([d for _, d in found]).astype(np.int64)
    at = np.concatenate([h >> np.uint64(64 - BITS) for h, _ in found]).astype(np.int64)
    both = textkit.distinct(doc << BITS | at)
    return both >> BITS, both & (2**BITS - 1)


def ftrl(rows: list[np.ndarray], labels: list[int], epochs: int = 5, alpha: float = 0.5, beta: float = 1.0, l1: float = 8.0, l2: float = 1.0) -> Model:
    """Fit on rows of distinct coordinates. The last coordinate is the bias, free of L1."""
    z, n = np.zeros(2**BITS + 1), np.zeros(2**BITS + 1)
    bias = np.array([2**BITS])
    for epoch in range(epochs):
        for k in np.random.default_rng(epoch).permutation(len(rows)):
            i = np.concatenate([rows[k], bias])
            zi, ni = z[i], n[i]
            shrunk = np.sign(zi) * np.maximum(np.abs(zi) - l1, 0)
            shrunk[-1] = zi[-1]
            w = -shrunk / ((beta + np.sqrt(ni)) / alpha + l2)
            g = 1 / (1 + np.exp(-np.clip(w.sum(), -35, 35))) - labels[k]
            root = np.sqrt(ni + g * g)
            z[i] = zi + g - (root - np.sqrt(ni)) / alpha * w
            n[i] = ni + g * g
    shrunk = np.sign(z) * np.maximum(np.abs(z) - l1, 0)
    shrunk[-1] = z[-1]
    w = -shrunk / ((beta + np.sqrt(n)) / alpha + l2)
    index = np.flatnonzero(w[:-1])
    return Model(index, w[:-1][index].astype(np.float32), float(w[-1]))


def fit(docs: DataFrame, labels: DataFrame, bound: int = TRAIN_DOCS) -> Model:
    """Fit on documents (``doc_id, text``) that have a label (``doc_id, toxic``).

    Labels that are null are left out; a document with several labels has their maximum, and of texts that
    share an id the one of the least hash is learnt. At most about ``bound``
    documents are used: all, or those whose id hash falls under the fitting threshold. They go to one task, which
    returns the weights other than zero. Without labels nothing is held to be toxic: every score is next to 0.
    """
    spark = docs.sparkSession
    known = labels.where("doc_id is not null and toxic is not null").groupBy(F.col("doc_id").alias("__id")).agg(F.max("toxic").alias("__y"))
    total = known.count()
    if not total:
        return Model(np.zeros(0, np.int64), np.zeros(0, np.float32), UNLABELLED)
    share = min(1.0, bound / total)
    chosen = known.where(F.pmod(F.xxhash64("__id"), F.lit(1 << 20)) < int(share * (1 << 20)))
    rows = docs.select(F.col("doc_id").alias("__id"), F.col("text").alias("__text")).join(small(chosen, min(total, 2 * bound)), "__id")
    rows = rows.groupBy("__id").agg(F.first("__y").alias("__y"), F.min_by(text_bytes("__text"), F.xxhash64("__text")).alias("__text")).select("__id", F.col("__y").cast("int"), "__text")

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets, ys, ids = [], [], []
        for part in sliced(batches):
            doc, at = features(part.columns[2].to_pylist())
            sets += np.split(at.astype(np.int32), np.searchsorted(doc, np.arange(1, part.num_rows)))
            ys += part.columns[1].to_pylist()
            ids += part.columns[0].to_pylist()
        order = sorted(range(len(ids)), key=lambda k: (ids[k], len(sets[k])))
        if order:
            model = ftrl([sets[k] for k in order], [int(ys[k] > 0) for k in order])
            yield pa.record_batch([pa.array([model.index.astype("<i4").tobytes()]), pa.array([model.weight.tobytes()]), pa.array([model.bias])], ["at", "weight", "bias"])

    got = rows.repartition(1).mapInArrow(train, "at binary, weight binary, bias double").collect()
    if not got:
        return Model(np.zeros(0, np.int64), np.zeros(0, np.float32), UNLABELLED)
    return Model(np.frombuffer(got[0].at, "<i4").astype(np.int64), np.frombuffer(got[0].weight, np.float32), got[0].bias)


def score(docs: DataFrame, model: Model, keep: list[str], name: str = "score") -> DataFrame:
    """Columns ``keep`` and the score (0 to 1), called ``name``, for every row of ``docs``.

    Null and empty texts have no features and score as the bias alone. Repeated rows score alike. Other columns of
    ``docs`` are not read.
    """
    data = private(docs, "bytes")
    sent = docs.sparkSession.sparkContext.broadcast((model.index, model.weight, model.bias))
    source = docs.select(*keep, text_bytes().alias(data))
    schema = source.drop(data).schema.add(name, "double")

    def work(part: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        index, weight, bias = sent.value
        dense = np.zeros(2**BITS, np.float32)
        dense[index] = weight
        t = textkit.tokenise(part.columns[-1].to_pylist(), textkit.ALNUM)
        pairs = []
        for gaps in ((), (1,), (2,)):
            gram, doc = textkit.grams(t, gaps)
            at = (gram >> np.uint64(64 - BITS)).astype(np.int64)
            hit = dense[at] != 0
            pairs.append(doc[hit].astype(np.int64) << BITS | at[hit])
        both = textkit.distinct(np.concatenate(pairs))
        total = np.bincount(both >> BITS, weights=dense[both & (2**BITS - 1)], minlength=part.num_rows) + bias
        out = 1 / (1 + np.exp(-np.clip(total, -35, 35)))
        yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(out)], names=schema.names)

    return in_batches(source, work, schema)
