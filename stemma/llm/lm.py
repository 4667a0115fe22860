"""Scores by a log-bilinear neural language model trained in numpy with noise-contrastive estimation.

Outcomes are the WORDS most frequent tokens and CLASSES surface classes (the last two bytes) for all others; a token of
a class has, within it, its smoothed share of the class's training tokens, so every text has a probability. The vectors
of the REACH tokens before a token, each times a vector for its distance, are summed into one prediction; an outcome's
score is its own vector times the prediction, plus a bias. Outcomes are parted into groups of neighbouring frequency,
and a probability is that of the group times that of the outcome within its group, both softmaxes over scores of this
form; so batched matrix products give normalised log-probabilities.

Noise-contrastive estimation tells each token from NOISE noise tokens drawn from the unigram of the groups, and of the
words of its group; the noise term is taken in expectation, over all of them, without drawing. A first model is trained
in one task on a bounded sample. From there, each partition goes once through all its training texts, and the partitions'
vectors are averaged, each by how often its outcome occurred there; so every training text takes part, and what the
partitions hand on has a fixed size.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stemma.llm import textkit
from stemma.llm.storage import cut, private, sliced, summed_vectors, text_bytes

#: Outcomes in a group, groups of words, and size of vectors; all fixed, so the model's size doesn't follow the input.
MEMBERS, GROUPS, SIZE, REACH, NOISE = 64, 64, 32, 3, 16
WORDS, CLASSES = MEMBERS * GROUPS, MEMBERS
OUTCOMES = WORDS + CLASSES
#: Training tokens that the first model is trained on, about, and how often it goes through them.
FIRST_TOKENS, FIRST_ROUNDS = 500_000, 3
#: Tokens of a step, and its rate.
STEP, RATE = 16_384, 0.08
#: Fixed-point places of averaged parameters, and their bound.
_FIXED, _MOST = 1 << 16, 30.0
#: Most tokens whose counts are sent to the executors; all others are looked up by a join.
HEAD = 150_000
#: Added to each count of the base.
SMOOTH = 0.1
#: Distinct tokens that a worker counts before it hands them on.
COUNTED = 400_000
_END = np.uint64(0x5EED0FE2D0F7E875)
#: Numbers that are summed by one key.
_BLOCK = 16_384


@dataclass
class Vectors:
    """Parameters: vectors of contexts [outcome], of outcomes [group, member] and groups, both with their bias as a last number, and vectors of distances."""

    context: np.ndarray
    word: np.ndarray
    group: np.ndarray
    distance: np.ndarray

    @classmethod
    def new(cls, unigram: np.ndarray, seed: int = 0) -> Vectors:
        """The start: small random vectors, and biases that give the ``unigram`` [group, member]."""
        rng = np.random.default_rng(seed)
        draw = lambda *shape: rng.normal(0, 0.1, shape).astype(np.float32)
        groups = unigram.sum(axis=1)
        distance = np.repeat(1 / np.arange(1, REACH + 1, dtype=np.float32)[:, None], SIZE, axis=1)
        word, group = draw(GROUPS + 1, MEMBERS, SIZE + 1), draw(GROUPS + 1, SIZE + 1)
        word[:, :, -1], group[:, -1] = _log(unigram / np.maximum(groups, 1e-30)[:, None]), _log(groups)
        return cls(draw(OUTCOMES, SIZE), word, group, distance)

    def arrays(self) -> list[np.ndarray]:
        return [self.context, self.word, self.group, self.distance]

    def copy(self) -> Vectors:
        return Vectors(*(x.copy() for x in self.arrays()))

    def predictions(self, contexts: np.ndarray) -> np.ndarray:
        """[token, SIZE + 1] of contexts [distance, token]; the last number is 1, for the biases."""
        out = np.ones((contexts.shape[1], SIZE + 1), np.float32)
        part = self.context[contexts[0]] * self.distance[0]
        for j in range(1, REACH):
            part += self.context[contexts[j]] * self.distance[j]
        out[:, :SIZE] = part
        return out


def _log(p: np.ndarray) -> np.ndarray:
    """Logarithms; an outcome that doesn't exist has one so low that its softmax is 0."""
    return np.where(p > 0, np.log(np.maximum(p, 1e-30)), -1e4).astype(np.float32)


@dataclass
class Model:
    """``head``: sorted names of frequent tokens, their counts and outcomes; the vectors; totals of tokens and of each class."""

    head: np.ndarray
    head_count: np.ndarray
    head_outcome: np.ndarray
    vectors: Vectors
    tokens: int
    types: int
    class_tokens: np.ndarray
    class_types: np.ndarray


def named(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Name, text row and class of each token, the end token of each text included; texts in order."""
    t = textkit.tokenise(texts, textkit.SPACE)
    raw = np.frombuffer(t.data, np.uint8).astype(np.int64)
    kind = (raw[t.end - 1] * 31 + np.where(t.end - t.start > 1, raw[t.end - 2], 0) * 7) % CLASSES
    last = np.cumsum(t.counts())
    return np.insert(t.name, last, _END), np.insert(t.doc, last, np.arange(len(texts))), np.insert(kind, last, 0)


def _signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def token_counts(docs: DataFrame) -> DataFrame:
    """Counts of all tokens in all texts: name, class, n. Each worker sums its own first.

    Null and empty texts have the end token alone, repeated rows count each, and without rows the table is empty.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

        def merged() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            names, kinds, n = (np.concatenate(x) for x in zip(*parts))
            uniq, first, inverse = np.unique(names, return_index=True, return_inverse=True)
            return uniq, kinds[first], np.bincount(inverse, n).astype(np.int64)

        for part in sliced(batches):
            name, _, kind = named(part.columns[-1].to_pylist())
            uniq, first, n = np.unique(name, return_index=True, return_counts=True)
            parts.append((uniq, kind[first], n))
            if sum(len(x[0]) for x in parts) > 2 * COUNTED:
                parts = [merged()]
                if len(parts[0][0]) > COUNTED:
                    yield _counted(*parts.pop())
        if parts:
            yield _counted(*merged())

    schema = "name long, class int, n long"
    return docs.select(text_bytes().alias("t")).mapInArrow(count, schema).groupBy("name").agg(F.first("class").alias("class"), F.sum("n").alias("n"))


def _counted(name: np.ndarray, kind: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    return pa.record_batch([pa.array(_signed(name)), pa.array(kind.astype(np.int32)), pa.array(n)], ["name", "class", "n"])


def outcomes(name: np.ndarray, kind: np.ndarray, head: np.ndarray, head_outcome: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Outcome of each token, and its place in the head or -1."""
    at = np.searchsorted(head, name)
    at[at == len(head)] = 0
    there = head[at] == name if len(head) else np.zeros(len(name), bool)
    out = WORDS + kind
    if len(head):
        own = head_outcome[at]
        out = np.where(there & (own >= 0), own, out)
    return out, np.where(there, at, -1)


def contexts(out: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """[distance, token]: the outcomes before each token; that of the beginning, where the text begins."""
    back = np.full((REACH, len(out)), _begin(), np.int32)
    for j in range(1, min(REACH, len(out) - 1) + 1):
        back[j - 1, j:] = np.where(doc[j:] == doc[:-j], out[:-j], _begin())
    return back


def _begin() -> int:
    """The context before a text's first token: class 0."""
    return WORDS


def _contrast(minus_score: np.ndarray, noise: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Gradient, its sign turned, by the scores [token, outcome] of telling the targets from expected ``noise`` [outcome], NOISE outcomes each.

    It is noise * right, where right = 1 / (1 + noise * exp(-score)) tells an outcome's odds of being no noise; at the
    target, 1 - right is taken away. ``minus_score`` is written over.
    """
    at = np.arange(len(target))
    with np.errstate(over="ignore", divide="ignore"):
        # An outcome that doesn't exist is no noise, and has no gradient.
        out = np.exp(minus_score, out=minus_score)
        out += 1 / noise
        np.reciprocal(out, out=out)
    out[at, target] -= 1 - out[at, target] / noise[target]
    return out


def _by_group(target: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Group, places and members of the targets, for each group there is."""
    group, member = np.divmod(target, MEMBERS)
    order = np.argsort(group.astype(np.int16), kind="stable")
    edges = np.searchsorted(group[order], np.arange(GROUPS + 2))
    for g in np.flatnonzero(np.diff(edges)):
        own = order[edges[g] : edges[g + 1]]
        yield int(g), own, member[own]


def train(v: Vectors, squares: list[np.ndarray], unigram: np.ndarray, context: np.ndarray, target: np.ndarray) -> None:
    """One step of noise-contrastive estimation in place, each coordinate at its own rate by its summed ``squares``."""
    groups = unigram.sum(axis=1)
    noise = (NOISE * groups).astype(np.float32)
    within = (NOISE * unigram / np.maximum(groups, 1e-30)[:, None]).astype(np.float32)
    h = v.predictions(context)
    grads = [np.zeros_like(x) for x in v.arrays()]
    e = _contrast(h @ -v.group.T, noise, target // MEMBERS)
    grads[2], down = e.T @ h, e @ v.group[:, :SIZE]
    for g, own, member in _by_group(target):
        part = h[own]
        e = _contrast(part @ -v.word[g].T, within[g], member)
        grads[1][g] = e.T @ part
        down[own] += e @ v.word[g][:, :SIZE]
    for j in range(REACH):
        grads[3][j] = (down * v.context[context[j]]).sum(axis=0)
        order = np.argsort(context[j].astype(np.int16), kind="stable")
        at = context[j][order]
        first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
        grads[0][at[first]] += np.add.reduceat(down[order], first) * v.distance[j]
    for x, s, grad in zip(v.arrays(), squares, grads):
        s += grad * grad
        x -= RATE * grad / (np.sqrt(s) + np.float32(1e-3))
        np.minimum(x, _MOST, out=x)


def log_probability(v: Vectors, context: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Normalised natural log-probabilities of the targets."""
    out = np.empty(len(target))
    for k in range(0, len(target), STEP):
        h, own = v.predictions(context[:, k : k + STEP]), target[k : k + STEP]
        score = h @ v.group.T
        part = score[np.arange(len(own)), own // MEMBERS] - _log_sum(score)
        for g, at, member in _by_group(own):
            score = h[at] @ v.word[g].T
            part[at] += score[np.arange(len(at)), member] - _log_sum(score)
        out[k : k + STEP] = part
    return out


def _log_sum(score: np.ndarray) -> np.ndarray:
    """Logarithms of the sums of the rows' exponentials."""
    ones = np.ones(score.shape[1], np.float32)
    with np.errstate(over="ignore"):
        sums = np.exp(score) @ ones
    # Scores are next to log-probabilities, so they hardly ever need to be moved to be summed.
    if sums.min() < 1e-25 or sums.max() > 1e25:
        top = score.max(axis=1)
        return np.log(np.exp(score - top[:, None]) @ ones) + top
    return np.log(sums)


def fit(docs: DataFrame) -> tuple[Model, DataFrame]:
    """The model of the texts of ``docs`` and the counts of all their tokens (name, n).

    Null texts are empty and have the end token alone. Of no texts at all, every outcome is alike.
    """
    spark = docs.sparkSession
    counts = cut(token_counts(docs))
    classes = counts.groupBy("class").agg(F.sum("n").alias("n"), F.count("*").alias("v"))
    tokens, types = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    sizes = counts.groupBy(F.floor(F.log2("n") * 4).alias("size")).count().orderBy(F.desc("size")).collect()
    least, total = None, 0
    for r in sizes:
        total += r["count"]
        if total > HEAD and least is not None:
            break
        least = r["size"]
    frequent = counts.where(F.floor(F.log2("n") * 4) >= F.lit(least if least is not None else 0)).orderBy(F.desc("n"), "name").limit(HEAD).toPandas()
    top = frequent.head(WORDS)
    order = np.argsort(frequent["name"].to_numpy().view(np.uint64))
    head, head_count = frequent["name"].to_numpy().view(np.uint64)[order], frequent["n"].to_numpy()[order]
    rank = np.where(np.arange(len(frequent)) < len(top), np.arange(len(frequent)), -1)
    head_outcome = rank[order]
    class_tokens, class_types = np.zeros(CLASSES, np.int64), np.zeros(CLASSES, np.int64)
    for r in classes.collect():
        class_tokens[r["class"]], class_types[r["class"]] = r["n"], r["v"]
    np.subtract.at(class_tokens, top["class"].to_numpy(), top["n"].to_numpy())
    np.subtract.at(class_types, top["class"].to_numpy(), 1)
    unigram = np.zeros(OUTCOMES)
    unigram[: len(top)] = top["n"]
    unigram[WORDS:] = class_tokens + 0.5
    unigram = (unigram / unigram.sum()).reshape(GROUPS + 1, MEMBERS)
    words = (head[head_outcome >= 0], head_outcome[head_outcome >= 0])
    first, squares = _first(docs, words, unigram, int(tokens))
    vectors = _averaged(docs, words, unigram, first, squares)
    return Model(head, head_count, head_outcome, vectors, int(tokens), int(types), class_tokens, class_types), counts.select("name", "n")


def _steps(batches: Iterator[pa.RecordBatch], words: tuple[np.ndarray, np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Contexts and targets of all tokens, in steps."""
    for part in sliced(batches):
        name, doc, kind = named(part.columns[-1].to_pylist())
        target, _ = outcomes(name, kind, *words)
        context = contexts(target, doc)
        for k in range(0, len(target), STEP):
            yield context[:, k : k + STEP], target[k : k + STEP]


def _first(docs: DataFrame, words: tuple[np.ndarray, np.ndarray], unigram: np.ndarray, tokens: int) -> tuple[Vectors, list[np.ndarray]]:
    """The first model and its summed squares, from texts with about FIRST_TOKENS tokens, chosen by the hash of id and text; repeated rows are learnt once.

    The task takes no more than twice as many tokens, and the rest of the text that it is at.
    """
    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast((words, unigram))
    share = min(1.0, FIRST_TOKENS / max(tokens, 1))

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, unigram = sent.value
        v = Vectors.new(unigram)
        squares = [np.full_like(x, 1e-2) for x in v.arrays()]
        steps, taken = [], 0
        for step in _steps(batches, words):
            steps.append(step)
            taken += len(step[1])
            if taken > 2 * FIRST_TOKENS:
                break
        steps.sort(key=lambda x: (x[1].tobytes(), x[0].tobytes()))
        for k in range(FIRST_ROUNDS):
            for i in np.random.default_rng(k).permutation(len(steps)):
                train(v, squares, unigram, *steps[i])
        yield pa.record_batch([pa.array([x.astype("<f4").tobytes() for x in [*v.arrays(), *squares]], pa.binary())], ["x"])

    chosen = docs.select("doc_id", text_bytes().alias("t"), F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 20)).alias("h")).where(F.col("h") < int(share * (1 << 20)))
    chosen = chosen.groupBy("doc_id", "t").agg(F.first("h")).select("t")
    got = chosen.repartition(1).mapInArrow(learn, "x binary").collect()
    start = Vectors.new(unigram)
    if not got:
        return start, [np.full_like(x, 1e-2) for x in start.arrays()]
    every = [np.frombuffer(r.x, "<f4").reshape(x.shape).copy() for r, x in zip(got, [*start.arrays()] * 2)]
    return Vectors(*every[:4]), every[4:]


def _averaged(docs: DataFrame, words: tuple[np.ndarray, np.ndarray], unigram: np.ndarray, first: Vectors, squares: list[np.ndarray]) -> Vectors:
    """One pass over all texts from the ``first`` model on, in every partition for itself, and the average of the partitions.

    A context's vector weighs as often as the partition has it as a context, an outcome's as a target, a group's as its
    targets; distances weigh by the tokens. Sums are of fixed-point numbers, so they don't hang on their order.
    """
    sent = docs.sparkSession.sparkContext.broadcast((words, unigram, first, squares))

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, unigram, first, squares = sent.value
        v, own = first.copy(), [x.copy() for x in squares]
        before, uses = np.zeros(OUTCOMES, np.int64), np.zeros(OUTCOMES, np.int64)
        for context, target in _steps(batches, words):
            train(v, own, unigram, context, target)
            before += np.bincount(context.reshape(-1), minlength=OUTCOMES)
            uses += np.bincount(target, minlength=OUTCOMES)
        if uses.any():
            salt = TaskContext.get().partitionId() % 32
            fixed = [np.rint(np.clip(x, -_MOST, _MOST) * _FIXED).astype(np.int64) * w for x, w in zip(v.arrays(), _weights(before, uses))]
            rows = np.concatenate([x.reshape(-1) for x in [before, uses, *fixed]])
            keys = range(0, len(rows), _BLOCK)
            data = [zlib.compress(rows[k : k + _BLOCK].astype("<i8").tobytes(), 1) for k in keys]
            yield pa.record_batch([pa.array([k // _BLOCK for k in keys], pa.int32()), pa.array([salt] * len(data), pa.int32()), pa.array(data, pa.binary())], ["key", "salt", "data"])

    blocks = summed_vectors(docs.select(text_bytes().alias("t")).mapInArrow(learn, "key int, salt int, data binary"), _BLOCK)
    if not blocks:
        return first
    rows = np.concatenate([blocks[k] for k in sorted(blocks)])
    before, uses = rows[:OUTCOMES], rows[OUTCOMES : 2 * OUTCOMES]
    out, at = [], 2 * OUTCOMES
    for x, w in zip(first.arrays(), _weights(before, uses)):
        sums = rows[at : at + x.size].reshape(x.shape)
        at += x.size
        # What never occurred stays as it was.
        out.append(np.where(w > 0, sums / np.maximum(w, 1) / _FIXED, x).astype(np.float32))
    return Vectors(*out)


def _weights(before: np.ndarray, uses: np.ndarray) -> list[np.ndarray]:
    """Weights of the arrays of ``Vectors``, in forms that go with theirs."""
    by_group = uses.reshape(GROUPS + 1, MEMBERS)
    groups = by_group.sum(axis=1)
    return [before[:, None], by_group[:, :, None], groups[:, None], groups.sum().reshape(1, 1)]


def score(docs: DataFrame, model: Model, counts: DataFrame, keep: list[str]) -> DataFrame:
    """Columns ``keep`` (their values may repeat) and n_tokens, n_known, train_tokens, base_score and score (log10).

    The names of the results must not be in ``keep``. Every row is scored whole, null as empty. Tokens outside the head are joined with ``counts``, one row for each
    distinct such token of a text with its uses, so no token is without its count. Other columns aren't read.
    """
    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast(model)
    data, row, tail, log, more = (private(docs, x) for x in ("bytes", "row", "rest", "log", "known"))
    source = docs.select(*keep, text_bytes().alias(data))
    schema = source.drop(data).schema
    for name, kind in (("n_tokens", "long"), ("n_known", "long"), ("base_score", "double"), ("score", "double"), (tail, T.ArrayType(T.StructType().add("name", "long").add("uses", "integer")))):
        schema = schema.add(name, kind)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        below = m.tokens + SMOOTH * (m.types + 1)
        inside = np.log10(np.maximum(m.class_tokens + SMOOTH * (m.class_types + 1), SMOOTH))
        for part in sliced(batches):
            texts = part.columns[-1].to_pylist()
            n = len(texts)
            name, doc, kind = named(texts)
            out, at = outcomes(name, kind, m.head, m.head_outcome)
            logs = log_probability(m.vectors, contexts(out, doc), out) / np.log(10)
            headed = at >= 0
            share = np.log10((m.head_count[at] if len(m.head) else np.zeros(len(at))) + SMOOTH)
            classed = out >= WORDS
            logs = logs - np.where(classed, inside[np.where(classed, out - WORDS, 0)], 0) + np.where(classed & headed, share, 0)
            base = np.where(headed, share, 0) - np.log10(below)
            rest = ~headed
            _, first, uses = np.unique(doc[rest].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) ^ name[rest], return_index=True, return_counts=True)
            order = np.argsort(first, kind="stable")
            rest_doc, rest_name, rest_uses = doc[rest][first[order]], name[rest][first[order]], uses[order]
            offsets = np.concatenate([[0], np.cumsum(np.bincount(rest_doc, minlength=n))]).astype(np.int32)
            structs = pa.StructArray.from_arrays([pa.array(_signed(rest_name)), pa.array(rest_uses.astype(np.int32))], names=["name", "uses"])
            total = lambda x: np.bincount(doc, x, minlength=n)
            columns = [pa.array(total(None), pa.int64()), pa.array(total(headed).astype(np.int64)), pa.array(total(base)), pa.array(total(logs)), pa.ListArray.from_arrays(pa.array(offsets), structs)]
            yield pa.RecordBatch.from_arrays([*part.columns[:-1], *columns], names=schema.names)

    rows = cut(source.mapInArrow(work, schema).withColumn(row, F.monotonically_increasing_id()))
    rest = rows.select(row, F.inline(tail))
    looked = rest.join(counts, "name", "left").groupBy(row).agg(
        F.sum(F.col("uses") * F.log10(F.coalesce(F.col("n"), F.lit(0)) + F.lit(SMOOTH))).alias(log),
        F.coalesce(F.sum(F.when(F.col("n") > 0, F.col("uses"))), F.lit(0)).alias(more),
    )
    out = rows.drop(tail).join(looked, row, "left")
    logs, known = F.coalesce(log, F.lit(0.0)), F.coalesce(more, F.lit(0))
    return out.select(*keep, "n_tokens", (F.col("n_known") + known).alias("n_known"), F.lit(model.tokens).cast("long").alias("train_tokens"), (F.col("base_score") + logs).alias("base_score"), (F.col("score") + logs).alias("score"))
