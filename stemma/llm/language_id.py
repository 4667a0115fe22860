"""Language identification by segmentation-marginalised unigrams over a fixed public vocabulary of pieces.

Each language gives every piece of the vocabulary a probability. A word, led by the mark of a word's beginning, has as
its probability the sum over all its segmentations into pieces of the product of the pieces' probabilities, computed by
the forward algorithm; a text's is the product over its words. Words are of any length: the recursion goes through them
in windows, and carries the sums of the last characters, scaled, from one to the next, so no segmentation is left out. The
piece probabilities of a language are fitted to its word counts by expectation-maximisation with the forward-backward
algorithm. Single characters outside the vocabulary share one floor probability, so every text can be scored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stemma.llm import textkit
from stemma.llm.storage import cut, in_batches, private, small, text_bytes

#: Bound on the documents that a model is fitted on, a documented parameter: all, or of each language those with the smallest id hashes.
TRAIN_DOCS = 6_000
ROUNDS = 2
#: Characters of a window of the recursion; the sums in one stay within the range of doubles.
WINDOW = 24
#: Characters of words that are scored at once; one longer word is scored by itself.
CELLS = 1 << 17
#: Languages that are scored at once, as arrays of the whole vocabulary.
TOGETHER = 64
#: Words whose scores a worker remembers.
REMEMBERED = 200_000
_HASHES = 1 << 20
_MARK = "▁"
_FLOOR = 1e-7
_OPEN: dict[str, Vocabulary] = {}


class Vocabulary:
    """Pieces and their numbers, and for two characters the length of the longest piece that ends with them."""

    def __init__(self, pieces: Iterable[str]):
        self.numbers = {p: i for i, p in enumerate(sorted(pieces))}
        self.longest: dict[str, int] = {}
        for p in self.numbers:
            self.longest[p[-2:]] = max(self.longest.get(p[-2:], 1), len(p))
        self.reach = max(map(len, self.numbers), default=1)


def vocabulary_of(path: str) -> Vocabulary:
    """The pieces in the vocabulary file that can occur in a word: lower-cased, without ASCII other than letters."""
    if path not in _OPEN:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        found = {_lower(model.id_to_piece(i)) for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_byte(i) or model.is_unknown(i))}
        _OPEN[path] = Vocabulary(p for p in found if p and all(ord(c) >= 128 or c.isalpha() for c in p))
    return _OPEN[path]


def _lower(text: str) -> str:
    return text.translate({c: c + 32 for c in range(65, 91)})


def spelled(word: bytes) -> str:
    """The characters that are scored for one word of a text."""
    return _MARK + word.decode("utf-8", "replace")


def in_groups(words: list[str]) -> Iterator[np.ndarray]:
    """Places of the words in order of their lengths, by groups of about CELLS characters."""
    lengths = np.array([len(w) for w in words])
    order = np.argsort(lengths, kind="stable")
    at = 0
    while at < len(order):
        n = max(1, int(np.searchsorted(lengths[order[at:]] * np.arange(1, len(order) - at + 1), CELLS, "right")))
        yield order[at : at + n]
        at += n


class Lattice:
    """The pieces at all places of some words, in order of their lengths.

    Number 0 stands for no piece, 1 for a character outside the vocabulary, and piece i has the number i + 2. A window has
    the pieces that end in it, as an array [end, length, word] for the words that reach into it.
    """

    def __init__(self, words: list[str], vocabulary: Vocabulary):
        self.words, self.vocabulary = words, vocabulary
        self.lengths = np.array([len(w) for w in words])
        self.top = int(self.lengths[-1])
        self.reach = min(vocabulary.reach, self.top)

    def window(self, a: int) -> tuple[int, np.ndarray, list[tuple[int, int]]]:
        """First word that has more than ``a`` characters, the pieces that end in the next WINDOW of it, and the (end, length) that there are."""
        first = int(np.searchsorted(self.lengths, a, "right"))
        rows = min(WINDOW, self.top - a) + 1
        places, values = [], []
        get, longest, n, reach = self.vocabulary.numbers.get, self.vocabulary.longest.get, len(self.words) - first, self.reach
        for k, w in enumerate(self.words[first:]):
            for end in range(a + 1, min(a + WINDOW, len(w)) + 1):
                row = (end - a) * (reach + 1)
                i = get(w[end - 1])
                places.append((row + 1) * n + k)
                values.append(1 if i is None else i + 2)
                for size in range(2, min(longest(w[end - 2 : end], 1), end) + 1):
                    i = get(w[end - size : end])
                    if i is not None:
                        places.append((row + size) * n + k)
                        values.append(i + 2)
        at = np.zeros(rows * (reach + 1) * n, np.int32)
        at[places] = values
        at = at.reshape(rows, reach + 1, n)
        used = at.any(axis=2)
        return first, at, [(e, z) for e in range(1, rows) for z in range(1, reach + 1) if used[e, z]]

    def forward(self, p: np.ndarray, every: bool = False) -> np.ndarray:
        """Logarithms of the sums of the products over all segmentations: [word, language] of the whole words, or if ``every``, [characters, word] of their beginnings in the one language.

        ``p`` is [number, language].
        """
        n, reach = len(self.words), self.reach
        out = np.zeros((n, p.shape[1]))
        kept = np.full((self.top + 1, n), -np.inf) if every else None
        carried, scale = np.zeros((reach, n, p.shape[1])), np.zeros((n, p.shape[1]))
        carried[-1] = 1
        if every:
            kept[0] = 0
        before = 0
        for a in range(0, self.top, WINDOW):
            first, at, used = self.window(a)
            carried, scale = carried[:, first - before :], scale[first - before :]
            before = first
            rows = at.shape[0] - 1
            alpha = np.concatenate([carried, np.zeros((rows, *carried.shape[1:]))])
            for end, size in used:
                alpha[reach - 1 + end] += alpha[reach - 1 + end - size] * p[at[end, size]]
            if every:
                with np.errstate(divide="ignore"):
                    kept[a + 1 : a + rows + 1, first:] = np.log(alpha[reach:, :, 0]) + scale[:, 0]
            done = np.flatnonzero(self.lengths[first:] <= a + rows)
            out[first + done] = np.log(alpha[reach - 1 + self.lengths[first + done] - a, done]) + scale[done]
            last = np.where(alpha[-1] > 0, alpha[-1], 1)
            carried, scale = alpha[rows:] / last, scale + np.log(last)
        return kept if every else out

    def expected(self, p: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """Expected uses of each piece number in the words, each word counted ``weights`` times; ``p`` is that of one language."""
        n, reach = len(self.words), self.reach
        alpha = self.forward(p[:, None], every=True)
        total = alpha[self.lengths, np.arange(n)]
        out = np.zeros(len(p))
        # Carried are the places from ``reach`` before a window's first to that one.
        carried, scale = np.zeros((reach + 1, 0)), np.zeros(0)
        for a in range((self.top - 1) // WINDOW * WINDOW, -1, -WINDOW):
            first, at, used = self.window(a)
            rows, more = at.shape[0] - 1, n - first - len(scale)
            beta, scale = np.zeros((reach + rows + 1, n - first)), np.concatenate([np.zeros(more), scale])
            beta[rows:, more:] = carried
            here = np.flatnonzero(self.lengths[first:] <= a + rows)
            beta[reach + self.lengths[first + here] - a, here] = 1
            for end, size in sorted(used, reverse=True):
                step = beta[reach + end] * p[at[end, size]]
                share = np.exp(np.minimum(alpha[a + end - size, first:] + scale - total[first:], 700))
                out += np.bincount(at[end, size], share * step * weights[first:], minlength=len(out))
                beta[reach + end - size] += step
            last = np.where(beta[reach] > 0, beta[reach], 1)
            carried, scale = beta[: reach + 1] / last, scale + np.log(last)
        return out


@dataclass
class Model:
    """Piece probabilities by language. What is kept of a language are the pieces that its texts have; all others share one probability."""

    languages: list[str]
    #: Of each language the numbers of its pieces and their probabilities, and the probability of each other number but 0.
    columns: list[tuple[np.ndarray, np.ndarray]]
    rest: list[float]
    #: Numbers, and the vocabulary's file.
    size: int
    path: str

    def dense(self, a: int, b: int) -> np.ndarray:
        """[number, language] of the languages from ``a`` to ``b``; row 0 is 0."""
        p = np.tile(np.array(self.rest[a:b], float), (self.size, 1))
        for j, (i, value) in enumerate(self.columns[a:b]):
            p[i, j] = value
        p[0] = 0
        return p


def equal_share(sizes: list[int], bound: int) -> float:
    """The most documents a language may use, for all to use ``bound`` together, or all that there are."""
    left = bound
    for k, n in enumerate(sorted(sizes)):
        if n * (len(sizes) - k) > left:
            return left / (len(sizes) - k)
        left -= n
    return float(max(sizes, default=0))


def fit(docs: DataFrame, path: str | None = None, bound: int = TRAIN_DOCS, rounds: int = ROUNDS) -> Model:
    """Fit to the texts of ``docs`` (doc_id, text, lang); rows with a null language or text are left out.

    At most about ``bound`` documents are used, chosen by the hash of id and text: languages have equal shares, and what one
    doesn't use is shared by the others. The documents of the least hash of a language are always used, so every language
    is learnt, also beyond the bound. Words are counted by language and the counts stay distributed; each round sums the
    expected counts of the pieces that the chosen texts have, which are as many as these texts' pieces at most.
    """
    spark = docs.sparkSession
    path = path or public_tokenizers.path("piece_bpe_32k.model")
    known = docs.where("lang is not null and text is not null")
    known = known.select(F.col("lang").cast("string").alias("lang"), text_bytes().alias("t"), F.pmod(F.xxhash64("doc_id", "text"), F.lit(_HASHES)).alias("h"))
    found = known.groupBy("lang").agg(F.count("*").alias("n"), F.min("h").alias("least")).collect()
    share = equal_share([r.n for r in found], bound)
    below = [(r.lang, max(int(min(1.0, share / r.n) * _HASHES), r.least + 1)) for r in found]
    limits = small(spark.createDataFrame(below, "lang string, below long"), len(below))
    chosen = known.join(limits, "lang").where("h < below")

    def count(part: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        from collections import Counter

        counts: dict[str, Counter] = {}
        parting = _parting()
        for lang, text in zip(part.columns[0].to_pylist(), part.columns[1].to_pylist()):
            counts.setdefault(lang, Counter()).update(text.translate(parting).split())
        rows = [(lang, w, n) for lang, c in counts.items() for w, n in c.items()]
        yield pa.record_batch(list(map(pa.array, zip(*rows))) if rows else [pa.array([], t) for t in (pa.string(), pa.binary(), pa.int64())], ["lang", "word", "n"])

    counted = in_batches(chosen.select("lang", "t"), count, "lang string, word binary, n long")
    words = cut(counted.groupBy("lang", "word").agg(F.sum("n").alias("n")))
    languages = sorted(r.lang for r in words.select("lang").distinct().collect())
    size = len(vocabulary_of(path).numbers) + 2
    number = {name: j for j, name in enumerate(languages)}
    none = (np.zeros(0, np.int64), np.zeros(0))
    model = Model(languages, [none] * len(languages), [1.0 / size] * len(languages), size, path)
    for _ in range(rounds if languages else 0):
        sent = spark.sparkContext.broadcast(model)

        def expect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            model, vocabulary = sent.value, vocabulary_of(path)
            sums: dict[int, np.ndarray] = {}
            for batch in batches:
                names, own = np.unique(np.array(batch.columns[0].to_pylist(), object), return_inverse=True)
                n, order = np.array(batch.columns[2].to_pylist(), float), np.argsort(own, kind="stable")
                for name, rows in zip(names, np.split(order, np.cumsum(np.bincount(own, minlength=len(names)))[:-1])):
                    j = number[name]
                    p, total = model.dense(j, j + 1)[:, 0], sums.setdefault(j, np.zeros(size))
                    words = [spelled(batch.columns[1][k].as_py()) for k in rows]
                    for at in in_groups(words):
                        total += Lattice([words[i] for i in at], vocabulary).expected(p, n[rows[at]])
                    if len(sums) > TOGETHER:
                        yield _expected(sums)
                        sums = {}
            yield _expected(sums)

        got = words.mapInArrow(expect, "i int, j int, n double").groupBy("i", "j").agg(F.sum("n").alias("n")).toPandas()
        sent.unpersist()
        columns, rest = [], []
        for j, own in enumerate(_by_language(got, len(languages))):
            total = 0.05 * (size - 1) + own.n.sum()
            columns.append((own.i.to_numpy(np.int64), np.maximum((0.05 + own.n.to_numpy()) / total, _FLOOR / 100)))
            rest.append(max(0.05 / total, _FLOOR / 100))
        model = Model(languages, columns, rest, size, path)
    return model


def _expected(sums: dict[int, np.ndarray]) -> pa.RecordBatch:
    held = [(np.flatnonzero(x), j) for j, x in sums.items()]
    i = np.concatenate([np.zeros(0, np.int64), *(x for x, _ in held)])
    j = np.repeat([j for _, j in held], [len(x) for x, _ in held]) if held else i
    n = np.concatenate([np.zeros(0), *(sums[j][x] for x, j in held)])
    return pa.record_batch([pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array(n)], ["i", "j", "n"])


def _by_language(rows: pd.DataFrame, languages: int) -> Iterator[pd.DataFrame]:
    rows = rows.sort_values(["j", "i"])
    edges = np.searchsorted(rows.j, np.arange(languages + 1))
    for a, b in zip(edges, edges[1:]):
        yield rows.iloc[a:b]


def _parting() -> bytes:
    """A byte table: ASCII letters lower-cased, other ASCII made blanks."""
    return bytes(b if b >= 128 else (b | 32) if chr(b).isalpha() else 32 for b in range(256))


def predict(docs: DataFrame, model: Model, keep: list[str]) -> DataFrame:
    """Columns ``keep``, ``lang_pred`` and ``score`` (the posterior of the language, 0 to 1) for every row of ``docs``.

    A text that is null or has no letter, or any text under a model without languages, is ``und`` with score 0. Ties go
    to the first language in order. Whole texts are scored; repeated rows score alike; other columns are not read.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)
    data = private(docs, "bytes")
    source = docs.select(*keep, text_bytes().alias(data))
    schema = source.drop(data).schema.add("lang_pred", "string").add("score", "double")
    memory: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def scored(tokens: textkit.Tokens, first: np.ndarray, p: np.ndarray, vocabulary: Vocabulary) -> np.ndarray:
        """Log-probabilities [token, language] of the tokens at ``first``."""
        words = [spelled(tokens.data[tokens.start[k] : tokens.end[k]]) for k in first]
        out = np.zeros((len(first), p.shape[1]))
        for at in in_groups(words):
            out[at] = Lattice([words[i] for i in at], vocabulary).forward(p)
        return out

    def looked_up(t: textkit.Tokens, name: np.ndarray, first: np.ndarray, a: int, model: Model) -> np.ndarray:
        """Log-probabilities [token, language] of the distinct tokens for the TOGETHER languages from ``a`` on; a worker remembers some."""
        p, vocabulary = model.dense(a, a + TOGETHER), vocabulary_of(model.path)
        known, old = memory.get(a, (np.zeros(0, np.uint64), np.zeros((0, p.shape[1]))))
        at = np.searchsorted(known, name)
        there = at < len(known)
        there[there] = known[at[there]] == name[there]
        table = np.zeros((len(name), p.shape[1]))
        table[there] = old[at[there]]
        if not there.all():
            table[~there] = scored(t, first[~there], p, vocabulary)
            if (len(known) + (~there).sum()) * len(model.languages) > REMEMBERED * min(len(model.languages), TOGETHER):
                memory[a] = (name, table)
            else:
                names = np.concatenate([known, name[~there]])
                order = np.argsort(names)
                memory[a] = (names[order], np.concatenate([old, table[~there]])[order])
        return table

    def work(part: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        model = sent.value
        texts = part.columns[-1].to_pylist()
        lettered = np.array([any(map(str.isalpha, x.decode())) for x in texts], bool)
        best, top, total = np.zeros(len(texts), np.int64), np.full(len(texts), -np.inf), np.zeros(len(texts))
        if model.languages:
            t = textkit.tokenise(texts, textkit.LETTER)
            name, first, inverse = np.unique(t.name, return_index=True, return_inverse=True)
        for a in range(0, len(model.languages), TOGETHER):
            table = looked_up(t, name, first, a, model)
            sums = np.stack([np.bincount(t.doc, table[inverse, j], minlength=len(texts)) for j in range(table.shape[1])], axis=1)
            own = sums.max(axis=1)
            best = np.where(own > top, a + sums.argmax(axis=1), best)
            high = np.maximum(top, own)
            total = total * np.exp(top - high) + np.exp(sums - high[:, None]).sum(axis=1)
            top = high
        seen = lettered & bool(model.languages)
        pred = [model.languages[b] if s else "und" for b, s in zip(best, seen)]
        score = 1 / np.maximum(total, 1)
        yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(pred, pa.string()), pa.array(np.where(seen, score, 0.0))], names=schema.names)

    return in_batches(source, work, schema)
