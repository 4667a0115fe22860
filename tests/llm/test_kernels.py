"""Kernels and models against brute force."""

import hashlib
import math
import re
import zlib
from collections import Counter
from functools import cache

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from llm_plain import plain_probability, plain_segmentation
from stemma.llm import bpe, fingerprint, jaccard_join, language_id, lm, packing, textkit, toxicity

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
TEXT = st.text(alphabet=st.sampled_from(list("aAbB é\n\t\x0b. ß")), max_size=40)


@given(st.lists(TEXT, max_size=6))
@settings(max_examples=60, deadline=None)
def test_tokens(texts):
    t = textkit.tokenise([x.encode() for x in texts], textkit.SPACE)
    want = [(k, w) for k, x in enumerate(texts) for w in re.findall(r"[^\x20\x09-\x0D]+", x.translate(LOW))]
    assert [(int(d), t.data[a:b].decode()) for d, a, b in zip(t.doc, t.start, t.end)] == want
    names = {}
    for (_, w), n in zip(want, t.name):
        assert names.setdefault(w, n) == n
    assert len(set(names.values())) == len(names)


def test_long_tokens_over_slices(monkeypatch):
    texts = [b"ab " * 50 + b"x" * 100 + b" ab"]
    whole = textkit.tokenise(texts, textkit.SPACE).name
    monkeypatch.setattr(textkit, "_SLICE", 16)
    assert (textkit.tokenise(texts, textkit.SPACE).name == whole).all()


@given(st.lists(TEXT, max_size=6))
@settings(max_examples=60, deadline=None)
def test_sets(texts):
    got = jaccard_join.sets([x.encode() for x in texts])
    words = [re.findall(r"[^\x20\x09-\x0D]+", x.translate(LOW)) for x in texts]
    want = [set(zip(w, w[1:], w[2:])) if len(w) >= 3 else {tuple(w)} if w else set() for w in words]
    assert [len(x) for x in got] == [len(x) for x in want]
    for a, x in zip(got, want):
        for b, y in zip(got, want):
            assert len(np.intersect1d(a, b)) == len(x & y)


@given(st.integers(0, 5000))
def test_lengths(n):
    parts = packing.lengths(n)
    assert sum(parts) == n and all(x & (x - 1) == 0 and x <= 1024 for x in parts) and parts == sorted(parts, reverse=True)
    assert len([x for x in parts if x < 1024]) == bin(n % 1024).count("1")


@pytest.mark.parametrize("text", ["", "Hello  world\n\n don't <|endoftext|> 12345 ÄÖ é   ...", " " * 50, "x" * 3000, "日本語 текст"])
def test_ids_are_those_of_the_tokenizer(text):
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    assert bpe.encoder(public_tokenizers.path("byte_bpe_50k.json"))(text) == np.array(t.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
    t.encode_special_tokens = True
    assert bpe.encoder(public_tokenizers.path("byte_bpe_50k.tiktoken"))(text) == np.array(t.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


@cache
def _plain():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


PARTS = ["<|endoftext|>", "a", " ", "\n", "  ", "é", "<|", "|>", "end", "1", "'s", "。", "\u3000", " " * 2500, "\n" * 3000, "\x85\xa0" * 1500, "\x1c" * 2500]


@given(st.lists(st.sampled_from(PARTS), max_size=12))
@settings(max_examples=150, deadline=None)
def test_ids_around_long_blanks_and_special_strings(parts):
    t = _plain()
    text = "".join(parts)
    assert bpe.encoder(public_tokenizers.path("byte_bpe_50k.json"))(text) == np.array(t.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


def test_ids_of_a_very_long_run():
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for text in (" " * 1_200_000 + "x", "\n " * 600_000, "ab" * 600_000):
        assert bpe.encoder(public_tokenizers.path("byte_bpe_50k.json"))(text) == np.array(t.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


def test_unordered_vocabularies_are_refused():
    with pytest.raises(ValueError):
        bpe.encoder(public_tokenizers.path("word_bpe_49k.json"))


PIECES = ["a", "b", "ab", "ba", "aba", "abababababababa"]


def some_probabilities(languages=2):
    p = np.random.default_rng(0).random((len(PIECES) + 2, languages)) * 0.2
    p[0] = 0
    return p


@given(st.lists(st.text(alphabet="abx", min_size=1, max_size=70), min_size=1, max_size=5), st.sampled_from([3, 5, 24]))
@settings(max_examples=60, deadline=None)
def test_forward_sums_all_segmentations(words, window):
    vocabulary, p = language_id.Vocabulary(PIECES), some_probabilities()
    words = sorted(words, key=len)
    old, language_id.WINDOW = language_id.WINDOW, window
    try:
        lattice = language_id.Lattice(words, vocabulary)
        assert np.allclose(lattice.forward(p), [[plain_segmentation(w, vocabulary.numbers, p[:, j]) for j in range(2)] for w in words])
        got = lattice.expected(p[:, 0], np.arange(1.0, len(words) + 1))
    finally:
        language_id.WINDOW = old
    want = np.zeros(len(p))
    for k, w in enumerate(words):
        want += (k + 1) * plain_uses(w, vocabulary.numbers, p[:, 0])
    assert np.allclose(got, want)


def plain_uses(word, numbers, p):
    """Expected uses: the derivative of the log-probability by the logarithms of the probabilities."""
    out = np.zeros(len(p))
    for k in range(1, len(p)):
        up, down = p.copy(), p.copy()
        up[k] *= 1 + 1e-5
        down[k] *= 1 - 1e-5
        out[k] = (plain_segmentation(word, numbers, up) - plain_segmentation(word, numbers, down)) / 2e-5
    return out


def test_words_of_any_length():
    """No segmentation across a window is lost, nothing underflows, and groups of words score like words alone."""
    vocabulary = language_id.vocabulary_of(public_tokenizers.path("piece_bpe_32k.model"))
    rng = np.random.default_rng(2)
    p = rng.random((len(vocabulary.numbers) + 2, 3)) / len(vocabulary.numbers)
    p[0] = 0
    words = ["\u2581" + "".join(rng.choice(list("abcdefgino"), n)) for n in (1, 5, 23, 24, 25, 1_000, 30_000)] + ["\u2581" + "日本語の文章は分かち書きをしない" * 60]
    got = np.zeros((len(words), 3))
    for at in language_id.in_groups(words):
        got[at] = language_id.Lattice([words[i] for i in at], vocabulary).forward(p)
    assert np.isfinite(got).all()
    assert np.allclose(got, [[plain_segmentation(w, vocabulary.numbers, p[:, j]) for j in range(3)] for w in words])
    assert max(map(len, vocabulary.numbers)) > 12 and language_id.spelled(("x" * 1000).encode()) == "\u2581" + "x" * 1000


def test_expected_counts():
    vocabulary = language_id.Vocabulary(["a", "b", "ab"])
    p = np.array([0, 0.1, 0.3, 0.3, 0.3])
    got = language_id.Lattice(["ab"], vocabulary).expected(p, np.array([2.0]))
    split, whole = 0.09 / 0.39, 0.3 / 0.39
    number = {w: i + 2 for w, i in vocabulary.numbers.items()}
    want = np.zeros(5)
    want[[number["a"], number["b"], number["ab"]]] = 2 * split, 2 * split, 2 * whole
    assert np.allclose(got, want)


def test_ftrl_finds_the_word():
    rng = np.random.default_rng(0)
    words = [f"w{i}" for i in range(50)]
    texts, labels = [], []
    for k in range(600):
        bad = k % 4 == 0
        texts.append(" ".join([*rng.choice(words, 20), *(["vile"] if bad else [])]).encode())
        labels.append(int(bad))
    doc, at = toxicity.features(texts)
    rows = np.split(at, np.searchsorted(doc, np.arange(1, len(texts))))
    model = toxicity.ftrl(rows[:400], labels[:400])
    dense = np.zeros(2**toxicity.BITS)
    dense[model.index] = model.weight
    score = np.array([1 / (1 + math.exp(-(model.bias + dense[r].sum()))) for r in rows[400:]])
    assert ((score >= toxicity.THRESHOLD) == np.array(labels[400:])).all()
    assert len(model.index) < 2000


def test_language_model_is_normalised_and_learns():
    rng = np.random.default_rng(1)
    # A word after the two before it: neither of them tells it alone.
    first, second = rng.integers(0, 8, 20_000), rng.integers(8, 16, 20_000)
    out = np.stack([first, second, 16 + 4 * (first // 2) + (second - 8) // 2, np.full(20_000, lm.WORDS)], axis=1).reshape(-1)
    doc = np.repeat(np.arange(20_000), 4)
    unigram = np.bincount(out, minlength=lm.OUTCOMES) / len(out)
    unigram = unigram.reshape(lm.GROUPS + 1, lm.MEMBERS)
    v = lm.Vectors.new(unigram)
    squares = [np.full_like(x, 1e-2) for x in v.arrays()]
    context = lm.contexts(out, doc)
    start = lm.log_probability(v, context, out).reshape(-1, 4)
    for _ in range(12):
        for k in range(0, len(out), lm.STEP):
            lm.train(v, squares, unigram, context[:, k : k + lm.STEP], out[k : k + lm.STEP])
    got = lm.log_probability(v, context, out).reshape(-1, 4)
    assert got[:, 2].mean() > -0.3 and got[:, 3].mean() > -0.1 and got.mean() > start.mean() + 0.5
    assert got[:, 0].mean() < start[:, 0].mean() + 1.5
    every = np.flatnonzero(unigram.reshape(-1))
    for k in (0, 1, 2, 3, 40_001):
        assert math.isclose(sum(plain_probability(v, context[:, k], int(x)) for x in every), 1, rel_tol=1e-4)
        assert math.isclose(plain_probability(v, context[:, k], int(out[k])), math.exp(got.reshape(-1)[k]), rel_tol=1e-3)


def test_sums_of_extreme_scores():
    score = np.array([[-200, -201], [90, 95], [0, -1e4]], np.float32)
    for rows in (score, score[:1], score[2:]):
        assert np.allclose(lm._log_sum(rows), np.logaddexp.reduce(rows.astype(float), axis=1), rtol=1e-5, atol=1e-5)


def test_noise_contrastive_gradient():
    """The gradient is that of the objective written out, by differences."""
    rng = np.random.default_rng(0)
    unigram = rng.random((lm.GROUPS + 1, lm.MEMBERS))
    unigram /= unigram.sum()
    scores, target = rng.normal(0, 1, (3, lm.MEMBERS)), np.array([5, 9, 5])
    noise = unigram[4] / unigram[4].sum()
    sigmoid = lambda x: 1 / (1 + math.exp(-x))

    def objective(s):
        d = s - np.log(lm.NOISE * noise)
        return sum(math.log(sigmoid(d[k, t])) for k, t in enumerate(target)) + sum(lm.NOISE * noise[w] * math.log(1 - sigmoid(d[k, w])) for k in range(3) for w in range(lm.MEMBERS))

    got = -lm._contrast(-scores, lm.NOISE * noise, target)
    for k, w in ((0, 5), (0, 6), (1, 9), (2, 0)):
        shift = np.zeros_like(scores)
        shift[k, w] = 1e-5
        assert math.isclose(got[k, w], (objective(scores + shift) - objective(scores - shift)) / 2e-5, rel_tol=1e-3, abs_tol=1e-6)


def test_phrases_are_locally_consistent():
    rng = np.random.default_rng(2)
    inner = "".join(rng.choice(list("abcdefgh "), 4000))
    a, b = fingerprint.sketches([inner, "".join(rng.choice(list("abcdefgh "), 333)) + inner])
    assert fingerprint.likeness(a, b) > 0.75
    symbols = lambda t: textkit.mix(np.frombuffer(t.encode("utf-32-le"), "<u4").astype(np.uint64) + np.uint64(1))
    one, _ = fingerprint.phrases(symbols(inner), np.zeros(len(inner), int))
    other, _ = fingerprint.phrases(symbols("xyz" + inner), np.zeros(len(inner) + 3, int))
    assert (one[20:-20] == other[-len(one) + 20 : -20]).all()


@pytest.mark.parametrize("text", ["", "a", "aaaaaa", "ab", "abab" * 9, "é" * 100, "a\n\n\nb"])
def test_sketches_of_odd_texts(text):
    (a,), (b,) = fingerprint.sketches([text]), fingerprint.sketches([text])
    assert (a == b).all() and 1 <= len(a) <= fingerprint.KEPT and fingerprint.likeness(a, b) == 1.0


def test_edited_text():
    assert fingerprint.edited("abcdefg", "xyz") == "abcdexy" and fingerprint.edited("abcdefg", "z") == "abcdez" and fingerprint.edited("", "x") == ""
    assert hashlib.sha256(fingerprint.edited("ab", "c").encode()).hexdigest() == hashlib.sha256(b"ab").hexdigest()


def test_named_tokens_and_contexts():
    name, doc, _ = lm.named([b"a b", b"", b"A"])
    assert doc.tolist() == [0, 0, 0, 1, 2, 2] and name[0] == name[4] and name[2] == name[3] == name[5]
    out = np.array([5, 6, 7, 8, 9, 3])
    b = lm.WORDS
    assert lm.contexts(out, doc).tolist() == [[b, 5, 6, b, b, 9], [b, b, 5, b, b, b], [b] * 6]
    assert lm.contexts(out[:1], doc[:1]).tolist() == [[b]] * 3 and lm.contexts(out[:0], doc[:0]).shape == (3, 0)
    assert Counter(doc.tolist()) == {0: 3, 1: 1, 2: 2} and zlib.crc32(b"") == 0
