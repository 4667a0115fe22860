"""What the operators compute, written out plainly."""

import math
from itertools import groupby

import numpy as np

from stemma.llm import fingerprint, lm, textkit, toxicity

_ALL = (1 << 64) - 1


def plain_probability(v, before, outcome):
    """The model's probability of an outcome after others, nearest first, written out."""
    r = sum(np.float64(v.distance[j]) * v.context[c] for j, c in enumerate(before))
    groups = [math.exp(float(r @ g[:-1] + g[-1])) for g in v.group]
    g, m = divmod(outcome, lm.MEMBERS)
    words = [math.exp(float(r @ w[:-1] + w[-1])) for w in v.word[g]]
    return groups[g] / sum(groups) * words[m] / sum(words)


def plain_segmentation(word, numbers, p):
    """Logarithm of the sum over all segmentations, by a plain sum in logarithms for each character."""
    longest = max(map(len, numbers))
    at = [0.0]
    for end in range(1, len(word) + 1):
        terms = []
        for size in range(1, min(longest, end) + 1):
            i = numbers.get(word[end - size : end])
            if i is not None or size == 1:
                terms.append(at[end - size] + math.log(p[1 if i is None else i + 2]))
        top = max(terms)
        at.append(top + math.log(sum(math.exp(t - top) for t in terms)))
    return at[-1]


def _mix(x):
    x = (x ^ x >> 30) * 0xBF58476D1CE4E5B9 & _ALL
    x = (x ^ x >> 27) * 0x94D049BB133111EB & _ALL
    return x ^ x >> 31


def _tossed(label, left):
    differ = label ^ left
    low = (differ & -differ).bit_length() - 1
    return 2 * low + (label >> low & 1)


def _level(symbols):
    """Names of the phrases of one text."""
    rows = []
    for s, run in groupby(symbols):
        n = len(list(run))
        rows.append(s if n == 1 else _mix((s + _mix(n * 0x9E3779B97F4A7C15 & _ALL)) & _ALL))
    labels = [_tossed(s, rows[k - 1] if k else ~s & _ALL) for k, s in enumerate(rows)]
    for _ in range(fingerprint.ROUNDS - 1):
        labels = [_tossed(x, labels[k - 1] if k else ~x & 255) for k, x in enumerate(labels)]
    starts = [0] + [k for k in range(2, len(rows) - 1) if labels[k] > labels[k - 1] and labels[k] > labels[k + 1]]
    out = []
    for a, b in zip(starts, [*starts[1:], len(rows)]):
        total = 0
        for place, s in enumerate(rows[a:b]):
            weight = _mix((min(place, 63) + 1) * 0xD1342543DE82EF95 & _ALL) + (place if place >= 64 else 0)
            total += _mix(s) * (weight | 1)
        out.append(_mix(total & _ALL))
    return out


def plain_phrases(text):
    """The names of all phrases that count for a text's fingerprint."""
    symbols, found, level = [_mix(ord(c) + 1) for c in text], set(), 0
    if not symbols:
        found.add(0)
    while symbols:
        if level >= fingerprint.FIRST or len(symbols) == 1:
            found |= set(symbols)
        symbols = _level(symbols) if len(symbols) > 1 else []
        level += 1
    return {_mix(x ^ 0xA5A5A5A5A5A5A5A5) >> 32 for x in found}


def plain_features(text):
    """Coordinates of the words, pairs and skip pairs of a text, each looked up by itself."""
    at = lambda words, gaps: int(textkit.grams(textkit.tokenise([" ".join(words).encode()], textkit.ALNUM), gaps)[0][0] >> np.uint64(64 - toxicity.BITS))
    w = text.split()
    return {at([x], ()) for x in w} | {at(x, (1,)) for x in zip(w, w[1:])} | {at([a, "x", b], (2,)) for a, b in zip(w, w[2:])}


def plain_ftrl(rows, labels, epochs=5, alpha=0.5, beta=1.0, l1=8.0, l2=1.0):
    """Weights by coordinate and the bias, one coordinate at a time."""
    z, n, bias = {}, {}, -1

    def weight(i):
        own, least = z.get(i, 0.0), 0.0 if i == bias else l1
        return 0.0 if abs(own) <= least else -(own - math.copysign(least, own)) / ((beta + math.sqrt(n.get(i, 0.0))) / alpha + l2)

    for epoch in range(epochs):
        for k in np.random.default_rng(epoch).permutation(len(rows)):
            w = {i: weight(i) for i in [*rows[k], bias]}
            g = 1 / (1 + math.exp(-sum(w.values()))) - labels[k]
            for i, x in w.items():
                before = n.get(i, 0.0)
                z[i] = z.get(i, 0.0) + g - (math.sqrt(before + g * g) - math.sqrt(before)) / alpha * x
                n[i] = before + g * g
    return {i: weight(i) for i in z if i != bias}, weight(bias)
