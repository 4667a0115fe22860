"""Vectorised kernels over batches of UTF-8 texts: token boundaries, 64-bit token names and n-gram names."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

_U = np.uint64
_ODD = _U(0x9E3779B97F4A7C15)
#: Names of byte values; fixed by the seed, so equal tokens have equal names on every machine.
_BYTE = np.random.default_rng(20_240_229).integers(1, 2**63, 256, dtype=np.uint64) * _U(2) + _U(1)
_BASE = 0xD1342543DE82EF95
_INVERSE = pow(_BASE, -1, 2**64)
#: Bytes hashed at once.
_SLICE = 1 << 20
_POWERS = [np.ones(0, np.uint64), np.ones(0, np.uint64)]


def separators(pattern: str) -> np.ndarray:
    """Which byte values part tokens: ``space`` (0x20, 0x09-0x0D) or ``alnum`` (all ASCII but letters and digits) or ``letter`` (all ASCII but letters)."""
    out = np.zeros(256, bool)
    if pattern == "space":
        out[[0x20, *range(0x09, 0x0E)]] = True
    else:
        out[:128] = True
        out[ord("a") : ord("z") + 1] = out[ord("A") : ord("Z") + 1] = False
        if pattern == "alnum":
            out[ord("0") : ord("9") + 1] = False
    return out


SPACE, ALNUM, LETTER = (separators(x) for x in ("space", "alnum", "letter"))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit names (splitmix64 finaliser)."""
    x = x ^ (x >> _U(30))
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


def distinct(x: np.ndarray) -> np.ndarray:
    """The sorted distinct values of an array, by sorting."""
    x = np.sort(x)
    return x[np.concatenate([[True], x[1:] != x[:-1]])] if len(x) else x


def _powers(n: int) -> list[np.ndarray]:
    if len(_POWERS[0]) < n:
        for i, base in enumerate((_BASE, _INVERSE)):
            ones = np.full(n, base, np.uint64)
            ones[0] = 1
            _POWERS[i] = np.cumprod(ones)
    return _POWERS


@dataclass
class Tokens:
    """Tokens of a batch: ``name`` (uint64), ``doc`` (row in the batch), ``start``/``end`` into ``data`` (lower-cased bytes)."""

    data: bytes
    name: np.ndarray
    doc: np.ndarray
    start: np.ndarray
    end: np.ndarray
    docs: int

    def counts(self) -> np.ndarray:
        return np.bincount(self.doc, minlength=self.docs)


def tokenise(texts: list[bytes], separator: np.ndarray) -> Tokens:
    """Split texts, ASCII letters lower-cased, at separator bytes and name each token by its bytes.

    Names are 64-bit hashes with a fixed seed: tokens of natural text don't share one, while long tokens made by someone
    who knows the seed could.
    """
    data = b" " + b" ".join(texts).lower() + b" "
    raw = np.frombuffer(data, np.uint8)
    keep = ~separator[raw]
    start = np.flatnonzero(keep[1:] & ~keep[:-1]) + 1
    end = np.flatnonzero(keep[:-1] & ~keep[1:]) + 1
    name = np.empty(len(start), np.uint64)
    at = 0
    while at < len(start):
        to = int(np.searchsorted(end, start[at] + _SLICE, "right"))
        to = max(to, at + 1)
        a, b = int(start[at]), int(end[to - 1])
        power, inverse = _powers(max(b - a, _SLICE))
        total = np.zeros(b - a + 1, np.uint64)
        np.cumsum(_BYTE[raw[a:b]] * power[: b - a], out=total[1:])
        s = start[at:to] - a
        name[at:to] = mix((total[end[at:to] - a] - total[s]) * inverse[s])
        at = to
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    first = np.cumsum(lengths + 1) - lengths
    doc = np.searchsorted(first, start, "right") - 1
    return Tokens(data, name, doc, start, end, len(texts))


def grams(tokens: Tokens, gaps: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray]:
    """Names of the tuples of tokens at the offsets 0, ``gaps``... within one text, and the texts' rows."""
    reach = gaps[-1] if gaps else 0
    n = max(0, len(tokens.name) - reach)
    out = tokens.name[:n] * _ODD
    for k, gap in enumerate(gaps):
        out = out + mix(tokens.name[gap : gap + n] + _U(2 * k + 3 + 16 * gap)) * _U(2 * k + 0x2545F4914F6CDD1D)
    inside = tokens.doc[:n] == tokens.doc[reach : reach + n]
    return mix(out[inside]), tokens.doc[:n][inside]
