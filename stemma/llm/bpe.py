"""Byte-level BPE ids of whole texts from public vocabulary files.

Texts of every length go one way. A run of white space is one token of the splitting pattern but for its last character,
so very long runs, for which the pattern's lookahead would need a deep stack, are cut out there and merged as one piece.
"""

from __future__ import annotations

import base64
import json
import re
from collections.abc import Callable
from functools import cache

import numpy as np
import public_tokenizers
import tiktoken

#: White space as the splitting pattern has it, in runs that are cut out before it is applied.
_RUN = re.compile(r"[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{2000,}")
_OPEN: dict[tuple[str, bool], Callable[[str], bytes]] = {}


def _byte_of() -> dict[str, int]:
    """The byte that each character of a vocabulary's pieces stands for: printable ones themselves, the others from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(other)}


def _json_ranks(path: str) -> tuple[dict[bytes, int], dict[str, int]]:
    """Ranks and special tokens of a JSON vocabulary; ValueError if its ids aren't in the order of its merges."""
    with open(path, encoding="utf-8") as file:
        data = json.load(file)
    added = {t["content"]: t["id"] for t in data["added_tokens"]}
    vocabulary = {k: v for k, v in data["model"]["vocab"].items() if k not in added}
    merged = [vocabulary["".join(m if isinstance(m, list) else m.split(" "))] for m in data["model"]["merges"]]
    split = data["pre_tokenizer"]
    plain = split["type"] == "ByteLevel" and split["use_regex"] and not split["add_prefix_space"] and data["normalizer"] is None
    if not plain or merged != sorted(merged) or any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in data["added_tokens"]):
        raise ValueError(f"{path} is no vocabulary of ranked byte pairs")
    byte = _byte_of()
    return {bytes(byte[c] for c in piece): i for piece, i in vocabulary.items()}, added


def _ranks(path: str) -> tuple[dict[bytes, int], dict[str, int]]:
    if path.endswith(".json"):
        return _json_ranks(path)
    with open(path, "rb") as file:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}, {}


@cache
def piece_bytes(path: str) -> list[bytes]:
    """The bytes of every id of a vocabulary file; an id without an entry has none, a special token those of its string."""
    ranks, special = _ranks(path)
    found = {i: b for b, i in ranks.items()} | {i: s.encode() for s, i in special.items()}
    return [found.get(i, b"") for i in range(max(found) + 1)]


def _opened(path: str, with_special: bool) -> Callable[[str], bytes]:
    ranks, special = _ranks(path)
    special = special if with_special else {}
    coding = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special)
    piece = tiktoken.Encoding("piece", pat_str=r"[\s\S]+", mergeable_ranks=ranks, special_tokens={})
    whole = lambda text: coding.encode_to_numpy(text, allowed_special="all", disallowed_special=()).astype("<u4").tobytes()

    def run(text: str) -> bytes:
        out, at = [], 0
        for m in _RUN.finditer(text) if len(text) >= 2000 else ():
            # Before the text's end or a special token, the run is a piece up to its last character.
            last = m.end() == len(text) or any(text.startswith(s, m.end()) for s in special)
            end = m.end() - (0 if last else 1)
            out.append(whole(text[at : m.start()]))
            out.append(np.array(piece.encode_ordinary(text[m.start() : end]), "<u4").tobytes())
            at = end
        return b"".join([*out, whole(text[at:])]) if out else whole(text)

    return run


def encoder(path: str, special: bool = True) -> Callable[[str], bytes]:
    """The worker's encoder for a vocabulary file, opened once: ids of a text as little-endian unsigned 32-bit values.

    The ids are those that ``tokenizers`` gives for a ``.json`` file with ``add_special_tokens=False``: the strings of the
    file's special tokens become their ids, but without ``special`` they are plain text. A ``.tiktoken`` file of ranks has
    no special tokens.
    """
    if (path, special) not in _OPEN:
        _OPEN[path, special] = _opened(path, special)
    return _OPEN[path, special]
