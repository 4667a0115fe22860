"""Scalar functions that need Python, and their Arrow-batched forms."""

from __future__ import annotations

import re
import unicodedata

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Letters written as LaTeX commands, and letters that don't decompose. Fixed values.
LATEX_LETTERS = {
    "AA": "A", "AE": "Ae", "aa": "a", "ae": "e", "oslash": "o", "Oslash": "O", "OE": "OE", "oe": "oe", "O": "O", "o": "o", "L": "L", "l": "l", "i": "i", "j": "j",
    "NG": "NG", "ng": "ng", "texteng": "ng", "ss": "ss", "textbari": "i", "textbaru": "u", "textbarI": "I", "textbarU": "U", "texthtd": "d", "texthtb": "b",
    "textopeno": "o", "textepsilon": "e", "textschwa": "e", "textrhooktopd": "d", "textthorn": "th",
}
PLAIN_LETTERS = {"ø": "o", "Ø": "O", "ł": "l", "Ł": "L", "ŋ": "ng", "Ŋ": "NG", "ə": "@", "þ": "th", "Þ": "Th", "ß": "ss", "æ": "ae", "Æ": "AE", "œ": "oe", "Œ": "OE", "ð": "d", "Ð": "D", "đ": "d", "Đ": "D", "ı": "i", "ʔ": "?", "’": "'", "‘": "'", "“": '"', "”": '"', "–": "-", "—": "--", "ɔ": "o", "ɛ": "e", "ɓ": "b", "ɗ": "d"}
#: Accents as LaTeX commands and their combining characters. Fixed values.
ACCENTS = {"`": "\u0300", "'": "\u0301", "^": "\u0302", '"': "\u0308", "H": "\u030b", "~": "\u0303", "c": "\u0327", "k": "\u0328", "=": "\u0304", "b": "\u0331", ".": "\u0307", "d": "\u0323", "r": "\u030a", "u": "\u0306", "v": "\u030c"}
UNICODE_LETTERS = {"AA": "Å", "AE": "Æ", "aa": "å", "ae": "æ", "O": "Ø", "o": "ø", "L": "Ł", "l": "ł", "i": "ı", "ss": "ß", "OE": "Œ", "oe": "œ", "ng": "ŋ", "NG": "Ŋ", "textschwa": "ə", "textopeno": "ɔ", "textepsilon": "ɛ", "texthtb": "ɓ", "texthtd": "ɗ", "textthorn": "þ", "textbari": "ɨ", "textbaru": "ʉ"}

# A command is tried against the listed letters in their order, so that ``\oslash`` is not ``\o`` and a rest.
_LETTER = re.compile(r"\\(" + "|".join(LATEX_LETTERS) + r")(?:\{\})?")
_ACCENT = re.compile(r"\\([`'^\"H~ckl=b.druvt])(?:\{([a-zA-Z])\}|([a-zA-Z]))")


def undiacritic(text: str) -> str:
    """Text without diacritics, as Unicode or as LaTeX, for comparison."""
    if not text.isascii():
        text = unicodedata.normalize("NFKD", "".join(PLAIN_LETTERS.get(c, c) for c in text))
        text = "".join(c for c in text if not unicodedata.combining(c))
    if "\\" in text or "{" in text or "}" in text:
        text = _LETTER.sub(lambda m: LATEX_LETTERS[m[1]], text)
        text = re.sub(r"\\text[a-z]+\{([^}]*)\}", r"\1", text)
        text = re.sub(r"\\text[a-z]+", "", text)
        text = _ACCENT.sub(lambda m: m[2] or m[3], text)
        text = re.sub(r"\\[^\s{}]+\{|\\.|[{}]", "", text)
    return text


def from_latex(text: str) -> str:
    """LaTeX letters and accents as Unicode, single characters out of their braces."""
    if "\\" in text:
        text = re.sub(r"\\(" + "|".join(sorted(UNICODE_LETTERS, key=len, reverse=True)) + r")(?:\{\}|(?![A-Za-z])\s?)", lambda m: UNICODE_LETTERS[m[1]], text)
        accent = re.compile(r"\\(?:([`'^\"~=.])\s?(?:\{\\?([a-zA-Zı])\}|\\?([a-zA-Zı]))|([Hckbdruv])(?:\{\\?([a-zA-Zı])\}|\s\\?([a-zA-Zı])))")
        text = accent.sub(lambda m: unicodedata.normalize("NFC", (m[2] or m[3] or m[5] or m[6]).replace("ı", "i") + ACCENTS[m[1] or m[4]]), text)
    return re.sub(r"\{(.)\}", r"\1", text)


def to_latex(text: str) -> str:
    """Non-ASCII letters as LaTeX, as far as there is a command for them."""
    letters, marks = {v: k for k, v in UNICODE_LETTERS.items()}, {v: k for k, v in ACCENTS.items()}
    out = []
    for c in text:
        parts = unicodedata.normalize("NFD", c)
        if c.isascii():
            out.append(c)
        elif c in letters:
            out.append(f"{{\\{letters[c]}}}")
        elif len(parts) == 2 and parts[1] in marks and parts[0].isascii():
            out.append(f"\\{marks[parts[1]]}{{{parts[0]}}}")
        else:
            out.append(c)
    return "".join(out)


def u_escape(text: str) -> str:
    """Non-ASCII characters as ``?[\\u<decimal>]``."""
    return "".join(c if c.isascii() else f"?[\\u{ord(c)}]" for c in text)


def u_unescape(text: str) -> str:
    """``?[\\u<decimal>]`` with three to five digits as its character."""
    return re.sub(r"\?\[\\u(\d{3,5})\]", lambda m: chr(int(m[1])), text)


def to_roman(n: int) -> str:
    """Lower-case Roman digits, where only four of a digit are written by the next one: 9 is ``viv``."""
    out, digits = "", [(1000, "m", ""), (500, "d", "m"), (100, "c", "d"), (50, "l", "c"), (10, "x", "l"), (5, "v", "x"), (1, "i", "v")]
    for value, digit, above in digits:
        times, n = divmod(n, value)
        out += digit + above if times == 4 and above else digit * times
    return out


def roman(text: str) -> str:
    """All numbers of a text as Roman ones, upper-case."""
    return re.sub(r"\d+", lambda m: to_roman(int(m[0])), text).upper()


def _column(function, kind: T.DataType = T.StringType()):
    @F.pandas_udf(kind)
    def run(values: pd.Series) -> pd.Series:
        return values.map(lambda x: None if x is None else function(x))

    return run


undiacritic_of, from_latex_of, to_latex_of, u_escape_of, u_unescape_of, roman_of = (_column(f) for f in (undiacritic, from_latex, to_latex, u_escape, u_unescape, roman))
character_name = _column(lambda c: unicodedata.name(c, "") if c else "")
