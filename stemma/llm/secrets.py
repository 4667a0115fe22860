"""Secret scans with SQL functions alone: three patterns, and candidate strings of high sliding-window entropy.

Places of a pattern: the text is split at its matches, and the lengths of the parts and of the matches, running summed,
are the places. Running values are made in blocks, as an array that grows by one in a fold is copied each time, so a text
costs in proportion to its length and matches. Entropy: candidates are runs of 20 or more token characters. The characters of a run are folded into the
symbols of its class (hexadecimal or base 64); a window of WINDOW symbols slides over it, and the sum of c*log2(c) over
the symbol counts c changes only by the entering and the leaving symbol, so counts are kept incrementally. A run is
reported where a window reaches the class's threshold, unless the allow-list suppresses it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stemma.llm.storage import private

#: The patterns of secrets, and group 2 of an assignment.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
#: Least characters of group 2.
ASSIGN_LEAST = 12
KINDS = ("assign", "access", "hex", "entropy")
CANDIDATE = r"[A-Za-z0-9+/_-]{20,}={0,2}"
WINDOW = 20
#: Least bits a symbol in a window, by class; random base 62 windows nearly all reach the second.
HEX_BITS, BASE64_BITS = 3.0, 3.5
#: A word in one case, capitalised or of capitalised parts; possessive, as Java would recurse otherwise.
_WORD = r"(?:[A-Z]++(?![a-z])|[A-Z]?[a-z]++(?:[A-Z][a-z]{2,}+)*+)"
#: Allow-list, candidates that are no secrets: words, and paths and compounds of words; UUIDs; rules of one repeated character; dates and times.
ALLOW = rf"^(?:[/_=+-]*+{_WORD}(?:[/_=+-]++{_WORD})*+[/_=+-]*+|[/_=+-]+|[0-9A-Fa-f]{8}(?:-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}|(.)\1+|[0-9/_-]+)$"
#: Paths and compounds of words and numbers are secrets only from these bits on.
_PART = rf"(?:{_WORD}[0-9]{{0,4}}+|[0-9]++)"
NUMBERED, NUMBERED_BITS = rf"^[/_=+-]*+{_PART}(?:[/_=+-]++{_PART})*+[/_=+-]*+$", 3.9
MASK = "<secret>"
#: Elements of a block of running values; levels of blocks over blocks; characters of a block of text.
_BLOCK, _LEVELS, _CHARS = 64, 3, 4096


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is worked out once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def running(values: Column, step: Callable[[Column, Column], Column], levels: int = _LEVELS) -> Column:
    """Running values of an array of int from 0 on: ``step`` is an associative sum or maximum of numbers not negative."""
    if not levels:
        none = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out"))
        push = lambda acc, x: _let(step(acc["at"], x), lambda v: F.struct(v.alias("at"), F.concat(acc["out"], F.array(v)).alias("out")))
        return F.aggregate(values, none, push, lambda acc: acc["out"])

    def joined(blocks: Column) -> Column:
        def carried(before: Column) -> Column:
            return F.flatten(F.transform(blocks, lambda x, k: F.transform(x, lambda y: F.when(k == 0, y).otherwise(step(F.get(before, k - 1), y)))))

        return _let(running(F.transform(blocks, lambda x: F.element_at(x, -1)), step, levels - 1), carried)

    def whole(v: Column) -> Column:
        blocks = F.transform(F.sequence(F.lit(0), F.size(v) - 1, F.lit(_BLOCK)), lambda k: running(F.slice(v, k + 1, _BLOCK), step, 0))
        return F.when(F.size(v) > 0, _let(blocks, joined)).otherwise(F.array().cast("array<int>"))

    return _let(values, whole)


def _places(text: Column, pattern: str) -> Column:
    """Array of struct(start, match) of the non-overlapping matches, leftmost first; the pattern never matches nothing."""

    def ended(x: Column) -> Column:
        steps = F.transform(x["found"], lambda m, k: F.get(x["gaps"], k) + F.length(m))
        return _let(running(steps, lambda a, b: a + b), lambda ends: F.transform(x["found"], lambda m, k: F.struct((F.get(ends, k) - F.length(m)).alias("start"), m.alias("match"))))

    both = F.struct(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("found"), F.transform(F.split(text, pattern, -1), F.length).alias("gaps"))
    return F.when(F.regexp_like(text, F.lit(pattern)), _let(both, ended)).otherwise(F.array().cast("array<struct<start:int,match:string>>"))


def _spans(places: Column, kind: int) -> Column:
    return F.transform(places, lambda x: F.struct(x["start"].alias("start"), F.lit(kind).alias("kind"), (x["start"] + F.length(x["match"])).alias("end")))


def _cell(count: Column) -> Column:
    """c * log2(c), 0 for 0."""
    return F.when(count > 0, count * F.log2(count.cast("double"))).otherwise(F.lit(0.0))


def window_entropy(run: Column) -> Column:
    """Highest Shannon entropy, in bits a symbol, of WINDOW neighbouring characters of ``run`` (the whole, if shorter).

    Each character costs a pass over the counts of the run's symbols, 66 at most.
    """
    return F.get(
        F.transform(F.array(F.struct(F.split(run, "").alias("all"))), lambda r: F.get(
            F.transform(F.array(F.struct(r["all"].alias("all"), F.array_distinct(r["all"]).alias("symbols"))), _slide), F.lit(0))),
        F.lit(0),
    )


def _slide(r: Column) -> Column:
    n = F.size(r["all"])
    width = F.least(F.lit(WINDOW), n)

    def step(acc: Column, i: Column) -> Column:
        entering = F.array_position(r["symbols"], F.get(r["all"], i)).cast("int") - 1
        leaving = F.when(i >= WINDOW, F.array_position(r["symbols"], F.get(r["all"], i - WINDOW)).cast("int") - 1).otherwise(F.lit(-1))
        own, other = F.get(acc["counts"], entering), F.get(acc["counts"], leaving)
        change = F.when(entering == leaving, F.lit(0.0)).otherwise(_cell(own + 1) - _cell(own) + F.when(leaving >= 0, _cell(other - 1) - _cell(other)).otherwise(F.lit(0.0)))
        total = acc["total"] + change
        counts = F.transform(acc["counts"], lambda c, k: c + (k == entering).cast("int") - (k == leaving).cast("int"))
        full = i >= width - 1
        return F.struct(counts.alias("counts"), total.alias("total"), F.when(full, F.least(acc["least"], total)).otherwise(acc["least"]).alias("least"))

    start = F.struct(F.transform(r["symbols"], lambda _: F.lit(0)).alias("counts"), F.lit(0.0).alias("total"), F.lit(1e9).alias("least"))
    return F.aggregate(F.sequence(F.lit(0), n - 1), start, step, lambda acc: F.log2(width.cast("double")) - acc["least"] / width)


def _secret_run(run: Column) -> Column:
    """Is a candidate a secret by its entropy? The cheap allow-list comes first."""
    hexadecimal = F.regexp_like(run, F.lit(r"^[0-9A-Fa-f]+$"))
    least = F.when(hexadecimal, HEX_BITS).when(F.regexp_like(run, F.lit(NUMBERED)), NUMBERED_BITS).otherwise(BASE64_BITS)
    return F.when(F.regexp_like(run, F.lit(ALLOW)), F.lit(False)).otherwise(window_entropy(run) >= least)


def scan(docs: DataFrame, text: str = "text", out: str = "secret_spans") -> DataFrame:
    """Add column ``out``: array of struct(start, kind, end) in code points, end exclusive, in order of start, then kind.

    ``kind`` numbers KINDS. Null and empty texts have no spans. Rows stand for themselves, so repeated rows, ties and
    null ids don't matter; columns of ``docs`` are kept, and ValueError is raised if one has the name ``out``. Whole texts are
    read, of any length and however many matches.
    """
    if out.lower() in (c.lower() for c in docs.columns):
        raise ValueError(f"there is a column {out} already")
    t = F.coalesce(F.col(text).cast("string"), F.lit(""))
    assign = F.filter(_places(t, ASSIGN), lambda x: F.length(F.regexp_extract(x["match"], ASSIGN, 2)) >= ASSIGN_LEAST)
    runs = F.filter(_places(t, CANDIDATE), lambda x: _secret_run(x["match"]))
    base = F.concat(_spans(assign, 0), _spans(_places(t, ACCESS), 1), _spans(_places(t, HEX), 2))
    return docs.withColumn(out, F.array_sort(F.concat(base, _spans(runs, 3))))


def written(spans: Column) -> Column:
    """The spans as kind:start:end, comma-joined; no spans are an empty text, and null ones null."""
    kinds = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.get(kinds, x["kind"]), x["start"].cast("string"), x["end"].cast("string"))), ",")


def masked(text: Column, spans: Column) -> Column:
    """``text`` with MASK in place of every span; spans that overlap or touch become one mask. ``spans`` are in order of their starts."""

    def part(blocks: Column, a: Column, b: Column) -> Column:
        """The characters from ``a`` to before ``b``; each block is read as far as needed, so a long text costs no more for its later parts."""
        cut = lambda k: F.substring(F.get(blocks, k), F.greatest(a - k * _CHARS, F.lit(0)) + 1, F.least(b - k * _CHARS, F.lit(_CHARS)) - F.greatest(a - k * _CHARS, F.lit(0)))
        return F.when(a < b, F.array_join(F.transform(F.sequence(F.floor(a / _CHARS).cast("int"), F.floor((b - 1) / _CHARS).cast("int")), cut), "")).otherwise(F.lit(""))

    def joined(x: Column) -> Column:
        def piece(s: Column, k: Column) -> Column:
            before = F.when(k == 0, F.lit(0)).otherwise(F.get(x["ends"], k - 1))
            return F.when((k > 0) & (s["start"] <= before), F.lit("")).otherwise(F.concat(part(x["blocks"], before, s["start"]), F.lit(MASK)))

        return F.concat(F.array_join(F.transform(x["spans"], piece), ""), part(x["blocks"], F.element_at(x["ends"], -1), x["n"]))

    ends = running(F.transform(spans, lambda s: s["end"]), lambda a, b: F.greatest(a, b))
    blocks = F.regexp_extract_all(text, F.lit(rf"(?s).{{1,{_CHARS}}}"), F.lit(0))
    return F.when(F.size(spans) == 0, text).otherwise(_let(F.struct(spans.alias("spans"), ends.alias("ends"), blocks.alias("blocks"), F.char_length(text).alias("n")), joined))


def redacted(docs: DataFrame) -> DataFrame:
    """``docs`` with MASK in place of the secrets in ``text``; ``n_chars``, if there, follows. Texts without secrets stay as they are."""
    spans = private(docs, "spans")
    found = scan(docs, out=spans)
    found = found.withColumn("text", F.when(F.size(spans) > 0, masked(F.col("text"), F.col(spans))).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        found = found.withColumn("n_chars", F.when(F.size(spans) > 0, F.char_length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return found.select(*docs.columns)
