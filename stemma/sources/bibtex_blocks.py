"""Large BibTeX files read by many tasks: a task reads whole blocks of a file's lines, and entries over borders are put together.

Where an entry begins hangs on the braces before it. So a first pass tells of each block what it makes of every depth of
braces that may come in, up to DEPTHS: the depth that goes out, and whether the entry that comes in ends in it. A block that
starts outside an entry begins with text that is skipped. Over the blocks of a file these answers are put together to the
depth that does come in, one small row for each block. A second pass cuts each block where the entry from before ends, and
gives that head to the block in which the entry began. Names for texts (``@string``) reach the blocks behind them. Files whose
blocks leave something open (entries in parentheses, a type whose brace is in another block, more depth than DEPTHS) are
read whole.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import islice

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stemma.joins import few
from stemma.lineage import cut
from stemma.sources import bibtex

#: Depths that a block answers for.
DEPTHS = 32
_BRACE = re.compile(r"\\.|[{}]", re.S)
_TYPE = re.compile(r"@\s*([^\s\"#%'(),={}]+)\s*(.?)", re.S)
#: What is given for a depth that a block can't answer for.
OPEN = -1
#: Bytes of small blocks that a task reads one after another, and entries that leave a task's Python at once.
TASK_BYTES, ENTRIES = 8 << 20, 1_000
_KEY = ["path", "start"]


def ends_of(text: str, at: int = 0, depth: int = 0) -> tuple[int, int, list[int]]:
    """From ``at`` on, outside an entry (depth 0) or that deep in one: the depth at the end, where the first entry ends (or -1), and all places outside.

    The depth is OPEN where it can't be told.
    """
    first, outside = -1, [at] if depth == 0 else []
    while True:
        if depth == 0:
            found = _TYPE.search(text, at)
            while found and found[1].lower() == "comment":
                found = _TYPE.search(text, found.start() + 1)
            if not found:
                rest = text[text.rfind("@", at) :] if "@" in text[at:] else ""
                return (OPEN if rest.strip() == "@" else 0), first, outside
            if found[2] != "{":
                return OPEN, first, outside
            at, depth = found.end(), 1
        for m in _BRACE.finditer(text, at):
            depth += {"{": 1, "}": -1}.get(m[0], 0)
            if depth == 0:
                at = m.end()
                first = at if first < 0 else first
                outside.append(at)
                break
        else:
            return depth, first, outside


def answers(text: str) -> tuple[list[int], list[bool], int]:
    """For each depth up to DEPTHS: the depth that goes out, and whether the block comes to be outside; and what deeper ones are raised by."""
    out, reaches, total = [0] * (DEPTHS + 1), [True] * (DEPTHS + 1), 0
    lows: list[int] = []
    for m in _BRACE.finditer(text):
        total += {"{": 1, "}": -1}.get(m[0], 0)
        if total < -len(lows):
            lows.append(m.end())
    known: dict[int, int] = {}
    for d in range(DEPTHS + 1):
        if d > len(lows):
            out[d], reaches[d] = d + total, False
            continue
        at = lows[d - 1] if d else 0
        if at not in known:
            depth, _, outside = ends_of(text, at)
            known |= dict.fromkeys(outside, depth)
        out[d] = known[at]
    return out, reaches, total if len(lows) <= DEPTHS else None


def lines_of(spark: SparkSession, path: str, block: int | None = None) -> DataFrame:
    """The lines of files with their block: path, start, line, value; in a task, a block's lines follow each other in the order of ``line``.

    Blocks of ``block`` bytes, which the session's reading has made, are put together to tasks of about TASK_BYTES.
    """
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("line"), "value")
    if not block or block >= TASK_BYTES:
        return lines
    blocks = lines.rdd.getNumPartitions()
    return lines.coalesce(max(1, blocks * block // TASK_BYTES, min(blocks, 4 * spark.sparkContext.defaultParallelism)))


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """The rows of batches one by one, so that one text at a time is a Python string."""
    for batch in batches:
        for k in range(batch.num_rows):
            yield tuple(c[k].as_py() for c in batch.columns)


def _blocks(batches: Iterator[pa.RecordBatch], columns: int) -> Iterator[tuple]:
    """The first ``columns`` columns and the text of each block of lines that follow each other."""
    key, lines = None, []
    for batch in batches:
        for *now, line in zip(*(c.to_pylist() for c in batch.columns)):
            if now != key:
                if key is not None:
                    yield *key, "\n".join(lines)
                key, lines = now, []
            lines.append(line)
    if key is not None:
        yield *key, "\n".join(lines)


def block_states(lines: DataFrame) -> DataFrame:
    """Of each block: path, start, number (from 0 in its file), depth (that comes in), owner (number of the block whose entry comes in), odd (of the file)."""

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for path, start, text in _blocks(batches, 2):
            out, reaches, raised = answers(text)
            yield pa.record_batch([pa.array([path]), pa.array([start], pa.int64()), pa.array([out], pa.list_(pa.int64())), pa.array([reaches], pa.list_(pa.bool_())), pa.array([raised], pa.int64())], ["path", "start", "out", "reaches", "raised"])

    def folded(file: pd.DataFrame) -> pd.DataFrame:
        file = file.sort_values("start", ignore_index=True)
        depth, owner, odd, rows = 0, 0, False, []
        for number, (out, reaches, raised) in enumerate(zip(file["out"], file["reaches"], file["raised"])):
            rows.append((number, depth, owner))
            if depth <= DEPTHS:
                owner = number if reaches[depth] else owner
                depth = int(out[depth])
            else:
                depth = OPEN if pd.isna(raised) else depth + int(raised)
            if depth == OPEN:
                odd = True
                break
        rows += [(k, 0, k) for k in range(len(rows), len(file))]
        states = pd.DataFrame(rows, columns=["number", "depth", "owner"])
        return pd.concat([file[_KEY], states], axis=1).assign(odd=odd)

    each = lines.select(*_KEY, "value").mapInArrow(summed, "path string, start long, out array<long>, reaches array<boolean>, raised long")
    return each.groupBy("path").applyInPandas(folded, "path string, start long, number long, depth long, owner long, odd boolean")


def pieces(lines: DataFrame, states: DataFrame) -> DataFrame:
    """The texts of blocks, each with all of the entries that begin in it: path, owner, text."""

    def parted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for path, number, depth, owner, text in _blocks(batches, 4):
            end = 0 if depth == 0 else ends_of(text, 0, depth)[1]
            parts = [(owner, text if end < 0 else text[:end])] if depth else []
            parts += [(number, text[end:])] if end >= 0 else []
            yield pa.record_batch([pa.array([path] * len(parts)), pa.array([o for o, _ in parts], pa.int64()), pa.array([number] * len(parts), pa.int64()), pa.array([t for _, t in parts])], ["path", "owner", "number", "text"])

    sent = few(states)
    told = lines.join(sent, _KEY).where("not odd")
    # Where the states are too many to be sent, the lines were shuffled and are put in order again.
    told = told.sortWithinPartitions(*_KEY, "line") if sent is states else told
    each = told.select("path", "number", "depth", "owner", "value").mapInArrow(parted, "path string, owner long, number long, text string")
    listed = F.transform(F.array_sort(F.collect_list(F.struct("number", "text"))), lambda x: x["text"])
    return each.groupBy("path", "owner").agg(F.array_join(listed, "\n").alias("text"))


def _strings(own: DataFrame) -> DataFrame:
    """What the earlier pieces of a file define: path, owner, given (text)."""

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for path, owner, text in _texts(batches):
            yield pa.record_batch([pa.array([path]), pa.array([owner], pa.int64()), pa.array([bibtex.definitions(text)])], ["path", "owner", "given"])

    defined = own.where(F.regexp_like("text", F.lit(r"(?i)@\s*string"))).select("path", "owner", "text").mapInArrow(found, "path string, owner long, given string")
    # A row for each piece that defines something, which are few, joined with the pieces behind it in the file.
    before = own.select("path", F.col("owner").alias("behind")).join(few(cut(defined)), "path").where("behind > owner")
    listed = F.transform(F.array_sort(F.collect_list(F.struct("owner", "given"))), lambda x: x["given"])
    return before.groupBy("path", F.col("behind").alias("owner")).agg(F.array_join(listed, "\n").alias("given"))


def entry_batches(batches: Iterator[pa.RecordBatch], encoding: str) -> Iterator[pa.RecordBatch]:
    """The entries of texts (path, owner, text, given), ENTRIES at a time, whatever there is of texts in a batch and of entries in a text."""
    kinds = [pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.map_(pa.string(), pa.string()), pa.string()]
    names = ["path", "owner", "filename", "place", "bibkey", "entrytype", "fields", "error"]
    for path, owner, text, given in _texts(batches):
        found = bibtex.rows(path.rsplit("/", 1)[-1], text, "failfast", encoding, given or "")
        while part := [(path, owner, *r) for r in islice(found, ENTRIES)]:
            yield pa.record_batch([pa.array(x, kind) for x, kind in zip(zip(*part), kinds)], names)


def read(spark: SparkSession, path: str, encoding: str = "utf-8", block: int | None = None) -> DataFrame:
    """Entries as ``bibtex.read`` gives them strictly, of files of any size: filename, entry_pos, bibkey, entrytype, fields, error.

    Blocks are of about ``block`` bytes, by default as the session reads files. A syntax problem raises, as in whole files.
    Files with the same name in several folders are told apart. A block and an entry have to fit into a task's memory.
    """
    name = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(name)
    if block:
        spark.conf.set(name, str(block))
    try:
        lines = lines_of(spark, path, block)
        states = cut(block_states(lines))
        own = cut(pieces(lines, states))
    finally:
        spark.conf.set(name, before)
    odd = [r.path for r in states.where("odd").select("path").distinct().collect()]
    texts = own.join(_strings(own), ["path", "owner"], "left")

    read_ = cut(texts.select("path", "owner", "text", "given").mapInArrow(lambda batches: entry_batches(batches, encoding), "path string, owner long, filename string, place long, bibkey string, entrytype string, fields map<string,string>, error string"))
    earlier = Window.partitionBy("path").orderBy("owner").rowsBetween(Window.unboundedPreceding, -1)
    base = read_.groupBy("path", "owner").agg(F.count("*").alias("n")).withColumn("base", F.coalesce(F.sum("n").over(earlier), F.lit(0))).drop("n")
    out = read_.join(few(cut(base)), ["path", "owner"]).select("filename", (F.col("base") + F.col("place")).alias("entry_pos"), "bibkey", "entrytype", "fields", "error")
    return out.unionByName(bibtex.read(spark, odd, "failfast", encoding)) if odd else out
