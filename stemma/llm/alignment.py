"""Alignment of two tokenizers' tokens by DuckDB within Arrow partitions; the pair counts of the partitions are merged in Spark.

Both tokenizers end a token before every blank that follows something other than white space: the splitting pattern of the
byte vocabulary has no match across such a place, and no piece of the other vocabulary holds one (checked when it is opened).
So a text is the row of its segments between those places, and what holds for a segment holds wherever it stands. A task
takes lots of documents, tokenizes each distinct segment of a lot once, and lays the tokens as byte intervals into tables of
DuckDB: an ASOF join finds the tokens of A that end where one of B ends, window sums over these ends number the groups, a
range join puts the tokens of B into them, and the links are the pairs of ids of a group. A lot's row has its documents as
segment numbers and, for each pair of ids, how many of its documents hold it. Spark sums these over all lots and sends
each lot the sums of its own pairs; from them, every document's sums are added up.
"""

from __future__ import annotations

import hashlib
import itertools
import re
from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stemma.llm.bpe import encoder, piece_bytes
from stemma.llm.storage import cut, private, sliced, text_bytes

#: Bytes of text in a lot; one longer text is a lot by itself. And bytes of distinct segments that DuckDB aligns at once.
LOT, ALIGNED = 4 << 20, 256 << 10
_SPACE = "▁"
_OPEN: dict[str, Pieces] = {}
#: White space before a blank: no segment ends there.
_INNER = re.compile(r"\s ")


class Pieces:
    """The ids and bytes of a vocabulary of pieces with marked blanks."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = self.model.get_piece_size()
        pieces = [self.model.id_to_piece(i) for i in range(n)]
        if any(re.search(f"[^{_SPACE}]{_SPACE}", p) for p in pieces) or self.model.encode("a  b ") != self.model.encode("a") + self.model.encode(" b") + [self.model.piece_to_id(_SPACE)]:
            raise ValueError(f"pieces of {path} go on over blanks")
        self.bytes = [bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace(_SPACE, " ").encode() for i, p in enumerate(pieces)]

    def encode(self, segments: list[str]) -> list[list[int]]:
        """Ids of segments, each of which begins with the blank that the model adds."""
        alone = [self.model.piece_to_id(_SPACE)]
        return [ids or alone for ids in self.model.encode([s[1:] for s in segments], num_threads=1)]


def pieces(path: str) -> Pieces:
    """The worker's vocabulary of pieces, opened once."""
    if path not in _OPEN:
        _OPEN[path] = Pieces(path)
    return _OPEN[path]


def segments(text: str) -> list[str]:
    """A blank and the text, cut before every blank that follows something other than white space."""
    parts = text.split(" ")
    if not _INNER.search(" " + text):
        return [" " + p for p in parts]
    out = [" " + parts[0]]
    for p in parts[1:]:
        if out[-1][-1].isspace():
            out[-1] += " " + p
        else:
            out.append(" " + p)
    return out


#: Tokens are (id, s, e): global byte offsets over the segments of a batch, in order. Segments' ends are ends of both sides.
_GROUPED = """
    CREATE OR REPLACE TEMP TABLE ga AS
    SELECT id, s, e, CAST(coalesce(sum(ends) OVER (ORDER BY e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS g
    FROM (SELECT a.id, a.s, a.e, CAST(b.e IS NOT NULL AND b.e = a.e AS INT) AS ends FROM a ASOF LEFT JOIN b ON a.e >= b.e);
    CREATE OR REPLACE TEMP TABLE groups AS SELECT g, min(s) AS s, max(e) AS e, count(*) AS n_a FROM ga GROUP BY g;
    CREATE OR REPLACE TEMP TABLE gb AS SELECT b.id, b.s, b.e, groups.g FROM b ASOF JOIN groups ON b.s >= groups.s;
    CREATE OR REPLACE TEMP TABLE whole AS
    SELECT groups.g, seg.seg, n_a, n_b FROM groups JOIN (SELECT g, count(*) AS n_b FROM gb GROUP BY g) USING (g) ASOF JOIN seg ON groups.s >= seg.s;
"""
_LINKS = """
    SELECT whole.seg, x.id AS a, y.id AS b, CAST(sum(x.n * y.n) AS BIGINT) AS n
    FROM (SELECT g, id, count(*) AS n FROM ga GROUP BY g, id) x
    JOIN (SELECT g, id, count(*) AS n FROM gb GROUP BY g, id) y USING (g) JOIN whole USING (g) GROUP BY ALL
"""
_SUMS = "SELECT seg, CAST(sum(n_a) AS BIGINT) AS n_a, CAST(sum(n_b) AS BIGINT) AS n_b, count(*) AS n_groups, CAST(sum(n_a * n_b) AS BIGINT) AS n_links FROM whole GROUP BY seg ORDER BY seg"
_HOLD = "SELECT pair, count(*) AS n FROM (SELECT DISTINCT doc, pair FROM words JOIN links USING (seg)) GROUP BY pair ORDER BY pair"


def _table(con, name: str, **columns: np.ndarray) -> None:
    con.register(f"arrow_{name}", pa.table(columns))
    con.execute(f"CREATE OR REPLACE TEMP TABLE {name} AS SELECT * FROM arrow_{name}")
    con.unregister(f"arrow_{name}")


def _ids_of_a(texts: list[str], encode: Callable[[str], bytes]) -> np.ndarray:
    """Ids of all segments in order. They are tokenized in one piece, but for those that end with white space, where a piece ends."""
    out, first = [], 0
    for k, t in enumerate(texts):
        if t[-1].isspace() or k + 1 == len(texts):
            out.append(encode("".join(texts[first : k + 1])))
            first = k + 1
    return np.frombuffer(b"".join(out), "<u4").astype(np.int32)


def _ids_of_b(texts: list[str], b: Pieces) -> np.ndarray:
    return np.fromiter(itertools.chain.from_iterable(b.encode(texts)), np.int32)


def _gives(ids: np.ndarray, table: list[bytes], size: np.ndarray, whole: bytes, ends: np.ndarray) -> bool:
    """Whether the ids' bytes are ``whole``, with a token's end at each of ``ends``."""
    return b"".join([table[i] for i in ids.tolist()]) == whole and bool(np.isin(ends, np.cumsum(size[ids])).all())


class Aligner:
    """Two vocabularies and a connection to DuckDB."""

    def __init__(self, byte_path: str, piece_path: str):
        import duckdb

        self.encode, self.a_bytes, self.b = encoder(byte_path, special=False), piece_bytes(byte_path), pieces(piece_path)
        self.size_a, self.size_b = (np.array([len(x) for x in table], np.int64) for table in (self.a_bytes, self.b.bytes))
        self.con = duckdb.connect(config={"threads": 1})

    def _sides(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, bool]:
        whole, ends = "".join(texts).encode(), np.cumsum([len(t.encode()) for t in texts])
        a, b = _ids_of_a(texts, self.encode), _ids_of_b(texts, self.b)
        return a, b, _gives(a, self.a_bytes, self.size_a, whole, ends) and _gives(b, self.b.bytes, self.size_b, whole, ends)

    def aligned(self, texts: list[str]) -> tuple[np.ndarray, list[str], dict[str, np.ndarray]]:
        """Align both tokenizations of segments.

        Gives (n_a, n_b, n_groups, n_links) by segment, all -1 where one side's bytes aren't the segment's; the written
        groups; and the links (seg, a, b, n), n being how many occurrences of the pair the segment has.
        """
        sums, written, kept = np.full((len(texts), 4), -1, np.int64), [""] * len(texts), list(range(len(texts)))
        a, b, sound = self._sides(texts)
        if not sound:
            kept = [k for k in kept if self._sides(texts[k : k + 1])[2]]
            if not kept:
                return sums, written, {x: np.zeros(0, np.int64) for x in ("seg", "a", "b", "n")}
            a, b, _ = self._sides([texts[k] for k in kept])
        con, length = self.con, np.array([len(texts[k].encode()) for k in kept])
        for name, ids, size in (("a", a, self.size_a), ("b", b, self.size_b)):
            e = np.cumsum(size[ids])
            _table(con, name, id=ids, s=e - size[ids], e=e)
        _table(con, "seg", seg=np.array(kept), s=np.cumsum(length) - length)
        con.execute(_GROUPED)
        found = con.execute(_SUMS).fetchnumpy()
        sums[kept] = np.column_stack([found[x] for x in ("n_a", "n_b", "n_groups", "n_links")])
        ga, gb = (con.execute(f"SELECT g FROM {x} ORDER BY e").fetchnumpy()["g"] for x in ("ga", "gb"))
        seg = con.execute("SELECT seg FROM whole ORDER BY g").fetchnumpy()["seg"]
        parts = _written(a, ga, b, gb, seg)
        first = np.cumsum(sums[kept, 0] + sums[kept, 1])
        for k, i, j in zip(kept, [0, *first[:-1].tolist()], first.tolist()):
            written[k] = "".join(parts[i:j])
        return sums, written, con.execute(_LINKS).fetchnumpy()

    def holders(self, docs: int, words: list[np.ndarray], seg: np.ndarray, pair: np.ndarray, pairs: int) -> np.ndarray:
        """How many of a lot's documents, given by the numbers of their segments, hold each pair."""
        _table(self.con, "words", doc=np.repeat(np.arange(docs), [len(x) for x in words]), seg=np.concatenate([np.zeros(0, np.int64), *words]))
        _table(self.con, "links", seg=seg, pair=pair)
        got, out = self.con.execute(_HOLD).fetchnumpy(), np.zeros(pairs, np.int64)
        out[got["pair"]] = got["n"]
        return out

    def close(self) -> None:
        """Give the connection's memory back."""
        self.con.close()


def _written(a: np.ndarray, ga: np.ndarray, b: np.ndarray, gb: np.ndarray, seg: np.ndarray) -> list[str]:
    """The ids of both sides in the order of groups, A's first, each with what parts it from the next: nothing at a segment's end."""
    groups = len(seg)
    n_a, n_b = np.bincount(ga, minlength=groups), np.bincount(gb, minlength=groups)
    at_a = np.arange(len(a)) + (np.cumsum(n_b) - n_b)[ga]
    at_b = np.arange(len(b)) + np.cumsum(n_a)[gb]
    ids, mark = np.empty(len(a) + len(b), np.int64), np.zeros(len(a) + len(b), np.int64)
    ids[at_a], ids[at_b] = a, b
    ends = np.cumsum(n_a + n_b) - 1
    mark[ends - n_b] = 1
    mark[ends] = np.append(np.where(seg[1:] == seg[:-1], 2, 3), 3)
    marks = [",", "|", ";", ""]
    return [f"{i}{marks[m]}" for i, m in zip(ids.tolist(), mark.tolist())]


class Lot:
    """The documents of a lot, as rows of segment numbers, and the alignment of its segments."""

    def __init__(self, texts: list[str], aligner: Aligner, batch: int = ALIGNED):
        number: dict[str, int] = defaultdict(itertools.count().__next__)
        self.rows = [np.array([number[s] for s in segments(t)] if t else [], np.int64) for t in texts]
        every, at = list(number), 0
        sums, self.written, links = [], [], []
        while at < len(every):
            size, to = 0, at
            while to < len(every) and (to == at or size + len(every[to]) <= batch):
                size, to = size + len(every[to]), to + 1
            s, w, found = aligner.aligned(every[at:to])
            sums.append(s)
            self.written += w
            links.append([found["seg"] + at, found["a"], found["b"], found["n"]])
            at = to
        self.sums = np.concatenate(sums) if sums else np.zeros((0, 4), np.int64)
        self.seg, a, b, self.n = (np.concatenate(x).astype(np.int64) for x in zip(*links)) if links else (np.zeros(0, np.int64) for _ in range(4))
        pairs, pair = np.unique(a << 32 | b, return_inverse=True)
        self.a, self.b, self.pair = (pairs >> 32).astype(np.int32), (pairs & 0xFFFFFFFF).astype(np.int32), pair.reshape(-1)
        lost = self.sums[:, 0] < 0
        self.rows = [r if len(r) and not lost[r].any() else r[:0] for r in self.rows]
        held = [np.unique(r, return_counts=True) for r in self.rows]
        self.words, self.times = [x for x, _ in held], [n for _, n in held]
        self.documents = aligner.holders(len(texts), self.words, self.seg, self.pair, len(pairs))


def _digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest() if text else ""


def _packed(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
        writer.write_table(table)
    return sink.getvalue().to_pybytes()


def _unpacked(data: bytes) -> pa.Table:
    return pa.ipc.open_stream(data).read_all()


_SUM_NAMES = ["n_a", "n_b", "n_groups", "n_links"]


def _lots(docs: DataFrame, columns: list[str], byte_path: str, piece_path: str, digested: bool, size: int, batch: int) -> DataFrame:
    """A row for each lot: lot, its documents and links (Arrow tables, compressed), and of each pair a, b and in how many documents (n)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        at = TaskContext.get().partitionId() << 32
        for k, part in enumerate(sliced(batches, size)):
            aligner = Aligner(byte_path, piece_path)
            lot = Lot([t.decode() for t in part.columns[-1].to_pylist()], aligner, batch)
            aligner.close()
            write = _digest if digested else str
            own = pa.Table.from_batches([part]).drop_columns([part.schema.names[-1]])
            sums = np.array([lot.sums[r].sum(axis=0) for r in lot.rows]).reshape(-1, 4)
            for name, value in zip(_SUM_NAMES, sums.T):
                own = own.append_column(private_name(name), pa.array(value))
            own = own.append_column(private_name("groups"), pa.array([write(";".join([lot.written[s] for s in r.tolist()])) for r in lot.rows], pa.string()))
            for name, value in (("words", lot.words), ("times", lot.times)):
                own = own.append_column(private_name(name), pa.array([v.astype(np.int32) for v in value], pa.list_(pa.int32())))
            links = pa.table({"seg": lot.seg.astype(np.int32), "pair": lot.pair.astype(np.int32), "n": lot.n})
            values = ([at + k], [_packed(own)], [_packed(links)], [lot.a], [lot.b], [lot.documents])
            kinds = (pa.int64(), pa.binary(), pa.binary(), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.list_(pa.int64()))
            yield pa.record_batch([pa.array(v, t) for v, t in zip(values, kinds)], ["lot", "documents", "links", "a", "b", "n"])

    read = docs.select(*columns, text_bytes().alias(private(docs, "bytes")))
    return read.mapInArrow(work, "lot long, documents binary, links binary, a array<int>, b array<int>, n array<long>")


def private_name(name: str) -> str:
    """The name of a computed column within a lot's table, where it can't meet one of the documents'."""
    return f"stemma alignment {name}"


def align(docs: DataFrame, columns: list[str] | None = None, byte_path: str | None = None, piece_path: str | None = None, digested: bool = False, size: int = LOT, batch: int = ALIGNED) -> DataFrame:
    """Align the tokens of every text of ``docs``: ``columns`` (doc_id alone by default) and n_a, n_b, n_groups, n_links, n_best, count_sum, groups.

    A is the byte-level vocabulary at ``byte_path``, applied to a blank and the text, B the pieces at ``piece_path``, which
    add the blank. A group is what lies between two byte offsets at which a token of A and one of B end, a link a pair of
    token occurrences of one group; groups are written ``a1,a2|b1;a3|b2,b3``, or as their SHA-256 if ``digested``. The count
    of a pair of ids is how many documents hold it linked; ``n_best`` is the number of links whose pair has the largest
    count of its A id, and ``count_sum`` the sum of the counts over links.

    Null and empty texts, and those that a side's tokens don't give back byte for byte, have no tokens: zeros and ''.
    Repeated rows count each as a document. Of ``docs``, only ``columns`` and text are read; a column of theirs whose name is
    that of a computed one is refused. Without documents the table is empty.
    """
    columns = columns or ["doc_id"]
    computed = [*_SUM_NAMES, "n_best", "count_sum", "groups"]
    if clash := {c.lower() for c in columns} & set(computed):
        raise ValueError(f"columns named as computed ones: {sorted(clash)}")
    lots = cut(_lots(docs, columns, byte_path or public_tokenizers.path("byte_bpe_50k.json"), piece_path or public_tokenizers.path("piece_bpe_32k.model"), digested, size, batch))
    each = lots.select("lot", F.posexplode(F.arrays_zip("a", "b", "n")).alias("place", "pair")).select("lot", "place", "pair.*")
    counts = each.groupBy("a", "b").agg(F.sum("n").alias("count"))
    most = counts.groupBy("a").agg(F.max("count").alias("most"))  # a row for each id of A, at most
    told = counts.join(F.broadcast(most), "a").select("a", "b", "count", (F.col("count") == F.col("most")).alias("best"))
    back = each.select(F.col("lot").alias("of"), "place", "a", "b").join(told, ["a", "b"]).select("of", "place", "count", "best")
    schema = docs.select(*columns).schema
    for name, kind in zip(computed, [*["long"] * 6, "string"]):
        schema = schema.add(name, kind)

    def finish(left: pa.Table, right: pa.Table) -> pa.Table:
        own, links = (_unpacked(left.column(x)[0].as_py()) for x in ("documents", "links"))
        place = right.column("place").to_numpy()
        count, best = np.zeros(len(place), np.int64), np.zeros(len(place), np.int64)
        count[place], best[place] = right.column("count").to_numpy(), right.column("best").to_numpy(zero_copy_only=False)
        seg, pair, n = (links.column(x).to_numpy() for x in ("seg", "pair", "n"))
        size = int(seg.max()) + 1 if len(seg) else 0
        totals = [np.zeros(size, np.int64) for _ in range(2)]
        for total, value in zip(totals, (best, count)):
            np.add.at(total, seg, n * value[pair])
        words, times = (own.column(private_name(x)).combine_chunks() for x in ("words", "times"))
        doc = np.repeat(np.arange(own.num_rows), np.diff(words.offsets.to_numpy()))
        word, time = words.flatten().to_numpy(), times.flatten().to_numpy()
        out = own.select(columns)
        for name in _SUM_NAMES:
            out = out.append_column(name, own.column(private_name(name)))
        for name, total in zip(("n_best", "count_sum"), totals):
            sums = np.zeros(own.num_rows, np.int64)
            np.add.at(sums, doc, total[word] * time)
            out = out.append_column(name, pa.array(sums))
        return out.append_column("groups", own.column(private_name("groups")))

    return lots.select("lot", "documents", "links").groupBy("lot").cogroup(back.groupBy("of")).applyInArrow(finish, schema)
