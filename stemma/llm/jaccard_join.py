"""Exact Jaccard self-join of documents by a token-group matrix, and the components of its links.

A document is the set of its distinct SHINGLE-word shingles. Equal sets are one class at once, and classes go on.

Order. Tokens (shingles) are ordered by how frequent they are in a fixed-size table of counts over all documents, rarest
first, ties by name. For a similarity of T, two sets that link share k tokens in their prefixes, the first
n - ceil(T * n) + k tokens of each in that one order; k grows with n (``shared_least``). So only prefix tokens are
shuffled, very common ones stay out, and a passage that two documents share is not enough to compare them.

Groups. Classes that share prefix tokens are put into a group by the most shared token of their prefixes, as similar
documents have that token in common; large groups are split. Classes that share too few link with nothing and drop out.
Each group is opened once: its members' overlaps are counted over an inverted index, exactly. A few pivots of a split
group are asked of all its parts, so that a large cluster of copies is one component from here on.

Matrix. (token, group) says which groups have a prefix token, members of one component being groups of their own. A
class becomes a query of each other group that has enough of its prefix tokens and that it isn't one component with
already, as links within a component add nothing: so the parts of a cluster are not compared with one another. With a
group's members, their token union is kept, and the query's overlap with the union bounds its overlap with every member:
only groups that reach ceil(T * n) are opened. One link of a query to each component suffices.

Components. Links are contracted by large-star and small-star steps (Kiveris et al. 2014) until nothing changes.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stemma.llm import textkit
from stemma.llm.storage import cut, in_batches, keyed, private, sliced, small, summed_vectors, text_bytes, without

SHINGLE = 3
#: Links have 100 * intersection >= PERCENT * union.
PERCENT = 90
#: The same for near copies, where no contract says otherwise.
COPY_SHINGLE, COPY_PERCENT = 5, 80
#: Cells of the table of counts, in blocks.
CELLS, _BLOCK = 1 << 20, 1 << 16
#: Tokens and members that a group has about, at most.
GROUP_TOKENS, GROUP_MEMBERS = 1_000_000, 256
#: Pivots of a split group, about.
PIVOTS = 8
#: Members of one component that a group has, for them to be a group of their own.
CLUSTERED = 16
_MEMBER, _QUERY = 0, 1


def sets(texts: list[bytes], shingle: int = SHINGLE) -> list[np.ndarray]:
    """The sorted distinct names of each text's shingles; of a text with fewer words, of its whole sequence."""
    t = textkit.tokenise(texts, textkit.SPACE)
    name, doc = textkit.grams(t, tuple(range(1, shingle)))
    words = t.counts()
    edges = np.concatenate([[0], np.cumsum(np.bincount(doc, minlength=len(texts)))])
    first = np.cumsum(words) - words
    out = []
    for k in range(len(texts)):
        if 0 < words[k] < shingle:
            # A whole sequence never equals a shingle, as the number of its words goes into its name.
            short = t.name[first[k] : first[k] + words[k]]
            out.append(textkit.mix(np.array([sum(int(x) * (2 * i + 3) for i, x in enumerate(short)) + len(short) & (1 << 64) - 1], np.uint64)))
        else:
            out.append(textkit.distinct(name[edges[k] : edges[k + 1]]))
    return out


def _cell(names: np.ndarray) -> np.ndarray:
    return (names >> np.uint64(64 - CELLS.bit_length() + 1)).astype(np.int64)


def _frequencies(source: DataFrame, shingle: int) -> np.ndarray:
    """How many documents have tokens in each cell."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(CELLS, np.int64)
        for part in sliced(batches):
            own = sets(part.columns[-1].to_pylist(), shingle)
            sums += np.bincount(_cell(np.concatenate(own)), minlength=CELLS)
        for k in range(0, CELLS, _BLOCK):
            block = sums[k : k + _BLOCK]
            if block.any():
                yield pa.record_batch([pa.array([k], pa.int32()), pa.array([TaskContext.get().partitionId() % 32], pa.int32()), pa.array([zlib.compress(block.tobytes(), 1)], pa.binary())], ["key", "salt", "data"])

    out = np.zeros(CELLS, np.int64)
    for k, block in summed_vectors(source.mapInArrow(count, "key int, salt int, data binary"), _BLOCK).items():
        out[k : k + _BLOCK] = block
    return np.minimum(out, 2**31 - 1).astype(np.int32)


def least(n: int, percent: int = PERCENT) -> int:
    """The least overlap of a set of n with any set that it links with."""
    return -(-percent * n // 100)


def shared_least(n: int, percent: int = PERCENT) -> int:
    """How many tokens the prefixes of a set of n and of a set no smaller that it links with share."""
    return min(1 + n // 20, least(n, percent)) if n else 0


def _shared_least(n: Column, percent: int) -> Column:
    """``shared_least`` of the smallest set that a set of n may link with."""
    m = F.floor((n * percent + 99) / 100)
    return F.least(1 + F.floor(m / 20), F.floor((m * percent + 99) / 100))


def join(docs: DataFrame, percent: int = PERCENT, shingle: int = SHINGLE) -> DataFrame:
    """For every row of ``docs``: doc_id, text_key, n_shingles, class_size (rows with the same set), component and component_id.

    component numbers the groups, null for rows without words. component_id is the smallest doc_id reachable by links, the row's own included; rows with equal sets link. Rows
    without words have n_shingles 0 and link with nothing, not even with each other. Rows with a null doc_id link by
    their text, but a null is never the smallest; a component of nulls alone has a null id. Repeated rows are equal
    sets. text_key is a hash of the text. Other columns aren't read. Only components leave: no pair is ever listed.
    """
    spark = docs.sparkSession
    source = docs.select("doc_id", F.xxhash64("text").alias("text_key"), text_bytes().alias("t"))
    cells = spark.sparkContext.broadcast(_frequencies(source.select("t"), shingle))
    kind = docs.schema["doc_id"].dataType.simpleString()

    def describe(part: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        own = sets(part.columns[-1].to_pylist(), shingle)
        prefixes, high, low = [], [], []
        for s in own:
            n = len(s)
            order = np.lexsort((s, cells.value[_cell(s)]))
            prefixes.append(s[order[: n - least(n, percent) + shared_least(n, percent)]].view(np.int64))
            high.append(int(textkit.mix(s).sum(dtype=np.uint64).view(np.int64)))
            low.append(int(np.bitwise_xor.reduce(textkit.mix(s * np.uint64(0xD6E8FEB86659FD93))).view(np.int64)) if n else 0)
        columns = [*part.columns[:2], pa.array([len(s) for s in own], pa.int64()), pa.array(high, pa.int64()), pa.array(low, pa.int64()), pa.array(prefixes, pa.list_(pa.int64()))]
        yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "text_key", "n", "high", "low", "prefix"])

    described = in_batches(source, describe, f"doc_id {kind}, text_key long, n long, high long, low long, prefix array<long>")
    described = cut(described)
    key = ["n", "high", "low"]
    # Id and text key are those of one row, as the class's text is looked up by both; a null id comes last.
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key"))
    classes = described.where("n > 0").groupBy(*key).agg(first.alias("first"), F.count("*").alias("class_size"), F.first("prefix").alias("prefix"))
    classes = cut(classes.select(*key, F.col("first.doc_id").alias("least_id"), F.col("first.text_key").alias("text_key"), "class_size", "prefix", F.xxhash64(*key).alias("class")))
    links = _links(source, classes, percent, shingle)
    components = connected(links)
    n_classes = classes.count()
    labels = classes.select("class", "least_id").join(components, classes["class"] == components["node"], "left").select("class", "least_id", F.coalesce("component", "class").alias("component"))
    labels = cut(labels)
    smallest = labels.groupBy("component").agg(F.min("least_id").alias("component_id"), F.count("*").alias("members"))
    named = keyed(labels, smallest, ["component"], "members", n_classes).select("class", "component", "component_id")
    found = classes.select(*key, "class", "class_size").join(named, "class").drop("class")
    out = keyed(described.drop("prefix"), found, key, "class_size", described.count(), "left")
    return out.select("doc_id", "text_key", F.col("n").alias("n_shingles"), F.coalesce("class_size", F.lit(1)).alias("class_size"), "component", F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))


def _links(source: DataFrame, classes: DataFrame, percent: int, shingle: int) -> DataFrame:
    """Links (a long, b long) between classes, as many as connect all classes that links connect."""
    n_tokens = classes.agg(F.coalesce(F.sum(F.size("prefix")), F.lit(0))).first()[0]
    rows = classes.select("class", "n", F.explode("prefix").alias("token"))
    shared = rows.groupBy("token").agg(F.count("*").alias("holders")).where("holders > 1")
    rows = cut(keyed(rows, shared, ["token"], "holders", n_tokens))
    enough = F.col("k") >= _shared_least(F.col("n"), percent)
    grouped = rows.groupBy("class", "n").agg(F.max(F.struct("holders", "token")).alias("g"), F.count("*").alias("k")).where(enough)
    grouped = cut(grouped.select("class", "n", F.col("g.token").alias("g")))
    n_grouped = grouped.count()
    parts = F.greatest(F.ceil(F.sum("n") / GROUP_TOKENS), F.ceil(F.count("*") / GROUP_MEMBERS)).cast("long")
    size = grouped.groupBy("g").agg(parts.alias("parts"), F.count("*").alias("members"))
    part = F.pmod(F.xxhash64("class"), F.col("parts"))
    grouped = keyed(grouped, size, ["g"], "members", n_grouped).select("class", "n", "g", "parts", "members", part.alias("part"), F.xxhash64("g", part).alias("group"))
    grouped = cut(grouped)
    carried = cut(_carried(source, classes.join(grouped.select("class"), "class", "left_semi"), n_grouped, shingle))

    pivots = grouped.where((F.col("parts") > 1) & (F.pmod(F.xxhash64("class", F.lit(7)), F.greatest(F.floor(F.col("members") / PIVOTS), F.lit(1))) == 0))
    pivots = pivots.select("class", "g", "part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("to")).where("part <> to")
    pivots = pivots.select(F.xxhash64("g", "to").alias("group"), F.lit(_QUERY).alias("role"), "class", F.col("class").alias("component"))
    busy = grouped.groupBy("group").count().where("count > 1").select("group").unionByName(pivots.select("group")).distinct()
    members = grouped.join(busy, "group", "left_semi").select("group", F.lit(_MEMBER).alias("role"), "class", F.col("class").alias("component"))
    near = cut(_dealt(cut(members.unionByName(pivots)), carried, percent, True))

    found = connected(near)
    own = grouped.select("class", "n", "group").join(found, grouped["class"] == found["node"], "left").select("class", "n", "group", F.coalesce("component", "class").alias("component"))
    own = cut(own)
    there = own.groupBy("group", "component").agg(F.count("*").alias("here")).where(F.col("here") >= CLUSTERED)
    own = own.join(there, ["group", "component"], "left")
    # A label is a component, or what is left of a group.
    own = own.select("class", "n", "component", F.col("group").alias("first"), F.when(F.col("here").isNotNull(), F.col("component")).otherwise(F.xxhash64("group", F.lit("rest"))).alias("label"))
    own = cut(own.withColumn("group", F.xxhash64("first", "label")))
    far = _matrix(rows, own, n_tokens, percent)
    asked = far.select("group", F.lit(_QUERY).alias("role"), "class", "component")
    members = own.join(far.select("group").distinct(), "group", "left_semi").select("group", F.lit(_MEMBER).alias("role"), "class", "component")
    return near.unionByName(cut(_dealt(cut(members.unionByName(asked)), carried, percent, False)))


def _matrix(rows: DataFrame, own: DataFrame, n_tokens: int, percent: int) -> DataFrame:
    """(class, component, group): the groups of other labels that have enough of a class's prefix tokens.

    A class asks only labels of more members than its own, ties by name; the others' members ask its own.
    """
    held = rows.select("token", "class").join(own, "class")
    mixed = held.groupBy("token").agg(F.min("label").alias("one"), F.max("label").alias("other"), F.count("*").alias("several")).where("one <> other")
    held = cut(keyed(held, mixed.select("token", "several"), ["token"], "several", n_tokens))
    weight = own.groupBy("label").agg(F.count("*").alias("weight"))
    labels = held.select("token", "label").distinct().join(weight, "label")
    a, b = labels.select("token", "label", "weight"), labels.select("token", F.col("label").alias("to"), F.col("weight").alias("to_weight"))
    pairs = a.join(b, "token").where((F.col("to_weight") > F.col("weight")) | ((F.col("to_weight") == F.col("weight")) & (F.col("to") > F.col("label")))).select("token", "label", "to")
    target = held.groupBy("token", F.col("label").alias("to"), F.col("group").alias("there"), F.col("first").alias("there_first")).agg(F.min("n").alias("low"), F.max("n").alias("high"))
    asked = held.select("token", "label", "class", "component", "n", "first").join(pairs, ["token", "label"]).join(target, ["token", "to"])
    fits = (F.col("n") * percent <= F.col("high") * 100) & (F.col("low") * percent <= F.col("n") * 100) & (F.col("first") != F.col("there_first"))
    asked = asked.where(fits).groupBy("class", "component", "n", F.col("there").alias("group")).agg(F.count("*").alias("k"))
    return cut(asked.where(F.col("k") >= _shared_least(F.col("n"), percent)).select("class", "component", "group"))


def _carried(source: DataFrame, classes: DataFrame, rows: int, shingle: int) -> DataFrame:
    """(class, tokens): the whole token set of each of the ``rows`` classes, from the text of one of its rows."""
    wanted = classes.select("class", F.col("text_key").alias("__key"), F.col("least_id").alias("__id"))
    texts = source.join(small(wanted, rows, 200_000), source["doc_id"].eqNullSafe(F.col("__id")) & (source["text_key"] == F.col("__key"))).select("class", "t")

    def spread(part: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        own = [s.tobytes() for s in sets(part.columns[-1].to_pylist(), shingle)]
        yield pa.RecordBatch.from_arrays([part.columns[0], pa.array(own, pa.binary())], names=["class", "tokens"])

    # Several rows may have the least id and the text: one is enough, and repeats are passed over where groups are opened.
    return in_batches(texts, spread, "class long, tokens binary")


def _dealt(routes: DataFrame, carried: DataFrame, percent: int, inner: bool) -> DataFrame:
    """The links found by opening the groups of ``routes`` (group, role, class, component).

    A group with many queries is opened several times, each time with all its members and a share of the queries.
    """
    asked = routes.where(F.col("role") == _QUERY).groupBy("group").agg(F.ceil(F.count("*") / GROUP_MEMBERS).alias("parts"), F.count("*").alias("queries"))
    split = asked.where("parts > 1")
    total = routes.count()
    told = keyed(routes, split, ["group"], "queries", total, "left")
    part = F.when(F.col("role") == _QUERY, F.array(F.pmod(F.xxhash64("class", F.lit(3)), F.col("parts")))).otherwise(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1))
    told = told.withColumn("part", F.explode(F.when(F.col("parts").isNull(), F.array(F.lit(0).cast("long"))).otherwise(part)))
    told = told.select(F.when(F.col("parts").isNull(), F.col("group")).otherwise(F.xxhash64("group", "part")).alias("group"), "role", "class", "component")
    dealt = told.join(carried, "class").select("group", "role", "class", "component", "tokens")
    dealt = dealt.repartition("group").sortWithinPartitions("group", "role", "class")
    return dealt.mapInArrow(lambda batches: _opened(batches, percent, inner), "a long, b long").distinct()


def deduplicated(docs: DataFrame, percent: int = COPY_PERCENT, shingle: int = COPY_SHINGLE) -> DataFrame:
    """One row of each component of ``join``, with the columns of ``docs``; copies are found by five words and 0.8.

    The row with the smallest doc_id stays, null being the largest, of equal ones that with the smallest text hash, of
    repeated rows any one. Rows without words link with nothing and all stay.
    """
    found = cut(join(docs, percent, shingle).where("component is not null and class_size > 0").select("doc_id", "text_key", "component"))
    best = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key")).alias("best")
    first = found.groupBy("component").agg(best, F.count("*").alias("members"))
    told = keyed(found, first, ["component"], "members", found.count())
    lost = cut(told.where(~(F.col("doc_id").eqNullSafe(F.col("best.doc_id")) & (F.col("text_key") == F.col("best.text_key")))).select("doc_id", "text_key").distinct())
    again = cut(found.groupBy("doc_id", "text_key").count().where("count > 1").select("doc_id", "text_key"))
    n_again = again.count()
    kept = without(docs, lost, lost.count())
    if not n_again:
        return kept
    name = private(docs, "key")
    a = again.select(F.col("doc_id").alias("__again_id"), F.col("text_key").alias("__again_key"))
    twice = kept.withColumn(name, F.xxhash64("text"))
    once = twice.join(small(a, n_again), twice["doc_id"].eqNullSafe(a["__again_id"]) & (twice[name] == a["__again_key"]), "left_semi")
    return without(kept, again, n_again).unionByName(once.dropDuplicates(["doc_id", name]).drop(name))


class _Group:
    """The members of a group: an inverted index of their tokens, and a union-find forest of their components."""

    def __init__(self, percent: int):
        self.percent, self.names, self.components, self.tokens = percent, [], [], []
        self.closed = False

    def add(self, name: int, component: int, tokens: np.ndarray) -> None:
        if self.names and self.names[-1] == name:
            return
        self.names.append(name)
        self.components.append(component)
        self.tokens.append(tokens)

    def close(self, inner: bool) -> Iterator[tuple[int, int]]:
        """Index the members; if ``inner``, their links among themselves, as a spanning forest."""
        self.closed = True
        self.sizes = np.array([len(t) for t in self.tokens])
        every = np.concatenate(self.tokens)
        order = np.argsort(every, kind="stable")
        self.every, self.member = every[order], np.repeat(np.arange(len(self.names)), self.sizes)[order]
        self.union, self.start = np.unique(self.every, return_index=True)
        self.start = np.append(self.start, len(self.every))
        first: dict[int, int] = {}
        self.up = [first.setdefault(c, k) for k, c in enumerate(self.components)]
        for k, tokens in enumerate(self.tokens if inner else ()):
            for j in self.linked(tokens):
                a, b = self.root(k), self.root(int(j))
                if a != b:
                    self.up[max(a, b)] = min(a, b)
                    yield self.names[k], self.names[int(j)]
        self.tokens = []

    def root(self, k: int) -> int:
        while self.up[k] != k:
            self.up[k] = k = self.up[self.up[k]]
        return k

    def linked(self, tokens: np.ndarray) -> np.ndarray:
        """Members that link with a set; none are tried if its overlap with the union of all is too small."""
        at = np.searchsorted(self.union, tokens)
        at[at == len(self.union)] = 0
        at = at[self.union[at] == tokens]
        if len(at) < least(len(tokens), self.percent):
            return np.zeros(0, np.int64)
        counts = self.start[at + 1] - self.start[at]
        ends = np.cumsum(counts)
        places = np.arange(ends[-1]) - np.repeat(ends - counts, counts) + np.repeat(self.start[at], counts)
        both = np.bincount(self.member[places], minlength=len(self.names))
        return np.flatnonzero(100 * both >= self.percent * (len(tokens) + self.sizes - both))

    def ask(self, name: int, component: int, tokens: np.ndarray) -> Iterator[tuple[int, int]]:
        """One link of the query for each other component of members that it links with."""
        seen = set()
        for j in self.linked(tokens):
            root = self.root(int(j))
            if root not in seen and self.components[int(j)] != component:
                seen.add(root)
                yield name, self.names[int(j)]


def _opened(batches: Iterator[pa.RecordBatch], percent: int, inner: bool) -> Iterator[pa.RecordBatch]:
    """Links from rows (group, role, class, component, tokens) sorted by group, members before queries."""
    at, group, out, last = None, None, [], None
    for batch in batches:
        for key, role, name, component, data in zip(*(c.to_pylist() for c in batch.columns)):
            if key != at:
                if group is not None and not group.closed and group.names:
                    out += group.close(inner)
                at, group, last = key, _Group(percent), None
            tokens = np.frombuffer(data, np.uint64)
            if role == _MEMBER:
                group.add(name, component, tokens)
            elif name != last:
                last = name
                if not group.closed and group.names:
                    out += group.close(inner)
                if group.names:
                    out += group.ask(name, component, tokens)
            if len(out) > 50_000:
                yield _pairs(out)
                out = []
    if group is not None and not group.closed and group.names:
        out += group.close(inner)
    yield _pairs(out)


def _pairs(out: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.record_batch([pa.array([x[k] for x in out], pa.int64()) for k in (0, 1)], ["a", "b"])


def connected(links: DataFrame) -> DataFrame:
    """``node`` and ``component`` (the least node) of every node in ``links`` (a long, b long).

    Every round that isn't the last makes the links point to smaller nodes, so it ends, after about the square of the logarithm of the nodes.
    """
    edges = cut(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    mark = [F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.sum(F.xxhash64("v", "u").cast("decimal(38,0)"))]
    seen = edges.agg(*mark).first()
    while seen[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        small_low = large.groupBy("u").agg(F.min("v").alias("m"))
        kept = large.join(small_low, "u")
        step = kept.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(small_low.select("u", F.col("m").alias("v"))).distinct()
        edges = cut(step)
        before, seen = seen, edges.agg(*mark).first()
        if seen == before:
            break
    nodes = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return nodes.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
