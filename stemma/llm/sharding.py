"""Sharding by balanced label propagation: linked documents move towards their neighbours' shards, within quotas.

Links are groups of nodes (an edge is a group of two). In each round the nodes' shards are counted by group, with the
counts summed before they are shuffled; a node wants the shard that most nodes of its groups are in, and moves if the
quota from its shard to that one allows. Quotas keep shards near their capacity: as many may leave for each other as
come back, and more as far as there is room. At the end single nodes are moved so that row counts differ by one at most.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stemma.llm.storage import cut, keyed, numbered, text_bytes

SHARDS = 8
ROUNDS = 4
#: A group with this share of a shard's capacity is seeded whole; there can be few such groups.
SEEDED = 1 / 64
#: How far a shard may be over its capacity between rounds.
SLACK = 0.05
_BUCKETS = 512


def _lookup(values: list[int], index: Column) -> Column:
    return F.get(F.array(*[F.lit(int(v)).cast("long") for v in values]), index.cast("int"))


def _seeds(sizes: list[tuple[int, int]], shards: int) -> dict[int, int]:
    """Largest group first, each to the shard with the least so far."""
    load, out = [0] * shards, {}
    for group, n in sorted(sizes, key=lambda x: (-x[1], x[0])):
        out[group] = min(range(shards), key=lambda s: (load[s], s))
        load[out[group]] += n
    return out


def _quotas(want: dict[tuple[int, int], int], counts: list[int], capacity: float) -> dict[tuple[int, int], int]:
    """How many may move from each shard to each other one."""
    allowed = {(a, b): min(n, want.get((b, a), 0)) for (a, b), n in want.items()}
    size = list(counts)
    for (a, b), n in sorted(want.items(), key=lambda x: (-x[1], x[0])):
        more = max(0, min(n - allowed[a, b], int(capacity * (1 + SLACK)) - size[b]))
        allowed[a, b] += more
        size[a], size[b] = size[a] - more, size[b] + more
    return allowed


def propagate(nodes: DataFrame, links: DataFrame, shards: int = SHARDS, rounds: int = ROUNDS) -> DataFrame:
    """``nodes`` (node long) with a ``shard`` from 0 and ``linked``; ``links`` is (group long, node long), both materialised.

    A group larger than half a shard's capacity is split by the hash of its nodes, as it can't be in one shard; a
    node may be in several groups. Groups with a large share of a capacity are seeded to the emptiest shards, all other
    nodes start by hash. Ties go to the smaller shard number. The votes of a group are summed before they are shuffled, and
    those of hot groups are sent to all nodes instead of bringing the nodes together.
    """
    total = nodes.count()
    capacity = max(1.0, total / shards)
    sizes = links.groupBy("group").agg(F.count("*").alias("n")).where("n > 1")
    large = sizes.where(F.col("n") > capacity / 2).collect()
    parts = [(r.group, int(-(-r.n // max(1, int(capacity / 2))))) for r in large]
    own = links
    if parts:
        cases = reduce(lambda c, x: c.when(F.col("group") == x[0], F.pmod(F.xxhash64("node"), F.lit(x[1]))), parts[1:], F.when(F.col("group") == parts[0][0], F.pmod(F.xxhash64("node"), F.lit(parts[0][1]))))
        own = links.withColumn("group", F.when(F.col("group").isin([p[0] for p in parts]), F.xxhash64("group", cases)).otherwise(F.col("group")))
    sizes = own.groupBy("group").agg(F.count("*").alias("n")).where("n > 1")
    heavy = [(r.group, r.n) for r in sizes.where(F.col("n") >= max(2.0, capacity * SEEDED)).orderBy(F.desc("n"), "group").limit(int(4 * shards / SEEDED)).collect()]
    seeds = _seeds(heavy, shards)
    ties = links.count()
    linked = keyed(own, sizes, ["group"], "n", ties).select("group", "node")
    first = F.pmod(F.xxhash64("node"), F.lit(shards)).cast("int")
    if seeds:
        spark = nodes.sparkSession
        seeded = F.broadcast(spark.createDataFrame(sorted(seeds.items()), "group long, seed int"))
        own_seed = linked.join(seeded, "group").groupBy("node").agg(F.min("seed").alias("seed"))
        state = nodes.select("node").join(own_seed, "node", "left").select("node", F.coalesce("seed", first).alias("shard"))
    else:
        state = nodes.select("node", first.alias("shard"))
    linked = cut(linked)
    state = cut(state)
    for k in range(rounds):
        placed = linked.join(state, "node")
        votes = placed.groupBy("group", "shard").agg(F.count("*").alias("votes"))
        unsettled = votes.groupBy("group").agg(F.count("*").alias("k"), F.sum("votes").alias("n"), F.collect_list(F.struct("shard", "votes")).alias("votes")).where("k > 1").drop("k")
        heard = keyed(placed, unsettled, ["group"], "n", ties).select("node", "shard", "group", F.inline("votes").alias("to", "votes"))
        heard = heard.groupBy("node", "shard", "to").agg(F.sum("votes").alias("votes"), F.min(F.xxhash64("group", "to")).alias("tie"))
        best = heard.groupBy("node", "shard").agg(F.max(F.struct("votes", "tie", "to")).alias("best")).where("best.to <> shard")
        best = best.select("node", "shard", F.col("best.to").alias("to"), F.pmod(F.xxhash64("node", F.lit(k)), F.lit(_BUCKETS)).alias("bucket"))
        best = cut(best)
        want = {(r.shard, r.to): r["count"] for r in best.groupBy("shard", "to").count().collect()}
        if not want:
            break
        counts = [0] * shards
        for r in state.groupBy("shard").count().collect():
            counts[r.shard] = r["count"]
        allowed = _quotas(want, counts, capacity)
        upto = [0 if not want.get((a, b)) else int(_BUCKETS * allowed[a, b] / want[a, b]) for a in range(shards) for b in range(shards)]
        moves = best.where(F.col("bucket") < _lookup(upto, F.col("shard") * shards + F.col("to"))).select("node", "to")
        state = cut(state.join(moves, "node", "left").select("node", F.coalesce("to", "shard").cast("int").alias("shard")))
    tied = linked.select("node").distinct().withColumn("linked", F.lit(True))
    return state.join(tied, "node", "left").select("node", "shard", F.coalesce("linked", F.lit(False)).alias("linked"))


def levelled(state: DataFrame, shards: int = SHARDS) -> DataFrame:
    """Move as few nodes as it takes for counts that differ by one at most, unlinked ones first, and number each shard from 0.

    ``state`` (node, shard, linked) has each node once, without nulls; shards without nodes get their share, and without
    nodes there are no rows.
    """
    counted = {(r.shard, r.linked): r["count"] for r in state.groupBy("shard", "linked").count().collect()}
    tied = [counted.get((s, True), 0) for s in range(shards)]
    counts = [tied[s] + counted.get((s, False), 0) for s in range(shards)]
    total = sum(counts)
    capacity = [total // shards] * shards
    for s in sorted(range(shards), key=lambda s: (-counts[s], s))[: total % shards]:
        capacity[s] += 1
    ranked = numbered(state, ["shard", "linked"], ["node"], total, "place")
    place = F.col("place") + F.when(F.col("linked"), F.lit(0)).otherwise(_lookup(tied, F.col("shard")))
    over = [max(0, n - c) for n, c in zip(counts, capacity)]
    room = [max(0, c - n) for n, c in zip(counts, capacity)]
    before = lambda x: [sum(x[:s]) for s in range(shards)]
    spare = _lookup(before(over), F.col("shard")) + F.col("place") - _lookup(capacity, F.col("shard"))
    out = ranked.withColumn("place", place).withColumn("spare", F.when(F.col("place") >= _lookup(capacity, F.col("shard")), spare))
    to, slot = F.col("shard"), F.col("place")
    for s, start in enumerate(before(room)):
        here = (F.col("spare") >= start) & (F.col("spare") < start + room[s])
        to = F.when(here, F.lit(s)).otherwise(to)
        slot = F.when(here, F.lit(counts[s]) + F.col("spare") - start).otherwise(slot)
    return out.select("node", to.cast("int").alias("shard"), slot.cast("long").alias("slot"))


def shard_documents(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """For every row of ``docs``: doc_id, size (UTF-8 bytes plus 1), text_crc32, shard and slot.

    Documents with equal texts are linked; null counts as empty. Rows stand for themselves, so repeated rows and null
    ids are placed like others, and counts of rows differ by one at most. Without rows the result is empty. Other
    columns are not read.
    """
    data = text_bytes()
    rows = docs.select("doc_id", (F.octet_length(data) + 1).cast("long").alias("size"), F.crc32(data).alias("text_crc32"), F.xxhash64(data).alias("group"))
    rows = cut(rows.withColumn("node", F.monotonically_increasing_id()))
    links = rows.select(F.xxhash64("group", "text_crc32", "size").alias("group"), "node")
    placed = levelled(cut(propagate(rows.select("node"), links, shards)), shards)
    return rows.select("node", "doc_id", "size", "text_crc32").join(placed, "node").drop("node")
