"""Minimum-cost-flow resharding.

Given the sizes of the old shards and the capacities of the new ones, a
minimum-cost flow (a byte that stays in its shard costs nothing, a moved byte
costs one) says how many bytes go from each old shard to each new one with the
fewest bytes moved.  Each old shard's rows lie in a fixed order, grouped in
hash blocks; its flows cut that order into consecutive ranges, and a row goes
where its middle byte falls.  Only shards that give or receive are rewritten.

The flow graph has one node for each shard.  Running sums of bytes and rows
are taken over blocks first and then inside a block, so no task holds a whole
shard, and a group of equal texts is spread over all blocks.
"""

from __future__ import annotations

from heapq import heappop, heappush

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from gondola.sources.io import remove

from .common import crc32, cut, stored, without

SHARDS = 16
#: Shards of the layout that the query's documents come from.
OLD_SHARDS = 12
#: Hash blocks of an old shard.
BLOCKS = 1024

_ADDED = ["size", "text_crc32", "shard", "slot"]


def row_size(text: Column) -> Column:
    """UTF-8 bytes of a text (null: none) plus one."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long")


def even_capacities(total: int, shards: int) -> list[int]:
    """Capacities that differ by one byte at most and add up to ``total``."""
    return [total * (j + 1) // shards - total * j // shards for j in range(shards)]


def min_cost_flow(supply: dict[int, int], capacity: dict[int, int]) -> dict[tuple[int, int], int]:
    """Bytes from each old to each new shard; moves the fewest bytes.

    Bytes that stay go straight from an old shard to the new one of its number,
    at no cost; all others pass one transit node, at cost one, so the graph has as
    many edges as shards.  Primal-dual: shortest distances from the source give
    node potentials, and every path of reduced cost zero is filled before the next
    distances.  Capacities must cover the supply.
    """
    if sum(supply.values()) > sum(capacity.values()):
        raise ValueError("the new capacities cannot hold the old shards")
    source, sink, transit = range(3)
    old = {i: 3 + k for k, i in enumerate(supply)}
    new = {j: 3 + len(old) + k for k, j in enumerate(capacity)}
    n = 3 + len(old) + len(new)
    to, room, cost, edges = [], [], [], [[] for _ in range(n)]

    def edge(u: int, v: int, most: int, price: int) -> int:
        for a, b, r, c in ((u, v, most, price), (v, u, 0, -price)):
            edges[a].append(len(to))
            to.append(b)
            room.append(r)
            cost.append(c)
        return len(to) - 2

    out = {i: edge(old[i], transit, b, 1) for i, b in supply.items()}
    into = {j: edge(transit, new[j], b, 0) for j, b in capacity.items()}
    home = {i: edge(old[i], new[i], b, 0) for i, b in supply.items() if i in new}
    for i, b in supply.items():
        edge(source, old[i], b, 0)
    for j, b in capacity.items():
        edge(new[j], sink, b, 0)
    potential, left = [0] * n, sum(supply.values())
    while left:
        distance, queue = {source: 0}, [(0, source)]
        while queue:
            d, u = heappop(queue)
            if d > distance[u]:
                continue
            for e in edges[u]:
                step = d + cost[e] + potential[u] - potential[to[e]]
                if room[e] and step < distance.get(to[e], step + 1):
                    distance[to[e]] = step
                    heappush(queue, (step, to[e]))
        far = max(distance.values())
        potential = [p + distance.get(u, far) for u, p in enumerate(potential)]
        at, path, on_path = [0] * n, [], {source}
        u = source
        while True:
            if u == sink:
                amount = min(room[e] for e in path)
                for e in path:
                    room[e] -= amount
                    room[e ^ 1] += amount
                left -= amount
                u, path, on_path = source, [], {source}
                continue
            while at[u] < len(edges[u]):
                e = edges[u][at[u]]
                if room[e] and to[e] not in on_path and cost[e] + potential[u] == potential[to[e]]:
                    break
                at[u] += 1
            else:  # no way on
                if u == source:
                    break
                on_path.discard(u)
                u = to[path.pop() ^ 1]
                at[u] += 1
                continue
            path.append(e)
            u = to[e]
            on_path.add(u)
    sent = lambda e: room[e ^ 1]
    flow = {(i, i): sent(e) for i, e in home.items() if sent(e)}
    takers = [[j, sent(e)] for j, e in into.items() if sent(e)]
    for i, e in out.items():  # what leaves goes to the takers in turn
        rest = sent(e)
        while rest:
            j, wants = takers[-1]
            flow[i, j] = flow.get((i, j), 0) + min(rest, wants)
            rest, takers[-1][1] = rest - min(rest, wants), wants - min(rest, wants)
            if not takers[-1][1]:
                takers.pop()
    return flow


def _ranges(supply: dict[int, int], flow: dict[tuple[int, int], int]) -> list[tuple[int, int, int, int]]:
    """(old, new, first byte, end byte): a shard keeps its head and gives away its tail."""
    out = []
    for i in sorted(supply):
        at = 0
        for j in sorted((j for (o, j) in flow if o == i), key=lambda j: (j != i, j)):
            out.append((i, j, at, at + flow[i, j]))
            at += flow[i, j]
    return out


def reshard(docs: DataFrame, old_shard: Column, shards: int = SHARDS, capacities: list[int] | None = None,
            blocks: int = BLOCKS) -> DataFrame:
    """``docs`` with size, text_crc32, old_shard, shard and slot (gapless from 0).

    ``capacities`` defaults to equal bytes.  ``old_shard`` is an expression
    over ``docs`` giving the shard each row lies in now.  Null and empty texts
    have size 1; rows without doc_id are ordered by their text's checksum;
    repeated rows get slots of their own; an empty table gives an empty one.
    Incoming columns named like the added ones are replaced.
    """
    spark = docs.sparkSession
    rows = docs.select("*", old_shard.cast("int").alias("__old"), row_size(F.col("text")).alias("__size"), crc32(F.col("text")).alias("__crc"))
    rows = rows.withColumn("__block", F.pmod(F.xxhash64("doc_id", "__crc"), F.lit(blocks)).cast("int"))
    totals = cut(rows.groupBy("__old", "__block").agg(F.sum("__size").alias("bytes"), F.count("*").alias("n")))
    # one row for each old shard
    supply = {r["__old"]: r["b"] for r in totals.groupBy("__old").agg(F.sum("bytes").alias("b")).collect()}
    total = sum(supply.values())
    flow = min_cost_flow(supply, dict(enumerate(capacities or even_capacities(total, shards))))
    ranges = spark.createDataFrame(_ranges(supply, flow), "__old int, shard int, low long, high long")
    arrays = ranges.groupBy("__old").agg(F.sort_array(F.collect_list(F.struct("low", "high", "shard"))).alias("__ranges"))
    before = W.partitionBy("__old").orderBy("__block").rowsBetween(W.unboundedPreceding, -1)
    starts = cut(totals.select("__old", "__block", F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("__b0"),
                               F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__r0")).join(arrays, "__old"))

    def placed(df: DataFrame) -> DataFrame:
        inside = W.partitionBy("__old", "__block").orderBy("doc_id", "__crc", "__size")
        at = (df.withColumn("__rank", F.row_number().over(inside) - 1)
              .withColumn("__at", F.coalesce(F.sum("__size").over(inside.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
              .join(starts, ["__old", "__block"]))
        middle = F.col("__b0") + F.col("__at") + F.floor((F.col("__size") - 1) / 2)
        return at.withColumn("__shard", F.element_at(F.filter("__ranges", lambda r: r["low"] <= middle), -1)["shard"]).withColumn(
            "__rank", F.col("__r0") + F.col("__rank"))

    thin = placed(rows.select("doc_id", "__old", "__size", "__crc", "__block"))
    pieces = thin.groupBy("__old", "__shard").agg(F.min("__rank").alias("__first"), F.count("*").alias("n"))
    ahead = W.partitionBy("__shard").orderBy("__old").rowsBetween(W.unboundedPreceding, -1)
    bases = cut(pieces.select("__old", "__shard", (F.coalesce(F.sum("n").over(ahead), F.lit(0)) - F.col("__first")).alias("__base")))
    out = placed(rows).join(bases, ["__old", "__shard"])
    own = without(docs, [*_ADDED, "old_shard"]).columns
    return out.select(*[F.col(f"`{c}`") for c in own], F.col("__size").alias("size"), F.col("__crc").alias("text_crc32"),
                      F.col("__old").alias("old_shard"), F.col("__shard").alias("shard"),
                      (F.col("__base") + F.col("__rank")).cast("long").alias("slot"))


def rewrite_affected(resharded: DataFrame, folder: str) -> list[int]:
    """Write the shards that give or receive rows under ``folder``/shard=N.

    Returns their numbers; every other shard's files stay as they are.  ``folder``
    may hold the layout that ``resharded`` was read from: the affected rows are
    stored first, then each shard's files are replaced, and a shard that gave all
    its rows away loses its folder.  No affected shard, no write.
    """
    moves = resharded.where("old_shard != shard").select("old_shard", "shard").distinct().collect()  # pairs of shards
    affected = sorted({s for r in moves for s in r})
    if affected:
        rows = stored(resharded.where(F.col("shard").isin(affected)))
        (rows.repartition("shard", F.floor(F.col("slot") / 1_000_000)).sortWithinPartitions("shard", "slot")
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("shard").parquet(folder))
        for shard in set(affected) - {r["shard"] for r in rows.select("shard").distinct().collect()}:
            remove(resharded.sparkSession, f"{folder}/shard={shard}")
    return affected


# ---------------------------------------------------------------- query

def by_id(doc_id: Column) -> Column:
    """The old layout: twelve shards by a checksum of doc_id."""
    return F.pmod(crc32(doc_id.cast("string")), F.lit(OLD_SHARDS))


def contract(docs: DataFrame) -> DataFrame:
    """``docs`` resharded from the old layout to 16 shards of equal bytes."""
    own = without(docs, ["law", "grown_shard"])
    return reshard(own, by_id(F.col("doc_id"))).withColumns({"law": F.lit("bytes"), "grown_shard": F.lit(None).cast("int")})


def query(spark, sf_dir: str) -> DataFrame:
    """Contract form: one row per document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return contract(docs).select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard", "old_shard")
