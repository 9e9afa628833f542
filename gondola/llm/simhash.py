"""SimHash near-duplicates over a Gray-order hierarchical index.

Fingerprints are sorted by their rank in the reflected Gray code, which keeps
codes that differ in few bits close together.  Consecutive codes share many
bit positions; a node of the index holds the mask and pattern of the bits that
all codes below it share, less those its ancestors hold.  A search carries the
differences found so far down the tree and drops a whole group once they
exceed the allowed distance, so only a polylogarithmic part of the codes is
compared and no link is lost.

Distributed form: the distinct fingerprints are cut into ranges of Gray rank,
whose nodes (a bounded number, ``MAX_BLOCKS``) are the index's top.  A table
of more than ``MAX_BLOCKS`` blocks has a second level: each range is cut into
blocks of its own, whose nodes stay a table.  Each fingerprint is routed through
the top to the ranges, and by an equi-join with their nodes to the blocks, that
may hold a partner; each block task builds its own subtree and answers the
fingerprints sent to it.  A block's size does not grow with the table.  A task
returns a spanning forest of the links it found, never all pairs of a group.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import cut, map_batches, set_aside, ship, stored, text_bytes, without
from .components import connected_components, local_forest

SHINGLE = 3
MAX_DISTANCE = 2
#: Distinct fingerprints a block aims at, and the most nodes of the index's top
#: (what routing broadcasts); more blocks are reached through a second level.
BLOCK = 32_768
MAX_BLOCKS = 4096
#: Codes of a block that one task holds beside the queries sent to it; larger
#: blocks deal their queries over several tasks.
TASK_CODES = 65_536
_FANOUT = 16
#: Queries that walk the tree together.
_STEP = 2048
#: Links a task gathers before it reduces them to a forest.
_LINKS = 1 << 20


# ---------------------------------------------------------------- fingerprint

def fingerprint(text: bytes, k: int = SHINGLE) -> int:
    """64-bit SimHash of a text's word shingles (repeats counted)."""
    words = text.lower().split()  # bytes: lowers A-Z, splits at \x20 and \x09-\x0D
    if not words:
        return 0
    h64 = xxhash.xxh64_intdigest
    if len(words) < k:
        return h64(b" ".join(words), 42)
    join = b" ".join
    h = np.fromiter((h64(join(s), 42) for s in zip(*(words[i:] for i in range(k)))), np.uint64, len(words) - k + 1)
    ones = np.zeros(64, np.int64)
    for i in range(0, len(h), 1 << 16):
        bits = np.unpackbits(h[i:i + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(h), bitorder="little").view(np.uint64)[0])


def with_fingerprint(docs: DataFrame, k: int = SHINGLE, keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns of ``docs`` and ``fp``, the fingerprint as a signed long."""
    ship(docs.sparkSession)
    keep = list(docs.columns if keep is None else keep)
    given = without(docs.select([F.col(f"`{c}`") for c in keep]), ["fp"])
    width = len(given.columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, off = text_bytes(batch.column(width))
            body = memoryview(data) if len(data) else memoryview(b"")
            fps = np.array([fingerprint(bytes(body[a:b]), k) for a, b in zip(off[:-1].tolist(), off[1:].tolist())], np.uint64)
            yield pa.RecordBatch.from_arrays(batch.columns[:width] + [pa.array(fps.view(np.int64))],
                                             names=batch.schema.names[:width] + ["fp"])

    schema = T.StructType(given.schema.fields + [T.StructField("fp", T.LongType())])
    texts = docs.select(*[F.col(f"`{c}`") for c in given.columns], F.col("text").alias("__text"))
    return map_batches(texts, run, schema)


# ---------------------------------------------------------------- Gray-order index

def gray_rank(x: np.ndarray) -> np.ndarray:
    """Position of each code in the reflected Gray order."""
    x = x.copy()
    for s in (1, 2, 4, 8, 16, 32):
        x ^= x >> np.uint64(s)
    return x


class GrayIndex:
    """Tree over codes sorted by Gray rank; every node keeps the bits its codes share."""

    def __init__(self, codes: np.ndarray):
        self.codes = codes[np.argsort(gray_rank(codes))]
        sizes = [_FANOUT]
        while sizes[-1] < len(codes):
            sizes.append(sizes[-1] * _FANOUT)
        self.levels = []  # from the root: (group size, masks of bits new at this node, patterns)
        above, above_size = None, 0
        for size in reversed(sizes):
            at = np.arange(0, len(codes), size)
            ones, anyone = np.bitwise_and.reduceat(self.codes, at), np.bitwise_or.reduceat(self.codes, at)
            shared = ~(ones ^ anyone)
            fresh = shared if above is None else shared & ~above[at // above_size]
            self.levels.append((size, fresh, ones))
            above, above_size = shared, size
        self.leaf_free = ~above  # bits left to compare below the lowest nodes

    def search(self, queries: np.ndarray, distance: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(query index, code index) of every pair within ``distance`` bits."""
        n = len(self.codes)
        for lo in range(0, len(queries), _STEP):
            q = queries[lo:lo + _STEP]
            who, node, acc = np.arange(len(q)), np.zeros(len(q), np.int64), np.zeros(len(q), np.uint8)
            for depth, (size, mask, pattern) in enumerate(self.levels):
                if depth:
                    who, node, acc = np.repeat(who, _FANOUT), (node[:, None] * _FANOUT + np.arange(_FANOUT)).ravel(), np.repeat(acc, _FANOUT)
                    ok = node < len(mask)
                    who, node, acc = who[ok], node[ok], acc[ok]
                acc = acc + np.bitwise_count((q[who] ^ pattern[node]) & mask[node])
                ok = acc <= distance
                who, node, acc = who[ok], node[ok], acc[ok]
            step = 1 << 16  # groups opened at once
            for s in range(0, len(who), step):
                w, g, a = who[s:s + step], node[s:s + step], acc[s:s + step]
                at = (g[:, None] * _FANOUT + np.arange(_FANOUT)).ravel()
                w, a, free = np.repeat(w, _FANOUT), np.repeat(a, _FANOUT), np.repeat(self.leaf_free[g], _FANOUT)
                ok = at < n
                w, at, a, free = w[ok], at[ok], a[ok], free[ok]
                hit = a + np.bitwise_count((q[w] ^ self.codes[at]) & free) <= distance
                if hit.any():
                    yield w[hit] + lo, at[hit]


def _place(bounds: np.ndarray):
    """Each fingerprint's block: the range of Gray ranks it falls in."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            block = np.searchsorted(bounds, batch.column(1).to_numpy(), side="right")
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(block.astype(np.int64))], names=["fp", "block"])
    return run


def _route(nodes: list[tuple[int, int, int]], distance: int, first: int):
    """Sends each fingerprint to every range, from ``first`` after its own on, whose
    shared bits allow a partner."""
    block = np.array([n[0] for n in nodes], np.int64)
    mask = np.array([n[1] % 2**64 for n in nodes], np.uint64)
    pattern = np.array([n[2] % 2**64 for n in nodes], np.uint64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp_all, top_all, own_all = batch.column(0).to_numpy().view(np.uint64), batch.column(1).to_numpy(), batch.column(2).to_numpy()
            for s in range(0, len(fp_all), 1024):
                fp, top, own = fp_all[s:s + 1024], top_all[s:s + 1024], own_all[s:s + 1024]
                near = np.bitwise_count((fp[:, None] ^ pattern[None, :]) & mask[None, :]) <= distance
                near &= block[None, :] >= top[:, None] + first  # a pair is found from its lower block
                i, j = np.nonzero(near)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(block[j]), pa.array(fp[i].view(np.int64)), pa.array(own[i])], names=["top", "fp", "own"])
    return run


def _block_links(distance: int):
    def run(table: pa.Table) -> pa.Table:
        fp = table.column("fp").to_numpy().view(np.uint64)
        role = table.column("role").to_numpy()
        a = b = np.empty(0, np.int64)
        codes = fp[role != 1]  # 0 own and asking, 2 own but asked for by another task
        if len(codes):
            index = GrayIndex(codes)
            queries = np.concatenate([fp[role == 0], fp[role == 1]])
            more_a, more_b, held = [], [], 0
            for q, c in index.search(queries, distance):
                x, y = queries[q], index.codes[c]
                far = x != y
                more_a.append(x[far].view(np.int64))
                more_b.append(y[far].view(np.int64))
                held += int(far.sum())
                if held >= _LINKS:
                    a, b = local_forest(np.concatenate([a, *more_a]), np.concatenate([b, *more_b]))
                    more_a, more_b, held = [], [], 0
            a, b = local_forest(np.concatenate([a, *more_a]), np.concatenate([b, *more_b]))
        return pa.table({"u": pa.array(a, pa.int64()), "v": pa.array(b, pa.int64())})
    return run


def _signed_rank(fp):
    """Gray rank as a long whose signed order is the rank's order."""
    for s in (1, 2, 4, 8, 16, 32):
        fp = fp.bitwiseXOR(F.shiftrightunsigned(fp, s))
    return fp.bitwiseXOR(F.lit(-2**63).cast("long"))


def _nodes(placed: DataFrame, level: str, a: str = "fp", o: str = "fp") -> DataFrame:
    """The bits that all codes below a node share: ones in both ``a`` and ``o``, zeros in neither."""
    return placed.groupBy(level).agg(F.bit_and(a).alias("a"), F.bit_or(o).alias("o"))


def _two_levels(tops: DataFrame, fine: int, distance: int) -> tuple[DataFrame, DataFrame]:
    """``tops`` (fp, top) cut into some ``fine`` blocks for each top: (fp, top, block), and
    the rows routed to them: (block, fp)."""
    tops = cut(tops)
    rank = _signed_rank(F.col("fp"))
    cuts = tops.groupBy("top").agg(F.percentile_approx(rank, [i / fine for i in range(1, fine)], 20 * fine).alias("cuts"))
    within = F.size(F.filter("cuts", lambda c: c <= F.col("rank"))).cast("long")
    placed = cut(tops.withColumn("rank", rank).join(cuts, "top").select("fp", "top", (F.col("top") * fine + within).alias("block")))
    leaves = cut(_nodes(placed, "block").withColumn("top", F.floor(F.col("block") / F.lit(fine))))  # a row for each block
    # at most ``max_blocks`` rows
    nodes = [(r["top"], ~(r["a"] ^ r["o"]), r["a"]) for r in _nodes(leaves, "top", "a", "o").collect()]
    routed = map_batches(placed, _route(nodes, distance, 0), "top long, fp long, own long")
    differ = F.bit_count(F.col("fp").bitwiseXOR(F.col("a")).bitwiseAND(F.bitwise_not(F.col("a").bitwiseXOR(F.col("o")))))
    routed = routed.join(leaves, "top").where((F.col("block") > F.col("own")) & (differ <= distance))
    return placed, routed.select("block", "fp")


def block_rows(codes: DataFrame, distance: int = MAX_DISTANCE, block: int = BLOCK,
               max_blocks: int = MAX_BLOCKS, task_codes: int = TASK_CODES) -> DataFrame:
    """(block, deal, fp, role): the codes of every block and the fingerprints sent to it.

    Role 0 is a block's own code that asks, 2 one that is only asked for, 1 a
    fingerprint of a lower block.
    """
    n = codes.count()
    n_tops = max(1, min(max_blocks, -(-n // block)))
    fine = -(-n // (n_tops * block))
    ranked = codes.select("fp", _signed_rank(F.col("fp")).alias("rank"))
    # the bounds between ranges, at most ``max_blocks``
    bounds = ranked.agg(F.percentile_approx("rank", [i / n_tops for i in range(1, n_tops)], 20 * n_tops)).first()[0] if n_tops > 1 else []
    tops = map_batches(ranked, _place(np.unique(np.array(bounds or [], np.int64))), "fp long, top long")
    if fine > 1:
        placed, routed = _two_levels(tops, fine, distance)
    else:
        placed = cut(tops.select("fp", "top", F.col("top").alias("block")))
        # at most ``max_blocks`` rows
        nodes = [(r["block"], ~(r["a"] ^ r["o"]), r["a"]) for r in _nodes(placed, "block").collect()]
        routed = map_batches(placed, _route(nodes, distance, 1), "top long, fp long, own long").select(F.col("top").alias("block"), "fp")
    deals = max(1, -(-min(n, block) // task_codes))
    deal = F.pmod(F.xxhash64("fp"), F.lit(deals))
    own = placed.select("block", "fp", deal.alias("home"), F.explode(F.sequence(F.lit(0), F.lit(deals - 1))).alias("deal"))
    return (own.select("block", "fp", F.col("deal").cast("long"), F.when(F.col("home") == F.col("deal"), 0).otherwise(2).alias("role"))
            .unionByName(routed.select("block", "fp", deal.cast("long").alias("deal"), F.lit(1).alias("role"))))


def fingerprint_links(codes: DataFrame, distance: int = MAX_DISTANCE, block: int = BLOCK,
                      max_blocks: int = MAX_BLOCKS, task_codes: int = TASK_CODES) -> DataFrame:
    """Links (u, v) that connect distinct fingerprints as all pairs within ``distance`` do.

    ``codes`` holds each fingerprint once in ``fp``.  The links are spanning
    forests per block, not every pair.
    """
    ship(codes.sparkSession)
    rows = block_rows(codes, distance, block, max_blocks, task_codes)
    return rows.groupBy("block", "deal").applyInArrow(_block_links(distance), "u long, v long")


def _labelled(marked: DataFrame, distance: int, best: Column) -> DataFrame:
    """(fp, best, label): each fingerprint with the smallest ``best`` of its rows
    and the label of its component."""
    groups = cut(marked.groupBy("fp").agg(F.min(best).alias("best")))
    labels = connected_components(fingerprint_links(groups.select("fp"), distance))
    return groups.join(labels.withColumnRenamed("node", "fp"), "fp", "left").withColumn("label", F.coalesce("label", "fp"))


def near_duplicates(docs: DataFrame, k: int = SHINGLE, distance: int = MAX_DISTANCE) -> DataFrame:
    """(doc_id, fp, component_id) per row of ``docs``; links join fingerprints
    that differ in at most ``distance`` bits.

    ``component_id`` is the smallest doc_id reachable.  A null or empty text
    has fingerprint zero and links like any other; a very long text is
    fingerprinted whole.  Repeated rows come back repeated, and so do equal
    fingerprints, which tie in everything.  Rows without doc_id take part in
    linking but cannot name a component (null only if no row of the component has
    a doc_id).  An empty table gives an empty one; other columns are not carried.
    """
    marked = cut(with_fingerprint(docs, k, ["doc_id"]))
    rooted = _labelled(marked, distance, F.col("doc_id"))
    names = rooted.groupBy("label").agg(F.min("best").alias("component_id"))
    of = rooted.join(names, "label").select("fp", "component_id")
    return marked.join(of, "fp").select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame, k: int = SHINGLE, distance: int = MAX_DISTANCE) -> DataFrame:
    """One row of ``docs`` for each component, with its own columns: the one with
    the smallest doc_id (null last), of several the earliest row.

    Rows are told apart by a key of their own, so a component is never lost where
    one doc_id stands on unlike texts, and copies without doc_id go like others.
    Null and empty texts are copies of each other; an empty table gives an empty one.
    """
    rows, back = set_aside(docs, ["__row"])
    rows = stored(rows.withColumn("__row", F.monotonically_increasing_id()))
    marked = cut(with_fingerprint(rows.select("doc_id", "__row", "text"), k, ["doc_id", "__row"]))
    rooted = _labelled(marked, distance, F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "__row"))
    first = rooted.groupBy("label").agg(F.min("best").alias("best")).select(F.col("best.__row").alias("__row"))
    copies = marked.select("__row").join(first, "__row", "left_anti")
    return back(rows.join(copies, "__row", "left_anti"))


# ---------------------------------------------------------------- query

def query(spark, sf_dir: str) -> DataFrame:
    """Contract form: one row per document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return near_duplicates(docs).select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
