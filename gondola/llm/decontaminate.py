"""Benchmark decontamination by a prefix-filtered set join.

Every benchmark item is cut into windows of 13 consecutive words (an item of
fewer words is one window).  A window is a set of word shingles, and a text
contains the window only if it holds all of them, so for full containment the
necessary prefix is one token: the window's rarest shingle, by counts over the
whole corpus.  Texts meet windows on that token only; a candidate then has to
pass the length and positional bounds (the window, placed by the token's
position in it, must lie inside the text) and is verified word for word.

The index of prefix tokens is built for blocks of at most ``BLOCK_WINDOWS``
windows, so what is sent to the executors has a fixed bound; a larger
benchmark takes more passes.  Texts are never shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import (ALNUM, LOWER, cut, lower_ascii, map_batches, set_aside, shingle_hashes, ship, steps, text_bytes, without,
                     word_hashes, word_spans)

WINDOW = 13
SHINGLE = 5
#: Most windows whose index one pass sends to the executors.
BLOCK_WINDOWS = 100_000
WORD_PATTERN = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_FILTER_BITS = 20
_ADDED = ["n_words", "n_hit", "items", "hit_spans"]


def benchmark_windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Distinct (item, window): the words of each window joined by a space."""
    words = F.regexp_extract_all(lower_ascii(F.col("text")), F.lit(WORD_PATTERN), F.lit(0))
    items = (benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), words.alias("w"))
             .where(F.size("w") > 0)
             .withColumn("at", F.explode(F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("w") - (window - 1))))))
    return items.select("item", F.array_join(F.slice("w", F.col("at"), window), " ").alias("window")).distinct()


class _Tokens:
    """Words of one step of texts: lower-cased bytes, spans, hashes."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.data = LOWER[data]
        inside, self.starts, self.ends, self.first = word_spans(self.data, offsets, ALNUM)
        self.hashes = word_hashes(self.data, self.starts, self.ends)
        self.lens = self.ends - self.starts
        self.body_at = np.zeros(len(self.starts) + 1, np.int64)
        np.cumsum(self.lens, out=self.body_at[1:])
        self.inside = inside

    def shingles(self, k: int) -> np.ndarray:
        """Hash of the k words from each word on, 0 where the text ends before."""
        out = np.zeros(len(self.starts), np.uint64)
        h = shingle_hashes(self.hashes, k)
        out[:len(h)] = h
        left = np.repeat(self.first[1:], np.diff(self.first)) - np.arange(len(self.starts))
        out[left < k] = 0
        return out


class _Filter:
    """Membership of 64-bit values: a small bit table first, then the sorted values."""

    def __init__(self, values: np.ndarray):
        self.values = np.unique(values)
        self.table = np.zeros(1 << _FILTER_BITS, bool)
        self.table[self.values >> np.uint64(64 - _FILTER_BITS)] = True

    def find(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions in ``h`` of members, and each one's index among the values."""
        at = np.flatnonzero(self.table[h >> np.uint64(64 - _FILTER_BITS)])
        k = np.searchsorted(self.values, h[at])
        ok = k < len(self.values)
        ok[ok] = self.values[k[ok]] == h[at][ok]
        return at[ok], k[ok]


class _Window:
    __slots__ = ("items", "lens", "body", "n", "shingles", "k")

    def __init__(self, text: str, shingle: int):
        data = np.frombuffer(text.encode(), np.uint8)
        t = _Tokens(data, np.array([0, len(data)]))
        self.items, self.n = [], len(t.starts)
        self.lens, self.body = t.lens.tobytes(), t.data[t.inside].tobytes()
        self.k = min(shingle, self.n)
        self.shingles = t.shingles(self.k)[:self.n - self.k + 1]


def _block(rows, shingle: int) -> list[_Window]:
    windows: dict[str, _Window] = {}
    for r in rows:
        w = windows.get(r["window"]) or windows.setdefault(r["window"], _Window(r["window"], shingle))
        w.items.append(r["item"])
    return list(windows.values())


def _corpus_counts(texts: DataFrame, windows: list[_Window]) -> dict[tuple[int, int], int]:
    """How often each shingle of the block's windows occurs in the whole corpus."""
    kinds = sorted({w.k for w in windows})
    sets = {k: np.unique(np.concatenate([w.shingles for w in windows if w.k == k])) for k in kinds}
    shared = texts.sparkSession.sparkContext.broadcast(sets)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filters = {k: _Filter(v) for k, v in shared.value.items()}
        totals = {k: np.zeros(len(f.values), np.int64) for k, f in filters.items()}
        for batch in batches:
            data, offsets = text_bytes(batch.column(0))
            for i, j in steps(offsets):
                t = _Tokens(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
                for k, f in filters.items():
                    totals[k] += np.bincount(f.find(t.shingles(k))[1], minlength=len(f.values))
        for k, f in filters.items():
            some = np.flatnonzero(totals[k])
            if len(some):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(some), k), pa.int32()), pa.array(f.values[some].view(np.int64)),
                     pa.array(totals[k][some])], names=["k", "h", "n"])

    counts = (map_batches(texts, count, "k int, h long, n long").groupBy("k", "h").agg(F.sum("n").alias("n")))
    # at most one row per distinct shingle of the block
    return {(r["k"], r["h"] % 2**64): r["n"] for r in counts.collect()}


def _prefix_index(windows: list[_Window], counts: dict) -> dict[int, tuple[np.ndarray, list]]:
    """Rarest shingle of each window -> (window, offset); a window with a
    shingle that no text has cannot occur and is left out."""
    index: dict[int, dict[int, list]] = {}
    for w in windows:
        if len(w.shingles) == 0:
            continue
        n, h, at = min((counts.get((w.k, int(x)), 0), int(x), i) for i, x in enumerate(w.shingles))
        if n:
            index.setdefault(w.k, {}).setdefault(h, []).append((at, w.n, w.lens, w.body, w.items))
    return {k: (np.array(sorted(v), np.uint64), [v[h] for h in sorted(v)]) for k, v in index.items()}


def _hits(t: _Tokens, index: dict) -> list[tuple[int, int, int, list[str]]]:
    """Verified occurrences in one step of texts: (text, first word, last word, items)."""
    out = []
    if len(t.starts) == 0:
        return out
    body = t.data[t.inside].tobytes()
    for k, (f, entries) in index.items():
        where, which = f.find(t.shingles(k))
        rows = np.searchsorted(t.first, where, side="right") - 1
        for pos, e, row in zip(where.tolist(), which.tolist(), rows.tolist()):
            low, high = int(t.first[row]), int(t.first[row + 1])
            for at, n, lens, words, items in entries[e]:
                a = pos - at
                b = a + n
                if a < low or b > high:  # positional and length bounds
                    continue
                if (t.lens[a:b].tobytes() == lens
                        and body[t.body_at[a]:t.body_at[b]] == words):
                    out.append((row, a - low, b - low, items))
    return out


def _merge(found: list[tuple[str, int, int]]) -> tuple[list[str], list[tuple[int, int]]]:
    """Items, and the union of the word spans."""
    spans: list[list[int]] = []
    for a, b in sorted({(a, b) for _, a, b in found}):
        if spans and a <= spans[-1][1]:
            spans[-1][1] = max(spans[-1][1], b)
        else:
            spans.append([a, b])
    return sorted({i for i, _, _ in found}), [tuple(s) for s in spans]


def find_contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, shingle: int = SHINGLE,
                       block_windows: int = BLOCK_WINDOWS) -> DataFrame:
    """``docs`` with ``n_words``, ``n_hit``, ``items`` (sorted ids) and ``hit_spans``.

    ``hit_spans`` are the hit stretches of words as [first, last) word numbers.
    Every document row comes back once, repeated rows too.  A null or empty
    text has no words and no hits.  Benchmark items without words match
    nothing; a null item id counts as ''; an empty benchmark hits nothing.
    An empty table of documents gives an empty one; very long texts are searched
    whole.  Incoming columns named like the added ones are replaced; all others pass.
    """
    ship(docs.sparkSession)
    docs = without(docs, _ADDED)
    texts = docs.select("text")
    found = cut(benchmark_windows(benchmark, window))
    n_blocks = -(-found.count() // block_windows)
    span = T.ArrayType(T.StructType([T.StructField("first", T.LongType()), T.StructField("last", T.LongType())]))
    schema = T.StructType(docs.schema.fields + [
        T.StructField("n_words", T.LongType()), T.StructField("n_hit", T.LongType()),
        T.StructField("items", T.ArrayType(T.StringType())), T.StructField("hit_spans", span)])
    out = docs
    for b in range(max(1, n_blocks)):
        # dealt by item too, so a window that many items share is in several blocks
        block = found.where(F.pmod(F.xxhash64("window", "item"), F.lit(max(1, n_blocks))) == b)
        windows = _block(block.collect(), shingle)  # bounded by the block
        index = _prefix_index(windows, _corpus_counts(texts, windows)) if windows else {}
        match = _matcher(docs.sparkSession.sparkContext.broadcast(index), len(docs.columns), docs.columns.index("text"))
        out = map_batches(out, match, schema)
    return out


def _matcher(shared, width: int, text_at: int):
    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = {k: (_Filter(v), entries) for k, (v, entries) in shared.value.items()}
        span = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))
        for batch in batches:
            data, offsets = text_bytes(batch.column(text_at))
            n_words = np.zeros(batch.num_rows, np.int64)
            found: dict[int, list] = {}
            if batch.num_columns > width:  # hits of an earlier block
                for r, (items, spans) in enumerate(zip(batch.column(width + 2).to_pylist(), batch.column(width + 3).to_pylist())):
                    if items:
                        ends = [(s["first"], s["last"]) for s in spans]
                        found[r] = [(i, *ends[0]) for i in items] + [(items[0], *s) for s in ends]
            for i, j in steps(offsets):
                t = _Tokens(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
                n_words[i:j] = np.diff(t.first)
                for row, a, b, items in _hits(t, index):
                    found.setdefault(i + row, []).extend((x, a, b) for x in items)
            n_hit = np.zeros(batch.num_rows, np.int64)
            items, spans = [[]] * batch.num_rows, [[]] * batch.num_rows
            for r, hits in found.items():
                items[r], spans[r] = _merge(hits)
                n_hit[r] = sum(b - a for a, b in spans[r])
            spans = [[{"first": a, "last": b} for a, b in s] for s in spans]
            yield pa.RecordBatch.from_arrays(
                batch.columns[:width] + [pa.array(n_words), pa.array(n_hit), pa.array(items, pa.list_(pa.string())),
                                         pa.array(spans, span)],
                names=batch.schema.names[:width] + ["n_words", "n_hit", "items", "hit_spans"])
    return match


def is_contaminated():
    """A document is contaminated when hit words are a twentieth of its words or more."""
    return (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))


def remove_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, with their own columns."""
    rows, back = set_aside(docs, _ADDED)
    return back(find_contamination(rows, benchmark).where(~is_contaminated()))


# ---------------------------------------------------------------- query

def query(spark, sf_dir: str) -> DataFrame:
    """Contract form: one row per document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = find_contamination(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
                        is_contaminated().alias("contaminated"))


SQL = """
WITH d AS (SELECT row_number() OVER () AS r, doc_id,
                  coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                              '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), []) AS w
           FROM documents),
     b AS (SELECT CAST(item_id AS VARCHAR) AS item,
                  regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
           FROM benchmark),
     bw AS (SELECT DISTINCT item, least(len(w), 13) AS n, array_to_string(list_slice(w, i, i + 12), ' ') AS x
            FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
     dw AS (SELECT r, n, i, array_to_string(list_slice(w, i, i + n - 1), ' ') AS x
            FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i
                  FROM d, (SELECT DISTINCT n FROM bw) WHERE len(w) >= n)),
     hit AS (SELECT r, i, dw.n, item FROM dw JOIN bw ON dw.n = bw.n AND dw.x = bw.x),
     words AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS p FROM hit) GROUP BY r),
     items AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
               FROM (SELECT DISTINCT r, item FROM hit) GROUP BY r)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN words USING (r) LEFT JOIN items USING (r)
"""
