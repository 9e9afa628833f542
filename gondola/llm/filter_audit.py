"""Filter interaction audit: what each filter removes, given those before it.

One pass over each text's UTF-8 bytes counts words, capitals, code points and
symbols.  The pass is a finite-state transducer given by two tables: ``CLASS``
maps a byte to its class, ``OUT`` maps the state (the class of the byte before,
``SPACE`` at the start) and the class to output bits (word begins, word ends,
code point, capital, symbol).  As a state depends on one byte only, the table is
applied to a whole block of bytes at once.  The word spans that the pass puts
out are inserted into a hash table with linear probing; a word meets an earlier
one only where all their bytes agree, so distinct words are exact.

Every document then has a set of failing filters.  Documents are counted by
part and failing set, and everything about every order of the filters follows
from those counts: at most 2**filters numbers for a part.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import permutations
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import STEP_BYTES, map_batches, mix, ship, steps, stored, text_bytes, without, word_hashes

# ---------------------------------------------------------------- transducer

SPACE, CAPITAL, SYMBOL, OTHER, CONTINUATION = range(5)
STARTS, ENDS, POINT, UPPER, SIGN = (1 << i for i in range(5))
SYMBOLS = b"#$%&*|"


def _classes() -> np.ndarray:
    t = np.full(256, OTHER, np.uint8)
    t[[0x20, *range(0x09, 0x0E)]] = SPACE
    t[0x41:0x5B] = CAPITAL
    t[list(SYMBOLS)] = SYMBOL
    t[0x80:0xC0] = CONTINUATION
    return t


def _outputs() -> np.ndarray:
    t = np.zeros((8, 8), np.uint8)
    for state in range(5):
        for c in range(5):
            t[state, c] = ((STARTS if state == SPACE != c else 0) | (ENDS if state != SPACE == c else 0)
                           | (POINT if c != CONTINUATION else 0) | (UPPER if c == CAPITAL else 0) | (SIGN if c == SYMBOL else 0))
    return t.ravel()


CLASS, OUT = _classes(), _outputs()


def transduce(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Output bits of each byte, and of the step that ends each text."""
    classes = CLASS[data]
    state = np.empty(len(data), np.uint8)
    state[1:] = classes[:-1]
    state[offsets[:-1][offsets[:-1] < len(data)]] = SPACE  # every text begins in this state
    full = offsets[1:] > offsets[:-1]
    last = np.full(len(offsets) - 1, SPACE, np.uint8)
    last[full] = classes[offsets[1:][full] - 1]
    return OUT[(state << 3) | classes], OUT[(last << 3) | SPACE] & ENDS  # a text's end acts as a space


def _sums(bits: np.ndarray, flag: int, offsets: np.ndarray) -> np.ndarray:
    """How often a flag occurs in each text."""
    at = np.flatnonzero(bits & flag)
    return np.diff(np.searchsorted(at, offsets))


# ---------------------------------------------------------------- hash table

def _words8(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each byte on, as one number (zeros after the end)."""
    padded = np.zeros(len(data) + 8, np.uint8)
    padded[:len(data)] = data
    return np.lib.stride_tricks.sliding_window_view(padded, 8)[:len(data)].copy().view(np.uint64).ravel()


def same_bytes(eight: np.ndarray, a: np.ndarray, b: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """Whether the spans of equal length from ``a`` and from ``b`` hold equal bytes."""
    same = np.ones(len(a), bool)
    todo, at = np.arange(len(a)), 0
    while len(todo):
        left = lens[todo] - at
        keep = np.where(left >= 8, np.uint64(2**64 - 1), (np.uint64(1) << (8 * np.clip(left, 0, 7)).astype(np.uint64)) - np.uint64(1))
        same[todo] = ((eight[a[todo] + at] ^ eight[b[todo] + at]) & keep) == 0
        at += 8
        todo = todo[same[todo] & (left > 8)]
    return same


def first_occurrences(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, text: np.ndarray) -> np.ndarray:
    """Mask of the words that no earlier word of the same text equals.

    Open addressing: in a round every word that has no place yet looks at its
    slot; free slots go to the first word that asks, words equal to a slot's
    owner (same text, length and bytes) are done, all others go one slot on.
    """
    first = np.zeros(len(starts), bool)
    if not len(starts):
        return first
    hashes = mix(word_hashes(data, starts, ends) + text.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    size = 1 << max(4, int(2 * len(starts) - 1).bit_length())
    owner = np.full(size, -1, np.int64)
    eight, lens = _words8(data), ends - starts
    slot = (hashes & np.uint64(size - 1)).astype(np.int64)
    todo = np.arange(len(starts))
    while len(todo):
        at = slot[todo]
        free = owner[at] < 0
        owner[at[free][::-1]] = todo[free][::-1]  # of several the first stays
        first[owner[at[free]]] = True
        held = owner[at]
        equal = (hashes[todo] == hashes[held]) & (text[todo] == text[held]) & (lens[todo] == lens[held])
        rest = np.flatnonzero(equal & (held != todo))
        equal[rest] = same_bytes(eight, starts[todo[rest]], starts[held[rest]], lens[todo[rest]])
        todo = todo[~equal]
        slot[todo] = (slot[todo] + 1) & (size - 1)
    return first


# ---------------------------------------------------------------- counts of a text

COUNTS = ["n_words", "n_distinct", "n_capitals", "n_chars", "n_symbols"]


def _count(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Counts of several texts laid end to end, as rows of ``COUNTS``, and the
    spans of each distinct word: start, end."""
    bits, closing = transduce(data, offsets)
    starts = np.flatnonzero(bits & STARTS)
    inner = np.flatnonzero(bits & ENDS)
    ends = np.sort(np.concatenate([inner, offsets[1:][closing > 0]]))
    first_word = np.searchsorted(starts, offsets)
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(first_word))
    first = first_occurrences(data, starts, ends, text)
    return np.stack([np.diff(first_word), np.bincount(text[first], minlength=len(offsets) - 1), _sums(bits, UPPER, offsets),
                     _sums(bits, POINT, offsets), _sums(bits, SIGN, offsets)]), [starts[first], ends[first]]


def _count_long(data: np.ndarray, limit: int) -> np.ndarray:
    """Counts of one text by blocks that end before a space; the distinct words
    of all blocks are held, nothing else."""
    total, words, at = np.zeros(len(COUNTS), np.int64), set(), 0
    while at < len(data):
        end = min(len(data), at + limit)
        while end < len(data) and CLASS[data[end]] != SPACE:
            end += 1
        block = data[at:end]
        counts, (a, b) = _count(block, np.array([0, len(block)]))
        body = block.tobytes()
        words.update(body[i:j] for i, j in zip(a.tolist(), b.tolist()))
        total += counts[:, 0]
        at = end
    total[1] = len(words)
    return total


def text_counts(docs: DataFrame, limit: int = STEP_BYTES) -> DataFrame:
    """``docs`` less ``text``, with the text's ``COUNTS``.

    A null text counts as an empty one; a text longer than ``limit`` bytes is
    taken in blocks; repeated rows stay repeated; an empty table gives an empty
    one.  Incoming columns named like the counts are replaced.
    """
    ship(docs.sparkSession)
    docs = without(docs, COUNTS)
    names = [c for c in docs.columns if c != "text"]
    schema = T.StructType([docs.schema[c] for c in names] + [T.StructField(c, T.LongType()) for c in COUNTS])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column(len(names)))
            counts = np.zeros((len(COUNTS), batch.num_rows), np.int64)
            for i, j in steps(offsets, limit):
                part = data[offsets[i]:offsets[j]]
                counts[:, i:j] = (_count_long(part, limit)[:, None] if len(part) > limit
                                  else _count(part, offsets[i:j + 1] - offsets[i])[0])
            yield pa.RecordBatch.from_arrays(batch.columns[:len(names)] + [pa.array(c) for c in counts], names=names + COUNTS)

    return map_batches(docs.select(*[F.col(f"`{c}`") for c in names], "text"), run, schema)


# ---------------------------------------------------------------- filters

def copies_of_smaller(rows: DataFrame) -> DataFrame:
    """``rows`` (doc_id, digest, ...) with ``copy``: a smaller doc_id has the same digest.

    Joined by digest and doc_id together, so that the rows of a frequent text
    are spread; a row without doc_id is neither smaller nor larger than another.
    """
    smallest = (rows.where("doc_id IS NOT NULL").groupBy("digest").agg(F.min("doc_id").alias("doc_id"))
                .withColumn("__smallest", F.lit(True)))
    out = rows.where("doc_id IS NOT NULL").join(smallest, ["digest", "doc_id"], "left")
    out = out.withColumn("copy", F.col("__smallest").isNull()).drop("__smallest")
    return out.unionByName(rows.where("doc_id IS NULL").withColumn("copy", F.lit(False)))


#: Filters by letter: SQL over the counts and ``copy``, true where a document fails.
FILTERS: dict[str, str] = {
    "A": "n_words < 50",
    "B": "100 * n_distinct < 65 * n_words",
    "C": "100 * n_capitals > 5 * n_chars",
    "D": "n_symbols > 0",
    "E": "copy",
}


def failing_sets(docs: DataFrame, labels: DataFrame, filters: dict[str, str] | None = None) -> DataFrame:
    """(part, fails, n, good, toxic): documents by source and set of failing
    filters (bit i: the i-th filter), with those labelled quality 1 and toxic 1."""
    filters = filters or FILTERS
    own = docs.select("doc_id", F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"), "text",
                      F.unhex(F.sha2(F.coalesce("text", F.lit("")), 256)).alias("digest"))
    rows = copies_of_smaller(stored(text_counts(own)))
    fails = F.lit(0)
    for i, condition in enumerate(filters.values()):
        fails = fails.bitwiseOR(F.when(F.expr(condition), F.lit(1 << i)).otherwise(F.lit(0)))
    # a doc_id may stand on many rows; they are added up before they meet the labels
    cells = rows.groupBy("doc_id", "part", fails.alias("fails")).agg(F.count("*").alias("n"))
    marks = labels.where("doc_id IS NOT NULL").groupBy("doc_id").agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False)).cast("int")).alias("good"),
        F.max(F.coalesce(F.col("toxic") == 1, F.lit(False)).cast("int")).alias("toxic"))
    named = cells.where("doc_id IS NOT NULL").join(marks, "doc_id", "left")
    unnamed = cells.where("doc_id IS NULL").withColumns({"good": F.lit(0), "toxic": F.lit(0)})
    return named.unionByName(unnamed).groupBy("part", "fails").agg(
        F.sum("n").alias("n"), F.sum(F.col("n") * F.coalesce("good", F.lit(0))).alias("good"),
        F.sum(F.col("n") * F.coalesce("toxic", F.lit(0))).alias("toxic"))


def interactions(cells: DataFrame, letters: Sequence[str]) -> DataFrame:
    """Every order of the filters, step by step, from the counts of ``failing_sets``."""
    n = len(letters)
    bit = {x: 1 << i for i, x in enumerate(letters)}
    plan = []
    for order in permutations(letters):
        before = 0
        for step, x in enumerate(order, 1):
            plan.append(F.struct(F.lit("".join(order)).alias("filter_order"), F.lit(step).alias("step"),
                                 F.lit(bit[x]).alias("own"), F.lit(before).alias("before")))
            before |= bit[x]
    # one row of at most 2**n cells for a part
    parts = cells.groupBy("part").agg(F.collect_list(F.struct("fails", "n", "good", "toxic")).alias("cells"))
    rows = parts.select("part", "cells", F.inline(F.array(*plan)))

    def total(value: str, where) -> Column:
        return F.aggregate("cells", F.lit(0).cast("long"), lambda s, c: s + F.when(where(c["fails"]), c[value]).otherwise(F.lit(0)))

    own, before = F.col("own"), F.col("before")
    has = lambda f: f.bitwiseAND(own) != 0
    free = lambda f: f.bitwiseAND(before) == 0
    here = lambda f: has(f) & free(f)
    # of all orders, a document is removed by each of its failing filters equally often
    orders = F.array(F.lit(0), *[F.lit(factorial(n) // k) for k in range(1, n + 1)])
    shares = F.aggregate("cells", F.lit(0).cast("long"), lambda s, c: s + F.when(
        has(c["fails"]), c["n"] * F.get(orders, F.bit_count(c["fails"]))).otherwise(F.lit(0)))
    return rows.select(
        "part", "filter_order", "step",
        total("n", lambda f: f.bitwiseAND(own.bitwiseOR(before)) == 0).alias("kept"), total("n", here).alias("removed"),
        total("n", lambda f: has(f) & ~free(f)).alias("redundant"), total("n", lambda f: f == own).alias("unique_fails"),
        total("good", here).alias("good_lost"), total("toxic", here).alias("toxic_lost"), shares.alias("shapley"))


def audit(docs: DataFrame, labels: DataFrame, filters: dict[str, str] | None = None) -> DataFrame:
    """One row for each part, order of the filters and step.

    A null text is an empty one, and empty texts are copies of each other; a null
    source is the part ''; a row without doc_id is no copy, makes none and has no
    label; repeated rows count as documents of their own and are no copies of
    each other, having one doc_id; a document is good or toxic if any of its
    labels says so, and labels without a document count nothing.  Very long texts
    are counted whole.  An empty table of documents gives no rows.  Other columns
    of the tables are not read, so their names cannot clash.
    """
    return interactions(failing_sets(docs, labels, filters), list(filters or FILTERS))


# ---------------------------------------------------------------- query

def query(spark, sf_dir: str) -> DataFrame:
    """Contract form: five filters over all documents, 120 orders of five steps."""
    return audit(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))


SQL = """
WITH d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
                  regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
     c AS (SELECT doc_id, part, len(w) < 50 AS a, 100 * len(list_distinct(w)) < 65 * len(w) AS b,
                  100 * len(regexp_extract_all(t, '[A-Z]')) > 5 * length(t) AS c, regexp_matches(t, '[#$%&*|]') AS d,
                  coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), false) AS e FROM d),
     l AS (SELECT doc_id, coalesce(max(CAST(quality = 1 AS INTEGER)), 0) AS good, coalesce(max(CAST(toxic = 1 AS INTEGER)), 0) AS toxic
           FROM labels GROUP BY doc_id),
     g AS (SELECT part, CASE WHEN a THEN 'A' ELSE '' END || CASE WHEN b THEN 'B' ELSE '' END || CASE WHEN c THEN 'C' ELSE '' END
                  || CASE WHEN d THEN 'D' ELSE '' END || CASE WHEN e THEN 'E' ELSE '' END AS fails,
                  count(*) AS n, sum(coalesce(good, 0)) AS good, sum(coalesce(toxic, 0)) AS toxic
           FROM c LEFT JOIN l USING (doc_id) GROUP BY 1, 2),
     x AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f),
     o AS (SELECT p.f || q.f || r.f || s.f || t.f AS filter_order FROM x p, x q, x r, x s, x t
           WHERE len(list_distinct([p.f, q.f, r.f, s.f, t.f])) = 5),
     k AS (SELECT filter_order, step, substr(filter_order, step, 1) AS own, substr(filter_order, 1, step - 1) AS before
           FROM o, (SELECT unnest([1, 2, 3, 4, 5]) AS step)),
     h AS (SELECT part, filter_order, step, n, good, toxic, fails, own, contains(fails, own) AS has,
                  translate(fails, before, '') = fails AS free FROM g, k)
SELECT part, filter_order, CAST(step AS INTEGER) AS step,
       CAST(sum(CASE WHEN free AND NOT has THEN n ELSE 0 END) AS BIGINT) AS kept,
       CAST(sum(CASE WHEN free AND has THEN n ELSE 0 END) AS BIGINT) AS removed,
       CAST(sum(CASE WHEN has AND NOT free THEN n ELSE 0 END) AS BIGINT) AS redundant,
       CAST(sum(CASE WHEN fails = own THEN n ELSE 0 END) AS BIGINT) AS unique_fails,
       CAST(sum(CASE WHEN free AND has THEN good ELSE 0 END) AS BIGINT) AS good_lost,
       CAST(sum(CASE WHEN free AND has THEN toxic ELSE 0 END) AS BIGINT) AS toxic_lost,
       CAST(sum(CASE WHEN has THEN n * (120 // length(fails)) ELSE 0 END) AS BIGINT) AS shapley
FROM h GROUP BY part, filter_order, step
"""
