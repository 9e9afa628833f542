"""Brown class-based bigrams.

Words are grouped into classes by exchange clustering: starting from classes
by frequency, each unit in turn moves to the class that raises the likelihood
of the class bigrams most, until no unit moves.  A text's probability is the
product over its tokens of P(class | class before) and P(word | class), with
smoothed transitions and emissions; its perplexity follows.

Counts come from the whole training corpus, and the exchange has two levels.
First units are clustered on the driver: the most frequent words (at most
``CLUSTERED``), and for all other words their ending, hashed to ``ENDINGS``
units, so the bigram table has a fixed bound.  Then the next words by frequency,
up to ``EXCHANGED``, are exchanged one by one, from the class of their ending:
a grouped aggregation counts the classes before and after each word, and tasks
move each word by the same gain against the shared class table, pass after
pass, as long as the likelihood of the whole corpus rises.  Words beyond have
their ending's class.  For the exchange the texts are stored as word numbers once.

Emissions always use the word's own count.  For scoring, the counts of the
``FREQUENT`` most frequent words are sent to the tasks; the counts of all other
words are joined by a shuffle.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import LOWER, NONSPACE, crc32, cut, map_batches, ship, steps, stored, text_bytes, without, word_array, word_spans

#: Most words that are units of their own, and units for the endings of others.
CLUSTERED = 768
ENDINGS = 256
CLASSES = 48
#: Most passes of the exchange over all units.
PASSES = 30
#: Most words that have a class of their own, and most passes over them.
EXCHANGED = 1 << 18
WORD_PASSES = 2
#: Blocks of words that one task of the exchange holds at once.
BLOCKS = 1024
#: Most words whose counts are sent to the tasks.
FREQUENT = 1 << 18
#: Pseudo-count of the class shares in a transition.
SMOOTHING = 20.0
_STEP = 2 << 20
_END = 0  # the unit (and class) of a text's end, which also stands before its start


class _Words:
    """Words of one step of texts."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.data = LOWER[data]
        inside, self.starts, self.ends, self.first = word_spans(self.data, offsets, NONSPACE)
        self.array = word_array(self.data, inside, self.starts, self.ends)

    def endings(self) -> np.ndarray:
        return _endings(self.data, self.starts, self.ends)


def _endings(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Number of each word's ending: its last three bytes, hashed."""
    h = np.zeros(len(ends), np.uint32)
    for back in (1, 2, 3):
        at = ends - back
        h = h * np.uint32(257) + np.where(at >= starts, data[np.maximum(at, 0)] if len(data) else 0, 0).astype(np.uint32)
    return ((h * np.uint32(2654435761)) >> np.uint32(16)) % ENDINGS


def _find(words: pa.Array, known: pa.Array) -> np.ndarray:
    """Index of each word among the known ones, -1 if absent."""
    return pc.index_in(words, value_set=known).fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)


def _texts(batches: Iterator[pa.RecordBatch], column: int = 0) -> Iterator[tuple[pa.RecordBatch, int, int, _Words]]:
    for batch in batches:
        data, offsets = text_bytes(batch.column(column))
        for i, j in steps(offsets, _STEP):
            yield batch, i, j, _Words(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])


def word_counts(texts: DataFrame) -> DataFrame:
    """(word, n) over all texts; words are lower-cased (A-Z) bytes."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []

        def flush() -> Iterator[pa.RecordBatch]:
            if held:
                whole = pa.concat_tables(held).group_by("word").aggregate([("n", "sum")])
                yield from whole.select(["word", "n_sum"]).rename_columns(["word", "n"]).to_batches(max_chunksize=65_536)
                held.clear()

        for _, _, _, w in _texts(batches):
            c = w.array.value_counts()
            held.append(pa.table({"word": c.field("values").cast(pa.binary()), "n": c.field("counts")}))
            if sum(t.num_rows for t in held) > 400_000:
                yield from flush()
        yield from flush()

    ship(texts.sparkSession)
    return map_batches(texts, count, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


def frequent_words(counts: DataFrame, *most: int) -> tuple[pa.Table, list[int]]:
    """(word, n) of the most frequent words, and for each bound in ``most`` how many
    of them it takes: at most that many, and all of a level of frequency or none
    (levels are sixteenths of a doubling).  The table holds the largest bound's."""
    level = F.floor(F.log2("n") * 16)
    sizes = counts.groupBy(level.alias("level")).count().collect()  # at most 16 * 64 levels
    sizes = sorted(((r["level"], r["count"]) for r in sizes), reverse=True)
    sums = np.cumsum([n for _, n in sizes], dtype=np.int64)
    whole = [int(np.searchsorted(sums, m, side="right")) for m in most]  # levels within the bound
    taken = [int(sums[k - 1]) if k else 0 for k in whole]
    if not any(taken):
        return pa.table({"word": pa.array([], pa.large_binary()), "n": pa.array([], pa.int64())}), taken
    found = counts.where(level >= sizes[max(whole) - 1][0]).select("word", "n").toArrow()
    found = found.set_column(0, "word", found.column("word").cast(pa.large_binary())).combine_chunks()
    return found.sort_by([("n", "descending"), ("word", "ascending")]), taken


def _one_array(column: pa.ChunkedArray) -> pa.Array:
    return pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.large_binary())


def _chain(of_words: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Values with one end after each text's words, and each text's first position."""
    ends = first[1:]
    return np.insert(of_words, ends, _END), first + np.arange(len(first))


def numbered(texts: DataFrame, words: pa.Array) -> DataFrame:
    """The texts as numbers, 32 bits a word, in one binary column ``ids``: the word's
    place in ``words``, or -1 less the number of its ending.  Stored, so the passes
    below neither split nor look up words again; a numbered table is given back."""
    if texts.columns == ["ids"]:
        return texts
    shared = texts.sparkSession.sparkContext.broadcast(words)

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, _, _, w in _texts(batches):
            at = _find(w.array, shared.value)
            ids = np.where(at >= 0, at, -1 - w.endings().astype(np.int64)).astype(np.int32)
            column = pa.Array.from_buffers(pa.binary(), len(w.first) - 1, [None, pa.py_buffer((4 * w.first).astype(np.int32)), pa.py_buffer(ids)])
            yield pa.RecordBatch.from_arrays([column], names=["ids"])

    return stored(map_batches(texts, number, "ids binary"))


def _numbers(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Word numbers of a step of numbered texts, and each text's first."""
    for batch in batches:
        data, offsets = text_bytes(batch.column(0))
        for i, j in steps(offsets, _STEP):
            yield data[offsets[i]:offsets[j]].view(np.int32), (offsets[i:j + 1] - offsets[i]) // 4


def _bigrams(ids: DataFrame, of_number: np.ndarray, size: int) -> np.ndarray:
    """Counts of successive values over all numbered texts, as a square matrix;
    ``of_number`` has each number's value, the endings' from its end."""
    shared = ids.sparkSession.sparkContext.broadcast(of_number)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size * size, np.int64)
        for numbers, first in _numbers(batches):
            chain, _ = _chain(shared.value[numbers], first)
            before = np.concatenate([[_END], chain[:-1]]) if len(chain) else chain
            total += np.bincount(before * size + chain, minlength=len(total))
        at = np.flatnonzero(total)
        for s in range(0, len(at), 65_536):
            part = at[s:s + 65_536]
            yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(total[part])], names=["pair", "n"])

    pairs = map_batches(ids, count, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    found = pairs.toArrow()  # at most size ** 2 rows
    out = np.zeros(size * size)
    out[found.column("pair").to_numpy()] = found.column("n").to_numpy()
    return out.reshape(size, size)


def unit_bigrams(texts: DataFrame, words: pa.Array, n_named: int) -> np.ndarray:
    """Counts of successive units: 1.. for the first ``n_named`` words, after them the endings."""
    data, offsets = text_bytes(words[n_named:])
    by_ending = 1 + n_named + np.concatenate([_endings(data, offsets[:-1], offsets[1:]), np.arange(ENDINGS)[::-1]])
    return _bigrams(numbered(texts, words), np.concatenate([1 + np.arange(n_named), by_ending]), 1 + n_named + ENDINGS)


def _xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1e-300))


def _taken_out(grid: np.ndarray, old: int, r: np.ndarray, l: np.ndarray, own: float) -> None:  # noqa: E741
    """Takes a unit's bigrams out of the class table."""
    grid[old] -= r
    grid[:, old] -= l
    grid[old, old] -= own


def _gains(grid: np.ndarray, r: np.ndarray, l: np.ndarray, own: float) -> np.ndarray:  # noqa: E741
    """What each class for a unit adds to the likelihood.

    ``grid`` holds the class bigrams without the unit, ``r`` and ``l`` its
    counts of classes after and before, ``own`` how often it follows itself.
    """
    base = _xlogx(grid)
    rows, cols = _xlogx(grid + r) - base, _xlogx(grid + l[:, None]) - base
    diagonal = np.arange(len(grid))
    gain = rows.sum(axis=1) - rows[diagonal, diagonal] + cols.sum(axis=0) - cols[diagonal, diagonal]
    d = grid[diagonal, diagonal]
    gain += _xlogx(d + r + l + own) - _xlogx(d)
    left, right = grid.sum(axis=1), grid.sum(axis=0)
    gain -= _xlogx(left + r.sum() + own) - _xlogx(left) + _xlogx(right + l.sum() + own) - _xlogx(right)
    gain[_END] = -np.inf
    return gain


def _best(gain: np.ndarray, old: int) -> int:
    new = int(np.argmax(gain))
    return int(old) if gain[new] <= gain[old] + 1e-9 * abs(gain[old]) else new


def _best_classes(grid: np.ndarray, cells: np.ndarray, old: np.ndarray) -> np.ndarray:
    """``_best`` of ``_gains`` for many units at once, each taken out of ``grid`` alone.

    A row of ``cells`` holds a unit's counts of classes after and before it and of
    itself.  Only classes that it meets change their column or row, so the terms
    are those of the counts above zero.
    """
    size = len(grid)
    r, l, own = cells[:, :size], cells[:, size:-1], cells[:, -1:]  # noqa: E741
    unit, base = np.arange(len(cells)), _xlogx(grid)
    gain = np.zeros(r.shape)
    for mine, other, table, logs in ((r, l, grid.T, base.T), (l, r, grid, base)):
        i, j = np.nonzero(mine)
        if not len(i):
            continue
        n, at, of = mine[i, j], np.arange(len(i)), old[i]
        rest, before = table[j], logs[j]
        hit = j == of
        rest[hit] -= other[i[hit]]
        rest[at, of] -= n
        before[hit] = _xlogx(rest[hit])
        before[at, of] = _xlogx(rest[at, of])
        terms = _xlogx(rest + n[:, None]) - before
        terms[at, j] = 0.0  # the diagonal comes below
        starts = np.flatnonzero(np.diff(i, prepend=-1))
        gain[i[starts]] += np.add.reduceat(terms, starts, axis=0)
    d = np.repeat(np.diagonal(grid)[None], len(cells), axis=0)
    d[unit, old] -= r[unit, old] + l[unit, old] + own[:, 0]
    gain += _xlogx(d + r + l + own) - _xlogx(d)
    for mine, other, sums in ((r, l, grid.sum(axis=1)), (l, r, grid.sum(axis=0))):
        taken = mine.sum(axis=1, keepdims=True) + own
        left = sums - other
        left[unit, old] -= taken[:, 0]
        gain -= _xlogx(left + taken) - _xlogx(left)
    gain[:, _END] = -np.inf
    new, kept = np.argmax(gain, axis=1), gain[unit, old]
    return np.where(gain[unit, new] <= kept + 1e-9 * np.abs(kept), old, new)


def exchange_clusters(bigrams: np.ndarray, classes: int = CLASSES, passes: int = PASSES) -> np.ndarray:
    """Class of each unit; the end (unit 0) keeps class 0 to itself."""
    n = len(bigrams)
    freq = bigrams.sum(axis=0)
    order = [u for u in np.argsort(-freq, kind="stable") if u != _END and freq[u] > 0]
    of = np.ones(n, np.int64)
    of[_END] = 0
    for k, u in enumerate(order):
        of[u] = 1 + k % (classes - 1)
    member = np.zeros((n, classes))
    member[np.arange(n), of] = 1.0
    to_class, from_class = bigrams @ member, bigrams.T @ member  # of each unit
    grid = member.T @ to_class
    for _ in range(passes):
        moved = 0
        for u in order:
            old = of[u]
            own = bigrams[u, u]
            r, l = to_class[u].copy(), from_class[u].copy()  # noqa: E741
            r[old] -= own
            l[old] -= own
            _taken_out(grid, old, r, l, own)
            new = _best(_gains(grid, r, l, own), old)
            grid[new] += r
            grid[:, new] += l
            grid[new, new] += own
            if new != old:
                of[u] = new
                to_class[:, old] -= bigrams[:, u]
                to_class[:, new] += bigrams[:, u]
                from_class[:, old] -= bigrams[u]
                from_class[:, new] += bigrams[u]
                moved += 1
        if not moved:
            break
    return of


# ---------------------------------------------------------------- exchange of single words

class Classes:
    """Class of every word: by name for the first words, by ending for all others."""

    def __init__(self, words: pa.Array, of_word: np.ndarray, of_ending: np.ndarray):
        self.words, self.of_word, self.of_ending = words, of_word, of_ending

    def of_number(self) -> np.ndarray:
        """Class of each number of ``numbered``, the endings' from the end."""
        return np.concatenate([self.of_word, self.of_ending[::-1]])


def class_bigrams(texts: DataFrame, classes: Classes) -> np.ndarray:
    """Counts of successive classes over all texts."""
    return _bigrams(numbered(texts, classes.words), classes.of_number(), CLASSES)


def _word_cells(words: np.ndarray, sums: np.ndarray) -> pa.RecordBatch:
    """(word, cells) of a block of words."""
    i, slot = np.nonzero(sums)
    cells = pa.StructArray.from_arrays([pa.array(slot.astype(np.int32)), pa.array(sums[i, slot])], names=["slot", "n"])
    ends = pa.array(np.searchsorted(i, np.arange(len(words) + 1)), pa.int32())
    return pa.RecordBatch.from_arrays([pa.array(words), pa.ListArray.from_arrays(ends, cells)], names=["word", "cells"])


def word_contexts(texts: DataFrame, classes: Classes, first: int, finish: Callable[[np.ndarray, np.ndarray], pa.RecordBatch] = _word_cells,
                  schema: str = "word int, cells array<struct<slot: int, n: long>>") -> DataFrame:
    """(word, cells) for the words numbered from ``first`` on; cells are (slot, n).

    Slots are the classes after the word, then the classes before it, then the
    word itself after itself.  A task sends its combined counts as one row for
    each block of words; ``finish`` makes the rows of a block from its words and
    their counts (a row for each word, a column for each slot).
    """
    ids = numbered(texts, classes.words)
    shared = ids.sparkSession.sparkContext.broadcast(classes.of_number())
    width = 2 * CLASSES + 1
    room = width * -(-len(classes.words) // BLOCKS)  # of a block

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def flush() -> Iterator[pa.RecordBatch]:
            if held:
                key, n = np.unique(np.concatenate(held), return_counts=True)
                held.clear()
                blocks, starts = np.unique(key // room, return_index=True)
                ends = pa.array(4 * np.append(starts, len(key)), pa.int32())
                packed = [pa.Array.from_buffers(pa.binary(), len(blocks), [None, ends.buffers()[1], pa.py_buffer(x.astype(np.int32))]) for x in (key % room, n)]
                yield pa.RecordBatch.from_arrays([pa.array(blocks.astype(np.int32)), *packed], names=["block", "cells", "n"])

        for numbers, begin in _numbers(batches):
            chain, _ = _chain(shared.value[numbers], begin)
            word = np.insert(numbers, begin[1:], -1)
            if len(word) < 2:
                continue
            at = np.where(word >= first, (word % BLOCKS).astype(np.int64) * room + (word // BLOCKS) * width, -1)
            same = (word[:-1] == word[1:]) & (at[1:] >= 0)
            after, before = (at[:-1] >= 0) & ~same, (at[1:] >= 0) & ~same
            # the step's first word follows an end
            head = at[:1][at[:1] >= 0] + CLASSES + _END
            held.extend([at[:-1][after] + chain[1:][after], at[1:][before] + CLASSES + chain[:-1][before], at[1:][same] + 2 * CLASSES, head])
            if sum(map(len, held)) > 4_000_000:
                yield from flush()
        yield from flush()

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, cells, n in zip(*(c.to_pylist() for c in batch.columns)):
                if block not in sums:
                    sums[block] = np.zeros(room, np.int64)
                sums[block][np.frombuffer(cells, np.int32)] += np.frombuffer(n, np.int32)  # a row has a cell once
        for block in sorted(sums):
            table = sums.pop(block).reshape(-1, width)
            some = np.flatnonzero(table.any(axis=1))
            yield finish((some * BLOCKS + block).astype(np.int32), table[some])

    return map_batches(map_batches(ids, count, "block int, cells binary, n binary").repartition("block"), add, schema)


def _likelihood(grid: np.ndarray) -> float:
    return _xlogx(grid).sum() - _xlogx(grid.sum(axis=0)).sum() - _xlogx(grid.sum(axis=1)).sum()


def exchange_words(texts: DataFrame, classes: Classes, grid: np.ndarray, first: int, passes: int) -> tuple[Classes, np.ndarray]:
    """``classes`` after exchange passes over the words numbered from ``first`` on, and
    their class bigrams.  Words of a pass move at once; a pass that does not raise the
    likelihood is left out and ends the exchange."""
    ids = numbered(texts, classes.words)
    for _ in range(passes if len(classes.words) > first else 0):
        shared = ids.sparkSession.sparkContext.broadcast((grid, classes.of_word))

        def move(words: np.ndarray, cells: np.ndarray) -> pa.RecordBatch:
            table, of_word = shared.value  # noqa: B023
            new = _best_classes(table, cells.astype(np.float64), of_word[words])
            moved = new != of_word[words]
            return pa.RecordBatch.from_arrays([pa.array(words[moved]), pa.array(new[moved].astype(np.int32))], names=["word", "class"])

        moves = word_contexts(ids, classes, first, move, "word int, class int").toArrow()  # at most ``EXCHANGED`` rows
        of_word = classes.of_word.copy()
        of_word[moves.column("word").to_numpy()] = moves.column("class").to_numpy()
        moved = Classes(classes.words, of_word, classes.of_ending)
        table = class_bigrams(ids, moved) if moves.num_rows else grid
        if _likelihood(table) <= _likelihood(grid):
            break
        classes, grid = moved, table
    return classes, grid


class ClassModel:
    """What scoring needs; everything here has a fixed bound.

    ``frequent`` are the words sent to the tasks, all with their class, the first
    ``n_counted`` with their count.
    """

    def __init__(self, frequent: pa.Table, n_counted: int, classes: Classes, grid: np.ndarray, distinct: np.ndarray, n: int, v: int):
        self.frequent, self.n, self.v = _one_array(frequent.column("word")), n, v
        self.n_counted = n_counted
        self.counts = frequent.column("n").to_numpy().astype(np.float64)
        tokens = grid.sum(axis=0)
        share = (tokens + 1.0) / (tokens.sum() + CLASSES)
        self.transition = np.log10((grid + SMOOTHING * share) / (grid.sum(axis=1, keepdims=True) + SMOOTHING))
        # a word of the class: (count + 1) over this; the end is sure in its class
        self.room = np.log10(tokens + distinct + 1.0)
        self.ending_class = classes.of_ending
        data, offsets = text_bytes(self.frequent)
        by_ending = classes.of_ending[_endings(data, offsets[:-1], offsets[1:])]
        self.frequent_class = np.concatenate([classes.of_word, by_ending[len(classes.of_word):]])


def _distinct_words(counts: DataFrame, classes: Classes) -> np.ndarray:
    """Distinct training words of each class."""
    shared = counts.sparkSession.sparkContext.broadcast(classes.words)

    def endings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(ENDINGS, np.int64)
        for batch in batches:
            data, offsets = text_bytes(batch.column(0))
            other = _find(batch.column(0).cast(pa.large_binary()), shared.value) < 0
            total += np.bincount(_endings(data, offsets[:-1], offsets[1:])[other], minlength=ENDINGS)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["ending", "n"])

    out = np.bincount(classes.of_word, minlength=CLASSES).astype(np.float64)
    for r in map_batches(counts.select("word"), endings, "ending long, n long").groupBy("ending").agg(F.sum("n").alias("n")).collect():
        out[classes.of_ending[r["ending"]]] += r["n"]  # a row for each ending
    return out


def train(texts: DataFrame, counts: DataFrame, n_texts: int) -> ClassModel:
    """Model from training texts and their word counts."""
    table, (n_units, n_exchanged, n_counted) = frequent_words(counts, CLUSTERED, max(CLUSTERED, EXCHANGED), FREQUENT)
    words = _one_array(table.column("word"))
    ids = numbered(texts, words[:n_exchanged])
    bigrams = unit_bigrams(ids, words[:n_exchanged], n_units)
    of_unit = exchange_clusters(bigrams)
    member = np.eye(CLASSES)[of_unit]
    of_ending = of_unit[1 + n_units:]
    named = words[n_units:n_exchanged]
    data, offsets = text_bytes(named)
    of_word = np.concatenate([of_unit[1:1 + n_units], of_ending[_endings(data, offsets[:-1], offsets[1:])]])
    classes, grid = exchange_words(ids, Classes(words[:n_exchanged], of_word, of_ending), member.T @ bigrams @ member, n_units, WORD_PASSES)
    totals = counts.agg(F.sum("n").alias("n"), F.count("*").alias("v")).first()
    return ClassModel(table, n_counted, classes, grid, _distinct_words(counts, classes),
                      (totals["n"] or 0) + n_texts, totals["v"] + (n_texts > 0))


def score(docs: DataFrame, training: DataFrame) -> DataFrame:
    """``docs`` less text with n_tokens, n_known, train_tokens, base_score, score, perplexity.

    ``training`` holds the texts to learn from.  A null or empty text is an end
    alone.  With no training text every token is unknown; scores are finite.
    A very long text is scored whole; an empty table gives an empty one.  Words
    that tie in frequency are taken or left together, by their level.
    Repeated rows come back repeated.  Incoming columns named like the added
    ones are replaced.
    """
    added = ["n_tokens", "n_known", "train_tokens", "base_score", "score", "perplexity"]
    spark = docs.sparkSession
    ship(spark)
    texts = training.select("text")
    n_texts = texts.count()
    counts = cut(word_counts(texts))
    model = train(texts, counts, n_texts)
    shared = spark.sparkContext.broadcast(model)
    given = without(docs, [*added, "text"])
    width = len(given.columns)
    end_count = n_texts

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        row = TaskContext.get().partitionId() << 33
        room = np.log10(m.n + m.v + 1.0)
        logs = np.log10(m.counts + 1.0)
        for batch, i, j, w in _texts(batches, width):
            at = _find(w.array, m.frequent)
            cls = np.where(at < 0, m.ending_class[w.endings()], m.frequent_class[np.maximum(at, 0)] if len(m.frequent_class) else 0)
            rare = (at < 0) | (at >= m.n_counted)
            log_count = np.where(rare, 0.0, logs[np.maximum(at, 0)] if len(logs) else 0.0)
            chain, first = _chain(cls, w.first)
            before = np.concatenate([[_END], chain[:-1]])
            steps_ = m.transition[before, chain]
            sums = np.add.reduceat(steps_, first[:-1])  # every text has an end
            cum = lambda x: np.concatenate([[0.0], np.cumsum(x)])
            of_text = lambda x: np.diff(cum(x)[w.first])
            n_words = np.diff(w.first)
            seen = of_text(log_count)
            n_tokens = n_words + 1
            base = seen + np.log10(end_count + 1.0) - n_tokens * room
            total = sums + seen - of_text(m.room[cls] if len(cls) else cls)
            known = of_text((~rare).astype(np.float64)) + (end_count > 0)
            # words whose counts have to be joined, once for each text
            where = np.flatnonzero(rare)
            owner = np.searchsorted(w.first, where, side="right") - 1
            code = w.array.take(pa.array(where)).dictionary_encode()
            words = code.dictionary
            pair, tf = np.unique(owner * max(1, len(words)) + code.indices.to_numpy(), return_counts=True)
            per = np.searchsorted(pair // max(1, len(words)), np.arange(j - i + 1))
            lists = pa.ListArray.from_arrays(pa.array(per, pa.int32()), words.take(pa.array(pair % max(1, len(words)))).cast(pa.binary()))
            times = pa.ListArray.from_arrays(pa.array(per, pa.int32()), pa.array(tf.astype(np.int32)))
            part = batch.slice(i, j - i)
            yield pa.RecordBatch.from_arrays(
                part.columns[:width] + [pa.array(row + np.arange(j - i)), pa.array(n_tokens), pa.array(known.astype(np.int64)),
                                        pa.array(base), pa.array(total), lists, times],
                names=batch.schema.names[:width] + ["__row", "n_tokens", "n_known", "base_score", "score", "__words", "__times"])
            row += j - i

    schema = T.StructType(given.schema.fields + T._parse_datatype_string(
        "__row long, n_tokens long, n_known long, base_score double, score double, __words array<binary>, __times array<int>").fields)
    bodies = docs.select(*[F.col(f"`{c}`") for c in given.columns], F.col("text").alias("__text"))
    rows = stored(map_batches(bodies, run, schema))
    rare = (rows.select("__row", F.explode(F.arrays_zip("__words", "__times")).alias("w"))
            .select("__row", F.col("w.__words").alias("word"), F.col("w.__times").alias("times")))
    found = (rare.join(counts, "word").groupBy("__row")
             .agg(F.sum(F.col("times") * F.log10(F.col("n") + 1)).alias("__logs"), F.sum("times").alias("__known")))
    out = rows.drop("__words", "__times").join(found, "__row", "left")
    more = F.coalesce("__logs", F.lit(0.0))
    return out.select(*[F.col(f"`{c}`") for c in given.columns], "n_tokens", (F.col("n_known") + F.coalesce("__known", F.lit(0))).alias("n_known"),
                      F.lit(model.n).cast("long").alias("train_tokens"), (F.col("base_score") + more).alias("base_score"),
                      (F.col("score") + more).alias("score"), F.pow(F.lit(10.0), -(F.col("score") + more) / F.col("n_tokens")).alias("perplexity"))


# ---------------------------------------------------------------- query

def held_out(doc_id):
    return F.pmod(crc32(doc_id.cast("string")), F.lit(7)) == 2


def query(spark, sf_dir: str) -> DataFrame:
    """Contract form: one row per document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").withColumn("held_out", held_out(F.col("doc_id")))
    return score(docs, docs.where(~F.col("held_out"))).select(
        "doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score", "perplexity")
