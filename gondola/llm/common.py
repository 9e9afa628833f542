"""Helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
import os
import re
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Bytes of text that one vectorised step works on (a longer text is one step).
STEP_BYTES = 1 << 20


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Hand this package to the executors' Python, once per application."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="package-"), "gondola.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, files in os.walk(top):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(folder, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(top)))
    sc.addPyFile(path)
    _shipped.add(sc.applicationId)


# ---------------------------------------------------------------- lineage

def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints: the session's ``spark.checkpoint.dir``.

    A private folder is made only where the session names none and has no
    executors on other machines (a ``local`` master, as in tests).
    """
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        named = spark.conf.get("spark.checkpoint.dir", None)
        if not named and not re.match(r"local(\[|$)", sc.master):
            raise ValueError("spark.checkpoint.dir has to name a folder that all executors share")
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="ckpt-"))
    return sc.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and go on from the files."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def stored(df: DataFrame) -> DataFrame:
    """As ``cut`` for larger tables: compressed Parquet in the same shared folder."""
    path = f"{checkpoint_dir(df.sparkSession)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


# ---------------------------------------------------------------- columns

def without(df: DataFrame, names: list[str]) -> DataFrame:
    """``df`` less the columns whose names clash (in any case) with ``names``."""
    low = {n.lower() for n in names}
    return df.select([F.col(f"`{c}`") for c in df.columns if c.lower() not in low])


def set_aside(df: DataFrame, names: list[str]) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """``df`` with columns that clash with ``names`` under names of their own, and
    the way back to exactly its columns."""
    low = {n.lower() for n in names}
    own = {c: f"__own_{i}" if c.lower() in low else c for i, c in enumerate(df.columns)}
    renamed = df.select([F.col(f"`{c}`").alias(n) for c, n in own.items()])
    return renamed, lambda out: out.select([F.col(f"`{n}`").alias(c) for c, n in own.items()])


def lower_ascii(c: Column) -> Column:
    """A-Z to a-z; every other character stays."""
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def crc32(c: Column) -> Column:
    """Unsigned CRC-32 of a text's UTF-8 bytes; null counts as empty."""
    return F.crc32(F.coalesce(c, F.lit("")))


def rank_within(df: DataFrame, group: str, order: list[Column | str], name: str) -> DataFrame:
    """``df`` with each row's rank (from 1) in its group by ``order``.

    ``group`` is never null.  The rows are range-sorted, so a group that holds a
    third of them is spread over many partitions; a row's rank is its place in
    its partition plus the group's rows in the partitions before.
    """
    at = cut(df.repartitionByRange(group, *order).sortWithinPartitions(group, *order)).select(
        "*", F.spark_partition_id().alias("__part"), F.monotonically_increasing_id().alias("__at"))
    pieces = at.groupBy(group, "__part").agg(F.min("__at").alias("__first"), F.count("*").alias("__n"))
    earlier = Window.partitionBy(group).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    starts = pieces.select(group, "__part", (F.coalesce(F.sum("__n").over(earlier), F.lit(0)) - F.col("__first") + 1).alias("__base"))
    return at.join(starts, [group, "__part"]).withColumn(name, F.col("__at") + F.col("__base")).drop("__part", "__at", "__base")


# ---------------------------------------------------------------- Arrow text

Batches = Iterator[pa.RecordBatch]


def map_batches(df: DataFrame, run: Callable[[Batches], Batches], schema) -> DataFrame:
    """``mapInArrow`` that gives a task's free memory back to the system at its
    end: Python workers stay for later stages, beside the JVM's."""
    def runs(batches: Batches) -> Batches:
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
        if trim is not None:
            trim(0)

    return df.mapInArrow(runs, schema)


def text_bytes(arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of an Arrow text column and each row's offsets (null: empty)."""
    arr = arr.cast(pa.large_binary())
    if arr.null_count:
        arr = arr.fill_null(b"")
    off = np.frombuffer(arr.buffers()[1], np.int64)[arr.offset: arr.offset + len(arr) + 1]
    if len(arr) == 0 or off[-1] == off[0]:
        return np.empty(0, np.uint8), np.zeros(len(arr) + 1, np.int64)
    data = np.frombuffer(arr.buffers()[2], np.uint8)[off[0]:off[-1]]
    return data, off - off[0]


def steps(offsets: np.ndarray, limit: int = STEP_BYTES) -> Iterator[tuple[int, int]]:
    """Runs of rows holding about ``limit`` bytes each, at least one row."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + limit, side="right")) - 1
        j = min(n, max(i + 1, j))
        yield i, j
        i = j


def byte_table(ranges: list[tuple[int, int]]) -> np.ndarray:
    """Boolean table over byte values, true inside the inclusive ranges."""
    t = np.zeros(256, bool)
    for a, b in ranges:
        t[a:b + 1] = True
    return t


#: Word bytes of ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]`` on text with A-Z lowered.
ALNUM = byte_table([(0x30, 0x39), (0x61, 0x7A), (0x80, 0xFF)])
#: Word bytes of ``[^\x20\x09-\x0D]``.
NONSPACE = ~byte_table([(0x20, 0x20), (0x09, 0x0D)])
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


def word_spans(data: np.ndarray, offsets: np.ndarray, word: np.ndarray):
    """Words of several texts laid end to end.

    Returns the mask of word bytes, each word's start and end, and for each
    text the index of its first word (one more entry closes the last).  Bytes
    of UTF-8 continuation are word bytes in both tables, so working on bytes
    gives the same words as working on characters.
    """
    inside = word[data]
    n = len(data)
    if n == 0:
        return inside, np.empty(0, np.int64), np.empty(0, np.int64), np.zeros(len(offsets), np.int64)
    before = np.empty(n, bool)
    before[0], before[1:] = False, inside[:-1]
    after = np.empty(n, bool)
    after[-1], after[:-1] = False, inside[1:]
    first = offsets[:-1][offsets[:-1] < n]
    last = offsets[1:][offsets[1:] > 0] - 1
    before[first] = False
    after[last] = False
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    return inside, starts, ends, np.searchsorted(starts, offsets)


def word_array(data: np.ndarray, inside: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The words as an Arrow binary array."""
    off = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(ends - starts, out=off[1:])
    body = np.ascontiguousarray(data[inside])
    return pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(off), pa.py_buffer(body)])


_BYTE_CODE = np.random.default_rng(20240229).integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_POWERS = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the odd base and of its inverse modulo 2**64."""
    if len(_POWERS[0]) < n:
        size = max(n, 2 * STEP_BYTES)
        inverse = np.uint64(pow(int(_BASE), -1, 2**64))
        for k, b in enumerate((_BASE, inverse)):
            p = np.full(size, b, np.uint64)
            p[0] = 1
            _POWERS[k] = np.multiply.accumulate(p)
    return _POWERS[0], _POWERS[1]


def mix(h: np.ndarray) -> np.ndarray:
    """Spread a 64-bit value over all its bits."""
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each word's bytes (a filter: callers compare the bytes)."""
    if len(starts) == 0:
        return np.empty(0, np.uint64)
    up, down = _powers(len(data) + 1)
    total = np.empty(len(data) + 1, np.uint64)
    total[0] = 0
    np.cumsum(_BYTE_CODE[data] * up[:len(data)], out=total[1:])
    return mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def shingle_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hash of every run of ``k`` word hashes."""
    n = len(words) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    h = np.zeros(n, np.uint64)
    for j in range(k):
        h = h * _BASE + words[j:j + n]
    return mix(h)
