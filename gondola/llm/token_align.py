"""Cross-tokenizer alignment by interval coalescing.

Two tokenizers cut the same bytes (a space and the text): A, a byte-level BPE
given by a tokenizer JSON file, and B, a piece model that puts the space there
itself.  All tokens of A and B are sorted by start; the running maximum of their
ends is taken, and a group ends where the next start reaches it, which is where
tokens of both end together.  Within a group every A token is expanded to the B
tokens that it overlaps; an overlap is a *link* where both tokens end together.

Links are counted over the corpus in a second step.  The most frequent pairs
(``TOP_PAIRS`` at most) are sent to the tasks, all others are joined by a
shuffle, where a pair is rare.

Texts are encoded in chunks that end before a space between an ASCII sign and an
ASCII letter.  Neither tokenizer joins anything across it, so a long text is
never held as one list of tokens and a chunk's groups are the text's.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import STEP_BYTES, cut, map_batches, ship, stored, without

A_PATH = "/opt/tokenizers/byte_bpe_50k.json"
B_PATH = "/opt/tokenizers/piece_bpe_32k.model"
#: Pairs whose counts are sent to the tasks at most (17 bytes each).
TOP_PAIRS = 1 << 18
#: Distinct pairs that a task holds while counting; more are passed on in parts.
HELD_PAIRS = 1 << 20

# FIXED VALUE: how a byte-level tokenizer that uses its pattern cuts a text into words.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


# ---------------------------------------------------------------- tokenizers

def _byte_letters() -> dict[str, int]:
    """Byte-level letters: a visible Latin-1 character stands for its own byte,
    the other bytes in turn for the characters from U+0100 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in own]
    return {**{chr(b): b for b in own}, **{chr(0x100 + i): b for i, b in enumerate(rest)}}


class ByteTokenizer:
    """A: ids of a text and the bytes of each id.

    Where the merges are ranked by id and the words are cut by the usual pattern
    alone, the faster of two installed libraries encodes the same vocabulary;
    else the one that reads the file itself.
    """

    def __init__(self, spec: str):
        d = json.loads(spec)
        letters, model = _byte_letters(), d["model"]
        special = {t["content"] for t in d["added_tokens"]}
        ranks = {bytes(letters[c] for c in t): i for t, i in model["vocab"].items() if t not in special}
        merged = [model["vocab"]["".join(m if isinstance(m, list) else m.split(" "))] for m in model["merges"]]
        pre = d["pre_tokenizer"] or {}
        plain = (all(a < b for a, b in zip(merged, merged[1:])) and all(ranks.get(bytes([b]), len(ranks)) < min(merged) for b in range(256))
                 and not d["normalizer"] and pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space")
                 and not model.get("ignore_merges") and not model.get("dropout"))
        self.bytes: list[bytes] = [b""] * (max(model["vocab"].values()) + 1)
        for b, i in ranks.items():
            self.bytes[i] = b
        if plain:
            import tiktoken
            self.ids = tiktoken.Encoding("a", pat_str=WORDS, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        else:
            import tokenizers
            whole = tokenizers.Tokenizer.from_str(spec)
            whole.encode_special_tokens = True  # their strings in a text are plain text
            self.ids = lambda text: whole.encode(text, add_special_tokens=False).ids


class PieceTokenizer:
    """B: ids of a text and the bytes of each id (U+2581 is a space)."""

    def __init__(self, spec: bytes):
        import sentencepiece
        self._model = sentencepiece.SentencePieceProcessor(model_proto=spec)
        pieces = [self._model.id_to_piece(i) for i in range(self._model.vocab_size())]
        self.bytes = [bytes([int(p[3:5], 16)]) if self._model.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        #: no piece holds a space after anything else, so words are encoded on their own
        self.splits = not any("▁" in p.lstrip("▁") for p in pieces)

    def ids(self, texts: list[str]) -> list[list[int]]:
        return self._model.encode(texts, num_threads=1)


class Pair:
    """Both tokenizers with what the alignment needs of their vocabularies."""

    def __init__(self, a: str, b: bytes):
        self.a, self.b = ByteTokenizer(a), PieceTokenizer(b)
        self.a_lens, self.b_lens = (np.array([len(x) for x in t.bytes], np.int64) for t in (self.a, self.b))
        n = max(len(self.a.bytes), len(self.b.bytes))
        width = len(str(n)) + 1
        digits = np.zeros((n, width), np.uint8)
        for i in range(n):
            digits[i, :len(str(i))] = list(str(i).encode())
        # a row for each separator and id: digits, separator, zeros
        self.written = np.repeat(digits[None], 3, 0)
        at = np.argmin(digits, 1)
        for k, sign in enumerate(b",|;"):
            self.written[k, np.arange(n), at] = sign

    def encode(self, texts: list[str]) -> tuple[list, list]:
        """Ids of each text by A and by B, None for both where their bytes differ from space and text."""
        own, other = [self.a.ids(" " + x) for x in texts], self.b.ids(texts)
        for i, x in enumerate(texts):
            whole = b" " + x.encode()
            if not (whole == b"".join(map(self.a.bytes.__getitem__, own[i])) == b"".join(map(self.b.bytes.__getitem__, other[i]))):
                own[i] = other[i] = None
        return own, other


@lru_cache(maxsize=1)
def _loaded(a: str, b: bytes) -> Pair:
    return Pair(a, b)


# ---------------------------------------------------------------- alignment

def coalesce(a_start, a_end, b_start, b_end) -> tuple[np.ndarray, np.ndarray]:
    """Group numbers of the A and of the B intervals."""
    start, end = np.concatenate([a_start, b_start]), np.concatenate([a_end, b_end])
    order = np.lexsort((end, start))
    reached = np.maximum.accumulate(end[order])
    breaks = np.zeros(len(order), np.int64)
    breaks[1:] = start[order][1:] >= reached[:-1]
    group = np.empty(len(order), np.int64)
    group[order] = np.cumsum(breaks)
    return group[:len(a_start)], group[len(a_start):]


def overlaps(a_start, a_end, b_start, b_end) -> tuple[np.ndarray, np.ndarray]:
    """Positions of all pairs of an A and a B interval that share a byte
    (each side's intervals lie in order, without gaps or overlaps)."""
    low, high = np.searchsorted(b_end, a_start, "right"), np.searchsorted(b_start, a_end, "left")
    n = high - low
    first = np.cumsum(n) - n
    a = np.repeat(np.arange(len(n)), n)
    return a, np.arange(len(a)) - first[a] + low[a]


class Aligned:
    """Groups, overlaps and links of several texts laid end to end."""

    def __init__(self, pair: Pair, own: list, other: list):
        self.pair = pair
        self.a_first, self.b_first = (np.cumsum([0, *map(len, ids)]) for ids in (own, other))
        self.a, self.b = (np.array([i for ids in side for i in ids], np.int64) for side in (own, other))
        self.a_end, self.b_end = np.cumsum(pair.a_lens[self.a]), np.cumsum(pair.b_lens[self.b])
        spans = self.a_end - pair.a_lens[self.a], self.a_end, self.b_end - pair.b_lens[self.b], self.b_end
        self.a_group, self.b_group = coalesce(*spans)
        self.a_at, self.b_at = overlaps(*spans)
        linked = self.a_end[self.a_at] == self.b_end[self.b_at]
        self.link_a, self.link_b = self.a_at[linked], self.b_at[linked]

    def group_firsts(self) -> np.ndarray:
        """Number of groups before each text, one more entry at the end."""
        n = int(self.a_group[-1]) + 1 if len(self.a_group) else 0
        return np.append(self.a_group, n)[self.a_first]

    def write(self) -> tuple[bytes, np.ndarray]:
        """``a1,a2|b1;a3|b2,b3;`` for all texts, and where each text begins."""
        n = int(self.a_group[-1]) + 1 if len(self.a_group) else 0
        a_of, b_of = np.bincount(self.a_group, minlength=n), np.bincount(self.b_group, minlength=n)
        a_to = np.arange(len(self.a)) + (np.cumsum(b_of) - b_of)[self.a_group]
        b_to = np.arange(len(self.b)) + np.cumsum(a_of)[self.b_group]
        ids, signs = (np.zeros(len(self.a) + len(self.b), np.int64) for _ in range(2))
        ids[a_to], ids[b_to] = self.a, self.b
        signs[a_to[np.cumsum(a_of) - 1]], signs[b_to[np.cumsum(b_of) - 1]] = 1, 2
        rows = self.pair.written[signs, ids]
        lens = np.concatenate([[0], np.cumsum((rows != 0).sum(1))])
        return rows[rows != 0].tobytes(), lens[self.a_first + self.b_first]

    def pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, pair code, times) of the linked id pairs, by text and code."""
        text = np.searchsorted(self.a_first, self.link_a, "right") - 1
        codes = len(self.pair.b.bytes)
        every = len(self.pair.a.bytes) * codes
        found, times = np.unique(text * every + self.a[self.link_a] * codes + self.b[self.link_b], return_counts=True)
        return found // every, found % every, times


def chunks(text: str, limit: int) -> list[str]:
    """The text cut before spaces that both tokenizers cut at, into pieces of
    ``limit`` characters or the next such space; the space itself is left out."""
    out, at = [], 0
    border = re.compile(r"(?<=[!-~]) (?=[A-Za-z])")
    while len(text) - at > limit:
        space = border.search(text, at + limit)
        if not space:
            break
        out.append(text[at:space.start()])
        at = space.end()
    return [*out, text[at:]]


NUMBERS = ["n_a", "n_b", "n_groups", "n_links"]
#: What ``align`` can give besides, with its type.
OUTPUTS = {
    "a_ids": "array<int>", "b_ids": "array<int>",           # tokens in order
    "group_a": "array<int>", "group_b": "array<int>",       # tokens of each group
    "group_end": "array<bigint>",                           # byte at which it ends in space and text
    "overlaps": "array<struct<a:int,b:int>>",               # positions of overlapping tokens
    "pairs": "array<bigint>", "pair_n": "array<int>",       # linked id pairs (A id * size of B + B id) and how often
    "groups_sha256": "string",                              # digest of a1,a2|b1;a3|b2,b3
}


class _Text:
    """What the chunks of one text add up to."""

    def __init__(self, outputs: Sequence[str]):
        self.numbers, self.bytes, self.digest = np.zeros(4, np.int64), 0, hashlib.sha256()
        self.parts: dict[str, list[np.ndarray]] = {c: [] for c in outputs}

    def add(self, al: Aligned, i: int, links: np.ndarray, groups: np.ndarray, text: bytes, pairs: tuple) -> None:
        a, b = slice(*al.a_first[i:i + 2]), slice(*al.b_first[i:i + 2])
        if self.numbers[0]:
            self.digest.update(b";")
        self.digest.update(text)
        if "a_ids" in self.parts:
            self.parts["a_ids"].append(al.a[a])
            self.parts["b_ids"].append(al.b[b])
        if "group_a" in self.parts:
            n = groups[i + 1] - groups[i]
            last = al.a_first[i] + np.cumsum(own := np.bincount(al.a_group[a] - groups[i], minlength=n)) - 1
            self.parts["group_a"].append(own)
            self.parts["group_b"].append(np.bincount(al.b_group[b] - groups[i], minlength=n))
            self.parts["group_end"].append(al.a_end[last] - (al.a_end[a.start - 1] if a.start else 0) + self.bytes)
        if "overlaps" in self.parts:
            at = slice(*np.searchsorted(al.a_at, [a.start, a.stop]))
            self.parts["overlaps"].append(np.stack([al.a_at[at] - a.start + self.numbers[0], al.b_at[at] - b.start + self.numbers[1]], 1))
        if "pairs" in self.parts:
            self.parts["pairs"].append(pairs[0])
            self.parts["pair_n"].append(pairs[1])
        self.bytes += int(al.a_end[a.stop - 1] - (al.a_end[a.start - 1] if a.start else 0)) if a.stop > a.start else 0
        self.numbers += [a.stop - a.start, b.stop - b.start, groups[i + 1] - groups[i], links[i]]

    def result(self, column: str):
        if column == "groups_sha256":
            return self.digest.hexdigest() if self.numbers[0] else ""
        if column in ("pairs", "pair_n") and len(self.parts["pairs"]) > 1:
            codes, where = np.unique(np.concatenate(self.parts["pairs"]), return_inverse=True)
            self.parts["pair_n"] = [np.bincount(where, np.concatenate(self.parts["pair_n"])).astype(np.int64)]
            self.parts["pairs"] = [codes]
        whole = np.concatenate(self.parts[column]) if self.parts[column] else np.empty(0, np.int64)
        return [{"a": int(x), "b": int(y)} for x, y in whole] if column == "overlaps" else whole


def _align_texts(pair: Pair, texts: list[str | None], outputs: Sequence[str], limit: int) -> list[_Text]:
    done = [_Text(outputs) for _ in texts]
    queue: list[tuple[int, str]] = []

    def run() -> None:
        own, other = pair.encode([c for _, c in queue])
        bad = {t for (t, _), ids in zip(queue, own) if ids is None}
        for t in bad:
            done[t] = None
        good = [k for k, (t, _) in enumerate(queue) if done[t] is not None]
        al = Aligned(pair, [own[k] for k in good], [other[k] for k in good])
        links = np.bincount(np.searchsorted(al.a_first, al.link_a, "right") - 1, minlength=len(good))
        groups = al.group_firsts()
        body, begins = al.write() if "groups_sha256" in outputs and good else (b"", np.zeros(len(good) + 1, np.int64))
        text, codes, times = al.pairs() if "pairs" in outputs else (np.empty(0, np.int64),) * 3
        firsts = np.searchsorted(text, np.arange(len(good) + 1))
        for i, k in enumerate(good):
            p = slice(firsts[i], firsts[i + 1])
            done[queue[k][0]].add(al, i, links, groups, body[begins[i]:max(begins[i], begins[i + 1] - 1)], (codes[p], times[p]))
        queue.clear()

    held = 0
    for t, text in enumerate(texts):
        for chunk in chunks(text, limit) if text and pair.b.splits else [text] if text else []:
            if done[t] is None:
                break
            queue.append((t, chunk))
            held += len(chunk)
            if held >= limit:
                run()
                held = 0
    if queue:
        run()
    return [x or _Text(outputs) for x in done]


def align(docs: DataFrame, outputs: Sequence[str] = tuple(OUTPUTS), a_path: str = A_PATH, b_path: str = B_PATH,
          limit: int = STEP_BYTES) -> DataFrame:
    """``docs`` less ``text``, with the ``NUMBERS`` of its alignment and the ``OUTPUTS`` asked for.

    A null or empty text, and one whose joined A or B bytes differ from space and
    text (U+2581 is such a character), has no tokens: zeros, empty lists and an
    empty digest.  Strings of special tokens are plain text.  Very long texts are
    taken in chunks of ``limit`` characters; repeated rows stay repeated; an empty
    table gives an empty one.  Incoming columns named like the added ones are
    replaced.  The driver reads the two tokenizer files and sends them to the tasks.
    """
    spark = docs.sparkSession
    ship(spark)
    docs = without(docs, [*NUMBERS, *OUTPUTS])
    names = [c for c in docs.columns if c != "text"]
    outputs = [c for c in OUTPUTS if c in outputs]
    schema = T.StructType([docs.schema[c] for c in names] + [T.StructField(c, T.LongType()) for c in NUMBERS]
                          + [T.StructField(c, T._parse_datatype_string(OUTPUTS[c])) for c in outputs])
    with open(a_path, encoding="utf-8") as a, open(b_path, "rb") as b:
        files = spark.sparkContext.broadcast((a.read(), b.read()))
    asked = {*outputs, *(["pairs", "pair_n"] if {"pairs", "pair_n"} & {*outputs} else []),
             *(["group_a", "group_b", "group_end"] if {"group_a", "group_b", "group_end"} & {*outputs} else []),
             *(["a_ids", "b_ids"] if {"a_ids", "b_ids"} & {*outputs} else [])}

    def texts_of(column: pa.Array) -> list[str | None]:
        out = []
        for x in column.cast(pa.large_binary()).to_pylist():
            try:
                out.append(x.decode() if x else None)
            except UnicodeDecodeError:
                out.append(None)  # no tokenizer gives its bytes back
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = _loaded(*files.value)
        kinds = {"array<int>": pa.list_(pa.int32()), "array<bigint>": pa.list_(pa.int64()), "string": pa.string(),
                 "array<struct<a:int,b:int>>": pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())]))}
        for batch in batches:
            found = _align_texts(pair, texts_of(batch.column(len(names))), asked, limit)
            numbers = np.stack([x.numbers for x in found]) if found else np.zeros((0, 4), np.int64)
            yield pa.RecordBatch.from_arrays(
                batch.columns[:len(names)] + [pa.array(numbers[:, k]) for k in range(4)]
                + [pa.array([x.result(c) for x in found], kinds[OUTPUTS[c]]) for c in outputs], names=schema.names)

    return map_batches(docs.select(*[F.col(f"`{c}`") for c in names], "text"), run, schema)


# ---------------------------------------------------------------- corpus counts

def _b_size(b_path: str) -> int:
    with open(b_path, "rb") as b:
        return len(PieceTokenizer(b.read()).bytes)


def link_counts(aligned: DataFrame, b_path: str = B_PATH, held: int = HELD_PAIRS) -> DataFrame:
    """(pair, n, best) from columns ``pairs`` and ``pair_n``: links of the whole
    table that hold the id pair, and whether its B id has no pair with more."""
    ship(aligned.sparkSession)

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, sums = np.empty(0, np.int64), np.empty(0, np.int64)
        for batch in batches:
            more, times = (c.flatten().to_numpy(zero_copy_only=False) for c in batch.columns)
            codes, where = np.unique(np.concatenate([codes, more]), return_inverse=True)
            sums = np.bincount(where, np.concatenate([sums, times]), len(codes)).astype(np.int64)
            if len(codes) > held:
                yield pa.RecordBatch.from_arrays([pa.array(codes), pa.array(sums)], names=["pair", "n"])
                codes, sums = np.empty(0, np.int64), np.empty(0, np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(codes), pa.array(sums)], names=["pair", "n"])

    counts = map_batches(aligned.select("pairs", "pair_n"), total, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    counts = cut(counts.withColumn("b", F.col("pair") % _b_size(b_path)))
    most = counts.groupBy("b").agg(F.max("n").alias("most"))
    return counts.join(most, "b").select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def score_links(aligned: DataFrame, counts: DataFrame, top: int = TOP_PAIRS) -> DataFrame:
    """``aligned`` less ``pairs`` and ``pair_n``, with n_best (links whose pair is
    its B id's most frequent, ties included) and count_sum (the links' counts)."""
    spark = aligned.sparkSession
    ship(spark)
    counts = cut(counts)
    known = counts.orderBy(F.desc("n"), "pair").limit(top).collect()  # top rows at most
    known.sort()
    table = spark.sparkContext.broadcast((np.array([r["pair"] for r in known], np.int64), np.array([r["n"] for r in known], np.int64),
                                          np.array([r["best"] for r in known], bool)))
    names = [c for c in without(aligned, ["n_best", "count_sum"]).columns if c not in ("pairs", "pair_n")]
    rows = aligned.select(*[F.col(f"`{c}`") for c in names], "pairs", "pair_n")
    rare = T._parse_datatype_string("array<struct<pair:long,times:int>>")
    schema = T.StructType([rows.schema[c] for c in names] + [T.StructField("n_best", T.LongType()), T.StructField("count_sum", T.LongType()),
                                                            T.StructField("__rare", rare)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, n, best = table.value
        kind = pa.list_(pa.struct([("pair", pa.int64()), ("times", pa.int32())]))
        for batch in batches:
            lists, times = batch.column(len(names)), batch.column(len(names) + 1).flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            pairs = lists.flatten().to_numpy(zero_copy_only=False)
            row = np.repeat(np.arange(batch.num_rows), lists.value_lengths().to_numpy(zero_copy_only=False))
            at = np.minimum(np.searchsorted(codes, pairs), max(0, len(codes) - 1))
            hit = codes[at] == pairs if len(codes) else np.zeros(len(pairs), bool)
            sums = [np.zeros(batch.num_rows, np.int64) for _ in range(2)]
            np.add.at(sums[0], row[hit], times[hit] * best[at[hit]])
            np.add.at(sums[1], row[hit], times[hit] * n[at[hit]])
            left: list[list] = [[] for _ in range(batch.num_rows)]
            for r, p, t in zip(row[~hit].tolist(), pairs[~hit].tolist(), times[~hit].tolist()):
                left[r].append({"pair": p, "times": t})
            yield pa.RecordBatch.from_arrays(batch.columns[:len(names)] + [pa.array(s) for s in sums] + [pa.array(left, kind)], names=schema.names)

    scored = map_batches(rows, run, schema)
    if len(known) < top:
        return scored.drop("__rare")
    scored = stored(scored.withColumn("__row", F.monotonically_increasing_id()))
    others = (scored.select("__row", F.explode("__rare").alias("x")).select("__row", "x.pair", "x.times").join(counts, "pair")
              .groupBy("__row").agg(F.sum(F.col("times") * F.col("best").cast("int")).alias("__best"), F.sum(F.col("times") * F.col("n")).alias("__sum")))
    whole = scored.join(others, "__row", "left")
    return whole.select(*[F.col(f"`{c}`") for c in names], (F.col("n_best") + F.coalesce("__best", F.lit(0))).alias("n_best"),
                        (F.col("count_sum") + F.coalesce("__sum", F.lit(0))).alias("count_sum"))


# ---------------------------------------------------------------- query

def query(spark, sf_dir: str, limit: int = STEP_BYTES, top: int = TOP_PAIRS) -> DataFrame:
    """Contract form: one row per document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    aligned = stored(align(docs, ["pairs", "pair_n", "groups_sha256"], limit=limit))
    scored = score_links(aligned, link_counts(aligned), top)
    return scored.select("doc_id", *NUMBERS, "n_best", "count_sum", "groups_sha256")
