import hashlib
import json
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
import sentencepiece
import tokenizers

from gondola.llm import token_align as ta

SPECIAL = ["<|endoftext|>", "</s>", "<s> <unk>", "a<0x0A>b", "a▁b", "▁", "x�", "\x00", "é é ﬁ", "日本語 テキスト", "👩‍👩‍👧 family", "don't we'll I'm",
           " lead", "trail ", "  ", " ", "\n\n x\t\ty\r\n", "12345 67", "ﷺ", "a" * 500, "^" * 300, " " * 300, "x y " * 200, "Ünï " * 50, "!? ...—– “q”"]


@pytest.fixture(scope="module")
def libraries():
    a = tokenizers.Tokenizer.from_file(ta.A_PATH)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=ta.B_PATH)


def plain_tokens(libraries, text):
    """[(id, bytes)] of each side by the files' own libraries, none if the bytes differ."""
    a, b = libraries
    if not text:
        return [], []
    letters = ta._byte_letters()
    left = [(i, bytes(letters[c] for c in a.id_to_token(i))) for i in a.encode(" " + text, add_special_tokens=False).ids]
    right = [(i, bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()) for i in b.encode(text)]
    whole = (" " + text).encode()
    return (left, right) if b"".join(x for _, x in left) == whole == b"".join(x for _, x in right) else ([], [])


def plain_alignment(libraries, text):
    """Groups ([a ids], [b ids], end) and links by walking the byte offsets."""
    left, right = plain_tokens(libraries, text)
    ends = [[], []]
    for side, tokens in enumerate((left, right)):
        at = 0
        for _, x in tokens:
            at += len(x)
            ends[side].append(at)
    groups, links, i, j = [], [], 0, 0
    for end in sorted({*ends[0]} & {*ends[1]}):
        a, b = [], []
        while i < len(left) and ends[0][i] <= end:
            a.append(left[i][0])
            i += 1
        while j < len(right) and ends[1][j] <= end:
            b.append(right[j][0])
            j += 1
        groups.append((a, b, end))
    for p, x in enumerate(ends[0]):
        links += [(left[p][0], right[q][0]) for q, y in enumerate(ends[1]) if x == y] if len(ends[1]) < 200 else []
    if len(ends[1]) >= 200:
        at = {y: q for q, y in enumerate(ends[1])}
        links = [(left[p][0], right[at[x]][0]) for p, x in enumerate(ends[0]) if x in at]
    return groups, links, (len(left), len(right))


def plain_rows(libraries, texts):
    done = [plain_alignment(libraries, t) for t in texts]
    count = Counter(x for _, links, _ in done for x in links)
    best = defaultdict(int)
    for (_, b), n in count.items():
        best[b] = max(best[b], n)
    rows = []
    for groups, links, (n_a, n_b) in done:
        written = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b, _ in groups)
        rows.append((n_a, n_b, len(groups), len(links), sum(count[x] == best[x[1]] for x in links), sum(count[x] for x in links),
                     hashlib.sha256(written.encode()).hexdigest() if n_a else ""))
    return rows


COLUMNS = [*ta.NUMBERS, "n_best", "count_sum", "groups_sha256"]


@pytest.mark.parametrize("limit,top", [(ta.STEP_BYTES, ta.TOP_PAIRS), (300, 5), (1, 40)])
def test_query_against_plain_version(spark, libraries, documents, tmp_dir, limit, top):
    """Whole steps; chunks and a shuffle of all but a few pairs; a chunk a word."""
    texts = SPECIAL + [None, ""] + [t for _, t, *_ in documents]
    texts += [texts[40]] * 3
    rows = [(i, t) for i, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_dir}/documents.parquet")
    got = {r["doc_id"]: tuple(r[c] for c in COLUMNS) for r in ta.query(spark, tmp_dir, limit, top).collect()}
    expected = dict(enumerate(plain_rows(libraries, texts)))
    assert got == expected
    assert expected[4] == (0, 0, 0, 0, 0, 0, "") and expected[0][0] > 1


def test_all_outputs(spark, libraries):
    texts = SPECIAL + [None]
    docs = spark.createDataFrame([(i, t, "n", 7) for i, t in enumerate(texts)], "doc_id long, text string, N_A string, pairs int")
    for limit in (ta.STEP_BYTES, 50):
        out = ta.align(docs, limit=limit)
        assert out.columns == ["doc_id", *ta.NUMBERS, *ta.OUTPUTS]
        for r in out.collect():
            groups, links, _ = plain_alignment(libraries, texts[r["doc_id"]])
            left, right = plain_tokens(libraries, texts[r["doc_id"]] or "")
            assert r["a_ids"] == [i for i, _ in left] and r["b_ids"] == [i for i, _ in right]
            assert list(zip(r["group_a"], r["group_b"], r["group_end"])) == [(len(a), len(b), e) for a, b, e in groups]
            codes = Counter(a * 32000 + b for a, b in links)
            assert dict(zip(r["pairs"], r["pair_n"])) == codes
            spans = [np.cumsum([0, *(len(x) for _, x in s)]) for s in (left, right)]
            shared = {(i, j) for i in range(len(left)) for j in range(len(right))
                      if min(spans[0][i + 1], spans[1][j + 1]) > max(spans[0][i], spans[1][j])} if len(left) < 150 else None
            got = [(x["a"], x["b"]) for x in r["overlaps"]]
            assert len(got) == len(set(got)) == (len(left) + len(right) - len(groups))
            assert shared is None or set(got) == shared


def test_coalescing_of_random_cuts():
    rng = random.Random(3)
    for _ in range(200):
        n = rng.randrange(1, 40)
        cuts = [sorted({0, n, *(rng.randrange(n + 1) for _ in range(rng.randrange(10)))}) for _ in range(2)]
        spans = [np.array(x) for c in cuts for x in (c[:-1], c[1:])]
        a, b = ta.coalesce(*spans)
        common = sorted(set(cuts[0][1:]) & set(cuts[1][1:]))
        assert a.tolist() == [sum(e < end for e in common) for end in cuts[0][1:]]
        assert b.tolist() == [sum(e < end for e in common) for end in cuts[1][1:]]
        x, y = ta.overlaps(*spans)
        assert set(zip(x.tolist(), y.tolist())) == {(i, j) for i in range(len(cuts[0]) - 1) for j in range(len(cuts[1]) - 1)
                                                   if min(cuts[0][i + 1], cuts[1][j + 1]) > max(cuts[0][i], cuts[1][j])}


def test_chunks_keep_the_text():
    text = "one two, three\nfour 5 six  seven! Eight é nine"
    for limit in range(1, 20):
        assert " ".join(ta.chunks(text, limit)) == text
    assert ta.chunks("x" * 50, 10) == ["x" * 50] and ta.chunks("", 5) == [""]


def test_both_ways_of_encoding_agree(documents):
    with open(ta.A_PATH, encoding="utf-8") as f:
        spec = f.read()
    other = json.loads(spec)
    other["model"]["dropout"] = 0.0
    other["normalizer"] = {"type": "Sequence", "normalizers": []}  # not plain: the file's own library encodes
    fast, slow = ta.ByteTokenizer(spec), ta.ByteTokenizer(json.dumps(other))
    assert type(fast.ids) is not type(slow.ids) and fast.bytes == slow.bytes
    for text in SPECIAL + [t or "" for _, t, *_ in documents]:
        assert list(fast.ids(" " + text)) == list(slow.ids(" " + text))


def test_very_long_text_and_empty_table(spark, libraries):
    rng = random.Random(4)
    words = ["the", "of", "Zürich", "tokenization", "x1", "don't", "日本", "—"]
    text = " ".join(rng.choice(words) for _ in range(300_000)) + " " + "q" * 200_000
    docs = spark.createDataFrame([(1, text), (1, text)], "doc_id long, text string")
    aligned = ta.align(docs, ["pairs", "pair_n", "groups_sha256"])
    got = ta.score_links(aligned, ta.link_counts(aligned)).collect()
    assert [tuple(r[c] for c in COLUMNS) for r in got] == plain_rows(libraries, [text, text])
    none = ta.align(docs.limit(0), ["pairs", "pair_n"])
    assert ta.score_links(none, ta.link_counts(none)).count() == 0
