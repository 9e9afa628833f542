import random
import re
from itertools import permutations

import numpy as np
import pytest

from gondola.llm import filter_audit as fa

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_counts(text):
    t = text or ""
    w = WORD.findall(t)
    return len(w), len(set(w)), len(re.findall("[A-Z]", t)), len(t), len(re.findall(r"[#$%&*|]", t))


def plain_audit(docs, labels):
    """Each order applied filter by filter to the documents (doc_id, text, source)."""
    rows = []
    for doc, text, source in docs:
        n, distinct, capitals, chars, symbols = plain_counts(text)
        copy = doc is not None and any(d is not None and d < doc and (t or "") == (text or "") for d, t, _ in docs)
        fails = {x for x, f in zip("ABCDE", (n < 50, 100 * distinct < 65 * n, 100 * capitals > 5 * chars, symbols > 0, copy)) if f}
        mine = [x for x in labels if doc is not None and x[0] == doc]
        rows.append((source or "", fails, any(q == 1 for _, q, _ in mine), any(t == 1 for *_, t in mine)))
    out = {}
    for part in {r[0] for r in rows}:
        lost = dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            left = [r for r in rows if r[0] == part]
            gone = []
            for step, x in enumerate(order, 1):
                here = [r for r in left if x in r[1]]
                out[part, "".join(order), step] = [
                    len(left) - len(here), len(here), sum(x in r[1] for r in gone), sum(r[0] == part and r[1] == {x} for r in rows),
                    sum(r[2] for r in here), sum(r[3] for r in here)]
                left, gone = [r for r in left if x not in r[1]], gone + here
                lost[x] += len(here)
        for order in permutations("ABCDE"):
            for step, x in enumerate(order, 1):
                out[part, "".join(order), step].append(lost[x])
    return out


def audited(spark, docs, labels):
    d = spark.createDataFrame(docs, "doc_id long, text string, source string")
    got = fa.audit(d, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    columns = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    rows = got.collect()
    assert len({(r["part"], r["filter_order"], r["step"]) for r in rows}) == len(rows)
    return {(r["part"], r["filter_order"], r["step"]): [r[c] for c in columns] for r in rows}


def mixed_text(rng, n):
    parts = ["a", "B", "ab", "Ünïcode", "日本", "𝒳𝒴", "#", "x$y", "|", " ", " q", "CAPS", "w%d" % rng.randrange(40)]
    return "".join(rng.choice(parts) + rng.choice([" ", "\t", "\n", "\x0b", "  ", "\r\n", ""]) for _ in range(n))


def test_counts_against_plain_python(spark):
    rng = random.Random(5)
    texts = [mixed_text(rng, rng.randrange(120)) for _ in range(60)] + [None, "", " ", "\n", "a", " a ", "A", "é", "\x00", "\x1c\x85"]
    docs = spark.createDataFrame([(i, t, i * 2) for i, t in enumerate(texts)], "doc_id long, text string, N_WORDS int")
    for limit in (1 << 20, 40, 1):  # whole steps, texts in blocks, one word at a time
        got = {r["doc_id"]: tuple(r[c] for c in fa.COUNTS) for r in fa.text_counts(docs, limit).collect()}
        assert got == {i: plain_counts(t) for i, t in enumerate(texts)}


def test_very_long_text(spark):
    rng = random.Random(6)
    text = " ".join(f"w{rng.randrange(30_000)}" + "Q" * (rng.random() < 0.1) for _ in range(400_000)) + " " + "x" * 3_000_000
    got = fa.text_counts(spark.createDataFrame([(1, text)], "doc_id long, text string")).collect()
    assert tuple(got[0][c] for c in fa.COUNTS) == plain_counts(text)


def test_hash_table_verifies_bytes(monkeypatch):
    """With one hash for all words only the comparison of bytes tells them apart."""
    rng = random.Random(7)
    texts = [" ".join(rng.choice(["a", "b", "ab", "ba", "abcdefgh", "abcdefgi", "abcdefghij", "abcdefghik"]) for _ in range(60)) for _ in range(3)]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    offsets = np.cumsum([0, *map(len, texts)])
    expected = fa._count(data, offsets)[0]
    assert expected[1].tolist() == [len(set(t.split())) for t in texts]
    monkeypatch.setattr(fa, "mix", lambda h: np.zeros(len(h), np.uint64))
    assert (fa._count(data, offsets)[0] == expected).all()


def long_text(rng, n, words):
    return " ".join(f"w{rng.randrange(words)}" for _ in range(n))


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(8)
    base = [long_text(rng, 60, 1000), long_text(rng, 60, 5), long_text(rng, 10, 100), "UP " * 60, "a#b " + long_text(rng, 70, 1000), "", None, "   "]
    docs = [(i, rng.choice(base), rng.choice(["s0", "s0", "s1", None, ""])) for i in range(60)]
    docs += [(3, docs[3][1], "s1"), docs[3], (None, base[0], "s0"), (None, base[0], "s0"), (-5, "fresh", "só")]
    labels = [(i, i % 2, int(i % 3 == 0)) for i in range(0, 60, 2)] + [(3, 0, 0), (3, 1, None), (None, 1, 1), (999, 1, 1)]
    return docs, labels


def test_against_plain_version(spark, corpus):
    docs, labels = corpus
    assert audited(spark, docs, labels) == plain_audit(docs, labels)


def test_on_documents(spark, documents):
    docs = [(d, t, s) for d, t, _, s, _ in documents]
    labels = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/labels.parquet").select("doc_id", "quality", "toxic").collect()]
    assert audited(spark, docs, labels) == plain_audit(docs, labels)


def test_empty_tables_and_other_filters(spark):
    docs = spark.createDataFrame([(1, "a b", "s"), (2, "a#b", "s"), (3, "a b", "s")], "doc_id long, text string, source string")
    labels = spark.createDataFrame([(1, 1, 1)], "doc_id long, quality int, toxic int")
    assert fa.audit(docs.limit(0), labels).count() == 0
    none = fa.audit(docs, labels.limit(0))
    assert none.count() == 600 and none.selectExpr("max(good_lost + toxic_lost)").first()[0] == 0
    two = fa.audit(docs, labels, {"X": "n_symbols > 0", "Y": "n_words < 3"})
    assert {(r["filter_order"], r["step"]): (r["kept"], r["removed"], r["shapley"]) for r in two.collect()} == {
        ("XY", 1): (2, 1, 1), ("XY", 2): (0, 2, 5), ("YX", 1): (0, 3, 5), ("YX", 2): (0, 0, 1)}
    clash = docs.selectExpr("doc_id", "text", "source", "1 AS part", "2 AS n", "3 AS digest", "4 AS copy", "5 AS N_CHARS")
    assert fa.audit(clash, labels).count() == 600
