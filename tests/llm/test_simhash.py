import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from gondola.llm import simhash
from gondola.llm.components import connected_components, local_labels

from . import brute
from .conftest import SF


def test_fingerprints_match_brute_force():
    for text in ["", "  \n", "one", "Two words", "a b c", "A  B\tc d", "é à ü ñ É", "x " * 3000, "the cat sat on the mat " * 9]:
        assert simhash.fingerprint(text.encode()) == brute.fingerprint(text)


def test_gray_rank_orders_by_single_bit_steps():
    ranks = simhash.gray_rank(np.arange(256, dtype=np.uint64))
    by_rank = np.argsort(ranks)
    steps = np.bitwise_count(by_rank[1:].astype(np.uint64) ^ by_rank[:-1].astype(np.uint64))
    assert sorted(ranks) == list(range(256)) and (steps == 1).all()


def clustered_codes(n, seed):
    rng = random.Random(seed)
    out = set()
    while len(out) < n:
        x = rng.getrandbits(64)
        for _ in range(rng.randint(1, 6)):
            out.add(x)
            for _ in range(rng.randint(0, 3)):
                x ^= 1 << rng.randrange(64)
    return sorted(out)


@pytest.mark.parametrize("n", [1, 2, 15, 17, 300, 900])
def test_index_finds_exactly_the_pairs_within_distance(n):
    codes = np.array(clustered_codes(n, n), np.uint64)
    index = simhash.GrayIndex(codes)
    got = {(int(codes[i]), int(index.codes[j])) for q, c in index.search(codes, 2) for i, j in zip(q, c)}
    near = np.bitwise_count(codes[:, None] ^ codes[None, :]) <= 2
    assert got == {(int(codes[i]), int(codes[j])) for i, j in zip(*np.nonzero(near))}


def test_blocks_and_dealt_queries_lose_no_link(spark):
    codes = clustered_codes(700, 5)
    df = spark.createDataFrame([(int(np.uint64(c).astype(np.int64)),) for c in codes], "fp long")
    expected = brute.components({c: c for c in codes})
    for kw in ({}, {"block": 40}, {"block": 100, "max_blocks": 3, "task_codes": 50}):
        labels = {r["node"] % 2**64: r["label"] for r in connected_components(simhash.fingerprint_links(df, **kw)).collect()}
        groups = {}
        for c in codes:
            groups.setdefault(labels.get(c, ("alone", c)), set()).add(c)
        want = {}
        for c in codes:
            want.setdefault(expected[c], set()).add(c)
        assert sorted(map(sorted, groups.values())) == sorted(map(sorted, want.values()))


def test_components_of_a_long_chain_and_a_star(spark):
    links = [(i, i + 1) for i in range(0, 200)] + [(1000, 1000 + k) for k in range(1, 60)] + [(5, 5)]
    got = {r["node"]: r["label"] for r in connected_components(spark.createDataFrame(links, "u long, v long")).collect()}
    assert got == {**{i: 0 for i in range(201)}, **{1000 + k: 1000 for k in range(60)}}
    nodes, labels = local_labels(np.array([3, 9, 4]), np.array([4, 8, 1]))
    assert dict(zip(nodes.tolist(), labels.tolist())) == {1: 1, 3: 1, 4: 1, 8: 8, 9: 8}


def test_query_on_the_smallest_scale(spark, documents):
    fps = {d[0]: brute.fingerprint(d[1]) for d in documents}
    comp = brute.components(fps)
    rows = {r["doc_id"]: tuple(r) for r in simhash.query(spark, SF).collect()}
    assert rows == {k: (k, f"{fps[k]:016x}", comp[k]) for k in fps}


def test_nulls_copies_and_empty_tables(spark, make_docs):
    docs = make_docs([(5, None), (3, ""), (9, "a b c d"), (9, "a b c d"), (2, "a b c d"), (None, "a b c d"), (None, "only without id"), (7, "q " * 4000)])
    rows = simhash.near_duplicates(docs).collect()
    assert len(rows) == 8
    got = sorted(((r["doc_id"], r["component_id"]) for r in rows), key=repr)
    assert got == sorted([(5, 3), (3, 3), (9, 2), (9, 2), (2, 2), (None, 2), (None, None), (7, 7)], key=repr)
    assert simhash.near_duplicates(make_docs([])).collect() == []


def test_one_document_of_each_group_stays(spark, make_docs):
    """Rows, not ids, are kept or dropped: reused, null and repeated ids."""
    docs = make_docs([(4, "a b c d"), (2, "a b c d"), (2, "a b c d"), (8, "entirely different words here"), (8, "nothing like the other text of that id"),
                      (None, "x"), (None, "x"), (None, "a b c d"), (None, "only without id"), (1, ""), (0, None)]).withColumn("fp", F.lit("own"))
    kept = simhash.keep_one(docs.withColumn("__ROW", F.lit(1)))
    assert kept.columns == [*docs.columns, "__ROW"]
    assert sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=repr) == sorted(
        [(2, "a b c d"), (8, "entirely different words here"), (8, "nothing like the other text of that id"), (None, "x"), (None, "only without id"), (0, None)], key=repr)
    assert simhash.keep_one(docs.limit(0)).count() == 0


def test_kept_rows_against_brute_force(spark, make_docs, documents):
    """One row of each component, its smallest id, on documents with ids taken away or used twice."""
    rows = [(None if i % 5 == 0 else i // 2, t) for i, (_, t, *_) in enumerate(documents)] + [(3, documents[3][1]), (None, "q " * 12_000)]
    comp = brute.components({i: brute.fingerprint(t) for i, (_, t) in enumerate(rows)})
    best = {}
    for i, (doc, _) in enumerate(rows):
        best.setdefault(comp[i], []).append((doc is None, doc))
    got = simhash.keep_one(make_docs(rows).repartition(3)).collect()
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in got) == sorted((n, d or 0) for n, d in (min(v, key=lambda x: (x[0], x[1] or 0)) for v in best.values()))
    left = {i: brute.fingerprint(r["text"]) for i, r in enumerate(got)}
    assert len(set(brute.components(left).values())) == len(left) == len(best)



@pytest.mark.parametrize("n", [150, 1200])
def test_two_levels_lose_no_link(spark, n):
    """More blocks than the top may have: ranges are cut again, and routing joins their nodes."""
    codes = clustered_codes(n, 11)
    df = spark.createDataFrame([(int(np.uint64(c).astype(np.int64)),) for c in codes], "fp long")
    expected = brute.components({c: c for c in codes})
    for kw in ({"block": 20, "max_blocks": 4}, {"block": 7, "max_blocks": 1, "task_codes": 3}):
        labels = {r["node"] % 2**64: r["label"] for r in connected_components(simhash.fingerprint_links(df, **kw)).collect()}
        pairs = {(labels.get(c, ("alone", c)), expected[c]) for c in codes}
        assert len(pairs) == len({a for a, _ in pairs}) == len({b for _, b in pairs})


def test_rows_grow_near_linearly_beyond_the_top(spark):
    """Four times the fingerprints send some four to seven times the rows, not sixteen, and blocks stay small."""
    rng, rows = random.Random(2), {}
    for n in (2000, 8000):
        df = spark.createDataFrame([(rng.getrandbits(64) - 2**63,) for _ in range(n)], "fp long").distinct()
        simhash.ship(spark)
        out = simhash.block_rows(df, block=50, max_blocks=4).groupBy("block", "role").count().collect()
        rows[n] = sum(r["count"] for r in out)
        own = [r["count"] for r in out if r["role"] == 0]
        assert sum(own) == n and max(own) <= 100 and len(own) >= n // 50 // 2
        assert sum(r["count"] for r in out if r["role"] == 2) == 0
    assert rows[8000] < 8 * rows[2000]
