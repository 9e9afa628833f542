import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from gondola.llm import class_lm

from . import brute
from .conftest import SF


def expected(texts, training):
    c = brute.base_counts(training)
    n, v = sum(c.values()), len(c)
    out = []
    for t in texts:
        tokens = brute.class_tokens(t)
        out.append((len(tokens), sum(c[x] > 0 for x in tokens), n, sum(math.log10((c[x] + 1) / (n + v + 1)) for x in tokens)))
    return out


def test_query_against_brute_force_and_held_out_perplexity(spark, documents):
    rows = {r["doc_id"]: r for r in class_lm.query(spark, SF.replace("0.001", "0.01")).collect()}
    docs = [tuple(r) for r in spark.read.parquet(f"{SF.replace('0.001', '0.01')}/documents.parquet").select("doc_id", "text").collect()]
    out = {d: brute.crc(str(d)) % 7 == 2 for d, _ in docs}
    want = expected([t for _, t in docs], [t for d, t in docs if not out[d]])
    base = score = tokens = 0
    for (d, _), (n, known, total, b) in zip(docs, want):
        r = rows[d]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (out[d], n, known, total)
        assert r["base_score"] == pytest.approx(b, rel=1e-9)
        assert r["perplexity"] == pytest.approx(10 ** (-r["score"] / n))
        if out[d]:
            base, score, tokens = base + b, score + r["score"], tokens + n
    assert 10 ** (-score / tokens) < 0.8 * 10 ** (-base / tokens)


def test_joined_counts_equal_sent_counts(spark, make_docs, monkeypatch):
    monkeypatch.setattr(class_lm, "CLUSTERED", 4)
    docs = make_docs([(i, " ".join(f"w{j % (3 + i)}" for j in range(40)) + f" only{i}") for i in range(20)])
    training = docs.where("doc_id < 15")
    whole = {r["doc_id"]: r for r in class_lm.score(docs, training).collect()}
    monkeypatch.setattr(class_lm, "FREQUENT", 8)
    joined = {r["doc_id"]: r for r in class_lm.score(docs, training).collect()}
    for d, r in whole.items():
        assert (r["n_known"], r["n_tokens"]) == (joined[d]["n_known"], joined[d]["n_tokens"])
        assert joined[d]["base_score"] == pytest.approx(r["base_score"])
        assert joined[d]["score"] == pytest.approx(r["score"])


def test_probabilities_add_up(spark, make_docs):
    docs = make_docs([(i, "the cat sat on the mat and the dog sat too") for i in range(5)])
    counts = class_lm.word_counts(docs.select("text"))
    m = class_lm.train(docs.select("text"), counts, 5)
    assert np.allclose((10 ** m.transition).sum(axis=1), 1.0)
    # words of a class and one unseen word share its emissions
    for c in set(m.frequent_class.tolist()):
        mine = m.frequent_class == c
        assert (m.counts[mine] + 1).sum() + 1 <= 10 ** m.room[c] * (1 + 1e-9) + 1e-9


def test_exchange_raises_the_likelihood():
    rng = np.random.default_rng(3)
    kind = rng.integers(0, 4, 61)
    b = np.zeros((61, 61))
    for _ in range(20_000):
        i = rng.integers(1, 61)
        j = rng.choice(np.flatnonzero(kind == (kind[i] + 1) % 4))
        b[i, j] += 1
    b[0, :] += 1
    b[:, 0] += 1

    def objective(of):
        m = np.eye(8)[of]
        g = m.T @ b @ m
        f = lambda x: (x[x > 0] * np.log(x[x > 0])).sum()
        return f(g) - f(g.sum(0)) - f(g.sum(1))

    start, end = class_lm.exchange_clusters(b, 8, 0), class_lm.exchange_clusters(b, 8, 30)
    assert objective(end) > objective(start) and (end[1:] != 0).all() and end[0] == 0
    # hidden kinds are not mixed
    pure = sum(np.bincount(kind[1:][end[1:] == c], minlength=4).max() for c in range(1, 8) if (end[1:] == c).any())
    assert pure >= 55


def test_nulls_repeats_clashes_and_empty_tables(spark, make_docs):
    docs = make_docs([(1, None), (2, ""), (3, "A b\x0bc"), (3, "A b\x0bc"), (None, "a"), (4, "z " * 50_000)]).withColumn("Score", F.lit("x"))
    rows = class_lm.score(docs, docs).collect()
    want = expected([r[1] for r in docs.collect()], [r[1] for r in docs.collect()])
    key = lambda r: (r[0], r[1], r[2], round(r[3], 6))
    assert sorted(key((r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"])) for r in rows) == sorted(map(key, want))
    assert class_lm.score(make_docs([]), make_docs([])).collect() == []
    alone = class_lm.score(make_docs([(1, "a b")]), make_docs([])).first()
    assert (alone["n_tokens"], alone["n_known"], alone["train_tokens"]) == (3, 0, 0) and math.isfinite(alone["score"])


def test_class_score_against_plain_python(spark, documents, make_docs, monkeypatch):
    """P(class | class before) and P(word | class), counted in plain Python from the classes of the words."""
    monkeypatch.setattr(class_lm, "CLUSTERED", 60)
    rows = [(d, t) for d, t, *_ in documents][:120] + [(-1, None), (-2, "neverseen xyzzyqq the")]
    docs = make_docs(rows)
    training = docs.where("doc_id >= 0 AND doc_id % 3 > 0")
    counts = class_lm.word_counts(training.select("text"))
    texts = [brute.spaced_words(t) for d, t in rows if d >= 0 and d % 3 > 0]
    m = class_lm.train(training.select("text"), counts, len(texts))
    named = {bytes(w.as_py()).decode(): int(c) for w, c in zip(m.frequent, m.frequent_class)}

    def class_of(word):
        data = np.frombuffer(word.encode(), np.uint8)
        return named[word] if word in named else int(m.ending_class[class_lm._endings(data, np.array([0]), np.array([len(data)]))[0]])

    count = Counter(w for t in texts for w in t)
    grid = np.zeros((class_lm.CLASSES, class_lm.CLASSES))
    for t in texts:
        chain = [0, *map(class_of, t), 0]
        for a, b in zip(chain, chain[1:]):
            grid[a, b] += 1
    tokens = grid.sum(axis=0)
    distinct = Counter(class_of(w) for w in count)
    share = (tokens + 1) / (tokens.sum() + class_lm.CLASSES)
    got = {r["doc_id"]: r["score"] for r in class_lm.score(docs, training).collect()}
    for d, t in rows:
        words = brute.spaced_words(t)
        chain = [0, *map(class_of, words), 0]
        score = sum(math.log10((grid[a, b] + class_lm.SMOOTHING * share[b]) / (grid[a].sum() + class_lm.SMOOTHING)) for a, b in zip(chain, chain[1:]))
        score += sum(math.log10((count[w] + 1) / (tokens[class_of(w)] + distinct[class_of(w)] + 1)) for w in words)
        assert got[d] == pytest.approx(score, rel=1e-9), d


def test_word_contexts_and_moves_against_plain_python(spark, documents, make_docs, monkeypatch):
    """Counts of classes around each word, the class table, and that a pass raises the likelihood."""
    monkeypatch.setattr(class_lm, "CLUSTERED", 20)
    rows = [(d, t) for d, t, *_ in documents][:80] + [(-1, None), (-2, ""), (-3, "echo echo echo " * 400)]
    texts = make_docs(rows).select("text").repartition(3)
    counts = class_lm.word_counts(texts)
    table, (n_units, n_exchanged, _) = class_lm.frequent_words(counts, 20, 500, 10)
    assert 0 < n_units <= 20 < n_exchanged <= 500
    words = class_lm._one_array(table.column("word"))[:n_exchanged]
    rng = np.random.default_rng(1)
    classes = class_lm.Classes(words, rng.integers(1, class_lm.CLASSES, n_exchanged), rng.integers(1, class_lm.CLASSES, class_lm.ENDINGS))
    number = {bytes(w.as_py()).decode(): i for i, w in enumerate(words)}

    def class_of(word, c):
        data = np.frombuffer(word.encode(), np.uint8)
        ending = class_lm._endings(data, np.array([0]), np.array([len(data)]))[0]
        return int(c.of_word[number[word]]) if word in number else int(c.of_ending[ending])

    def counted(c):
        cells, grid = Counter(), np.zeros((class_lm.CLASSES, class_lm.CLASSES))
        for _, t in rows:
            tokens = [None, *brute.spaced_words(t), None]
            of = [0 if w is None else class_of(w, c) for w in tokens]
            for a, b, x, y in zip(tokens, tokens[1:], of, of[1:]):
                grid[x, y] += 1
                i, j = number.get(a, -1), number.get(b, -1)
                if i == j >= n_units:
                    cells[i, 2 * class_lm.CLASSES] += 1
                    continue
                if i >= n_units:
                    cells[i, y] += 1
                if j >= n_units:
                    cells[j, class_lm.CLASSES + x] += 1
        return cells, grid

    cells, grid = counted(classes)
    got = {(r["word"], s["slot"]): s["n"] for r in class_lm.word_contexts(texts, classes, n_units).collect() for s in r["cells"]}
    assert got == cells
    assert (class_lm.class_bigrams(texts, classes) == grid).all()
    moved, after = class_lm.exchange_words(texts, classes, grid, n_units, 2)
    assert (after == counted(moved)[1]).all()
    assert class_lm._likelihood(after) > class_lm._likelihood(grid)
    assert (moved.of_word[:n_units] == classes.of_word[:n_units]).all() and (moved.of_word > 0).all()


def test_more_words_of_their_own_class_predict_better(spark, monkeypatch):
    docs = spark.read.parquet(f"{SF.replace('0.001', '0.01')}/documents.parquet").select("doc_id", "text").withColumn("held_out", class_lm.held_out(F.col("doc_id")))
    log = {}
    for most in (0, class_lm.EXCHANGED):
        monkeypatch.setattr(class_lm, "EXCHANGED", most)
        sums = class_lm.score(docs, docs.where("NOT held_out")).groupBy("held_out").agg(F.sum("score").alias("s"), F.sum("n_tokens").alias("n")).collect()
        log[most] = {r["held_out"]: r["s"] / r["n"] for r in sums}
    print(log)
    assert all(log[class_lm.EXCHANGED][h] > log[0][h] for h in (False, True))


def test_classes_of_many_words_at_once_equal_one_by_one():
    rng = np.random.default_rng(7)
    size = 9
    grid = rng.integers(0, 60, (size, size)).astype(float)
    cells, old = np.zeros((300, 2 * size + 1)), rng.integers(1, size, 300)
    for k, c in enumerate(old):  # counts that the table holds; some units meet no class
        r, l = (np.floor(rng.random(size) * (rng.random(size) < 0.5) * x / 3) for x in (grid[c], grid[:, c]))  # noqa: E741
        cells[k] = [*r, *l, rng.integers(0, 2) * (grid[c, c] // 4)] if k % 10 else 0
    want = []
    for v, c in zip(cells, old):
        rest = grid.copy()
        class_lm._taken_out(rest, c, v[:size], v[size:-1], v[-1])
        want.append(class_lm._best(class_lm._gains(rest, v[:size], v[size:-1], v[-1]), c))
    got = class_lm._best_classes(grid, cells, old)
    assert got.tolist() == want and (got != old).any() and (got == old).any()
