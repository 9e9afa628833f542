import pytest
from pyspark.sql import functions as F

from gondola.llm import decontaminate

from . import brute
from .conftest import SF

WORDS = [f"w{i}" for i in range(40)]


def found(spark, docs, items, **kw):
    bench = spark.createDataFrame(items, "item_id long, text string")
    rows = decontaminate.find_contamination(docs, bench, **kw).collect()
    return rows


def check(rows, items):
    for r in rows:
        n, h, ids = brute.contamination(r["text"], items)
        assert (r["n_words"], r["n_hit"], r["items"]) == (n, h, ids), r["doc_id"]
        assert sum(s["last"] - s["first"] for s in r["hit_spans"]) == h


def test_edge_cases_against_brute_force(spark, make_docs):
    passage = " ".join(WORDS[:20])
    items = [(1, passage), (2, "Short Item!"), (3, ""), (4, None), (5, "one"), (6, " ".join(WORDS[5:25])), (1, "w1 w1 w1"), (7, "é à ü ñ")]
    docs = [
        (1, f"before {passage} after"), (2, " ".join(WORDS[:13])), (3, " ".join(WORDS[:12])), (4, None), (5, ""),
        (6, "SHORT... item"), (7, "short x item"), (8, "one"), (9, "one " * 50), (10, " ".join(WORDS)), (11, f"{passage} {passage}"),
        (12, "w1 w1 w1 w1"), (13, "z " * 5000 + passage), (1, f"before {passage} after"), (None, passage), (14, "É À ü ñ é à ü ñ"),
        (15, " ".join(WORDS[:12]) + " x " + WORDS[12]), (16, "!!! ???"),
    ]
    rows = found(spark, make_docs(docs), items)
    assert len(rows) == len(docs)
    check(rows, items)


def test_a_benchmark_of_several_blocks_gives_the_same(spark, make_docs):
    items = [(i, " ".join(WORDS[i:i + 15])) for i in range(20)]
    docs = make_docs([(i, " ".join(WORDS[i:i + 18])) for i in range(15)] + [(99, "nothing here")])
    rows = found(spark, docs, items, block_windows=7)
    assert len(rows) == 16
    check(rows, items)


def test_empty_tables_and_clashing_columns(spark, make_docs):
    docs = make_docs([(1, "a b c")]).withColumns({"n_hit": F.lit("x"), "Items": F.lit(1), "extra": F.lit(2)})
    rows = found(spark, docs, [])
    assert [(r["n_words"], r["n_hit"], r["extra"]) for r in rows] == [(3, 0, 2)]
    assert found(spark, make_docs([]), [(1, "a b")]) == []


def test_removal_keeps_clean_documents(spark, make_docs):
    passage = " ".join(WORDS[:13])
    docs = [(1, passage), (2, "z " * 247 + passage), (3, "z " * 248 + passage), (4, "clean"), (5, None)]
    kept = decontaminate.remove_contaminated(make_docs(docs), spark.createDataFrame([(1, passage)], "item_id long, text string"))
    assert kept.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    # 13 of 260 words are a twentieth, 13 of 261 are less
    assert sorted(r["doc_id"] for r in kept.collect()) == [3, 4, 5]


def test_query_on_the_smallest_scale(spark, documents):
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    texts = {d[0]: d[1] for d in documents}
    rows = decontaminate.query(spark, SF).collect()
    assert len(rows) == len(texts)
    for r in rows:
        n, h, ids = brute.contamination(texts[r["doc_id"]], items)
        assert tuple(r) == (r["doc_id"], n, h, len(ids), brute.sha(",".join(ids)), h > 0 and 20 * h >= n)
    assert any(r["contaminated"] for r in rows)


@pytest.mark.parametrize("text,words", [("Añb-c  D2", ["añb", "c", "d2"]), ("İX", ["İx"])])
def test_words(spark, text, words):
    bench = spark.createDataFrame([(1, text)], "item_id long, text string")
    assert decontaminate.benchmark_windows(bench).first()["window"] == " ".join(words)


def test_a_window_that_many_items_share_is_dealt_over_blocks(spark, make_docs, monkeypatch):
    """No block holds more than its share of a window's items; the result is whole."""
    items = spark.range(100_000).select(F.col("id").alias("item_id"), F.lit(" ".join(WORDS[:13])).alias("text"))
    sizes, block = [], decontaminate._block
    monkeypatch.setattr(decontaminate, "_block", lambda rows, k: (sizes.append(len(rows)), block(rows, k))[1])
    docs = make_docs([(1, " ".join(WORDS)), (2, " ".join(WORDS[:12])), (3, "x " * 10_000 + " ".join(WORDS[:13]))])
    got = {r["doc_id"]: r for r in decontaminate.find_contamination(docs, items, block_windows=30_000).collect()}
    assert sum(sizes) == 100_000 and max(sizes) < 30_000
    ids = sorted(str(i) for i in range(100_000))
    assert [(d, got[d]["n_words"], got[d]["n_hit"], got[d]["items"] == ids) for d in (1, 2, 3)] == [(1, 40, 13, True), (2, 12, 0, False), (3, 10_013, 13, True)]
