from collections import Counter, defaultdict

from pyspark.sql import functions as F

from gondola.llm import exact_dedup

from . import brute
from .conftest import SF


def expected(docs):
    groups = defaultdict(list)
    for d, t in docs:
        groups["".join(brute.re.split(r"[\x20\x09-\x0D]+", t or ""))].append((d, t or ""))
    out = {}
    for norm, rows in groups.items():
        keep = min(rows, key=lambda r: (-len(r[1]), r[0]))[0]
        for d, _ in rows:
            out[d] = (d, keep, len(rows), d == keep, brute.sha(norm))
    return out


def test_query_on_the_smallest_scale(spark, documents):
    rows = {r["doc_id"]: tuple(r) for r in exact_dedup.query(spark, SF).collect()}
    assert rows == expected([d[:2] for d in documents])


def test_hot_and_cold_digests_agree_with_brute_force(spark, make_docs):
    docs = [(i, "hot  text" if i % 3 else f"cold {i // 6}") for i in range(300)] + [(900, None), (901, " \n"), (902, ""), (903, "hot text"), (904, "y" * 60_000)]
    for counters in (3, 255):
        rows = exact_dedup.exact_groups(make_docs(docs), counters).collect()
        assert {r["doc_id"]: tuple(r) for r in rows} == expected(docs)


def test_misra_gries_names_every_heavy_digest(spark):
    values = ["a"] * 500 + ["b"] * 300 + [f"x{i}" for i in range(400)]
    df = spark.createDataFrame([(v.encode(),) for v in values], "digest binary").repartition(5)
    found = {bytes(r["digest"]).decode(): r["at_least"] for r in exact_dedup.misra_gries(df, 9).collect()}
    true = Counter(values)
    assert {"a", "b"} <= set(found) and len(found) <= 10
    assert all(n <= true[v] for v, n in found.items())


def test_repeated_rows_null_ids_and_clashing_columns(spark, make_docs):
    docs = make_docs([(1, "a"), (1, "a"), (None, "a"), (2, "a a")]).withColumn("kept", F.lit("own"))
    rows = exact_dedup.exact_groups(docs).collect()
    assert sorted((str(r["doc_id"]), r["keep_id"], r["group_size"]) for r in rows) == [("1", 1, 3), ("1", 1, 3), ("2", 2, 1), ("None", 1, 3)]
    assert sum(r["kept"] for r in rows) == 2
    assert exact_dedup.exact_groups(make_docs([])).collect() == []


def test_dropping_copies_keeps_the_columns(spark, make_docs):
    kept = exact_dedup.drop_copies(make_docs([(1, "a b"), (2, "ab"), (3, "c")]))
    assert kept.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 3]


def test_rows_are_dropped_not_ids(spark, make_docs):
    docs = make_docs([(1, "a b"), (1, "ab"), (1, "other"), (1, "other"), (None, "c"), (None, "c"), (None, "unique"), (2, None), (3, " ")]).withColumn("__row", F.lit("own"))
    kept = exact_dedup.drop_copies(docs)
    assert kept.columns == docs.columns
    assert sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=repr) == sorted([(1, "a b"), (1, "other"), (None, "c"), (None, "unique"), (3, " ")], key=repr)
    assert exact_dedup.drop_copies(make_docs([])).count() == 0
