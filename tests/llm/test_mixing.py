import pytest
from pyspark.sql import functions as F

from gondola.llm import mixing

from . import brute
from .conftest import SF


def compare(rows, expected):
    for r in rows:
        size, source_size, target, taken, copies = expected[r["key"]]
        assert (r["size"], r["source_size"], r["taken"], r["copies"]) == (size, source_size, taken, copies), r
        assert r["target"] == pytest.approx(target)
        assert len(r["positions"]) == (-(-taken // size) if size else 0)
        assert all(0 <= p <= 1 for p in r["positions"])


def test_small_mix_against_brute_force(spark, make_docs):
    docs = ([(i, "w " * (1 + i % 7), "en", "a") for i in range(60)] + [(100 + i, "w " * 3, "en", "b") for i in range(4)]
            + [(200, None, "en", "c"), (201, "", "en", "c"), (300, "w " * 400, "en", None), (301, "w", "en", None), (301, "w", "en", None),
               (None, "w w", "en", "a"), (None, "w w", "en", "a"), (400, "w " * 20_000, "en", "é")])
    df = make_docs(docs).withColumn("key", F.col("doc_id"))
    keyed = spark.createDataFrame([(k, *d) for k, d in enumerate(docs)], "key long, doc_id long, text string, lang string, source string")
    rows = mixing.mix(keyed.withColumns({"Size": F.lit("x"), "taken": F.lit("y")})).collect()
    assert len(rows) == len(docs) == df.count()
    expected = brute.mix([(k, d[0], d[1], d[3]) for k, d in enumerate(docs)])
    # repeated rows share an order key: only their sums are defined
    repeated = {k for k, d in enumerate(docs) if d[0] in (None, 301)}
    compare([r for r in rows if r["key"] not in repeated], expected)
    assert sum(r["taken"] for r in rows) == sum(e[3] for e in expected.values())
    assert all(r["taken"] <= 3 * r["size"] for r in rows)


def test_query_on_the_smallest_scale(spark, documents):
    expected = brute.mix([(d[0], d[0], d[1], d[3]) for d in documents])
    rows = mixing.query(spark, SF).collect()
    assert len(rows) == len(documents)
    for r in rows:
        size, source_size, target, taken, copies = expected[r["doc_id"]]
        assert (r["size"], r["source_size"], r["taken"], r["copies"]) == (size, source_size, taken, copies)
    positions = [r["position"] for r in rows if r["position"] is not None]
    assert positions == sorted(positions)


@pytest.mark.parametrize("knots", [[(0, 1), (1, 1)], [(0, 0), (1, 2)], [(0, 2), (1, 0)], [(0, 1), (0.25, 3), (0.25, 0), (0.5, 0), (1, 4)]])
def test_inverting_the_integrated_schedule(spark, knots):
    def integral(t):
        total = 0.0
        for (a, x), (b, y) in zip(knots, knots[1:]):
            if t > a:
                e = min(t, b)
                end = x + (y - x) * (e - a) / (b - a) if b > a else x
                total += (e - a) * (x + end) / 2
        return total
    schedule = F.array(*[F.struct(F.lit(float(t)).alias("t"), F.lit(float(w)).alias("w")) for t, w in knots])
    sizes = spark.createDataFrame([("0s", 100)], "__source string, source_size long")
    planned = mixing.targets(sizes, lambda rank: schedule)
    shares = [0.0, 0.1, 0.3, 0.5, 0.77, 0.999]
    got = planned.select(*[mixing.invert(F.col("segments"), F.lit(s)).alias(str(k)) for k, s in enumerate(shares)]).first()
    for s, t in zip(shares, got):
        assert integral(t) / integral(1.0) == pytest.approx(s, abs=1e-9)


def test_training_order_holds_each_copy(spark, make_docs):
    docs = make_docs([(i, "w " * 5, "en", "a") for i in range(30)] + [(100, "w " * 2, "en", "b")])
    mixed = mixing.mix(docs)
    ordered = mixing.in_training_order(mixed).collect()
    assert len(ordered) == mixed.agg(F.sum("copies")).first()[0]
    assert [r["position"] for r in ordered] == sorted(r["position"] for r in ordered)
    assert mixing.mix(make_docs([])).collect() == []
    assert mixing.mix(make_docs([(1, None), (2, " ")])).agg(F.sum("taken")).first()[0] == 0


def test_rows_without_id_are_spread(spark):
    """A source whose rows have no id is not one bucket; reruns agree."""
    docs = spark.range(100_000).select(F.lit(None).cast("long").alias("doc_id"), F.concat(F.lit("text "), "id").alias("text"), F.lit("s").alias("source"))
    sizes = [r["count"] for r in mixing._ordered(docs, "mix").groupBy("__bucket").count().collect()]
    assert len(sizes) > 4000 and max(sizes) < 100
    once, again = (sorted((r["text"], r["taken"], r["positions"]) for r in mixing.mix(d).collect()) for d in (docs.limit(500), docs.limit(500).repartition(5)))
    assert once == again
