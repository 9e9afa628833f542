from collections import defaultdict

from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from gondola.llm import langid

from . import brute
from .conftest import SF


def test_stages_and_registration():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language ID", "SimHash near-dedup", "benchmark decontamination",
                                                     "mixing sources to target weights", "sharding"]
    assert entry.queries()["pipeline"] is corpus_pipeline.run
    assert {f"op{n}_" for n in range(1, 14)} == {q.split("_")[0] + "_" for q in entry.queries() if q.startswith("op")}


def test_run_against_brute_force(spark, documents):
    """Language ID is checked by its own accuracy tests: here all prose stays."""
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    stay = {r["doc_id"] for r in langid.keep_identified(docs).collect()}
    assert stay == {d[0] for d in documents}
    fps = {d[0]: brute.fingerprint(d[1]) for d in documents if d[0] in stay}
    comp = brute.components(fps)
    texts = {d[0]: d for d in documents if comp.get(d[0]) == d[0] and not brute.contaminated(d[1], items)}
    mixed = brute.mix([(k, k, d[1], d[3]) for k, d in texts.items()])
    copies = {k: m[4] for k, m in mixed.items() if m[4]}
    rows = corpus_pipeline.run(spark, SF).collect()
    got = defaultdict(int)
    slots = defaultdict(list)
    for r in rows:
        assert (r["text"], r["lang"], r["source"], r["n_chars"]) == tuple(texts[r["doc_id"]][1:])
        got[r["doc_id"]] += 1
        slots[r["shard"]].append(r["slot"])
    assert got == copies
    assert all(sorted(v) == list(range(len(v))) for v in slots.values()) and set(slots) <= set(range(16))


def test_stages_on_nulls_and_repeats(spark, make_docs):
    docs = make_docs([(1, None), (2, "the of and ing that thing"), (2, "the of and ing that thing"), (None, "the other words of that"), (4, "")])
    # columns that clash with what the operators add come through as they are
    own = {c: F.lit(c) for c in ("Kept", "language", "fp", "n_words", "items", "size", "taken", "position", "extra col")}
    docs = docs.withColumns(own)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns
        assert all(r[c] == c for r in out.collect() for c in own)
        docs = out
    # the copies and the texts without letters are gone
    assert {r["doc_id"] for r in docs.collect()} <= {2, None}
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, make_docs([]), SF).collect() == []
