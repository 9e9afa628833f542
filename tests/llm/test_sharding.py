import itertools
import os
import random
import time
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from gondola.llm import sharding

from . import brute
from .conftest import SF


def moved(flow):
    return sum(f for (i, j), f in flow.items() if i != j)


@pytest.mark.parametrize("supply,capacity", [
    ({0: 10, 1: 10, 2: 10}, [10, 10, 10]), ({0: 30}, [10, 10, 10]), ({0: 5, 1: 25}, [10, 10, 10]), ({0: 0, 3: 7}, [4, 0, 3]),
    ({i: 100 + 7 * i for i in range(12)}, None), ({}, [0, 0])])
def test_flow_moves_the_fewest_bytes(supply, capacity):
    capacity = capacity or sharding.even_capacities(sum(supply.values()), 16)
    flow = sharding.min_cost_flow(supply, dict(enumerate(capacity)))
    for i, s in supply.items():
        assert sum(f for (o, _), f in flow.items() if o == i) == s
    for j, c in enumerate(capacity):
        assert sum(f for (_, n), f in flow.items() if n == j) <= c
    # what a shard cannot hold has to leave it
    assert moved(flow) == sum(max(0, s - (capacity[i] if i < len(capacity) else 0)) for i, s in supply.items())


def test_flow_by_enumeration():
    supply, capacity = {0: 3, 1: 2}, {0: 1, 1: 2, 2: 2}
    best = min(sum(i != j for i, j in zip([0] * 3 + [1] * 2, to)) for to in itertools.product(capacity, repeat=5)
               if all(to.count(j) <= c for j, c in capacity.items()))
    assert moved(sharding.min_cost_flow(supply, capacity)) == best
    with pytest.raises(ValueError):
        sharding.min_cost_flow({0: 5}, {0: 4})


def test_query_on_a_larger_scale(spark):
    sf = SF.replace("0.001", "0.01")
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = sharding.query(spark, sf).collect()
    assert len(rows) == len(texts)
    shards = defaultdict(list)
    for r in rows:
        t = texts[r["doc_id"]] or ""
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(t.encode()) + 1, brute.crc(t), "bytes", None)
        assert r["old_shard"] == brute.crc(str(r["doc_id"])) % 12
        shards[r["shard"]].append(r)
    assert sorted(shards) == list(range(16))
    sizes = {k: sum(r["size"] for r in v) for k, v in shards.items()}
    longest = max(r["size"] for r in rows)
    assert max(sizes.values()) - min(sizes.values()) <= longest
    for v in shards.values():
        assert sorted(r["slot"] for r in v) == list(range(len(v)))
    # no old shard sends bytes to another old one
    assert all(r["shard"] in (r["old_shard"], 12, 13, 14, 15) for r in rows)


def test_nulls_repeats_clashes_and_empty_tables(spark, make_docs):
    rows = [(1, "a"), (1, "a"), (None, "b"), (None, None), (3, ""), (4, "z" * 100_000)] + [(i, "copy") for i in range(10, 400)]
    docs = make_docs(rows).withColumns({"slot": F.lit("x"), "Size": F.lit("y"), "extra": F.lit(7)})
    out = sharding.contract(docs).collect()
    assert len(out) == len(rows) and {r["extra"] for r in out} == {7}
    slots = defaultdict(list)
    for r in out:
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    assert sharding.contract(make_docs([])).collect() == []


def test_only_affected_shards_are_rewritten(spark, make_docs, tmp_dir):
    docs = make_docs([(i, "x" * 9) for i in range(100)])  # 25 rows of 10 bytes in each shard
    out = sharding.reshard(docs, F.pmod("doc_id", F.lit(4)), capacities=[250, 150, 250, 350])
    affected = sharding.rewrite_affected(out, f"{tmp_dir}/new")
    assert affected == [1, 3]
    assert sorted(d for d in os.listdir(f"{tmp_dir}/new") if d.startswith("shard=")) == ["shard=1", "shard=3"]
    back = spark.read.parquet(f"{tmp_dir}/new")
    assert back.groupBy("shard").count().orderBy("shard").collect() == [(1, 15), (3, 35)]


def test_flow_of_many_shards_is_fast():
    """A thousand shards to twelve hundred; moved bytes are the least possible."""
    rng = random.Random(2)
    supply = {i: rng.randrange(10**9) for i in range(1000)}
    capacity = dict(enumerate(sharding.even_capacities(sum(supply.values()), 1200)))
    began = time.time()
    flow = sharding.min_cost_flow(supply, capacity)
    assert time.time() - began < 60
    assert all(sum(f for (i, _), f in flow.items() if i == k) == b for k, b in list(supply.items())[:50])
    assert sum(flow.values()) == sum(supply.values())
    got = defaultdict(int)
    for (_, j), f in flow.items():
        got[j] += f
    assert all(got[j] <= capacity[j] for j in got)
    assert sum(f for (i, j), f in flow.items() if i != j) == sum(max(0, b - capacity.get(i, 0)) for i, b in supply.items())


def test_an_existing_layout_is_rewritten_in_place(spark, make_docs, tmp_dir):
    """Only affected shards change; a shard that gives all its rows away is gone; doing it again changes nothing."""
    old = make_docs([(i, "x" * 10) for i in range(40)]).withColumn("shard", (F.col("doc_id") % 4).cast("int"))
    old.write.partitionBy("shard").parquet(f"{tmp_dir}/layout")
    untouched = {f: os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(f"{tmp_dir}/layout/shard=0") for f in names}
    docs = spark.read.parquet(f"{tmp_dir}/layout").withColumnRenamed("shard", "was")
    size = 11 * 10
    out = sharding.reshard(docs, F.col("was"), 3, [size, 2 * size, size]).drop("was")
    assert sharding.rewrite_affected(out, f"{tmp_dir}/layout") == [1, 3]
    now = spark.read.parquet(f"{tmp_dir}/layout")
    assert {r["shard"]: r["n"] for r in now.groupBy("shard").agg(F.count("*").alias("n")).collect()} == {0: 10, 1: 20, 2: 10}
    assert sorted(r["doc_id"] for r in now.collect()) == list(range(40))
    assert not os.path.exists(f"{tmp_dir}/layout/shard=3")
    assert untouched == {f: os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(f"{tmp_dir}/layout/shard=0") for f in names}
    again = sharding.reshard(now.select("doc_id", "text", F.col("shard").alias("was")), F.col("was"), 3, [size, 2 * size, size])
    assert sharding.rewrite_affected(again, f"{tmp_dir}/layout") == []
