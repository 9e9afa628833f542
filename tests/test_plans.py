"""Plan shape of every registered query: no all-pairs joins, no Python
evaluation, every aggregation combined map-side, the feed read no oftener than
needed."""

import re

import pytest

from gondola.queries import QUERIES

from .conftest import SF_SMALL

FORBIDDEN = ["CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "EvalPython", "InPandas", "InArrow"]


@pytest.fixture(scope="module")
def plan_of(spark):
    """Physical plans without adaptive execution, so that reuse shows."""
    def plan(name):
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        try:
            return QUERIES[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
        finally:
            spark.conf.set("spark.sql.adaptive.enabled", "true")
    return plan


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plan_shape(plan_of, name):
    plan = plan_of(name)
    for op in FORBIDDEN:
        assert op not in plan, f"{name}: {op}"
    # the stage below an aggregation's exchange has already combined its rows
    lines = plan.splitlines()
    for k, line in enumerate(lines):
        if "Exchange hashpartitioning" in line and "Reused" not in line and k and re.search(r"(Hash|Sort|ObjectHash)Aggregate\(keys", lines[k - 1]):
            assert re.search(r"Aggregate\(keys", lines[k + 1]), f"{name}: {line}"


# Scans of the fact table, all of them: the feed's, which alone reads l_linenumber,
# and two columns for each map.
@pytest.mark.parametrize("name", ["kpi_lattice", "kpi_lattice_model3", "market_share_lattice", "volume_units_by_level", "match_rate", "product_sample"])
def test_the_feed_is_read_once(plan_of, name):
    scans = re.findall(r"FileScan parquet \[([^\]]*l_suppkey[^\]]*)\]", plan_of(name))
    assert len([s for s in scans if "l_linenumber" in s]) == 1
    assert all(s.count(",") == 1 for s in scans if "l_linenumber" not in s) and len(scans) <= 3


def test_no_id_is_shuffled_once_per_grain(plan_of):
    """Rows are emitted per grain only after the ids have been counted."""
    plan = plan_of("kpi_lattice")
    exchanges = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan)
    assert not [e for e in exchanges if "grain#" in e and "_value#" in e]


def test_scan_reads_only_needed_columns(plan_of):
    schemas = re.findall(r"/part\.parquet.*?ReadSchema: struct<([^>]*)>", plan_of("unit_inconsistency"))
    assert schemas and all("p_retailprice" not in s and "p_container" not in s for s in schemas)


@pytest.mark.parametrize("name", ["standardize_feed", "map_products", "silver", "kpis_l4", "product_sample", "prepare_product_map"])
def test_no_generated_method_is_too_long_to_be_compiled(spark, name):
    """HotSpot runs a method of more than 8,000 bytes uncompiled."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        stages = QUERIES[name](spark, SF_SMALL)._jdf.queryExecution().debug().codegenToSeq()
        longest = max(stages.apply(i)._3().maxMethodCodeSize() for i in range(stages.size()))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert longest < 8000


def test_the_map_joins_do_not_exchange_the_feed(spark):
    """The maps are there, and small, before the feed is joined with them."""
    df = QUERIES["map_products"](spark, SF_SMALL)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "__spread" in plan and not re.search(r"Exchange hashpartitioning\([^)]*level_1#\d+[^)]*product", plan)
    assert not re.search(r"SortMergeJoin \[retailer", plan)


def test_comparison_rows_are_dealt_by_product_once(plan_of):
    """A product's entries, windows and semi-join are where its rows are."""
    dealt = re.findall(r"Exchange hashpartitioning\(([^)]*product_id#[^)]*)\)", plan_of("misclass_variants"))
    dealt = [by for by in dealt if "level_1_standard" not in by]  # but for the distinct rows
    assert len(dealt) == 2 and all(re.fullmatch(r"product_id#\d+, \d+", by) for by in dealt)


def test_lines_are_not_sorted_for_their_orders(plan_of):
    plan = plan_of("kpis_l1")
    assert "ShuffledHashJoin [l_orderkey" in plan and "Sort [l_orderkey" not in plan


def test_unicity_reduces_the_feed_once(plan_of):
    """Offending keys and their details share the feed's distinct keys."""
    assert len(re.findall(r"FileScan parquet \[[^\]]*l_orderkey", plan_of("unicity_code_ids"))) == 1


@pytest.mark.parametrize("name", ["kpi_lattice", "market_share_lattice", "market_share_model3"])
def test_ids_travel_beside_one_text(plan_of, name):
    """where rows of ids are exchanged, a cell is one text, and no exchange of them is merged by size."""
    dealt = [line for line in plan_of(name).splitlines() if "Exchange hashpartitioning" in line and "_value#" in line]
    assert len(dealt) == 2 and not [line for line in dealt if "standard#" in line or "year#" in line]
    assert "REPARTITION_BY_NUM" in dealt[0]


def test_a_partition_of_ids_has_few_cells(spark):
    """ids of a year and level 1 are dealt in a number of shares, so partial sums of a cell are at most as many."""
    from pyspark.sql import functions as F

    from gondola.operators.kpis import ID_SHARES, kpi_grains, kpi_lattice

    n = 20000
    lines = spark.range(0, n, 1, 8).select(F.lit("r").alias("retailer"), F.lit("2024").alias("year"), F.lit("1").alias("department"), F.lit("A").alias("level_1_standard"),
                                           F.col("id").cast("string").alias("product_id"), (F.col("id") + 1).cast("string").alias("product_code"), F.lit(1.0).alias("turnover"))
    spark.conf.set("spark.sql.shuffle.partitions", "100")
    try:
        df = kpi_lattice(lines, kpi_grains(1, ["", "Dep"]))
        assert [tuple(r)[-3:] for r in df.collect()] == [(n, n, n)] * 2
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert ID_SHARES < 100 and re.search(rf"pmod\(xxhash64\(_value#\d+, 42\), {ID_SHARES}\)", plan)
