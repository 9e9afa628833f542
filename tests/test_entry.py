"""Driver contract, and a sample of registered queries against their DuckDB
oracles on the smallest scale (the full set runs via tools/check_oracle.py)."""

import duckdb
import pytest

import __spark_entry__ as entry
from gondola.oracle import SQL
from gondola.queries import QUERIES
from tools.check_oracle import rows_of

from .conftest import SF_SMALL

SAMPLE = ["standardize_feed", "silver", "kpis_l2", "kpi_lattice_model3", "market_share_l1_c1",
          "misclass_variants", "misclass_long", "misclass_three_levels", "unicity_code_ids", "volume_extract", "product_sample",
          "unit_inconsistency", "gtin_explode", "period_split", "bronze_feeds", "feed_assembly", "match_rate", "market_share_model2",
          "volume_units_by_level", "volume_missing_sample"]


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert {"ms_turnover", "ms_nb_product_ids", "retailer"} <= set(df.columns)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql())


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ["region", "nation", "customer", "supplier", "part", "orders", "lineitem"]:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", SAMPLE)
def test_query_matches_oracle(spark, duck, name):
    df = entry.queries()[name](spark, SF_SMALL)
    res = duck.sql(entry.oracle_sql()[name])
    assert sorted(df.columns) == sorted(res.columns)
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(res.columns, res.fetchall())


def test_sample_query_size(spark):
    assert entry.queries()["volume_missing_sample"](spark, SF_SMALL).count() <= 40
