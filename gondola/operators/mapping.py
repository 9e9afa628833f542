"""Nomenclature mapping and the silver table.

The correspondence tables are small dimensions keyed by the native levels;
they are joined with plain left equi-joins on ``retailer`` + levels.  No
broadcast hint is forced: Catalyst broadcasts a map whose estimated size is
under ``spark.sql.autoBroadcastJoinThreshold`` and AQE converts the join at
run time once the map's real size is known, falling back to a (skew-split)
sort-merge join when a map is large.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gondola.config import (
    CUSTOMER_SEGMENTS,
    CUSTOMER_STANDARDS,
    PRODUCT_LEVELS,
    PRODUCT_STANDARDS,
    SILVER_COLUMNS,
)
from gondola.functions.agg import any_null
from gondola.functions.text import classification_path
from gondola.operators.shaping import select_existing

RETAILER = "retailer"
SPREAD_BY = ("product_id", "product_code", "month")


def _map_side(mapping: DataFrame, keys: Sequence[str], standards: Sequence[str]) -> DataFrame:
    # right-hand duplicates of non-key columns would be ambiguous; keep keys + standards
    return mapping.select(*keys, *[c for c in standards if c in mapping.columns])


def _left_join(feed: DataFrame, mapping: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left equi-join.  A line whose key holds a null matches nothing; such lines
    get a number of their own as one more key, so that a join by shuffle spreads
    them instead of meeting them all in one partition.  The number is made of the
    few columns that tell lines apart best, where the feed has them: made of all, it
    would have every column computed and carried through the join for reports that
    read three of them."""
    own = [c for c in SPREAD_BY if c in feed.columns] or feed.columns
    spread = F.when(any_null(keys), F.xxhash64(*[F.col(f"`{c}`") for c in own])).otherwise(F.lit(0).cast("long"))
    # always zero, but no literal: the planner would take that out of the keys
    zero = F.xxhash64(*keys) % 1
    out = feed.withColumn("__spread", spread).join(mapping.withColumn("__spread", zero), [*keys, "__spread"], "left")
    return out.drop("__spread")


def map_products(
    feed: DataFrame,
    product_map: DataFrame,
    *,
    levels: Sequence[str] = PRODUCT_LEVELS,
    standards: Sequence[str] = PRODUCT_STANDARDS,
) -> DataFrame:
    """Left join on retailer + native levels; duplicate map keys fan out."""
    keys = [RETAILER, *levels]
    return _left_join(feed, _map_side(product_map, keys, standards), keys)


def map_customers(
    feed: DataFrame,
    customer_map: DataFrame,
    *,
    segments: Sequence[str] = CUSTOMER_SEGMENTS,
    standards: Sequence[str] = CUSTOMER_STANDARDS,
) -> DataFrame:
    """Left join on retailer + native segments."""
    keys = [RETAILER, *segments]
    return _left_join(feed, _map_side(customer_map, keys, standards), keys)


def build_silver(
    feed: DataFrame,
    product_map: DataFrame,
    customer_map: DataFrame,
    *,
    levels: Sequence[str] = PRODUCT_LEVELS,
    segments: Sequence[str] = CUSTOMER_SEGMENTS,
    product_standards: Sequence[str] = PRODUCT_STANDARDS,
    customer_standards: Sequence[str] = CUSTOMER_STANDARDS,
    columns: Sequence[str] = SILVER_COLUMNS,
) -> DataFrame:
    """J1 -> J2 -> schema-intersecting select -> classification path.

    Output: ``retailer`` + the silver columns the feed has + ``classification``.
    """
    mapped = map_products(feed, product_map, levels=levels, standards=product_standards)
    mapped = map_customers(mapped, customer_map, segments=segments, standards=customer_standards)
    silver = select_existing(mapped, [RETAILER, *columns])
    return silver.withColumn("classification", classification_path(list(levels)))


def mapped_product_keys(feed: DataFrame, product_map: DataFrame, *,
                        levels: Sequence[str] = PRODUCT_LEVELS,
                        standards: Sequence[str] = PRODUCT_STANDARDS,
                        keys: Sequence[str] = ("product_id", "product_code")) -> DataFrame:
    """Distinct product keys x native levels of the feed, with their standards.

    Holds exactly the distinct (retailer, keys, levels, standards) combinations
    of silver (left joins only repeat lines), from a table bounded by the
    product catalogue instead of the sales lines; reports that look only at
    product classification (unicity checks) run on it.  The exchange after it
    lets a report that reads the table twice, with other columns each time, share
    it: without, the planner would reduce the whole feed once for each.
    """
    present = [k for k in keys if k in feed.columns]
    distinct_keys = feed.select(RETAILER, *present, *levels).distinct().repartition(RETAILER, *present)
    return map_products(distinct_keys, product_map, levels=levels, standards=standards)
