"""Data-quality reports on the mapped data."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gondola.config import (
    CUSTOMER_SEGMENTS,
    CUSTOMER_STANDARDS,
    PRODUCT_LEVELS,
    PRODUCT_STANDARDS,
)
from gondola.functions.agg import any_null

RETAILER = "retailer"


def unmatched(silver: DataFrame, natives: Sequence[str], standards: Sequence[str]) -> DataFrame:
    """Distinct native keys whose standard is missing in at least one level."""
    return (silver.filter(any_null(standards))
            .select(RETAILER, *natives, *standards)
            .distinct())


def unmatched_products(silver: DataFrame, levels: Sequence[str] = PRODUCT_LEVELS,
                       standards: Sequence[str] = PRODUCT_STANDARDS) -> DataFrame:
    """A8."""
    return unmatched(silver, levels, standards)


def unmatched_customers(silver: DataFrame, segments: Sequence[str] = CUSTOMER_SEGMENTS,
                        standards: Sequence[str] = CUSTOMER_STANDARDS) -> DataFrame:
    """A9."""
    return unmatched(silver, segments, standards)


def check_unicity(df: DataFrame, subset: Sequence[str], to_check: Sequence[str], *,
                  key: Sequence[str] = (RETAILER,), detail_prefix: str = "level") -> tuple[DataFrame, DataFrame] | None:
    """A6 (``check_unicity``): keys of ``subset`` carrying more than one
    distinct combination of ``to_check``.

    Returns ``(offenders, details)``: offending keys, and the distinct detail
    rows (subset + other ``level*`` columns + checked columns) for them, or
    ``None`` when a column is missing.  The offender list is never pulled to
    the driver: details are a left-semi join against it.
    """
    subset, to_check, key = list(subset), list(to_check), list(key)
    if not set(subset + to_check).issubset(df.columns):
        return None
    others = [c for c in df.columns if c.startswith(detail_prefix) and c not in to_check and c not in subset]
    detail_cols = list(dict.fromkeys(key + subset + others + to_check))
    details = df.select(*detail_cols).distinct()
    combos = details.select(*dict.fromkeys(key + to_check + subset)).distinct()
    offenders = (combos.groupBy(*key, *subset).count()
                 .filter(F.col("count") > 1).select(*key, *subset))
    return offenders, details.join(offenders, key + subset, "left_semi")


def unicity_checks(silver: DataFrame, without_id: Sequence[str],
                   standards: Sequence[str] = PRODUCT_STANDARDS) -> dict[str, DataFrame]:
    """(standards by id), (standards by code), (ids by code).

    Feeds without a product id take part only in the code-based standards
    check, as their silver has no id column.
    """
    with_id = silver.filter(~F.col(RETAILER).isin(*without_id)) if without_id else silver
    out = {}
    for name, frame, subset, to_check in (
        ("unicity_id_levels", with_id, ["product_id"], list(standards)),
        ("unicity_code_levels", silver, ["product_code"], list(standards)),
        ("unicity_code_ids", with_id, ["product_code"], ["product_id"]),
    ):
        res = check_unicity(frame, subset, to_check)
        if res is not None:
            out[name] = res[1]
    return out


# ---------------------------------------------------------------- key-level forms
#
# Match counts and unmatched keys depend only on the mapping keys of a line,
# not on the line itself.  Pre-aggregating the standardised feed to its
# distinct keys (with a row count) before the map joins reads the feed once
# and joins a table whose size is bounded by the key combinations, not by
# the number of sales lines.  Results equal the silver-based forms: a left
# join keeps every key and repeats it once per matching map row, so
# weighting by the row count reproduces the silver multiplicities.


def _rows_per_key(mapping: DataFrame, keys: Sequence[str], flag: str, name: str) -> DataFrame:
    """Rows of a map for each key, and those with a standard."""
    return mapping.groupBy(*keys).agg(F.count(F.lit(1)).alias(f"_{name}_rows"), F.count_if(F.col(flag).isNotNull()).alias(f"_{name}_matched"))


def match_rate(std: DataFrame, product_map: DataFrame, customer_map: DataFrame, *,
               levels: Sequence[str] = PRODUCT_LEVELS, segments: Sequence[str] = CUSTOMER_SEGMENTS,
               product_flag: str = "level_1_standard", customer_flag: str = "segment_1_standard",
               lines: str | None = None) -> DataFrame:
    """A10: feed rows, mapped rows with a product standard, with a customer
    standard, per retailer (mapped rows count fan-out, so may exceed input).

    The feed is read once and reduced to its distinct keys with line counts
    (``lines`` names such a count that ``std`` already carries); the maps are
    reduced to one row a key, so nothing fans out.
    """
    n = F.count(F.lit(1)) if lines is None else F.sum(lines)
    keyed = std.groupBy(RETAILER, *levels, *segments).agg(n.alias("_n"))
    p = _rows_per_key(product_map, [RETAILER, *levels], product_flag, "p")
    c = _rows_per_key(customer_map, [RETAILER, *segments], customer_flag, "c")
    both = keyed.join(p, [RETAILER, *levels], "left").join(c, [RETAILER, *segments], "left")
    zero, one = F.lit(0), F.lit(1)
    return both.groupBy(RETAILER).agg(
        F.sum("_n").alias("n_rows"),
        F.sum(F.col("_n") * F.coalesce("_p_matched", zero) * F.coalesce("_c_rows", one)).alias("n_matched"),
        F.sum(F.col("_n") * F.coalesce("_p_rows", one) * F.coalesce("_c_matched", zero)).alias("n_matched_customer"))


def match_metrics(retailers: Sequence[str], *, product_flag: str = "level_1_standard",
                  customer_flag: str = "segment_1_standard") -> dict[str, Column]:
    """A10 as aggregates to observe while silver is written: per retailer its
    lines with a product standard and with a customer standard."""
    of = lambda r, flag: F.count_if((F.col(RETAILER) == r) & F.col(flag).isNotNull())
    return {f"{name}_{i}": of(r, flag) for i, r in enumerate(retailers)
            for name, flag in (("n_matched", product_flag), ("n_matched_customer", customer_flag))}


def observed_match_rate(std: DataFrame, retailers: Sequence[str], metrics: dict, *, lines: str | None = None) -> DataFrame:
    """A10 from the values of ``match_metrics``: the feed's lines are counted
    (from column ``lines`` if it carries counts), no map is joined again."""
    n = F.count(F.lit(1)) if lines is None else F.sum(lines)
    rows = [(r, metrics[f"n_matched_{i}"], metrics[f"n_matched_customer_{i}"]) for i, r in enumerate(retailers)]
    counted = std.sparkSession.createDataFrame(rows, f"{RETAILER} string, n_matched long, n_matched_customer long")
    return std.groupBy(RETAILER).agg(n.alias("n_rows")).join(counted, RETAILER)


def distinct_keys(std: DataFrame, *, levels: Sequence[str] = PRODUCT_LEVELS, segments: Sequence[str] = CUSTOMER_SEGMENTS,
                  keys: Sequence[str] = ("product_id", "product_code")) -> DataFrame:
    """The feed's distinct mapping and product keys with their number of lines
    (``n_lines``): what all classification reports need of it."""
    present = [k for k in keys if k in std.columns]
    return std.groupBy(RETAILER, *present, *levels, *segments).agg(F.count(F.lit(1)).alias("n_lines"))


def unmatched_by_keys(std: DataFrame, mapping: DataFrame, natives: Sequence[str],
                      standards: Sequence[str]) -> DataFrame:
    """A8/A9 from the distinct native keys: same result as ``unmatched`` on silver."""
    keys = [RETAILER, *natives]
    m = mapping.select(*keys, *standards)
    mapped = std.select(*keys).distinct().join(m, keys, "left")
    return mapped.filter(any_null(standards)).select(*keys, *standards).distinct()
