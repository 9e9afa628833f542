"""Feed and correspondence-table standardisation.

All feeds are processed as one long frame keyed by ``retailer``; per-feed
differences (no product id, department from zip code, constant columns) are
column expressions on that key, so one plan serves every feed and nothing
loops over data on the driver.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from gondola.config import (
    CHAR_REPAIR,
    CUSTOMER_MAP_OWNER,
    CUSTOMER_SEGMENTS,
    CUSTOMER_STANDARDS,
    INVALID_PRODUCT_IDS,
    NOT_FILLED,
    PRODUCT_LEVELS,
    PRODUCT_MAP_OWNER,
    PRODUCT_STANDARDS,
    STRIP_COLUMNS,
    FeedSpec,
    feeds_with_zip,
    feeds_without_id,
    required_defaults,
)
from gondola.functions.text import (
    amount_text,
    cast_amount,
    department_from_zip,
    fill_empty,
    replace_first,
    strip_chars,
    strip_department_prefix,
    strip_edges,
    zero_fill,
)
from gondola.operators.shaping import add_required_columns, set_constants_by_retailer

RETAILER = "retailer"


def strip_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """C1 on the listed columns that exist."""
    cols = {c: strip_chars(c) for c in columns if c in df.columns}
    return df.withColumns(cols) if cols else df


def strip_together(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """C1 on the listed columns that exist, in one projection.

    Spark computes a projection with a lambda apart from the scans and joins below
    and the projections above it, in short methods.  As part of one generated
    method with these the cleaning has more than the 8,000 bytes beyond which the
    JVM compiles nothing, and runs several times slower.
    """
    columns = [c for c in columns if c in df.columns]
    if not columns:
        return df
    texts = df.withColumns({c: F.col(f"`{c}`").cast("string") for c in columns})
    return texts.withColumns({c: strip_edges(c) for c in columns})


def fill_empty_columns(df: DataFrame, columns: Sequence[str], value: str = NOT_FILLED) -> DataFrame:
    """C2 (``handle_empty``) on the listed columns."""
    return df.withColumns({c: fill_empty(c, value) for c in columns})


def valid_product_id(c: Column) -> Column:
    """not null and not one of the placeholder ids."""
    return F.coalesce(~c.isin(*INVALID_PRODUCT_IDS), F.lit(False))


def _in(retailers: Sequence[str]) -> Column:
    return F.col(RETAILER).isin(*retailers) if retailers else F.lit(False)


def standardize_feed(
    df: DataFrame,
    feeds: Sequence[FeedSpec],
    *,
    levels: Sequence[str] = PRODUCT_LEVELS,
    segments: Sequence[str] = CUSTOMER_SEGMENTS,
    strip: Sequence[str] = STRIP_COLUMNS,
    strict_amounts: bool = True,
) -> DataFrame:
    """Required columns -> strip -> fill empty -> amounts -> department
    -> valid product ids -> feed constants, in that order.

    ``df`` holds canonical column names (after ``rename_columns``) and a
    ``retailer`` column; ``feeds`` describes each retailer present.
    """
    given = [c for c in strip if c in df.columns]
    df = add_required_columns(df, [required_defaults(levels), required_defaults(segments)])
    df = strip_together(df, given)
    df = strip_columns(df, [c for c in strip if c not in given])
    df = fill_empty_columns(df, list(levels) + list(segments))

    # amounts in two projections: the normalised text is computed once and
    # not inlined into every branch of the validating cast
    texts = [c for c in ("turnover", "volume")
             if c in df.columns and isinstance(df.schema[c].dataType, StringType)]
    if texts:
        df = df.withColumns({c: amount_text(F.col(c)) for c in texts})
        df = df.withColumns({c: cast_amount(F.col(c), strict=strict_amounts) for c in texts})

    zip_feeds = feeds_with_zip(feeds)
    if zip_feeds and "zip_code" in df.columns:
        from_zip = department_from_zip(F.col("zip_code"))
        dep = (F.when(_in(zip_feeds), from_zip).otherwise(F.col("department").cast("string"))
               if "department" in df.columns else from_zip)
        df = df.withColumn("department", dep)
    if "department" in df.columns:
        df = df.withColumn("department", strip_department_prefix(F.col("department")))
        df = df.withColumn("department", zero_fill(F.col("department")))

    if "product_id" in df.columns:
        no_id = feeds_without_id(feeds)
        df = df.filter(_in(no_id) | valid_product_id(F.col("product_id")))

    constants = {f.name: f.add_columns for f in feeds if f.add_columns}
    return set_constants_by_retailer(df, constants, RETAILER)


def _prepare_map(
    mapping: DataFrame,
    owner: str,
    natives: Sequence[str],
    standards: Sequence[str],
    retailers: Sequence[str] | None,
    char_repair: Mapping[str, tuple[str, str]],
    strip: bool,
) -> DataFrame:
    df = mapping.withColumnRenamed(owner, RETAILER)
    if retailers is not None:
        df = df.filter(F.col(RETAILER).isin(*retailers))  # F2, one read for all feeds
    df = add_required_columns(df, [required_defaults(natives), required_defaults(standards)])
    # empties are filled *before* stripping: a whitespace-only cell ends up ''
    df = fill_empty_columns(df, natives)
    if strip:
        df = strip_columns(df, df.columns)
    if char_repair:
        repaired = {}
        for c in natives:
            expr = None
            for retailer, (pattern, repl) in char_repair.items():
                cond = F.col(RETAILER) == F.lit(retailer)
                val = replace_first(F.col(c).cast("string"), pattern, repl)
                expr = F.when(cond, val) if expr is None else expr.when(cond, val)
            repaired[c] = expr.otherwise(F.col(c))
        df = df.withColumns(repaired)
    return df.select(RETAILER, *natives, *standards)


def prepare_product_map(
    mapping: DataFrame,
    *,
    retailers: Sequence[str] | None = None,
    levels: Sequence[str] = PRODUCT_LEVELS,
    standards: Sequence[str] = PRODUCT_STANDARDS,
    owner: str = PRODUCT_MAP_OWNER,
    char_repair: Mapping[str, tuple[str, str]] = CHAR_REPAIR,
    strip: bool = True,
) -> DataFrame:
    """R2: owner filter -> required columns -> fill empty -> strip -> char repair."""
    return _prepare_map(mapping, owner, levels, standards, retailers, char_repair, strip)


def prepare_customer_map(
    mapping: DataFrame,
    *,
    retailers: Sequence[str] | None = None,
    segments: Sequence[str] = CUSTOMER_SEGMENTS,
    standards: Sequence[str] = CUSTOMER_STANDARDS,
    owner: str = CUSTOMER_MAP_OWNER,
    strip: bool = True,
) -> DataFrame:
    """Same steps as R2 on the customer correspondence table."""
    return _prepare_map(mapping, owner, segments, standards, retailers, {}, strip)


def union_feed_maps(frames: Mapping[str, DataFrame], feeds: Sequence[FeedSpec],
                    owner: str = PRODUCT_MAP_OWNER) -> DataFrame:
    """Model 1 (Q11): one correspondence sheet per feed, written with that
    feed's native column names.  Each is renamed with its feed's map, tagged
    with its owner and the sheets are concatenated by name (missing columns
    become null, then ``NON RENSEIGNE`` in the preparation)."""
    from gondola.operators.shaping import rename_columns, union_all

    by_name = {f.name: f for f in feeds}
    parts = [rename_columns(df, by_name[name].rename).withColumn(owner, F.lit(name))
             for name, df in frames.items()]
    return union_all(parts, allow_missing=True)
