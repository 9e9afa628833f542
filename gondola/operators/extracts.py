"""Exploratory extracts on silver."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gondola.config import PRODUCT_STANDARDS, QUANTITY_PATTERN
from gondola.functions.agg import safe_div
from gondola.functions.text import extract_quantities, parse_amount
from gondola.operators.kpis import incremental_sublists

RETAILER = "retailer"


def any_row_per_key(df: DataFrame, subset: Sequence[str]) -> DataFrame:
    """Distinct on ``subset`` keeping one deterministic row per key.

    The kept row is the smallest by the remaining columns (nulls first).  A
    ``min`` over a struct aggregates map-side, so a huge key group is reduced
    in every partition before the shuffle instead of being sorted in one task.
    """
    subset = list(subset)
    others = [c for c in df.columns if c not in subset]
    if not others:
        return df.select(*subset).distinct()
    return (df.groupBy(*subset).agg(F.min(F.struct(*others)).alias("_row"))
            .select(*subset, *[F.col("_row")[c].alias(c) for c in others]))


def product_sample(silver: DataFrame, retailers: Sequence[str] | None = None) -> DataFrame:
    """One representative silver row per retailer x levels x unit."""
    df = silver if retailers is None else silver.filter(F.col(RETAILER).isin(*retailers))
    subset = [RETAILER] + [c for c in df.columns if c.startswith("level")] + ["volume_unit"]
    return any_row_per_key(df, subset)


def volume_units(silver: DataFrame) -> DataFrame:
    """Distinct units per retailer."""
    return silver.select(RETAILER, "volume_unit").distinct()


def product_key(without_id: Sequence[str]) -> Column:
    """Product id, or the product code for feeds without ids."""
    if not without_id:
        return F.col("product_id")
    return F.when(F.col(RETAILER).isin(*without_id), F.col("product_code")).otherwise(F.col("product_id"))


def volume_units_by_level(silver: DataFrame, without_id: Sequence[str], *,
                          standards: Sequence[str] = PRODUCT_STANDARDS) -> DataFrame:
    """Distinct products per unit x level prefix, one table for all prefixes."""
    # one scan: distinct products at the finest prefix, emitted for every prefix
    standards = list(standards)
    fine = silver.select(RETAILER, "volume_unit", *standards, product_key(without_id).alias("_product")).distinct()
    per_prefix = F.inline(F.array(*[
        F.struct(F.lit(f"level_{i}").alias("grain"),
                 *[(F.col(c) if c in levels else F.lit(None).cast("string")).alias(c) for c in standards])
        for i, levels in enumerate(incremental_sublists(standards), start=1)]))
    cell = ["grain", RETAILER, "volume_unit", *standards]
    # a null product is a value too
    products = fine.select(RETAILER, "volume_unit", "_product", per_prefix).select(*cell, "_product").distinct()
    return products.groupBy(*cell).agg(F.count(F.lit(1)).cast("int").alias("nb_products"))


def quantity_extract(names: DataFrame, column: str = "product_name",
                     pattern: str = QUANTITY_PATTERN) -> DataFrame:
    """C13/C14 + C15 on the given rows: quantities found and their number."""
    q = extract_quantities(F.col(column), pattern)
    return names.withColumn("new_volume_unit", q).withColumn("nb_volume_unit", F.size("new_volume_unit"))


def distinct_names(silver: DataFrame, by_retailer: bool = False) -> DataFrame:
    cols = [RETAILER, "product_name"] if by_retailer else ["product_name"]
    return silver.select(*cols).distinct()


def quantity_stats(silver: DataFrame, pattern: str = QUANTITY_PATTERN) -> DataFrame:
    """A15 + W4: per retailer, how many distinct names hold 0, 1, 2... quantities,
    and that count's share of the retailer's names."""
    q = quantity_extract(distinct_names(silver, by_retailer=True), pattern=pattern)
    counts = q.groupBy(RETAILER, "nb_volume_unit").agg(F.count(F.lit(1)).alias("nb_products"))
    total = F.sum("nb_products").over(Window.partitionBy(RETAILER))
    return counts.withColumn("rate", safe_div(F.col("nb_products"), total)).select(
        RETAILER, "nb_volume_unit", "nb_products", "rate")


def names_without_quantity(silver: DataFrame, n: int = 40, seed: int = 0,
                           pattern: str = QUANTITY_PATTERN) -> DataFrame:
    """F9 + O2: a sample of ``n`` distinct names with no quantity.

    The sample order is the MD5 of seed and name, then the name, so it does not
    depend on partitioning, and ``limit`` after it plans as a top-k, not a full sort.
    """
    q = quantity_extract(distinct_names(silver), pattern=pattern).filter(F.col("nb_volume_unit") == 0)
    return q.orderBy(F.md5(F.concat(F.lit(str(seed)), F.col("product_name"))), "product_name").limit(n).select(
        "product_name", "new_volume_unit", "nb_volume_unit")


def volume_turnover_signs(silver: DataFrame) -> DataFrame:
    """A16 + F7: six counts of sign classes of volume x turnover per retailer
    (a null volume counts as zero volume; a null turnover as zero turnover
    only in ``v0t0``)."""
    v = F.col("volume")
    if dict(silver.dtypes).get("volume") == "string":
        v = parse_amount(v)
    t = F.col("turnover")
    v0 = (v == 0) | v.isNull()
    return silver.groupBy(RETAILER).agg(
        F.count_if(v0 & (t > 0)).alias("v0tp"),
        F.count_if(v0 & (t < 0)).alias("v0tn"),
        F.count_if(v0 & ((t == 0) | t.isNull())).alias("v0t0"),
        F.count_if((v < 0) & (t > 0)).alias("vntp"),
        F.count_if((v < 0) & (t < 0)).alias("vntn"),
        F.count_if((v > 0) & (t < 0)).alias("vptn"),
    )


def unit_inconsistency(silver: DataFrame, left: str, right: str,
                       columns: Sequence[str] = ("product_name", "volume", "volume_unit")) -> DataFrame:
    """J4 + F8 + A17: products both retailers sell with different units.

    One row per product: the smallest (left, right) pair of rows, ordered by
    the left row's columns then the right's, among pairs whose units differ.
    Found with per-(product, unit) minima and one-row-per-product joins, so
    the two sides' rows are never paired up.
    """
    cols = list(columns)
    unit = "volume_unit"
    rest = [c for c in cols if c != unit]

    def side(name):
        s = silver.filter(F.col(RETAILER) == F.lit(name)).select("product_id", *cols)
        s = s.filter(F.col(unit).isNotNull())  # a null unit never differs (F8)
        per_unit = s.groupBy("product_id", unit).agg(F.min(F.struct(*rest)).alias("_m"))
        return per_unit.select("product_id", F.struct(*[F.col("_m")[c].alias(c) if c != unit else F.col(unit)
                                                        for c in cols]).alias("row"))

    a, b = side(left), side(right)
    b_units = b.groupBy("product_id").agg(
        F.count_distinct(F.col("row")[unit]).alias("_nb"), F.min(F.col("row")[unit]).alias("_ub"))
    a_best = (a.join(b_units, "product_id")
              .filter((F.col("_nb") >= 2) | (F.col("row")[unit] != F.col("_ub")))
              .groupBy("product_id").agg(F.min("row").alias("a")))
    b_best = (b.join(a_best, "product_id")
              .filter(F.col("row")[unit] != F.col("a")[unit])
              .groupBy("product_id").agg(F.min("row").alias("b"), F.first("a").alias("a")))
    return b_best.select(
        "product_id",
        *[F.col("a")[c].alias(f"{c}_{left}") for c in cols],
        *[F.col("b")[c].alias(f"{c}_{right}") for c in cols],
    )
