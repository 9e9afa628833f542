"""Cross-retailer misclassification.

A product (shared ``product_id``) is misclassified when some combination of
its retailers' variants (one row from each retailer that sells it) shows, at
once, at least ``min_present`` retailers with a non-null level 1 (F5) and two
different non-null values at some compared level (F6, C11).

The combinations are never built.  A conflict needs two retailers with two
values; all other retailers can show a level 1 if they have one.  So a pair of
(retailer, value) entries costs, of the product's retailers with a level 1,
those whose value only stands on rows without one.  The cheapest pair decides,
and whether an entry has a partner differing in both retailer and value follows
from counts: entries, less those of its retailer, less those of its value.
Everything is aggregation on ``product_id`` over distinct entries.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gondola.config import ITEM_PLACEHOLDERS, MISCLASS_COLUMNS, PRODUCT_STANDARDS

RETAILER = "retailer"
KEY = "product_id"


def comparison_rows(silver: DataFrame, retailers: Sequence[str], *,
                    columns: Sequence[str] = MISCLASS_COLUMNS,
                    placeholder_level: str | None = "level_4_standard",
                    placeholders: Sequence[str] = ITEM_PLACEHOLDERS) -> DataFrame:
    """Per-retailer distinct comparison rows (select -> A11 -> F4).

    ``NOT IN`` keeps three-valued logic: a null ``placeholder_level`` drops
    the row too.
    """
    df = silver.filter(F.col(RETAILER).isin(*retailers)).select(RETAILER, KEY, *columns)
    if placeholder_level is not None:
        df = df.filter(~F.col(placeholder_level).isin(*placeholders))
    return df.distinct()


def _compared_levels(levels: Sequence[str], compat_level4: bool) -> list[str]:
    levels = list(levels)
    if compat_level4 and len(levels) >= 4:
        # the source builds its fourth list from the level-3 columns
        levels[3] = levels[2]
    return levels


def _by_product(rows: DataFrame) -> DataFrame:
    """``rows`` dealt by product once: a product's entries and windows and the join
    with the misclassified products find them there and exchange nothing more.  As
    many partitions as the session's shuffles have, as so many steps in one task
    are to have few rows each."""
    return rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), KEY)


def _entries(rows: DataFrame, levels: Sequence[str], presence_level: str) -> DataFrame:
    """Distinct (product, level, retailer, value) with ``shown``: some row of the
    retailer holds the value beside a level 1."""
    used = list(dict.fromkeys([presence_level, *levels]))
    stacked = rows.select(KEY, RETAILER, F.col(presence_level).isNotNull().alias("shown"), F.inline(F.array(*[
        F.struct(F.lit(c).alias("level"), F.col(c).cast("string").alias("value")) for c in used]))
    ).filter(F.col("value").isNotNull())
    return stacked.groupBy(KEY, "level", RETAILER, "value").agg(F.max("shown").alias("shown"))


def conflicting_products(rows: DataFrame, *, levels: Sequence[str] = PRODUCT_STANDARDS,
                         min_present: int = 2, presence_level: str = "level_1_standard",
                         compat_level4: bool = False) -> DataFrame:
    """Product ids for which some combination of variants has ``min_present``
    retailers with a level 1 and a conflict."""
    compared = list(dict.fromkeys(_compared_levels(levels, compat_level4)))
    e = _entries(rows, compared, presence_level)
    of_product = Window.partitionBy(KEY)
    present = F.max((F.col("level") == presence_level).cast("int")).over(Window.partitionBy(KEY, RETAILER)) == 1
    e = e.withColumn("present", present)
    # at most one entry of the set for each retailer
    e = e.withColumn("n_present", F.size(F.collect_set(F.when(F.col("present"), F.col(RETAILER))).over(of_product)))
    e = e.filter(F.col("level").isin(*compared)).withColumn("free", (F.col("shown") | ~F.col("present")).cast("int"))

    def partners(weight: Column) -> Column:
        """Entries differing in both retailer and value, counting ``weight``."""
        at = lambda *k: F.sum(weight).over(Window.partitionBy(KEY, "level", *k))
        return at() - at(RETAILER) - at("value") + weight

    e = e.withColumns({"_all": partners(F.lit(1)), "_free": partners(F.col("free"))})
    loss = (F.when((F.col("free") == 1) & (F.col("_free") > 0), 0)
            .when((F.col("free") == 1) & (F.col("_all") > 0), 1).when(F.col("_all") > 0, 2))
    best = e.groupBy(KEY).agg(F.max("n_present").alias("n_present"), F.min(loss).alias("loss"))
    return best.filter(F.col("n_present") - F.col("loss") >= min_present).select(KEY)


def misclassification_variants(rows: DataFrame, *, levels: Sequence[str] = PRODUCT_STANDARDS, min_present: int = 2,
                               compat_level4: bool = False) -> DataFrame:
    """Every retailer's variants of the misclassified products, one row each.

    Holds the columns of a variant together (which name goes with which
    classification, unit and segments); its size is linear in the input, where
    the combinations of the retailers' variants would multiply.
    """
    rows = _by_product(rows)
    bad = conflicting_products(rows, levels=levels, min_present=min_present, compat_level4=compat_level4)
    return rows.join(bad, KEY, "left_semi")


def misclassification_long(rows: DataFrame, *, levels: Sequence[str] = PRODUCT_STANDARDS,
                           min_present: int = 2, compat_level4: bool = False) -> DataFrame:
    """R5 long: one row per misclassified product x level x standard value
    with the retailers using it (sorted, comma-joined)."""
    rows = _by_product(rows)
    bad = conflicting_products(rows, levels=levels, min_present=min_present, compat_level4=compat_level4)
    kept = rows.join(bad, KEY, "left_semi")
    stacked = kept.select(
        KEY, RETAILER,
        F.inline(F.array(*[F.struct(F.lit(c).alias("level"), F.col(c).cast("string").alias("standard"))
                           for c in levels])),
    ).filter(F.col("standard").isNotNull())
    return stacked.groupBy(KEY, "level", "standard").agg(
        F.array_join(F.array_sort(F.collect_set(RETAILER)), ",").alias("retailers"))
