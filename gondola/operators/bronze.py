"""Raw feed -> bronze shaping, one rule set per distributor.

Each feed is delivered as one or more files (per year, per category or per
sheet) that are concatenated by name, then gets its own small set of fixes
before it is written to the bronze layer.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gondola.config import YEAR_WIDENING
from gondola.functions.text import remove_first_space
from gondola.operators.shaping import (
    explode_list,
    nullify_placeholder,
    slice_period,
    split_exact,
    union_all,
    widen_years,
)

# FIXED VALUES: source columns touched by the per-feed bronze fixes.
METRO_GTIN_LIST = "concatenated_gtin"
METRO_GTIN = "gtin"
PRO_A_PRO_ZERO_PLACEHOLDER = ["Sous Sous Famille"]
RELAIS_DOR_DASH_PLACEHOLDER = [
    "Hiérarchie Tout Produit niv 2",
    "Hiérarchie Tout Produit niv 3",
    "Hiérarchie Tout Produit niv 4",
]
SYSCO_PERIOD = "Mois civil YY-MM"
SYSCO_AMOUNT = "CA Brut"
TRANSGOURMET_PERIOD = "Annee Mois"


def _metro(df: DataFrame) -> DataFrame:
    # one row per GTIN; every measure is repeated on each (the source does the same)
    return explode_list(df, METRO_GTIN_LIST, METRO_GTIN)


def _pro_a_pro(df: DataFrame) -> DataFrame:
    return nullify_placeholder(df, [c for c in PRO_A_PRO_ZERO_PLACEHOLDER if c in df.columns], "0")


def _relais_dor(df: DataFrame) -> DataFrame:
    return nullify_placeholder(df, [c for c in RELAIS_DOR_DASH_PLACEHOLDER if c in df.columns], "-")


def _sysco(df: DataFrame) -> DataFrame:
    df = split_exact(df, SYSCO_PERIOD, "-", ["year", "month"])
    df = widen_years(df, "year", YEAR_WIDENING)
    return df.withColumn(SYSCO_AMOUNT, remove_first_space(F.col(f"`{SYSCO_AMOUNT}`")))


def _transgourmet(df: DataFrame) -> DataFrame:
    return slice_period(df, TRANSGOURMET_PERIOD, year="Annee", month="Mois")


BRONZE_FIXES: dict[str, Callable[[DataFrame], DataFrame]] = {
    "metro": _metro,
    "pro_a_pro": _pro_a_pro,
    "relais_dor": _relais_dor,
    "sysco": _sysco,
    "transgourmet": _transgourmet,
}


def shape_bronze(name: str, frames: Sequence[DataFrame]) -> DataFrame:
    """Concatenate a feed's files by column name (U1) and apply its fixes."""
    df = union_all(list(frames))
    fix = BRONZE_FIXES.get(name)
    return fix(df) if fix else df


def build_bronze(spark: SparkSession, name: str, paths: Sequence[str], *, fmt: str = "csv",
                 **read_options) -> DataFrame:
    """Read a feed's files (CSV ``;``, TSV or parquet), shape them and tag the
    retailer, ready for ``gondola.sources.io.write_layer``."""
    from gondola.sources.io import read_delimited, read_parquet, read_tsv

    readers = {"csv": read_delimited, "tsv": read_tsv, "parquet": read_parquet}
    frames = [readers[fmt](spark, p, **read_options) if fmt != "parquet" else read_parquet(spark, p)
              for p in paths]
    return shape_bronze(name, frames).withColumn("retailer", F.lit(name))
