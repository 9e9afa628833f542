"""Registered queries: the operators of each stage run on the test feed.

Each query is ``fn(spark, sf_dir) -> DataFrame`` and has a DuckDB twin with
the same name in ``gondola.oracle``.  Amount scale and zero-total rule are the
batch run's own (``gondola.config``), so what is checked is what is shipped.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gondola.config import (
    AMOUNT_SCALE,
    CUSTOMER_SEGMENTS,
    CUSTOMER_STANDARDS,
    FEEDS,
    MISCLASS_COLUMNS,
    PRODUCT_LEVELS,
    PRODUCT_STANDARDS,
    QUANTITY_PATTERN_STRICT,
    SHARE_ON_ZERO,
    YEAR_WIDENING,
    required_defaults,
)
from gondola.functions.text import (
    classification_path,
    clean_department,
    department_from_zip,
    format_quantities,
    parse_amount,
    remove_first_space,
)
from gondola.functions.agg import distinct_non_null_count, null_count
from gondola.operators import extracts as ex
from gondola.operators.kpis import compute_kpis, kpi_grains, kpi_lattice, ordered_positions
from gondola.operators.mapping import build_silver, map_customers, map_products, mapped_product_keys
from gondola.operators.market_share import market_share, market_share_lattice
from gondola.operators.misclassification import (
    comparison_rows,
    misclassification_long,
    misclassification_variants,
)
from gondola.operators.quality import match_rate, unicity_checks, unmatched_by_keys
from gondola.operators.bronze import build_bronze, shape_bronze
from gondola.operators.shaping import (
    add_required_columns,
    assemble_feeds,
    explode_list,
    nullify_placeholder,
    rename_columns,
    slice_period,
    split_exact,
    strip_suffix,
    suffix_columns,
    union_all,
    widen_years,
    with_feed_metadata,
)
from gondola.operators.standardize import (
    fill_empty_columns,
    prepare_customer_map,
    prepare_product_map,
    standardize_feed,
    strip_columns,
    valid_product_id,
)
from gondola.plans.models import MODELS, Model
from gondola.sources.io import CP1252_HIGH, LATIN1_HIGH, decode_cp1252, format_lines, parse_lines, read_folder
from gondola.testfeed import (
    RETAILERS,
    RETAILERS_WITH_ID,
    RETAILERS_WITHOUT_ID,
    TEST_FEEDS,
    FixtureFeed,
)

MIN_PRESENT = 2
LEFT_UNIT_FEED, RIGHT_UNIT_FEED = "africa", "america"


class Stages:
    """Lazy DataFrames of each stage over one scale-factor directory."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.fx = FixtureFeed(spark, sf_dir)

    @cached_property
    def feed(self) -> DataFrame:
        return self.fx.feed

    @cached_property
    def std(self) -> DataFrame:
        return standardize_feed(self.feed, TEST_FEEDS)

    @cached_property
    def pmap(self) -> DataFrame:
        return prepare_product_map(self.fx.product_map, retailers=RETAILERS)

    @cached_property
    def cmap(self) -> DataFrame:
        return prepare_customer_map(self.fx.customer_map, retailers=RETAILERS)

    @cached_property
    def silver(self) -> DataFrame:
        return build_silver(self.std, self.pmap, self.cmap)


# ---------------------------------------------------------------- scans and sinks

# A product name with a separator, a tab, quotes and a space at the edge; an empty unit.
CELLS = {"code": "product_code", "name": "concat(' a;', chr(9), '\"', level_3, '\" ', product_name)", "unit": "nullif(volume_unit, 'L')"}
# Signs of windows-1252 that ISO-8859-1 has not, and some that both have, for the ten digits.
CP1252_WORDS = "€‚œŽ™éüß–Ÿ"


def cells(spark, sf_dir) -> DataFrame:
    return Stages(spark, sf_dir).feed.selectExpr(*[f"{e} AS {c}" for c, e in CELLS.items()])


def _lines(df: DataFrame, sep: str) -> DataFrame:
    """Delimited lines put together by hand: the name always quoted."""
    quoted = F.concat(F.lit('"'), F.replace("name", F.lit('"'), F.lit('""')), F.lit('"'))
    return df.select(F.concat_ws(sep, "code", quoted, F.coalesce("unit", F.lit(""))).alias("line"))


def q_csv_scan(spark, sf_dir):
    return parse_lines(_lines(cells(spark, sf_dir), ";"), "line", list(CELLS), sep=";")


def q_tsv_scan(spark, sf_dir):
    return parse_lines(_lines(cells(spark, sf_dir), "\t"), "line", list(CELLS), sep="\t")


def q_cp1252_scan(spark, sf_dir):
    accented = F.translate("code", "0123456789", CP1252_WORDS)
    latin = F.translate(accented, CP1252_HIGH.replace("\ufffd", ""), "".join(a for a, b in zip(LATIN1_HIGH, CP1252_HIGH) if b != "\ufffd"))
    return cells(spark, sf_dir).select("code", decode_cp1252(F.encode(latin, "ISO-8859-1")).alias("text"))


def q_csv_sink(spark, sf_dir):
    return format_lines(cells(spark, sf_dir))


def q_folder_scan(spark, sf_dir):
    """S5 on the given tables' own flat folder: three of its files as feeds."""
    return read_folder(spark, sf_dir, ["region", "nation", "supplier"])


def q_feed_drop(spark, sf_dir):
    """Two deliveries of a feed that land as files."""
    return build_bronze(spark, "even", [f"{sf_dir}/nation.parquet", f"{sf_dir}/nation.parquet"], fmt="parquet")


# ---------------------------------------------------------------- shaping

# Two distributors' rename maps are tried on each test retailer's rows, ten in all.
RENAME_TRIALS = dict(zip(RETAILERS, zip(list(FEEDS)[:5], list(FEEDS)[5:])))


def as_delivered(df: DataFrame, name: str) -> DataFrame:
    """A canonical frame under the column names of distributor ``name``."""
    return df.withColumnsRenamed({canon: src for src, canon in FEEDS[name].rename.items() if canon in df.columns})


def q_feed_rename(spark, sf_dir):
    feed = Stages(spark, sf_dir).feed
    parts = []
    for retailer, names in RENAME_TRIALS.items():
        for name in names:
            given = as_delivered(feed.filter(F.col("retailer") == retailer), name)
            parts.append(rename_columns(given, FEEDS[name].rename).withColumn("feed", F.lit(name)))
    return union_all(parts)


# Native columns of the five distributors whose files need shaping, one for
# each test retailer's rows.
def bronze_inputs(spark, sf_dir) -> dict[str, list[DataFrame]]:
    """Each feed as two deliveries, in its own column names and column order."""
    feed = Stages(spark, sf_dir).feed
    of = dict(zip(("metro", "pro_a_pro", "relais_dor", "sysco", "transgourmet"), RETAILERS))
    month = F.lpad("month", 2, "0")
    spaced = F.concat(F.substring("turnover", 1, 1), F.lit(" "), F.substring("turnover", 2, 30))
    native = {
        "metro": {"concatenated_gtin": F.concat_ws("|", "product_id", F.when(F.col("level_3") == "S1", F.col("product_code"))),
                  "art_no": F.col("product_code"), "SA": F.col("level_1"), "annee": F.col("year"), "CA_HT": F.col("turnover").cast("double")},
        "pro_a_pro": {"Code Article Interne": F.col("product_code"), "Secteur": F.col("level_1"),
                      "Sous Sous Famille": F.when(F.col("level_3") == "S0", F.lit("0")).otherwise(F.col("level_3")),
                      "Année": F.col("year"), "CA facturé hors taxe": F.col("turnover")},
        "relais_dor": {"Code produit": F.col("product_code"), "Hiérarchie Tout Produit niv 1": F.lit("-"),
                       "Hiérarchie Tout Produit niv 2": F.when(F.col("level_2") == "Brand#1", F.lit("-")).otherwise(F.col("level_2")),
                       "Hiérarchie Tout Produit niv 3": F.when(F.col("level_3") == "S2", F.lit("-")).otherwise(F.col("level_3")),
                       "Hiérarchie Tout Produit niv 4": F.lit("-"), "CP": F.col("zip_code"), "Année de ventes": F.col("year"), "CA": F.col("turnover")},
        "sysco": {"Code article": F.col("product_code"), "Mois civil YY-MM": F.concat(F.lit("2"), F.substring("year", 4, 1), F.lit("-"), month),
                  "CA Brut": spaced, "Température produit": F.col("level_1")},
        "transgourmet": {"Code Article Centrale": F.col("product_code"), "Annee Mois": F.concat("year", month), "Ca Brut": F.col("turnover")},
    }
    out = {}
    for name, retailer in of.items():
        rows = feed.filter(F.col("retailer") == retailer)
        columns = [c.alias(n) for n, c in native[name].items()]
        out[name] = [rows.filter(F.col("year") < "1996").select(*columns), rows.filter(F.col("year") >= "1996").select(*reversed(columns))]
    return out


def q_bronze_feeds(spark, sf_dir):
    """The five shaped feeds, assembled under canonical names."""
    shaped = {name: shape_bronze(name, frames) for name, frames in bronze_inputs(spark, sf_dir).items()}
    canonical = assemble_feeds(shaped, FEEDS)
    return canonical.select("retailer", "product_id", "product_code", "level_1", "level_2", "level_3", "level_4", "zip_code", "year", "month", "turnover")


def q_feed_assembly(spark, sf_dir):
    """Feeds whose columns differ (no month; no ids or brand; zip code), united as text."""
    feed = Stages(spark, sf_dir).feed.withColumn("volume", F.col("volume").cast("int"))
    lacks = {"pomona": ("america", ["month", "zip_code", "volume_unit"]), "ducreux": ("africa", ["product_id", "brand_name", "zip_code", "segment_2", "segment_3"]),
             "relais_dor": ("asia", ["product_id", "department", "volume_unit"]), "metro": ("europe", ["zip_code", "segment_2", "segment_3", "turnover"]),
             "sysco": ("middle_east", ["brand_name", "zip_code", "volume_unit", "segment_3"])}
    frames = {n: as_delivered(feed.filter(F.col("retailer") == r).drop("retailer", *gone), n) for n, (r, gone) in lacks.items()}
    return assemble_feeds(frames, FEEDS)


def q_feed_required_columns(spark, sf_dir):
    feed = Stages(spark, sf_dir).feed
    return add_required_columns(feed, [required_defaults(PRODUCT_LEVELS), required_defaults(CUSTOMER_SEGMENTS)])


def q_feed_union(spark, sf_dir):
    feed = Stages(spark, sf_dir).feed
    early = feed.filter(F.col("year") < "1998")
    late = feed.filter(F.col("year") >= "1998")
    return union_all([early, late.select(*reversed(late.columns))])


def q_gtin_explode(spark, sf_dir):
    feed = Stages(spark, sf_dir).feed
    listed = feed.select(
        "retailer", "product_code",
        F.when(F.col("product_id").isNotNull(), F.concat("product_id", F.lit("|"), "product_code"))
        .alias("concatenated_gtin"))
    return explode_list(listed, "concatenated_gtin", "gtin").select("retailer", "product_code", "gtin")


def period_input(spark, sf_dir) -> DataFrame:
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    yy = F.lpad((F.col("o_orderkey") % 30).cast("string"), 2, "0")
    mm = F.lpad(F.month("o_orderdate").cast("string"), 2, "0")
    yymm = (F.when(F.col("o_orderkey") % 11 == 0, yy)
            .when(F.col("o_orderkey") % 11 == 1, F.concat(yy, F.lit("-"), mm, F.lit("-X")))
            .otherwise(F.concat(yy, F.lit("-"), mm)))
    yyyymm = (F.year("o_orderdate") * 100 + F.month("o_orderdate")).cast("string")
    return orders.select("o_orderkey", yymm.alias("yymm"), yyyymm.alias("yyyymm"))


def q_period_split(spark, sf_dir):
    df = period_input(spark, sf_dir)
    df = split_exact(df, "yymm", "-", ["year_a", "month_a"])
    df = widen_years(df, "year_a", YEAR_WIDENING)
    return slice_period(df, "yyyymm", "year_b", "month_b")


def q_placeholder_null(spark, sf_dir):
    feed = Stages(spark, sf_dir).feed
    dirty = feed.select(
        "retailer", "product_code",
        F.when(F.col("level_1") == "LARGE", F.lit("-")).otherwise(F.col("level_1")).alias("level_1"),
        F.when(F.col("level_2") == "Brand#1", F.lit("-")).otherwise(F.col("level_2")).alias("level_2"),
        F.when(F.col("level_3") == "S0", F.lit("0")).otherwise(F.col("level_3")).alias("level_3"),
        F.when(F.col("segment_3") == "P", F.lit("-")).otherwise(F.col("segment_3")).alias("segment_3"),
    )
    df = nullify_placeholder(dirty, ["level_3"], "0")
    return nullify_placeholder(df, ["level_1", "level_2", "segment_3"], "-")


def q_suffix_columns(spark, sf_dir):
    """P5: one retailer's rows for a comparison beside others."""
    rows = Stages(spark, sf_dir).std.filter(F.col("retailer") == "africa").select("product_id", "product_name", "volume_unit").distinct()
    return suffix_columns(rows, "africa", keep=["product_id"])


def q_strip_suffix(spark, sf_dir):
    """The standard levels under the plain names."""
    return strip_suffix(Stages(spark, sf_dir).pmap.select("retailer", *PRODUCT_STANDARDS).distinct(), "standard")


# ---------------------------------------------------------------- scalar cleaning

def q_row_counts(spark, sf_dir):
    """C10, C11 over the native levels of each line."""
    levels = ["level_1", "level_2", "level_3", "product_id"]
    return Stages(spark, sf_dir).feed.groupBy("retailer", null_count(levels).alias("n_null"), distinct_non_null_count([*levels, "level_1"]).alias("n_distinct")).count()


def q_strip_whitespace(spark, sf_dir):
    feed = Stages(spark, sf_dir).feed
    return strip_columns(feed.select("retailer", "product_code", "level_1"), ["level_1"])


def q_fill_empty(spark, sf_dir):
    feed = Stages(spark, sf_dir).feed
    return fill_empty_columns(feed.select("retailer", "product_code", "level_1", "level_2", "segment_2"), ["level_1", "level_2", "segment_2"])


def q_amount_parse(spark, sf_dir):
    feed = Stages(spark, sf_dir).feed
    comma_volume = F.replace(F.col("volume").cast("string"), F.lit("."), F.lit(","))
    return feed.select(
        "retailer", "product_code",
        parse_amount(F.col("turnover")).alias("turnover"),
        parse_amount(comma_volume, drop_space=False).alias("volume"),
        remove_first_space(F.col("turnover")).alias("turnover_text"),
    )


def q_department_clean(spark, sf_dir):
    feed = Stages(spark, sf_dir).feed
    raw = F.when(F.col("retailer") == "asia", department_from_zip(F.col("zip_code"))).otherwise(F.col("department"))
    return feed.select("retailer", F.col("department").alias("department_raw"), "zip_code",
                       clean_department(raw).alias("department")).distinct()


def q_char_repair(spark, sf_dir):
    # every owner's map under the name of the feed whose levels need the repair
    broken = Stages(spark, sf_dir).fx.product_map.select(
        F.lit("metro").alias("ENTREPRISE"), "level_1", F.replace("level_2", F.lit("#"), F.lit("?")).alias("level_2"), "level_3", *PRODUCT_STANDARDS)
    return prepare_product_map(broken, retailers=["metro"]).select("retailer", "level_2").distinct()


def q_valid_product_filter(spark, sf_dir):
    feed = strip_columns(Stages(spark, sf_dir).feed, ["product_id"])
    kept = F.col("retailer").isin(*RETAILERS_WITHOUT_ID) | valid_product_id(F.col("product_id"))
    return feed.groupBy("retailer").agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(kept).alias("n_kept"))


def q_classification_path(spark, sf_dir):
    feed = Stages(spark, sf_dir).feed
    return feed.select("retailer", classification_path(["level_1", "level_2", "level_3"]).alias("classification")).distinct()


# ---------------------------------------------------------------- standardise and map

def q_standardize_feed(spark, sf_dir):
    return Stages(spark, sf_dir).std


def q_prepare_product_map(spark, sf_dir):
    return Stages(spark, sf_dir).pmap


def q_prepare_customer_map(spark, sf_dir):
    return Stages(spark, sf_dir).cmap


def q_prepare_product_map_no_strip(spark, sf_dir):
    """The oldest model's preparation."""
    model = MODELS[1]
    return prepare_product_map(Stages(spark, sf_dir).fx.product_map, retailers=RETAILERS, standards=model.standards, strip=model.strip_map)


def q_map_products(spark, sf_dir):
    s = Stages(spark, sf_dir)
    return map_products(s.std, s.pmap).select("retailer", "product_id", "product_code", *PRODUCT_LEVELS,
                                              *PRODUCT_STANDARDS)


def q_map_customers(spark, sf_dir):
    s = Stages(spark, sf_dir)
    return map_customers(s.std, s.cmap).select("retailer", "product_id", "product_code", *CUSTOMER_SEGMENTS,
                                               *CUSTOMER_STANDARDS)


def q_silver(spark, sf_dir):
    return Stages(spark, sf_dir).silver


# ---------------------------------------------------------------- quality

def q_match_rate(spark, sf_dir):
    s = Stages(spark, sf_dir)
    return match_rate(s.std, s.pmap, s.cmap)


def q_unmatched_products(spark, sf_dir):
    s = Stages(spark, sf_dir)
    return unmatched_by_keys(s.std, s.pmap, PRODUCT_LEVELS, PRODUCT_STANDARDS)


def q_unmatched_customers(spark, sf_dir):
    s = Stages(spark, sf_dir)
    return unmatched_by_keys(s.std, s.cmap, CUSTOMER_SEGMENTS, CUSTOMER_STANDARDS)


def _unicity(name):
    def fn(spark, sf_dir):
        s = Stages(spark, sf_dir)
        return unicity_checks(mapped_product_keys(s.std, s.pmap), RETAILERS_WITHOUT_ID)[name]
    fn.__name__ = f"q_{name}"
    return fn


# ---------------------------------------------------------------- KPIs and shares

KPI_LEVEL_COLS = {i: ["year", *PRODUCT_STANDARDS[:i]] for i in range(1, 5)}


def _kpis(i):
    def fn(spark, sf_dir):
        return compute_kpis(Stages(spark, sf_dir).silver, KPI_LEVEL_COLS[i], amount_scale=AMOUNT_SCALE)
    fn.__name__ = f"q_kpis_l{i}"
    return fn


def q_kpis_without_id(spark, sf_dir):
    silver = Stages(spark, sf_dir).silver
    no_id = silver.filter(F.col("retailer").isin(*RETAILERS_WITHOUT_ID)).drop("product_id")
    return compute_kpis(no_id, KPI_LEVEL_COLS[1], amount_scale=AMOUNT_SCALE)


def q_kpis_ordered(spark, sf_dir):
    """O1: the rows of a report with their places in its order."""
    kpis = compute_kpis(Stages(spark, sf_dir).silver, KPI_LEVEL_COLS[2], amount_scale=AMOUNT_SCALE)
    return ordered_positions(kpis, ["retailer", *KPI_LEVEL_COLS[2]])


# What each test feed's amounts are
TURNOVER_TYPES = dict(zip(RETAILERS, ["net", "brut", "HT"]))
TYPED_FEEDS = [replace(f, turnover_type=TURNOVER_TYPES.get(f.name, f.turnover_type)) for f in TEST_FEEDS]


def q_kpis_turnover_type(spark, sf_dir):
    kpis = compute_kpis(Stages(spark, sf_dir).silver, KPI_LEVEL_COLS[1], amount_scale=AMOUNT_SCALE)
    return with_feed_metadata(kpis, TYPED_FEEDS)


LATTICE = kpi_grains(4)
LATTICE_MODEL3 = kpi_grains(4, ["", "Dep"])


def q_kpi_lattice(spark, sf_dir):
    return kpi_lattice(Stages(spark, sf_dir).silver, LATTICE, amount_scale=AMOUNT_SCALE)


def q_kpi_lattice_model3(spark, sf_dir):
    return kpi_lattice(Stages(spark, sf_dir).silver, LATTICE_MODEL3, amount_scale=AMOUNT_SCALE)


SHARE_COLS = {
    "market_share_l1": ["year", "level_1_standard"],
    "market_share_l1_dep": ["year", "department", "level_1_standard"],
    "market_share_l1_c1": ["year", "segment_1_standard", "department", "level_1_standard"],
}


def _share(name):
    cols = SHARE_COLS[name]
    kpi_cols = [c for c in ["year", "department", "segment_1_standard"] if c in cols] + ["level_1_standard"]

    def fn(spark, sf_dir):
        kpis = compute_kpis(Stages(spark, sf_dir).silver, kpi_cols, amount_scale=AMOUNT_SCALE)
        return market_share(kpis, cols, on_zero_total=SHARE_ON_ZERO, amount_scale=AMOUNT_SCALE)
    fn.__name__ = f"q_{name}"
    return fn


def q_market_share_lattice(spark, sf_dir):
    lattice = kpi_lattice(Stages(spark, sf_dir).silver, LATTICE, amount_scale=AMOUNT_SCALE)
    return market_share_lattice(lattice, LATTICE, on_zero_total=SHARE_ON_ZERO, amount_scale=AMOUNT_SCALE)


def _model_shares(model_id: int):
    """The share lattice of an older model (2, 3 or 4 levels, with and without department)."""
    grains = MODELS[model_id].grains

    def fn(spark, sf_dir):
        lattice = kpi_lattice(Stages(spark, sf_dir).silver, grains, amount_scale=AMOUNT_SCALE)
        return market_share_lattice(lattice, grains, on_zero_total=SHARE_ON_ZERO, amount_scale=AMOUNT_SCALE)
    return fn


# ---------------------------------------------------------------- misclassification

def q_placeholder_class_filter(spark, sf_dir):
    return comparison_rows(Stages(spark, sf_dir).silver, RETAILERS_WITH_ID)


def _misclass_rows(spark, sf_dir, model: Model) -> DataFrame:
    return comparison_rows(Stages(spark, sf_dir).silver, RETAILERS_WITH_ID, columns=list(model.misclass_columns),
                           placeholder_level=model.placeholder_level)


def _misclass_variants(model: Model):
    def fn(spark, sf_dir):
        return misclassification_variants(_misclass_rows(spark, sf_dir, model), levels=model.standards, min_present=MIN_PRESENT)
    return fn


def q_misclass_long(spark, sf_dir):
    return misclassification_long(_misclass_rows(spark, sf_dir, MODELS[4]), min_present=MIN_PRESENT)


# Four levels with customer segments, without units
NO_UNITS = replace(MODELS[4], misclass_columns=tuple(c for c in MISCLASS_COLUMNS if c != "volume_unit"))


# ---------------------------------------------------------------- extracts

def _volume_extract(pattern=None):
    def fn(spark, sf_dir):
        names = ex.distinct_names(Stages(spark, sf_dir).std)  # left joins add no new names
        q = ex.quantity_extract(names, pattern=pattern) if pattern else ex.quantity_extract(names)
        return q.select("product_name", format_quantities("new_volume_unit").alias("new_volume_unit"),
                        "nb_volume_unit")
    return fn


q_volume_extract = _volume_extract()
q_volume_extract_strict = _volume_extract(QUANTITY_PATTERN_STRICT)


def q_volume_extract_stats(spark, sf_dir):
    return ex.quantity_stats(Stages(spark, sf_dir).std)  # distinct names: the joins add none


def q_volume_missing_sample(spark, sf_dir):
    s = ex.names_without_quantity(Stages(spark, sf_dir).std, n=40, seed=42)
    return s.select("product_name", "nb_volume_unit")


def q_product_sample(spark, sf_dir):
    return ex.product_sample(Stages(spark, sf_dir).silver)


def q_volume_units(spark, sf_dir):
    return ex.volume_units(Stages(spark, sf_dir).std)  # distinct units: the joins add none


def q_volume_units_by_level(spark, sf_dir):
    return ex.volume_units_by_level(Stages(spark, sf_dir).silver, RETAILERS_WITHOUT_ID)


def q_volume_turnover_signs(spark, sf_dir):
    return ex.volume_turnover_signs(Stages(spark, sf_dir).silver)


def q_unit_inconsistency(spark, sf_dir):
    return ex.unit_inconsistency(Stages(spark, sf_dir).silver, LEFT_UNIT_FEED, RIGHT_UNIT_FEED)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "csv_scan": q_csv_scan,
    "tsv_scan": q_tsv_scan,
    "cp1252_scan": q_cp1252_scan,
    "folder_scan": q_folder_scan,
    "feed_drop": q_feed_drop,
    "csv_sink": q_csv_sink,
    "feed_rename": q_feed_rename,
    "bronze_feeds": q_bronze_feeds,
    "feed_assembly": q_feed_assembly,
    "feed_required_columns": q_feed_required_columns,
    "feed_union": q_feed_union,
    "gtin_explode": q_gtin_explode,
    "period_split": q_period_split,
    "placeholder_null": q_placeholder_null,
    "suffix_columns": q_suffix_columns,
    "strip_suffix": q_strip_suffix,
    "strip_whitespace": q_strip_whitespace,
    "fill_empty": q_fill_empty,
    "amount_parse": q_amount_parse,
    "department_clean": q_department_clean,
    "char_repair": q_char_repair,
    "row_counts": q_row_counts,
    "valid_product_filter": q_valid_product_filter,
    "classification_path": q_classification_path,
    "standardize_feed": q_standardize_feed,
    "prepare_product_map": q_prepare_product_map,
    "prepare_customer_map": q_prepare_customer_map,
    "prepare_product_map_no_strip": q_prepare_product_map_no_strip,
    "map_products": q_map_products,
    "map_customers": q_map_customers,
    "silver": q_silver,
    "match_rate": q_match_rate,
    "unmatched_products": q_unmatched_products,
    "unmatched_customers": q_unmatched_customers,
    "unicity_id_levels": _unicity("unicity_id_levels"),
    "unicity_code_levels": _unicity("unicity_code_levels"),
    "unicity_code_ids": _unicity("unicity_code_ids"),
    "kpis_l1": _kpis(1),
    "kpis_l2": _kpis(2),
    "kpis_l3": _kpis(3),
    "kpis_l4": _kpis(4),
    "kpis_without_id": q_kpis_without_id,
    "kpis_ordered": q_kpis_ordered,
    "kpis_turnover_type": q_kpis_turnover_type,
    "kpi_lattice": q_kpi_lattice,
    "kpi_lattice_model3": q_kpi_lattice_model3,
    "market_share_l1": _share("market_share_l1"),
    "market_share_l1_dep": _share("market_share_l1_dep"),
    "market_share_l1_c1": _share("market_share_l1_c1"),
    "market_share_lattice": q_market_share_lattice,
    "market_share_model1": _model_shares(1),
    "market_share_model2": _model_shares(2),
    "market_share_model3": _model_shares(3),
    "placeholder_class_filter": q_placeholder_class_filter,
    "misclass_variants": _misclass_variants(MODELS[4]),
    "misclass_long": q_misclass_long,
    "misclass_two_levels": _misclass_variants(MODELS[1]),
    "misclass_three_levels": _misclass_variants(MODELS[2]),
    "misclass_no_units": _misclass_variants(NO_UNITS),
    "volume_extract": q_volume_extract,
    "volume_extract_strict": q_volume_extract_strict,
    "volume_extract_stats": q_volume_extract_stats,
    "volume_missing_sample": q_volume_missing_sample,
    "product_sample": q_product_sample,
    "volume_units": q_volume_units,
    "volume_units_by_level": q_volume_units_by_level,
    "volume_turnover_signs": q_volume_turnover_signs,
    "unit_inconsistency": q_unit_inconsistency,
}
