"""Batch run of one nomenclature model: bronze -> silver -> reports.

Silver is written by product-id route and retailer and read back before the
reports: that cuts the lineage, so an executor lost while computing the
twenty-grain lattice re-reads silver files instead of recomputing the mapping
from raw feeds.  Match counts are observed by that write.  The distinct keys of
the feed are written once too; unmatched keys and unicity checks run from that
table.  All feeds run as one job keyed by ``retailer``; the driver only loops
over feeds and reports.  A run on a folder that has an earlier run's results
reads nothing of it and leaves none of its reports standing.
"""

from __future__ import annotations

import os
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gondola.config import (
    AMOUNT_SCALE,
    CUSTOMER_SEGMENTS,
    CUSTOMER_STANDARDS,
    PRODUCT_LEVELS,
    PRODUCT_STANDARDS,
    SHARE_ON_ZERO,
    SILVER_COLUMNS,
    FeedSpec,
    feeds_with_id,
    feeds_without_id,
)
from gondola.operators.extracts import product_sample, volume_units
from gondola.operators.kpis import kpi_lattice, lattice_columns, order_report
from gondola.operators.mapping import build_silver, mapped_product_keys
from gondola.operators.market_share import market_share_lattice
from gondola.operators.misclassification import (
    comparison_rows,
    misclassification_long,
    misclassification_variants,
)
from gondola.operators.quality import distinct_keys, match_metrics, observed_match_rate, unicity_checks, unmatched_by_keys
from gondola.operators.shaping import add_required_columns, assemble_feeds, feed_catalog
from gondola.operators.standardize import (
    prepare_customer_map,
    prepare_product_map,
    standardize_feed,
    union_feed_maps,
)
from gondola.plans.models import MODELS, Model
from gondola.sources.io import (
    layer_feeds,
    read_delimited,
    read_silver,
    remove,
    write_delimited,
    write_report,
    write_silver,
)

#: Every report that some run writes.
REPORTS = ("match_rate", "unmatched_levels_pdt", "unmatched_levels_customer", "unicity_id_levels", "unicity_code_levels",
           "unicity_code_ids", "misclassification", "misclassification_long", "feeds", "kpis", "market_share")

#: With n feeds that have product ids, a misclassified product is shown by at
#: least n - 5 of them, and by two.
PRESENT_SLACK = 5


def load_feeds(spark: SparkSession, bronze_root: str, feeds: Sequence[FeedSpec]) -> DataFrame:
    """The bronze layer's feeds under canonical names in one frame (Q5), with
    every line column that silver has (null where no feed gives it)."""
    feed = assemble_feeds(layer_feeds(spark, bronze_root, [f.name for f in feeds]), {f.name: f for f in feeds})
    mapped = {*PRODUCT_LEVELS, *CUSTOMER_SEGMENTS, *PRODUCT_STANDARDS, *CUSTOMER_STANDARDS}
    return add_required_columns(feed, {c: None for c in SILVER_COLUMNS if c not in mapped})


def load_product_map(spark: SparkSession, source: str | Mapping[str, str], model: Model, feeds: Sequence[FeedSpec]) -> DataFrame:
    """A model's product correspondence table: one delimited file in the model's
    encoding, or (model 1) one sheet per feed under that feed's column names."""
    if model.map_rename:
        if isinstance(source, str):
            raise ValueError(f"model {model.model_id} reads one sheet per feed: pass {{feed: path}}")
        return union_feed_maps({n: read_delimited(spark, p, encoding=model.map_encoding) for n, p in source.items()}, feeds)
    return read_delimited(spark, source, encoding=model.map_encoding)


def run_from_bronze(spark: SparkSession, bronze_root: str, product_map: str | Mapping[str, str], customer_map: str | None,
                    feeds: Sequence[FeedSpec], out_root: str, *, model_id: int = 4, **options) -> dict[str, str]:
    """``run_model`` on a written bronze layer and delimited correspondence tables."""
    model = MODELS[model_id]
    customers = read_delimited(spark, customer_map, encoding=model.map_encoding) if customer_map and model.customer_mapping else None
    return run_model(spark, load_feeds(spark, bronze_root, feeds), load_product_map(spark, product_map, model, feeds), customers, feeds,
                     out_root, model_id=model_id, **options)


def key_reports(keys: DataFrame, product_map: DataFrame, customer_map: DataFrame, feeds: Sequence[FeedSpec], model: Model,
                matched: dict) -> dict[str, DataFrame]:
    """Reports on classification (A6-A10) from the feed's distinct keys, in order;
    ``matched`` are the counts observed while silver was written."""
    reports = {"match_rate": observed_match_rate(keys, [f.name for f in feeds], matched, lines="n_lines"),
               "unmatched_levels_pdt": unmatched_by_keys(keys, product_map, PRODUCT_LEVELS, model.standards)}
    if model.customer_mapping:
        reports["unmatched_levels_customer"] = unmatched_by_keys(keys, customer_map, CUSTOMER_SEGMENTS, CUSTOMER_STANDARDS)
    classified = mapped_product_keys(keys, product_map, standards=model.standards)
    reports.update(unicity_checks(classified, feeds_without_id(feeds), standards=model.standards))
    return {name: order_report(df, df.columns) for name, df in reports.items()}


def misclassification_reports(silver: DataFrame, feeds: Sequence[FeedSpec], model: Model, *, min_present: int | None = None,
                              compat_level4: bool = False) -> dict[str, DataFrame]:
    """The variants of misclassified products and their conflicts, long."""
    with_id = feeds_with_id(feeds)
    if min_present is None:
        min_present = max(2, len(with_id) - PRESENT_SLACK)
    rows = comparison_rows(silver, with_id, columns=list(model.misclass_columns),
                           placeholder_level=model.placeholder_level, placeholders=model.placeholders)
    options = {"levels": model.standards, "min_present": min_present, "compat_level4": compat_level4}
    return {"misclassification": misclassification_variants(rows, **options),
            "misclassification_long": misclassification_long(rows, **options)}


def run_model(spark: SparkSession, feed: DataFrame, product_map: DataFrame, customer_map: DataFrame | None,
              feeds: Sequence[FeedSpec], out_root: str, *, model_id: int = 4,
              min_present: int | None = None, compat: bool = False) -> dict[str, str]:
    """Standardise, map and write silver, then write every report and extract.

    ``feed`` holds all feeds in canonical names with a ``retailer`` column.
    ``compat`` reproduces the source's fourth misclassification level.  Empty
    classification reports are not written.  Returns {report name: path}.
    """
    model = MODELS[model_id]
    names = [f.name for f in feeds]
    std = standardize_feed(feed, feeds)
    pmap = prepare_product_map(product_map, retailers=names, standards=model.standards, strip=model.strip_map)
    if customer_map is not None and model.customer_mapping:
        cmap = prepare_customer_map(customer_map, retailers=names)
    else:
        cmap = _empty_customer_map(spark)
    out = {"silver": os.path.join(out_root, "silver"), "keys": os.path.join(out_root, "keys")}
    built = build_silver(std, pmap, cmap, product_standards=model.standards)
    run = write_silver(built, out["silver"], feeds_without_id(feeds), metrics=match_metrics(names))
    silver = read_silver(spark, out["silver"], run=run.run)
    distinct_keys(std).write.mode("overwrite").parquet(out["keys"])
    report_root = os.path.join(out_root, "reports")
    for name, df in key_reports(spark.read.parquet(out["keys"]), pmap, cmap, feeds, model, run.metrics).items():
        if write_report(df, report_root, name, skip_empty=True):
            out[name] = os.path.join(report_root, name)
    reports = misclassification_reports(silver, feeds, model, min_present=min_present, compat_level4=compat)
    reports["feeds"] = feed_catalog(spark, feeds)
    order = ["grain", "retailer", *lattice_columns(model.grains)]
    write_report(order_report(kpi_lattice(silver, model.grains, amount_scale=AMOUNT_SCALE), order), report_root, "kpis")
    out["kpis"] = os.path.join(report_root, "kpis")
    # the lattice is written once; shares are computed from the written table
    shares = market_share_lattice(spark.read.parquet(out["kpis"]), model.grains, on_zero_total=SHARE_ON_ZERO, amount_scale=AMOUNT_SCALE)
    reports["market_share"] = order_report(shares, order)
    for name, df in reports.items():
        write_report(df, report_root, name)
        out[name] = os.path.join(report_root, name)
    for name in REPORTS:
        if name not in out:
            remove(spark, os.path.join(report_root, name))
    extracts = {"product_sample": product_sample(silver), "volume_units": volume_units(silver)}
    for name, df in extracts.items():
        out[name] = os.path.join(out_root, "extracts", name)
        write_delimited(order_report(df, ["retailer", "volume_unit"]), out[name])
    return out


def _empty_customer_map(spark: SparkSession) -> DataFrame:
    cols = ["retailer", *CUSTOMER_SEGMENTS, *CUSTOMER_STANDARDS]
    return spark.createDataFrame([], ", ".join(f"`{c}` string" for c in cols)).select(*[F.col(c) for c in cols])
