"""Benchmark the headline queries and print one JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Each query runs to completion into Spark's ``noop`` sink (the full plan is
executed, nothing is collected to the driver) and derives the test feed from
the given tables itself; the first also absorbs JVM start-up.
"""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "standardize_feed",
    "silver",
    "match_rate",
    "unmatched_products",
    "unicity_code_levels",
    "kpis_l4",
    "kpi_lattice",
    "market_share_lattice",
    "misclass_variants",
    "misclass_long",
    "volume_extract_stats",
    "volume_units_by_level",
    "product_sample",
    "volume_turnover_signs",
    "unit_inconsistency",
]


def session(cpus: int):
    from pyspark.sql import SparkSession

    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("gondola-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("BENCH_DRIVER_MEMORY", "16g"))
        .config("spark.sql.shuffle.partitions", str(max(8, 2 * cpus)))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        # the cleaning projection is one long generated method, which the JVM
        # compiles only with this option
        .config("spark.driver.extraJavaOptions", "-XX:-DontCompileHugeMethods")
        .getOrCreate()
    )


def operator_times(spark, sf_dir: str) -> dict[str, float]:
    """Operators apart from the feed: on silver written once to the folder that
    ``$BENCH_SILVER_DIR`` names (a private one by default; the bench is local)."""
    from gondola.config import AMOUNT_SCALE, SHARE_ON_ZERO
    from gondola.operators import extracts, kpis, market_share, misclassification
    from gondola.queries import KPI_LEVEL_COLS, LATTICE, Stages
    from gondola.sources.io import read_silver, write_silver
    from gondola.testfeed import RETAILERS_WITH_ID, RETAILERS_WITHOUT_ID

    folder = os.environ.get("BENCH_SILVER_DIR") or tempfile.mkdtemp(prefix="bench-silver-")
    t0 = time.perf_counter()
    run = write_silver(Stages(spark, sf_dir).silver, folder, RETAILERS_WITHOUT_ID)
    times = {"write_silver": round(time.perf_counter() - t0, 3)}
    silver = read_silver(spark, folder, run=run.run)
    lattice = kpis.kpi_lattice(silver, LATTICE, amount_scale=AMOUNT_SCALE)
    rows = misclassification.comparison_rows(silver, RETAILERS_WITH_ID)
    for name, df in {
        "kpis_l4": kpis.compute_kpis(silver, KPI_LEVEL_COLS[4], amount_scale=AMOUNT_SCALE),
        "kpi_lattice": lattice,
        "market_share_lattice": market_share.market_share_lattice(lattice, LATTICE, on_zero_total=SHARE_ON_ZERO, amount_scale=AMOUNT_SCALE),
        "misclass_long": misclassification.misclassification_long(rows, min_present=2),
        "product_sample": extracts.product_sample(silver),
        "volume_units_by_level": extracts.volume_units_by_level(silver, RETAILERS_WITHOUT_ID),
    }.items():
        t0 = time.perf_counter()
        df.write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
        print(f"# on silver, {name}: {times[name]}s", file=sys.stderr, flush=True)
    return times


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = sys.argv[1:] or HEADLINE
    spark = session(cpus)
    spark.sparkContext.setLogLevel("ERROR")
    from gondola.queries import QUERIES

    times = {}
    for name in names:
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
        print(f"# {name}: {times[name]}s", file=sys.stderr, flush=True)
    operators = {} if sys.argv[1:] else operator_times(spark, sf_dir)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "headline_queries_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "operators": operators,
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": cpus,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
