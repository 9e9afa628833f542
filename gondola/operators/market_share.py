"""Market shares between retailers.

A share is a retailer's value over the total of all retailers in the same
grain cell: a window sum partitioned by the grain columns (retailer excluded).
Each window partition holds at most one KPI row per retailer, so partitions
stay tiny however large the data is.  For the whole lattice one window keyed
by ``grain`` + every dimension (null where rolled up) serves all grains with
a single shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gondola.functions.agg import safe_div
from gondola.operators.kpis import Grain, lattice_columns


def market_share(kpis: DataFrame, cols: Sequence[str], *, on_zero_total: str = "ieee",
                 amount_scale: int | None = None) -> DataFrame:
    """W1 (``agg_kpis``): add ``ms_turnover`` and ``ms_nb_product_ids``.

    ``on_zero_total='ieee'`` gives NaN / +-Infinity for a zero total like float
    division; ``'null'`` gives null.  With ``amount_scale`` the total is summed
    as a decimal, so it does not depend on the order of the window's input.
    """
    w = Window.partitionBy(*cols)
    t = F.col("turnover")
    if amount_scale is None:
        total = F.sum(t).over(w)
    else:
        total = F.sum(t.cast(f"decimal(38,{amount_scale})")).over(w).cast("double")
    ids_total = F.sum("nb_product_ids").over(w)
    return kpis.withColumns({
        "ms_turnover": safe_div(t, total, on_zero=on_zero_total),
        "ms_nb_product_ids": safe_div(F.col("nb_product_ids"), ids_total, on_zero=on_zero_total),
    })


def market_share_lattice(lattice: DataFrame, grains: Sequence[Grain], *, on_zero_total: str = "ieee",
                         amount_scale: int | None = None) -> DataFrame:
    """Shares for every grain of a KPI lattice in one window."""
    return market_share(lattice, ["grain", *lattice_columns(grains)], on_zero_total=on_zero_total,
                        amount_scale=amount_scale)
