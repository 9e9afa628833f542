"""KPIs per grain and the KPI lattice (A1-A5).

A grain is ``year`` (+ department, + customer standards) x a prefix of the
product standards.  The lattice reads silver once: every line gives one row for
its product id (with the turnover) and one for its product code, reduced to
distinct ids and codes at the finest grain (combined map-side).  These are dealt
by id, and each is flagged for the grains in whose cell it is the first of its
id; the flags are added up by finest cell.  Only finest cells are emitted once
per grain (unused dimensions null, the grain name in the key) and added up, so
the plan is one chain of stages, and no row of an id is multiplied by the
number of grains.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from gondola.config import PRODUCT_STANDARDS

RETAILER = "retailer"

# Signs between texts packed as one, and for a null or one of the two in a text.
_BORDER, _ESCAPE = "\u0001", "\u0002"

# Shares in which the ids of a year and level 1 are dealt out.
ID_SHARES = 32

# FIXED VALUES: dimension prefixes of the KPI lattice and their report names.
DIMENSIONS = {
    "": ["year"],
    "Dep": ["year", "department"],
    "c1Dep": ["year", "department", "segment_1_standard"],
    "c2Dep": ["year", "department", "segment_1_standard", "segment_2_standard"],
    "c3Dep": ["year", "department", "segment_1_standard", "segment_2_standard", "segment_3_standard"],
}


@dataclass(frozen=True)
class Grain:
    name: str
    dims: tuple[str, ...]
    levels: tuple[str, ...]

    @property
    def columns(self) -> list[str]:
        return [*self.dims, *self.levels]


def incremental_sublists(items: Sequence) -> list[list]:
    """Prefixes ``[a], [a, b], ...`` of a list (A3: rollup without total)."""
    return [list(items[:i]) for i in range(1, len(items) + 1)]


def kpi_grains(n_levels: int = 4, dimensions: Sequence[str] = tuple(DIMENSIONS),
               standards: Sequence[str] = PRODUCT_STANDARDS) -> list[Grain]:
    """Level prefixes x dimension prefixes (A4 with all five, A5 with fewer)."""
    grains = []
    for i, levels in enumerate(incremental_sublists(list(standards)[:n_levels]), start=1):
        for d in dimensions:
            grains.append(Grain(f"l{i}{d}", tuple(DIMENSIONS[d]), tuple(levels)))
    return grains


def _with_product_id(df: DataFrame) -> DataFrame:
    # a feed without ids counts one (null) id per group (A2)
    if "product_id" in df.columns:
        return df
    return df.withColumn("product_id", F.lit(None).cast("string"))


def compute_kpis(df: DataFrame, cols: Sequence[str], *, key: Sequence[str] = (RETAILER,),
                 amount_scale: int | None = None) -> DataFrame:
    """A1: group by key + cols; turnover sum (0 when all null), distinct ids and
    codes counting null as a value; year as text."""
    cell = [*key, *cols]
    values = (_ids_and_codes(_with_product_id(df), cell, _as_amount(F.col("turnover"), amount_scale))
              .groupBy(*cell, "_kind", "_value").agg(F.sum("turnover").alias("turnover")))
    out = values.groupBy(*cell).agg(
        F.coalesce(F.sum("turnover").cast("double"), F.lit(0.0)).alias("turnover"),
        F.count_if(F.col("_kind") == 0).cast("int").alias("nb_product_ids"),
        F.count_if(F.col("_kind") == 1).cast("int").alias("nb_product_codes"))
    if "year" in cols:
        out = out.withColumn("year", F.col("year").cast("string"))
    return out


def lattice_columns(grains: Sequence[Grain]) -> list[str]:
    return list(dict.fromkeys(c for g in grains for c in g.columns))


def _as_amount(c: Column, scale: int | None) -> Column:
    return c if scale is None else c.cast(f"decimal(38,{scale})")


def _ids_and_codes(df: DataFrame, cell: Sequence[str], amount: Column) -> DataFrame:
    """A row (kind, value) for the product id and one for the code, with the amount:
    a code may have several ids."""
    nothing = F.when(F.lit(False), amount)
    return df.select(*cell, F.inline(F.array(
        F.struct(F.lit(0).alias("_kind"), F.col("product_id").alias("_value"), nothing.alias("turnover")),
        F.struct(F.lit(1).alias("_kind"), F.col("product_code").alias("_value"), amount.alias("turnover")))))


def _chains(grains: Sequence[Grain], every: Sequence[str]) -> list[list[tuple[Grain, list[str]]]]:
    """Grains in chains whose columns beyond ``every`` are nested, each with the
    columns that it adds to the one before: the grains of a level prefix, or those
    of a dimension prefix, whichever needs fewer chains."""

    def chained(rank, columns) -> list[list[tuple[Grain, list[str]]]]:
        chains: list[list[tuple[Grain, list[str]]]] = []
        for g in sorted(grains, key=lambda g: (rank(g), len(g.columns))):
            own = [c for c in columns(g) if c not in every]
            held = [c for _, added in chains[-1] for c in added] if chains else []
            if chains and rank(chains[-1][-1][0]) == rank(g) and set(held) <= set(own):
                chains[-1].append((g, [c for c in own if c not in held]))
            else:
                chains.append([(g, own)])
        return chains

    return min(chained(lambda g: g.levels, lambda g: [*g.levels, *g.dims]), chained(lambda g: g.dims, lambda g: [*g.dims, *g.levels]), key=len)


def _packed(cols: Sequence[str]) -> Column:
    """Texts, nulls included, as one text that ``_unpacked`` takes apart."""
    plain = [F.replace(F.replace(F.col(c), F.lit(_ESCAPE), F.lit(_ESCAPE + "b")), F.lit(_BORDER), F.lit(_ESCAPE + "a")) for c in cols]
    return F.concat_ws(_BORDER, *[F.coalesce(c, F.lit(_ESCAPE)) for c in plain]) if cols else F.lit("")


def _unpacked(packed: str, cols: Sequence[str]) -> list[Column]:
    texts = [F.get(F.split(packed, _BORDER), F.lit(i)) for i in range(len(cols))]
    plain = [F.replace(F.replace(t, F.lit(_ESCAPE + "a"), F.lit(_BORDER)), F.lit(_ESCAPE + "b"), F.lit(_ESCAPE)) for t in texts]
    return [F.when(t != _ESCAPE, p).alias(c) for t, p, c in zip(texts, plain, cols)]


def _first_seen(rows: DataFrame, within: Sequence[str], chains) -> tuple[DataFrame, dict[str, Column]]:
    """``rows`` with a flag (0 or 1) for each grain, a bit of a ``_flags`` number: the
    first row of its cell within the columns ``within``.

    Sorted by a chain's columns in the order in which its grains add them, the
    rows of a cell lie together for every grain of the chain, so a row begins a
    cell where it differs from the row before.
    """
    flags: dict[str, Column] = {}
    for chain in chains:
        order = [c for _, added in chain for c in added]
        w = Window.partitionBy(*within).orderBy(*order) if order else Window.partitionBy(*within).orderBy(F.lit(0))
        rows = rows.withColumns({f"_p{k}": F.lag(c).over(w) for k, c in enumerate(order)} | {"_p": F.lag(F.lit(True)).over(w)})
        new, k, numbers = F.col("_p").isNull(), 0, {}
        for g, added in chain:
            for c in added:
                new, k = new | ~F.col(c).eqNullSafe(F.col(f"_p{k}")), k + 1
            word, bit = divmod(len(flags), 60)
            number = f"_flags{word}"
            flags[g.name] = F.shiftright(number, bit).bitwiseAND(F.lit(1))
            held = numbers.get(number, F.col(number) if number in rows.columns else F.lit(0).cast("long"))
            numbers[number] = held.bitwiseOR(F.when(new, F.lit(1 << bit).cast("long")).otherwise(F.lit(0).cast("long")))
        rows = rows.withColumns(numbers).drop("_p", *[f"_p{k}" for k in range(len(order))])
    return rows, flags


def kpi_lattice(silver: DataFrame, grains: Sequence[Grain], *, key: Sequence[str] = (RETAILER,),
                amount_scale: int | None = None) -> DataFrame:
    """A4/A5: every grain in one long table.

    Columns: ``grain``, key, every dimension of any grain (null where the grain
    does not use it), ``turnover``, ``nb_product_ids``, ``nb_product_codes``.
    """
    dims = lattice_columns(grains)
    every = [c for c in dims if all(c in g.columns for g in grains)]
    # The rows of ids are exchanged twice and sorted for each chain, so the texts of
    # a cell travel as one, those that every grain keeps apart first.
    types = silver.select(*[F.col(c).alias(c) for c in [*key, *dims]]).schema
    texts = [c for c in types.names if types[c].dataType == StringType()]
    other = [c for c in types.names if c not in texts]
    apart = [c for c in [*key, *every] if c in texts]
    rest = [c for c in dims if c in texts and c not in apart]
    given = _with_product_id(silver).select("product_id", "product_code", "turnover", *other, _packed([*apart, *rest]).alias("_cell"))
    lines = _ids_and_codes(given, ["_cell", *other], _as_amount(F.col("turnover"), amount_scale))
    fine = lines.groupBy("_cell", *other, "_kind", "_value").agg(F.sum("turnover").alias("turnover"))
    # All rows of an id (a null id or code is a value too, as n_unique counts it)
    # within what every grain keeps apart lie in one partition, so an id is
    # counted in each of its cells there, once, and cells add up from then on.
    # Ids are dealt in shares, so that a partition has few cells and adds up many
    # rows of each; their number is given, as short rows would be merged into
    # partitions whose sorts spill.
    at = F.substring_index("_cell", _BORDER, len(apart))
    deal = F.pmod(F.xxhash64("_value"), F.lit(ID_SHARES)) * 2 + F.col("_kind")
    kept = [c for c in other if c in key or c in every]
    parts = int(silver.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = fine.repartition(parts, at, *kept, deal).select("_value", deal.alias("_deal"), at.alias("_apart"), *other, "turnover", *_unpacked("_cell", [*apart, *rest])[len(apart):])
    # The value comes first: it settles nearly every comparison of a sort.
    flagged, flags = _first_seen(dealt, ["_value", "_deal", "_apart", *kept], _chains(grains, every))
    # both counts of a grain in one number: ids above, codes below
    one = F.when(F.col("_deal") % 2 == 0, F.lit(1 << 32)).otherwise(F.lit(1).cast("long")).alias("_one")
    numbers = [c for c in flagged.columns if c.startswith("_flags")]
    counts = {g.name: f"_n{i}" for i, g in enumerate(grains)}
    cells = (flagged.select("_apart", _packed(rest).alias("_rest"), *other, "turnover", *numbers, one).groupBy("_apart", "_rest", *other)
             .agg(F.sum("turnover").alias("turnover"), *[F.sum(flags[g] * F.col("_one")).alias(n) for g, n in counts.items()])
             .select(*_unpacked("_apart", apart), *_unpacked("_rest", rest), *other, "turnover", *counts.values()))
    # one row per (finest cell, grain); ``grain`` in the key keeps a rolled-up
    # null apart from a real null
    per_grain = F.inline(F.array(*[
        F.struct(F.lit(g.name).alias("grain"),
                 *[(F.col(c).cast("string") if c in g.columns else F.lit(None).cast("string")).alias(c) for c in dims],
                 F.col(counts[g.name]).alias("_n"))
        for g in grains]))
    out = cells.select(*key, "turnover", per_grain).groupBy("grain", *key, *dims).agg(
        F.sum("turnover").alias("turnover"),
        F.sum(F.shiftright("_n", 32)).cast("int").alias("nb_product_ids"),
        F.sum(F.col("_n").bitwiseAND(F.lit((1 << 32) - 1))).cast("int").alias("nb_product_codes"))
    total = F.coalesce(F.col("turnover").cast("double"), F.lit(0.0))
    return out.select("grain", *key, *dims, total.alias("turnover"), "nb_product_ids", "nb_product_codes")


def order_report(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """O1: ascending multi-column order, nulls first."""
    return df.orderBy(*[F.col(c).asc_nulls_first() for c in cols])


def ordered_positions(df: DataFrame, cols: Sequence[str], name: str = "position", parts: int = 64) -> DataFrame:
    """O1 with a proof of order: each row's place (from 0) in ``order_report``'s
    order, ties broken by the other columns.

    Borders from a sample of keys (bounded, and the same in every run) cut the
    order into ranges; the rows of a range are numbered from the number of rows in
    the ranges before, so no task sorts the whole table.
    """
    full = [*cols, *[c for c in df.columns if c not in cols]]
    key = F.struct(*[F.col(c) for c in full])
    # at most a hundred keys for each part, whatever the table's size: the smallest by hash
    sample = df.select(key.alias("k")).orderBy(F.xxhash64("k"), "k").limit(100 * parts)
    ranked = [r["k"] for r in sample.orderBy("k").collect()]
    kind = df.select(key.alias("k")).schema
    borders = df.sparkSession.createDataFrame([(ranked[len(ranked) * i // parts],) for i in range(1, parts)] if ranked else [], kind)
    borders = borders.distinct().agg(F.sort_array(F.collect_list("k")).alias("b")).first()["b"]
    literal = F.array(*[F.struct(*[F.lit(v).cast(kind["k"].dataType[c].dataType).alias(c) for c, v in zip(full, b)]) for b in borders]) if borders else None
    part = F.size(F.filter(literal, lambda b: b <= key)) if borders else F.lit(0)
    dealt = df.withColumn("_part", part)
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = dealt.groupBy("_part").agg(F.count(F.lit(1)).alias("_n")).select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_at"))
    order = Window.partitionBy("_part").orderBy(*[F.col(c).asc_nulls_first() for c in full])
    placed = dealt.withColumn("_i", F.row_number().over(order) - 1).join(F.broadcast(starts), "_part")  # a row for each part
    return placed.select(*df.columns, (F.col("_at") + F.col("_i")).cast("long").alias(name))
