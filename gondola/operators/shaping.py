"""Projection and schema shaping of feeds."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gondola.functions.text import null_if, widen_year


def _q(name: str) -> Column:
    """Column by exact name (dots and spaces taken literally)."""
    return F.col(f"`{name.replace('`', '``')}`")


def rename_columns(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename ``source -> canonical``; sources the frame lacks are ignored."""
    present = {k: v for k, v in mapping.items() if k in df.columns and k != v}
    return df.withColumnsRenamed(present) if present else df


def add_required_columns(df: DataFrame, required: Mapping[str, object] | Sequence[Mapping[str, object]]) -> DataFrame:
    """Append every missing required column as a literal.

    A list of dicts is merged with the first dict winning on a shared key.
    Columns already present are left untouched.
    """
    if isinstance(required, Mapping):
        merged = dict(required)
    else:
        dicts = list(required)
        # key order as a chained lookup lists them (last dict's keys first),
        # value from the first dict holding the key
        order = list(dict.fromkeys(k for d in reversed(dicts) for k in d))
        merged = {k: next(d[k] for d in dicts if k in d) for k in order}
    missing = {c: F.lit(v).cast("string") if isinstance(v, str) or v is None else F.lit(v)
               for c, v in merged.items() if c not in df.columns}
    return df.withColumns(missing) if missing else df


def set_constants_by_retailer(df: DataFrame, constants: Mapping[str, Mapping[str, object]],
                              retailer_col: str = "retailer") -> DataFrame:
    """P3 on a multi-feed frame: each feed's constants only on its own rows."""
    cols: dict[str, Column] = {}
    for name in sorted({c for d in constants.values() for c in d}):
        expr = None
        for retailer, d in constants.items():
            if name in d:
                cond = F.col(retailer_col) == F.lit(retailer)
                expr = F.when(cond, F.lit(d[name])) if expr is None else expr.when(cond, F.lit(d[name]))
        base = _q(name) if name in df.columns else F.lit(None).cast("string")
        cols[name] = expr.otherwise(base)
    return df.withColumns(cols) if cols else df


def select_existing(df: DataFrame, wanted: Iterable[str]) -> DataFrame:
    """Select the wanted columns the frame has, in wanted order."""
    return df.select([_q(c) for c in wanted if c in df.columns])


def suffix_columns(df: DataFrame, suffix: str, keep: Iterable[str] = ()) -> DataFrame:
    """Append ``_suffix`` to every column except ``keep`` (P5)."""
    keep = set(keep)
    return df.toDF(*[c if c in keep else f"{c}_{suffix}" for c in df.columns])


def strip_suffix(df: DataFrame, suffix: str) -> DataFrame:
    """Remove ``_suffix`` from every column name."""
    return df.toDF(*[c.replace(f"_{suffix}", "") for c in df.columns])


def columns_with_prefix(df: DataFrame, prefix: str = "", suffix: str = "") -> list[str]:
    """Names chosen by prefix and/or suffix."""
    return [c for c in df.columns if c.startswith(prefix) and c.endswith(suffix)]


def explode_list(df: DataFrame, source: str, target: str, sep_pattern: str = r"[|]") -> DataFrame:
    """Split ``source`` and emit one row per item into ``target``.

    Outer explode: a null list keeps its row with a null item.  All other
    columns (measures included) are repeated on every item.
    """
    return df.withColumn(target, F.explode_outer(F.split(_q(source), sep_pattern)))


def split_exact(df: DataFrame, source: str, sep: str, names: Sequence[str]) -> DataFrame:
    """Split into exactly ``len(names)`` parts.

    A missing part is null and parts beyond ``len(names)`` are dropped.
    """
    parts = F.split(_q(source).cast("string"), _regex_literal(sep))
    return df.withColumns({n: F.get(parts, i) for i, n in enumerate(names)})


def _regex_literal(text: str) -> str:
    import re

    return re.escape(text)


def widen_years(df: DataFrame, column: str, mapping: Mapping[str, str]) -> DataFrame:
    """Conditional two-digit -> four-digit year."""
    return df.withColumn(column, widen_year(_q(column), dict(mapping)))


def nullify_placeholder(df: DataFrame, columns: Iterable[str], placeholder: str) -> DataFrame:
    """Placeholder text -> null on the listed columns (P10)."""
    return df.withColumns({c: null_if(_q(c), placeholder) for c in columns})


def slice_period(df: DataFrame, source: str, year: str, month: str) -> DataFrame:
    """``YYYY..MM`` text: last two characters -> month, first four -> year."""
    s = _q(source).cast("string")
    return df.withColumns({month: F.substring(s, -2, 2), year: F.substring(s, 1, 4)})


def tag_retailer(df: DataFrame, name: str, column: str = "retailer") -> DataFrame:
    """Literal feed tag."""
    return df.withColumn(column, F.lit(name))


def union_all(frames: Sequence[DataFrame], allow_missing: bool = False) -> DataFrame:
    """Vertical concat by column name (U1; ``allow_missing`` gives U2)."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=allow_missing), frames)


def as_text(df: DataFrame, column: str) -> Column:
    """A column as text; whole numbers held as doubles print without exponent."""
    c = _q(column)
    if df.schema[column].dataType.simpleString() in ("double", "float"):
        whole = (c == F.floor(c)) & (F.abs(c) < F.lit(1e18))
        return F.when(whole, c.cast("decimal(38,0)").cast("string")).otherwise(c.cast("string"))
    return c.cast("string")


def common_types(frames: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """The frames with every column that differs in type between them as text."""
    kinds: dict[str, set[str]] = {}
    for df in frames.values():
        for c, t in df.dtypes:
            kinds.setdefault(c, set()).add(t)
    mixed = {c for c, t in kinds.items() if len(t) > 1}
    return {n: df.select([as_text(df, c).alias(c) if c in mixed else _q(c) for c in df.columns]) for n, df in frames.items()}


def assemble_feeds(frames: Mapping[str, DataFrame], feeds: Mapping[str, object], column: str = "retailer") -> DataFrame:
    """Feeds in their native names -> one frame in canonical names.

    Each feed is renamed with its own map and tagged; the feeds are united by
    name, a column that one lacks is null, and every value is text (feeds
    deliver the same amount as number or text).
    """
    parts = []
    for name, df in frames.items():
        renamed = rename_columns(df, feeds[name].rename)
        parts.append(tag_retailer(renamed.select([as_text(renamed, c).alias(c) for c in renamed.columns if c != column]), name, column))
    return union_all(parts, allow_missing=True)


def feed_catalog(spark, feeds) -> DataFrame:
    """One row per feed with its metadata (turnover type, whether it has
    product ids, whether its department comes from a zip code), to join to
    KPI rows on ``retailer`` when a report needs it."""
    rows = [(f.name, f.turnover_type, f.with_product_id, f.department_from_zip) for f in feeds]
    return spark.createDataFrame(
        rows, "retailer string, turnover_type string, has_product_id boolean, department_from_zip boolean")


def with_feed_metadata(report: DataFrame, feeds, columns: Sequence[str] = ("turnover_type",)) -> DataFrame:
    """P15 on request: a report's rows with their feed's metadata."""
    return report.join(F.broadcast(feed_catalog(report.sparkSession, feeds).select("retailer", *columns)), "retailer", "left")
