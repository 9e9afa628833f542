"""Aggregate and arithmetic helpers with the source pipeline's null semantics."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def n_unique(c) -> Column:
    """Distinct count where null counts as one more value.

    ``count(DISTINCT c)`` skips nulls; the source counts a null group member
    as a value, so add 1 when at least one null is present.
    """
    c = _col(c)
    return F.count_distinct(c) + F.coalesce(F.max(c.isNull().cast("int")), F.lit(0))


def sum_or_zero(c, *, scale: int | None = None) -> Column:
    """Sum that is 0 (not null) when every input is null.

    With ``scale`` the values are summed as DECIMAL(38, scale) and the result
    cast back to double, which makes the total independent of the summation
    order (exact for amounts carrying at most ``scale`` decimals).
    """
    c = _col(c)
    if scale is None:
        return F.coalesce(F.sum(c), F.lit(0.0)).cast("double")
    s = F.sum(c.cast(f"decimal(38,{scale})"))
    return F.coalesce(s.cast("double"), F.lit(0.0))


def safe_div(num, den, *, on_zero: str = "ieee") -> Column:
    """num / den without ANSI's divide-by-zero error.

    ``on_zero='ieee'``: x/0 = +-Infinity, 0/0 = NaN, like float division.
    ``on_zero='null'``: null where the denominator is 0.
    A null operand gives null.
    """
    num, den = _col(num).cast("double"), _col(den).cast("double")
    q = F.when(den != F.lit(0.0), num / den)
    if on_zero == "null":
        return q
    if on_zero != "ieee":
        raise ValueError(f"on_zero must be 'ieee' or 'null', not {on_zero!r}")
    return (
        q.when(num.isNull() | den.isNull(), F.lit(None).cast("double"))
        .when(num > 0, F.lit(float("inf")))
        .when(num < 0, F.lit(float("-inf")))
        .otherwise(F.lit(float("nan")))
    )


def any_null(cols) -> Column:
    """True when at least one of ``cols`` is null."""
    return reduce(or_, [_col(c).isNull() for c in cols])


def null_count(cols) -> Column:
    """Row-wise number of null columns."""
    return reduce(lambda a, b: a + b, [_col(c).isNull().cast("int") for c in cols])


def distinct_non_null_count(cols) -> Column:
    """Row-wise number of distinct non-null values among ``cols`` (C11)."""
    return F.size(F.array_distinct(F.array_compact(F.array(*[_col(c) for c in cols]))))
