"""Scalar text and amount cleaning, as native Spark column expressions.

Every function takes and returns a ``Column`` so it stays inside
whole-stage codegen; none of them needs a Python UDF.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from gondola.config import (
    CLASSIFICATION_SEPARATOR,
    DEPARTMENT_PREFIX_PATTERN,
    DEPARTMENT_WIDTH,
    NOT_FILLED,
    QUANTITY_PATTERN,
)

# FIXED VALUES: the Unicode White_Space code points, stripped at either end
# (plain ``trim`` removes only the space character, keeping tab and NBSP).
UNICODE_WHITESPACE = "".join(chr(c) for c in [
    0x0009, 0x000A, 0x000B, 0x000C, 0x000D, 0x0020, 0x0085, 0x00A0, 0x1680,
    0x2000, 0x2001, 0x2002, 0x2003, 0x2004, 0x2005, 0x2006, 0x2007, 0x2008, 0x2009, 0x200A,
    0x2028, 0x2029, 0x202F, 0x205F, 0x3000,
])

# A number the strict float cast accepts: digits with an optional point and
# exponent, or inf/infinity/nan.  Anything else (including a trailing
# d/f type suffix that Spark's own cast would silently accept) is rejected.
_FLOAT_TEXT = r"^[+-]?(?:(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?|(?i:inf|infinity|nan))$"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _sql_name(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _sql_text(text: str) -> str:
    return "'" + "".join(f"\\u{ord(ch):04X}" for ch in text) + "'"


def strip_chars(name: str) -> Column:
    """The named column as text without Unicode whitespace at both ends.

    One call of ``btrim`` with the White_Space set: a projection strips dozens of
    columns, and code of more than a few calls for each makes the generated method
    too long for the JVM's compiler.
    """
    return F.expr(f"btrim(CAST({_sql_name(name)} AS STRING), {_sql_text(UNICODE_WHITESPACE)})")


def strip_edges(name: str) -> Column:
    """The named column as ``strip_chars`` has it, for a column that holds text.

    ``btrim`` looks for a text's edges in the whole White_Space set, which costs more
    than all else that cleans a line; a text between two visible ASCII signs is not
    given to it.  The last sign is read as a byte: a text's last character is found
    by counting all of them.  The lambda, which Spark interprets, is left to the others.
    """
    c = _sql_name(name)
    last = f"substring(CAST({c} AS BINARY), -1, 1)"
    bare = f"{c} >= '!' AND {c} < '\\u007F' AND {last} BETWEEN X'21' AND X'7E'"
    stripped = f"get(transform(array({c}), x -> btrim(x, {_sql_text(UNICODE_WHITESPACE)})), 0)"
    return F.expr(f"CASE WHEN {c} IS NULL OR {c} = '' OR ({bare}) THEN {c} ELSE {stripped} END")


def fill_empty(name: str, value: str = NOT_FILLED) -> Column:
    """The named column with null or empty text as ``value``.

    ``coalesce`` with a literal is known to hold no null, so a join on the column
    adds no filter that computes it a second time.
    """
    c = _sql_name(name)
    return F.expr(f"coalesce(CASE WHEN {c} <> '' THEN {c} END, {_sql_text(value)})")


def _java_replacement(text: str) -> str:
    return text.replace("\\", "\\\\").replace("$", "\\$")


def replace_first(c, pattern: str, replacement: str) -> Column:
    """Replace only the leftmost match of the Java regex ``pattern``.

    ``regexp_replace`` rewrites every match; anchoring a lazy prefix keeps
    the first one only: ``(?s)^(.*?)(?:pattern)`` -> ``$1replacement``.
    """
    return F.regexp_replace(
        _col(c),
        F.lit(f"(?s)^(.*?)(?:{pattern})"),
        F.lit("$1" + _java_replacement(replacement)),
    )


def replace_first_literal(c, needle: str, replacement: str) -> Column:
    """Replace the first occurrence of a literal substring (no regex engine).

    ``split`` with limit 2 cuts at the first occurrence only; joining the (one
    or two) parts with the replacement rebuilds the text.  The input is
    referenced once, so nesting several replacements stays linear.
    """
    return F.array_join(F.split(_col(c), re.escape(needle), 2), replacement)


def remove_first_space(c) -> Column:
    """Drop the first space of an amount written with a thousands space."""
    return replace_first_literal(_col(c).cast("string"), " ", "")


def amount_text(c, *, drop_space: bool = True) -> Column:
    """Decimal-comma amount text normalised for a float cast: first ``,`` ->
    ``.``, and (``drop_space``) first space removed (C3 without the cast)."""
    s = replace_first_literal(_col(c).cast("string"), ",", ".")
    return replace_first_literal(s, " ", "") if drop_space else s


def cast_amount(text, *, strict: bool = True) -> Column:
    """Normalised amount text -> double.  ``strict`` raises on text that is not
    a plain number, like a strict float cast; otherwise it becomes null."""
    s = _col(text)
    ok = s.rlike(_FLOAT_TEXT)
    if strict:
        checked = F.when(ok | s.isNull(), s).otherwise(
            F.raise_error(F.concat(F.lit("amount is not a number: '"), s, F.lit("'"))).cast("string"))
        return checked.cast("double")
    return F.when(ok, s).cast("double")


def parse_amount(c, *, drop_space: bool = True, strict: bool = True) -> Column:
    """Decimal-comma amount -> double (C3; ``drop_space=False`` is C4).

    The first ``,`` becomes ``.`` and, with ``drop_space``, the first space is
    removed.  ``strict`` raises on text that is not a number, like a strict
    float cast; otherwise such values become null (quarantine mode).
    """
    return cast_amount(amount_text(c, drop_space=drop_space), strict=strict)


def zero_fill(c, width: int = DEPARTMENT_WIDTH) -> Column:
    """Left-pad with zeros to ``width`` without truncating longer text."""
    c = _col(c)
    return F.when(F.length(c) >= width, c).otherwise(F.lpad(c, width, "0"))


def department_from_zip(zip_code) -> Column:
    """Department = first two characters of the zip code."""
    return F.substring(_col(zip_code).cast("string"), 1, DEPARTMENT_WIDTH)


def strip_department_prefix(c) -> Column:
    """Remove the first ``^0|FR/`` match (first half of C7)."""
    return replace_first(_col(c).cast("string"), DEPARTMENT_PREFIX_PATTERN, "")


def clean_department(c) -> Column:
    """Remove the first ``^0|FR/`` match, then zero-fill to 2.

    As one expression the regex result is referenced three times; operators
    that own the frame project ``strip_department_prefix`` first instead.
    """
    return zero_fill(strip_department_prefix(c))


def null_if(c, placeholder: str) -> Column:
    """Placeholder text -> null (P10)."""
    c = _col(c)
    return F.when(c == F.lit(placeholder), F.lit(None).cast("string")).otherwise(c)


def widen_year(c, mapping: dict[str, str]) -> Column:
    """Two-digit years listed in ``mapping`` become four digits."""
    c = _col(c)
    out = None
    for short, full in mapping.items():
        out = (F.when(c == F.lit(short), F.lit(full)) if out is None
               else out.when(c == F.lit(short), F.lit(full)))
    return c if out is None else out.otherwise(c)


def classification_path(level_cols, sep: str = CLASSIFICATION_SEPARATOR) -> Column:
    """Levels joined by ``sep``; null as soon as one level is null.

    ``concat`` propagates nulls (``concat_ws`` would skip them).
    """
    parts = []
    for i, c in enumerate(level_cols):
        if i:
            parts.append(F.lit(sep))
        parts.append(_col(c).cast("string"))
    return F.concat(*parts)


_QUANTITY_TYPE = "array<struct<number:string,unit:string,multiplier:string>>"


def extract_quantities(c, pattern: str = QUANTITY_PATTERN) -> Column:
    """All (number, unit, multiplier) matches of ``pattern`` in a text.

    An unmatched optional group yields ``''``; null text yields null.
    """
    c = _col(c)
    groups = [F.regexp_extract_all(c, F.lit(pattern), F.lit(i)) for i in (1, 2, 3)]
    return F.arrays_zip(*groups).cast(_QUANTITY_TYPE)


def format_quantities(arr) -> Column:
    """``number|unit|multiplier`` items joined by ``;`` (display form)."""
    return F.array_join(
        F.transform(_col(arr), lambda x: F.concat_ws("|", x["number"], x["unit"], x["multiplier"])),
        ";",
    )
