"""Scalar functions: the traps that decide every later value."""

import math

import pytest
from pyspark.sql import functions as F

from gondola.config import QUANTITY_PATTERN, QUANTITY_PATTERN_STRICT
from gondola.functions import (
    classification_path,
    clean_department,
    distinct_non_null_count,
    extract_quantities,
    fill_empty,
    format_quantities,
    n_unique,
    null_count,
    parse_amount,
    remove_first_space,
    replace_first,
    safe_div,
    strip_chars,
    sum_or_zero,
    widen_year,
)


def one_col(spark, values, type_="string"):
    return spark.createDataFrame([(v,) for v in values], f"x {type_}")


def values(df, expr):
    return [r[0] for r in df.select(expr.alias("y")).collect()]


def test_strip_unicode_whitespace(spark):
    df = one_col(spark, ["  a b\t", " x　", " y ", "plain", "", None, " \t "])
    assert values(df, strip_chars("x")) == ["a b", "x", "y", "plain", "", None, ""]


def test_names_are_taken_as_they_are(spark):
    df = spark.createDataFrame([(" a ", "")], "`Mque comm.` string, `q``x` string")
    assert df.select(strip_chars("Mque comm."), fill_empty("q`x")).first()[:] == ("a", "NON RENSEIGNE")


def test_fill_empty(spark):
    df = one_col(spark, ["", None, " ", "v"])
    assert values(df, fill_empty("x")) == ["NON RENSEIGNE", "NON RENSEIGNE", " ", "v"]


def test_replace_first_only(spark):
    df = one_col(spark, ["a?b?c", "none", None, "$x?"])
    assert values(df, replace_first(F.col("x"), r"\?", "ї")) == ["aїb?c", "none", None, "$xї"]
    assert values(df, replace_first(F.col("x"), r"\?", "$1")) == ["a$1b?c", "none", None, "$x$1"]


@pytest.mark.parametrize("raw,expected", [
    ("1234,56 ", 1234.56), ("-1 234,5", -1234.5), ("12.5", 12.5), ("0", 0.0), (None, None),
])
def test_parse_amount(spark, raw, expected):
    assert values(one_col(spark, [raw]), parse_amount(F.col("x"))) == [expected]


def test_parse_amount_strict_rejects(spark):
    # two spaces, a type suffix Spark's own cast would accept, text
    for bad in ["1 234 567,8", "1.5d", "abc"]:
        with pytest.raises(Exception):
            one_col(spark, [bad]).select(parse_amount(F.col("x"))).collect()
    df = one_col(spark, ["1.5d", "abc", "2,5"])
    assert values(df, parse_amount(F.col("x"), strict=False)) == [None, None, 2.5]


def test_parse_amount_without_space_removal(spark):
    df = one_col(spark, ["12,5"])
    assert values(df, parse_amount(F.col("x"), drop_space=False)) == [12.5]
    with pytest.raises(Exception):
        one_col(spark, ["12,5 "]).select(parse_amount(F.col("x"), drop_space=False)).collect()


def test_remove_first_space(spark):
    assert values(one_col(spark, ["1 234 5", "12"]), remove_first_space(F.col("x"))) == ["1234 5", "12"]


@pytest.mark.parametrize("raw,expected", [
    ("FR/5", "05"), ("01", "01"), ("05", "05"), ("2", "02"), ("974", "974"), ("0974", "974"),
    ("FR/013", "013"), ("", "00"), (None, None), ("00", "00"),
])
def test_clean_department(spark, raw, expected):
    # 974 is not truncated to 97 (bare lpad would); only the first match goes
    assert values(one_col(spark, [raw]), clean_department(F.col("x"))) == [expected]


def test_widen_year(spark):
    df = one_col(spark, ["23", "24", "25", None])
    assert values(df, widen_year(F.col("x"), {"23": "2023", "24": "2024"})) == ["2023", "2024", "25", None]


def test_classification_path_null_propagates(spark):
    df = spark.createDataFrame([("a", "b", "c"), ("a", None, "c")], "l1 string, l2 string, l3 string")
    assert values(df, classification_path(["l1", "l2", "l3"])) == ["a>b>c", None]


# Hand-derived from the extraction pattern
LABELS = {
    "LASAGNE AUX OEUFS BOITE 500 G BARILLA": [("500", "G", "")],
    "LASAGNE AUX OEUFS BOITE 500G": [("500", "G", "")],
    "LASAGNE AUX OEUFS BOITE 500Gx120": [("500", "G", "x120")],
    "LASAGNE AUX OEUFS BOITE (500Gx120)": [("500", "G", "x120")],
    "LASAGNE AUX OEUFS BOITE 500 G x120": [("500", "G", "x120")],
    "LASAGNE AUX OEUFS BOITE 500G X 120": [("500", "G", "X 120")],
    "Coque macaron vanille (20Gx12x4)": [("20", "G", "x12x4")],
    "LASAGNE AUX OEUFS BOITE 500.0 L": [("500.0", "L", "")],
    "LASAGNE AUX OEUFS BOITE 500,11 CL 500 ml x100BARILLA": [("500,11", "CL", ""), ("500", "ml", "x100")],
    "12 GR": [("12", "G", "")],
    "NO DIGITS": [],
}


def test_extract_quantities(spark):
    df = one_col(spark, list(LABELS) + [None])
    got = df.select("x", extract_quantities(F.col("x"), QUANTITY_PATTERN).alias("q")).collect()
    for row in got:
        if row.x is None:
            assert row.q is None
        else:
            assert [tuple(t) for t in row.q] == LABELS[row.x], row.x


def test_extract_quantities_strict_needs_boundaries(spark):
    df = one_col(spark, ["BOITE 500G BARILLA", "BOITE 500GBARILLA", "x 12 kg"])
    got = [r[0] for r in df.select(format_quantities(extract_quantities(F.col("x"), QUANTITY_PATTERN_STRICT))).collect()]
    assert got == ["500|G|", "", "12|kg|"]


def test_n_unique_counts_null(spark):
    df = spark.createDataFrame([(1, "a"), (1, None), (1, "a"), (2, None)], "k int, v string")
    got = dict(df.groupBy("k").agg(n_unique("v").alias("n")).collect())
    assert got == {1: 2, 2: 1}


def test_sum_or_zero(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, 1.25), (2, None)], "k int, v double")
    got = dict(df.groupBy("k").agg(sum_or_zero("v").alias("s")).collect())
    assert got == {1: 0.0, 2: 1.25}
    got = dict(df.groupBy("k").agg(sum_or_zero("v", scale=2).alias("s")).collect())
    assert got == {1: 0.0, 2: 1.25}


def test_safe_div(spark):
    df = spark.createDataFrame([(1.0, 0.0), (-1.0, 0.0), (0.0, 0.0), (1.0, 4.0), (None, 1.0), (1.0, None)],
                               "n double, d double")
    ieee = values(df, safe_div("n", "d"))
    assert ieee[0] == math.inf and ieee[1] == -math.inf and math.isnan(ieee[2])
    assert ieee[3:] == [0.25, None, None]
    assert values(df, safe_div("n", "d", on_zero="null")) == [None, None, None, 0.25, None, None]


def test_row_wise_counts(spark):
    df = spark.createDataFrame([("a", None, "a"), (None, None, None), ("a", "b", None)], "x string, y string, z string")
    assert values(df, null_count(["x", "y", "z"])) == [1, 3, 1]
    assert values(df, distinct_non_null_count(["x", "y", "z"])) == [1, 0, 2]
