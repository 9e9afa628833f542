"""Operators on tiny frames, checked against hand results or brute force."""

import itertools
import math
import random
from collections import defaultdict

from pyspark.sql import functions as F

from gondola.config import AMOUNT_SCALE, CUSTOMER_SEGMENTS, PRODUCT_LEVELS, PRODUCT_STANDARDS, FeedSpec
from gondola.operators.extracts import any_row_per_key, unit_inconsistency, volume_turnover_signs
from gondola.functions.agg import n_unique, sum_or_zero
from gondola.operators.kpis import Grain, compute_kpis, incremental_sublists, kpi_grains, kpi_lattice, lattice_columns, order_report, ordered_positions
from gondola.operators.mapping import build_silver, map_products
from gondola.operators.market_share import market_share, market_share_lattice
from gondola.operators.misclassification import (
    comparison_rows,
    conflicting_products,
    misclassification_long,
    misclassification_variants,
)
from gondola.operators.quality import check_unicity, distinct_keys, match_rate, unmatched_products
from gondola.operators.shaping import (
    add_required_columns,
    as_text,
    columns_with_prefix,
    explode_list,
    rename_columns,
    split_exact,
    strip_suffix,
    suffix_columns,
    tag_retailer,
    union_all,
)
from gondola.operators.standardize import prepare_product_map, standardize_feed


def test_rename_ignores_missing_and_takes_dotted_names(spark):
    df = spark.createDataFrame([(1, 2)], "`Mque comm.` int, other int")
    out = rename_columns(df, {"Mque comm.": "brand_name", "absent": "x"})
    assert out.columns == ["brand_name", "other"]


def test_add_required_columns_first_dict_wins(spark):
    df = spark.createDataFrame([("v",)], "a string")
    out = add_required_columns(df, [{"a": "no", "b": "first"}, {"b": "second", "c": "third"}])
    row = out.collect()[0].asDict()
    assert row == {"a": "v", "b": "first", "c": "third"}


def test_explode_outer_keeps_null_list(spark):
    df = spark.createDataFrame([("c1", "1|2", 10.0), ("c2", None, 5.0)], "code string, g string, t double")
    rows = sorted(explode_list(df, "g", "gtin").select("code", "gtin", "t").collect(), key=str)
    assert [tuple(r) for r in rows] == [("c1", "1", 10.0), ("c1", "2", 10.0), ("c2", None, 5.0)]


def test_split_exact(spark):
    df = spark.createDataFrame([("23-05",), ("24",), ("25-01-X",)], "p string")
    rows = split_exact(df, "p", "-", ["y", "m"]).select("y", "m").collect()
    assert [tuple(r) for r in rows] == [("23", "05"), ("24", None), ("25", "01")]


def test_suffix_and_union(spark):
    a = spark.createDataFrame([(1, "x")], "product_id int, name string")
    assert suffix_columns(a, "metro", keep=["product_id"]).columns == ["product_id", "name_metro"]
    b = spark.createDataFrame([("y", 2)], "name string, product_id int")
    assert union_all([a, b]).count() == 2


FEEDS = [FeedSpec("r1", has_product_id=True, zip_department=False),
         FeedSpec("r2", has_product_id=False, zip_department=True, add_columns={"volume_unit": "KG"})]
FEED_SCHEMA = ("retailer string, product_id string, product_code string, level_1 string, segment_1 string, "
               "department string, zip_code string, year string, turnover string, volume double, volume_unit string")


def small_feed(spark):
    rows = [
        ("r1", " 11 ", "C1", " A\t", "s", "FR/5", None, "2024", "1,5 ", 1.0, "G"),
        ("r1", "0", "C2", "A", "s", "01", None, "2024", "2", 1.0, "G"),      # placeholder id: dropped
        ("r1", None, "C3", "", None, "974", None, "2024", "3", 0.0, "G"),    # null id: dropped
        ("r2", None, "C4", None, "s", "x", "05000", "2024", "-4", -1.0, "L"),  # no-id feed: kept
    ]
    return spark.createDataFrame(rows, FEED_SCHEMA)


def test_standardize_feed(spark):
    out = {r.product_code: r for r in standardize_feed(small_feed(spark), FEEDS).collect()}
    assert set(out) == {"C1", "C4"}
    c1, c4 = out["C1"], out["C4"]
    assert (c1.product_id, c1.level_1, c1.department, c1.turnover, c1.volume_unit) == ("11", "A", "05", 1.5, "G")
    assert c1.level_7 == "NON RENSEIGNE" and c1.segment_6 == "NON RENSEIGNE"
    assert (c4.level_1, c4.department, c4.turnover, c4.volume_unit) == ("NON RENSEIGNE", "05", -4.0, "KG")


def product_map_frame(spark):
    rows = [("r1", "A", "STD_A", "F1"), ("r1", "A", "STD_A", "F2"),   # duplicate key: fan-out
            ("r1", "   ", "STD_BLANK", "F"), ("r2", None, "STD_NR", "F")]
    return spark.createDataFrame(rows, "ENTREPRISE string, level_1 string, level_1_standard string, "
                                       "level_2_standard string")


def test_prepare_map_fills_before_strip(spark):
    pm = prepare_product_map(product_map_frame(spark), retailers=["r1", "r2"],
                             standards=["level_1_standard", "level_2_standard"])
    got = sorted((r.retailer, r.level_1) for r in pm.collect())
    # whitespace-only stays '' (never matches); null becomes the filler
    assert got == [("r1", ""), ("r1", "A"), ("r1", "A"), ("r2", "NON RENSEIGNE")]


def silver_frame(spark):
    std = standardize_feed(small_feed(spark), FEEDS)
    pm = prepare_product_map(product_map_frame(spark), retailers=["r1", "r2"],
                             standards=["level_1_standard", "level_2_standard"])
    cm = spark.createDataFrame([("r1", "s", "PRO")], "retailer string, segment_1 string, segment_1_standard string")
    cm = add_required_columns(cm, {c: "NON RENSEIGNE" for c in CUSTOMER_SEGMENTS})
    return std, build_silver(std, pm, cm, product_standards=["level_1_standard", "level_2_standard"],
                             customer_standards=["segment_1_standard"])


def test_mapping_fan_out_and_quality(spark):
    std, silver = silver_frame(spark)
    rows = silver.collect()
    assert len(rows) == 3  # C1 matches twice, C4 once
    assert sorted(r.level_2_standard for r in rows if r.product_code == "C1") == ["F1", "F2"]
    assert {r.classification for r in rows if r.product_code == "C1"} == {">".join(["A"] + ["NON RENSEIGNE"] * 6)}
    pm = prepare_product_map(product_map_frame(spark), retailers=["r1", "r2"],
                             standards=["level_1_standard", "level_2_standard"])
    cm = add_required_columns(spark.createDataFrame([("r1", "s", "PRO")],
                                                    "retailer string, segment_1 string, segment_1_standard string"),
                              {c: "NON RENSEIGNE" for c in CUSTOMER_SEGMENTS})
    mr = {r.retailer: tuple(r)[1:] for r in match_rate(std, pm, cm).collect()}
    counted = silver.groupBy("retailer").agg(F.count("level_1_standard"), F.count("segment_1_standard")).collect()
    assert mr == {"r1": (1, 2, 2), "r2": (1, 1, 0)} == {r[0]: (1, r[1], r[2]) for r in counted}
    keys = distinct_keys(std.unionByName(std))  # a key table carries its line counts
    assert {r.retailer: tuple(r)[1:] for r in match_rate(keys, pm, cm, lines="n_lines").collect()} == {"r1": (2, 4, 4), "r2": (2, 2, 0)}
    assert unmatched_products(silver, standards=["level_1_standard", "level_2_standard"]).count() == 0


def test_check_unicity(spark):
    df = spark.createDataFrame([("r", "p1", "A", "X"), ("r", "p1", "B", "X"), ("r", "p2", "A", "X"),
                                ("r", "p2", "A", "X"), ("r", None, "A", "Y"), ("r", None, "B", "Y")],
                               "retailer string, product_id string, level_1 string, level_1_standard string")
    offenders, details = check_unicity(df, ["product_id"], ["level_1_standard", "level_1"])
    assert sorted(r.product_id or "" for r in offenders.collect()) == ["", "p1"]
    # null keys never match the semi-join (as a membership test drops them)
    assert sorted(tuple(r) for r in details.collect()) == [("r", "p1", "X", "A"), ("r", "p1", "X", "B")]
    assert check_unicity(df, ["missing"], ["level_1"]) is None


def test_kpis_count_null_ids_and_zero_sums(spark):
    df = spark.createDataFrame([("r", "2024", "A", None, "c1", None), ("r", "2024", "A", None, "c2", None),
                                ("s", "2024", "A", "p", "c1", 2.0)],
                               "retailer string, year string, level_1_standard string, product_id string, "
                               "product_code string, turnover double")
    got = {r.retailer: (r.turnover, r.nb_product_ids, r.nb_product_codes)
           for r in compute_kpis(df, ["year", "level_1_standard"]).collect()}
    assert got == {"r": (0.0, 1, 2), "s": (2.0, 1, 1)}
    no_id = compute_kpis(df.drop("product_id"), ["year"]).collect()
    assert {r.nb_product_ids for r in no_id} == {1}


def lattice_input(spark):
    rows = []
    for i in range(60):
        rows.append((f"r{i % 3}", str(2020 + i % 2), f"D{i % 4}", f"S{i % 2}", f"T{i % 3}", f"U{i % 2}",
                     f"L{i % 2}", f"M{i % 3}", f"N{i % 4}", None if i % 7 == 0 else f"O{i % 2}",
                     None if i % 5 == 0 else f"p{i % 9}", f"c{i % 6}", float(i % 11) - 3.0))
    schema = ("retailer string, year string, department string, segment_1_standard string, "
              "segment_2_standard string, segment_3_standard string, level_1_standard string, "
              "level_2_standard string, level_3_standard string, level_4_standard string, product_id string, "
              "product_code string, turnover double")
    return spark.createDataFrame(rows, schema)


def test_lattice_agrees_with_group_bys_and_sums(spark):
    df = lattice_input(spark)
    grains = kpi_grains(4)
    assert len(grains) == 20 and incremental_sublists([1, 2, 3]) == [[1], [1, 2], [1, 2, 3]]
    a = kpi_lattice(df, grains, amount_scale=2)
    for g in grains:  # every grain against a group-by of its own, by the library's own aggregates
        own = df.groupBy("retailer", *g.columns).agg(sum_or_zero("turnover", scale=2), n_unique("product_id"), n_unique("product_code"))
        of = a.filter(F.col("grain") == g.name).select("retailer", *g.columns, "turnover", "nb_product_ids", "nb_product_codes")
        assert sorted(map(tuple, of.collect()), key=str) == sorted(map(tuple, own.collect()), key=str)
    total = sum(r.turnover for r in df.collect())
    for g in grains:  # the turnover of every grain adds up to the silver total
        s = a.filter(F.col("grain") == g.name).agg(F.sum("turnover")).collect()[0][0]
        assert math.isclose(s, total, abs_tol=1e-9)
    # one grain checked against a direct group-by
    direct = compute_kpis(df, ["year", "department", "level_1_standard"], amount_scale=2)
    l1dep = a.filter(F.col("grain") == "l1Dep").select(*direct.columns)
    assert sorted(map(tuple, direct.collect()), key=str) == sorted(map(tuple, l1dep.collect()), key=str)


def test_market_share_sums_to_one(spark):
    grains = kpi_grains(2, ["", "Dep"])
    ms = market_share_lattice(kpi_lattice(lattice_input(spark), grains), grains).collect()
    cells = {}
    for r in ms:
        key = (r.grain, r.year, r.department, r.level_1_standard, r.level_2_standard)
        cells.setdefault(key, []).append(r)
    for rs in cells.values():
        assert math.isclose(sum(r.ms_nb_product_ids for r in rs), 1.0)
        tot = sum(r.turnover for r in rs)
        if tot != 0:
            assert math.isclose(sum(r.ms_turnover for r in rs), 1.0)


def test_market_share_zero_total(spark):
    df = spark.createDataFrame([("a", "x", 1.0, 1), ("b", "x", -1.0, 1), ("a", "y", 0.0, 1)],
                               "retailer string, g string, turnover double, nb_product_ids int")
    got = {(r.retailer, r.g): r.ms_turnover for r in market_share(df, ["g"]).collect()}
    assert got[("a", "x")] == math.inf and got[("b", "x")] == -math.inf and math.isnan(got[("a", "y")])
    got = {(r.retailer, r.g): r.ms_turnover for r in market_share(df, ["g"], on_zero_total="null").collect()}
    assert set(got.values()) == {None}


MIS_SCHEMA = "retailer string, product_id string, level_1_standard string, level_2_standard string"


def brute_force_conflicts(rows, levels, min_present):
    """Reference rule, brute force: a product qualifies when some combination
    (one variant per retailer carrying it) has >= min_present non-null level 1
    and >1 distinct non-null value at some level."""
    by = {}
    for r in rows:
        by.setdefault(r[1], {}).setdefault(r[0], set()).add(r[2:])
    bad = set()
    for pid, per in by.items():
        for combo in itertools.product(*[sorted(v, key=str) for v in per.values()]):
            present = sum(1 for v in combo if v[0] is not None)
            conflict = any(len({v[i] for v in combo if v[i] is not None}) > 1 for i in range(len(levels)))
            if present >= min_present and conflict:
                bad.add(pid)
    return bad


def test_misclassification_matches_brute_force(spark):
    rows = [
        ("a", "p1", "X", "F"), ("b", "p1", "Y", "F"),                       # conflict level 1
        ("a", "p2", "X", "F"), ("a", "p2", "Y", "F"), ("b", "p2", None, None),  # variance inside one retailer only
        ("a", "p3", "X", "F"), ("b", "p3", "X", "F"),                       # agree
        ("a", "p4", "X", "F"), ("b", "p4", "X", "G"), ("c", "p4", "X", "G"),  # conflict level 2
        ("a", "p5", "X", "F"),                                              # one retailer
        ("a", "p6", "X", "F"), ("a", "p6", "X", "G"), ("b", "p6", "X", "F"),  # cross-retailer via fan-out
    ]
    df = spark.createDataFrame(rows, MIS_SCHEMA)
    levels = ["level_1_standard", "level_2_standard"]
    got = {r.product_id for r in conflicting_products(df, levels=levels, min_present=2).collect()}
    assert got == brute_force_conflicts(rows, levels, 2) == {"p1", "p4", "p6"}
    kept = sorted(tuple(r) for r in misclassification_variants(df, levels=levels).select("retailer", "product_id", *levels).collect())
    assert kept == sorted(r for r in rows if r[1] in ("p1", "p4", "p6"))
    long = {(r.product_id, r.level, r.standard): r.retailers for r in misclassification_long(df, levels=levels).collect()}
    assert long[("p4", "level_2_standard", "G")] == "b,c"


def test_misclassification_rule_on_random_rows(spark):
    """Presence and conflict on the same combination, with null level 1 beside
    filled lower levels, for every threshold."""
    rng = random.Random(11)
    rows = [("a", "case", None, "X"), ("a", "case", "L", "Y"), ("b", "case", "L", "Y")]
    for p in range(400):
        for r in "abcd"[:rng.randint(1, 4)]:
            for _ in range(rng.randint(1, 3)):
                rows.append((r, f"p{p}", rng.choice([None, None, "X", "Y"]), rng.choice([None, "F", "G", "H"])))
    levels = ["level_1_standard", "level_2_standard"]
    df = spark.createDataFrame(sorted(set(rows), key=str), MIS_SCHEMA)
    for n in (1, 2, 3, 4):
        got = {r.product_id for r in conflicting_products(df, levels=levels, min_present=n).collect()}
        assert got == brute_force_conflicts(rows, levels, n)
    assert "case" not in {r.product_id for r in conflicting_products(df, levels=levels, min_present=2).collect()}


def test_fourth_level_as_the_source_has_it(spark):
    df = spark.createDataFrame([("a", "p", "X", "F", "S", "I"), ("b", "p", "X", "F", "S", "J")],
                               MIS_SCHEMA + ", level_3_standard string, level_4_standard string")
    assert conflicting_products(df).count() == 1
    assert conflicting_products(df, compat_level4=True).count() == 0


def test_column_name_helpers(spark):
    df = spark.createDataFrame([("p", "n", "l")], "product_id string, name string, level_1 string")
    suffixed = suffix_columns(df, "metro", keep=["product_id"])
    assert suffixed.columns == ["product_id", "name_metro", "level_1_metro"]
    assert strip_suffix(suffixed, "metro").columns == df.columns
    assert columns_with_prefix(suffixed, "level") == columns_with_prefix(suffixed, "l", "_metro") == ["level_1_metro"]
    assert tag_retailer(df, "r").first()["retailer"] == "r"


def test_text_of_mixed_types(spark):
    df = spark.createDataFrame([(3012345678901.0, 2.5, None, 7)], "a double, b double, c double, d long")
    assert [df.select(as_text(df, c)).first()[0] for c in df.columns] == ["3012345678901", "2.5", None, "7"]


def test_order_report_puts_nulls_first(spark):
    df = spark.createDataFrame([("b", 1), (None, 2), ("a", 3)], "k string, v int")
    assert [r.v for r in order_report(df, ["k"]).collect()] == [2, 3, 1]


def test_amounts_with_four_decimals(spark):
    df = spark.createDataFrame([("r", "2024", "p", "c", 0.0001), ("r", "2024", "p", "c", 12.3456)],
                               "retailer string, year string, product_id string, product_code string, turnover double")
    assert compute_kpis(df, ["year"], amount_scale=AMOUNT_SCALE).first()["turnover"] == 12.3457


def test_comparison_rows_drop_placeholder_and_null(spark):
    df = spark.createDataFrame([("a", "p", "A L'EAN"), ("a", "p", None), ("a", "p", "ITEM"), ("z", "p", "ITEM")],
                               "retailer string, product_id string, level_4_standard string")
    out = comparison_rows(df, ["a"], columns=["level_4_standard"]).collect()
    assert [tuple(r) for r in out] == [("a", "p", "ITEM")]


def test_any_row_per_key_is_smallest(spark):
    df = spark.createDataFrame([("k", "b", 2.0), ("k", None, 9.0), ("k", "a", 1.0), ("j", "z", None)],
                               "k string, x string, y double")
    got = {r.k: (r.x, r.y) for r in any_row_per_key(df, ["k"]).collect()}
    assert got == {"k": (None, 9.0), "j": ("z", None)}


def test_unit_inconsistency_matches_brute_force(spark):
    rows = [("a", "1", "n1", 1.0, "KG"), ("a", "1", "n0", 2.0, "KG"), ("b", "1", "m", 1.0, "KG"),
            ("b", "1", "m", 3.0, "L"), ("a", "2", "x", 1.0, "G"), ("b", "2", "y", 1.0, "G"),
            ("a", "3", "x", None, "L"), ("b", "3", "y", 5.0, None), ("b", "3", "w", 5.0, "G")]
    df = spark.createDataFrame(rows, "retailer string, product_id string, product_name string, volume double, "
                                     "volume_unit string")
    got = {r.product_id: tuple(r)[1:] for r in unit_inconsistency(df, "a", "b").collect()}

    def key(t):
        return tuple((0, "") if v is None else (1, v) for v in t)
    expect = {}
    for x in rows:
        for y in rows:
            if x[0] == "a" and y[0] == "b" and x[1] == y[1] and x[4] and y[4] and x[4] != y[4]:
                pair = x[2:] + y[2:]
                if x[1] not in expect or key(pair) < key(expect[x[1]]):
                    expect[x[1]] = pair
    assert got == expect


def test_volume_turnover_signs(spark):
    df = spark.createDataFrame([("r", 0.0, 5.0), ("r", None, -1.0), ("r", None, None), ("r", -2.0, 3.0),
                                ("r", -2.0, -3.0), ("r", 2.0, -3.0), ("r", 2.0, 3.0)],
                               "retailer string, volume double, turnover double")
    r = volume_turnover_signs(df).collect()[0]
    assert (r.v0tp, r.v0tn, r.v0t0, r.vntp, r.vntn, r.vptn) == (1, 1, 1, 1, 1, 1)


def test_map_products_on_retailer_key(spark):
    feed = spark.createDataFrame([("r1", *["A"] * 7), ("r2", *["A"] * 7)],
                                 "retailer string, " + ", ".join(f"{c} string" for c in PRODUCT_LEVELS))
    pm = spark.createDataFrame([("r1", *["A"] * 7, "S")],
                               "retailer string, " + ", ".join(f"{c} string" for c in PRODUCT_LEVELS)
                               + ", level_1_standard string")
    got = {r.retailer: r.level_1_standard for r in map_products(feed, pm, standards=["level_1_standard"]).collect()}
    assert got == {"r1": "S", "r2": None}


def test_union_feed_maps_renames_per_sheet(spark):
    from gondola.config import FEEDS
    from gondola.operators.standardize import union_feed_maps

    coup = spark.createDataFrame([("F", "Std1")], "`[Famille Produit]` string, `Modele 1 Niv 1 BIS` string")
    metro = spark.createDataFrame([("SA1", "Std2")], "SA string, `Modele 1 Niv 1 BIS` string")
    out = union_feed_maps({"coup_de_pates": coup, "metro": metro}, list(FEEDS.values()))
    got = sorted((r.ENTREPRISE, r.level_1, r.level_1_standard) for r in out.collect())
    assert got == [("coup_de_pates", "F", "Std1"), ("metro", "SA1", "Std2")]


def test_lines_without_a_key_are_spread_by_a_map_join(spark):
    """With broadcast off, a third of the lines with a null level lie in many partitions; the result is the plain join's."""
    feed = spark.range(3000).select(F.lit("a").alias("retailer"), F.when(F.col("id") % 3 > 0, F.concat(F.lit("L"), F.col("id") % 7)).alias("level_1"),
                                    F.col("id").alias("line"))
    mapping = spark.createDataFrame([("a", f"L{i}", f"S{i}") for i in range(5)] + [("a", None, "never")], "retailer string, level_1 string, level_1_standard string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        got = map_products(feed, mapping, levels=["level_1"], standards=["level_1_standard"])
        assert got.columns == ["retailer", "level_1", "line", "level_1_standard"]
        parts = {p for level, p in got.select("level_1", F.spark_partition_id()).collect() if level is None}
        plain = feed.join(mapping, ["retailer", "level_1"], "left").select(got.columns)
        assert len(parts) > 3 and got.exceptAll(plain).count() == plain.exceptAll(got).count() == 0
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_ordered_positions(spark):
    rows = [(None, 3, "x"), ("b", None, "y"), ("a", 1, "z"), ("b", 2, "q"), ("a", 1, "z"), ("a", 1, None), ("", 5, "w")] * 40
    df = spark.createDataFrame(rows, "k string, v int, t string").repartition(7)
    for parts in (1, 3, 64):
        got = sorted(ordered_positions(df, ["k", "v"], parts=parts).collect(), key=lambda r: r["position"])
        assert [r["position"] for r in got] == list(range(len(rows)))
        assert [tuple(r)[:3] for r in got] == sorted(rows, key=lambda r: tuple((x is not None, x) for x in r))
    assert ordered_positions(df.limit(0), ["k"]).count() == 0


def test_lattice_counts_repeated_and_null_ids(spark):
    """Every grain against a plain count of distinct ids and codes, nulls counted as a value."""
    rng = random.Random(1)
    pick = lambda *x: rng.choice(x)
    rows = [(pick("r", "s"), pick("2023", "2024"), pick("01", None), pick("P", None), pick("H", "N"), "T", pick("A", "B", None), pick("a", "b"), pick("x", None),
             "i", pick("1", "2", "3", None), pick("c", "d", None), float(rng.randrange(-5, 9))) for _ in range(300)]
    dims = ["year", "department", "segment_1_standard", "segment_2_standard", "segment_3_standard", *PRODUCT_STANDARDS]
    df = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in ["retailer", *dims, "product_id", "product_code"]) + ", turnover double")
    for grains in (kpi_grains(4), kpi_grains(2, ["", "Dep"]), [Grain("one", ("year",), ("level_2_standard",)), Grain("two", ("department",), ("level_1_standard",))]):
        used = lattice_columns(grains)
        expected = {}
        for g in grains:
            cells = defaultdict(list)
            for r in rows:
                d = dict(zip(["retailer", *dims, "product_id", "product_code", "turnover"], r))
                cells[(g.name, d["retailer"], *[d[c] if c in g.columns else None for c in used])].append(d)
            expected |= {k: (sum(d["turnover"] for d in v), len({d["product_id"] for d in v}), len({d["product_code"] for d in v})) for k, v in cells.items()}
        got = {tuple(r)[:-3]: tuple(r)[-3:] for r in kpi_lattice(df, grains).collect()}
        assert got == expected


def test_cleaning_together_is_cleaning_apart(spark):
    from gondola.operators.standardize import fill_empty_columns, strip_columns, strip_together

    rows = [("\u00a0a\t", None), ("", "  "), (None, "b c"), ("\u3000", "\n")]
    df = spark.createDataFrame(rows, "`a.b` string, c string").withColumn("n", F.lit(1))
    apart, together = strip_columns(df.withColumnRenamed("a.b", "ab"), ["ab", "c"]), strip_together(df.withColumnRenamed("a.b", "ab"), ["ab", "missing", "c"])
    assert together.columns == apart.columns == ["ab", "c", "n"]
    assert [tuple(r) for r in together.collect()] == [tuple(r) for r in apart.collect()] == [("a", None, 1), ("", "", 1), (None, "b c", 1), ("", "", 1)]
    filled = fill_empty_columns(together, ["ab", "c"], "-")
    assert [tuple(r)[:2] for r in filled.collect()] == [("a", "-"), ("-", "-"), ("-", "b c"), ("-", "-")]
    assert not filled.schema["ab"].nullable and not filled.schema["c"].nullable


def test_a_map_join_computes_only_what_is_read(spark):
    """The key that spreads lines reads no column that a report does not."""
    names = ["product_id", "product_code", "product_name", "month", "level_1"]
    feed = spark.range(5).select(F.when(F.col("id") > 0, "a").alias("retailer"), *[F.concat(F.lit(c), F.col("id")).alias(c) for c in names])
    mapping = spark.createDataFrame([("a", "level_11", "S")], "retailer string, level_1 string, level_1_standard string")
    got = map_products(feed, mapping, levels=["level_1"], standards=["level_1_standard"]).select("retailer", "level_1_standard")
    assert "__spread" in got._jdf.queryExecution().optimizedPlan().toString()
    assert "product_name" not in got._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(got.collect(), key=str) == sorted([(None, None), ("a", "S")] + [("a", None)] * 3, key=str)


def test_edges_of_texts_are_stripped_as_btrim_does(spark):
    from gondola.functions.text import UNICODE_WHITESPACE, strip_chars, strip_edges

    signs = [*UNICODE_WHITESPACE, "a", "~", "!", "\x00", "\x1f", "\x7f", "\x80", "\u00e9", "\u200b", "\U0001f600"]
    rows = [(a + b + c,) for a in signs for b in ("", "x y") for c in signs] + [(a,) for a in signs] + [("",), (None,)]
    df = spark.createDataFrame(rows, "`a.b` string")
    assert df.filter(~strip_edges("a.b").eqNullSafe(strip_chars("a.b"))).count() == 0
    plan = df.select(strip_edges("a.b"))._jdf.queryExecution().executedPlan().toString()
    assert "substring" in plan  # bare texts are not given to btrim


def test_the_last_sign_of_a_text_is_read_as_a_byte(spark):
    from gondola.functions.text import strip_edges

    df = spark.createDataFrame([("caf\u00e9",), ("caf\u00e9\u00a0",), ("\u3000caf\u00e9~",)], "t string")
    assert [r.s for r in df.select(strip_edges("t").alias("s")).collect()] == ["caf\u00e9", "caf\u00e9", "caf\u00e9~"]
    assert "as binary" in df.select(strip_edges("t"))._jdf.queryExecution().optimizedPlan().toString()


def test_lattice_sorts_once_for_each_chain(spark):
    """grains are covered by the fewest chains, and a grain stands in one only."""
    from gondola.operators.kpis import _chains, kpi_grains

    for n, dims, most in ((4, ["", "Dep"], 2), (3, ["", "Dep"], 2), (4, ["", "Dep", "c1Dep", "c2Dep", "c3Dep"], 4), (1, ["", "Dep"], 1)):
        grains = kpi_grains(n, dims)
        chains = _chains(grains, ["year", "level_1_standard"])
        assert len(chains) <= most and sorted(g.name for c in chains for g, _ in c) == sorted(g.name for g in grains)
        for chain in chains:
            held = set()
            for g, added in chain:
                held |= set(added)
                assert held == set(g.columns) - {"year", "level_1_standard"}


def test_maps_of_the_feed_from_numbers(spark, tmp_path):
    """The maps hold what the whole join gives, null and repeated keys and two names of a region included."""
    from gondola.testfeed import BASE_SQL, CUSTOMER_MAP_SQL, PRODUCT_MAP_SQL, DRIVER_TABLES, FixtureFeed

    small = {t: spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet") for t in DRIVER_TABLES}
    region, nation = small["region"], small["nation"]
    small["region"] = region.union(region.limit(2)).union(region.limit(1).withColumn("r_name", F.lit("OTHER"))).union(region.limit(1).withColumn("r_name", F.lit(None).cast("string")))
    small["nation"] = nation.withColumn("n_regionkey", F.when(F.col("n_nationkey") != 3, F.col("n_regionkey"))).union(nation.limit(2))
    for t, df in small.items():
        df.write.parquet(f"{tmp_path}/{t}.parquet")
    tables = {t: spark.read.parquet(f"{tmp_path}/{t}.parquet") for t in DRIVER_TABLES}
    base = spark.sql(BASE_SQL, **tables)
    fx = FixtureFeed(spark, str(tmp_path))
    for got, sql in ((fx.product_map, PRODUCT_MAP_SQL), (fx.customer_map, CUSTOMER_MAP_SQL)):
        want = sorted(map(str, spark.sql(sql, base=base).collect()))
        assert want and sorted(map(str, got.collect())) == want


def test_lattice_packs_any_texts(spark):
    """a cell travels as one text; signs used for that, empty texts, nulls and numbers stay apart."""
    from gondola.operators.kpis import _packed, _unpacked

    odd = [None, "", "\u0001", "\u0002", "\u0002a", "\u0002b", "a\u0001", "\u0001\u0002", "a"]
    names = ["a", "b", "c"]
    df = spark.createDataFrame([(x, y, z) for x in odd for y in odd for z in odd], "a string, b string, c string")
    back = df.select(*names, _packed(names).alias("t")).select(*names, "t", F.struct(*_unpacked("t", names)).alias("u"))
    assert back.filter(~F.struct(*names).eqNullSafe(F.col("u"))).count() == 0
    assert back.select("t").distinct().count() == len(odd) ** 3

    rng = random.Random(2)
    rows = [(rng.randrange(2), rng.randrange(2023, 2025), rng.choice(odd), rng.choice(odd), rng.choice(odd), rng.choice(odd), rng.choice(odd), float(rng.randrange(9))) for _ in range(400)]
    lines = spark.createDataFrame(rows, "retailer int, year int, department string, level_1_standard string, level_2_standard string, product_id string, product_code string, turnover double")
    grains = kpi_grains(2, ["", "Dep"])
    got = kpi_lattice(lines, grains, amount_scale=2)
    assert got.schema["retailer"].dataType.simpleString() == "int" and got.schema["year"].dataType.simpleString() == "string"
    for g in grains:
        cells = defaultdict(list)
        for r in rows:
            d = dict(zip(lines.columns, r)) | {"year": str(r[1])}
            cells[(d["retailer"], *[d[c] for c in g.columns])].append(d)
        of = got.filter(F.col("grain") == g.name).select("retailer", *g.columns, "turnover", "nb_product_ids", "nb_product_codes")
        assert {tuple(r)[:-3]: tuple(r)[-3:] for r in of.collect()} == {k: (sum(d["turnover"] for d in v), len({d["product_id"] for d in v}), len({d["product_code"] for d in v})) for k, v in cells.items()}


def test_lattice_of_many_grains(spark):
    """Flags of more grains than a number has bits."""
    grains = [Grain(f"g{i}", ("year", "department") if i % 2 else ("year",), ("level_1_standard",)) for i in range(130)]
    got = defaultdict(set)
    for r in kpi_lattice(lattice_input(spark), grains).collect():
        got[r.grain].add(tuple(r)[1:])
    assert len(got) == 130 and all(got[f"g{i}"] == got[f"g{i % 2}"] for i in range(130)) and got["g0"] != got["g1"]
