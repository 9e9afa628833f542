"""DuckDB oracle SQL for every registered query (same names as ``QUERIES``).

Each text is self-contained: a ``WITH`` clause rebuilds the test feed from
the driver tables (pre-registered as views), then every stage (standardised
feed, prepared maps, silver, KPIs) as a CTE, written independently of the
Spark code from the operator definitions.

Engine differences handled in the SQL: DuckDB's ``\\s`` is ASCII (Unicode
edges are ``[\\s\\p{Z}]``), ``regexp_replace`` without ``'g'`` replaces the
first match only, an unmatched regex group is null (Spark: ``''``), and
``ORDER BY`` sorts nulls last unless told otherwise.
"""

from __future__ import annotations

from gondola.config import (
    CUSTOMER_SEGMENTS,
    CUSTOMER_STANDARDS,
    NOT_FILLED,
    PRODUCT_LEVELS,
    PRODUCT_STANDARDS,
)
from gondola.operators.kpis import kpi_grains, lattice_columns
from gondola.testfeed import RETAILERS, RETAILERS_WITH_ID, duckdb_views

NR = f"'{NOT_FILLED}'"
WITH_IDS = ", ".join(f"'{r}'" for r in RETAILERS_WITH_ID)
ALL_RETAILERS = ", ".join(f"'{r}'" for r in RETAILERS)
PLACEHOLDERS = "'A L''EAN', 'A l''EAN'"
# RE2 flavour of the quantity patterns (ASCII fixture labels, so no (?U))
QTY = r"'(?i)(\d+(?:\.|,)*\d*)\s*(g|kg|k|ml|cl|l|gr)\s*(x\s*\d+(?:(?:\s|\))*x\s*\d+)*)?'"
QTY_STRICT = r"'(?i)\b(\d+(?:\.|,)*\d*)\s*(g|kg|ml|cl|l|gr)\s*(x\s*\d+(?:\s*x\s*\d+)*)?\b'"


def strip(x: str) -> str:
    return rf"regexp_replace(CAST({x} AS VARCHAR), '^[\s\p{{Z}}]+|[\s\p{{Z}}]+$', '', 'g')"


def fill(x: str) -> str:
    return f"CASE WHEN {x} IS NULL OR {x} = '' THEN {NR} ELSE {x} END"


def zfill2(x: str) -> str:
    return f"CASE WHEN length({x}) >= 2 THEN {x} ELSE lpad({x}, 2, '0') END"


def amount(x: str) -> str:
    return f"CAST(regexp_replace(regexp_replace({x}, ',', '.'), ' ', '') AS DOUBLE)"


def nunique(c: str) -> str:
    return f"CAST(count(DISTINCT {c}) + coalesce(max(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END), 0) AS INTEGER)"


def dec_sum(c: str) -> str:
    return f"coalesce(CAST(sum(CAST({c} AS DECIMAL(38,6))) AS DOUBLE), 0.0)"


def cols(names, prefix: str = "") -> str:
    return ", ".join(f"{prefix}{c}" for c in names)


_levels_std = [f"{fill(strip(c))} AS {c}" for c in PRODUCT_LEVELS[:3]] + [f"{NR} AS {c}" for c in PRODUCT_LEVELS[3:]]
_segments_std = [f"{fill(strip(c))} AS {c}" for c in CUSTOMER_SEGMENTS[:3]] + [f"{NR} AS {c}" for c in CUSTOMER_SEGMENTS[3:]]
_dep_raw = "CASE WHEN retailer = 'asia' THEN left(zip_code, 2) ELSE CAST(department AS VARCHAR) END"
_dep = zfill2(f"regexp_replace({_dep_raw}, '^0|FR/', '')")

STD = f"""std AS (
  SELECT retailer, {strip('product_id')} AS product_id, {strip('product_code')} AS product_code,
    {strip('product_name')} AS product_name, {strip('brand_name')} AS brand_name,
    {', '.join(_levels_std)}, {', '.join(_segments_std)},
    {_dep} AS department, zip_code, {strip('year')} AS year, month,
    {amount('turnover')} AS turnover, volume,
    CASE WHEN retailer = 'africa' THEN 'KG' ELSE {strip('volume_unit')} END AS volume_unit
  FROM feed
  WHERE retailer = 'middle_east'
     OR ({strip('product_id')} IS NOT NULL AND {strip('product_id')} NOT IN ('', '0', '#', 'Non Defini'))
)"""


def _prepared(owner: str, source: str, natives_present: list[str], natives_all: list[str], standards: list[str]) -> str:
    items = [f"{strip(owner)} AS retailer"]
    for c in natives_all:
        if c in natives_present:
            items.append(f"{strip(fill(c))} AS {c}")
        else:
            items.append(f"{NR} AS {c}")
    items += [f"{strip(c)} AS {c}" for c in standards]
    return f"SELECT {', '.join(items)} FROM {source} WHERE {owner} IN ({ALL_RETAILERS})"


PMAP = f"pmap AS ({_prepared('ENTREPRISE', 'product_map', PRODUCT_LEVELS[:3], PRODUCT_LEVELS, PRODUCT_STANDARDS)})"
CMAP = f"cmap AS ({_prepared('ENSEIGNE', 'customer_map', CUSTOMER_SEGMENTS[:3], CUSTOMER_SEGMENTS, CUSTOMER_STANDARDS)})"

_pjoin = " AND ".join(f"s.{c} = p.{c}" for c in ["retailer", *PRODUCT_LEVELS])
_cjoin = " AND ".join(f"s.{c} = c.{c}" for c in ["retailer", *CUSTOMER_SEGMENTS])
_classification = " || '>' || ".join(f"s.{c}" for c in PRODUCT_LEVELS)

SILVER = f"""silver AS (
  SELECT s.retailer, s.product_id, s.product_code, s.product_name, s.brand_name,
    {cols(PRODUCT_LEVELS, 's.')}, {cols(CUSTOMER_SEGMENTS, 's.')},
    {cols(PRODUCT_STANDARDS, 'p.')}, {cols(CUSTOMER_STANDARDS, 'c.')},
    s.department, s.year, s.month, s.turnover, s.volume, s.volume_unit,
    {_classification} AS classification
  FROM std s LEFT JOIN pmap p ON {_pjoin} LEFT JOIN cmap c ON {_cjoin}
)"""


def with_stages(*extra: str) -> str:
    return "WITH " + ",\n".join([duckdb_views(), STD, PMAP, CMAP, SILVER, *extra]) + "\n"


def with_views() -> str:
    return "WITH " + duckdb_views() + "\n"


# ---------------------------------------------------------------- scans and sinks

SQL: dict[str, str] = {}

_NAME = "' a;' || chr(9) || '\"' || level_3 || '\" ' || product_name"
_CELLS = f"SELECT product_code AS code, {_NAME} AS name, CASE WHEN volume_unit <> 'L' THEN volume_unit END AS unit FROM feed"
SQL["csv_scan"] = SQL["tsv_scan"] = with_views() + _CELLS
SQL["cp1252_scan"] = with_views() + "SELECT product_code AS code, translate(product_code, '0123456789', '€‚œŽ™éüß–Ÿ') AS text FROM feed"
SQL["csv_sink"] = with_views() + (f"SELECT code || ';\"' || replace(name, '\"', '\"\"') || '\";' || coalesce(unit, '') AS line FROM ({_CELLS})")
SQL["folder_scan"] = " UNION ALL BY NAME ".join(f"SELECT *, '{t}' AS retailer FROM {t}" for t in ("region", "nation", "supplier"))
SQL["feed_drop"] = "SELECT *, 'even' AS retailer FROM nation UNION ALL SELECT *, 'even' AS retailer FROM nation"

# ---------------------------------------------------------------- shaping

# two of the ten rename maps on each retailer's rows, in the order of the maps
FEED_ORDER = ["coup_de_pates", "ds_restauration", "ducreux", "even", "metro", "pomona", "pro_a_pro", "relais_dor", "sysco", "transgourmet"]
SQL["feed_rename"] = with_views() + " UNION ALL ".join(
    f"SELECT *, '{n}' AS feed FROM feed WHERE retailer = '{RETAILERS[k % 5]}'" for k, n in enumerate(FEED_ORDER))

_NULLS = {c: f"CAST(NULL AS VARCHAR) AS {c}" for c in
          ["product_id", "level_1", "level_2", "level_3", "level_4", "zip_code", "year", "month", "turnover"]}


def _bronze(name: str, retailer: str, **given: str) -> str:
    items = [f"{given[c]} AS {c}" if c in given else n for c, n in _NULLS.items()]
    return f"SELECT '{name}' AS retailer, product_code, {', '.join(items)} FROM feed WHERE retailer = '{retailer}'"


_as_double = "CAST(regexp_replace(turnover, ' ', '') AS DOUBLE)"
SQL["bronze_feeds"] = with_views() + " UNION ALL ".join([
    # a list of ids gives a row each; a row without ids keeps an empty one
    "SELECT * REPLACE (unnest(string_split(product_id, '|')) AS product_id) FROM (" + _bronze(
        "metro", RETAILERS[0], product_id="concat_ws('|', product_id, CASE WHEN level_3 = 'S1' THEN product_code END)", level_1="level_1", year="year",
        turnover=f"CASE WHEN {_as_double} = floor({_as_double}) THEN CAST(CAST({_as_double} AS BIGINT) AS VARCHAR) ELSE CAST({_as_double} AS VARCHAR) END") + ")",
    _bronze("pro_a_pro", RETAILERS[1], level_1="level_1", level_4="CASE WHEN level_3 <> 'S0' THEN level_3 END", year="year", turnover="turnover"),
    _bronze("relais_dor", RETAILERS[2], level_1="'-'", level_2="CASE WHEN level_2 <> 'Brand#1' THEN level_2 END",
            level_3="CASE WHEN level_3 <> 'S2' THEN level_3 END", zip_code="zip_code", year="year", turnover="turnover"),
    _bronze("sysco", RETAILERS[3], level_1="level_1", year="CASE substr(year, 4, 1) WHEN '3' THEN '2023' WHEN '4' THEN '2024' ELSE concat('2', substr(year, 4, 1)) END",
            month="lpad(month, 2, '0')", turnover="turnover"),
    _bronze("transgourmet", RETAILERS[4], year="year", month="lpad(month, 2, '0')", turnover="turnover"),
])

_FEED_COLS = ["product_id", "product_code", "product_name", "brand_name", "level_1", "level_2", "level_3", "segment_1", "segment_2", "segment_3",
              "department", "zip_code", "year", "month", "turnover", "volume", "volume_unit"]


def _assembled(name: str, retailer: str, *gone: str) -> str:
    items = [f"CAST(NULL AS VARCHAR) AS {c}" if c in gone else f"CAST(CAST(volume AS INTEGER) AS VARCHAR) AS {c}" if c == "volume" else c for c in _FEED_COLS]
    return f"SELECT '{name}' AS retailer, {', '.join(items)} FROM feed WHERE retailer = '{retailer}'"


SQL["feed_assembly"] = with_views() + " UNION ALL ".join([
    _assembled("pomona", "america", "month", "zip_code", "volume_unit"),
    _assembled("ducreux", "africa", "product_id", "brand_name", "zip_code", "segment_2", "segment_3"),
    _assembled("relais_dor", "asia", "product_id", "department", "volume_unit"),
    _assembled("metro", "europe", "zip_code", "segment_2", "segment_3", "turnover"),
    _assembled("sysco", "middle_east", "brand_name", "zip_code", "volume_unit", "segment_3"),
])

SQL["feed_required_columns"] = with_views() + (
    "SELECT *, " + ", ".join(f"{NR} AS {c}" for c in PRODUCT_LEVELS[3:] + CUSTOMER_SEGMENTS[3:]) + " FROM feed")

SQL["feed_union"] = with_views() + (
    "SELECT * FROM feed WHERE year < '1998' UNION ALL SELECT * FROM feed WHERE year >= '1998'")

SQL["gtin_explode"] = with_views() + f"""
SELECT retailer, product_code,
  unnest(CASE WHEN g IS NULL THEN [NULL::VARCHAR] ELSE string_split(g, '|') END) AS gtin
FROM (SELECT retailer, product_code,
        CASE WHEN product_id IS NOT NULL THEN concat(product_id, '|', product_code) END AS g
      FROM feed)"""

SQL["period_split"] = """
WITH p AS (
  SELECT o_orderkey,
    CASE WHEN o_orderkey % 11 = 0 THEN lpad(CAST(o_orderkey % 30 AS VARCHAR), 2, '0')
         WHEN o_orderkey % 11 = 1 THEN concat(lpad(CAST(o_orderkey % 30 AS VARCHAR), 2, '0'), '-',
                                             lpad(CAST(month(o_orderdate) AS VARCHAR), 2, '0'), '-X')
         ELSE concat(lpad(CAST(o_orderkey % 30 AS VARCHAR), 2, '0'), '-',
                     lpad(CAST(month(o_orderdate) AS VARCHAR), 2, '0')) END AS yymm,
    CAST(year(o_orderdate) * 100 + month(o_orderdate) AS VARCHAR) AS yyyymm
  FROM orders)
SELECT o_orderkey, yymm, yyyymm,
  CASE WHEN string_split(yymm, '-')[1] = '23' THEN '2023' WHEN string_split(yymm, '-')[1] = '24' THEN '2024'
       ELSE string_split(yymm, '-')[1] END AS year_a,
  string_split(yymm, '-')[2] AS month_a,
  left(yyyymm, 4) AS year_b, right(yyyymm, 2) AS month_b
FROM p"""

SQL["placeholder_null"] = with_views() + """
SELECT retailer, product_code,
  CASE WHEN level_1 = 'LARGE' OR level_1 = '-' THEN NULL ELSE level_1 END AS level_1,
  CASE WHEN level_2 = 'Brand#1' OR level_2 = '-' THEN NULL ELSE level_2 END AS level_2,
  CASE WHEN level_3 = 'S0' OR level_3 = '0' THEN NULL ELSE level_3 END AS level_3,
  CASE WHEN segment_3 = 'P' OR segment_3 = '-' THEN NULL ELSE segment_3 END AS segment_3
FROM feed"""

SQL["suffix_columns"] = with_stages() + """
SELECT DISTINCT product_id, product_name AS product_name_africa, volume_unit AS volume_unit_africa FROM std WHERE retailer = 'africa'"""
SQL["strip_suffix"] = with_stages() + f"""
SELECT DISTINCT retailer, {', '.join(f"{c} AS {c.replace('_standard', '')}" for c in PRODUCT_STANDARDS)} FROM pmap"""

# ---------------------------------------------------------------- scalar cleaning

SQL["row_counts"] = with_views() + """
SELECT retailer, n_null, n_distinct, count(*) AS count FROM (
  SELECT retailer, CAST((level_1 IS NULL)::INT + (level_2 IS NULL)::INT + (level_3 IS NULL)::INT + (product_id IS NULL)::INT AS INTEGER) AS n_null,
    CAST(len(list_distinct([level_1, level_2, level_3, product_id])) AS INTEGER) AS n_distinct FROM feed) GROUP BY ALL"""
SQL["strip_whitespace"] = with_views() + f"SELECT retailer, product_code, {strip('level_1')} AS level_1 FROM feed"

SQL["fill_empty"] = with_views() + (
    f"SELECT retailer, product_code, {fill('level_1')} AS level_1, {fill('level_2')} AS level_2, "
    f"{fill('segment_2')} AS segment_2 FROM feed")

SQL["amount_parse"] = with_views() + f"""
SELECT retailer, product_code, {amount('turnover')} AS turnover,
  CAST(regexp_replace(replace(CAST(volume AS VARCHAR), '.', ','), ',', '.') AS DOUBLE) AS volume,
  regexp_replace(turnover, ' ', '') AS turnover_text
FROM feed"""

SQL["department_clean"] = with_views() + f"""
SELECT DISTINCT retailer, department AS department_raw, zip_code, {_dep} AS department FROM feed"""

SQL["char_repair"] = with_views() + f"""
SELECT DISTINCT 'metro' AS retailer, regexp_replace({strip(fill("replace(level_2, '#', '?')"))}, '\\?', 'ї') AS level_2 FROM product_map"""

SQL["valid_product_filter"] = with_views() + f"""
SELECT retailer, count(*) AS n_rows,
  count_if(retailer = 'middle_east' OR ({strip('product_id')} IS NOT NULL
           AND {strip('product_id')} NOT IN ('', '0', '#', 'Non Defini'))) AS n_kept
FROM feed GROUP BY retailer"""

SQL["classification_path"] = with_views() + (
    "SELECT DISTINCT retailer, level_1 || '>' || level_2 || '>' || level_3 AS classification FROM feed")

# ---------------------------------------------------------------- standardise and map

SQL["standardize_feed"] = with_stages() + "SELECT * FROM std"
SQL["prepare_product_map"] = with_stages() + "SELECT * FROM pmap"
SQL["prepare_customer_map"] = with_stages() + "SELECT * FROM cmap"
_plain_map = [f"{fill(c)} AS {c}" for c in PRODUCT_LEVELS[:3]] + [f"{NR} AS {c}" for c in PRODUCT_LEVELS[3:]]
SQL["prepare_product_map_no_strip"] = with_views() + f"""
SELECT ENTREPRISE AS retailer, {', '.join(_plain_map)}, {cols(PRODUCT_STANDARDS[:2])} FROM product_map WHERE ENTREPRISE IN ({ALL_RETAILERS})"""
SQL["map_products"] = with_stages() + f"""
SELECT s.retailer, s.product_id, s.product_code, {cols(PRODUCT_LEVELS, 's.')}, {cols(PRODUCT_STANDARDS, 'p.')}
FROM std s LEFT JOIN pmap p ON {_pjoin}"""
SQL["map_customers"] = with_stages() + f"""
SELECT s.retailer, s.product_id, s.product_code, {cols(CUSTOMER_SEGMENTS, 's.')}, {cols(CUSTOMER_STANDARDS, 'c.')}
FROM std s LEFT JOIN cmap c ON {_cjoin}"""
SQL["silver"] = with_stages() + "SELECT * FROM silver"

# ---------------------------------------------------------------- quality

SQL["match_rate"] = with_stages() + """
SELECT r.retailer, r.n_rows, m.n_matched, m.n_matched_customer
FROM (SELECT retailer, count(*) AS n_rows FROM std GROUP BY retailer) r
JOIN (SELECT retailer, count_if(level_1_standard IS NOT NULL) AS n_matched,
             count_if(segment_1_standard IS NOT NULL) AS n_matched_customer
      FROM silver GROUP BY retailer) m USING (retailer)"""


def _unmatched(natives, standards):
    cond = " OR ".join(f"{c} IS NULL" for c in standards)
    return with_stages() + f"SELECT DISTINCT retailer, {cols(natives)}, {cols(standards)} FROM silver WHERE {cond}"


SQL["unmatched_products"] = _unmatched(PRODUCT_LEVELS, PRODUCT_STANDARDS)
SQL["unmatched_customers"] = _unmatched(CUSTOMER_SEGMENTS, CUSTOMER_STANDARDS)


def _unicity(subset: str, to_check: list[str], with_id_only: bool) -> str:
    others = [c for c in PRODUCT_LEVELS + PRODUCT_STANDARDS if c not in to_check]
    where = f"WHERE retailer IN ({WITH_IDS})" if with_id_only else ""
    detail = ["retailer", subset, *others, *to_check]
    return with_stages(
        f"d AS (SELECT DISTINCT {cols(detail)} FROM silver {where})",
        f"off AS (SELECT retailer, {subset} FROM (SELECT DISTINCT retailer, {cols(to_check)}, {subset} FROM d) "
        f"GROUP BY retailer, {subset} HAVING count(*) > 1)",
    ) + f"SELECT d.* FROM d SEMI JOIN off ON d.retailer = off.retailer AND d.{subset} = off.{subset}"


SQL["unicity_id_levels"] = _unicity("product_id", PRODUCT_STANDARDS, True)
SQL["unicity_code_levels"] = _unicity("product_code", PRODUCT_STANDARDS, False)
SQL["unicity_code_ids"] = _unicity("product_code", ["product_id"], True)

# ---------------------------------------------------------------- KPIs and shares

KPI_MEASURES = (f"{dec_sum('turnover')} AS turnover, {nunique('product_id')} AS nb_product_ids, "
                f"{nunique('product_code')} AS nb_product_codes")


def _kpis(group: list[str], source: str = "silver") -> str:
    return f"SELECT retailer, {cols(group)}, {KPI_MEASURES} FROM {source} GROUP BY retailer, {cols(group)}"


for _i in range(1, 5):
    SQL[f"kpis_l{_i}"] = with_stages() + _kpis(["year", *PRODUCT_STANDARDS[:_i]])

SQL["kpis_without_id"] = with_stages() + f"""
SELECT retailer, year, level_1_standard, {dec_sum('turnover')} AS turnover, CAST(1 AS INTEGER) AS nb_product_ids,
  {nunique('product_code')} AS nb_product_codes
FROM silver WHERE retailer = 'middle_east' GROUP BY retailer, year, level_1_standard"""


_L2 = ["retailer", "year", *PRODUCT_STANDARDS[:2]]
SQL["kpis_ordered"] = with_stages(f"k AS ({_kpis(_L2[1:])})") + (
    f"SELECT *, row_number() OVER (ORDER BY {', '.join(c + ' NULLS FIRST' for c in _L2)}) - 1 AS position FROM k")
SQL["kpis_turnover_type"] = with_stages(f"k AS ({_kpis(['year', 'level_1_standard'])})") + """
SELECT *, CASE retailer WHEN 'africa' THEN 'net' WHEN 'america' THEN 'brut' WHEN 'asia' THEN 'HT' ELSE 'unknown' END AS turnover_type FROM k"""


def _lattice(grains) -> str:
    dims = lattice_columns(grains)
    parts = []
    for g in grains:
        sel = ", ".join(c if c in g.columns else f"CAST(NULL AS VARCHAR) AS {c}" for c in dims)
        parts.append(f"SELECT '{g.name}' AS grain, retailer, {sel}, {KPI_MEASURES} FROM silver "
                     f"GROUP BY retailer, {cols(g.columns)}")
    return "\nUNION ALL\n".join(parts)


SQL["kpi_lattice"] = with_stages() + _lattice(kpi_grains(4))
SQL["kpi_lattice_model3"] = with_stages() + _lattice(kpi_grains(4, ["", "Dep"]))


def _share(source: str, part: list[str]) -> str:
    p = cols(part)
    return f"""SELECT * EXCLUDE (_tot, _ids),
  CASE WHEN _tot <> 0 THEN turnover / _tot END AS ms_turnover,
  CASE WHEN _ids <> 0 THEN nb_product_ids / _ids END AS ms_nb_product_ids
FROM (SELECT k.*, CAST(sum(CAST(turnover AS DECIMAL(38,6))) OVER (PARTITION BY {p}) AS DOUBLE) AS _tot,
             CAST(sum(nb_product_ids) OVER (PARTITION BY {p}) AS DOUBLE) AS _ids FROM {source} k)"""


SQL["market_share_l1"] = with_stages(f"k AS ({_kpis(['year', 'level_1_standard'])})") + _share(
    "k", ["year", "level_1_standard"])
SQL["market_share_l1_dep"] = with_stages(f"k AS ({_kpis(['year', 'department', 'level_1_standard'])})") + _share(
    "k", ["year", "department", "level_1_standard"])
SQL["market_share_l1_c1"] = with_stages(
    f"k AS ({_kpis(['year', 'department', 'segment_1_standard', 'level_1_standard'])})") + _share(
    "k", ["year", "segment_1_standard", "department", "level_1_standard"])
for _m, _n in ((1, 2), (2, 3), (3, 4)):
    _g = kpi_grains(_n, ["", "Dep"])
    SQL[f"market_share_model{_m}"] = with_stages(f"k AS ({_lattice(_g)})") + _share("k", ["grain", *lattice_columns(_g)])
SQL["market_share_lattice"] = with_stages(f"k AS ({_lattice(kpi_grains(4))})") + _share(
    "k", ["grain", *lattice_columns(kpi_grains(4))])

# ---------------------------------------------------------------- misclassification

MISCLASS_COLS = ["product_name", "classification", "volume_unit", *PRODUCT_STANDARDS, *CUSTOMER_STANDARDS]


def _rows(columns, placeholder: str | None) -> str:
    where = f"retailer IN ({WITH_IDS})"
    if placeholder:
        where += f" AND {placeholder} NOT IN ({PLACEHOLDERS})"
    return f"rows AS (SELECT DISTINCT retailer, product_id, {cols(columns)} FROM silver WHERE {where})"


def _bad(levels) -> str:
    """The rule on rows: two rows of a product from different retailers differ at
    some level, and with the best rows of its other retailers at least two
    rows in all have a level 1."""
    used = list(dict.fromkeys(["level_1_standard", *levels]))
    differ = " OR ".join(f"a.{c} <> b.{c}" for c in levels)
    return (f"v AS (SELECT DISTINCT product_id, retailer, {cols(used)} FROM rows), "
            "has AS (SELECT DISTINCT product_id, retailer FROM v WHERE level_1_standard IS NOT NULL), "
            "n AS (SELECT product_id, count(*) AS n FROM has GROUP BY product_id), "
            "bad AS (SELECT DISTINCT a.product_id FROM v a JOIN v b ON a.product_id = b.product_id AND a.retailer < b.retailer "
            "LEFT JOIN n ON n.product_id = a.product_id "
            "LEFT JOIN has ha ON ha.product_id = a.product_id AND ha.retailer = a.retailer "
            "LEFT JOIN has hb ON hb.product_id = b.product_id AND hb.retailer = b.retailer "
            f"WHERE ({differ}) AND coalesce(n.n, 0) - CASE WHEN ha.retailer IS NOT NULL THEN 1 ELSE 0 END "
            "- CASE WHEN hb.retailer IS NOT NULL THEN 1 ELSE 0 END + CASE WHEN a.level_1_standard IS NOT NULL THEN 1 ELSE 0 END "
            "+ CASE WHEN b.level_1_standard IS NOT NULL THEN 1 ELSE 0 END >= 2)")


_KEPT = "SELECT * FROM rows WHERE product_id IN (SELECT product_id FROM bad)"
NO_UNIT_COLS = [c for c in MISCLASS_COLS if c != "volume_unit"]

SQL["placeholder_class_filter"] = with_stages(_rows(MISCLASS_COLS, "level_4_standard")) + "SELECT * FROM rows"
SQL["misclass_variants"] = with_stages(_rows(MISCLASS_COLS, "level_4_standard"), _bad(PRODUCT_STANDARDS)) + _KEPT
SQL["misclass_no_units"] = with_stages(_rows(NO_UNIT_COLS, "level_4_standard"), _bad(PRODUCT_STANDARDS)) + _KEPT
SQL["misclass_three_levels"] = with_stages(
    _rows(["product_name", "classification", *PRODUCT_STANDARDS[:3]], "level_3_standard"), _bad(PRODUCT_STANDARDS[:3])) + _KEPT
SQL["misclass_two_levels"] = with_stages(
    _rows(["product_name", "classification", *PRODUCT_STANDARDS[:2]], None), _bad(PRODUCT_STANDARDS[:2])) + _KEPT
SQL["misclass_long"] = with_stages(_rows(MISCLASS_COLS, "level_4_standard"), _bad(PRODUCT_STANDARDS)) + (
    "SELECT product_id, level, standard, array_to_string(list_sort(list_distinct(list(retailer))), ',') AS retailers "
    "FROM (" + " UNION ALL ".join(
        f"SELECT product_id, retailer, '{c}' AS level, {c} AS standard FROM rows "
        f"WHERE product_id IN (SELECT product_id FROM bad)" for c in PRODUCT_STANDARDS)
    + ") WHERE standard IS NOT NULL GROUP BY product_id, level, standard")

# ---------------------------------------------------------------- extracts


def _extract(pattern: str) -> str:
    return with_stages() + f"""
SELECT product_name,
  array_to_string(list_transform(range(1, len(n) + 1), lambda i: n[i] || '|' || u[i] || '|' || coalesce(m[i], '')), ';')
    AS new_volume_unit,
  CAST(len(n) AS INTEGER) AS nb_volume_unit
FROM (SELECT product_name, regexp_extract_all(product_name, {pattern}, 1) AS n,
             regexp_extract_all(product_name, {pattern}, 2) AS u,
             regexp_extract_all(product_name, {pattern}, 3) AS m
      FROM (SELECT DISTINCT product_name FROM silver))"""


SQL["volume_extract"] = _extract(QTY)
SQL["volume_extract_strict"] = _extract(QTY_STRICT)

SQL["volume_extract_stats"] = with_stages() + f"""
SELECT retailer, nb_volume_unit, nb_products,
  nb_products / sum(nb_products) OVER (PARTITION BY retailer) AS rate
FROM (SELECT retailer, CAST(len(regexp_extract_all(product_name, {QTY}, 1)) AS INTEGER) AS nb_volume_unit,
             count(*) AS nb_products
      FROM (SELECT DISTINCT retailer, product_name FROM silver) GROUP BY ALL)"""

_SILVER_COLS = ["retailer", "product_id", "product_code", "product_name", "brand_name", *PRODUCT_LEVELS,
                *CUSTOMER_SEGMENTS, *PRODUCT_STANDARDS, *CUSTOMER_STANDARDS, "department", "year", "month",
                "turnover", "volume", "volume_unit", "classification"]
_SAMPLE_KEY = ["retailer", *PRODUCT_LEVELS, *PRODUCT_STANDARDS, "volume_unit"]
_SAMPLE_REST = [c for c in _SILVER_COLS if c not in _SAMPLE_KEY]

SQL["product_sample"] = with_stages() + f"""
SELECT * EXCLUDE (_rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY {cols(_SAMPLE_KEY)}
                               ORDER BY {', '.join(c + ' NULLS FIRST' for c in _SAMPLE_REST)}) AS _rn
  FROM silver) WHERE _rn = 1"""

SQL["volume_missing_sample"] = with_stages() + f"""
SELECT product_name, CAST(0 AS INTEGER) AS nb_volume_unit FROM (SELECT DISTINCT product_name FROM silver)
WHERE len(regexp_extract_all(product_name, {QTY}, 1)) = 0 ORDER BY md5('42' || product_name), product_name LIMIT 40"""

SQL["volume_units"] = with_stages() + "SELECT DISTINCT retailer, volume_unit FROM silver"


def _units_by_level() -> str:
    parts = []
    key = "CASE WHEN retailer = 'middle_east' THEN product_code ELSE product_id END"
    for i in range(1, 5):
        lv = PRODUCT_STANDARDS[:i]
        sel = ", ".join(c if c in lv else f"CAST(NULL AS VARCHAR) AS {c}" for c in PRODUCT_STANDARDS)
        parts.append(f"SELECT 'level_{i}' AS grain, retailer, volume_unit, {sel}, {nunique('_p')} AS nb_products "
                     f"FROM (SELECT *, {key} AS _p FROM silver) GROUP BY retailer, volume_unit, {cols(lv)}")
    return "\nUNION ALL\n".join(parts)


SQL["volume_units_by_level"] = with_stages() + _units_by_level()

SQL["volume_turnover_signs"] = with_stages() + """
SELECT retailer,
  count_if((volume = 0 OR volume IS NULL) AND turnover > 0) AS v0tp,
  count_if((volume = 0 OR volume IS NULL) AND turnover < 0) AS v0tn,
  count_if((volume = 0 OR volume IS NULL) AND (turnover = 0 OR turnover IS NULL)) AS v0t0,
  count_if(volume < 0 AND turnover > 0) AS vntp,
  count_if(volume < 0 AND turnover < 0) AS vntn,
  count_if(volume > 0 AND turnover < 0) AS vptn
FROM silver GROUP BY retailer"""

_UC = ["product_name", "volume", "volume_unit"]
SQL["unit_inconsistency"] = with_stages(
    "a AS (SELECT product_id, product_name, volume, volume_unit FROM silver WHERE retailer = 'africa')",
    "b AS (SELECT product_id, product_name, volume, volume_unit FROM silver WHERE retailer = 'america')",
    "j AS (SELECT a.product_id, " + ", ".join(f"a.{c} AS {c}_africa" for c in _UC) + ", "
    + ", ".join(f"b.{c} AS {c}_america" for c in _UC)
    + " FROM a JOIN b ON a.product_id = b.product_id WHERE a.volume_unit <> b.volume_unit)",
) + ("SELECT * EXCLUDE (_rn) FROM (SELECT *, row_number() OVER (PARTITION BY product_id ORDER BY "
     + ", ".join(f"{c}_africa NULLS FIRST" for c in _UC) + ", "
     + ", ".join(f"{c}_america NULLS FIRST" for c in _UC) + ") AS _rn FROM j) WHERE _rn = 1")
