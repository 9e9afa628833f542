"""Test feed over the driver tables (FIXTURES.md section 5).

Five retailers = supplier regions.  The same SQL text builds the views in
Spark (``spark.sql`` with DataFrame arguments, no global temp views) and in
DuckDB (plain table names), so the oracle and the Spark queries read the
same dirty input: padded, empty and null levels, placeholder ids, mixed
department forms, comma amounts, returns, zero and null volumes, duplicate
and missing mapping keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gondola.config import FeedSpec

DRIVER_TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem"]

BASE_SQL = """
SELECT lower(replace(r_name, ' ', '_')) AS retailer, l.*, p.p_name, p.p_brand, p.p_type, p.p_size,
       o.o_orderdate, o.o_orderpriority, o.o_orderstatus, c.c_mktsegment, c.c_nationkey
FROM {lineitem} l
JOIN {part} p ON l.l_partkey = p.p_partkey
JOIN {orders} o ON l.l_orderkey = o.o_orderkey
JOIN {customer} c ON o.o_custkey = c.c_custkey
JOIN {supplier} s ON l.l_suppkey = s.s_suppkey
JOIN {nation} n ON s.s_nationkey = n.n_nationkey
JOIN {region} r ON n.n_regionkey = r.r_regionkey
"""

FEED_SQL = """
SELECT retailer,
  CASE WHEN retailer = 'middle_east' THEN NULL
       WHEN l_partkey % 50 = 0 THEN '0' WHEN l_partkey % 50 = 1 THEN '#'
       WHEN l_partkey % 50 = 2 THEN '' WHEN l_partkey % 50 = 3 THEN 'Non Defini'
       WHEN l_partkey % 50 = 4 THEN NULL ELSE CAST(l_partkey AS STRING) END AS product_id,
  concat('C', CAST(l_partkey % 500 AS STRING)) AS product_code,
  concat(p_name, ' ', CASE p_size % 6
       WHEN 0 THEN concat(CAST(p_size AS STRING), ' G')
       WHEN 1 THEN concat(CAST(p_size AS STRING), 'Gx12')
       WHEN 2 THEN concat('(', CAST(p_size AS STRING), ',5 CL x6x4)')
       WHEN 3 THEN concat(CAST(p_size AS STRING), ' kg ', CAST(p_size AS STRING), ' ml X 3')
       WHEN 4 THEN concat(CAST(p_size AS STRING), '.0L')
       ELSE 'SANS POIDS' END) AS product_name,
  p_brand AS brand_name,
  CASE WHEN p_type = 'ECONOMY' THEN concat('  ', p_type, chr(9))
       WHEN p_type = 'SMALL' THEN ''
       WHEN p_type = 'PROMO' AND retailer = 'asia' THEN NULL ELSE p_type END AS level_1,
  CASE WHEN p_size % 10 = 0 THEN NULL ELSE p_brand END AS level_2,
  concat('S', CAST((p_size + CASE WHEN l_partkey % 40 = 7 AND l_linenumber = 1 THEN 1 ELSE 0 END) % 5 AS STRING)) AS level_3,
  c_mktsegment AS segment_1,
  CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN '' ELSE o_orderpriority END AS segment_2,
  o_orderstatus AS segment_3,
  CASE c_nationkey % 4 WHEN 0 THEN concat('FR/', CAST(c_nationkey AS STRING))
       WHEN 1 THEN concat('0', CAST(c_nationkey AS STRING))
       WHEN 2 THEN CAST(c_nationkey AS STRING)
       ELSE concat('97', CAST(c_nationkey % 10 AS STRING)) END AS department,
  CASE WHEN retailer = 'asia' THEN concat(lpad(CAST(c_nationkey AS STRING), 2, '0'), '000') END AS zip_code,
  CAST(year(o_orderdate) AS STRING) AS year,
  CAST(month(o_orderdate) AS STRING) AS month,
  CASE WHEN retailer = 'europe' THEN concat(replace(CAST(signed AS STRING), '.', ','), ' ')
       ELSE CAST(signed AS STRING) END AS turnover,
  CASE WHEN l_linenumber = 5 THEN NULL WHEN l_linenumber = 6 THEN 0.0e0
       WHEN l_returnflag = 'R' AND l_linenumber <= 3 THEN -l_quantity ELSE l_quantity END AS volume,
  CASE WHEN retailer = 'africa' THEN 'KG' WHEN l_partkey % 3 = 0 THEN 'G'
       WHEN l_partkey % 3 = 1 THEN 'KG' ELSE 'L' END AS volume_unit
FROM (SELECT *, CASE WHEN l_returnflag = 'R' THEN -l_extendedprice
                     WHEN l_linenumber = 7 THEN 0.0e0 ELSE l_extendedprice END AS signed FROM {base}) b
"""

PRODUCT_MAP_SQL = """
SELECT DISTINCT retailer AS ENTREPRISE,
  CASE WHEN p_type = 'SMALL' OR (p_type = 'PROMO' AND retailer = 'asia') THEN NULL
       WHEN p_type = 'STANDARD' THEN 'STANDARD ' ELSE p_type END AS level_1,
  CASE WHEN p_size % 10 = 0 THEN '' WHEN p_brand = 'Brand#3' THEN '   ' ELSE p_brand END AS level_2,
  concat('S', CAST(p_size % 5 AS STRING)) AS level_3,
  CASE WHEN retailer = 'europe' AND p_type = 'LARGE' THEN 'STD_MEDIUM'
       WHEN p_type IN ('SMALL', 'PROMO') THEN 'STD_OTHER' ELSE concat('STD_', p_type) END AS level_1_standard,
  CASE WHEN p_size % 10 = 0 THEN 'FAM_0' ELSE concat('FAM_', CAST(length(p_brand) AS STRING)) END AS level_2_standard,
  CASE WHEN retailer = 'america' AND p_size % 5 = 2 THEN 'SUB_X'
       ELSE concat('SUB_', CAST(p_size % 5 AS STRING)) END AS level_3_standard,
  CASE WHEN p_size % 10 <> 0 AND p_brand = 'Brand#9' THEN 'A L''EAN'
       WHEN retailer = 'africa' AND p_size % 10 <> 0 AND p_brand = 'Brand#4' THEN concat('ITEM_', CAST(length(p_name) % 2 AS STRING))
       ELSE 'ITEM' END AS level_4_standard
FROM {base}
WHERE p_brand <> 'Brand#7' AND NOT (p_size % 10 <> 0 AND p_brand = 'Brand#11' AND retailer = 'africa')
  AND NOT (p_type = 'PROMO' AND retailer = 'asia')
"""

CUSTOMER_MAP_SQL = """
SELECT DISTINCT retailer AS ENSEIGNE, c_mktsegment AS segment_1,
  CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN NULL ELSE concat(o_orderpriority, ' ') END AS segment_2,
  o_orderstatus AS segment_3,
  CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN 'PRO' ELSE 'CONSUMER' END AS segment_1_standard,
  CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'HIGH' ELSE 'NORMAL' END AS segment_2_standard,
  concat('ST_', o_orderstatus) AS segment_3_standard
FROM {base} WHERE o_orderpriority <> '5-LOW'
"""

# BASE_SQL as Spark joins it.  The orders get their customers first, and each
# nation its retailer's name, so that the lines are exchanged once for the orders
# and once for the parts, and no expression on the name is repeated in the code of
# the feed's columns (a stage's method beyond 8,000 bytes runs uncompiled).
PLACES_SQL = """
SELECT n.n_nationkey, lower(replace(r.r_name, ' ', '_')) AS retailer
FROM {nation} n JOIN {region} r ON n.n_regionkey = r.r_regionkey
"""

SOLD_SQL = """
SELECT o.o_orderkey, o.o_orderdate, o.o_orderpriority, o.o_orderstatus, c.c_mktsegment, c.c_nationkey
FROM {orders} o JOIN {customer} c ON o.o_custkey = c.c_custkey
"""

SPARK_BASE_SQL = """
SELECT n.retailer, l.*, p.p_name, p.p_brand, p.p_type, p.p_size,
       o.o_orderdate, o.o_orderpriority, o.o_orderstatus, o.c_mktsegment, o.c_nationkey
FROM {lineitem} l
JOIN {sold} o ON l.l_orderkey = o.o_orderkey
JOIN {part} p ON l.l_partkey = p.p_partkey
JOIN {supplier} s ON l.l_suppkey = s.s_suppkey
JOIN {places} n ON s.s_nationkey = n.n_nationkey
"""

# What the two maps need of it: the parts and the kinds of order that each retailer
# sells.  Every line has its part, order and customer, so the joins that these leave
# out would drop nothing.  The product map reduces the fact table to pairs of keys
# before any other join.  The customer map joins the lines with their orders at once,
# as pairs of keys would be nearly as many, and keeps the few kinds of order.  Both
# tell regions apart by number and put the retailer's name in last.
RETAILERS_SQL = """
SELECT r_regionkey, lower(replace(r_name, ' ', '_')) AS retailer FROM {region}
"""

PART_KEYS_SQL = """
SELECT DISTINCT k.l_partkey, n.n_regionkey
FROM {keys} k JOIN {supplier} s ON k.l_suppkey = s.s_suppkey JOIN {nation} n ON s.s_nationkey = n.n_nationkey
"""

PRODUCT_BASE_SQL = """
SELECT r.retailer, p.p_name, p.p_brand, p.p_type, p.p_size
FROM {sellers} l JOIN {part} p ON l.l_partkey = p.p_partkey JOIN {regions} r ON l.n_regionkey = r.r_regionkey
"""

CUSTOMER_KINDS_SQL = """
SELECT DISTINCT n.n_regionkey, o.o_orderpriority, o.o_orderstatus, o.c_mktsegment
FROM {keys} k JOIN {sold} o ON k.l_orderkey = o.o_orderkey
JOIN {supplier} s ON k.l_suppkey = s.s_suppkey JOIN {nation} n ON s.s_nationkey = n.n_nationkey
"""

CUSTOMER_BASE_SQL = """
SELECT r.retailer, k.o_orderpriority, k.o_orderstatus, k.c_mktsegment
FROM {kinds} k JOIN {regions} r ON k.n_regionkey = r.r_regionkey
"""

# The five test retailers: middle_east has no product ids, asia gives a zip
# code instead of a department, africa gets a constant unit column.
TEST_FEEDS = [
    FeedSpec("africa", add_columns={"volume_unit": "KG"}, has_product_id=True, zip_department=False),
    FeedSpec("america", has_product_id=True, zip_department=False),
    FeedSpec("asia", has_product_id=True, zip_department=True),
    FeedSpec("europe", has_product_id=True, zip_department=False),
    FeedSpec("middle_east", has_product_id=False, zip_department=False),
]
RETAILERS = [f.name for f in TEST_FEEDS]
RETAILERS_WITH_ID = [f.name for f in TEST_FEEDS if f.with_product_id]
RETAILERS_WITHOUT_ID = [f.name for f in TEST_FEEDS if not f.with_product_id]


def duckdb_views() -> str:
    """``WITH`` clause entries defining base, feed, product_map, customer_map."""
    names = {t: t for t in DRIVER_TABLES}
    return ",\n".join([
        f"base AS ({BASE_SQL.format(**names)})",
        f"feed AS ({FEED_SQL.format(base='base')})",
        f"product_map AS ({PRODUCT_MAP_SQL.format(base='base')})",
        f"customer_map AS ({CUSTOMER_MAP_SQL.format(base='base')})",
    ])


class FixtureFeed:
    """The fixture views of one scale-factor directory as Spark DataFrames."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.tables = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in DRIVER_TABLES}
        t = self.tables
        self.places = F.broadcast(spark.sql(PLACES_SQL, nation=t["nation"], region=t["region"]))  # a row for each nation
        self.nation = F.broadcast(t["nation"].select("n_nationkey", "n_regionkey"))
        self.regions = F.broadcast(spark.sql(RETAILERS_SQL, region=t["region"]))
        # Joined by a hash table of the orders of a partition, several times fewer and
        # shorter than its lines, which then need no sort.
        self.sold = spark.sql(SOLD_SQL, orders=t["orders"], customer=t["customer"]).hint("shuffle_hash")
        # The fact table is hash-partitioned on the orders key: a file with a
        # single row group would otherwise be read (and joined, and cleaned)
        # by one task, and at scale this is the partitioning the sort-merge
        # join with ``orders`` needs anyway.  The maps read two columns of it
        # each, dealt by the key of the join that follows.
        self.base = spark.sql(SPARK_BASE_SQL, lineitem=t["lineitem"].repartition("l_orderkey"), sold=self.sold,
                              part=t["part"], supplier=t["supplier"], places=self.places)

    def _keys(self, key: str) -> DataFrame:
        """A key of the fact table beside its suppliers, dealt by that key."""
        return self.tables["lineitem"].select(key, "l_suppkey").repartition(key)

    @property
    def feed(self) -> DataFrame:
        return self.spark.sql(FEED_SQL, base=self.base)

    @property
    def product_map(self) -> DataFrame:
        sellers = self.spark.sql(PART_KEYS_SQL, keys=self._keys("l_partkey"), supplier=self.tables["supplier"], nation=self.nation)
        base = self.spark.sql(PRODUCT_BASE_SQL, sellers=sellers, part=self.tables["part"], regions=self.regions)
        return self._written(self.spark.sql(PRODUCT_MAP_SQL, base=base))

    @property
    def customer_map(self) -> DataFrame:
        kinds = self.spark.sql(CUSTOMER_KINDS_SQL, keys=self._keys("l_orderkey"), sold=self.sold, supplier=self.tables["supplier"], nation=self.nation)
        base = self.spark.sql(CUSTOMER_BASE_SQL, kinds=kinds, regions=self.regions)
        return self._written(self.spark.sql(CUSTOMER_MAP_SQL, base=base))

    def _written(self, table: DataFrame) -> DataFrame:
        """The map as a table that is there before the feed is joined with it, as a
        retailer's sheet is: the join then knows its size, and does not exchange
        the feed for a small one while the map is still being made."""
        return table.checkpoint() if self.spark.sparkContext.getCheckpointDir() else table
