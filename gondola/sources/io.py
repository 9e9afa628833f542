"""Scans and sinks.

Feeds arrive as delimited text or parquet.  The bronze layer is parquet
partitioned by ``retailer`` so a feed's data can be replaced on its own
(dynamic partition overwrite) and read back with partition pruning.  Silver is
written by runs: each run has a folder of its own, and a manifest of its files,
committed last, says which run is read.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Mapping, Sequence
from datetime import datetime, timezone
from typing import NamedTuple
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gondola.operators.shaping import common_types, union_all

RETAILER = "retailer"


# ---------------------------------------------------------------- scans

#: How delimited text quotes cells, in files and in lines alike.
QUOTING = {"quote": '"', "escape": '"'}
_KEEP_SPACES = {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}

# FIXED VALUES: what windows-1252 has at the bytes 80 to 9F; bytes that it leaves
# undefined are read as U+FFFD.
CP1252_HIGH = ("\u20ac\ufffd\u201a\u0192\u201e\u2026\u2020\u2021\u02c6\u2030\u0160\u2039\u0152\ufffd\u017d\ufffd"
               "\ufffd\u2018\u2019\u201c\u201d\u2022\u2013\u2014\u02dc\u2122\u0161\u203a\u0153\ufffd\u017e\u0178")
LATIN1_HIGH = "".join(map(chr, range(0x80, 0xA0)))


def from_latin1(c: Column) -> Column:
    """Windows-1252 text that was read as ISO-8859-1, corrected."""
    return F.translate(c, LATIN1_HIGH, CP1252_HIGH)


def _is_cp1252(encoding: str | None) -> bool:
    return encoding is not None and encoding.lower().replace("_", "-") in ("cp1252", "windows-1252")


def read_delimited(spark: SparkSession, paths: str | Sequence[str], *, sep: str = ";",
                   encoding: str | None = None, header: bool = True, multi_line: bool = False) -> DataFrame:
    """Delimited text with a header, every column read as text.

    No type inference: codes such as ``01`` keep their leading zero and the
    amount parser sees the raw text.  Quotes inside a quoted cell are doubled;
    an empty cell is null, quoted or not.
    Each path is read with its own header and the files are united by column
    name (a column that a file lacks is null); the files of one folder have to
    share one header.  ``multi_line`` reads cells that hold line breaks, but a
    file is then one task, so it is off unless a feed needs it.  Either way a
    record with the wrong number of columns raises, whatever columns are used.

    ``encoding='windows-1252'`` is read as ISO-8859-1, which any session can,
    and the code points that differ are replaced in cells and header; a byte
    that windows-1252 leaves undefined becomes U+FFFD.
    """
    reader = (spark.read.option("header", header).option("sep", sep).option("inferSchema", False).options(**QUOTING)
              .option("multiLine", multi_line)
              .option("mode", "FAILFAST").option("enforceSchema", not header).option("columnPruning", False))
    if encoding:
        reader = reader.option("encoding", "ISO-8859-1" if _is_cp1252(encoding) else encoding)
    frames = [reader.csv(p) for p in ([paths] if isinstance(paths, str) else paths)]
    if _is_cp1252(encoding):
        named = str.maketrans(LATIN1_HIGH, CP1252_HIGH)
        frames = [df.select([from_latin1(F.col(f"`{c}`")).alias(c.translate(named)) for c in df.columns]) for df in frames]
    return union_all(frames, allow_missing=True)


def parse_lines(df: DataFrame, line: str, columns: Sequence[str], *, sep: str = ";") -> DataFrame:
    """S1/S3 on lines that a frame holds (a feed that arrives as messages):
    column ``line`` replaced by its cells, by ``read_delimited``'s rules; a line
    with the wrong number of cells raises."""
    schema = ", ".join(f"`{c}` string" for c in columns)
    cells = F.from_csv(F.col(line), schema, {"sep": sep, "mode": "FAILFAST", **QUOTING})
    others = [F.col(f"`{c}`") for c in df.columns if c != line]
    return df.select(*others, cells.alias("__cells")).select(*others, "__cells.*")


def decode_cp1252(c: Column) -> Column:
    """S2 on bytes: windows-1252 text of a binary column."""
    return from_latin1(F.decode(c, "ISO-8859-1"))


def read_tsv(spark: SparkSession, paths: str | Sequence[str], **kw) -> DataFrame:
    """S3: tab-separated text."""
    return read_delimited(spark, paths, sep="\t", **kw)


def read_parquet(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Parquet scan (filters and column pruning reach the files).  Columns
    of all files are merged, so a file with more columns loses none."""
    return spark.read.option("mergeSchema", True).parquet(*([paths] if isinstance(paths, str) else list(paths)))


def layer_feeds(spark: SparkSession, root: str, retailers: Sequence[str] | None = None) -> dict[str, DataFrame]:
    """Each feed of a layer written by ``write_layer`` with its own columns,
    read from its own partition directory."""
    names = retailers
    if names is None:  # partition values only: one row for each feed
        names = sorted(r[0] for r in spark.read.parquet(root).select(RETAILER).distinct().collect())
    return {n: read_parquet(spark, f"{root}/{RETAILER}={n}").withColumn(RETAILER, F.lit(n)) for n in names}


def read_layer(spark: SparkSession, root: str, retailers: Sequence[str] | None = None) -> DataFrame:
    """The feeds of a layer (all, or those named) united by column name.

    Feeds may differ in columns (null where a feed lacks one) and in types (a
    column that differs is read as text).
    """
    return union_all(list(common_types(layer_feeds(spark, root, retailers)).values()), allow_missing=True)


def folder_feeds(spark: SparkSession, root: str, retailers: Sequence[str] | None = None) -> dict[str, DataFrame]:
    """S5 on a flat folder: ``<retailer>.parquet`` (a file, or a folder of files)
    for each feed, with its own columns and the retailer taken from that name."""
    base = qualified(spark, root)
    files = (spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", True).load(root)
             .select("path"))  # a listing: no content is read
    entry = F.substring_index(F.substring(F.col("path"), len(base) + 2, 1 << 20), "/", 1)
    names = sorted(r[0] for r in files.select(entry).distinct().collect())  # one for each feed
    feeds = {n.removesuffix(".parquet"): n for n in names}
    return {f: read_parquet(spark, f"{root}/{n}").withColumn(RETAILER, F.lit(f))
            for f, n in feeds.items() if retailers is None or f in retailers}


def read_folder(spark: SparkSession, root: str, retailers: Sequence[str] | None = None) -> DataFrame:
    """The feeds of a flat folder united as ``read_layer`` unites those of a layer."""
    return union_all(list(common_types(folder_feeds(spark, root, retailers)).values()), allow_missing=True)


# ---------------------------------------------------------------- files

def _file_system(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def qualified(spark: SparkSession, path: str) -> str:
    """The path with its scheme, as Spark lists files under it."""
    fs, p = _file_system(spark, path)
    return fs.makeQualified(p).toString()


def remove(spark: SparkSession, path: str) -> bool:
    """Delete a table that this library wrote; false if there is none."""
    fs, p = _file_system(spark, path)
    return fs.delete(p, True)


# ---------------------------------------------------------------- sinks

def write_layer(df: DataFrame, root: str, *, mode: str = "overwrite") -> None:
    """Parquet partitioned by retailer, replacing only the retailers
    present in ``df`` (dynamic partition overwrite)."""
    (df.write.mode(mode).option("partitionOverwriteMode", "dynamic")
     .partitionBy(RETAILER).parquet(root))


#: Runs of a silver table whose files are kept: the one that is read, and the
#: one before it for readers that began on it.
KEEP_RUNS = 2

#: A row for each file of a run, and one without a file, which has the schema.
_MANIFEST = "run string, committed timestamp, route string, retailer string, file string, n_rows long, schema string"


class SilverRun(NamedTuple):
    run: str
    n_rows: int
    metrics: dict


def write_silver(silver: DataFrame, root: str, without_id: Sequence[str], *, metrics: Mapping[str, Column] | None = None,
                 keep_runs: int = KEEP_RUNS) -> SilverRun:
    """Silver as a run of its own, routed to ``route=with_id`` /
    ``route=without_id`` by the presence of product ids and partitioned by retailer.

    One job writes both routes, so silver is computed once; feeds without ids
    carry a null ``product_id``, which ``read_silver(..., "without_id")`` drops.
    ``metrics`` (aggregates over silver) are observed by that job.  The run is
    read from the moment its manifest, one file, is in place: a run that is killed
    before changes nothing, and one after it holds exactly its own rows, whatever
    feeds earlier runs had.  Older runs than the last ``keep_runs`` are deleted.
    """
    spark = silver.sparkSession
    run = f"{datetime.now(timezone.utc):%Y%m%dT%H%M%S%f}-{uuid.uuid4().hex[:8]}"
    no_id = F.col(RETAILER).isin(*without_id) if without_id else F.lit(False)
    routed = silver.withColumn("route", F.when(no_id, F.lit("without_id")).otherwise(F.lit("with_id")))
    if "year" in silver.columns:  # few files for each feed and year; large ones are split
        routed = routed.hint("rebalance", RETAILER, "year")
    # observed in the last stage, whose tasks count once however often they are tried
    seen = Observation()
    observed = routed.observe(seen, F.count(F.lit(1)).alias("n_rows"), *[c.alias(n) for n, c in (metrics or {}).items()])
    observed.write.partitionBy("route", RETAILER).parquet(f"{root}/data/run={run}")
    counted = dict(seen.get)
    n_rows = counted.pop("n_rows")

    schema = T.StructType([f for f in routed.schema if f.name not in ("route", RETAILER)]
                          + [T.StructField(c, T.StringType()) for c in ("route", RETAILER)])
    # row counts come from the files' footers
    files = (spark.read.schema(schema).parquet(f"{root}/data/run={run}")
             .groupBy("route", RETAILER, F.col("_metadata.file_path").alias("file")).agg(F.count(F.lit(1)).alias("n_rows")))
    rows = [(r["route"], r[RETAILER], unquote(r["file"]), r["n_rows"], None) for r in files.collect()]  # as many as Spark lists itself
    if sum(r[3] for r in rows) != n_rows:
        raise RuntimeError(f"run {run} wrote {n_rows} rows but its files hold {sum(r[3] for r in rows)}")
    committed = datetime.now(timezone.utc)
    manifest = spark.createDataFrame([(run, committed, *r) for r in [(None, None, None, n_rows, schema.json()), *rows]], _MANIFEST)
    manifest.coalesce(1).write.mode("append").parquet(f"{root}/manifest")
    for old in [r["run"] for r in _runs(spark, root)][keep_runs:]:
        remove(spark, f"{root}/data/run={old}")
    return SilverRun(run, n_rows, counted)


def _runs(spark: SparkSession, root: str) -> list:
    """Committed runs, the last first."""
    heads = spark.read.schema(_MANIFEST).parquet(f"{root}/manifest").where("file IS NULL")
    return heads.select("run", "committed", "schema").orderBy(F.desc("committed"), F.desc("run")).collect()


def silver_files(spark: SparkSession, root: str, run: str) -> DataFrame:
    """(run, committed, route, retailer, file, n_rows) of a committed run."""
    return spark.read.schema(_MANIFEST).parquet(f"{root}/manifest").where((F.col("run") == run) & F.col("file").isNotNull()).drop("schema")


def read_silver(spark: SparkSession, root: str, route: str | None = None,
                retailers: Sequence[str] | None = None, run: str | None = None) -> DataFrame:
    """The silver of the last committed run (or of ``run``): one route or both,
    all feeds or those named.  The files are the manifest's; no folder is listed."""
    head = next((r for r in _runs(spark, root) if run in (None, r["run"])), None)
    if head is None:
        raise ValueError(f"no committed run {run or ''} of {root}")
    files = silver_files(spark, root, head["run"])
    if retailers is not None:
        files = files.where(F.col(RETAILER).isin(*retailers))
    if route is not None:
        files = files.where(F.col("route") == route)
    paths = [r["file"] for r in files.select("file").collect()]
    schema = T._parse_datatype_json_string(head["schema"])
    df = (spark.read.option("basePath", f"{root}/data/run={head['run']}").schema(schema).parquet(*paths) if paths
          else spark.createDataFrame([], schema))
    df = df.drop("route")
    return df.drop("product_id") if route == "without_id" else df


def write_report(df: DataFrame, root: str, name: str, *, skip_empty: bool = False) -> bool:
    """One parquet table per report, in place of an earlier run's.

    Its rows are counted while they are written; with ``skip_empty`` a report
    without rows leaves no table.  Returns whether there is one.
    """
    seen = Observation()
    path = os.path.join(root, name)
    df.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("overwrite").parquet(path)
    if skip_empty and not seen.get["n"]:
        remove(df.sparkSession, path)
        return False
    return True


def format_lines(df: DataFrame, line: str = "line", *, sep: str = ";") -> DataFrame:
    """S9 as lines of a frame: one delimited line for each row, by ``write_delimited``'s rules."""
    cells = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    return df.select(F.to_csv(cells, {"sep": sep, **QUOTING, **_KEEP_SPACES}).alias(line))


def write_delimited(df: DataFrame, path: str, *, sep: str = ";") -> None:
    """Delimited text with a header, as ``read_delimited`` reads it (cells
    that hold line breaks need its ``multi_line``)."""
    df.write.mode("overwrite").option("header", True).option("sep", sep).options(**QUOTING, **_KEEP_SPACES).csv(path)
