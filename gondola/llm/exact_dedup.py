"""Exact dedup with a heavy-hitter split.

Texts are equal when identical after deleting white space, compared by SHA-256.
Misra-Gries summaries, one per partition and merged by sums, name every digest
that may hold more than a small share of all rows.  Those few are counted
exactly; the verified winners (at most ``COUNTERS`` + 1 rows) are broadcast,
so a hot digest's rows are settled where they are read.  All other digests
hold a small share each and go through an ordinary shuffle.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import cut, map_batches, set_aside, ship, stored

#: Counters of a Misra-Gries summary: it names every digest with more than
#: 2 / (COUNTERS + 1) of all rows.
COUNTERS = 1023
WHITE_SPACE = r"[\x20\x09-\x0D]+"


def normalised(c):
    """Text without white space; null counts as empty."""
    return F.regexp_replace(F.coalesce(c, F.lit("")), WHITE_SPACE, "")


def misra_gries(digests: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """(digest, at_least): candidates from per-partition Misra-Gries summaries.

    A summary undercounts by at most rows / (counters + 1), and so do the sums
    over partitions; keeping sums above that share of all rows leaves at most
    ``counters`` + 1 candidates and loses no digest with twice the share.
    """
    ship(digests.sparkSession)

    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()
        rows = 0
        for batch in batches:
            rows += batch.num_rows
            for pair in batch.column(0).value_counts().to_pylist():
                held[pair["values"]] += pair["counts"]
            if len(held) > counters:  # subtract the first count that has no counter left
                over = sorted(held.values(), reverse=True)[counters]
                held = Counter({d: c - over for d, c in held.items() if c > over})
        if rows:
            yield pa.RecordBatch.from_arrays(
                [pa.array([*held, None], pa.binary()), pa.array([*held.values(), rows], pa.int64())], names=["digest", "n"])

    sums = map_batches(digests, summarise, "digest binary, n long").groupBy("digest").agg(F.sum("n").alias("n"))
    sums = cut(sums)  # at most counters + 1 rows for each partition
    total = sums.where("digest IS NULL").agg(F.sum("n")).first()[0] or 0
    return sums.where(F.col("digest").isNotNull() & (F.col("n") > total / (counters + 1))).select("digest", F.col("n").alias("at_least"))


def _grouped(rows: DataFrame, counters: int) -> DataFrame:
    """(__row, doc_id, keep_id, group_size, kept, text_sha256) from rows with a key ``__row``."""
    rows = cut(rows.select("doc_id", F.unhex(F.sha2(normalised(F.col("text")), 256)).alias("digest"),
                           F.coalesce(F.length("text"), F.lit(0)).alias("chars"), "__row"))
    hot = misra_gries(rows.select("digest"), counters).select("digest")

    # verified winners: exact counts of the candidates, combined map-side
    rank = F.struct(-F.col("chars"), F.col("doc_id").isNull(), F.col("doc_id"), F.col("__row"))
    winners = cut(rows.join(F.broadcast(hot), "digest").groupBy("digest")
                  .agg(F.count("*").alias("group_size"), F.min(rank).alias("best"))
                  .select("digest", "group_size", F.col("best.doc_id").alias("keep_id"), F.col("best.__row").alias("best_row")))
    settled = rows.join(F.broadcast(winners), "digest").withColumn("kept", F.col("__row") == F.col("best_row"))
    rest = rows.join(F.broadcast(winners.select("digest")), "digest", "left_anti")
    w = W.partitionBy("digest").orderBy(F.col("chars").desc(), F.col("doc_id").asc_nulls_last(), "__row")
    whole = w.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    shuffled = rest.select("*", F.count("*").over(whole).alias("group_size"), F.first("doc_id").over(whole).alias("keep_id"),
                           (F.row_number().over(w) == 1).alias("kept"))
    columns = ["__row", "doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256")]
    return settled.select(columns).unionByName(shuffled.select(columns))


def exact_groups(docs: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256), one row per row of ``docs``.

    Of equal texts the row with the most code points in the original text
    stays, then the smallest doc_id (null last).  Of repeated rows with the
    same doc_id and text, which tie in everything, each shows keep_id as its
    doc_id but only one is ``kept``.  Null texts are empty ones; very long texts
    are compared whole; an empty table gives an empty one; other columns are not
    carried, so their names cannot clash.
    """
    return _grouped(docs.select("doc_id", "text").withColumn("__row", F.monotonically_increasing_id()), counters).drop("__row")


def drop_copies(docs: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """The kept rows of ``docs``, own columns.  Rows are told apart by a key of
    their own, so null, reused and repeated ids lose no text and leave no copy."""
    rows, back = set_aside(docs, ["__row"])
    rows = stored(rows.withColumn("__row", F.monotonically_increasing_id()))
    copies = _grouped(rows, counters).where("NOT kept").select("__row")
    return back(rows.join(copies, "__row", "left_anti"))


# ---------------------------------------------------------------- query

def query(spark, sf_dir: str) -> DataFrame:
    """Contract form: one row per document, dropped ones too."""
    return exact_groups(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))


SQL = """
WITH d AS (SELECT doc_id, length(coalesce(text, '')) AS chars,
                  sha256(regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', '', 'g')) AS text_sha256
           FROM documents)
SELECT doc_id, first_value(doc_id) OVER g AS keep_id, count(*) OVER (PARTITION BY text_sha256) AS group_size,
       row_number() OVER g = 1 AS kept, text_sha256
FROM d WINDOW g AS (PARTITION BY text_sha256 ORDER BY chars DESC, doc_id NULLS LAST)
"""
