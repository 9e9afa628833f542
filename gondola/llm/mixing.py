"""Mixing sources to target weights along a time-varying curriculum.

Each source has a weight schedule: a piecewise-linear, non-negative weight
over training progress from 0 to 1.  Its integral is the source's weight in
the mix; targets share the whole corpus by weight, stop at ``MAX_EPOCHS``
times the source's size, and the excess is reshared by weight.  The integrated
schedule is a source's cumulative token demand; inverting it at a document's
offset in the source's stream gives its training position, and the documents
are range-sorted by position.

Only DataFrame functions are used.  Running sums are taken in two levels (hash
buckets of a source, then rows of a bucket), so a source that holds a third of
all rows is spread over thousands of small windows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import cut, set_aside, without

MAX_EPOCHS = 3
WORD_PATTERN = r"[^\x20\x09-\x0D]+"
#: Hex digits of the order key that name a bucket (16**3 buckets a source).
_BUCKET_DIGITS = 3

_ADDED = ["size", "source_size", "target", "taken", "copies", "positions"]


def word_count(c: Column) -> Column:
    """Words of a text; null has none."""
    return F.coalesce(F.regexp_count(c, F.lit(WORD_PATTERN)), F.lit(0)).cast("long")


def rising_and_falling(source_rank: Column) -> Column:
    """Default schedule of the n-th source: weight 1, 2 or 3 in turn; sources of
    even rank fade from 1.5 times to half of it, the others the other way."""
    w = (source_rank % 3 + 1).cast("double")
    early = F.when(source_rank % 2 == 0, F.lit(1.5)).otherwise(F.lit(0.5))
    return F.array(F.struct(F.lit(0.0).alias("t"), (w * early).alias("w")),
                   F.struct(F.lit(1.0).alias("t"), (w * (F.lit(2.0) - early)).alias("w")))


def _segments(schedule: Column) -> Column:
    """Pieces (t, span, w0, w1, area) of a schedule given by its knots."""
    def piece(i):
        a, b = F.get(schedule, i), F.get(schedule, i + 1)
        span = b["t"] - a["t"]
        return F.struct(a["t"].alias("t"), span.alias("span"), a["w"].alias("w0"), b["w"].alias("w1"),
                        (span * (a["w"] + b["w"]) / 2).alias("area"))
    return F.transform(F.sequence(F.lit(0), F.size(schedule) - 2), piece)


def _sum(areas: Column) -> Column:
    return F.aggregate(areas, F.lit(0.0), lambda s, x: s + x)


def invert(segments: Column, share: Column) -> Column:
    """Progress at which the integral of a schedule reaches ``share`` of its whole.

    ``segments`` also hold ``before``, the area left of each.
    """
    total = F.element_at(segments, -1)["before"] + F.element_at(segments, -1)["area"]
    # a segment of no area holds no share
    s = F.element_at(F.filter(segments, lambda x: (x["before"] <= share * total) & (x["area"] > 0)), -1)
    area = share * total - s["before"]
    root = F.sqrt(F.greatest(F.lit(0.0), s["w0"] * s["w0"] + 2.0 * area * (s["w1"] - s["w0"]) / s["span"]))
    step = F.when(area > 0, 2.0 * area / (s["w0"] + root)).otherwise(0.0)
    return F.least(F.lit(1.0), s["t"] + step)


def _source_key(c: Column) -> Column:
    """The source as a non-null key that sorts by code point, null last."""
    return F.coalesce(F.concat(F.lit("0"), c), F.lit("1"))


def _ordered(docs: DataFrame, seed: str) -> DataFrame:
    """``docs`` with size, source key, order key and bucket."""
    named = F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("="), F.md5(F.col("text"))), F.lit(""))
    key = F.md5(F.concat(F.lit(seed), named))
    return docs.select("*", word_count(F.col("text")).alias("size"), _source_key(F.col("source")).alias("__source"),
                       key.alias("__key")).withColumn("__bucket", F.substring("__key", 1, _BUCKET_DIGITS))


def targets(sizes: DataFrame, schedule=rising_and_falling, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """(__source, source_size, target, segments) from one row (__source, source_size) per source.

    A source is capped when the level shared by the others exceeds its
    ``max_epochs`` sizes.  With sources sorted by cap over weight the capped
    ones are a prefix; the first source that its level does not fill, and all
    after it, share by weight what the capped ones leave.  The windows here
    hold one row for each source.
    """
    everything = W.orderBy(F.lit(1)).rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    ranked = sizes.withColumn("__rank", F.row_number().over(W.orderBy("__source")) - 1)
    pieces = ranked.withColumn("__pieces", _segments(schedule(F.col("__rank"))))
    placed = F.transform("__pieces", lambda p, i: F.struct(
        p["t"].alias("t"), p["span"].alias("span"), p["w0"].alias("w0"), p["w1"].alias("w1"), p["area"].alias("area"),
        _sum(F.transform(F.slice("__pieces", F.lit(1), i), lambda q: q["area"])).alias("before")))
    weighed = (pieces.withColumn("segments", placed)
               .withColumn("__weight", _sum(F.transform("__pieces", lambda p: p["area"])))
               .withColumn("__cap", (max_epochs * F.col("source_size")).cast("double"))
               .withColumn("__ratio", F.when(F.col("__weight") > 0, F.try_divide("__cap", "__weight")).otherwise(F.lit(float("inf")))))
    earlier = W.orderBy("__ratio", "__source").rowsBetween(W.unboundedPreceding, -1)
    levelled = (weighed
                .withColumn("__left", F.sum("source_size").over(everything).cast("double") - F.coalesce(F.sum("__cap").over(earlier), F.lit(0.0)))
                .withColumn("__open", F.sum("__weight").over(everything) - F.coalesce(F.sum("__weight").over(earlier), F.lit(0.0)))
                .withColumn("__filled", F.coalesce(F.col("__cap") * F.col("__open") < F.col("__left") * F.col("__weight"), F.lit(True))))
    chosen = levelled.withColumn("__first", F.min(F.struct("__filled", "__ratio", "__source", "__left", "__open")).over(everything))
    share = F.coalesce(F.try_divide(F.col("__first")["__left"] * F.col("__weight"), F.col("__first")["__open"]), F.lit(0.0))
    return chosen.select("__source", "source_size", F.least("__cap", share).alias("target"), "segments")


def mix(docs: DataFrame, schedule=rising_and_falling, max_epochs: int = MAX_EPOCHS, seed: str = "mix") -> DataFrame:
    """``docs`` with size, source_size, target, taken, copies and positions.

    ``taken`` are the words the mix takes of the document: whole epochs of its
    source, then the last epoch up to the source's target in the order of a
    seeded hash of doc_id, which takes the document at its end in part, so a
    source's taken words equal its rounded target.  ``copies`` rounds ``taken``
    to whole documents.  ``positions`` are the training positions (0 to 1) of
    the document's copies, a part of one counting as a copy.

    A null or empty text has no words and takes no part (0 copies); a null
    source is a source of its own, the last; rows with the same doc_id, or without
    one and with the same text, share an order key and are placed one after the other; an empty table gives an empty
    one.  Incoming columns named like the added ones are replaced.
    """
    docs = without(docs, _ADDED)
    rows = _ordered(docs, seed)
    buckets = cut(rows.groupBy("__source", "__bucket").agg(F.sum("size").alias("__n")))
    plan = targets(buckets.groupBy("__source").agg(F.sum("__n").alias("source_size")), schedule, max_epochs)
    before = W.partitionBy("__source").orderBy("__bucket").rowsBetween(W.unboundedPreceding, -1)
    placed = cut(buckets.withColumn("__at", F.coalesce(F.sum("__n").over(before), F.lit(0)))
                 .drop("__n").join(plan, "__source"))
    inside = W.partitionBy("__source", "__bucket").orderBy("__key", "size").rowsBetween(W.unboundedPreceding, -1)
    at = (rows.withColumn("__in", F.coalesce(F.sum("size").over(inside), F.lit(0)))
          .join(placed, ["__source", "__bucket"]).withColumn("__at", F.col("__at") + F.col("__in")))
    quota = F.floor(F.col("target") + 0.5)
    whole = F.when(F.col("source_size") > 0, F.expr("quota div source_size")).otherwise(F.lit(0)).cast("long")
    at = (at.withColumn("quota", quota).withColumn("__whole", whole)
          .withColumn("__rest", F.col("quota") - F.col("__whole") * F.col("source_size"))
          .withColumn("__part", F.least(F.col("size"), F.greatest(F.lit(0), F.col("__rest") - F.col("__at"))))
          .withColumn("taken", F.col("__whole") * F.col("size") + F.col("__part")))
    passes = F.when(F.col("size") > 0, F.col("__whole") + (F.col("__part") > 0).cast("long")).otherwise(F.lit(0))
    share = lambda e: (e.cast("double") * F.col("source_size") + F.col("__at")) / F.col("quota")
    positions = F.when(passes > 0, F.transform(F.sequence(F.lit(0).cast("long"), passes - 1), lambda e: invert(F.col("segments"), share(e)))
                       ).otherwise(F.array().cast("array<double>"))
    copies = F.when(F.col("size") > 0, F.col("__whole") + (2 * F.col("__part") >= F.col("size")).cast("long")).otherwise(F.lit(0))
    return at.select(*[F.col(f"`{c}`") for c in docs.columns], "size", "source_size", "target", "taken",
                     copies.cast("int").alias("copies"), positions.alias("positions"))


def in_training_order(mixed: DataFrame) -> DataFrame:
    """A row for each whole copy, range-sorted by its training position."""
    copies = mixed.where("copies > 0").withColumn("position", F.explode(F.slice("positions", F.lit(1), F.col("copies"))))
    copies = copies.drop("positions", "copies")
    return copies.repartitionByRange("position", "doc_id").sortWithinPartitions("position", "doc_id")


def mixed_documents(docs: DataFrame) -> DataFrame:
    """``docs`` as the mix takes it, with its own columns: a row for each whole
    copy, in training order."""
    rows, back = set_aside(docs, [*_ADDED, "position"])
    return back(in_training_order(mix(rows)))


# ---------------------------------------------------------------- query

def query(spark, sf_dir: str) -> DataFrame:
    """Contract form: one row per document, in the order of first training positions."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source")
    mixed = mix(docs).select("doc_id", "size", "source_size", "target", "taken", "copies",
                             F.round(F.get("positions", F.lit(0)), 9).alias("position"))
    return mixed.repartitionByRange("position", "doc_id").sortWithinPartitions("position", "doc_id")


SQL = """
WITH d AS (SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS size,
                  md5('mix' || coalesce(CAST(doc_id AS VARCHAR), '=' || md5(text), '')) AS k FROM documents),
     s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
                  row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rank FROM d GROUP BY source),
     w AS (SELECT *, CAST(rank % 3 + 1 AS DOUBLE) AS weight, CAST(3 * source_size AS DOUBLE) AS cap,
                  CASE WHEN rank % 2 = 0 THEN 1.5 ELSE 0.5 END::DOUBLE AS early FROM s),
     l AS (SELECT *, CAST(sum(source_size) OVER () AS DOUBLE) - coalesce(sum(cap) OVER p, 0) AS rest,
                  sum(weight) OVER () - coalesce(sum(weight) OVER p, 0) AS open
           FROM w WINDOW p AS (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
     f AS (SELECT rest AS frest, open AS fopen FROM l WHERE NOT cap * open < rest * weight ORDER BY cap / weight, source NULLS LAST LIMIT 1),
     t AS (SELECT source, source_size, weight * early AS w0, weight * (2.0::DOUBLE - early) AS w1,
                  least(cap, coalesce(frest * weight / fopen, 0)) AS target,
                  CAST(floor(least(cap, coalesce(frest * weight / fopen, 0)) + 0.5) AS BIGINT) AS quota FROM l, f),
     o AS (SELECT d.*, source_size, target, quota, w0, w1, CASE WHEN source_size > 0 THEN quota // source_size ELSE 0 END AS whole,
                  CAST(coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY k, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start
           FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
     p AS (SELECT *, least(size, greatest(0, quota - whole * source_size - start)) AS part,
                  CASE WHEN quota > 0 THEN CAST(start AS DOUBLE) / quota * ((w0 + w1) / 2) END AS area FROM o)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target, CAST(whole * size + part AS BIGINT) AS taken,
       CAST(CASE WHEN size > 0 THEN whole + CASE WHEN 2 * part >= size THEN 1 ELSE 0 END ELSE 0 END AS INTEGER) AS copies,
       CASE WHEN size > 0 AND whole + part > 0 THEN round(least(1.0::DOUBLE, CASE WHEN area > 0
            THEN 2.0::DOUBLE * area / (w0 + sqrt(greatest(0, w0 * w0 + 2.0::DOUBLE * area * (w1 - w0)))) ELSE 0 END), 9) END AS position
FROM p
"""
