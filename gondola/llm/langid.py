"""Language ID by Bayesian evidence fusion.

A row's text gives a likelihood for each language (letter trigrams, hashed to
a fixed table).  Its declared markup language and its address suffix are
further observations whose likelihoods are estimated from the whole input, and
its host supplies the prior: language shares counted per host, smoothed toward
the host's domain and from there toward the whole input, each row leaving its
own count out.  All of these tables come from one grouped aggregation over the
text-only decisions.  The evidence is added in log space and normalised.

A row is rejected (``und``) when its text has no letters, when a flat
background explains it far better than every language, or when no language
reaches ``MIN_PROBABILITY``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import LOWER, byte_table, cut, map_batches, set_aside, ship, steps, text_bytes, without

#: Hashed trigram table (entries a language).
TABLE_BITS = 14
#: Trigrams of one text overlap and repeat, so it counts as this many at most.
EFFECTIVE_TRIGRAMS = 64
#: Pseudo-counts of a parent level in the host prior, and of unseen labels.
HOST_WEIGHT = 20.0
LABEL_WEIGHT = 5.0
MIN_PROBABILITY = 0.5
#: How much better (log, per trigram) a flat background must fit to reject a text.
BACKGROUND_MARGIN = 1.0
#: Count tables up to this many bytes are sent to the tasks whole; of larger ones
#: only the keys with more than 1 / HOT_KEYS of all rows, the others by a shuffle.
BROADCAST_BYTES = 32 << 20
HOT_KEYS = 1024
#: Most languages a model may have: it is sent to every task (64 kB each).
MAX_LANGUAGES = 512

_LETTER = byte_table([(0x61, 0x7A), (0x80, 0xFF)])
_ADDED = ["language", "probability", "kept"]


@dataclass
class TextModel:
    """Log-likelihoods of hashed trigrams, one row for each language."""

    languages: list[str]
    table: np.ndarray


def _trigrams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashed trigrams around each letter byte, and each text's first one."""
    padded = np.insert(np.where(_LETTER[LOWER[data]], LOWER[data], 0x20).astype(np.uint8), offsets, 0x20).astype(np.uint32)
    middle = np.flatnonzero(padded != 0x20)
    code = (padded[middle - 1] << 16) | (padded[middle] << 8) | padded[middle + 1]
    idx = (code * np.uint32(2654435761)) >> np.uint32(32 - TABLE_BITS)
    return idx, np.searchsorted(middle, offsets + np.arange(len(offsets)))


def train(labelled: DataFrame) -> TextModel:
    """Text model from (text, lang); rows without a language are left out."""
    ship(labelled.sparkSession)
    size = 1 << TABLE_BITS

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}
        for batch in batches:
            data, offsets = text_bytes(batch.column(0))
            langs = np.array(batch.column(1).to_pylist(), object)
            for i, j in steps(offsets):
                idx, first = _trigrams(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
                of = np.repeat(langs[i:j], np.diff(first))
                for lang in set(langs[i:j]):
                    t = totals.setdefault(lang, np.zeros(size, np.int64))
                    t += np.bincount(idx[of == lang], minlength=size)
        for lang, t in totals.items():
            at = np.flatnonzero(t)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at, pa.int32()), pa.array(t[at])],
                                             names=["lang", "at", "n"])

    rows = labelled.where(F.col("lang").isNotNull()).select("text", "lang")
    counts = cut(map_batches(rows, count, "lang string, at int, n long").groupBy("lang", "at").agg(F.sum("n").alias("n")))
    languages = sorted(r["lang"] for r in counts.select("lang").distinct().limit(MAX_LANGUAGES + 1).collect())
    if len(languages) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    table = np.full((len(languages), size), 0.5)
    for r in counts.groupBy("lang").agg(F.collect_list("at").alias("at"), F.collect_list("n").alias("n")).toLocalIterator():
        table[languages.index(r["lang"]), r["at"]] += r["n"]
    table = np.log(table / table.sum(axis=1, keepdims=True)) if len(languages) else table
    return TextModel(languages, table.astype(np.float32))


def _with_likelihoods(df: DataFrame, text: Column, model: TextModel) -> DataFrame:
    """``df`` with __ll (mean log-likelihood for each language) and __n (trigrams)."""
    spark = df.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(model.table)
    width = len(df.columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        for batch in batches:
            data, offsets = text_bytes(batch.column(width))
            mean = np.zeros((batch.num_rows, len(table)))
            n = np.zeros(batch.num_rows, np.int64)
            for i, j in steps(offsets):
                idx, first = _trigrams(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
                n[i:j] = np.diff(first)
                some = np.flatnonzero(n[i:j])
                if len(some):
                    for k, row in enumerate(table):
                        mean[i + some, k] = np.add.reduceat(row[idx], first[:-1][some], dtype=np.float64) / n[i + some]
            flat = pa.array(np.ascontiguousarray(mean).ravel())
            ll = pa.ListArray.from_arrays(pa.array(np.arange(batch.num_rows + 1) * len(table), pa.int32()), flat)
            yield pa.RecordBatch.from_arrays(batch.columns[:width] + [ll, pa.array(n)], names=batch.schema.names[:width] + ["__ll", "__n"])

    schema = T.StructType(df.schema.fields + [T.StructField("__ll", T.ArrayType(T.DoubleType())), T.StructField("__n", T.LongType())])
    return map_batches(df.withColumn("__text", text), run, schema)


def _attach(rows: DataFrame, table: DataFrame, key: str, name: str, n_langs: int) -> DataFrame:
    """``rows`` with the counts ``name`` of their ``key`` (null where it has none).

    However many rows a key has, they stay where they are: its counts come to
    them.  Only a table over the size bound is joined by a shuffle, without its
    hot keys, and rows that have nothing to find there are spread evenly.
    """
    if table.count() * n_langs * 8 <= BROADCAST_BYTES:
        return rows.join(F.broadcast(table), key, "left")
    of = F.aggregate(F.col(name), F.lit(0.0), lambda s, x: s + x)
    total = table.agg(F.sum(of)).first()[0]
    hot = table.where(of > total / HOT_KEYS).select(key, F.col(name).alias("__hot"))
    cold = table.where(of <= total / HOT_KEYS).select(F.col(key).alias("__key"), F.col(name).alias("__cold"))
    spread = F.concat(F.lit("\0"), F.pmod(F.xxhash64("__ll"), F.lit(HOT_KEYS)).cast("string"))
    found = rows.join(F.broadcast(hot), key, "left").withColumn(
        "__key", F.when(F.col(key).isNull() | F.col("__hot").isNotNull(), spread).otherwise(F.col(key)))
    return found.join(cold, "__key", "left").withColumn(name, F.coalesce("__hot", "__cold")).drop("__key", "__hot", "__cold")


def identify(df: DataFrame, model: TextModel, text: Column, host: Column | None = None, domain: Column | None = None,
             declared: Column | None = None, suffix: Column | None = None, carry: list[str] | None = None) -> DataFrame:
    """``df`` (its columns named in ``carry``, or all) with language, probability and kept.

    Missing evidence (null, or no column at all) says nothing.  Null and empty
    texts are ``und`` and not kept, as are those of an input without any
    language to choose from; ties go to the first language by name.  Repeated
    rows count as often as they occur.  Incoming columns named like the added
    ones are replaced.
    """
    own = without(df if carry is None else df.select([F.col(f"`{c}`") for c in carry]), _ADDED)
    null = F.lit(None).cast("string")
    fields = {"__host": host, "__domain": domain, "__declared": declared, "__suffix": suffix}
    keyed = df.select(*[F.col(f"`{c}`") for c in own.columns], text.alias("__body"),
                      *[(null if c is None else c.cast("string")).alias(n) for n, c in fields.items()])
    keyed = keyed.withColumn("__host", F.coalesce("__host", F.lit(""))).withColumn("__domain", F.coalesce("__domain", "__host"))
    if not model.languages:
        return own.withColumns({"language": F.lit("und"), "probability": F.lit(0.0), "kept": F.lit(False)})
    n_langs = len(model.languages)
    body = keyed.drop("__body")
    seen = _with_likelihoods(keyed.select(*body.columns, "__body"), F.col("__body"), model).drop("__body")
    seen = seen.withColumn("__first", F.when(F.col("__n") > 0, F.array_position("__ll", F.array_max("__ll")) - 1))

    # one pass over the texts; every table below is rolled up from these counts
    counts = cut(seen.where("__first IS NOT NULL").groupBy("__host", "__domain", "__declared", "__suffix", "__first")
                 .agg(F.count("*").alias("n")))

    def per_language(key: str, name: str) -> DataFrame:
        of = [F.coalesce(F.sum(F.when(F.col("__first") == k, F.col("n"))), F.lit(0)).cast("double") for k in range(n_langs)]
        return counts.where(F.col(key).isNotNull()).groupBy(key).agg(F.array(*of).alias(name))

    totals = [0] * n_langs
    for r in counts.groupBy("__first").agg(F.sum("n").alias("n")).collect():  # a row for each language
        totals[r["__first"]] = r["n"]
    every = F.array(*[F.lit(float(t)) for t in totals])

    out = seen
    for key, name in (("__host", "__hosts"), ("__domain", "__domains"), ("__declared", "__declareds"), ("__suffix", "__suffixes")):
        out = _attach(out, per_language(key, name), key, name, n_langs)
    zeros = F.array(*[F.lit(0.0)] * n_langs)
    add = lambda a: F.aggregate(a, F.lit(0.0), lambda s, x: s + x)

    def less_own(counted: Column) -> Column:
        """Counts without the row itself."""
        return F.transform(F.coalesce(counted, zeros), lambda x, k: F.greatest(F.lit(0.0), x - F.when(F.col("__first") == k, 1.0).otherwise(0.0)))

    def smooth(counted: Column, parent: Column, weight: float) -> Column:
        whole = add(counted) + weight
        return F.zip_with(counted, parent, lambda c, p: (c + weight * p) / whole)

    out = out.withColumns({"__all": less_own(every), "__hosts": less_own(F.col("__hosts")), "__domains": less_own(F.col("__domains"))})
    out = out.withColumn("__prior", smooth(F.col("__all"), F.array(*[F.lit(1.0 / n_langs)] * n_langs), float(n_langs)))
    out = out.withColumn("__prior", smooth(F.col("__domains"), F.col("__prior"), HOST_WEIGHT))
    out = out.withColumn("__prior", smooth(F.col("__hosts"), F.col("__prior"), HOST_WEIGHT))

    def label_likelihood(counted: str, shown: str) -> Column:
        """log P(label | language), smoothed by the label's overall share; no label says nothing."""
        c = less_own(F.col(counted))
        share = (add(c) + 1.0) / (add(F.col("__all")) + n_langs)
        return F.when(F.col(shown).isNotNull(), F.zip_with(c, F.col("__all"), lambda x, a: F.log((x + LABEL_WEIGHT * share) / (a + LABEL_WEIGHT)))
                      ).otherwise(zeros)

    terms = F.arrays_zip(F.col("__ll").alias("t"), F.col("__prior").alias("p"), label_likelihood("__declareds", "__declared").alias("d"),
                         label_likelihood("__suffixes", "__suffix").alias("s"))
    weight = F.least(F.col("__n"), F.lit(EFFECTIVE_TRIGRAMS)).cast("double")
    out = out.withColumn("__score", F.transform(terms, lambda e: weight * e["t"] + F.log(e["p"]) + e["d"] + e["s"]))
    out = out.withColumn("__top", F.array_max("__score"))
    out = out.withColumn("probability", 1.0 / add(F.transform("__score", lambda x: F.exp(x - F.col("__top")))))
    flat = float(-TABLE_BITS * np.log(2.0))
    kept = (F.col("__n") > 0) & (F.array_max("__ll") > flat - BACKGROUND_MARGIN) & (F.col("probability") >= MIN_PROBABILITY)
    name = F.element_at(F.array(*[F.lit(x) for x in model.languages]), F.array_position("__score", F.col("__top")).cast("int"))
    out = out.withColumn("kept", kept).withColumn("language", F.when(F.col("kept"), name).otherwise("und"))
    return out.select(*[F.col(f"`{c}`") for c in own.columns], "language", F.when(F.col("__n") > 0, F.col("probability")).otherwise(0.0).alias("probability"), "kept")


# ---------------------------------------------------------------- evidence of pages and documents

def visible_text(html: Column) -> Column:
    """Markup without scripts, styles, comments and tags."""
    return F.regexp_replace(html, r"(?is)<script.*?</script\s*>|<style.*?</style\s*>|<!--.*?-->|<[^>]*>", " ")


def declared_language(html: Column) -> Column:
    """Primary subtag of the html element's lang attribute, null if none."""
    found = F.regexp_extract(html, r"(?i)<html\b[^>]*?\slang\s*=\s*[\"']?\s*([a-z]{2,3})\b", 1)
    return F.nullif(F.lower(found), F.lit(""))


def host_of(url: Column) -> Column:
    return F.nullif(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)", 1)), F.lit(""))


def domain_of(host: Column) -> Column:
    return F.substring_index(host, ".", -2)


def suffix_of(host: Column) -> Column:
    return F.substring_index(host, ".", -1)


def identify_documents(docs: DataFrame, model: TextModel) -> DataFrame:
    """Documents have a source where pages have a host, and no markup or address."""
    return identify(docs, model, F.col("text"), host=F.col("source"))


def keep_identified(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` with a language, own columns."""
    rows, back = set_aside(docs, _ADDED)
    return back(identify_documents(rows, train(rows)).where("kept"))


# ---------------------------------------------------------------- query

def query(spark, sf_dir: str) -> DataFrame:
    """Every document and every page: doc_id (of a page: -1 - page_id), kind,
    language, probability, kept."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    host = host_of(F.col("url"))
    null = F.lit(None).cast("string")
    rows = (docs.select("doc_id", F.lit("document").alias("kind"), "text", F.concat(F.lit("source "), F.coalesce("source", F.lit(""))).alias("host"),
                        null.alias("domain"), null.alias("declared"), null.alias("suffix"))
            .unionByName(pages.select((-1 - F.col("page_id")).alias("doc_id"), F.lit("page").alias("kind"), visible_text(F.col("html")).alias("text"),
                                      host.alias("host"), domain_of(host).alias("domain"), declared_language(F.col("html")).alias("declared"),
                                      suffix_of(host).alias("suffix"))))
    # the text is dropped once its likelihoods are known
    return identify(rows, train(docs), F.col("text"), F.col("host"), F.col("domain"), F.col("declared"), F.col("suffix"),
                    carry=["doc_id", "kind"])
