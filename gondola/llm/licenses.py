"""Licence scans by canonical digest lookup.

A text's canonical form has its case, punctuation and white space normalised,
its copyright lines dropped and equivalent spellings replaced.  The SHA-256 of
the canonical form is joined with the digests of known licence texts, so two
texts meet exactly when they agree word for word after normalisation.  Whole
texts are looked up, and each line of a text as a text of its own (licence
notices are often one line of a longer document).

The known digests of ``license_texts``, a fixed list, are looked up row by row:
nothing is shuffled.  Where the caller adds a table of licences, of any size, the
digests of texts and lines are joined with all known ones by equality instead.
Everything runs in DataFrame functions.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, lower_ascii, stored, without
from .license_texts import FULL, NOTICES, SPELLINGS, TITLES, more_texts

#: The short known texts: the full ones also under their titles.  ``more_texts`` has the long ones.
KNOWN = (FULL + NOTICES
         + [(name, f"{title}\n{text}") for name, text in FULL for title in TITLES.get(name, [])])
#: A copyright statement, as opposed to a sentence about copyright.
COPYRIGHT_LINE = (r"^[^a-z0-9(©]*(copyright +(\(c\)|©|[<\[]?(19|20|year|yyyy))|\(c\) *[<\[]?(19|20|year|yyyy)|© *[<\[]?(19|20|year|yyyy)"
                  r"|all rights reserved)")
NOT_WORD = r"[^\p{L}\p{N}]+"


def _words(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, NOT_WORD, " "))


def _spelled(c: Column) -> Column:
    return reduce(lambda x, p: F.regexp_replace(x, rf"\b{p[0]}\b", p[1]), SPELLINGS, c)


def _lines(text: Column) -> Column:
    """Lower-case lines of a text without its copyright lines."""
    return F.filter(F.split(lower_ascii(F.coalesce(text, F.lit(""))), "\n"), lambda x: ~F.rlike(x, F.lit(COPYRIGHT_LINE)))


def _plain(text: Column) -> Column:
    """Words of a text without its copyright lines."""
    return _words(F.array_join(_lines(text), " "))


def canonical(text: Column) -> Column:
    """Canonical form; null texts are empty."""
    return _spelled(_plain(text))


def _first_word(words: Column) -> Column:
    """First word of the canonical form; a spelling spans three words at most."""
    return F.substring_index(_spelled(F.substring_index(words, " ", 4)), " ", 1)


def _digest(words: Column, starts: list[str]) -> Column:
    """Digest of the canonical form; null at once where no known text starts so."""
    return F.when(_first_word(words).isin(starts), F.sha2(_spelled(words), 256))


def known_digests(spark, more: DataFrame | None = None) -> DataFrame:
    """(digest, license, first): one row for each known canonical form, those of ``more`` (license, text) too."""
    texts = spark.createDataFrame(KNOWN + more_texts(), "license string, text string")
    if more is not None:
        texts = texts.unionByName(more.select("license", "text"))
    rows = texts.select("license", canonical(F.col("text")).alias("form")).where("license IS NOT NULL AND form != ''")
    return rows.groupBy(F.sha2("form", 256).alias("digest")).agg(F.min("license").alias("license"), F.min(F.substring_index("form", " ", 1)).alias("first"))


def scan(docs: DataFrame, more: DataFrame | None = None) -> DataFrame:
    """``docs`` with license (of the entire text, null if none), notices (sorted
    licences of its lines) and n_notices (lines that are a known text).

    ``more`` (license, text) are licences and notices to know beside the fixed ones;
    of two names for one text the smaller counts.
    Null and empty texts have no licence, nor has a text of copyright lines
    alone; very long texts are hashed whole; repeated rows come back repeated; an
    empty table gives an empty one.  Incoming columns named like the added ones are
    replaced.
    """
    own = without(docs, ["license", "notices", "n_notices"])
    if more is not None:
        return _scan_joined(own, cut(known_digests(docs.sparkSession, more).select("digest", "license")))
    known = known_digests(docs.sparkSession).collect()  # a row for each text of the fixed list
    starts = sorted({r["first"] for r in known})
    table = F.create_map(*[F.lit(x) for r in known for x in (r["digest"], r["license"])])
    rows = docs.select(*[F.col(f"`{c}`") for c in own.columns], F.transform(_lines(F.col("text")), _words).alias("__lines"))
    rows = (rows.withColumn("__digest", _digest(F.trim(F.array_join(F.filter("__lines", lambda x: x != ""), " ")), starts))
            .withColumn("__hits", F.filter(F.transform("__lines", lambda x: table[_digest(x, starts)]),
                                           lambda x: x.isNotNull())))
    forms = docs.sparkSession.createDataFrame([(r["digest"], r["license"]) for r in known], "__digest string, license string")
    return rows.join(F.broadcast(forms), "__digest", "left").select(
        *[F.col(f"`{c}`") for c in own.columns], "license", F.sort_array(F.array_distinct("__hits")).alias("notices"),
        F.size("__hits").cast("long").alias("n_notices"))


def _scan_joined(docs: DataFrame, known: DataFrame) -> DataFrame:
    """``scan`` by a join on digest; the planner broadcasts a small list."""
    rows = stored(without(docs, ["__row"]).withColumn("__row", F.monotonically_increasing_id()))
    lines = F.filter(F.transform(_lines(F.col("text")), _words), lambda x: x != "")
    whole = F.struct(F.lit(True).alias("whole"), F.sha2(_spelled(F.trim(F.array_join(lines, " "))), 256).alias("digest"))
    each = F.transform(lines, lambda x: F.struct(F.lit(False).alias("whole"), F.sha2(_spelled(x), 256).alias("digest")))
    digests = rows.select("__row", F.inline(F.concat(F.array(whole), each)))
    line = F.when(~F.col("whole"), F.col("license"))
    found = digests.join(known, "digest").groupBy("__row").agg(
        F.min(F.when(F.col("whole"), F.col("license"))).alias("license"), F.sort_array(F.collect_set(line)).alias("notices"),
        F.count(line).alias("n_notices"))
    out = rows.join(found, "__row", "left").withColumns({
        "notices": F.coalesce("notices", F.array().cast("array<string>")), "n_notices": F.coalesce("n_notices", F.lit(0).cast("long"))})
    return out.select(*[F.col(f"`{c}`") for c in rows.columns if c != "__row"], "license", "notices", "n_notices")


# ---------------------------------------------------------------- query

def query(spark, sf_dir: str) -> DataFrame:
    """Every document with its licence, the notices among its lines and their number."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return scan(docs).select("doc_id", "license", F.array_join("notices", ",").alias("notices"), "n_notices")


def _quoted(x: str) -> str:
    return "'" + x.replace("'", "''") + "'"


def _sql_spelled(c: str) -> str:
    return reduce(lambda x, p: f"regexp_replace({x}, '\\b{p[0]}\\b', '{p[1]}', 'g')", SPELLINGS, c)


def _sql_words(c: str) -> str:
    return f"trim(regexp_replace({c}, '{NOT_WORD}', ' ', 'g'))"


def _sql_lines(c: str) -> str:
    low = f"translate(coalesce({c}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"list_filter(string_split({low}, chr(10)), lambda x: NOT regexp_matches(x, '{COPYRIGHT_LINE}'))"


SQL = f"""
WITH k AS (SELECT sha256({_sql_spelled(_sql_words(f"array_to_string({_sql_lines('t')}, ' ')"))}) AS digest, min(license) AS license
           FROM (VALUES {", ".join(f"({_quoted(a)}, {_quoted(b)})" for a, b in KNOWN + more_texts())}) AS v(license, t) GROUP BY 1),
     d AS (SELECT row_number() OVER () AS r, doc_id, {_sql_lines('text')} AS lines FROM documents),
     w AS (SELECT r, doc_id, {_sql_words("array_to_string(lines, ' ')")} AS words FROM d),
     n AS (SELECT r, license FROM (SELECT r, sha256({_sql_spelled(_sql_words('line'))}) AS digest
                                   FROM (SELECT r, unnest(lines) AS line FROM d)) JOIN k USING (digest)),
     g AS (SELECT r, string_agg(DISTINCT license, ',' ORDER BY license) AS notices, count(*) AS n_notices FROM n GROUP BY r)
SELECT doc_id, license, coalesce(notices, '') AS notices, coalesce(n_notices, 0) AS n_notices
FROM (SELECT r, doc_id, sha256({_sql_spelled('words')}) AS digest FROM w) LEFT JOIN k USING (digest) LEFT JOIN g USING (r)
"""
