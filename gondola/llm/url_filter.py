"""URL filters: a blocked Bloom filter before an exact hash join.

Two lists judge a URL.  A rule (host, path, verdict) fits its host and all
subdomains of it where the URL's path starts with the rule's; the longest rule
wins.  A URL that no rule fits is blocked where its canonical form is listed.

Both lists become text keys: a rule's is its host and path, a listed URL's its
canonical form.  A URL has one key for its own canonical form and one for each
shape (labels of the host, characters of the path) that some rule has.  Keys
are looked up in a blocked Bloom filter first, a table of 64-bit blocks of which
a key sets bits in one.  Keys that pass are joined with the lists by equality,
which removes the false positives.  The filter has ``MAX_BLOCKS`` rows at most
and is broadcast; beyond that more false positives reach the join, nothing else.

Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, lower_ascii, without

#: Rows of the filter at most (16 bytes each).
MAX_BLOCKS = 1 << 18
#: Keys that share a 64-bit block on average, below that bound.
KEYS_PER_BLOCK = 4
#: Bits that a key sets in its block.
BITS = 4

#: Query parameters that a canonical URL has not.
TRACKING = r"^(utm_[^=]*|ref|fbclid|gclid)(=|$)"

_ADDED = ["host", "path", "rule", "verdict"]


# ---------------------------------------------------------------- URLs

def _rest(url: Column) -> Column:
    """What follows the first ``://`` (null where there is none)."""
    at = F.locate("://", url)
    return F.when(at > 0, F.substring(url, at + 3, F.length(url)))


def host_of(url: Column) -> Column:
    """Host, A-Z lower-cased; empty for null and for no ``://``."""
    return F.coalesce(lower_ascii(F.regexp_extract(_rest(url), r"^([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    """Path up to ``?`` or ``#``; empty for null and for no ``://``."""
    return F.coalesce(F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def canonical(url: Column) -> Column:
    """Canonical form, null for null and for no ``://``.

    Scheme, default port, final dots of the host and slashes of the path,
    fragment and tracking parameters go; other parameters are sorted.
    """
    host = F.regexp_replace(F.regexp_replace(host_of(url), r":(80|443)?\z", ""), r"\.+\z", "")
    path = F.regexp_replace(path_of(url), r"/+\z", "")
    query = F.regexp_extract(_rest(url), r"^[^?#]*\?([^#]*)", 1)
    kept = F.array_sort(F.filter(F.split(query, "&"), lambda x: (x != "") & ~F.rlike(x, F.lit(TRACKING))))
    return F.when(_rest(url).isNotNull(), F.concat(host, path, F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&")))
                                                   .otherwise(F.lit(""))))


# ---------------------------------------------------------------- keys and filter

def rule_key(host: Column, path: Column) -> Column:
    return F.concat(F.lit("r"), host, path)


def url_key(form: Column) -> Column:
    return F.concat(F.lit("u"), form)


def _labels(host: Column) -> Column:
    return F.length(host) - F.length(F.replace(host, F.lit("."), F.lit(""))) + 1


def _hash(key: Column, blocks: int) -> tuple[Column, Column]:
    """A key's block and its bits there.  ``blocks`` is a power of two."""
    h = F.xxhash64(key)
    bits = [F.call_function("shiftleft", F.lit(1).cast("long"),
                            F.shiftrightunsigned(h, 24 + 6 * i).bitwiseAND(F.lit(63)).cast("int")) for i in range(BITS)]
    mask = bits[0]
    for b in bits[1:]:
        mask = mask.bitwiseOR(b)
    return h.bitwiseAND(F.lit(blocks - 1)).cast("int"), mask


def bloom_filter(keys: DataFrame, max_blocks: int = MAX_BLOCKS) -> tuple[DataFrame, int]:
    """(block, word) of the filter over column ``key``, and its number of blocks."""
    blocks = 1
    wanted = min(max_blocks, -(-keys.count() // KEYS_PER_BLOCK))
    while blocks < wanted:
        blocks *= 2
    block, mask = _hash(F.col("key"), blocks)
    return keys.select(block.alias("block"), mask.alias("mask")).groupBy("block").agg(F.bit_or("mask").alias("word")), blocks


def possible_hits(keys: DataFrame, bloom: DataFrame, blocks: int) -> DataFrame:
    """Rows of ``keys`` whose column ``key`` passes the filter."""
    block, mask = _hash(F.col("key"), blocks)
    found = keys.withColumns({"block": block, "mask": mask}).join(F.broadcast(bloom), "block")
    return found.where(F.col("word").bitwiseAND(F.col("mask")) == F.col("mask")).select(keys.columns)


# ---------------------------------------------------------------- judgement

def _rules(rules: DataFrame) -> DataFrame:
    """One row for each (host, path), hosts lower-cased; block wins over allow."""
    whole = rules.select(lower_ascii(F.col("host")).alias("host"), "path", "verdict").dropna()
    return whole.groupBy("host", "path").agg(F.max("verdict").alias("verdict"))


def judge_urls(urls: DataFrame, rules: DataFrame, listed: DataFrame, max_blocks: int = MAX_BLOCKS) -> DataFrame:
    """(url, rule, verdict) of the distinct URLs that a rule fits or that are listed."""
    rules = cut(_rules(rules).withColumn("key", rule_key(F.col("host"), F.col("path"))))
    forms = cut(listed.select(url_key(canonical(F.col("url"))).alias("key")).dropna().distinct())
    # a pair of lengths each: far fewer than rules, since n pairs need texts of some n**1.5 characters
    shapes = sorted(tuple(r) for r in rules.select(_labels(F.col("host")), F.length("path")).distinct().collect())
    shapes = F.array(*[F.struct(F.lit(n).alias("labels"), F.lit(c).alias("chars")) for n, c in shapes]) if shapes else None
    bloom, blocks = bloom_filter(rules.select("key").unionAll(forms), max_blocks)

    parts = urls.select("url").where(F.contains("url", F.lit("://"))).distinct().select(
        "url", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    keys = F.array(url_key(canonical(F.col("url"))))
    if shapes is not None:
        fitting = F.filter(shapes, lambda s: (s["labels"] <= _labels(F.col("host"))) & (s["chars"] <= F.length("path")))
        keys = F.concat(keys, F.transform(fitting, lambda s: rule_key(
            F.call_function("substring_index", F.col("host"), F.lit("."), -s["labels"]), F.call_function("left", F.col("path"), s["chars"]))))
    keys = parts.select("url", F.explode(keys).alias("key"))
    hits = cut(possible_hits(keys, bloom, blocks))
    by_rule = hits.join(rules, "key").select(
        "url", F.struct(F.length(F.concat("host", "path")).alias("chars"), F.length("host").alias("host_chars"), "verdict",
                        F.concat("host", "path").alias("rule")).alias("rule"))
    by_list = hits.join(forms, "key").select("url", F.lit(None).alias("rule"))
    best = by_rule.unionByName(by_list).groupBy("url").agg(F.max("rule").alias("best"))
    return best.select("url", F.col("best.rule").alias("rule"), F.coalesce("best.verdict", F.lit("block")).alias("verdict"))


def judge(pages: DataFrame, rules: DataFrame, listed: DataFrame, max_blocks: int = MAX_BLOCKS) -> DataFrame:
    """``pages`` with host, path, rule (its text, null if none fits) and verdict.

    ``rules`` has host, path and verdict (allow or block), ``listed`` a column
    url.  Of rules of one length the one with the longer host wins; of equal
    rules block wins over allow; a rule with a null is left out.  A null url, or
    one without ``://``, has an empty host and path, is fitted by no rule and
    listed nowhere, so it is allowed; an empty one too.  Very long URLs are
    judged whole.  Repeated pages and URLs get equal verdicts and stay repeated;
    empty tables of any kind give what follows from the others.  Incoming columns
    named like the added ones are replaced.
    """
    pages = without(pages, _ADDED)
    # both sides are read from files, so a URL that many pages share can be split by AQE
    verdicts = cut(judge_urls(pages, rules, listed, max_blocks)).withColumnRenamed("url", "__url")
    out = pages.join(verdicts, F.col("url") == F.col("__url"), "left")
    return out.select(*[F.col(f"`{c}`") for c in pages.columns], host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"),
                      "rule", F.coalesce("verdict", F.lit("allow")).alias("verdict"))


# ---------------------------------------------------------------- query

#: The contract's rules.
RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


def repeat_visits(pages: DataFrame) -> DataFrame:
    """URLs whose canonical form stands on several pages (one URL for each form)."""
    return (pages.select("url", canonical(F.col("url")).alias("form")).where("form IS NOT NULL").groupBy("form")
            .agg(F.min("url").alias("url"), F.count("*").alias("n")).where("n > 1").select("url"))


def query(spark, sf_dir: str) -> DataFrame:
    """Contract form: every page by the four rules, else by the list of the
    canonical URLs that the crawl visited more than once."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    return judge(pages, spark.createDataFrame(RULES, "host string, path string, verdict string"), repeat_visits(pages)).drop("url")


_VALUES = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in RULES)

SQL = f"""
WITH p AS (SELECT row_number() OVER () AS r, page_id,
                  CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) END AS rest FROM pages),
     u AS (SELECT r, page_id, rest,
                  coalesce(translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
                  coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path,
                  list_sort(list_filter(string_split(regexp_extract(rest, '^[^?#]*\\?([^#]*)', 1), '&'),
                                        lambda x: x <> '' AND NOT regexp_matches(x, '{TRACKING}'))) AS q FROM p),
     f AS (SELECT *, CASE WHEN rest IS NOT NULL THEN
                  regexp_replace(regexp_replace(host, ':(80|443)?$', ''), '\\.+$', '') || regexp_replace(path, '/+$', '')
                  || CASE WHEN len(q) > 0 THEN '?' || array_to_string(q, '&') ELSE '' END END AS form FROM u),
     l AS (SELECT form FROM f WHERE form IS NOT NULL GROUP BY form HAVING count(*) > 1),
     m AS (SELECT r, arg_max(rule, length(rule)) AS rule, arg_max(v.verdict, length(rule)) AS verdict
           FROM f JOIN (SELECT *, h || s AS rule FROM (VALUES {_VALUES}) AS x(h, s, verdict)) v
                ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, s) AND rest IS NOT NULL GROUP BY r)
SELECT page_id, host, path, rule, coalesce(verdict, CASE WHEN l.form IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict
FROM f LEFT JOIN m USING (r) LEFT JOIN l ON f.form = l.form
"""
