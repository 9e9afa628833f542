import math
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from gondola.llm import langid

from .conftest import SF


@pytest.fixture(scope="module")
def model(spark):
    sample = spark.read.parquet(f"{SF.replace('0.001', '0.01')}/documents.parquet").where("doc_id % 2 = 0")
    return langid.train(sample)


def test_held_out_accuracy(spark, model):
    rest = spark.read.parquet(f"{SF.replace('0.001', '0.01')}/documents.parquet").where("doc_id % 2 = 1")
    rows = langid.identify_documents(rest, model).collect()
    assert len(rows) == 500 and all(r["kept"] for r in rows)
    assert sum(r["language"] == r["lang"] for r in rows) >= 495


def test_evidence_decides_short_texts(spark, model):
    rows = [(i, "a en de", "de", "h.de", None, "de") for i in range(20)] + [(100, "la", None, "x.org", "es", None), (101, "la", None, "x.org", "fr", None)]
    texts = [(200 + i, t, None, "x.org", lang, None) for i, (t, lang) in enumerate(
        [("Que de la ciones. Se los mente bo.", "es"), ("La qui des tre ouèe. Le éreaux.", "fr")] * 10)]
    df = spark.createDataFrame(rows + texts, "id long, text string, x string, host string, declared string, suffix string")
    got = {r["id"]: r["language"] for r in langid.identify(df, model, F.col("text"), F.col("host"), None, F.col("declared"), F.col("suffix")).collect()}
    # the same text, told apart by what its page declares
    assert (got[100], got[101]) == ("es", "fr")


def test_rejection_nulls_repeats_clashes_and_empty_tables(spark, model, make_docs):
    docs = make_docs([(1, None), (2, ""), (3, "123 456 !!"), (4, "the of and ing that"), (4, "the of and ing that"), (5, "漢字 仮名 交じり文 日本語 文章"),
                      (None, "the of and", "en", None), (6, "The that of " * 20_000)]).withColumn("Kept", F.lit("own"))
    rows = langid.identify_documents(docs, model).collect()
    got = sorted(((r["doc_id"], r["language"], r["kept"]) for r in rows), key=repr)
    assert got == sorted([(1, "und", False), (2, "und", False), (3, "und", False), (4, "en", True), (4, "en", True), (5, "und", False),
                          (None, "en", True), (6, "en", True)], key=repr)
    assert all(r["probability"] == 0.0 for r in rows if r["doc_id"] in (1, 2, 3))
    assert langid.identify_documents(make_docs([]), model).collect() == []
    unlabelled = langid.train(make_docs([(1, "a", None)]))
    assert [r["language"] for r in langid.identify_documents(make_docs([(1, "the")]), unlabelled).collect()] == ["und"]


def test_joined_counts_equal_sent_counts(spark, model, monkeypatch):
    rows = [(i, ["the of and", "le la des", "der die und", "x"][i % 4], f"h{i % 7}.{'ab'[i % 2]}.c", f"{'ab'[i % 2]}.c", ["en", None, "de"][i % 3], "c") for i in range(60)]
    df = spark.createDataFrame(rows, "id long, text string, host string, domain string, declared string, suffix string")
    args = [F.col(c) for c in ("text", "host", "domain", "declared", "suffix")]
    sent = sorted(map(tuple, langid.identify(df, model, *args).collect()))
    monkeypatch.setattr(langid, "BROADCAST_BYTES", 0)
    monkeypatch.setattr(langid, "HOT_KEYS", 6)
    joined = sorted(map(tuple, langid.identify(df, model, *args).collect()))
    assert [r[:-2] + r[-1:] for r in joined] == [r[:-2] + r[-1:] for r in sent]
    assert [r[-2] for r in joined] == pytest.approx([r[-2] for r in sent])


def test_markup_and_address(spark):
    df = spark.createDataFrame([("<!DOCTYPE html><HTML class='x' Lang = \"pt-BR\">", "https://u@news.Example.co.uk:80/a?b"), ("<html>", "nohost"), (None, None)],
                               "html string, url string")
    host = langid.host_of(F.col("url"))
    rows = df.select(langid.declared_language(F.col("html")), host, langid.domain_of(host), langid.suffix_of(host)).collect()
    assert [tuple(r) for r in rows] == [("pt", "news.example.co.uk", "co.uk", "uk"), (None, None, None, None), (None, None, None, None)]


def test_query_covers_documents_and_pages(spark):
    rows = langid.query(spark, SF).collect()
    docs = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    pages = {-1 - r["page_id"]: r["d"] for r in spark.read.parquet(f"{SF}/pages.parquet").select("page_id", langid.declared_language(F.col("html")).alias("d")).collect()}
    truth = {**docs, **pages}
    assert len(rows) == len(truth)
    assert sum(r["language"] == truth[r["doc_id"]] for r in rows) >= 0.99 * len(rows)


def plain_posteriors(rows, model):
    """(language, probability, kept) of rows (text, host, domain, declared, suffix), step by step in plain Python."""
    n_langs, size = len(model.languages), 1 << langid.TABLE_BITS
    seen = []
    for text, *_ in rows:
        letters = [b if 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in
                   (b + 32 if 0x41 <= b <= 0x5A else b for b in (text or "").encode())]
        padded = [0x20, *letters, 0x20]
        found = [((padded[i - 1] << 16 | padded[i] << 8 | padded[i + 1]) * 2654435761 % 2**32) >> (32 - langid.TABLE_BITS)
                 for i in range(1, len(padded) - 1) if padded[i] != 0x20]
        assert all(x < size for x in found)
        mean = [sum(float(model.table[k][x]) for x in found) / len(found) if found else 0.0 for k in range(n_langs)]
        seen.append((mean, len(found), mean.index(max(mean)) if found else None))
    keyed = [(host or "", domain if domain is not None else host or "", declared, suffix) for _, host, domain, declared, suffix in rows]
    tables = [defaultdict(lambda: [0.0] * n_langs) for _ in range(4)]
    every = [0.0] * n_langs
    for (_, _, first), keys in zip(seen, keyed):
        if first is not None:
            every[first] += 1
            for table, key in zip(tables, keys):
                if key is not None:
                    table[key][first] += 1
    out = []
    for (mean, n, first), keys in zip(seen, keyed):
        less = lambda c: [max(0.0, x - (k == first)) for k, x in enumerate(c)]  # noqa: B023, E731
        whole = less(every)
        hosts, domains, declared, suffix = (less(t.get(k, [0.0] * n_langs)) if k is not None else None for t, k in zip(tables, keys))
        prior = [(x + 1.0) / (sum(whole) + n_langs) for x in whole]
        for counts in (domains, hosts):
            prior = [(c + langid.HOST_WEIGHT * p) / (sum(counts) + langid.HOST_WEIGHT) for c, p in zip(counts, prior)]
        score = [min(n, langid.EFFECTIVE_TRIGRAMS) * m + math.log(p) for m, p in zip(mean, prior)]
        for label in (declared, suffix):
            if label is not None:
                share = (sum(label) + 1.0) / (sum(whole) + n_langs)
                score = [s + math.log((x + langid.LABEL_WEIGHT * share) / (a + langid.LABEL_WEIGHT)) for s, x, a in zip(score, label, whole)]
        top = max(score)
        probability = 1.0 / sum(math.exp(s - top) for s in score) if n else 0.0
        kept = n > 0 and max(mean) > -langid.TABLE_BITS * math.log(2) - langid.BACKGROUND_MARGIN and probability >= langid.MIN_PROBABILITY
        out.append((model.languages[score.index(top)] if kept else "und", probability, kept))
    return out


def test_posteriors_against_plain_python(spark, model):
    """Every term of the fusion: text, markup, suffix, and host priors smoothed by domain and whole."""
    rng = random.Random(9)
    docs = [r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").collect()]
    rows = []
    for i in range(250):
        text = rng.choice([rng.choice(docs)[:rng.choice([0, 3, 9, 25, 300])], "la", "de en", None, "", "12 !", "漢字 仮名", "A en de la"])
        domain = rng.choice(["x.org", "y.net", "z.com"])
        host = rng.choice([None, domain, f"a.{domain}", f"b{rng.randrange(9)}.{domain}"])
        rows.append((text, host, rng.choice([domain, domain, None]), rng.choice([None, "de", "fr", "es", "xx"]), rng.choice([None, "org", "net", "com"])))
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "id long, text string, host string, domain string, declared string, suffix string")
    got = {r["id"]: r for r in langid.identify(df, model, *[F.col(c) for c in ("text", "host", "domain", "declared", "suffix")]).collect()}
    want = plain_posteriors(rows, model)
    assert len({w[0] for w in want}) >= 4 and any(w[2] for w in want) and not all(w[2] for w in want)
    for i, (language, probability, kept) in enumerate(want):
        assert (got[i]["language"], got[i]["kept"]) == (language, kept), rows[i]
        assert got[i]["probability"] == pytest.approx(probability, rel=1e-6, abs=1e-12)


def test_query_against_plain_python(spark):
    """The registered query's rows: documents and pages together, model trained on all documents."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(d["doc_id"], d["text"], f"source {d['source'] or ''}", None, None, None) for d in docs.collect()]
    host = langid.host_of(F.col("url"))
    pages = spark.read.parquet(f"{SF}/pages.parquet").select(
        (-1 - F.col("page_id")), langid.visible_text(F.col("html")), host, langid.domain_of(host), langid.declared_language(F.col("html")), langid.suffix_of(host))
    rows += [tuple(r) for r in pages.collect()]
    want = plain_posteriors([r[1:] for r in rows], langid.train(docs))
    got = {r["doc_id"]: r for r in langid.query(spark, SF).collect()}
    assert len(got) == len(rows)
    for (doc, *_), (language, probability, kept) in zip(rows, want):
        assert (got[doc]["language"], got[doc]["kept"]) == (language, kept)
        assert got[doc]["probability"] == pytest.approx(probability, rel=1e-6, abs=1e-12)
