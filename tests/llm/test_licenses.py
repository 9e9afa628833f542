import textwrap

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from gondola.llm import license_texts, licenses
from gondola.llm.license_texts import FULL
from tools.check_oracle import rows_of

from .conftest import SF

MIT = dict(FULL)["MIT"]


def test_normalisation(spark, make_docs):
    rows = [
        (1, "The MIT License (MIT)\n\nCopyright (c) 2020 A B\n\n" + textwrap.fill(MIT, 60), "MIT", [], 0),
        (2, MIT.upper().replace("SUBLICENSE", "sub-licence"), "MIT", [], 0),
        (3, MIT + " Also.", None, [], 0),
        (4, "hello\n  released under the MIT licence!\nbye\nLicensed under CC BY 4.0\nLicensed under CC BY 4.0.", None, ["CC-BY-4.0", "MIT"], 3),
        (5, None, None, [], 0), (6, "", None, [], 0), (7, "© 2020 x\nAll rights reserved.", None, [], 0),
        (8, dict(FULL)["BSD-2-Clause"].replace("COPYRIGHT HOLDER", "COPYRIGHT OWNER"), "BSD-2-Clause", [], 0),
        (9, "Released under the MIT License.", "MIT", ["MIT"], 1), (9, "Released under the MIT License.", "MIT", ["MIT"], 1),
        (None, "permission " * 30_000, None, [], 0),
    ]
    docs = make_docs([r[:2] for r in rows]).withColumn("License", F.lit("own")).withColumn("digest", F.lit("own"))
    got = licenses.scan(docs).select("doc_id", "digest", "license", "notices", "n_notices").collect()
    key = lambda r: (str(r[0]), str(r[1]))
    assert sorted(((r["doc_id"], r["license"], r["notices"], r["n_notices"]) for r in got), key=key) == sorted(((a, *c) for a, _, *c in rows), key=key)
    assert all(r["digest"] == "own" for r in got)
    assert licenses.scan(make_docs([])).collect() == []


def test_long_licences_spdx_lines_and_a_table_of_more(spark, make_docs):
    texts = dict(sorted(license_texts.more_texts(), key=lambda x: len(x[1])))  # the whole files
    gpl, apache = texts["GPL-3.0"], texts["Apache-2.0"]
    assert "How to Apply" in gpl and "Apache-2.0" not in dict(FULL)
    rows = [
        (1, apache.upper(), "Apache-2.0", 0), (2, "Copyright 2020 A B\n" + gpl, "GPL-3.0", 0), (3, gpl[:gpl.index("END OF TERMS")], "GPL-3.0", 0),
        (4, texts["MPL-2.0"], "MPL-2.0", 0), (5, "x\nSPDX-License-Identifier: GPL-3.0-or-later\n# SPDX-License-Identifier: BSD-3-Clause", None, 2),
        (6, "My  licence: do as you like!", None, 0), (7, "", None, 0), (8, "gnu general public license", None, 0),
    ]
    docs = make_docs([r[:2] for r in rows])
    got = {r["doc_id"]: (r["license"], r["n_notices"]) for r in licenses.scan(docs).collect()}
    assert got == {r[0]: r[2:] for r in rows}
    more = spark.createDataFrame([("Own-1.0", "my license, do as you like"), ("No", None), ("No", ""), (None, "x")], "license string, text string")
    got = {r["doc_id"]: (r["license"], r["n_notices"]) for r in licenses.scan(docs, more).collect()}
    assert got == {r[0]: r[2:] for r in rows} | {6: ("Own-1.0", 1)}


def test_a_table_of_ten_thousand_more_licences(spark, make_docs):
    """Joined by digest: no literal of the plan and nothing on the driver grows with the table."""
    more = spark.range(10_000).select(F.concat(F.lit("L-"), "id").alias("license"), F.concat(F.lit("terms of licence number "), "id", F.lit(" are as follows")).alias("text"))
    docs = make_docs([(i, f"Terms of License number {i} are as follows!") for i in range(0, 10_000, 500)]
                     + [(-1, "x\nterms of licence number 7 are as follows\nterms of licence number 7 are as follows."), (-2, None), (-3, MIT), (-3, MIT)])
    out = licenses.scan(docs.withColumn("__row", F.lit("own")), more)
    assert len(out._jdf.queryExecution().analyzed().toString()) < 50_000
    got = sorted((r["doc_id"], r["license"], r["notices"], r["n_notices"]) for r in out.collect())
    assert got == sorted([(i, f"L-{i}", [f"L-{i}"], 1) for i in range(0, 10_000, 500)] + [(-1, None, ["L-7"], 2), (-2, None, [], 0)]
                         + [(-3, "MIT", [], 0)] * 2, key=lambda r: r[0])


@pytest.mark.parametrize("name", sorted(k for k in entry.oracle_sql() if k.startswith("op")))
def test_queries_against_their_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "conversations", "labels", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = entry.queries()[name](spark, SF)
    res = con.sql(entry.oracle_sql()[name])
    assert sorted(df.columns) == sorted(res.columns)
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(res.columns, res.fetchall())
