"""Licence scan and URL filter."""

import re

import duckdb
import pytest

from rillflow.llm import license_scan as ls
from rillflow.llm import url_filter as uf
from rillflow.llm.queries import ORACLE_SQL


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_every_known_sentence_can_be_found():
    for s in ls.known_sentences():
        assert any(h in s for h in ls.HINTS) or re.search(ls.SPACED_HINTS, s), s
        assert re.fullmatch("[a-z0-9]+( [a-z0-9]+)*", s)
    assert {i for _, want in ls.RULES for i in want} <= set(ls.SENTENCES)


def test_licences(spark):
    grant, notice = (ls.SENTENCES[k][0] for k in ("mit-grant", "mit-notice"))
    rows = [
        (1, "Intro text.\nReleased under the MIT License.\nMore."), (2, "LICENSED under the Apache License, Version 2.0. You may not use this file except in compliance with the License."), (3, "no terms here"), (4, None), (5, ""),
        (6, f"{grant.upper()}: {notice}."), (7, f"{grant}.\nSomething else between.\n{notice}!"), (8, notice + "."), (9, "The licence is lovely. A license."), (10, "x. " * 50_000 + "All rights reserved."),
        (11, "Licensed under CC BY-NC 4.0.\nLicensed under CC BY-NC 4.0."), (11, "Licensed under CC BY-NC 4.0."), (None, "Released under the MIT License"), (12, "This work is licensed under the GNU General Public License, version 3.; Released under the MIT License."),
    ]
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, ids string")
    out = ls.scan(df)
    assert "Python" not in plan(out) and "Arrow" not in plan(out) and "Exchange" not in plan(out)
    got = sorted(((r.doc_id or 0, r.licence, r.sentence_ids, r.n_sentences) for r in out.collect()))
    assert got == [
        (0, "MIT", "mit-ref", 1), (1, "MIT", "mit-ref", 1), (2, "Apache-2.0", "apache2-ref apache2-use", 2), (7, "MIT", "mit-grant mit-notice", 2), (8, "unknown", "mit-notice", 1),
        (10, "proprietary", "reserved", 1), (11, "CC-BY-NC-4.0", "ccbync4-ref", 1), (11, "CC-BY-NC-4.0", "ccbync4-ref ccbync4-ref", 2), (12, "GPL-3.0", "gpl3-ref mit-ref", 2),
    ]
    assert ls.scan(df.where("false")).count() == 0


URLS = [
    "http://a.example.com/en/1", "http://WWW.Example.com/en/2?x=/es/", "http://example.com/fr/3", "https://b.example.net/es/4", "https://b.example.net/de/5#t", "ftp://u:p@h.net:8080/fr/6", None, "", "no scheme/here",
    "http://", "http:///en/", "http://example.com?en/", "x://y://z.net/es/7", "http://notexample.com/en/8", "http://good.co.uk/en/9", "http://bad.co.uk/en/10", "http://ÄÖ.example.com/en/", "http://net/es/", "http://a.example.com/EN/",
]


def tables(spark):
    rows = [(i, u) for i, u in enumerate(URLS)] + [(100, URLS[0]), (100, URLS[0]), (None, URLS[3])]
    rows += [(200 + i, f"http://spam.bad.org/xx/{5000 + i}") for i in range(60)] + [(300 + i, f"http://fine.good.org/xx/{1000 + i}") for i in range(60)] + [(400, "http://new.bad.org/xx/9999")]
    labels = [(5000 + i, 0, 1) for i in range(60)] + [(1000 + i, 1, 0) for i in range(60)] + [(None, 0, 1), (1, None, None), (2, 0, 1)]
    return spark.createDataFrame([(*r, "h") for r in rows], "page_id long, url string, host string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_urls(spark, tmp_path):
    pages, labels = tables(spark)
    out = uf.judge(pages, labels)
    text = plan(out)
    assert "Python" not in text and "Arrow" not in text
    got = {r.page_id: r for r in out.collect()}
    at = lambda i: (got[i].host, got[i].path, got[i].rule, got[i].verdict)
    assert at(0) == ("a.example.com", "/en/1", "example.com/en/", "block")
    assert at(1) == ("www.example.com", "/en/2", "www.example.com/en/", "allow")
    assert at(2)[2:] == ("com/", "allow") and at(3)[2:] == ("net/es/", "block") and at(4) == ("b.example.net", "/de/5", None, "allow")
    assert at(5)[:3] == ("u:p@h.net:8080", "/fr/6", None) and at(6)[:3] == ("", "", None) and at(7)[:2] == ("", "") and at(8)[:2] == ("", "") and at(9)[:2] == ("", "") and at(10)[:3] == ("", "/en/", None)
    assert at(11)[:3] == ("example.com", "", None) and at(12)[:3] == ("y:", "//z.net/es/7", None) and at(13)[2:] == ("com/", "allow")
    assert at(16)[0] == "ÄÖ.example.com" and at(17)[2:] == ("net/es/", "block") and at(18)[2] == "com/"
    assert got[200].verdict == "block" and got[300].verdict == "allow" and got[400].verdict == "block" and got[400].rep_n == 0 and got[400].rep_mean > 0.5 > got[300].rep_mean
    assert out.count() == pages.count() and uf.judge(pages.where("false"), labels).count() == 0
    con = duckdb.connect()
    for n, df in (("pages", pages.select("page_id", "url")), ("labels", labels)):
        df.coalesce(1).write.parquet(f"{tmp_path}/{n}")
        con.sql(f"CREATE VIEW {n} AS SELECT * FROM read_parquet('{tmp_path}/{n}/*.parquet')")
    sql = con.sql(ORACLE_SQL["op5_url_filter"])
    order = sorted(out.columns)
    assert sorted(tuple(str(r[c]) for c in order) for r in out.collect()) == sorted(tuple(str(r[sql.columns.index(c)]) for c in order) for r in sql.fetchall())


@pytest.mark.parametrize("host, domain, suffix", [("a.b.example.com", "example.com", "com"), ("x.good.co.uk", "good.co.uk", "co.uk"), ("co.uk", "co.uk", "co.uk"), ("com", "com", "com"), ("", "", "")])
def test_names(spark, host, domain, suffix):
    from pyspark.sql import functions as F

    row = spark.range(1).select(uf.domain(F.lit(host)).alias("d")).select("d", uf.suffix(F.col("d")).alias("s")).first()
    assert row.d == domain
