"""Host reputations: estimated priors, hot and missing keys, odd hosts and labels."""

import math
import random

import duckdb
import pytest
from pyspark.sql import functions as F

from rillflow.llm import url_filter as uf
from rillflow.llm.queries import ORACLE_SQL


def by_sql(pages, labels, folder):
    con = duckdb.connect()
    for n, df in (("pages", pages.select("page_id", "url")), ("labels", labels)):
        df.coalesce(1).write.parquet(f"{folder}/{n}")
        con.sql(f"CREATE VIEW {n} AS SELECT * FROM read_parquet('{folder}/{n}/*.parquet')")
    sql = con.sql(ORACLE_SQL["op5_url_filter"])
    return sql.columns, sql.fetchall()


def same(out, pages, labels, folder):
    columns, rows = by_sql(pages, labels, folder)
    order = sorted(out.columns)
    assert order == sorted(columns)
    assert sorted(tuple(str(r[c]) for c in order) for r in out.collect()) == sorted(tuple(str(r[columns.index(c)]) for c in order) for r in rows)


def pages_(spark, urls):
    return spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "page_id long, url string")


@pytest.fixture(scope="module")
def made(spark):
    """Domains whose hosts are alike; one domain with a host a page; one document and pages without a number in very many."""
    rng = random.Random(6)
    urls, labels, doc = [], [], 1000
    for d in range(30):
        rate = 0.95 if d % 5 == 0 else 0.05
        for h in range(rng.randint(1, 6)):
            for _ in range(rng.randint(1, 25)):
                urls.append(f"https://h{h}.site{d}.{rng.choice(['org', 'co.uk', 'net'])}/en/{doc}")
                if rng.random() < 0.8:
                    labels.append((doc, int(rng.random() >= rate), 0))
                doc += 1
    urls += [f"http://u{i}.hosting.org/en/7" for i in range(400)] + [f"http://v{i}.blogspot.com/about" for i in range(300)] + ["http://one.org/en/7"] * 200
    urls += ["http://10.0.0.1:8080/en/1000", "http://[::1]:80/en/1001", "ftp://me@u@site0.org./x/1002", "http://site0.org.:80/", "http://a..org/", "http://.org/", None, "x", "http://long.org/" + "y" * 200_000 + "/1003", "http://" + "z." * 5000 + "org/en/1004"]
    return pages_(spark, urls), spark.createDataFrame([*labels, (7, 0, 1)], "doc_id long, quality int, toxic int")


@pytest.mark.parametrize("share", [1000, 20, 2])
def test_sql_gives_the_same_rows(spark, made, tmp_path, monkeypatch, share):
    monkeypatch.setattr(uf, "HOT_SHARE", share)
    pages, labels = made
    same(uf.judge(pages, labels), pages, labels, tmp_path)


def test_without_labels(spark, made, tmp_path):
    pages, labels = made
    out = uf.judge(pages, labels.where("false"))
    assert {r.verdict for r in out.where("rule is null").collect()} == {"allow"} and {r.rep_mean for r in out.collect()} == {0.5}
    same(out, pages, labels.where("false"), tmp_path)


def test_no_key_is_hot_in_a_shuffle(spark, made):
    pages, _ = made
    left = pages.select("page_id", F.when(F.col("page_id") % 3 > 0, F.col("page_id") % 3).otherwise(None).alias("k"))
    right = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "k long, v string")
    out = uf.joined(left, right, "k", left.groupBy("k").agg(F.count("*").alias("c")))
    text = out._jdf.queryExecution().executedPlan().toString()
    assert text.count("BroadcastHashJoin") >= 3
    got = {r.k: r.n for r in out.groupBy("k", "v").agg(F.count("*").alias("n")).collect()}
    assert got == {r.k: r.n for r in left.groupBy("k").agg(F.count("*").alias("n")).collect()}


def test_strength_follows_the_spread(spark):
    """Names alike under a parent make a strong prior, names that differ a weak one; chance alone none below the most."""
    def of(rates):
        rng = random.Random(3)
        rows = [("p", 200, sum(rng.random() < x for _ in range(200))) for x in rates for _ in range(20)]
        return uf.strength(uf.counted(spark.createDataFrame(rows, "p string, n long, bad long"), "p"))

    alike, some, apart = of([0.3]), of([0.2, 0.4]), of([0.0, 1.0])
    assert alike > 200 > some > 5 > apart >= uf.LEAST
    # two rates at equal shares: r is their variance over that of an outcome
    assert some == pytest.approx(0.3 * 0.7 / 0.01 - 1, rel=0.4)
    assert uf.strength(uf.counted(spark.createDataFrame([("p", 9, 4)], "p string, n long, bad long"), "p")) == uf.NO_PAIRS


def test_what_a_name_has_itself_counts_once(spark):
    """A host alone under its names gets the corpus' rate as its prior, not its own."""
    hosts = spark.createDataFrame([("a.bad.xyz", 10, 10, 10), ("b.good.org", 90, 90, 0)], "host string, pages long, n long, bad long")
    got = {r.host: r.rep_mean for r in uf.reputations(hosts).collect()}
    # the prior of a.bad.xyz comes from b.good.org alone
    assert got["a.bad.xyz"] == pytest.approx((10 + 8 * (0 + 1) / (90 + 2)) / 18)


@pytest.mark.parametrize("a, b", [(30.0, 8.0), (12.0, 9.0), (3.0, 40.0), (6.5, 1.2), (60.0, 50.0)])
def test_bound_is_a_quantile_of_the_beta_distribution(spark, a, b):
    steps = 20_000
    density = lambda x: x ** (a - 1) * (1 - x) ** (b - 1)
    upto = sum(density((i + 0.5) / steps) for i in range(steps // 2)) / sum(density((i + 0.5) / steps) for i in range(steps))
    for doubt in (0.01, 0.05, 0.2):
        if abs(math.log(max(upto, 1e-9) / doubt)) > 0.2:
            assert spark.range(1).select(uf.passes(F.lit(a / (a + b)), F.lit(a + b), 0.5, doubt).alias("x")).first().x == (upto <= doubt)


@pytest.mark.parametrize("host, domain", [("u:p@h.net:8080", "h.net"), ("h.net.", "h.net"), ("10.0.0.1:80", "10.0.0.1"), ("a.b.com.br", "b.com.br"), ("x.y.github.io", "y.github.io"), ("x.y.co", "y.co")])
def test_names(spark, host, domain):
    assert spark.range(1).select(uf.domain(F.lit(host)).alias("d")).first().d == domain
