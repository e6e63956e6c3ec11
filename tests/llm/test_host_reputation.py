"""URL filter: the registered query against its SQL on planted hosts and odd rows."""

import duckdb
import pytest
from pyspark.sql import functions as F

from loadkit.llm import host_reputation as H
from loadkit.llm.queries import QUERIES, URL_RULES
from verification import compare

ODD = [None, "", "no scheme", "http://", "http://EXAMPLE.com/en/x", "HTTP://WWW.Example.COM/en/", "https://example.com", "http://example.com?x=/en/",
       "http://notexample.com/en/1", "http://a.b.example.com/en/2#/fr/", "http://shop.net/fr/3", "http://net/es/4", "http://user:pw@net.net:80/de/5",
       "http://10.0.0.1/en/6", "http://localhost/en/7", "http://x.co.uk/en/8", "http://co.uk/en/9", "http://trailing./en/10", "ftp://://en/11",
       "http://É.example.org/en/12", "http://line\nbreak.org/en/13", "http://y.net/es/" + "z" * 100_000]


@pytest.fixture
def tables(spark, tmp_path):
    """Hosts of one domain mostly bad, of another mostly good, one host far worse than its domain, and odd urls."""
    rows, labels, doc = [], [], 0
    plan = [("a.spam.org", 60, 55), ("b.spam.org", 50, 47), ("c.spam.org", 3, 2), ("good.org", 80, 3), ("fine.good.org", 40, 2), ("odd.good.org", 70, 64),
            ("one.net", 20, 9), ("two.one.net", 1, 1), ("x.co.uk", 30, 28), ("y.co.uk", 30, 0), ("cheap.example.org", 200, 180)]
    for host, n, bad in plan:
        for i in range(n):
            rows.append(f"https://{host}/{'de' if i % 2 else 'en'}/{doc}?q=1")
            labels.append((doc, int(i >= bad), i % 2 if i < bad else 0))
            doc += 1
    rows += [f"https://new.{host}/de/999999" for host, _, _ in plan] + ["https://quite.new.org/de/1", "https://quite.other/de/1"] + ODD
    labels += [(0, 0, None), (1, None, None), (None, 0, 1), (2, None, 1), (999, None, None)]
    pages = spark.createDataFrame([(k if k != 5 else None, u, "name", "x") for k, u in enumerate(rows)], "page_id long, url string, name string, n string")
    pages.unionAll(pages.limit(3)).write.parquet(f"{tmp_path}/pages.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").coalesce(1).write.parquet(f"{tmp_path}/labels.parquet")
    return str(tmp_path)


def connection(folder):
    con = duckdb.connect()
    for name in ("pages", "labels"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet/*.parquet'")
    return con


def test_query_equals_sql_on_planted_hosts(spark, tables):
    query, sql = QUERIES["op11_host_reputation"]
    ok, account = compare.compare(spark, connection(tables), query, sql, tables)
    assert ok, account
    rows = query(spark, tables).collect()
    method = {r.host: r.verdict for r in rows if r.rule is None}
    assert method["a.spam.org"] == method["new.a.spam.org"] == method["odd.good.org"] == method["cheap.example.org"] == "block"
    assert method["good.org"] == method["fine.good.org"] == method["new.good.org"] == method["y.co.uk"] == method[""] == "allow"
    got = {(r.host, r.path, r.rule, r.verdict) for r in rows}
    assert {("example.com", "/en/x", "example.com/en/", "block"), ("www.example.com", "/en/", "www.example.com/en/", "allow"),
            ("a.b.example.com", "/en/2", "example.com/en/", "block"), ("net", "/es/4", "net/es/", "block"),
            ("notexample.com", "/en/1", "com/", "allow"), ("shop.net", "/fr/3", "net/fr/", "block")} <= got


@pytest.mark.parametrize("few", [0, 100_000])
def test_shuffled_lookups_give_the_same(spark, tables, few):
    pages, labels = spark.read.parquet(f"{tables}/pages.parquet"), spark.read.parquet(f"{tables}/labels.parquet")
    document = F.nullif(F.regexp_extract(H.parts(F.col("url"))["path"], "^/[a-z]+/([0-9]+)", 1), F.lit("")).try_cast("long")
    settings = H.Settings(few=few)
    known = H.fit(H.outcomes(pages, labels, document, settings), settings)
    assert sum(r.verdict == "block" for r in H.judge(pages, known, URL_RULES, carry=("page_id", "name")).collect()) == sum(
        r.verdict == "block" for r in QUERIES["op11_host_reputation"][0](spark, tables).collect())


def test_no_labels_and_no_pages(spark, tables):
    pages, labels = spark.read.parquet(f"{tables}/pages.parquet"), spark.read.parquet(f"{tables}/labels.parquet")
    none = H.fit(H.outcomes(pages, labels.where("false"), F.col("page_id")))
    assert {r.verdict for r in H.judge(pages, none).collect()} == {"allow"}
    known = H.fit(H.outcomes(pages, labels, F.col("page_id")))
    assert H.judge(pages.where("false"), known, URL_RULES).collect() == []


def test_strength_follows_the_scatter(spark):
    """Hosts that all share one rate are pulled together; hosts that scatter are left alone."""
    def strength(rates):
        counts = spark.createDataFrame([(f"h{i}.d{i % 3}.org", 200, int(200 * r)) for i, r in enumerate(rates)], "name string, n long, x long")
        return H.fit(counts).strength
    assert strength([0.2] * 12) == 1000 and strength([0.02, 0.9] * 6) < 10
