import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyrisk.llm import url_filter as U
from tallyrisk.llm.queries import ORACLE, QUERIES, RULES


def test_hosts_paths_and_rules(spark):
    cases = [("http://A.Example.NET/en/x?q#f", "a.example.net", "/en/x", "example.net/en/", "allow"),
             ("https://example.net", "example.net", "", None, "allow"), ("x://net/", "net", "/", "net/", "block"),
             ("http://a.net/b", "a.net", "/b", "net/", "block"), ("ftp://ÄB.org/fr/", "Äb.org", "/fr/", "org/fr/", "allow"),
             ("http://example.com/de/1", "example.com", "/de/1", "example.com/de/", "block"),
             ("http://myexample.com/de/1", "myexample.com", "/de/1", None, "allow"), ("no url", "", "", None, "allow"),
             ("", "", "", None, "allow"), (None, "", "", None, "allow"), ("http://bad.com?x://y", "bad.com", "", None, "block"),
             ("http://bad.com?x://y", "bad.com", "", None, "block")]
    df = spark.createDataFrame([(i, c[0], "clash") for i, c in enumerate(cases)], "page_id long, url string, host string")
    listed = spark.createDataFrame([("bad.com",), ("unseen.com",)], "key string")
    got = {r.page_id: (r.url, r.host, r.path, r.rule, r.verdict) for r in U.filter_urls(df, RULES, listed).collect()}
    assert got == dict(enumerate(cases))


@pytest.mark.parametrize("limit", [U.MAX_FILTER_BYTES, 200])
def test_cascade_is_exact_over_the_universe_also_in_shards(spark, limit):
    df = spark.range(3000).select(F.concat(F.lit("h"), F.col("id")).alias("key"), "id").union(
        spark.createDataFrame([(None, -1)], "key string, id long"))
    listed = df.filter("id % 7 = 0").select("key")
    got = U.judge(df, listed, F.col("key"), limit).select("id", "is_listed").collect()
    assert len(got) == 3001 and all(r.is_listed == (r.id % 7 == 0 and r.id >= 0) for r in got)


def test_empty_table_and_empty_list(spark):
    df = spark.createDataFrame([(1, "http://a.b/")], "page_id long, url string")
    none = spark.createDataFrame([], "key string")
    assert U.filter_urls(df.limit(0), RULES, none).count() == 0
    assert U.filter_urls(df, RULES, none).first().verdict == "allow"


def test_levels_shrink():
    rng = np.random.default_rng(0)
    h = rng.integers(-2**63, 2**63 - 1, size=(2, 4000))
    at = U._positions(h[0], h[1], 0, 640)
    assert at.shape == (4000, U.HASHES) and (np.bincount(at.ravel().astype(int), minlength=640) > 0).all()


def test_query_matches_sql(spark, brute):
    from tests.oracle_check import compare
    d = "/root/testdata/sf0.001"
    assert compare(QUERIES["op1_url_filter"](spark, d).toPandas(), brute(d).execute(ORACLE["op1_url_filter"]).df()) == (True, "ok")
