from pyspark.sql import functions as F

from tasteloom.llm import urlfilter as u
from tasteloom.llm.queries import URL_RULES

SCHEMA = "page_id long, url string, html string, rule string, key string"


def judged(spark, urls, rules=URL_RULES):
    df = spark.createDataFrame([(i, url, "x", "clash", "clash") for i, url in enumerate(urls)], SCHEMA)
    rows = u.judge_urls(df, rules).select("page_id", "host", "path", "rule", "verdict").collect()
    return {r["page_id"]: tuple(r)[1:] for r in rows}


def test_longest_rule_wins_and_others_are_allowed(spark):
    urls = [
        "http://a.com/x", "https://EXAMPLE.com/en/1?q", "http://www.example.com/en/", "http://b.www.example.com/en/#f",
        "http://x.net/es/", "http://xnet/es/", "http://net/fr/2", "http://example.com", "http://notexample.com/en/",
        None, "", "no scheme", "://", "http://a.com/b://c.net/es/", "http://a.org/" + "y" * 100_000, "x\ny://q.net/fr/a\nb?c",
    ]
    got = judged(spark, urls)
    assert got[0] == ("a.com", "/x", "com/", "allow")
    assert got[1] == ("example.com", "/en/1", "example.com/en/", "block")
    assert got[2][2:] == got[3][2:] == ("www.example.com/en/", "allow")
    assert got[4][2:] == ("net/es/", "block") and got[5][2:] == (None, "allow") and got[6][2:] == ("net/fr/", "block")
    assert got[7] == ("example.com", "", None, "allow") and got[8][2:] == ("com/", "allow")
    assert got[9] == got[10] == got[11] == got[12] == ("", "", None, "allow")
    assert got[13][:2] == ("a.com", "/b://c.net/es/") and len(got[14][1]) == 100_001
    assert got[15] == ("q.net", "/fr/a\nb", "net/fr/", "block")


def test_cascade_is_exact_over_its_universe(spark):
    universe = spark.range(5000).select(F.col("id").cast("string").alias("key"))
    listed = universe.where("key % 97 = 5")
    levels = u.build_cascade(universe, listed)
    told = universe.where(u.listed_in(F.col("key"), levels))
    assert len(levels) > 1 and {r[0] for r in told.collect()} == {r[0] for r in listed.collect()}
    assert sum(level.bits for level in levels) < 64 * listed.count()


def test_no_rules_and_no_pages(spark):
    assert judged(spark, ["http://a.com/"], [])[0] == ("a.com", "/", None, "allow")
    assert judged(spark, []) == {}
