"""URL rules against plain Python, and mined rules against all token sets."""

from llm_tables import SF01  # noqa: F401
from itertools import combinations

import duckdb
import __spark_entry__ as E
from pyspark.sql import functions as F

from sluice.llm import url_rules as U
from sluice.llm.common import prepare


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    end = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    host, rest = rest[:end], rest[end:]
    cut = min([rest.find(c) for c in "?#" if c in rest] or [len(rest)])
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), rest[:cut]


def rule(host, path):
    fits = [(len(h + p), h + p, v) for v, h, p in U.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits)[1:] if fits else (None, None)


URLS = [None, "", "no scheme", "http://", "http://A.Example.COM", "http://example.com/en/x", "https://www.example.com/en/x?q=/es/",
        "ftp://a.b.net/es/1#/fr/", "http://net/fr/", "http://internet/fr/", "http://x.com/", "http://x.com?en/", "a://b://c/d",
        "http://ÄB.net/es/", "http://user@h.com:80/p", "http://x.net/es", "http://www.example.com/en", "://com/en/", "http://a\n.com/\nb"]


def test_fixed_rules(spark):
    prepare(spark)
    pages = spark.createDataFrame([(i, u, "clash") for i, u in enumerate(URLS)], "page_id long, url string, host string")
    none = spark.createDataFrame([], "url string, blocked boolean")
    for r in U.judge(pages, none).collect():
        host, path = parts(URLS[r["page_id"]])
        name, verdict = rule(host, path)
        assert (r["host"], r["path"], r["rule"], r["verdict"]) == (host, path, name, verdict or "allow"), URLS[r["page_id"]]


def test_given_pages(spark):
    got = {r["page_id"]: r for r in E.queries()["op4_association_url_rules"](spark, SF01).collect()}
    rows = duckdb.sql(f"SELECT page_id, url FROM '{SF01}/pages.parquet'").fetchall()
    assert len(got) == len(rows)
    for i, url in rows:
        host, path = parts(url)
        name, verdict = rule(host, path)
        assert (got[i]["host"], got[i]["path"], got[i]["rule"]) == (host, path, name)
        assert verdict is None or got[i]["verdict"] == verdict


def labelled(spark):
    """Casino hosts and /ads/ under .org are bad, most others good."""
    rows = []
    for i in range(600):
        host = ["casino", "news", "blog", "shop"][i % 4]
        top, folder = ["org", "info"][i // 4 % 2], ["ads", "read"][i // 8 % 2]
        bad = host == "casino" or (top == "org" and folder == "ads" and i % 50 != 1)
        rows.append((f"http://{host}.site.{top}/{folder}/{i}?id={i}", bad))
    return spark.createDataFrame(rows, "url string, blocked boolean"), rows


def test_mined_rules_equal_all_token_sets(spark):
    prepare(spark)
    df, rows = labelled(spark)
    rules = {tuple(r["tokens"]): (round(r["confidence"], 9), r["count"]) for r in
             U.mine(df, min_support=0.05, min_confidence=0.8).collect()}
    tokens = {r["url"]: frozenset(r["t"]) for r in df.select("url", U.tokens_of(F.col("url")).alias("t")).collect()}
    bags = [(tokens[u], b) for u, b in rows]
    want, every = {}, sorted(set().union(*tokens.values()))
    for n in range(1, len(every) + 1):
        for s in combinations(every, n):
            has = [b for t, b in bags if t.issuperset(s)]
            if sum(has) >= 30 and sum(has) / len(has) >= 0.8:
                want[s] = (round(sum(has) / len(has), 9), sum(has))
    assert rules == want and want


def test_matching(spark):
    prepare(spark)
    df, rows = labelled(spark)
    pages = spark.createDataFrame([(1, "http://casino.x.org/read/1"), (2, "http://news.site.org/ads/9?id=1"),
                                   (3, "http://news.site.info/read/7?id=2"), (4, "http://casino.b.com/read/"), (5, None),
                                   (1, "http://casino.x.org/read/1")], "page_id long, url string")
    got = U.judge(pages, df, min_support=0.05).collect()
    assert sorted((r["page_id"], r["verdict"]) for r in got) == [
        (1, "block"), (1, "block"), (2, "block"), (3, "allow"), (4, "allow"), (5, "allow")]
    assert U.judge(pages.filter("false"), df).collect() == []
    assert U.mine(spark.createDataFrame([(None, True), ("http://a.b", None)], "url string, blocked boolean")).count() == 0
