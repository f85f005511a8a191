from __future__ import annotations

import duckdb
import pytest

from concord.llm import url_trie as u


def brute(url, rules):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        end = min((rest.index(c) for c in "/?#" if c in rest), default=len(rest))
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:end])
        rest = rest[end:]
        path = rest[: min((rest.index(c) for c in "?#" if c in rest), default=len(rest))]
    fits = [(len(h.split(".")), len(p), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=None)
    return host, path, best and best[2], best[3] if best else "allow"


RULES = [*u.RULES, ("example.net", "/en/bad", "block"), ("a.b.c", "", "block"), ("b.c", "/x", "allow"), ("b.c", "/x/y", "block"), ("b.c", "/x/y/", "allow")]
URLS = [
    None, "", "no scheme", "http://", "http://NET", "http://net/", "http://net?x", "https://x.example.net/en/1", "https://x.example.net/en", "https://example.net/en/badly", "http://notexample.net/en/",
    "http://example.com/de/?a", "http://m.example.com/de#x", "https://example.org/fr/2", "org://org/fr/", "http://a.b.c", "http://z.a.b.c/x", "http://b.c/x", "http://b.c/xx", "http://b.c/x/y", "http://b.c/x/yz", "http://b.c/x/y/z",
    "http://Ünï.net/\nq", "http://u:p@host.net:80/p", "http://a://b.net/", "http://.net/", "http://net./", "://net/",
]


def test_against_brute_force(spark):
    rows = [(k, url, "x", "y") for k, url in enumerate(URLS)] + [(None, "http://net/", "x", "y")] * 2
    pages = spark.createDataFrame(rows, "page_id long, url string, host string, rule string")
    found = u.judge_urls(pages, RULES).collect()
    assert len(found) == len(rows)
    for r in found:
        assert tuple(r)[1:] == brute("http://net/" if r["page_id"] is None else URLS[r["page_id"]], RULES)


def test_pages_match_sql(spark, sf_dir):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{sf_dir}/pages.parquet'")
    found = sorted(map(tuple, u.op7_url_trie(spark, sf_dir).collect()))
    assert found == sorted(con.execute(f"SELECT page_id, host, path, rule, verdict FROM ({u.ORACLE})").fetchall())


def test_bounds_and_contradictions(spark):
    with pytest.raises(ValueError, match="two verdicts"):
        u.UrlTrie([("a", "/", "block"), ("a", "/", "allow")])
    with pytest.raises(ValueError, match="more than 1"):
        u.UrlTrie([("a", "/", "block"), ("b", "/", "block")], most_rules=1)
    empty = spark.createDataFrame([], "page_id long, url string")
    assert u.judge_urls(empty, u.RULES).collect() == []
    assert u.UrlTrie([]).judge("a.b", "/") is None


def test_very_long_urls(spark):
    """A host of many labels and a path of many segments, at the rule's depth and below."""
    urls = ["https://" + "a." * 20_000 + "net/" + "x/" * 20_000, "https://" + "a." * 20_000 + "example.net/en/" + "x/" * 20_000, "https://net/" + "x" * 300_000]
    rows = u.judge_urls(spark.createDataFrame(list(enumerate(urls)), "page_id long, url string"), u.RULES).orderBy("page_id").collect()
    assert [(r["rule"], r["verdict"]) for r in rows] == [("net/", "block"), ("example.net/en/", "allow"), ("net/", "block")]


def test_lists_as_a_table(spark):
    """The same verdicts from joins, also with very many entries, one host of which has most of them."""
    rows = [(k, url, "x") for k, url in enumerate(URLS)] + [(None, "http://net/", "x")] * 2
    pages = spark.createDataFrame(rows, "page_id long, url string, rule string")
    listed = spark.createDataFrame(RULES, "host string, path string, verdict string")
    wanted = sorted(map(tuple, u.judge_urls(pages, RULES).collect()), key=repr)
    assert sorted(map(tuple, u.judge_by_table(pages, listed).collect()), key=repr) == wanted
    many = spark.range(300_000).selectExpr("if(id % 3 = 0, concat('h', id, '.net'), 'hot.org') AS host", "concat('/p', id, '/') AS path", "if(id % 2 = 0, 'allow', 'block') AS verdict")
    asked = spark.createDataFrame([(1, "http://a.hot.org/p7/x"), (2, "http://h3.net/p3/"), (3, "http://h3.net/p4/"), (4, "http://hot.org/p")], "page_id long, url string")
    found = sorted((r["page_id"], r["rule"], r["verdict"]) for r in u.judge_by_table(asked, many.union(listed), "block").collect())
    assert found == [(1, "hot.org/p7/", "block"), (2, "h3.net/p3/", "block"), (3, "net/", "block"), (4, None, "block")]
    assert u.judge_by_table(pages.limit(0), listed).count() == 0 and u.judge_by_table(pages, listed.limit(0)).where("rule IS NULL").count() == len(rows)
    with pytest.raises(Exception, match="two verdicts"):
        u.judge_by_table(pages, listed.union(spark.createDataFrame([("net", "/", "allow")], listed.schema))).collect()
