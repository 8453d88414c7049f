import random

import duckdb
import pandas as pd

from codeloom.llm import registry, url_filter as uf

SCHEMA = "page_id long, url string, html string, verdict string, component string"


def judged(spark, rows):
    pages = spark.createDataFrame([(*r, "clash", "clash") for r in rows], SCHEMA)
    got = uf.verdicts(pages, uf.RULES).toPandas()
    con = duckdb.connect()
    frame = pd.DataFrame(rows, columns=["page_id", "url", "html"]).astype({"page_id": "Int64"})
    con.register("pages", frame)
    want = con.execute(registry.ORACLE["op10_url_filter"]).df()
    as_rows = lambda d: sorted(repr([None if pd.isna(v) else str(v) for v in r]) for r in d[sorted(d.columns)].astype({"page_id": "Int64"}).astype(object).itertuples(index=False))
    assert as_rows(got) == as_rows(want)
    return {r.page_id: r.verdict for r in got.itertuples()}


def canonical(url):
    return f'<html><head><LINK href="{url}" rel="Canonical"></head>'


def refresh(url):
    return f"<meta http-equiv='refresh' content='0; URL={url}'>"


def test_rules_and_aliases(spark):
    rows = [
        (1, "http://example.com/en/1", ""), (2, "https://WWW.Example.com/en/1?q#f", ""), (3, "http://a.net/es/x", None), (4, "http://a.net/de/x", None), (5, "no scheme", ""), (6, None, "x"),
        (7, "http://example.com", ""), (8, "http://notexample.org/en/", ""),
        (10, "http://m.org/1", canonical("http://x.net/fr/9")), (11, "http://m.org/2", refresh("/1#top")), (12, "http://m.org/3", canonical("1")),       # blocked through /1
        (13, "http://m.org/4", canonical("http://example.com/en/5")), (14, "http://m.org/5", canonical("http://example.com/en/5") + refresh("http://other.com/fine")),   # an allow rule in the component
        (15, "http://m.org/6", f"<!-- {canonical('http://x.net/fr/1')} -->"), (16, "http://m.org/7", canonical("javascript:x()")), (17, "http://m.org/8", '<link rel=stylesheet href=http://x.net/fr/1>'),
        (18, "ftp://m.org/9", '<link rel=canonical href=//x.net/fr/1?a=1&amp;b=2>'), (19, "http://m.org/9#x", ""), (20, "http://m.org/?p", canonical("?p=2")), (21, "http://m.org/?p=2", canonical("http://x.net/es/")),
        (22, "http://m.org/10", canonical("#top")), (None, "http://m.org/1", ""), (10, "http://m.org/1", ""), (23, "://", ""), (24, "x", canonical("/y")),
    ]
    got = judged(spark, rows)
    assert [got[i] for i in (1, 2, 3, 4, 7, 8)] == ["block", "allow", "block", "allow", "allow", "allow"]
    assert [got[i] for i in (10, 11, 12, 13, 14)] == ["block", "block", "block", "allow", "allow"]
    assert [got[i] for i in (15, 16, 17, 18, 19, 20, 21)] == ["allow", "allow", "allow", "block", "block", "block", "block"]


def test_random_links_against_sql(spark):
    rng = random.Random(3)
    url = lambda: rng.choice(["http://", "https://"]) + rng.choice(["a.org", "B.org", "www.example.com", "example.com", "c.net"]) + rng.choice(["/", "/en/", "/es/", "/x/", ""]) + str(rng.randrange(9))
    rows = [(i, url(), rng.choice([None, "", canonical(url()), refresh(url()), canonical("/es/1"), canonical(str(rng.randrange(9)))])) for i in range(120)]
    judged(spark, rows)
    assert uf.verdicts(spark.createDataFrame([], SCHEMA), uf.RULES).count() == 0
