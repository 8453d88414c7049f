"""Web rules: decoding, labels, consent gate."""

from codeloom.operators import web


def test_utm_rules(spark):
    pages = spark.createDataFrame([
        (1, "https://x.org/a?utm_source=a%20b", "<a href=\"/cv.pdf\">cv</a>"),
        (2, "https://x.org/a?utm_source=", "<a class=\"k\" href=\"/cv.pdf\">cv</a>"),
        (3, "https://x.org/a?utm_source=s&utm_campaign=c+d", "<a href=\"/x\">x</a>"),
        (4, "https://x.org/a", "<a href=\"/cv.pdf\">1</a><a href=\"/cv.pdf#2\">2</a>"),
    ], "page_id long, url string, html string")
    p = web.utm_params(pages)
    src = {r.page_id: r.utm_source for r in p.collect()}
    assert src == {1: "a b", 2: "", 3: "s", 4: None}
    visits = {r.page_id: r.event_label for r in web.source_visit_events(p).collect()}
    assert visits == {1: "a b", 3: "s | c d"}
    clicks = sorted((r.page_id, r.event_label) for r in web.link_click_events(p, "cv.pdf").collect())
    assert clicks == [(1, "a b"), (2, "direct"), (4, "direct"), (4, "direct")]


def test_consent_gate(spark):
    df = spark.createDataFrame([("accepted", "FR"), ("", "FR"), (None, "US"), (None, None), (None, "SE")],
                               "consent string, country string")
    got = [r.a for r in df.select(web.consent_action("consent", "country").alias("a")).collect()]
    assert got == ["none", "banner", "track", "track", "banner"]


def test_json_field(spark):
    df = spark.createDataFrame([('{"k": 69}',), ('{"j": 1}',), ("not json",)], "p string")
    assert [r.k for r in df.select(web.json_field("p", "k").alias("k")).collect()] == [69, None, None]


def test_utm_extract_matches_python_urllib(spark):
    """V1 against Python's form-urlencoded parser (the browser's URLSearchParams rules)."""
    from urllib.parse import parse_qs, urlsplit

    from codeloom.sources.tables import read_table

    pages = read_table(spark, "/root/testdata/sf0.01", "pages", ["page_id", "url"])
    got = {r.page_id: (r.utm_source, r.utm_campaign)
           for r in web.utm_params(pages).select("page_id", "utm_source", "utm_campaign").collect()}

    def first(q, k):
        v = parse_qs(q, keep_blank_values=True).get(k)
        return v[0] if v else None

    want = {}
    for r in pages.collect():
        q = urlsplit(r.url).query
        want[r.page_id] = (first(q, "utm_source"), first(q, "utm_campaign"))
    assert got == want
    assert any(v[0] for v in got.values())


def test_unclassified_warning(spark, sf_dir):
    import pytest

    from codeloom.operators import reports as rp
    from codeloom.plans.pipelines import PersonPipeline

    p = PersonPipeline(spark, sf_dir)
    per_code = p.code_stats.join(p.code_map.where("keep"), "code_raw")
    with pytest.warns(UserWarning, match="unclassified"):
        n = rp.warn_unclassified(per_code)
    assert n == p.facts.where("code_type = 'other'").count() > 0


def test_query_strings_as_a_browser_reads_them(spark):
    cases = {
        "u?utm_source=a|b": "a|b", "u?utm_source=news&utm_campaign={cid}": "news", "u?utm_source=x&c=50%off": "x", "u?utm_source=50%off": "50%off",
        "u?utm_source=a^b": "a^b", "u?utm_source=%zz": "%zz", "u?utm_source=a b": "a b", "u?q=`x`&utm_source=z": "z", "u?utm_source=x&utm_source=y": "x",
        "u?utm%5Fsource=e": "e", "u?utm_source": "", "u?utm_source&b": "", "u?xutm_source=n": None, "u#?utm_source=n": None, "u?a#utm_source=n": None,
        "u?utm_source=a=b": "a=b", "u?utm_source=c+d%C3%A9": "c dé", "u": None, "": None, "u?": None, "u?utm_source=a%": "a%", "u?a?utm_source=1&utm_source=2": "2",
    }
    df = spark.createDataFrame(list(cases.items()) + [(None, None)], "url string, want string")
    got = df.withColumn("got", web.query_param("url", "utm_source")).collect()
    assert [(r.url, r.got) for r in got] == [(r.url, r.want) for r in got]


def test_link_tags_of_any_form(spark):
    cases = [
        ('<A HREF="x/the">', ["x/the"]), ("<a href='x/the'>", ["x/the"]), ("<a href=x/the>", ["x/the"]), ('<a href = "x/the">', ["x/the"]),
        ('<a data-href="x/the" href="y">', []), ('<a class="c" data-href="q" href="x/the">', ["x/the"]), ('<!-- <a href="x/the"> -->', []),
        ('<a href="the?a&amp;b">', ["the?a&b"]), ("<a title=\'href=\"x/the\"\' href=\"y\">", []), ('<a title="a>b" href="x/the">', ["x/the"]),
        ('<abbr href="x/the">', []), ('<a\nhref="x/the"\n>', ["x/the"]), ('<a href="the1" href="the2">', ["the1"]), ("<a " + 'b="c" ' * 3000 + "href=the>", ["the"]), (None, []), ("", []),
    ]
    df = spark.createDataFrame([(i, h, None) for i, (h, _) in enumerate(cases)], "page_id int, html string, utm_source string")
    got = {}
    for r in web.link_click_events(df, "the").collect():
        got.setdefault(r.page_id, []).append(r.href)
    assert [got.get(i, []) for i in range(len(cases))] == [w for _, w in cases]


def test_json_field_names_are_quoted(spark):
    df = spark.createDataFrame([('{"a.b": 3, "a": {"b": 4}}',)], "p string")
    assert df.select(web.json_field("p", "a.b").alias("k")).first().k == 3
