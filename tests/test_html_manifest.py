from urllib.parse import urljoin

from pyspark.sql import functions as F

from tarmac.functions.html import anchors, decode_entities, resolve_url
from tarmac.operators import manifest


def test_anchor_text_and_href(spark):
    html = ('<p><!-- <a href="/hidden">no</a> --><script>var s="<a href=/x>no</a>";</script>'
            '<a href="/a">Full <b>Analysis</b>\n 201104 </a>'
            "<a class='c' href='/b?x=1&amp;y=2'>  caf&eacute; &amp; caf&#233; &#xE9;t&nbsp;</a>"
            '<a>no href</a><a href="/empty">  </a><a href>bare</a><A HREF=/up>Upper</A>'
            '<abbr>not an anchor</abbr></p>')
    got = _read(spark, html)
    assert got == [("Full Analysis 201104", "/a"), ("café & café ét", "/b?x=1&y=2"), ("no href", None),
                   ("", "/empty"), ("bare", ""), ("Upper", "/up")]


def _read(spark, html):
    df = spark.createDataFrame([(html,)], "html string").select(
        F.posexplode(anchors("html")).alias("pos", "a")).orderBy("pos")
    return [(r.a.title, r.a.href) for r in df.collect()]


def test_anchors_of_ordinary_pages(spark):
    assert _read(spark, '<a title="a>b" href="/q">x</a>') == [("x", "/q")]
    assert _read(spark, '<a title="see href=foo">x</a>') == [("x", None)]
    assert _read(spark, "<a title='see href=foo' href=bar/>x</a>") == [("x", "bar/")]
    assert _read(spark, "<a href=/1>one<a href=/2>two</a> out") == [("one", "/1"), ("two", "/2")]
    assert _read(spark, "<li><a href=/1>one</li><li>no</li>") == [("one", "/1")]
    assert _read(spark, "<a href=/1>to the end") == [("to the end", "/1")]
    assert _read(spark, "<a href='/1' data-x='<a href=/2>'>one</a>") == [("one", "/1")]
    assert _read(spark, "<A\nHREF = \"/1\"><i title='>'>one</i></A>") == [("one", "/1")]
    assert _read(spark, "no anchors < a > <area href=/x>") == []
    assert _read(spark, "<script>never ends <a href=/1>one</a>") == []
    assert _read(spark, "") == [] and _read(spark, "<a" + " x='y'" * 20_000 + " href=/z>t</a>") == [("t", "/z")]


def test_no_reference_is_an_error(spark):
    texts = {"&#9999999; &#xFFFFFF;": "\ufffd \ufffd", "&#00000233;": "é", "&#233 &#xE9;": "é é",
             "&eacute;&Eacute;": "éÉ", "&copy 2 &amp": "© 2 &", "&nosuch; &nosuch &;": "&nosuch; &nosuch &;",
             "&#55296; &#0;": "\ufffd \ufffd", "&#128;": "€", "&#;&#x;": "&#;&#x;", "&#" + "9" * 300 + ";": "\ufffd",
             "&ngE;": "≧̸"}
    df = spark.createDataFrame(list(texts.items()), "s string, want string")
    for r in df.select("want", decode_entities("s").alias("got")).collect():
        assert r.got == r.want


def test_decode_entities(spark):
    df = spark.createDataFrame([("a &lt;b&gt; &#65;&#x42; &amp;lt; plain",)], "s string")
    assert df.select(decode_entities("s")).first()[0] == "a <b> AB &lt; plain"


def test_resolve_url_matches_urljoin(spark):
    bases = ["http://ex.com/fr/825?page=2&ref=x", "https://a.org/b/c/d.html#top", "http://h"]
    hrefs = ["/The", "rel/x.csv", "../up.csv", "./same", "//cdn.net/z", "?q=1", "#frag", "",
             "https://other.org/p", "/a/./b/../c", "a/..", "../../../../x"]
    pairs = [(b, h) for b in bases for h in hrefs]
    df = spark.createDataFrame(pairs, "b string, h string")
    got = [r[0] for r in df.select(resolve_url("b", "h")).collect()]
    assert got == [urljoin(b, h) for b, h in pairs]


def test_title_filter(spark):
    df = spark.createDataFrame([("201104 FullAnalysis (CSV document)",),
                                ("201104 ArrDep FullAnalysis",),
                                ("Arrival  Departure Full Analysis 201104",),
                                ("full   analysis",), ("Summary",)], "title string")
    kept = [r.title for r in manifest.filter_titles(df).collect()]
    assert kept == ["201104 FullAnalysis (CSV document)", "full   analysis"]


def test_manifest_dedupe_and_pending(spark):
    pages = spark.createDataFrame([
        (2, 2011, "https://s.org/2011/", '<a href="/f/2.csv">201104 FullAnalysis (CSV document)</a>'),
        (1, 2011, "https://s.org/2011/", '<a href="/f/1.csv">201104 FullAnalysis (CSV document)</a>'
                                         '<a href="x.csv">201105 Full Analysis</a>'),
        (3, 2010, "https://s.org/2010/", '<a href="/f/3.csv">201104 FullAnalysis (CSV document)</a>'),
    ], "page_id long, year int, url string, html string")
    m = manifest.build_manifest(pages, 2026)
    rows = {r.filename: r for r in m.collect()}
    assert set(rows) == {"201104_full_analysis.csv", "201105_full_analysis.csv"}
    assert rows["201104_full_analysis.csv"].url == "https://s.org/f/3.csv"   # earliest year wins
    assert rows["201105_full_analysis.csv"].url == "https://s.org/2011/x.csv"
    existing = spark.createDataFrame([("raw/2011/201104_full_analysis.csv",)], "path string")
    pending = [r.filename for r in manifest.pending_files(m, existing, "raw").collect()]
    assert pending == ["201105_full_analysis.csv"]
    assert manifest.pending_files(m, existing, "raw", overwrite=True).count() == 2
    summary = {r.metric: r.value for r in manifest.manifest_summary(pages, 2026, existing, "raw").collect()}
    assert summary == {"pages_scanned": 3, "links_matched": 2, "files_skipped": 1, "files_pending": 1}
    failed = spark.createDataFrame([("raw/2011/201104_full_analysis.csv",),
                                    ("raw/2011/201105_full_analysis.csv",)], "path string")
    summary = {r.metric: r.value for r in
               manifest.manifest_summary(pages, 2026, existing, "raw", failed=failed).collect()}
    assert summary == {"pages_scanned": 3, "links_matched": 2, "files_skipped": 1, "files_failed": 1}
    none = manifest.manifest_summary(pages.limit(0), 2026, existing, "raw")
    assert {r.metric: r.value for r in none.collect()} == {"pages_scanned": 0, "links_matched": 0}
    assert [r.year for r in manifest.manifest_years(m).collect()] == ["2011"]
    loaded = spark.createDataFrame([(2011,)], "year int")
    assert manifest.pending_years(m, loaded).count() == 0
