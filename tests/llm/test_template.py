import time
from collections import Counter, defaultdict

from tarmac.llm.template import _ROOT, SUPPORT, Page, _template, host_of, main_texts, templates

HEAD = "<html><head><title>T</title><script>var a='<p>no</p>'</script></head><body>"


def page(i, body, extra=""):
    return (i, f"https://h.example.org/{i}", f"{HEAD}<nav><ul><li><a href='/'>Home</a></li></ul></nav>"
            f"<div class='ad'>Buy {i}</div><div id='c{i}'><h1>Title {i}</h1>{body}"
            f"<div class='x'>Read our other pages</div></div>"
            f"<div class='comments'><p>nice {i}</p></div>{extra}<footer>&copy; {i}</footer></body></html>")


def test_template_of_a_host_without_article_elements(spark):
    pages = [page(i, f"<p>First  of <b>page</b> {i}.</p><p>Second &amp; last {i} {'word ' * 30}") for i in range(8)]
    got = {r.page_id: r.text for r in main_texts(
        spark.createDataFrame(pages, "page_id long, url string, html string").repartition(3)).collect()}
    for i in range(8):
        # "Read our other pages" is a constant of the template
        assert got[i] == f"Title {i}\nFirst of page {i}.\nSecond & last {i} {'word ' * 30}".strip()


def test_repeated_article_text_is_no_template(spark):
    """A third of a host's pages with one text keep it."""
    pages = [page(i, f"<p>{'copied text ' * 20 if i < 4 else f'own text {i} ' * 20}</p>") for i in range(12)]
    got = {r.page_id: r.text for r in main_texts(
        spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}
    assert all("copied text" in got[i] for i in range(4)) and "own text 9" in got[9]


def test_host_of_copies_keeps_its_text(spark):
    pages = [page(i, f"<p>{'copied text ' * 20}</p>") for i in range(10)]
    got = {r.page_id: r.text for r in main_texts(
        spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}
    assert all("copied text" in got[i] for i in range(10))


def test_lone_and_odd_pages(spark):
    rows = [
        (1, "http://a/", "<article><h1>A</h1><p><b>one<br>two<p>three<aside>no</aside></article><p>out"),
        (2, None, None), (3, "http://b/", ""), (4, "not a url", "plain  text &lt; &am"),
        (4, "not a url", "plain  text &lt; &am"),
        (5, "http://c/", "<script>x"), (6, "http://c/", "<p title='a>b'>q</p> <!-- <p>no</p> --> <p>r &eacute; &#233;"),
        (7, "http://d/", "<article>" + "<p>deep</p>" * 3000), (8, "http://e/", "<p \"unclosed>x</p> y"),
    ]
    got = {r.page_id: r.text for r in main_texts(
        spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got[1] == "A\none two\nthree" and got[2] == "" and got[3] == "" and got[4] == "plain text < &am"
    assert got[5] == "" and got[6] == "q\nr é é" and got[7] == "\n".join(["deep"] * 3000)
    assert "y" in got[8]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert main_texts(df).count() == len(rows) and main_texts(df.filter("false")).count() == 0


def test_vectors_are_classes(spark):
    df = spark.createDataFrame([(1, page(i, "<p>x</p>" * (i % 3))[2], "h") for i in range(9)],
                               "key long, html string, host string").selectExpr("host", "key + hash(html) AS key", "html")
    row = templates(df).first()
    assert row.host == "h" and row.main is not None


def test_unlinked_elements_are_in_no_class():
    classes = [{"most": 1, "even": True, "tokens": [{"token": 5, "parent": 4, "is_text": False, "chars": 100}]}]
    assert _template(100, classes) == (None, [])


def test_hosts(spark):
    df = spark.createDataFrame([("https://u@H.Org:80/x",), ("http://b?q",), (None,), ("x",)], "u string")
    assert [r[0] for r in df.select(host_of(df.u)).collect()] == ["h.org:80", "b", "", ""]


def test_blocks_name_their_place():
    p = Page("<div><p>a <i>b</i><p>c</div>d")
    assert [b.text for b in p.blocks] == ["a b", "c", "d"]
    assert p.blocks[0].chain == p.blocks[1].chain and len(p.blocks[2].chain) == 0


def texts_of(spark, sources):
    rows = [(i, f"https://h.example.org/{i}", source) for i, source in enumerate(sources)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    return [r.text for r in sorted(main_texts(df).collect(), key=lambda r: r.page_id)]


def article(i, tag="article"):
    return (f"<body><nav><a href='/'>Home</a></nav><{tag} class=c><h1>Title {i}</h1><p class=lead>Lead of {i}.</p>"
            f"<div class=body><p>Body {i} {'word ' * 60}</p></div><section class=one><p>First section {i}.</p></section>"
            f"<section class=two><p>Second section {i} {'text ' * 30}</p></section></{tag}><footer>f</footer></body>")


def test_hosts_of_four_and_five_pages_keep_the_whole_article(spark):
    four, five = (texts_of(spark, [article(i) for i in range(n)]) for n in (4, 5))
    assert four == five[:4]
    for i, text in enumerate(five):
        assert text.split("\n") == [f"Title {i}", f"Lead of {i}.", f"Body {i} {'word ' * 60}".strip(),
                                    f"First section {i}.", f"Second section {i} {'text ' * 30}".strip()]
    # without an article element the slot is around all of these
    assert texts_of(spark, [article(i, "div") for i in range(5)]) == five


def test_article_of_one_paragraph_keeps_its_heading(spark):
    got = texts_of(spark, [f"<body><article><h1>Title {i}</h1><p>{f'own {i} ' * 20}</p></article></body>"
                           for i in range(6)])
    assert [t.split("\n")[0] for t in got] == [f"Title {i}" for i in range(6)]


def test_layout_classes_are_no_menus():
    def kept(source):
        return Page(source).main_text(None, frozenset())

    for names in ("content with-sidebar", "page no-sidebar", "layout has-sidebar", "post no-comments",
                  "search-results", "elementor-widget elementor-widget-text-editor"):
        # the text beside it is longer: only the name speaks
        assert kept(f"<h1>T</h1><div class='{names}'><p>own</p></div><p>{'other ' * 9}</p>")[1] == "own", names
    for names in ("ad", "ad-slot", "site-footer", "main-nav", "comments", "comment-list", "cookie-banner",
                  "left-sidebar", "search-form", "widget widget_recent", "related-posts", "x menu"):
        assert kept(f"<h1>T</h1><div class='{names}'><p>no</p></div><p>own text</p>") == ["T", "own text"], names


def test_wrapper_of_the_article_is_kept_whatever_its_name():
    def kept(source):
        return Page(source).main_text(None, frozenset())

    long = "reply " * 50
    comments = f"<div class=comments><article class=comment><p>{long}</p></article></div>"
    wrapped = "<div class='wrap sidebar-open'><article><h1>T</h1><p>own text</p></article>"
    assert kept(f"{wrapped}{comments}</div>") == ["T", "own text"]
    assert kept(f"{wrapped}</div>{comments}") == ["T", "own text"]
    assert kept("<div class=modal-open><h1>T</h1><p>own text</p></div><div class=share>x</div>") == ["T", "own text"]
    # long comments beside an article of another place stay out
    assert kept(f"<div><h1>T</h1><p>own text</p></div><div class=comments><p>{long}</p></div>") == ["T", "own text"]


def test_host_with_a_layout_class_keeps_its_pages(spark):
    got = texts_of(spark, [f"<body class=x><div class='layout has-sidebar'><article><h1>Title {i}</h1><p>own {i}</p>"
                           "</article></div></body>" for i in range(6)])
    assert got == [f"Title {i}\nown {i}" for i in range(6)]


def test_text_shared_by_all_articles_of_a_host_stays(spark):
    shared = "shared passage " * 20
    for tag in ("article", "div"):
        got = texts_of(spark, [
            f"<body><div class=top><p>Welcome here</p></div><{tag} id=c><h1>Common heading</h1><p class=lead>{shared}</p>"
            f"<p>{f'own {i} ' * 60}</p><p class=end>The end.</p><p class=go><a href='/'>Go on</a></p>"
            f"<div class=x>Read our other pages</div></{tag}></body>" for i in range(8)])
        for i, text in enumerate(got):
            assert text.split("\n") == ["Common heading", shared.strip(), f"own {i} " * 59 + f"own {i}", "The end."]


def plain(i):
    """A page without an article element and without names that say anything."""
    return (f"<html><body><div class=r1><span>Daily Paper</span><div><a href=/a>World</a><a href=/b>Sport</a></div></div>"
            f"<div class=r2><div class=q1><h2>Title {i}</h2><p>{f'First of {i} ' * 20}</p><p>Same closing words.</p>"
            f"<p>{f'Last of {i} ' * 15}</p></div><div class=q2>All stories of this week</div></div>"
            f"<div class=r3>Printed in town</div></body></html>")


def test_hosts_without_marks_are_read_by_their_template(spark):
    want = [[f"Title {i}", f"First of {i} " * 19 + f"First of {i}", "Same closing words.",
             f"Last of {i} " * 14 + f"Last of {i}"] for i in range(7)]
    for n in (2, 4, 5, 7):
        got = texts_of(spark, [plain(i) for i in range(n)])
        assert [t.split("\n") for t in got] == want[:n], n
    # one page alone has no template: nothing tells its frame from its text
    assert "Daily Paper" in texts_of(spark, [plain(0)])[0]


def brute_classes(sources):
    """Classes by whole occurrence vectors, one number a page."""
    found, facts = defaultdict(lambda: [0] * len(sources)), {}
    chars = Counter()
    for k, source in enumerate(sources):
        page = Page(source)
        found[_ROOT][k] = 1
        facts[_ROOT] = (0, False, 0)
        chars[_ROOT] += sum(len(b.text) for b in page.blocks if not b.never and not b.linked)
        for token, parent, is_text, n, size, role in page.tokens():
            found[token][k] += n
            facts[token] = (parent, is_text, role)
            chars[token] += size
    out = defaultdict(set)
    for token, vector in found.items():
        if sum(v > 0 for v in vector) >= SUPPORT * len(sources):
            out[tuple(vector)].add(token)
    return out, chars[_ROOT], {t: {"token": t, "parent": p, "is_text": x, "chars": chars[t], "role": r}
                               for t, (p, x, r) in facts.items()}


def as_classes(classes, facts):
    return [{"most": max(v), "even": min(v) == max(v) and any(not facts[t]["is_text"] for t in ts),
             "tokens": [facts[t] for t in sorted(ts)]} for v, ts in classes.items()]


def test_templates_against_brute_force(spark):
    hosts = {"plain": [plain(i) for i in range(6)], "article": [article(i) for i in range(5)],
             "varied": [plain(i).replace("<p>Same", "<p>x</p><p>Same" if i % 2 else "<p>Same") for i in range(8)],
             "named": [page(i, f"<p>{'own ' * 30}{i}</p>", "<p>more</p>" * (i % 3))[2] for i in range(9)],
             "two": [article(0), article(1)], "one": [plain(3)]}
    rows = [(h, 100 * k + i, s) for k, (h, sources) in enumerate(hosts.items()) for i, s in enumerate(sources)]
    got = {r.host: (r.main, sorted(r.constants)) for r in templates(
        spark.createDataFrame(rows, "host string, key long, html string").repartition(3)).collect()}
    assert set(got) == set(hosts) - {"one"}
    for host, sources in hosts.items():
        classes, total, facts = brute_classes(sources)
        want = _template(total, as_classes(classes, facts))
        if host in got:
            assert got[host] == (want[0], sorted(want[1])), host
            assert want[0] is not None and (want[1] or host in ("article", "two"))


def test_vectors_decide(spark):
    """A passage that most pages repeat alone is no template; with a box that
    comes and goes with it, it is. With one class for all tokens both would be."""
    alone = [plain(i).replace("<div class=r3>", f"<div class=k>{'Often here' if i else ''}</div><div class=r3>")
             for i in range(12)]
    boxed = [alone[0].replace("<div class=k></div>", ""), *alone[1:]]
    assert all("Often here" in t for t in texts_of(spark, alone)[1:])
    assert not any("Often here" in t for t in texts_of(spark, boxed))
    for pages_, same in ((alone, False), (boxed, True)):
        classes, total, facts = brute_classes(pages_)
        right = _template(total, as_classes(classes, facts))
        merged = _template(total, [{"most": 1, "even": True,
                                    "tokens": [facts[t] for ts in classes.values() for t in sorted(ts)]}])
        assert (right == merged) == same


def main_of(source):
    return Page(source).main_text(None, frozenset())


def test_forms_and_headers_around_the_article():
    inner = "<article><header><h1>Title</h1><p>By line</p></header><p>own text</p></article>"
    assert main_of(f"<body><form method=post><nav>x</nav>{inner}<input value=1><button>Go</button></form></body>") == [
        "Title", "By line", "own text"]
    assert main_of(f"<header><h1>Site</h1></header>{inner}<form><p>Write to us</p></form>") == [
        "Title", "By line", "own text"]
    assert main_of("<h1><a href=/>Linked title</a></h1><p><a href=/x>All of it linked.</a></p><p>own text here</p>"
                   "<div><a href=/>Menu</a></div>") == ["Linked title", "All of it linked.", "own text here"]


def test_sections_named_after_their_subject_stay():
    for attribute in ("class=related-work", "class=ad-hoc-networks", "class=social-history", "id=search", "id=notice",
                      "class=nav-mesh", "class=comments-on-law", "class=menu-items", "style='display:none'", "hidden"):
        assert main_of(f"<article><h1>T</h1><section {attribute}><p>of it</p></section><p>own text</p></article>") == [
            "T", "of it", "own text"], attribute
        assert "of it" in main_of(f"<article><h1>T</h1><div {attribute.replace('id=', 'class=x id=')}><p>of it</p></div>"
                                  "<p>own text that is longer</p></article>"), attribute
    for name in ("comments", "comment-list", "ad", "share", "cookie-banner", "left-sidebar", "newsletter"):
        assert main_of(f"<article><h1>T</h1><div class={name}><p>no</p></div><p>own text</p></article>") == [
            "T", "own text"], name


def test_deep_nesting_and_open_tags_take_linear_time():
    began = time.perf_counter()
    for depth in (1000, 40_000):
        page_ = Page("<div class=x>" * depth + "<p>deep</p>" + "</div>" * depth)
        assert page_.main_text(None, frozenset()) == ["deep"] and len(page_.tokens()) == depth + 2
    assert main_of("<div>" * 40_000 + "<p>a<p>b") == ["a", "b"]
    assert main_of("<div></b></i></section>" * 20_000 + "end") == ["end"]
    assert len(Page("<a " * 40_000 + "x").blocks) == 1
    assert main_of("<p>x</p>" + "<!-- " * 20_000) == ["x"]
    assert time.perf_counter() - began < 20
