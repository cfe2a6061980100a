"""Exact semantics of text, HTML, date and link functions on small inputs."""

import datetime
import time

import pytest
from pyspark.sql import functions as F

from corpusflow.functions import dates as D
from corpusflow.functions import html as H
from corpusflow.functions import links as L
from corpusflow.functions import text as X
from corpusflow.operators import extraction


def one(spark, value, fn):
    return spark.createDataFrame([(value,)], "v string").select(fn(F.col("v"))).collect()[0][0]


@pytest.mark.parametrize(
    "value, blank",
    [(None, True), ("", True), ("   ", True), ("\t\n", True), (" ", True), ("\u001c", True), ("　 ", True), ("x", False), (" x ", False)],
)
def test_blank_is_unicode_white_space(spark, value, blank):
    assert one(spark, value, X.is_blank) is blank


@pytest.mark.parametrize(
    "fragment, sep, text",
    [
        ("a <b> b </b> c", "", "abc"),
        ("a <b> b </b> c", " ", "a b c"),
        ("<p>\n x<br><br/> y </p>", " ", "x y"),
        ("fish &amp; chips &quot;now&quot;", "", 'fish & chips "now"'),
        ("it&#8217;s &#x41;&#65; &#; &#99999;", "", "it’s AA &#; \U0001869f"),
        ("&amp;lt;b&amp;gt;", "", "&lt;b&gt;"),
        ("&nbsp;<i>x</i>&nbsp;", "", "x"),
        ("", " ", ""),
    ],
)
def test_plain(spark, fragment, sep, text):
    assert one(spark, fragment, lambda c: X.plain(c, sep)) == text


PAGE = """<html><head><script>var t="</p>";</script></head><body><!-- <p>no</p> -->
<main id="content"><h2>Intro</h2><p>One <b>bold</b> text&nbsp;</p>
<ul><li><p>item &amp; x</p></li><li>two<div>deep</div> end</li></ul><p>unclosed<p>next&#8217;s</p>
<h2> Share this page</h2><p>gone</p></main><footer><p>foot</p></footer></body></html>"""


def texts(spark, html, elements, sep):
    return [b.text for b in one(spark, html, lambda c: H.blocks(c, elements, sep))]


def test_blocks_keep_order_and_never_repeat_text(spark):
    assert texts(spark, PAGE, ("p", "li", "h2"), "") == [
        "Intro", "Oneboldtext", "item & x", "twodeepend", "unclosed", "next’s", "Share this page", "gone", "foot",
    ]
    assert texts(spark, PAGE, ("p",), " ") == ["One bold text", "item & x", "unclosed", "next’s", "gone", "foot"]


def test_container_matches_nested_elements(spark):
    html = '<div class="a"><div class="x post-content y"><p>in</p><div>n<div>m</div></div><p>in2</p></div><p>out</p></div>'
    inner = one(spark, html, lambda c: H.element(c, "div", H.class_attr("post-content")))
    assert inner == "<p>in</p><div>n<div>m</div></div><p>in2</p>"
    assert one(spark, html, lambda c: H.element(c, "div", H.class_attr("post"))) is None
    assert one(spark, html, lambda c: H.container(c, (("main", None), ("div", H.class_like("CONTENT"))))) == inner


@pytest.mark.parametrize(
    "html, text",
    [
        ("<main><p>one</p><!-- </main> --><p>two</p></main>", "one two"),
        ("<main><script>var s = '</main>';</script><p>two</p></main><p>no</p>", "two"),
        ("<main><p>a</p><!-- <main> --><p>b</p></main><p>no</p>", "a b"),
        ("<!-- <main><p>no</p></main> --><main><p>a</p></main>", "a"),
        ('<main title="1 > 0" data-x="</main>"><p class=\'<p>\'>a</p></main><p>no</p>', "a"),
        ("<main><script>x = '<!--';</script><p>a</p><!-- <script> --><p>b</p></main>", "a b"),
        ("<main><p>it's 4 > 1</p><p title=it's>b</p></main>", "it's 4 > 1 b"),
        ("<main><p>a</p><style>p > a { }</style><STYLE type='x'>b</STYLE ><p>c</p></main>", "a c"),
        ("<main><p>a</p></main><script>var never = '<p>ends</p>'", "a"),
        ("<main><p>\u0005a\u0006</p><!-- > --></main>", "a"),
        ("<main><p>a</p><br/><p a=b c = 'd>' e>b</p></main>", "a b"),
    ],
)
def test_tags_that_are_none_are_not_seen(spark, html, text):
    found = one(spark, html, lambda c: H.join_blocks(H.blocks(H.container(c, (("main", None),)), ("p",)), " "))
    assert found == text
    row = spark.createDataFrame([("x", "u", html)], "source string, url string, html string")
    rule = {"x": extraction.rules.ExtractRule(containers=(("main", None),), joiner=" ")}
    assert extraction.with_text(row, rule).first().text == text
    assert extraction.extract(row, rule).first().text == text


def test_slices_are_the_page_itself(spark):
    inside = "<p a='>'>x</p><!-- </div> --><script>'</div>'</script><div>y</div>"
    html = f"<div class='b'>{inside}</div>z"
    assert one(spark, html, lambda c: H.element(c, "div", H.class_attr("b"))) == inside
    assert one(spark, html, lambda c: H.drop_element(c, "div", H.class_attr("b"))) == "z"
    assert one(spark, html, lambda c: H.strip_tags(c, ("script", "p"))) == "<div class='b'><!-- </div> --><div>y</div></div>z"
    assert one(spark, html, H.strip_comments) == html.replace("<!-- </div> -->", "")
    assert one(spark, "<!-- <h1>old</h1> --><h1>new</h1>", H.title) == "new"
    listed = "<!-- <dl><dt>From:</dt><dd><a>no</a></dd></dl> --><dl><dt>From:</dt><dd><a title='>'>A</a></dd></dl>"
    assert one(spark, listed, lambda c: H.meta_list(c, "from:")) == ["A"]
    assert one(spark, listed, H.meta_pairs)[0].value == "<a title='>'>A</a>"
    assert one(spark, None, lambda c: H.strip_tags(c, ("p",))) is None


def test_deep_nesting_takes_linear_time(spark):
    def seconds(depth, fn):
        html = "a<aside>" * depth + "x" + "</aside>b" * depth + "<p>c</p>"
        start = time.perf_counter()
        found = one(spark, html, fn)
        return found, time.perf_counter() - start

    strip, inner = (lambda c: H.strip_tags(c, ("aside",))), (lambda c: F.length(H.element(c, "aside")).cast("string"))
    for fn, want in ((strip, "ab<p>c</p>"), (inner, str(9999 * 17 + 2 - 1))):
        seconds(1000, fn)
        got, taken = seconds(10_000, fn)
        assert got == want or fn is inner
        assert taken < 20 * max(seconds(1000, fn)[1], 0.2)
    assert one(spark, "a<aside>" * 50_000 + "</aside>b" * 50_000, strip) == "ab"


def test_drop_element(spark):
    html = '<div><p>a</p><div id="footnotes_section"><div>x</div></div><p>b</p></div>'
    drop = lambda c: H.drop_element(c, "div", H.id_attr("footnotes_section"))
    assert one(spark, html, drop) == "<div><p>a</p><p>b</p></div>"
    assert one(spark, "<p>a</p>", drop) == "<p>a</p>"


def test_extraction_by_source(spark):
    fft = (
        '<h2 class="entry-title">T</h2><div class="fusion-meta-info-wrapper"><span>By A</span><span>21st March 2024</span></div>'
        '<div class="post-content"><p>a <b>b</b></p><div id="footnotes_section"><p>note</p></div><p>c</p></div>'
    )
    fed = (
        '<h1 class="elementor-heading-title x">F</h1><time>May 2, 2024</time><div class="elementor-widget-theme-post-content">'
        "<p>one</p><p>The FED are happy to share blogs by others</p><p>two</p></div>"
    )
    epi = '<h1 class="single-title">E</h1><div class="single-title-date">3rd June 2024</div><p>outside</p>'
    gov_ie = "<main><nav><p>n</p></nav><p>From: Department of Education and Youth</p><p>Body (PDF)</p></main>"
    erc = "<p>Kept</p><p>Download the report now</p>"
    council = "<main><p>Published 3 May</p><p>Body <i>x</i></p></main>"
    rows = [
        ("gov", "u1", PAGE.replace("<main", '<dl><dt>Published:</dt><dd>1 May 2024</dd></dl><main')),
        ("fft", "u2", fft), ("fed", "u3", fed), ("epi", "u4", epi), ("gov_ie", "u5", gov_ie), ("erc", "u6", erc),
        ("teaching_council", "u7", council), ("nuffield", "u8", "<p>no area</p>"),
        ("rte", "https://www.rte.ie/news/education/2026/0312/1-a/", "<h1>R</h1><div class='the-article'><p>r</p><footer><p>f</p></footer></div>"),
        ("gtcs", "u9", "<h1>G</h1><p>outside</p>"),
    ]
    df = spark.createDataFrame(rows, "source string, url string, html string")
    got = {r.source: r for r in extraction.extract(df).collect()}
    day = datetime.date
    assert got["gov"].text.split("\n") == ["Intro", "Oneboldtext", "item & x", "twodeepend", "unclosed", "next’s"]
    assert got["gov"].date == day(2024, 5, 1)
    assert (got["fft"].title, got["fft"].date, got["fft"].text) == ("T", day(2024, 3, 21), "ab\nc")
    assert (got["fed"].title, got["fed"].date, got["fed"].text) == ("F", day(2024, 5, 2), "one")
    assert (got["epi"].title, got["epi"].date, got["epi"].text) == ("E", day(2024, 6, 3), "")
    assert got["gov_ie"].text == "Body"
    assert got["erc"].text == "Kept"
    assert got["teaching_council"].text == "Bodyx"
    assert got["nuffield"].text is None
    assert (got["rte"].date, got["rte"].text) == (day(2026, 3, 12), "r")
    kept = {r.source for r in extraction.usable(extraction.extract(df)).collect()}
    assert kept == {"gov", "fft", "fed", "epi", "gov_ie", "erc", "teaching_council", "rte"}


@pytest.mark.parametrize(
    "text, expected",
    [("3 March 2024", (2024, 3, 3)), ("12 Mar, 2026", (2026, 3, 12)), ("31 Foo 2024", None), ("31 February 2024", None), ("", None)],
)
def test_parse_date(spark, text, expected):
    got = one(spark, text, lambda c: D.parse_date(c, ("d MMMM yyyy", "d MMM, yyyy")))
    assert got == (expected and datetime.date(*expected))


def test_dates_in_text(spark):
    assert one(spark, "on February 26, 2026 and 1 May 2020", D.find_date) == datetime.date(2026, 2, 26)
    assert one(spark, "News, 21st March 2024 at noon", D.fuzzy_date) == datetime.date(2024, 3, 21)
    # a late hour in UTC stays on the day as written
    assert one(spark, "2026-03-12T23:30:00Z", D.iso_date) == datetime.date(2026, 3, 12)
    assert one(spark, "/news/2026/1345/x", D.url_date) is None


def test_metadata_list(spark):
    html = (
        '<dl class="m"><dt>From:</dt><dd><a href="/a">Ofsted</a> and <a href="/b">Department for Education</a></dd>'
        "<dt>Published:</dt><dd>not yet</dd><dt>Updated:</dt><dd>4 May 2024</dd></dl>"
    )
    assert one(spark, html, lambda c: H.meta_list(c, "from:")) == ["Ofsted", "Department for Education"]
    assert one(spark, html, lambda c: H.meta_list(c, "to:")) == []
    assert one(spark, html, D.labelled_date) == datetime.date(2024, 5, 4)
    block = '<div class="gem-c-published-dates">Published 2 May 2023</div>'
    assert one(spark, block, lambda c: D.published_block(c, H.class_attr("gem-c-published-dates"))) == datetime.date(2023, 5, 2)


@pytest.mark.parametrize(
    "html, url",
    [
        ('<li class="next-page"><a class="b" href="/p/2">x</a></li>', "/p/2"),
        ('<div class="govuk-pagination__next"> <a href="/p/3">x</a></div>', "/p/3"),
        ('<a href="/a">Nextdoor</a><a href="/p/4"> Next › </a>', "/p/4"),
        ('<a href="/a">1</a><span class="is-current">2</span><a href="/p/5">3</a>', "/p/5"),
        ('<a href="/a">one</a>', None),
    ],
)
def test_next_page(spark, html, url):
    assert one(spark, html, L.next_page) == url


def test_links_keep_order_and_distinct_keeps_first(spark):
    html = '<a href="/b">B</a><a class="x" href="https://h/a"><b>A</b></a><a href="/b">again</a><a name="n">none</a>'
    df = L.links(spark.createDataFrame([(1, html)], "page_id long, html string"))
    assert [tuple(r) for r in df.orderBy("pos").collect()] == [(1, 0, "/b", "B"), (1, 1, "https://h/a", "A"), (1, 2, "/b", "again")]
    assert {(r.href, r.pos) for r in L.distinct_links(df).collect()} == {("/b", 0), ("https://h/a", 1)}
    assert one(spark, "/b", lambda c: L.absolute(c, "https://h")) == "https://h/b"
    assert one(spark, "https://h/2024/03/slug/?q#f", L.path_parts) == ["2024", "03", "slug"]
