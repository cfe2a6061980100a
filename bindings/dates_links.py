"""Dates and links. Dates are written out from orders in several forms, then read back."""

from pyspark.sql import functions as F

from corpusflow.functions import dates as D
from corpusflow.functions import links as L
from corpusflow.operators import filters
from corpusflow.operators.dedup import frontier
from corpusflow.operators.extraction import page_date

from .base import plain_sql, query, table


def _orders(spark, sf):
    return table(spark, sf, "orders").withColumn("d", F.to_date("o_orderdate"))


def _fmt(pattern, c="d"):
    return F.date_format(c, pattern)


def _by_priority(*cases):
    """One form per order priority."""
    names = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")
    out = None
    for name, c in zip(names, cases, strict=True):
        test = F.col("o_orderpriority") == name
        out = F.when(test, c) if out is None else out.when(test, c)
    return out


_DAY = "CAST(CAST(o_orderdate AS DATE) AS VARCHAR)"
_NOT_LOW = f"CASE WHEN o_orderpriority <> '5-LOW' THEN {_DAY} END"


def _out(df, c):
    return df.select("o_orderkey", c.cast("string").alias("date"))


@query("parsed_dates", f"SELECT o_orderkey, {_NOT_LOW} AS date FROM orders")
def parsed_dates(spark, sf):
    text = _by_priority(
        _fmt("d MMMM yyyy"), _fmt("MMMM d yyyy"), _fmt("d MMM, yyyy"), _fmt("yyyy-MM-dd"),
        F.concat(F.lit("31 Foo "), _fmt("yyyy")),
    )
    df = _orders(spark, sf).withColumn("s", text)
    return _out(df, D.parse_date(F.col("s"), ("d MMMM yyyy", "MMMM d yyyy", "yyyy-MM-dd", "d MMM, yyyy")))


@query(
    "ordinal_dates",
    f"SELECT o_orderkey, strftime(o_orderdate, '%-d %B %Y') AS written, {_DAY} AS date FROM orders",
)
def ordinal_dates(spark, sf):
    n = F.dayofmonth("d")
    suffix = (
        F.when(n.isin(1, 21, 31), "st").when(n.isin(2, 22), "nd").when(n.isin(3, 23), "rd").otherwise("th")
    )
    raw = F.concat(n.cast("string"), suffix, F.lit(" "), _fmt("MMMM yyyy"))
    return (
        _orders(spark, sf).select("o_orderkey", D.strip_ordinal(raw).alias("written"))
        .withColumn("date", D.parse_date(F.col("written"), ("d MMMM yyyy",)).cast("string"))
    )


@query("found_dates", f"SELECT o_orderkey, {_NOT_LOW} AS date FROM orders")
def found_dates(spark, sf):
    lead = F.concat(F.lit("Order "), F.col("o_orderkey").cast("string"), F.lit(" of 12 items, placed on "))
    text = _by_priority(
        F.concat(lead, _fmt("d MMMM yyyy"), F.lit(", see 1 May 2031")),
        F.concat(lead, _fmt("MMMM d, yyyy"), F.lit(" at noon")),
        F.concat(lead, _fmt("MMMM d yyyy"), F.lit(".")),
        F.concat(lead, _fmt("dd  MMMM  yyyy"), F.lit(" or later")),
        F.concat(lead, F.lit("32 March 1999")),
    )
    return _out(_orders(spark, sf).withColumn("s", text), D.find_date(F.col("s")))


@query("iso_dates", f"SELECT o_orderkey, {_NOT_LOW} AS date FROM orders")
def iso_dates(spark, sf):
    text = _by_priority(
        F.concat(_fmt("yyyy-MM-dd"), F.lit("T23:30:00Z")),
        F.concat(_fmt("yyyy-MM-dd"), F.lit("T00:10:00+01:00")),
        _fmt("yyyy-MM-dd"),
        F.concat(_fmt("yyyy-MM-dd"), F.lit("T12:00:00.123-08:00")),
        F.lit("yesterday"),
    )
    return _out(_orders(spark, sf).withColumn("s", text), D.iso_date(F.col("s")))


@query("url_dates", f"SELECT o_orderkey, {_NOT_LOW} AS date FROM orders")
def url_dates(spark, sf):
    key = F.col("o_orderkey").cast("string")
    good = F.concat(F.lit("https://www.example.org/news/education/"), _fmt("yyyy/MMdd"), F.lit("/"), key, F.lit("-slug/"))
    bad = F.concat(F.lit("https://www.example.org/news/"), _fmt("yyyy"), F.lit("/1345/"), key, F.lit("-slug/"))
    return _out(_orders(spark, sf).withColumn("s", _by_priority(good, good, good, good, bad)), D.url_date(F.col("s")))


@query(
    "labelled_dates",
    "SELECT o_orderkey, CASE o_orderpriority WHEN '5-LOW' THEN NULL WHEN '2-HIGH' THEN "
    f"CAST(CAST(o_orderdate AS DATE) + 30 AS VARCHAR) ELSE {_DAY} END AS date FROM orders",
)
def labelled_dates(spark, sf):
    def block(published, updated):
        return F.concat(
            F.lit('<dl class="gem-c-metadata__list"><dt>From:</dt><dd><a href="/o">1 May 1990</a></dd>'
                  "<dt>Published:</dt>\n<dd> <span>"),
            published, F.lit("</span></dd><dt>Updated:</dt><dd>"), updated, F.lit("</dd></dl>"),
        )

    day, later = _fmt("d MMMM yyyy"), F.date_format(F.date_add("d", 30), "d MMMM yyyy")
    html = _by_priority(
        block(day, later), block(F.lit("not yet"), later), block(day, F.lit("")), block(day, day),
        block(F.lit("soon"), F.lit("later")),
    )
    return _out(_orders(spark, sf).withColumn("s", html), D.labelled_date(F.col("s")))


@query("fallback_dates", f"SELECT o_orderkey, {_NOT_LOW} AS date FROM orders")
def fallback_dates(spark, sf):
    iso = _fmt("yyyy-MM-dd")
    nothing = F.lit("<article><p>no date</p></article>")
    html = _by_priority(
        F.concat(F.lit('<article><time class="t" datetime="'), iso, F.lit('T23:59:00Z">x</time></article>')),
        F.concat(F.lit('<head><meta content="'), iso, F.lit('T08:00:00Z" property="article:published_time"/></head><time>x</time>')),
        nothing, nothing, nothing,
    )
    url = F.when(
        F.col("o_orderpriority") != "5-LOW",
        F.concat(F.lit("https://www.rte.ie/news/education/"), _fmt("yyyy/MMdd"), F.lit("/1-a/")),
    ).otherwise("https://www.rte.ie/news/1-a/")
    df = _orders(spark, sf).withColumns({"source": F.lit("rte"), "html": html, "url": url})
    return _out(df, page_date())


@query("fuzzy_dates", f"SELECT o_orderkey, {_NOT_LOW} AS date FROM orders")
def fuzzy_dates(spark, sf):
    n = F.dayofmonth("d").cast("string")
    text = _by_priority(
        F.concat(F.lit("News | "), n, F.lit("th "), _fmt("MMM"), F.lit(". "), _fmt("yyyy"), F.lit(", 9.30am")),
        F.concat(F.lit("Event on "), _fmt("MMMM"), F.lit(" "), n, F.lit("th, "), _fmt("yyyy")),
        F.concat(F.lit("Posted "), _fmt("yyyy-MM-dd"), F.lit(" by staff")),
        F.concat(F.lit("Written "), n, F.lit(" "), _fmt("MMMM yyyy")),
        F.lit("Date to be confirmed for 2030"),
    )
    return _out(_orders(spark, sf).withColumn("s", text), D.fuzzy_date(F.col("s")))


@query(
    "iso_prefixes",
    "SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS from_text, strftime(o_orderdate, '%Y-%m-%d') AS from_date FROM orders",
)
def iso_prefixes(spark, sf):
    return _orders(spark, sf).select(
        "o_orderkey",
        D.iso10(_fmt("yyyy-MM-dd'T'HH:mm:ss", "o_orderdate")).alias("from_text"),
        D.iso10(F.col("d")).alias("from_date"),
    )


# ---- links -----------------------------------------------------------------

_A = "(?is)<a\\s[^>]*href=\"[^\"]*\"[^>]*>.*?</a>"
LINKS_SQL = (
    f"a AS (SELECT page_id, url, regexp_extract_all(html, '{_A}') AS l FROM pages), "
    "e AS (SELECT page_id, url, unnest(range(len(l))) AS pos, unnest(l) AS x FROM a), "
    "links AS (SELECT page_id, url, CAST(pos AS INTEGER) AS pos, regexp_extract(x, 'href=\"([^\"]*)\"', 1) AS href, "
    + plain_sql("regexp_extract(x, '(?s)^<a[^>]*>(.*)</a>$', 1)") + " AS anchor FROM e)"
)


def page_links(spark, sf):
    return L.links(table(spark, sf, "pages"), keys=("page_id", "url"))


@query("page_links", f"WITH {LINKS_SQL} SELECT page_id, pos, href, anchor FROM links")
def links(spark, sf):
    return page_links(spark, sf).drop("url")


@query(
    "absolute_links",
    f"WITH {LINKS_SQL} SELECT page_id, pos, 'https://' || regexp_extract(url, '^[a-z]+://([^/?#]+)', 1) || href AS link FROM links",
)
def absolute_links(spark, sf):
    base = F.concat(F.lit("https://"), L.url_host(F.col("url")))
    return page_links(spark, sf).select("page_id", "pos", L.absolute(F.col("href"), base).alias("link"))


_PATH = "string_split(trim(regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1), '/'), '/')"


@query(
    "url_parts",
    f"SELECT page_id, CAST(len({_PATH}) AS INTEGER) AS n_parts, {_PATH}[1] AS first_part, {_PATH}[-1] AS last_part FROM pages",
)
def url_parts(spark, sf):
    parts = L.path_parts(F.col("url"))
    return table(spark, sf, "pages").select("page_id", parts.alias("p")).select(
        "page_id", F.size("p").alias("n_parts"), F.col("p")[0].alias("first_part"),
        F.element_at("p", -1).alias("last_part"),
    )


@query(
    "distinct_page_links",
    f"WITH {LINKS_SQL} SELECT page_id, href, min(pos) AS pos FROM links GROUP BY page_id, href",
)
def distinct_page_links(spark, sf):
    return L.distinct_links(page_links(spark, sf))


@query(
    "link_frontier",
    f"WITH {LINKS_SQL} SELECT DISTINCT href AS url FROM links WHERE href NOT IN "
    "(SELECT href FROM links WHERE starts_with(url, 'https'))",
)
def link_frontier(spark, sf):
    seen = page_links(spark, sf)
    captured = seen.filter(F.startswith("url", F.lit("https"))).select(F.col("href").alias("url"))
    return frontier(seen.select(F.col("href").alias("url")), captured)


@query(
    "next_pages",
    "SELECT page_id, CASE WHEN contains(url, '.html') THEN NULL WHEN contains(url, '?') THEN '/w/' || page_id "
    "WHEN contains(url, '#') THEN '/t/' || page_id ELSE '/n/' || page_id END AS next_url FROM pages",
)
def next_pages(spark, sf):
    key = F.col("page_id").cast("string")

    def wrap(a, b):
        return F.concat("html", F.lit(a), key, F.lit(b))

    html = (
        F.when(F.contains("url", F.lit(".html")), F.col("html"))
        .when(F.contains("url", F.lit("?")), wrap('<ul><li class="x next-page">\n<a class="q" href="/w/', '">go</a></li></ul>'))
        .when(F.contains("url", F.lit("#")), wrap('<div><a href="/t/', '"><span>Next</span> ›</a></div>').cast("string"))
        .otherwise(wrap('<span class="is-Current">2</span> <a href="/n/', '">3</a>'))
    )
    # "Next ›" is written in two nodes, which join without a space
    html = F.replace(html, F.lit("<span>Next</span> ›"), F.lit("<b>next ›</b>"))
    return table(spark, sf, "pages").select("page_id", L.next_page(html).alias("next_url"))


@query(
    "listing_cards",
    "WITH p AS (SELECT p_partkey, p_name, p_brand, CAST(DATE '2024-01-01' + p_size AS VARCHAR) AS d FROM part) "
    "SELECT p_partkey, 'data_attributes' AS layout, 0 AS pos, '/a/' || p_partkey AS url, p_name AS title, d AS date FROM p UNION ALL "
    "SELECT p_partkey, 'data_attributes', 1, '/b/' || p_partkey, p_brand, NULL FROM p UNION ALL "
    "SELECT p_partkey, 'search_result', 0, '/c/' || p_partkey, p_name, d FROM p UNION ALL "
    "SELECT p_partkey, 'card_link', 0, '/d/' || p_partkey, p_brand, NULL FROM p",
)
def listing_cards(spark, sf):
    day = F.date_add(F.lit("2024-01-01").cast("date"), F.col("p_size"))
    key = F.col("p_partkey").cast("string")
    html = F.concat(
        F.lit('<div class="gi-card wide" data-createdat="'), F.date_format(day, "yyyy-MM-dd'T'HH:mm"), F.lit('" data-title="'),
        "p_name", F.lit('"><h3>x</h3><a class="k" href="/a/'), key, F.lit('">go</a></div>'),
        F.lit('<div class="gi-card" data-createdat="" data-title="'), "p_brand", F.lit('"><a href="/b/'), key,
        F.lit('">go</a></div><ul><li class="ds_search-result"><h3><a class="ds_search-result__link" href="/c/'), key, F.lit('">'),
        "p_name", F.lit("</a></h3><dl><dt>Type</dt><dd>Publication</dd><dt>Date</dt><dd>"), F.date_format(day, "d MMMM yyyy"),
        F.lit('</dd></dl></li></ul><div id="article-results"><a class="card-item__container" href="/d/'), key,
        F.lit('"><h3 class="card-item__heading"> '), "p_brand", F.lit("</h3></a></div>"),
    )
    part = table(spark, sf, "part").select("p_partkey", html.alias("html"))
    out = None
    for layout, rule in L.CARD_RULES.items():
        one = L.cards(part, rule, keys=("p_partkey",)).select(
            "p_partkey", F.lit(layout).alias("layout"), "pos", "url", "title", F.col("date").cast("string").alias("date")
        )
        out = one if out is None else out.unionAll(one)
    return out


@query(
    "link_dates",
    "SELECT p_partkey, '/a/' || p_partkey AS href, CAST(DATE '2024-01-01' + p_size AS VARCHAR) AS date FROM part UNION ALL "
    "SELECT p_partkey, '/b/' || p_partkey, NULL FROM part",
)
def link_dates(spark, sf):
    day = F.date_add(F.lit("2024-01-01").cast("date"), F.col("p_size"))
    key = F.col("p_partkey").cast("string")
    html = F.concat(
        F.lit("<p>1 May 2020</p><ul><li><a href='/a/"), key, F.lit("'>"), "p_name", F.lit("</a> <span>"),
        F.date_format(day, "d MMMM yyyy"), F.lit("</span></li><li><a href='/b/"), key, F.lit("'>"), "p_brand",
        F.lit("</a></li></ul>"),
    )
    part = table(spark, sf, "part").select("p_partkey", html.alias("html"))
    return L.link_dates(part, keys=("p_partkey",)).select("p_partkey", "href", F.col("date").cast("string").alias("date"))




@query(
    "url_shapes",
    "WITH u AS (SELECT page_id, 'https://www.rte.ie/news/' || split_part(url, '/', 4) || '/2024/0312/' || page_id || '-a/' AS url FROM pages "
    "UNION ALL SELECT page_id, 'https://www.thejournal.ie/a-' || (100 * page_id) || '-Mar2026/' FROM pages "
    "UNION ALL SELECT page_id, 'https://ffteducationdatalab.org.uk/20' || regexp_extract(url, '^[a-z]+://[^/]*(.*)$', 1) FROM pages "
    "UNION ALL SELECT page_id, 'https://www.esri.ie/news' || regexp_extract(url, '^[a-z]+://[^/]*(.*)$', 1) FROM pages "
    "UNION ALL SELECT page_id, 'https://www.gtcs.org.uk/news/news-and-updates/' || page_id FROM pages), "
    "m AS (SELECT 'rte' AS rule, url FROM u WHERE regexp_matches(url, '/news/.*?/[0-9]{4}/[0-9]{4}/[0-9]+-') "
    "UNION ALL SELECT 'thejournal', url FROM u WHERE regexp_matches(url, '-[0-9]{5,}-\\w{3}[0-9]{4}') "
    "UNION ALL SELECT 'fft', url FROM u WHERE starts_with(url, 'https://ffteducationdatalab.org.uk/20') AND "
    "len(string_split(trim(regexp_extract(url, '^[a-z]+://[^/]*([^?#]*)', 1), '/'), '/')) >= 3 "
    "UNION ALL SELECT 'esri', url FROM u WHERE starts_with(url, 'https://www.esri.ie/news/') AND length(url) > 25 AND NOT contains(url, '?') "
    "UNION ALL SELECT 'gtcs', url FROM u WHERE contains(url, '/news/news-and-updates/')) SELECT rule, url FROM m",
)
def url_shapes(spark, sf):
    key = F.col("page_id").cast("string")
    path = F.regexp_extract("url", "^[a-z]+://[^/]*(.*)$", 1)
    urls = F.array(
        F.concat(F.lit("https://www.rte.ie/news/"), F.get(F.split("url", "/"), F.lit(3)), F.lit("/2024/0312/"), key, F.lit("-a/")),
        F.concat(F.lit("https://www.thejournal.ie/a-"), (F.col("page_id") * 100).cast("string"), F.lit("-Mar2026/")),
        F.concat(F.lit("https://ffteducationdatalab.org.uk/20"), path),
        F.concat(F.lit("https://www.esri.ie/news"), path),
        F.concat(F.lit("https://www.gtcs.org.uk/news/news-and-updates/"), key),
    )
    u = table(spark, sf, "pages").select(F.explode(urls).alias("url"))
    out = None
    for name, pattern in L.URL_RULES.items():
        one = filters.url_filter(u, pattern).select(F.lit(name).alias("rule"), "url")
        out = one if out is None else out.unionAll(one)
    return out
