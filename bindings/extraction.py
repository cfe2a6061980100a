"""Extraction over captured pages."""

from pyspark.sql import functions as F

from corpusflow import rules
from corpusflow.functions import html as H
from corpusflow.functions.links import URL_RULES, url_host
from corpusflow.functions.text import computed, plain, strip_literals
from corpusflow.operators import extraction, quality
from corpusflow.plans import corpus
from corpusflow.sources.files import flatten_posts, read_pages

from .base import (
    ORACLE, runs,
    ARTICLE_SQL, DIM_SQL, RANKED, TITLE_SQL, blocks_sql, no_script_sql, plain_sql, query, table, text_sql, trim_sql,
)

def page_blocks(sep=" "):
    return H.blocks(H.container(F.col("html"), (("main", None), ("article", None))), ("p",), sep)


@query("captured_pages", "SELECT page_id, url, length(html) AS n_chars FROM pages")
def captured_pages(spark, sf):
    return read_pages(spark, f"{sf}/pages.parquet").select(
        "page_id", "url", F.length("html").cast("long").alias("n_chars")
    )


@query(
    "containers",
    f"SELECT page_id, md5({ARTICLE_SQL}) AS article, "
    "regexp_extract(html, '(?s)<div class=\"ad\">(.*?)</div>', 1) AS ad FROM pages",
)
def containers(spark, sf):
    h = F.col("html")
    return table(spark, sf, "pages").select(
        "page_id",
        F.md5(H.container(h, (("main", None), ("article", None)))).alias("article"),
        H.container(h, (("div", H.class_attr("body-content")), ("div", H.class_attr("ad")))).alias("ad"),
    )


@query(
    "stripped_elements",
    "SELECT page_id, md5(regexp_replace(regexp_replace(regexp_replace(regexp_replace(html, "
    "'(?s)<script>.*?</script>', '', 'g'), '(?s)<style>.*?</style>', '', 'g'), "
    "'(?s)<nav>.*?</nav>', '', 'g'), '(?s)<footer>.*?</footer>', '', 'g')) AS rest FROM pages",
)
def stripped_elements(spark, sf):
    tags = ("script", "style", "figure", "aside", "nav", "footer", "header")
    return table(spark, sf, "pages").select("page_id", F.md5(H.strip_tags(F.col("html"), tags)).alias("rest"))


@query(
    "page_blocks",
    f"WITH b AS (SELECT page_id, {blocks_sql(ARTICLE_SQL)} AS l FROM pages) "
    "SELECT page_id, CAST(len(l) AS INTEGER) AS n_blocks, md5(array_to_string(l, chr(10))) AS text FROM b",
)
def blocks(spark, sf):
    b = page_blocks()
    return table(spark, sf, "pages").select("page_id", b.alias("b")).select(
        "page_id", F.size("b").alias("n_blocks"), F.md5(H.join_blocks(F.col("b"))).alias("text")
    )


@query(
    "block_cut",
    f"WITH b AS (SELECT page_id, {blocks_sql(ARTICLE_SQL)} AS l FROM pages), "
    "c AS (SELECT page_id, l, list_position(list_transform(l, lambda t: contains(t, 'anea') OR contains(t, 'sich')), true) AS cut FROM b) "
    "SELECT page_id, md5(array_to_string(CASE WHEN cut > 0 THEN list_slice(l, 1, cut - 1) ELSE l END, chr(10))) AS text FROM c",
)
def block_cut(spark, sf):
    b = H.cut_at(page_blocks(), ("anea", "sich"))
    return table(spark, sf, "pages").select("page_id", F.md5(H.join_blocks(b)).alias("text"))


@query(
    "block_skip",
    f"WITH b AS (SELECT page_id, {blocks_sql(ARTICLE_SQL)} AS l FROM pages) "
    "SELECT page_id, md5(array_to_string(list_filter(l, lambda t: NOT contains(t, 'anea') AND NOT contains(t, 'eriner') "
    "AND NOT starts_with(t, 'The')), chr(10))) AS text FROM b",
)
def block_skip(spark, sf):
    b = H.skip_blocks(page_blocks(), ("anea", "eriner"), "The")
    return table(spark, sf, "pages").select("page_id", F.md5(H.join_blocks(b)).alias("text"))


@query(
    "stripped_literals",
    "SELECT page_id, md5(" + trim_sql("replace(" + trim_sql(f"replace({text_sql(ARTICLE_SQL)}, 'the ', '')") + ", '(of)', '')") + ") AS text FROM pages",
)
def stripped_literals(spark, sf):
    text = H.join_blocks(page_blocks())
    return table(spark, sf, "pages").select(
        "page_id", F.md5(strip_literals(text, ("the ", "(of)"))).alias("text")
    )


@query(
    "page_titles",
    f"SELECT page_id, {TITLE_SQL} AS h1, CASE WHEN starts_with(url, 'https') "
    "THEN " + plain_sql("regexp_extract(html, '(?s)<title>(.*?)</title>', 1)") + f" ELSE {TITLE_SQL} END AS title FROM pages",
)
def page_titles(spark, sf):
    h = F.col("html")
    listed = F.when(F.startswith("url", F.lit("https")), H.title(h, "title")).otherwise("")
    return table(spark, sf, "pages").select(
        "page_id", H.title(h).alias("h1"), H.pick_title(listed, H.title(h)).alias("title")
    )


@query(
    "decoded_entities",
    "SELECT p_partkey, 'é' || p_name || '😀😀' || chr(39) || chr(39) || '&lt;' || '•&bogus;&#0;&#xD800;&' AS text, 'a' || p_partkey || 'c' AS nodes FROM part",
)
def decoded_entities(spark, sf):
    """By name, by number in either base and any length, once each; blank nodes go after decoding."""
    key = F.col("p_partkey").cast("string")
    raw = F.concat(F.lit("&eacute;"), "p_name", F.lit("&#128512;&#x1F600;&#X27;&#0000039;&#38;lt;&bull;&bogus;&#0;&#xD800;&"))
    nodes = F.concat(F.lit("a<b>&#160;</b>"), key, F.lit("<i> &nbsp;</i>c"))
    return table(spark, sf, "part").select("p_partkey", plain(raw).alias("text"), plain(nodes).alias("nodes"))


@query(
    "nested_elements",
    "SELECT p_partkey, p_name || '[' || p_brand || ']</p>' AS rest FROM part",
)
def nested_elements(spark, sf):
    """Elements inside one of the same name, and an end tag without a start."""
    html = F.concat(
        "p_name", F.lit("<aside>x<aside id='a'>y</aside>z</aside>["), "p_brand", F.lit("<ASIDE><aside></aside><p>w</p></ASIDE>]</aside></p>")
    )
    return table(spark, sf, "part").select("p_partkey", H.strip_tags(html, ("aside", "nav")).alias("rest"))


# tags where a parser sees none: in comments, scripts, styles and quoted attributes
_BEFORE = (
    '<!-- <main><h1>old</h1> --><script>var a = "<main><h1>older</h1></main>";</script><h1 title="a > <h1>b</h1>">t', "</h1>"
    "<main data-x='</main>' data-y=\"1 > 0\"><p>one</p><!-- </main> --><script>if (a < b) { w('</main><p>no</p>'); }</script>"
    '<style>main > p { }</style><aside><p>x</p><!-- </aside> --><aside>y</aside></aside>',
)
_AFTER = '<main><p title="</p></main>">inner</p></main><p>two</p></main><p>after</p>'
_WRAPPED_SQL = "{0} || page_id || {1} || html || {2}".format(*("'" + x.replace("'", "''") + "'" for x in (*_BEFORE, _AFTER)))


@query(
    "hidden_tags",
    f"WITH w AS (SELECT page_id, html, {_WRAPPED_SQL} AS page FROM pages), "
    "i AS (SELECT page_id, html, substr(page, strpos(page, '1 > 0\">') + 7) AS rest FROM w) "
    "SELECT page_id, 't' || page_id AS title, md5(substr(rest, 1, length(rest) - length('</main><p>after</p>'))) AS inside, "
    f"md5('one' || chr(10) || CASE WHEN {text_sql('html')} <> '' THEN {text_sql('html')} || chr(10) ELSE '' END || 'inner' || chr(10) || 'two') AS text FROM i",
)
def hidden_tags(spark, sf):
    """Title, container (as the page has it) and text where comments, scripts, styles and attributes hold tags."""
    page = F.concat(F.lit(_BEFORE[0]), F.col("page_id").cast("string"), F.lit(_BEFORE[1]), "html", F.lit(_AFTER))
    df = table(spark, sf, "pages").select("page_id", page.alias("page"))
    inside = H.container(F.col("page"), (("article", H.class_attr("no")), ("main", None)))
    read = computed(df, title=H.title(F.col("page")), inside=inside)
    blocks = H.blocks(H.strip_tags(F.col("inside"), ("aside",)))
    return read.select("page_id", "title", F.md5("inside").alias("inside"), F.md5(H.join_blocks(blocks)).alias("text"))


@query(
    "plain_fragments",
    "SELECT page_id, " + plain_sql("regexp_extract(html, '(?s)(<nav>.*?</nav>)', 1)", " ") + " AS nav, "
    + plain_sql("regexp_extract(html, '(?s)(<footer>.*?</footer>)', 1)") + " AS foot FROM pages",
)
def plain_fragments(spark, sf):
    return table(spark, sf, "pages").select(
        "page_id",
        plain(F.regexp_extract("html", "(?s)(<nav>.*?</nav>)", 1), " ").alias("nav"),
        plain(F.regexp_extract("html", "(?s)(<footer>.*?</footer>)", 1)).alias("foot"),
    )


@query(
    "publisher_lists",
    "SELECT p_partkey, p_brand || '; ' || p_type || ' & Co' AS publishers, 2 AS n FROM part",
)
def publisher_lists(spark, sf):
    html = F.concat(
        F.lit('<dl class="gem-c-metadata__list"><dt>Type:</dt><dd><a href="/t">x</a></dd><dt> From: </dt>\n<dd><a href="/b">'),
        "p_brand", F.lit('</a> and <a class="l" href="/t">'), "p_type",
        F.lit(" &amp; Co</a></dd><dt>Published:</dt><dd>3 March 2024</dd></dl>"),
    )
    return table(spark, sf, "part").select("p_partkey", H.meta_list(html, "from:").alias("o")).select(
        "p_partkey", F.array_join("o", "; ").alias("publishers"), F.size("o").alias("n")
    )


POST_DAY = "CAST(DATE '2024-01-01' + CAST(page_id % 700 AS INTEGER) AS VARCHAR)"


def posts(spark, sf):
    """Pages as post JSON of one feed source."""
    day = F.date_add(F.lit("2024-01-01").cast("date"), F.pmod("page_id", F.lit(700)).cast("int"))
    return table(spark, sf, "pages").select(
        "page_id",
        F.lit("sera").alias("source"),
        F.to_json(
            F.struct(
                F.concat(day.cast("string"), F.lit("T23:30:00")).alias("date"),
                F.col("url").alias("link"),
                F.struct(F.regexp_extract("html", "(?s)<h1>(.*?)</h1>", 1).alias("rendered")).alias("title"),
                F.struct(F.col("html").alias("rendered")).alias("content"),
            )
        ).alias("body"),
    )


@query(
    "feed_posts",
    f"SELECT page_id, url, {TITLE_SQL} AS title, {POST_DAY} AS date, md5({text_sql('html')}) AS text FROM pages",
)
def feed_posts(spark, sf):
    return flatten_posts(posts(spark, sf)).select(
        "page_id", "url", "title", F.col("date").cast("string").alias("date"), F.md5("text").alias("text")
    )


@query(
    "text_fallbacks",
    f"WITH t AS (SELECT page_id, CASE WHEN starts_with(url, 'https') THEN {text_sql(ARTICLE_SQL)} ELSE '' END AS a, "
    f"CASE WHEN contains(url, '?') THEN ' ' ELSE {TITLE_SQL} END AS b FROM pages) "
    f"SELECT page_id, md5(CASE WHEN {trim_sql('a')} <> '' THEN a ELSE b END) AS text FROM t "
    f"WHERE {trim_sql('a')} <> '' OR {trim_sql('b')} <> ''",
)
def text_fallbacks(spark, sf):
    h = F.col("html")
    both = table(spark, sf, "pages").select(
        "page_id",
        F.when(F.startswith("url", F.lit("https")), H.join_blocks(page_blocks())).otherwise("").alias("page_text"),
        F.when(F.contains("url", F.lit("?")), " ").otherwise(H.title(h)).alias("api_text"),
    )
    return extraction.text_fallback(both).select("page_id", F.md5("text").alias("text"))


@query(
    "feed_with_pages",
    f"SELECT url, {TITLE_SQL} AS title, {POST_DAY} AS date, md5(CASE WHEN starts_with(url, 'https') THEN {text_sql(ARTICLE_SQL, '')} "
    f"ELSE {text_sql('html')} END) AS text FROM pages",
)
def feed_with_pages(spark, sf):
    """Posts of a source whose feed holds excerpts: the captured page's text comes first.

    Secure pages were captured, with their article as main element.
    """
    h = F.col("html")
    captured = (
        table(spark, sf, "pages")
        .filter(F.startswith("url", F.lit("https")))
        .withColumn("html", F.replace(F.replace(h, F.lit("<article>"), F.lit("<main>")), F.lit("</article>"), F.lit("</main>")))
    )
    feed = posts(spark, sf).withColumn("source", F.lit("teaching_council"))
    found = corpus.articles_from_posts(feed, captured)
    return found.select("url", "title", F.col("date").cast("string").alias("date"), F.md5("text").alias("text"))


# ---- all sources' rules in one job -----------------------------------------

N = len(RANKED)
PAGE_SOURCE_SQL = "(" + "CASE CAST(page_id % {n} AS INTEGER) ".format(n=N) + " ".join(
    f"WHEN {i} THEN '{s}'" for i, s in enumerate(RANKED)
) + " END)"


def sourced_pages(spark, sf):
    """Pages spread over the registered sources."""
    names = F.array(*[F.lit(s) for s in RANKED])
    return table(spark, sf, "pages").withColumn(
        "source", F.get(names, F.pmod("page_id", F.lit(N)).cast("int"))
    )


# gov, epi, nuffield, fft, fed, gtcs, children_in_scotland and teaching_council
# look for containers these pages lack; the rest read the article or the page
_LACKING = ("gov", "epi", "nuffield", "fft", "fed", "gtcs", "children_in_scotland", "teaching_council")
_NULL_TEXT = ("gov", "nuffield", "fft", "fed")
_OTHER_TITLE = ("gov", "epi", "nuffield", "fft", "fed")


def _in(names):
    return "(" + ", ".join(f"'{n}'" for n in names) + ")"


@query(
    "rule_extraction",
    f"WITH s AS (SELECT page_id, {PAGE_SOURCE_SQL} AS source, {TITLE_SQL} AS title, {text_sql(ARTICLE_SQL)} AS text FROM pages) "
    f"SELECT page_id, source, CASE WHEN source NOT IN {_in(_OTHER_TITLE)} THEN title END AS title, "
    f"CASE WHEN source IN {_in(_NULL_TEXT)} THEN NULL WHEN source IN {_in(_LACKING)} THEN md5('') "
    f"WHEN source = 'gov_ie' THEN md5({trim_sql('text')}) ELSE md5(text) END AS text FROM s",
)
def rule_extraction(spark, sf):
    return extraction.extract(sourced_pages(spark, sf)).select(
        "page_id", "source", "title", F.md5("text").alias("text")
    )


@query(
    "source_status",
    f"WITH {DIM_SQL}, s AS (SELECT {PAGE_SOURCE_SQL} AS source FROM pages), "
    f"g AS (SELECT source, count(*) AS n, sum(CASE WHEN source IN {_in(_LACKING)} THEN 0 ELSE 1 END) AS ok FROM s GROUP BY source) "
    "SELECT d.source, CAST(coalesce(n, 0) AS BIGINT) AS n_pages, CAST(coalesce(ok, 0) AS BIGINT) AS n_usable, "
    "CASE WHEN coalesce(n, 0) = 0 THEN 'empty' WHEN ok = 0 THEN 'failed' WHEN ok < n THEN 'partial' ELSE 'ok' END AS status "
    "FROM dim d LEFT JOIN g USING (source)",
)
def source_status(spark, sf):
    return quality.source_status(extraction.extract(sourced_pages(spark, sf)), rules.source_dim(spark))


LISTED_SQL = (
    "listed AS (SELECT page_id, url, CASE WHEN contains(url, '?') THEN NULL ELSE "
    "DATE '2024-01-01' + CAST(page_id % 700 AS INTEGER) END AS date, 'listed ' || page_id AS title FROM pages)"
)


def listing(spark, sf):
    """Every page as a listing item of its source; addresses with a query have no date."""
    day = F.date_add(F.lit("2024-01-01").cast("date"), F.pmod("page_id", F.lit(700)).cast("int"))
    return sourced_pages(spark, sf).select(
        "source",
        F.lit("all").alias("section"),
        F.floor(F.col("page_id") / 20).cast("int").alias("page"),
        F.pmod("page_id", F.lit(20)).cast("int").alias("pos"),
        "url",
        F.concat(F.lit("listed "), F.col("page_id").cast("string")).alias("title"),
        F.when(~F.contains("url", F.lit("?")), day).alias("date"),
    )


@query(
    "listing_pages",
    f"WITH {LISTED_SQL} SELECT l.url, l.title, CAST(l.date AS VARCHAR) AS date, "
    "CAST(CASE WHEN starts_with(p.url, 'https') THEN length(p.html) END AS BIGINT) AS n_chars FROM listed l JOIN pages p USING (url)",
)
def listing_pages(spark, sf):
    captured = table(spark, sf, "pages").filter(F.startswith("url", F.lit("https")))
    return extraction.join_pages(listing(spark, sf), captured).select(
        "url",
        F.col("listing_title").alias("title"),
        F.col("listing_date").cast("string").alias("date"),
        F.length("html").cast("long").alias("n_chars"),
    )


@query(
    "articles_from_listing",
    f"WITH {LISTED_SQL}, s AS (SELECT page_id, url, {PAGE_SOURCE_SQL} AS source, {text_sql(ARTICLE_SQL)} AS text FROM pages) "
    f"SELECT s.source, l.url, l.title, CAST(l.date AS VARCHAR) AS date, md5(CASE WHEN source IN {_in(_LACKING)} OR s.page_id % 6 = 0 THEN '' ELSE text END) AS text "
    f"FROM listed l JOIN s USING (url) WHERE source NOT IN ('gov', 'nuffield', 'fft', 'fed', 'gtcs', 'children_in_scotland', 'teaching_council') "
    "AND NOT (source = 'epi' AND date IS NULL) AND (date IS NULL OR date BETWEEN DATE '2024-02-01' AND DATE '2025-06-30') "
    f"AND (s.page_id % 6 <> 0 OR source = 'gov_scot') AND source NOT IN {_in(URL_RULES)}",
)
def articles_from_listing(spark, sf):
    # the pages state no dates themselves; a sixth was not captured; no address has a source's shape
    pages = table(spark, sf, "pages").filter("page_id % 6 <> 0")
    found = corpus.articles_from_listing(listing(spark, sf), pages, "2024-02-01", "2025-06-30")
    return found.select("source", "url", "title", F.col("date").cast("string").alias("date"), F.md5("text").alias("text"))


@query("listing_captures", ORACLE["articles_from_listing"])
def listing_captures(spark, sf):
    """Every page captured again later, with another text: one article per url all the same."""
    pages = table(spark, sf, "pages").filter("page_id % 6 <> 0")
    again = pages.withColumns({"page_id": F.col("page_id") + 10**9, "html": F.lit("<article><p>later</p></article>")})
    found = corpus.articles_from_listing(listing(spark, sf), again.unionByName(pages), "2024-02-01", "2025-06-30")
    return found.select("source", "url", "title", F.col("date").cast("string").alias("date"), F.md5("text").alias("text"))


@query(
    "gov_corpus",
    "SELECT url, CASE page_id % 4 WHEN 0 THEN 'Ofsted' WHEN 1 THEN 'Department for Education' END AS institution_name, "
    "'training' AS dataset_type, '2024-03-03' AS date FROM pages WHERE page_id % 4 < 2",
)
def gov_corpus(spark, sf):
    """Pages that name their publishers, from the html to routed articles: core bodies stay, under their name."""
    orgs = F.element_at(
        F.array(*[F.lit(x) for x in ("Ofsted", "Cabinet Office</a> and <a href='/b'>Department for Education", "Home Office", "")]),
        (F.col("page_id") % 4 + 1).cast("int"),
    )
    html = F.concat(
        F.lit("<main id='content'><h1 class='govuk-heading-l'>A paper</h1><dl><dt>From:</dt><dd><a href='/a'>"), orgs,
        F.lit("</a></dd><dt>Published:</dt><dd>3 March 2024</dd></dl><p>"), "url", F.lit("</p></main>"),
    )
    pages = table(spark, sf, "pages").select("url", F.lit("gov").alias("source"), html.alias("html"))
    found = extraction.usable(extraction.extract(pages))
    out = corpus.build([found], rules.source_dim(spark), runs(spark), rules.country_dim(spark))
    return out.select("url", "institution_name", "dataset_type", F.col("date").cast("string").alias("date"))


FLAGSHIP_SQL = (
    f"WITH x AS (SELECT page_id, regexp_extract(url, '^[a-z]+://([^/?#]+)', 1) AS host, {TITLE_SQL} AS title, "
    f"{text_sql(ARTICLE_SQL)} AS text FROM pages), "
    "l AS (SELECT *, lower(text) AS t FROM x WHERE text <> ''), "
    "s AS (SELECT *, " + ", ".join(
        "(" + " + ".join(f"CAST(contains(t, '{w}') AS INTEGER)" for w in words) + f") AS {lang}"
        for lang, words in {
            "fr": (" le ", " la ", " les ", " des ", " et ", " que ", " pour ", " dans "),
            "de": (" der ", " die ", " das ", " und ", " ist ", " von ", " nicht ", " sich "),
            "es": (" el ", " los ", " las ", " para ", " con ", " por ", " una ", " del "),
        }.items()
    ) + " FROM l), "
    "u AS (SELECT *, CASE WHEN fr >= 3 THEN fr ELSE 0 END AS f, CASE WHEN de >= 3 THEN de ELSE 0 END AS d, "
    "CASE WHEN es >= 3 THEN es ELSE 0 END AS e FROM s), "
    "g AS (SELECT page_id, host, title, CASE WHEN length(text) < 50 OR greatest(f, d, e) = 0 THEN 'en' "
    "WHEN f = greatest(f, d, e) THEN 'fr' WHEN d = greatest(f, d, e) THEN 'de' ELSE 'es' END AS language FROM u), "
    "k AS (SELECT *, row_number() OVER (PARTITION BY host, title ORDER BY page_id) AS rn FROM g), "
    "c AS (SELECT host, language, count(*) AS n FROM k WHERE rn = 1 GROUP BY host, language) "
    "SELECT host, language, n, round(n / sum(n) OVER (PARTITION BY host), 6) AS share FROM c"
)

# Terms per language of the given texts; English is the default.
LANGUAGES = {
    "fr": ([" le ", " la ", " les ", " des ", " et ", " que ", " pour ", " dans "], 3),
    "de": ([" der ", " die ", " das ", " und ", " ist ", " von ", " nicht ", " sich "], 3),
    "es": ([" el ", " los ", " las ", " para ", " con ", " por ", " una ", " del "], 3),
}


@query("language_share_by_host", FLAGSHIP_SQL)
def language_share_by_host(spark, sf):
    """Share of each language among a host's distinct, non-blank captured articles."""
    from corpusflow.operators import dedup, filters, reports

    h = F.col("html")
    return (
        table(spark, sf, "pages")
        .select("page_id", url_host(F.col("url")).alias("host"), "html")
        .transform(computed, title=H.title(h), text=H.join_blocks(page_blocks()))
        .drop("html")
        .transform(filters.drop_blank)
        .transform(filters.flag_language, LANGUAGES)
        .drop("text")
        .transform(dedup.dedup_first, ("host", "title"), ("page_id",))
        .transform(reports.shares, ("host",), "language")
        .withColumn("share", F.round("share", 6))
    )
