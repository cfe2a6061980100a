"""Rule-driven extraction of title, date and text from captured pages.

All sources are handled by one projection. A step is a CASE over the distinct
settings of that step, not over sources, so the plan stays small as sources are
added; a row evaluates its own branch only.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import rules
from ..functions import dates, html as H
from ..functions.sql import apply, bind, lit
from ..functions.text import (
    computed, drop_tags_sql, first_present, is_blank, plain, plain_sql, strip_literals_sql,
)

_BLOCKS = "ARRAY<STRUCT<tag: STRING, text: STRING>>"


def _choose(extract_rules: dict, setting, build, otherwise: str) -> str:
    """CASE WHEN source IN .. THEN build(setting): one branch per distinct setting.

    Settings that build the same text as the default need no branch.
    """
    groups = {}
    for source, rule in extract_rules.items():
        groups.setdefault(setting(rule), []).append(source)
    branches = ""
    for value, sources in groups.items():
        built = build(value)
        if built != otherwise:
            names = ", ".join(lit(s) for s in sources)
            branches += f" WHEN source IN ({names}) THEN {built}"
    return f"CASE{branches} ELSE {otherwise} END" if branches else otherwise


def text_of(html: Column, extract_rules=None, visible: bool = False) -> Column:
    """Text that the rule of the row's source selects; a page is reduced to what is visible unless it is already.

    A captured page without the wanted container has "" as text, or NULL where the
    rule says that such a page is no article. A page that was not captured has NULL,
    or "" where the source's listing alone makes an article.
    """
    use = rules.EXTRACT if extract_rules is None else extract_rules

    def stop(v, c):
        stops, tag, phrases, prefix = v
        kept = H.cut_at_sql(c, stops, tag, ignore_case=tag is not None) if stops else c
        return H.skip_blocks_sql(kept, phrases, prefix)

    steps = [
        lambda c: _choose(use, lambda r: r.containers, lambda v: H.container_sql(c, v), "CAST(NULL AS STRING)"),
        lambda c: _choose(use, lambda r: r.drop, lambda v: H.drop_element_sql(c, *v) if v else c, c),
        lambda c: _choose(use, lambda r: r.removed, lambda v: H.strip_tags_sql(c, v), c),
        # the three parts of H.blocks, so that each is written out once per setting
        lambda c: _choose(use, lambda r: r.elements, lambda v: H.mark_sql(c, v), c),
        lambda c: _choose(use, lambda r: r.sep, lambda v: drop_tags_sql(c, v), c),
        lambda c: _choose(
            use,
            lambda r: ("li" in r.elements, r.sep if "li" in r.elements else ""),
            lambda v: H.split_sql(c, ("li",) if v[0] else (), v[1]),
            f"CAST(NULL AS {_BLOCKS})",
        ),
        lambda c: _choose(
            use, lambda r: (r.stops, r.stop_tag, r.skip_phrases, r.skip_prefix), lambda v: stop(v, c), c
        ),
        lambda c: _choose(use, lambda r: r.joiner, lambda v: H.join_blocks_sql(c, v), "CAST(NULL AS STRING)"),
        lambda c: _choose(use, lambda r: r.literals, lambda v: strip_literals_sql(c, v), c),
    ]

    def chain(v):
        for step in steps if visible else [H.visible_sql, *steps]:
            v = bind(v, step)
        return v

    lenient = [s for s, r in use.items() if r.allow_missing]
    listed = [s for s, r in use.items() if r.keep_uncaptured]
    empty = F.when(F.when(html.isNull(), F.col("source").isin(listed)).otherwise(F.col("source").isin(lenient)), "")
    return F.coalesce(apply(html, chain), empty)


def with_text(df: DataFrame, extract_rules=None, html: str = "html", to: str = "text") -> DataFrame:
    """Replace the html column by the text its source's rule selects."""
    return computed(df, **{to: text_of(F.col(html), extract_rules)}).drop(html)


def page_title(extract_rules=None, html: str = "html") -> Column:
    """Heading that the rule of the row's source names, of a visible page."""
    use = rules.EXTRACT if extract_rules is None else extract_rules

    def pick(v):
        return plain_sql(_choose(use, lambda r: r.title, lambda t: H.heading_sql(v, *t), "CAST(NULL AS STRING)"))

    return apply(F.col(html), pick)


def _page_text(page: Column) -> Column:
    return plain(page, " ")


def _inner(page: Column, tag: str, attr: str | None = None) -> Column:
    start = f"(?is)<{tag}(?:\\s[^>]*)?>" if attr is None else f"(?is)<{tag}\\s[^>]*{attr}[^>]*>"
    return plain(F.regexp_extract(page, f"{start}(.*?)</{tag}\\s*>", 1))


def page_date(html: str = "html", url: str = "url", visible: bool = False) -> Column:
    """Publication date as each source's pages state it; NULL where they do not."""
    p = F.col(html) if visible else H.visible(F.col(html))
    by_source = {
        "gov": dates.first_date(
            dates.labelled_date(p),
            dates.published_block(p, H.class_attr("gem-c-published-dates")),
            dates.find_date(_page_text(p), dates.DAY_MONTH),
        ),
        "epi": dates.parse_date(
            dates.strip_ordinal(_inner(p, "div", H.class_attr("single-title-date"))), ["d MMMM yyyy"]
        ),
        "fft": dates.fuzzy_date(
            plain(F.coalesce(H.element(p, "div", H.class_attr("fusion-meta-info-wrapper")), F.lit("")), " ")
        ),
        "fed": dates.parse_date(_inner(p, "time"), ["MMMM d, yyyy"]),
        "nuffield": dates.first_date(
            dates.fuzzy_date(_inner(p, "p", H.class_attr("article-meta"))),
            dates.fuzzy_date(
                plain(
                    F.regexp_extract(
                        p, f"(?is)<ul\\s[^>]*{H.class_attr('list-items')}[^>]*>.*?<li[^>]*>(.*?)</li>", 1
                    )
                )
            ),
        ),
        "esri": dates.find_date(_page_text(p), dates.EITHER_ORDER),
        "children_in_scotland": dates.parse_date(
            _inner(p, "div", H.class_attr("simple-hero__body-meta")),
            ["d MMM, yyyy", "d MMMM, yyyy", "d MMM yyyy", "d MMMM yyyy"],
        ),
        "thejournal": dates.first_date(
            dates.time_tag(p), dates.find_date(_page_text(p), dates.DAY_SHORT_MONTH)
        ),
        "rte": dates.first_date(
            dates.time_tag(p), dates.meta_published(p), dates.url_date(F.col(url))
        ),
    }
    out = None
    for source, expr in by_source.items():
        test = F.col("source") == source
        out = F.when(test, expr) if out is None else out.when(test, expr)
    return out


def extract(pages: DataFrame, extract_rules=None) -> DataFrame:
    """pages(source, url, html, ...) to title, date and text; html is dropped.

    A listing's title and date, where given as listing_title and listing_date,
    come before what the page says. ``from`` holds the publishing organisations
    where the source's pages name them.
    """
    use = rules.EXTRACT if extract_rules is None else extract_rules
    pages = computed(pages, html=H.visible(F.col("html")))
    title, date = page_title(use), page_date(visible=True)
    if "listing_title" in pages.columns:
        title = H.pick_title(F.col("listing_title"), title)
    if "listing_date" in pages.columns:
        date = F.coalesce("listing_date", date)
    names = F.array_join(H.meta_list(F.col("html"), "from:"), ", ")
    publishers = F.when(F.col("source").isin(rules.WITH_PUBLISHERS), F.nullif(names, F.lit("")))
    found = computed(pages, title=title, date=date, text=text_of(F.col("html"), use, visible=True), **{"from": publishers})
    return found.drop("html", "listing_title", "listing_date")


def usable(df: DataFrame, need_title=None, drop_blank=None) -> DataFrame:
    """Leave out pages that are no articles under their source's rule."""
    need_title = rules.NEED_TITLE if need_title is None else need_title
    blank = rules.DROP_BLANK_TEXT if drop_blank is None else drop_blank
    source = F.col("source")
    return df.filter(
        F.col("text").isNotNull()
        & ~(source.isin(need_title) & F.col("title").isNull())
        & ~(source.isin(blank) & is_blank(F.col("text")))
    ).withColumn("title", F.coalesce("title", F.lit("")))


def text_fallback(df: DataFrame, page: str = "page_text", api: str = "api_text") -> DataFrame:
    """Page text, else feed text; rows with neither are dropped."""
    return (
        computed(df, text=first_present(F.col(page), F.col(api)))
        .filter(F.col("text").isNotNull())
        .drop(page, api)
    )


def join_pages(listing: DataFrame, pages: DataFrame) -> DataFrame:
    """Listing items with their captured page: title and date from the listing.

    The listing is expected with one row per url (dedup_scope); pages too.
    """
    return listing.withColumnsRenamed({"title": "listing_title", "date": "listing_date"}).join(
        pages.select("url", "html"), "url", "left"
    )
