"""Link and listing functions over captured HTML."""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import dates
from .sql import TO_END
from .text import decode_entities, plain, trim_ws

_ANCHOR = "(?is)<a\\s[^>]*href\\s*=\\s*[\"'][^\"']*[\"'][^>]*>.*?</a>"
_HREF = "(?is)href\\s*=\\s*[\"']([^\"']*)[\"']"
_INNER = "(?is)^<a\\s[^>]*>(.*)</a>$"


def _href(c: Column) -> Column:
    return trim_ws(decode_entities(F.regexp_extract(c, _HREF, 1)))


def links(df: DataFrame, html: str = "html", keys=("page_id",)) -> DataFrame:
    """One row per link: keys, pos (0-based order in the page), href, anchor text."""
    anchors = F.regexp_extract_all(F.col(html), F.lit(_ANCHOR), F.lit(0))
    return df.select(*keys, F.posexplode(anchors).alias("pos", "_a")).select(
        *keys,
        "pos",
        _href(F.col("_a")).alias("href"),
        plain(F.regexp_extract("_a", _INNER, 1)).alias("anchor"),
    )


def absolute(c: Column, base) -> Column:
    """Prefix the base to a link that is not absolute."""
    base = base if isinstance(base, Column) else F.lit(base)
    return F.when(F.startswith(c, F.lit("http")), c).otherwise(F.concat(base, c))


def url_host(c: Column) -> Column:
    return F.regexp_extract(c, "^[a-zA-Z]+://([^/?#]+)", 1)


def path_parts(c: Column) -> Column:
    """Segments of a URL's path, outer slashes stripped."""
    path = F.regexp_extract(c, "^[a-zA-Z]+://[^/?#]*([^?#]*)", 1)
    return F.split(F.btrim(path, F.lit("/")), "/")


def distinct_links(df: DataFrame, keys=("page_id",)) -> DataFrame:
    """Each link of a page once, at its first position."""
    return df.groupBy(*keys, "href").agg(F.min("pos").alias("pos"))


# Anchor texts that lead to the following listing page.
NEXT_TEXTS = ["next", "next page", "›", "»", "next ›"]
# Wrappers whose first link leads to the following listing page.
NEXT_WRAPPERS = ["govuk-pagination__next", "next-page"]


def next_page(html: Column) -> Column:
    """Link to the following listing page, NULL on the last one.

    Tried in order: a link inside a known wrapper, a link whose text says so,
    the first link after the marked current page number.
    """
    wrapped = [
        F.regexp_extract(
            html,
            f"(?is)<(?:li|div)\\s[^>]*class\\s*=\\s*[\"'][^\"']*{w}[^\"']*[\"'][^>]*>"
            "[^<]*<a\\s[^>]*href\\s*=\\s*[\"']([^\"']*)",
            1,
        )
        for w in NEXT_WRAPPERS
    ]
    anchors = F.regexp_extract_all(html, F.lit(_ANCHOR), F.lit(0))
    by_text = _href(
        F.get(
            F.filter(
                anchors, lambda a: F.lower(plain(F.regexp_extract(a, _INNER, 1))).isin(*NEXT_TEXTS)
            ),
            F.lit(0),
        )
    )
    numbered = F.regexp_extract(
        html,
        "(?is)<span\\s[^>]*class\\s*=\\s*[\"'][^\"']*current[^\"']*[\"'][^>]*>.*?"
        "<a\\s[^>]*href\\s*=\\s*[\"']([^\"']*)",
        1,
    )
    tries = [F.nullif(trim_ws(c), F.lit("")) for c in (*wrapped, by_text, numbered)]
    return F.coalesce(*tries)


@dataclass(frozen=True)
class CardRule:
    """How one listing marks its cards. Patterns with one group, read inside a card."""

    start: str
    url: str
    title: str
    date: str


# The three card layouts.
CARD_RULES = {
    "data_attributes": CardRule(
        start="(?i)<div\\s[^>]*class\\s*=\\s*[\"'](?:[^\"'>]*\\s)?gi-card(?:\\s[^\"'>]*)?[\"']",
        url=_HREF,
        title="(?is)data-title\\s*=\\s*\"([^\"]*)\"",
        date="(?is)data-createdat\\s*=\\s*\"([^\"]*)\"",
    ),
    "search_result": CardRule(
        start="(?i)<li\\s[^>]*class\\s*=\\s*[\"'](?:[^\"'>]*\\s)?ds_search-result(?:\\s[^\"'>]*)?[\"']",
        url="(?is)<a\\s[^>]*href\\s*=\\s*[\"']([^\"']*)",
        title="(?is)<a\\s[^>]*>(.*?)</a>",
        date="(?is)<dd(?:\\s[^>]*)?>(.*?)</dd>",
    ),
    "card_link": CardRule(
        start="(?i)<a\\s[^>]*class\\s*=\\s*[\"'](?:[^\"'>]*\\s)?card-item__container(?:\\s[^\"'>]*)?[\"']",
        url=_HREF,
        title="(?is)<h3(?:\\s[^>]*)?>(.*?)</h3>",
        date="(?is)<time\\s[^>]*datetime\\s*=\\s*[\"']([^\"']*)",
    ),
}

_CARD = "\u0001"


def cards(df: DataFrame, rule: CardRule, html: str = "html", keys=("page_id",)) -> DataFrame:
    """One row per listing card: keys, pos, url as written, title, date."""
    # the start tag's own attributes belong to the card, so keep them in the piece
    marked = F.regexp_replace(F.translate(F.col(html), _CARD, ""), f"({rule.start})", _CARD + "$1")
    pieces = F.split(marked, _CARD)
    # the first of all places that holds a date

    def read(raw):
        text = plain(raw, " ")
        return F.coalesce(dates.iso_date(text), dates.find_date(text, dates.DAY_WORD))

    found = F.transform(F.regexp_extract_all("_c", F.lit(rule.date), F.lit(1)), read)
    return (
        df.select(*keys, F.posexplode(F.slice(pieces, F.lit(2), F.lit(TO_END))).alias("pos", "_c"))
        .select(
            *keys,
            "pos",
            _first_attr(F.col("_c"), rule.url).alias("url"),
            plain(F.regexp_extract("_c", rule.title, 1)).alias("title"),
            F.get(F.filter(found, lambda d: d.isNotNull()), F.lit(0)).alias("date"),
        )
    )


def _first_attr(c: Column, pattern: str) -> Column:
    return trim_ws(decode_entities(F.regexp_extract(c, pattern, 1)))


def link_dates(df: DataFrame, html: str = "html", keys=("page_id",)) -> DataFrame:
    """Links with the date written in the same block: keys, pos, href, date.

    A block starts at each list item, division or article tag.
    """
    pieces = F.split(
        F.regexp_replace(
            F.translate(F.col(html), _CARD, ""), "(?i)<(?:li|div|article)(?:\\s[^>]*)?>", _CARD
        ),
        _CARD,
    )
    return (
        df.select(*keys, F.posexplode(pieces).alias("pos", "_b"))
        .select(
            *keys,
            "pos",
            _href(F.col("_b")).alias("href"),
            dates.find_date(plain(F.col("_b"), " "), dates.DAY_MONTH).alias("date"),
        )
        .filter(F.col("href") != "")
    )


# What a source's article links look like.
URL_RULES = {
    "rte": "/news/.*?/[0-9]{4}/[0-9]{4}/[0-9]+-",
    "thejournal": "-[0-9]{5,}-\\w{3}[0-9]{4}",
    "fft": "^https://ffteducationdatalab\\.org\\.uk/20[^/]*/[^/]+/[^/?#]+",
    "esri": "^https://www\\.esri\\.ie/(?:news|publications)/[^?]+$",
    "gtcs": "/news/news-and-updates/",
}
