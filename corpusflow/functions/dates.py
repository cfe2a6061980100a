"""Date functions. All return NULL, never an error, on text that is no date."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from .html import meta_pairs_sql
from .sql import apply, lam, lit
from .text import plain, plain_sql, trim_sql, trim_ws

_LONG = "January|February|March|April|May|June|July|August|September|October|November|December"
_SHORT = "Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Oct|Nov|Dec"

# Patterns for a date inside running text; group 1 is the date.
DAY_MONTH = f"(?i)\\b([0-9]{{1,2}}\\s+(?:{_LONG})\\s+[0-9]{{4}})\\b"
DAY_SHORT_MONTH = f"(?i)([0-9]{{1,2}}\\s+(?:{_SHORT})\\s+[0-9]{{4}})"
EITHER_ORDER = (
    f"(?i)((?:{_LONG})\\s+[0-9]{{1,2}},?\\s+[0-9]{{4}}|[0-9]{{1,2}}\\s+(?:{_LONG})\\s+[0-9]{{4}})"
)
DAY_WORD = "([0-9]{1,2}\\s+\\w+\\s+[0-9]{4})"
# For dates inside a sentence whose wording is not known beforehand.
ANY_FORM = (
    f"(?i)((?:{_LONG}|{_SHORT})\\.?\\s+[0-9]{{1,2}}(?:st|nd|rd|th)?,?\\s+[0-9]{{4}}"
    f"|[0-9]{{1,2}}(?:st|nd|rd|th)?\\s+(?:{_LONG}|{_SHORT})\\.?,?\\s+[0-9]{{4}}"
    "|[0-9]{4}-[0-9]{2}-[0-9]{2})"
)

_WRITTEN = ("d MMMM yyyy", "MMMM d yyyy", "d MMM yyyy", "MMM d yyyy", "yyyy-MM-dd")


def parse_date(c: Column, formats) -> Column:
    """First format that fits, else NULL."""
    if len(formats) == 1:
        return F.try_to_date(c, formats[0])

    def tries(v):
        return "coalesce(" + ", ".join(f"try_to_date({v}, {lit(f)})" for f in formats) + ")"

    return apply(c, tries)


def strip_ordinal(c: Column) -> Column:
    """"21st March" to "21 March"."""
    return F.regexp_replace(c, "(\\d+)(st|nd|rd|th)", "$1")


def _tidy(c: Column) -> Column:
    return trim_ws(F.regexp_replace(F.translate(c, ",.", ""), "\\s+", " "))


def find_date(c: Column, pattern: str = EITHER_ORDER, formats=_WRITTEN) -> Column:
    """First date found in free text; a match that is no real date gives NULL."""
    return parse_date(_tidy(F.regexp_extract(c, pattern, 1)), formats)


def fuzzy_date(c: Column) -> Column:
    """A date in a sentence, in any of the usual written forms."""
    return parse_date(_tidy(strip_ordinal(F.regexp_extract(c, ANY_FORM, 1))), _WRITTEN)


def iso_date(c: Column) -> Column:
    """Calendar date of an ISO timestamp as written; the offset shifts nothing."""
    return F.try_to_date(F.substr(c, F.lit(1), F.lit(10)), "yyyy-MM-dd")


def iso10(c: Column) -> Column:
    """First ten characters of a timestamp, or a date as yyyy-MM-dd text."""
    return F.substr(c.cast("string"), F.lit(1), F.lit(10))


def url_date(c: Column) -> Column:
    """Date from a URL path such as /2026/0312/."""
    return F.try_to_date(F.regexp_extract(c, "/([0-9]{4}/[0-9]{4})/", 1), "yyyy/MMdd")


def _first_written(dates: str) -> str:
    return f"get(filter({dates}, d -> d IS NOT NULL), 0)"


def labelled_date(html: Column, labels=("published:", "updated:")) -> Column:
    """First value under one of the labels that is a date."""
    names = ", ".join(lit(x) for x in labels)

    def first(v):
        wanted = f"filter({meta_pairs_sql(v, labels)}, m -> m.label IN ({names}))"
        parsed = lam(lambda p: f"try_to_date({plain_sql(f'{p}.value', ' ')}, 'd MMMM yyyy')")
        return _first_written(f"transform({wanted}, {parsed})")

    return apply(html, first)


def published_block(html: Column, attr: str) -> Column:
    """Date of the first "Published ... / Updated ..." block that is a date."""
    block = lit(f"(?is)<div\\s[^>]*{attr}[^>]*>(.*?)</div>")

    def parsed(b):
        text = f"replace(replace({plain_sql(b, ' ')}, 'Published', ''), 'Updated', '')"
        return f"try_to_date({trim_sql(text)}, 'd MMMM yyyy')"

    return apply(
        html, lambda v: _first_written(f"transform(regexp_extract_all({v}, {block}, 1), {lam(parsed)})")
    )


def time_tag(html: Column) -> Column:
    """Date of the first <time datetime="...">."""
    return iso_date(F.regexp_extract(html, "(?is)<time\\s[^>]*datetime\\s*=\\s*[\"']([^\"']*)", 1))


def meta_published(html: Column) -> Column:
    """Date of <meta property="article:published_time" content="...">, attributes in either order."""
    one = F.regexp_extract(
        html, "(?is)<meta\\s[^>]*property\\s*=\\s*[\"']article:published_time[\"'][^>]*>", 0
    )
    return iso_date(F.regexp_extract(one, "(?is)content\\s*=\\s*[\"']([^\"']*)", 1))


def first_date(*cols: Column) -> Column:
    """First date source that has a value."""
    return F.coalesce(*cols)
