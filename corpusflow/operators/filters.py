"""Row filters and language flags. Narrow: no shuffle, no Python worker."""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import rules
from ..functions.sql import apply, bind, lit
from ..functions.text import computed, contains_any, contains_any_sql, count_present_sql, is_blank


def drop_blank(df: DataFrame, col: str = "text") -> DataFrame:
    """Drop rows whose text is NULL or only Unicode white space."""
    return df.filter(~is_blank(F.col(col)))


def drop_keyless(df: DataFrame, key: str = "url") -> DataFrame:
    return df.filter(F.col(key).isNotNull() & (F.col(key) != ""))


def is_title_rejected(title: Column, exclude=None, include=None) -> Column:
    """Has an exclude term and no include term. Substrings, any case; a NULL title passes."""
    exclude = rules.TITLE_EXCLUDE if exclude is None else exclude
    include = rules.TITLE_INCLUDE if include is None else include
    return apply(
        F.lower(F.coalesce(title, F.lit(""))),
        lambda t: f"{contains_any_sql(t, exclude)} AND NOT {contains_any_sql(t, include)}",
    )


def title_filter(df: DataFrame, exclude=None, include=None, col: str = "title") -> DataFrame:
    return df.filter(~is_title_rejected(F.col(col), exclude, include))


def title_rejects(
    df: DataFrame, order, n: int | None = 10, exclude=None, include=None, col: str = "title"
) -> DataFrame:
    """The first n rows the title filter removes, in the given total order; all with n=None."""
    rejected = df.filter(is_title_rejected(F.col(col), exclude, include)).orderBy(*order)
    return rejected if n is None else rejected.limit(n)


def skip_titles(df: DataFrame, patterns, col: str = "title") -> DataFrame:
    """Drop administrative titles."""
    lowered = F.lower(F.coalesce(F.col(col), F.lit("")))
    return df.filter(~contains_any(lowered, patterns))


def skip_titles_by_source(df: DataFrame, by_source=None, col: str = "title") -> DataFrame:
    """Drop each source's own administrative titles; sources without a list keep all."""
    by_source = rules.SKIP_TITLES if by_source is None else by_source
    lowered = F.lower(F.coalesce(F.col(col), F.lit("")))
    hits = [(F.col("source") == s) & contains_any(lowered, patterns) for s, patterns in by_source.items()]
    return df.filter(~F.coalesce(reduce(lambda a, b: a | b, hits), F.lit(False))) if hits else df


def url_shapes(df: DataFrame, by_source, col: str = "url") -> DataFrame:
    """Keep urls that look like an article of their source; sources without a pattern keep all."""
    misses = [(F.col("source") == s) & ~F.rlike(F.col(col), F.lit(rx)) for s, rx in by_source.items()]
    return df.filter(~F.coalesce(reduce(lambda a, b: a | b, misses), F.lit(False))) if misses else df


def date_range(df: DataFrame, since=None, until=None, col: str = "date") -> DataFrame:
    """Both ends included, either may be left open. A NULL date passes (see null_dates)."""
    tests = []
    if since is not None:
        tests.append(F.col(col) >= F.lit(since).cast("date"))
    if until is not None:
        # a timestamp on the last day is inside as well
        tests.append(F.col(col) < F.date_add(F.lit(until).cast("date"), 1))
    return df.filter(F.col(col).isNull() | reduce(lambda a, b: a & b, tests)) if tests else df


def null_dates(df: DataFrame, policy: str = "keep", col: str = "date") -> DataFrame:
    if policy not in ("keep", "drop"):
        raise ValueError(f"policy must be keep or drop, not {policy!r}")
    return df if policy == "keep" else df.filter(F.col(col).isNotNull())


def null_dates_by_source(df: DataFrame, extract_rules=None, col: str = "date") -> DataFrame:
    """Each source's own policy for articles without a date."""
    extract_rules = rules.EXTRACT if extract_rules is None else extract_rules
    dropping = [s for s, r in extract_rules.items() if r.on_null_date == "drop"]
    return df.filter(F.col(col).isNotNull() | ~F.col("source").isin(dropping))


def url_filter(df: DataFrame, pattern: str, col: str = "url") -> DataFrame:
    return df.filter(F.rlike(F.col(col), F.lit(pattern)))


def _words(terms) -> list:
    """Terms of the form " word ", which can be looked up among a text's pieces."""
    return [t for t in terms if t.startswith(" ") and t.endswith(" ") and len(t) > 2 and " " not in t[1:-1]]


def _array_sql(items) -> str:
    return "array(" + ", ".join(lit(x) for x in items) + ")"


def _present_sql(text: str, found: str, terms) -> str:
    """How many terms occur, given the words found in the text; other terms are searched for."""
    words = _words(terms)
    rest = [t for t in terms if t not in words]
    parts = []
    if words:
        parts.append(f"size(array_intersect({found}, {_array_sql(w[1:-1] for w in words)}))")
    if rest:
        parts.append(count_present_sql(text, rest))
    return " + ".join(parts)


def language(
    text: Column, lists=None, min_chars: int = rules.LANGUAGE_MIN_CHARS, default: str = "en"
) -> Column:
    """Language whose term list reaches its threshold.

    ``lists`` maps a language to (terms, threshold). A term counts once however
    often it occurs. Texts shorter than ``min_chars`` get the default (the sources' own rule). Where
    several lists reach their threshold the one with most terms present wins,
    the first named on a tie.
    """
    lists = {"ga": (rules.IRISH_TERMS, rules.IRISH_THRESHOLD)} if lists is None else lists
    names = _array_sql(lists)
    wanted = _array_sql(dict.fromkeys(w[1:-1] for terms, _ in lists.values() for w in _words(terms)))

    def reached(t, found):
        return ", ".join(
            bind(_present_sql(t, found, terms), lambda v, n=need: f"CASE WHEN {v} >= {n} THEN {v} ELSE 0 END")
            for terms, need in lists.values()
        )

    def best(scores):
        top = f"array_max({scores})"
        return f"CASE WHEN {top} > 0 THEN element_at({names}, CAST(array_position({scores}, {top}) AS INT)) ELSE {lit(default)} END"

    def pick(t):
        # the words between two spaces that any list asks for, in one pass; the
        # first and last piece of the text lack one of the spaces
        inner = bind(f"split({t}, ' ')", lambda w: f"slice({w}, 2, greatest(size({w}) - 2, 0))")
        return bind(f"array_intersect({inner}, {wanted})", lambda w: bind(f"array({reached(t, w)})", best))

    # a NULL text has no length; it gets the default as well
    short = F.coalesce(F.length(text), F.lit(0)) < min_chars
    return F.when(short, default).otherwise(apply(F.lower(text), pick))


def flag_language(df: DataFrame, lists=None, col: str = "text", **options) -> DataFrame:
    return computed(df, language=language(F.col(col), lists, **options))
