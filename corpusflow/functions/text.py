"""Text and HTML fragment functions. Each is Column -> Column and runs in the JVM."""

from functools import reduce
from html.entities import name2codepoint

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .sql import TO_END, apply, bind, lam, lit

# Characters that count as white space when text is stripped: Unicode's own
# set, which is wider than the single ASCII space Spark's trim() removes.
WHITESPACE = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())

# The same set as a regex character class body, valid for Java and RE2. Runs of
# neighbouring characters are written as ranges, which match faster.
_STARTS = [c for c in WHITESPACE if chr(ord(c) - 1) not in WHITESPACE]
_STOPS = [c for c in WHITESPACE if chr(ord(c) + 1) not in WHITESPACE]
WS_CLASS = "".join(
    f"\\x{{{ord(a):X}}}-\\x{{{ord(b):X}}}" for a, b in zip(_STARTS, _STOPS, strict=True)
)

# Names and letters of HTML entities, from the standard library's table.
_NAMED = {**{n: chr(c) for n, c in name2codepoint.items()}, "apos": "'"}


def computed(df: DataFrame, **columns: Column) -> DataFrame:
    """Add costly columns as a one-row inline.

    A later filter on a projected column is pushed below the projection, which
    repeats the expression in the filter. It stops at a generator, so the columns
    are computed once per row.
    """
    rest = [c for c in df.columns if c not in columns]
    made = F.struct(*[c.alias(name) for name, c in columns.items()])
    return df.select(*rest, F.inline(F.array(made)))


def trim_ws(c: Column) -> Column:
    return F.btrim(c, F.lit(WHITESPACE))


def is_blank(c: Column) -> Column:
    return F.coalesce(trim_ws(c) == "", F.lit(True))


def contains_any_sql(x: str, terms) -> str:
    return "(" + (" OR ".join(f"contains({x}, {lit(t)})" for t in terms) or "false") + ")"


def contains_any(c: Column, terms) -> Column:
    """True where any term is a substring; no word boundaries. False without terms."""
    return apply(c, lambda v: contains_any_sql(v, terms))


def count_present_sql(x: str, terms) -> str:
    """How many of the terms occur at least once."""
    return "(" + " + ".join(f"CAST(contains({x}, {lit(t)}) AS INT)" for t in terms) + ")"


def trim_sql(x: str) -> str:
    return f"btrim({x}, {lit(WHITESPACE)})"


def decode_sql(x: str) -> str:
    """Each entity decoded once, by number (any code point) or by name; others stay as they are."""
    # "a&#8217;b" splits into "a" and "#8217;b"
    rx = lit("(?s)^(#[xX][0-9A-Fa-f]{1,12}|#[0-9]{1,12}|[A-Za-z][A-Za-z0-9]{1,31});(.*)$")
    names = lit("\u0001".join(f"{n}\u0002{c}" for n, c in _NAMED.items()))
    table = f"str_to_map({names}, '\u0001', '\u0002')"

    def decoded(piece):
        rest, raw = f"regexp_extract({piece}, {rx}, 2)", f"concat('&', {piece})"

        def char(n):
            valid = f"{n} BETWEEN 1 AND 55295 OR {n} BETWEEN 57344 AND 1114111"
            return f"CASE WHEN {valid} THEN concat(decode(unhex(lpad(hex({n}), 8, '0')), 'UTF-32'), {rest}) ELSE {raw} END"

        def known(code):
            number = (
                f"CASE WHEN lower(substr({code}, 2, 1)) = 'x' THEN try_cast(conv(substr({code}, 3), 16, 10) AS BIGINT) "
                f"ELSE try_cast(substr({code}, 2) AS BIGINT) END"
            )
            return (
                f"CASE WHEN {code} = '' THEN {raw} WHEN startswith({code}, '#') THEN {bind(number, char)} "
                f"ELSE coalesce(concat(try_element_at({table}, {code}), {rest}), {raw}) END"
            )

        return bind(f"regexp_extract({piece}, {rx}, 1)", known)

    def body(v):
        joined = bind(
            f"split({v}, '&')",
            lambda p: f"concat({p}[0], array_join(transform(slice({p}, 2, {TO_END}), {lam(decoded)}), ''))",
        )
        return f"CASE WHEN contains({v}, '&') THEN {joined} ELSE {v} END"

    return bind(x, body)


def drop_tags_sql(x: str, sep: str) -> str:
    # text nodes lie between tags; each is decoded and stripped, blank ones go, the rest are joined
    nodes = f"split({x}, '<[^>]*>')"
    stripped = f"transform({nodes}, {lam(lambda n: trim_sql(decode_sql(n)))})"
    return f"array_join(filter({stripped}, n -> n <> ''), {lit(sep)})"


def plain_sql(x: str, sep: str = "") -> str:
    return trim_sql(drop_tags_sql(x, sep))


def decode_entities(c: Column) -> Column:
    return apply(c, decode_sql)


def plain(c: Column, sep: str = "") -> Column:
    """Text of an HTML fragment: tags dropped, entities decoded, ends stripped."""
    return apply(c, lambda v: plain_sql(v, sep))


def strip_literals_sql(x: str, literals) -> str:
    return reduce(lambda acc, s: trim_sql(f"replace({acc}, {lit(s)}, '')"), literals, x)


def strip_literals(c: Column, literals) -> Column:
    """Remove literal strings, stripping the ends after each."""
    return apply(c, lambda v: strip_literals_sql(v, literals))


def first_present(*cols: Column) -> Column:
    """First column that is not blank, else NULL."""
    picks = [apply(c, lambda v: f"CASE WHEN {trim_sql(v)} <> '' THEN {v} END") for c in cols]
    return F.coalesce(*picks)
