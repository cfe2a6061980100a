"""Registry, shared stand-ins for corpus tables, and their SQL twins."""

import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusflow import rules
from corpusflow.functions.text import WHITESPACE

# Entities of the given pages, for SQL that replaces one after the other.
ENTITIES = [
    ("&nbsp;", "\u00a0"), ("&copy;", "©"), ("&middot;", "·"), ("&quot;", '"'), ("&apos;", "'"), ("&lt;", "<"),
    ("&gt;", ">"), ("&ndash;", "–"), ("&mdash;", "—"), ("&hellip;", "…"), ("&pound;", "£"), ("&euro;", "€"), ("&amp;", "&"),
]

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query under a name, with the SQL that gives the same rows."""

    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return add


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def day(c) -> Column:
    """Dates are compared as text."""
    return F.date_format(c, "yyyy-MM-dd")


def flag(c: Column) -> Column:
    return c.cast("int")


# ---- articles: documents as articles of the registered sources -------------

# documents' sources in the order of the registry; the last two stay unregistered
RANKED = [r[0] for r in sorted(rules.SOURCES, key=lambda r: rules.COUNTRY_ORDER.index(r[1]))]
SOURCE_OF = {f"src{i}": s for i, s in enumerate(RANKED)}


def articles(spark: SparkSession, sf: str) -> DataFrame:
    """doc_id, url, title (first line), date, text, source, lang."""
    names = F.create_map(*[F.lit(x) for pair in SOURCE_OF.items() for x in pair])
    return table(spark, sf, "documents").select(
        "doc_id",
        F.concat(F.lit("https://"), "source", F.lit(".example.org/"), F.col("doc_id").cast("string")).alias("url"),
        F.substring_index("text", "\n", 1).alias("title"),
        F.date_add(F.lit("2023-01-01").cast("date"), F.pmod(F.col("doc_id") * 37, F.lit(1185)).cast("int")).alias("date"),
        "text",
        F.coalesce(F.try_element_at(names, F.col("source")), F.col("source")).alias("source"),
        "lang",
    )


def values_sql(rows, columns: str) -> str:
    def lit(v):
        return "NULL" if v is None else str(v) if isinstance(v, (int, float)) else "'" + v.replace("'", "''") + "'"

    body = ", ".join("(" + ", ".join(lit(v) for v in r) + ")" for r in rows)
    return f"(VALUES {body}) AS t({columns})"


DIM_SQL = "dim AS (SELECT * FROM " + values_sql(
    [
        (i, *r)
        for i, r in enumerate(sorted(rules.SOURCES, key=lambda r: rules.COUNTRY_ORDER.index(r[1])))
    ],
    "ordinal, source, country, type, institution_name",
) + ")"

COUNTRY_SQL = "countries AS (SELECT country, folder, CAST(start AS DATE) AS start, CAST(millions AS DOUBLE) AS millions FROM " + values_sql(
    rules.COUNTRIES, "country, folder, start, millions"
) + ")"

ARTICLES_SQL = (
    "articles AS (SELECT doc_id, 'https://' || d.source || '.example.org/' || doc_id AS url, "
    "string_split(text, chr(10))[1] AS title, "
    "CAST(DATE '2023-01-01' + CAST((doc_id * 37) % 1185 AS INTEGER) AS DATE) AS date, text, "
    "coalesce(m.name, d.source) AS source, lang FROM documents d LEFT JOIN "
    + values_sql(list(SOURCE_OF.items()), "src, name").replace("AS t(", "AS m(")
    + " ON d.source = m.src)"
)

ENRICHED_SQL = (
    ARTICLES_SQL + ", " + DIM_SQL + ", enriched AS (SELECT a.*, d.country, d.type, d.institution_name, d.ordinal "
    "FROM articles a LEFT JOIN dim d USING (source))"
)

def _made_runs() -> list[tuple]:
    """Run windows, irregular on purpose: seven or eight days, not the same for each country."""
    made = []
    for k, country in enumerate(rules.COUNTRY_ORDER):
        made.append((country, None, "2023-01-01", "2025-12-31"))
        since = datetime.date(2026, 1, 6 + k)
        for week in range(1, 10 + k):
            until = since + datetime.timedelta(days=6 + (week + k) % 2)
            made.append((country, week, since.isoformat(), until.isoformat()))
            since = until + datetime.timedelta(days=1)
    return made


RUNS = _made_runs()

RUNS_SQL = (
    "runs AS (SELECT country, CAST(week AS INTEGER) AS week, CAST(since AS DATE) AS since, "
    "CAST(until AS DATE) AS until FROM " + values_sql(RUNS, "country, week, since, until") + ")"
)


def runs(spark: SparkSession) -> DataFrame:
    return rules.calendar(spark, RUNS)


# ---- page text in SQL ------------------------------------------------------

WS_SQL = "(" + " || ".join(f"chr({ord(c)})" for c in WHITESPACE) + ")"


def trim_sql(x: str) -> str:
    return f"trim({x}, {WS_SQL})"


def decode_sql(x: str) -> str:
    for entity, char in ENTITIES:
        char = char.replace("'", "''")
        x = f"replace({x}, '{entity}', '{char}')"
    return x


def plain_sql(x: str, sep: str = "") -> str:
    """Text nodes, each decoded and stripped, blanks dropped, joined by sep."""
    return (
        f"array_to_string(list_filter(list_transform(string_split_regex({x}, '<[^>]*>'), "
        f"lambda n: {trim_sql(decode_sql('n'))}), lambda n: n <> ''), '{sep}')"
    )


def no_script_sql(x: str) -> str:
    return (
        f"regexp_replace(regexp_replace(regexp_replace({x}, '(?s)<!--.*?-->', '', 'g'), "
        "'(?s)<script.*?</script>', '', 'g'), '(?s)<style.*?</style>', '', 'g')"
    )


ARTICLE_SQL = "regexp_extract(html, '(?s)<article>(.*?)</article>', 1)"


def blocks_sql(x: str, sep: str = " ") -> str:
    """Paragraphs of a page as a list: split at <p>, each cut at its end."""
    piece = "regexp_extract(p, '(?s)^(.*?)(?:</p>|</article>|\\z)', 1)"
    return (
        f"list_filter(list_transform(list_slice(string_split({no_script_sql(x)}, '<p>'), 2, 100000000), "
        f"lambda p: {plain_sql(piece, sep)}), lambda t: t <> '')"
    )


def text_sql(x: str, sep: str = " ", joiner: str = "chr(10)") -> str:
    return f"array_to_string({blocks_sql(x, sep)}, {joiner})"


TITLE_SQL = plain_sql("regexp_extract(html, '(?s)<h1>(.*?)</h1>', 1)")
