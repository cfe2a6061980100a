"""Filters, language flags, enrichment, routing, deduplication and the cleaning chain."""

from functools import reduce

from pyspark.sql import functions as F

from corpusflow import rules
from corpusflow.functions import html as H
from corpusflow.operators import clean as C
from corpusflow.operators import dedup, enrich, filters, ordering, routing

from .base import (
    ARTICLES_SQL, COUNTRY_SQL, ENRICHED_SQL, RUNS, RUNS_SQL, TITLE_SQL, articles, day, flag, query, runs, table, trim_sql,
    values_sql,
)
from .extraction import LANGUAGES

# Terms that occur in the given titles and texts.
EXCLUDE = ["therh", "ation", "eau", "sich"]
INCLUDE = ["the ", "la ", "der "]


def any_sql(col, terms):
    return "(" + " OR ".join(f"contains({col}, '{t}')" for t in terms) + ")"


def rejected_sql(col, a=EXCLUDE, b=INCLUDE):
    t = f"lower(coalesce({col}, ''))"
    return f"({any_sql(t, a)} AND NOT {any_sql(t, b)})"


def count_sql(col, terms):
    return "(" + " + ".join(f"CAST(contains({col}, '{t}') AS INTEGER)" for t in terms) + ")"


def language_sql(text):
    t = f"lower({text})"
    s = {k: f"CASE WHEN {count_sql(t, w)} >= {n} THEN {count_sql(t, w)} ELSE 0 END" for k, (w, n) in LANGUAGES.items()}
    best = f"greatest({', '.join(s.values())})"
    picks = " ".join(f"WHEN {v} = {best} THEN '{k}'" for k, v in s.items())
    return f"CASE WHEN length({text}) < 50 THEN 'en' WHEN {best} = 0 THEN 'en' {picks} END"


IRISH_SQL = (
    f"CASE WHEN length(text) < {rules.LANGUAGE_MIN_CHARS} THEN 'en' WHEN "
    f"{count_sql('lower(text)', rules.IRISH_TERMS)} >= {rules.IRISH_THRESHOLD} THEN 'ga' ELSE 'en' END"
)


def titled(spark, sf):
    return table(spark, sf, "pages").select("page_id", "url", H.title(F.col("html")).alias("title"))


TITLED_SQL = f"titled AS (SELECT page_id, url, {TITLE_SQL} AS title FROM pages)"


@query(
    "nonblank_nodes",
    "WITH n AS (SELECT page_id, unnest(string_split_regex(html, '<[^>]*>')) AS text FROM pages) "
    f"SELECT page_id, count(*) AS n FROM n WHERE text IS NOT NULL AND {trim_sql('text')} <> '' GROUP BY page_id",
)
def nonblank_nodes(spark, sf):
    nodes = table(spark, sf, "pages").select("page_id", F.explode(F.split("html", "<[^>]*>")).alias("text"))
    return filters.drop_blank(nodes).groupBy("page_id").agg(F.count("*").alias("n"))


@query(
    "keyed_rows",
    "SELECT o_orderkey, url FROM (SELECT o_orderkey, CASE o_orderstatus WHEN 'P' THEN NULL WHEN 'O' THEN '' "
    "ELSE 'k' || o_custkey END AS url FROM orders) WHERE url IS NOT NULL AND url <> ''",
)
def keyed_rows(spark, sf):
    url = F.when(F.col("o_orderstatus") == "P", None).when(F.col("o_orderstatus") == "O", "").otherwise(
        F.concat(F.lit("k"), F.col("o_custkey").cast("string"))
    )
    return filters.drop_keyless(table(spark, sf, "orders").select("o_orderkey", url.alias("url")))


@query("title_kept", f"WITH {TITLED_SQL} SELECT page_id, title FROM titled WHERE NOT {rejected_sql('title')}")
def title_kept(spark, sf):
    return filters.title_filter(titled(spark, sf), EXCLUDE, INCLUDE).select("page_id", "title")


@query(
    "title_kept_default_terms",
    f"WITH {ARTICLES_SQL} SELECT doc_id, md5(title) AS title FROM articles WHERE NOT "
    + rejected_sql("title", rules.TITLE_EXCLUDE, rules.TITLE_INCLUDE),
)
def title_kept_default_terms(spark, sf):
    return filters.title_filter(articles(spark, sf)).select("doc_id", F.md5("title").alias("title"))


@query(
    "title_rejects",
    f"WITH {TITLED_SQL} SELECT page_id, title FROM titled WHERE {rejected_sql('title')} ORDER BY page_id LIMIT 10",
)
def title_rejects(spark, sf):
    # a report of the first ten
    return filters.title_rejects(titled(spark, sf), ["page_id"], 10, EXCLUDE, INCLUDE).select("page_id", "title")


@query(
    "administrative_titles",
    f"WITH {TITLED_SQL} SELECT page_id FROM titled WHERE NOT {any_sql('lower(title)', ['tion', 'under', 'ent'])}",
)
def administrative_titles(spark, sf):
    return filters.skip_titles(titled(spark, sf), ["tion", "under", "ent"]).select("page_id")


@query(
    "administrative_titles_by_source",
    "SELECT doc_id FROM documents WHERE NOT (source IN ('src0', 'src1') AND (doc_id % 4 = 1 OR (source = 'src1' AND doc_id % 4 = 2)))",
)
def administrative_titles_by_source(spark, sf):
    """Two sources with lists of their own; the others keep titles of the same kind."""
    title = F.element_at(F.array(*[F.lit(t) for t in ("News", "Minutes: board", "FOI Release 1", None)]), (F.col("doc_id") % 4 + 1).cast("int"))
    lists = {"src0": ["minutes:"], "src1": ["minutes:", "foi release"]}
    return filters.skip_titles_by_source(table(spark, sf, "documents").withColumn("title", title), lists).select("doc_id")


@query(
    "date_range",
    "SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS date FROM orders "
    "WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1996-02-01' AND DATE '1998-06-30'",
)
def date_range(spark, sf):
    # at noon, so that the last day ends after midnight
    orders = table(spark, sf, "orders").withColumn("o_orderdate", F.expr("timestampadd(HOUR, 12, o_orderdate)"))
    kept = filters.date_range(orders, "1996-02-01", "1998-06-30", "o_orderdate")
    return kept.select("o_orderkey", day("o_orderdate").alias("date"))


@query(
    "open_date_range",
    "SELECT event_id FROM events WHERE ts >= TIMESTAMP '2024-01-20 00:00:00'",
)
def open_date_range(spark, sf):
    return filters.date_range(table(spark, sf, "events"), since="2024-01-20", col="ts").select("event_id")


@query(
    "null_dates",
    "SELECT 'keep' AS policy, count(*) AS n FROM orders UNION ALL "
    "SELECT 'drop', count(*) FROM orders WHERE o_orderstatus <> 'P' UNION ALL "
    "SELECT 'by_source', count(*) FROM orders WHERE o_orderstatus <> 'P' OR o_orderpriority <> '1-URGENT'",
)
def null_dates(spark, sf):
    df = table(spark, sf, "orders").select(
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderdate")).alias("date"),
        F.when(F.col("o_orderpriority") == "1-URGENT", "epi").otherwise("rte").alias("source"),
    )
    frames = [
        ("keep", filters.null_dates(df, "keep")),
        ("drop", filters.null_dates(df, "drop")),
        ("by_source", filters.null_dates_by_source(df)),
    ]
    return reduce(
        lambda a, b: a.unionAll(b),
        [f.agg(F.count("*").alias("n")).select(F.lit(p).alias("policy"), "n") for p, f in frames],
    )


@query(
    "language_flags",
    f"SELECT doc_id, {language_sql('text')} AS language, {IRISH_SQL} AS irish FROM documents",
)
def language_flags(spark, sf):
    return table(spark, sf, "documents").select(
        "doc_id",
        filters.language(F.col("text"), LANGUAGES).alias("language"),
        filters.language(F.col("text")).alias("irish"),
    )


# ---- enrichment and routing ------------------------------------------------

@query(
    "enriched_articles",
    f"WITH {ENRICHED_SQL} SELECT doc_id, source, country, type, institution_name FROM enriched",
)
def enriched_articles(spark, sf):
    e = enrich.enrich(articles(spark, sf), rules.source_dim(spark))
    return e.select("doc_id", "source", "country", "type", "institution_name")


def enriched(spark, sf):
    return enrich.enrich(articles(spark, sf), rules.source_dim(spark))


@query(
    "final_columns",
    f"WITH {ENRICHED_SQL} SELECT url, title, CAST(date AS VARCHAR) AS date, md5(text) AS text, source, country, type, institution_name FROM enriched",
)
def final_columns(spark, sf):
    return enrich.conform(enriched(spark, sf)).withColumns(
        {"date": F.col("date").cast("string"), "text": F.md5("text")}
    )


BODIES = ["PROMO", "Brand#1", "ECONOMY", "Brand#23", "LARGE"]


def publishers(spark, sf):
    return table(spark, sf, "part").select(
        "p_partkey", F.concat("p_type", F.lit("; "), "p_brand").alias("from"),
        F.when(F.col("p_size") < 25, "gov").otherwise("epi").alias("source"), F.lit("Given").alias("institution_name"),
    )


_FROM = "p_type || '; ' || p_brand"
_CORE = any_sql(f"({_FROM})", BODIES)
_ORG = "CASE " + " ".join(f"WHEN contains({_FROM}, '{b}') THEN '{b}'" for b in BODIES) + " ELSE 'Other' END"


@query("core_flags", f"SELECT p_partkey, CAST({_CORE} AS INTEGER) AS core_education FROM part")
def core_flags(spark, sf):
    return enrich.flag_core(publishers(spark, sf), BODIES).select(
        "p_partkey", flag(F.col("core_education")).alias("core_education")
    )


@query("primary_orgs", f"SELECT p_partkey, {_ORG} AS primary_org FROM part")
def primary_orgs(spark, sf):
    return enrich.primary_org(publishers(spark, sf), BODIES).select("p_partkey", "primary_org")


@query(
    "source_rule",
    f"SELECT p_partkey, CASE WHEN p_size < 25 THEN {_ORG} ELSE 'Given' END AS institution_name FROM part "
    f"WHERE p_size >= 25 OR {_CORE}",
)
def source_rule(spark, sf):
    flagged = enrich.primary_org(enrich.flag_core(publishers(spark, sf), BODIES), BODIES)
    return enrich.apply_source_rule(flagged).select("p_partkey", "institution_name")


UNDATED_SQL = (
    "undated AS (SELECT * REPLACE (CASE WHEN doc_id % 11 <> 0 THEN date END AS date), "
    "CASE WHEN doc_id % 5 = 0 THEN country || '/2025-12-31' WHEN doc_id % 7 = 0 THEN 'nowhere/present' END AS run_id FROM enriched)"
)


def undated(spark, sf):
    """Articles of which some have no date, some name their run and some name one that is not there."""
    run = F.when(F.col("doc_id") % 5 == 0, F.concat("country", F.lit("/2025-12-31"))).when(
        F.col("doc_id") % 7 == 0, F.lit("nowhere/present")
    )
    return enriched(spark, sf).withColumn("date", F.when(F.col("doc_id") % 11 != 0, F.col("date"))).withColumn("run_id", run)


@query(
    "default_since",
    f"WITH {ENRICHED_SQL}, {UNDATED_SQL} SELECT doc_id, CAST(date AS VARCHAR) AS date FROM undated WHERE date IS NULL OR country IS NULL OR date >= CASE country "
    "WHEN 'eng' THEN DATE '2023-06-01' WHEN 'irl' THEN DATE '2024-01-01' WHEN 'sco' THEN DATE '2023-01-01' END",
)
def default_since(spark, sf):
    starts = rules.rows_frame(
        spark, [("eng", "2023-06-01"), ("irl", "2024-01-01"), ("sco", "2023-01-01")], country="STRING", start="DATE"
    )
    return routing.default_since(undated(spark, sf), starts).select("doc_id", F.col("date").cast("string").alias("date"))


BATCH_SQL = (
    "CASE WHEN week IS NULL THEN coalesce(CAST(until AS VARCHAR), 'present') ELSE "
    "'week' || lpad(CAST(week AS VARCHAR), 2, '0') || '_' || coalesce(CAST(until AS VARCHAR), 'present') END"
)
ROUTED_SQL = (
    f"{ENRICHED_SQL}, {RUNS_SQL}, routed AS (SELECT e.*, r.week, r.since, r.until, {BATCH_SQL} AS batch, "
    "CASE WHEN until IS NULL OR until <= DATE '2025-12-31' THEN 'training' ELSE 'inference' END AS dataset_type, "
    "CASE WHEN until IS NULL OR until <= DATE '2025-12-31' THEN 1 ELSE 0 END AS append "
    "FROM enriched e JOIN runs r ON e.country = r.country AND e.date BETWEEN r.since AND r.until)"
)


def routed(spark, sf):
    return routing.route(enriched(spark, sf), runs(spark), countries=rules.country_dim(spark))


@query(
    "run_windows",
    f"WITH {ENRICHED_SQL}, {RUNS_SQL} SELECT doc_id, week, CAST(since AS VARCHAR) AS run_since, CAST(until AS VARCHAR) AS run_until "
    "FROM enriched e JOIN runs r ON e.country = r.country AND e.date BETWEEN r.since AND r.until",
)
def run_windows(spark, sf):
    return routing.in_window(enriched(spark, sf), runs(spark)).select(
        "doc_id", "week", F.col("run_since").cast("string").alias("run_since"), F.col("run_until").cast("string").alias("run_until")
    )


# the runs, and one that is still open
OPEN_RUN = ("sco", 30, "2026-03-20", None)
OPEN_RUNS_SQL = "runs AS (SELECT country, CAST(week AS INTEGER) AS week, CAST(since AS DATE) AS since, CAST(until AS DATE) AS until FROM " + values_sql(
    [*RUNS, OPEN_RUN], "country, week, since, until"
) + ")"
_COVERED = "e.country = r.country AND (r.since IS NULL OR e.date >= r.since) AND (r.until IS NULL OR e.date <= r.until)"
RUN_ROUTED_SQL = (
    f"{ENRICHED_SQL}, {UNDATED_SQL}, {OPEN_RUNS_SQL}, b AS (SELECT *, {BATCH_SQL} AS batch FROM runs), "
    "routed AS (SELECT e.doc_id, r.until, r.batch FROM undated e JOIN b r ON "
    f"(e.run_id = r.country || '/' || r.batch) OR (e.run_id IS NULL AND {_COVERED}))"
)


@query(
    "routed_articles",
    f"WITH {RUN_ROUTED_SQL} SELECT doc_id, CASE WHEN until IS NULL OR until <= DATE '2025-12-31' THEN 'training' ELSE 'inference' END AS dataset_type, "
    "CASE WHEN until IS NULL OR until <= DATE '2025-12-31' THEN 1 ELSE 0 END AS append, batch FROM routed",
)
def routed_articles(spark, sf):
    calendar = rules.calendar(spark, [*RUNS, OPEN_RUN])
    out = routing.route(undated(spark, sf), calendar, countries=rules.country_dim(spark))
    return out.select("doc_id", "dataset_type", flag(F.col("append")).alias("append"), "batch")


@query(
    "unrouted_articles",
    f"WITH {RUN_ROUTED_SQL} SELECT doc_id, CASE WHEN run_id IS NOT NULL THEN 'unknown run' WHEN date IS NULL THEN 'no date' ELSE 'no window' END AS reason "
    "FROM undated WHERE doc_id NOT IN (SELECT doc_id FROM routed)",
)
def unrouted_articles(spark, sf):
    """With routed_articles, every article: none is lost without being named."""
    calendar = rules.calendar(spark, [*RUNS, OPEN_RUN])
    return routing.unrouted(undated(spark, sf), calendar, rules.country_dim(spark)).select("doc_id", "reason")


@query(
    "routed_without_training",
    f"WITH {ENRICHED_SQL}, {COUNTRY_SQL}, r AS (SELECT country, CASE WHEN country = 'eng' THEN 'training' ELSE 'inference' END AS dataset_type, "
    "0 AS append, 'present' AS batch, start FROM countries) "
    "SELECT doc_id, dataset_type, append, batch FROM enriched e JOIN r USING (country) WHERE date >= start",
)
def routed_without_training(spark, sf):
    """Runs with neither since nor until, and one training country."""
    open_runs = rules.calendar(spark, [(c, None, None, None) for c in rules.COUNTRY_ORDER])
    r = routing.route(
        enriched(spark, sf), open_runs, training_countries=["eng"], countries=rules.country_dim(spark)
    )
    return r.select("doc_id", "dataset_type", flag(F.col("append")).alias("append"), "batch")


@query(
    "batch_names",
    "SELECT o_orderkey, CASE WHEN o_orderstatus = 'O' THEN coalesce(d, 'present') ELSE 'week' || lpad(w, 2, '0') || '_' || coalesce(d, 'present') END AS batch "
    "FROM (SELECT o_orderkey, o_orderstatus, CAST(week(o_orderdate) AS VARCHAR) AS w, "
    "CASE WHEN o_orderpriority <> '5-LOW' THEN strftime(o_orderdate, '%Y-%m-%d') END AS d FROM orders)",
)
def batch_names(spark, sf):
    week = F.when(F.col("o_orderstatus") != "O", F.weekofyear("o_orderdate"))
    until = F.when(F.col("o_orderpriority") != "5-LOW", F.to_date("o_orderdate"))
    return table(spark, sf, "orders").select("o_orderkey", routing.batch_name(week, until).alias("batch"))


# ---- deduplication ---------------------------------------------------------

@query(
    "first_copies",
    f"WITH {ENRICHED_SQL} SELECT doc_id, source, md5(text) AS hash FROM (SELECT *, row_number() OVER "
    "(PARTITION BY md5(text) ORDER BY ordinal NULLS FIRST, doc_id) AS rn FROM enriched) WHERE rn = 1",
)
def first_copies(spark, sf):
    keyed = (
        articles(spark, sf)
        .join(rules.source_dim(spark).select("source", "ordinal"), "source", "left")
        .select("doc_id", "source", "ordinal", F.md5("text").alias("hash"))
    )
    return dedup.dedup_first(keyed, "hash", ("ordinal", "doc_id")).drop("ordinal")


@query(
    "last_writes",
    "SELECT o_custkey, arg_max(o_orderkey, o_orderkey) AS o_orderkey, round(arg_max(o_totalprice, o_orderkey), 2) AS price FROM orders GROUP BY o_custkey",
)
def last_writes(spark, sf):
    # keys rise with time, so the highest is the last write
    o = table(spark, sf, "orders").select("o_custkey", "o_orderkey", F.round("o_totalprice", 2).alias("price"))
    return dedup.dedup_last(o, "o_custkey", ("o_orderkey",))


@query(
    "scoped_links",
    "WITH l AS (SELECT page_id, regexp_extract(url, '^[a-z]+://([^/?#]+)', 1) AS host, "
    "unnest(regexp_extract_all(html, 'href=\"([^\"]*)\"', 1)) AS href FROM pages) "
    "SELECT 'host' AS scope, count(*) AS n FROM (SELECT DISTINCT host, href FROM l) UNION ALL "
    "SELECT 'page', count(*) FROM (SELECT DISTINCT page_id, href FROM l) UNION ALL SELECT 'none', count(*) FROM l",
)
def scoped_links(spark, sf):
    from .dates_links import page_links

    links = page_links(spark, sf).withColumns({
        "page": F.col("page_id"), "host": F.regexp_extract("url", "^[a-z]+://([^/?#]+)", 1),
    })
    frames = {
        "host": dedup.dedup_scope(links, ("host",), "href"),
        "page": dedup.dedup_scope(links, ("page_id",), "href"),
        "none": dedup.dedup_scope(links, None),
    }
    return reduce(
        lambda a, b: a.unionAll(b),
        [f.agg(F.count("*").alias("n")).select(F.lit(s).alias("scope"), "n") for s, f in frames.items()],
    )


@query(
    "united_sources",
    "SELECT 'doc' || doc_id AS url, lang, NULL AS title FROM documents UNION ALL "
    f"SELECT url, NULL, {TITLE_SQL} FROM pages",
)
def united_sources(spark, sf):
    docs = table(spark, sf, "documents").select(F.concat(F.lit("doc"), F.col("doc_id").cast("string")).alias("url"), "lang")
    return dedup.union_sources(docs, titled(spark, sf).select("title", "url")).select("url", "lang", "title")


# ---- cleaning --------------------------------------------------------------

def dirty(spark, sf):
    """Articles keyed by their text; texts of one line become blank."""
    a = articles(spark, sf).join(rules.source_dim(spark).select("source", "ordinal"), "source", "left")
    return a.select(
        "doc_id", "source", F.coalesce("ordinal", F.lit(99)).alias("ordinal"), F.md5("text").alias("url"), "title",
        F.when(F.contains("text", F.lit("\n")), F.col("text")).otherwise("  \t").alias("text"),
        F.col("doc_id").alias("pos"),
    )


DIRTY_SQL = (
    f"{ENRICHED_SQL}, dirty AS (SELECT doc_id, source, coalesce(ordinal, 99) AS ordinal, md5(text) AS url, title, "
    "CASE WHEN contains(text, chr(10)) THEN text ELSE ' ' || chr(160) || chr(9) END AS text FROM enriched)"
)
CLEAN_SQL = (
    f"{DIRTY_SQL}, nonblank AS (SELECT * FROM dirty WHERE {trim_sql('text')} <> ''), "
    f"titled AS (SELECT * FROM nonblank WHERE NOT {rejected_sql('title')}), "
    f"flagged AS (SELECT *, {language_sql('text')} AS language FROM titled), "
    "cleaned AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY url ORDER BY ordinal, doc_id) AS rn FROM flagged) WHERE rn = 1)"
)


def cleaned(spark, sf):
    return C.clean(dirty(spark, sf), exclude=EXCLUDE, include=INCLUDE, lists=LANGUAGES)


@query("cleaned_articles", f"WITH {CLEAN_SQL} SELECT url, source, language, md5(text) AS text FROM cleaned")
def cleaned_articles(spark, sf):
    return cleaned(spark, sf).select("url", "source", "language", F.md5("text").alias("text"))


@query("cleaned_articles_wide", f"WITH {CLEAN_SQL} SELECT url, source, language, md5(text) AS text FROM cleaned")
def cleaned_articles_wide(spark, sf):
    """The same with the key-only exchange asked for by name."""
    out = C.clean(dirty(spark, sf), exclude=EXCLUDE, include=INCLUDE, lists=LANGUAGES, wide=True)
    return out.select("url", "source", "language", F.md5("text").alias("text"))


@query("cleaned_articles_lazy", f"WITH {CLEAN_SQL} SELECT url, source, language, md5(text) AS text FROM cleaned")
def cleaned_articles_lazy(spark, sf):
    """The same with one exchange of the texts, and no job before it."""
    out = C.clean(dirty(spark, sf), exclude=EXCLUDE, include=INCLUDE, lists=LANGUAGES, wide=False)
    return out.select("url", "source", "language", F.md5("text").alias("text"))


@query(
    "cleaning_steps",
    f"WITH {CLEAN_SQL}, n AS (SELECT (SELECT count(*) FROM dirty) AS a, (SELECT count(*) FROM nonblank) AS b, "
    "(SELECT count(*) FROM titled) AS c, (SELECT count(*) FROM cleaned) AS d) "
    "SELECT 1 AS step_no, 'blank_text' AS step, a AS n_before, b AS n_after, a - b AS n_removed FROM n UNION ALL "
    "SELECT 2, 'title', b, c, b - c FROM n UNION ALL SELECT 3, 'duplicate', c, d, c - d FROM n",
)
def cleaning_steps(spark, sf):
    return C.step_counts(dirty(spark, sf), EXCLUDE, INCLUDE)


# ---- order -----------------------------------------------------------------

@query(
    "newest_first",
    f"WITH {ARTICLES_SQL} SELECT url, CAST(date AS VARCHAR) AS date FROM articles ORDER BY date DESC, url",
)
def newest_first(spark, sf):
    a = articles(spark, sf).select("url", "date")
    return ordering.newest_first(a).withColumn("date", F.col("date").cast("string"))


@query(
    "newest_per_source",
    f"WITH {ARTICLES_SQL} SELECT source, url, CAST(date AS VARCHAR) AS date, CAST(rank AS INTEGER) AS rank FROM "
    "(SELECT *, row_number() OVER (PARTITION BY source ORDER BY date DESC, url) AS rank FROM articles) WHERE rank <= 10",
)
def newest_per_source(spark, sf):
    a = articles(spark, sf).select("source", "url", "date")
    return ordering.newest_per_source(a, 10).withColumn("date", F.col("date").cast("string"))
