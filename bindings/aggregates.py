"""Reports and data-quality checks over articles."""

from pyspark.sql import functions as F

from corpusflow import rules
from corpusflow.operators import quality, reports
from corpusflow.schema import ARTICLE_COLS

from .base import (
    ARTICLES_SQL, COUNTRY_SQL, ENRICHED_SQL, RUNS, RUNS_SQL, articles, day, flag, query, runs, table, trim_sql, values_sql,
)
from .filters import CLEAN_SQL, ROUTED_SQL, cleaned, dirty, enriched, language_sql, routed

TYPES_SQL = "types AS (SELECT type FROM " + values_sql([(t,) for t in rules.TYPES], "type") + ")"
COUNTS_SQL = (
    f"{ENRICHED_SQL}, known AS (SELECT * REPLACE (coalesce(country, 'unknown') AS country, coalesce(type, 'unknown') AS type) FROM enriched), "
    "counts AS (SELECT country, type, count(*) AS n FROM known GROUP BY ALL), "
    "shares AS (SELECT *, n / sum(n) OVER (PARTITION BY country) AS share FROM counts)"
)


def known(spark, sf):
    """Sources without a dimension row are a group of their own."""
    unknown = {c: F.coalesce(c, F.lit("unknown")) for c in ("country", "type")}
    return enriched(spark, sf).withColumns(unknown)


def type_domain(spark):
    return rules.rows_frame(spark, [(t,) for t in rules.TYPES], type="STRING")


@query("rows_by_source", f"WITH {ARTICLES_SQL} SELECT source, count(*) AS n FROM articles GROUP BY source")
def rows_by_source(spark, sf):
    return reports.by_source(articles(spark, sf))


@query("rows_total", f"WITH {ARTICLES_SQL} SELECT source, count(*) AS n FROM articles GROUP BY ROLLUP (source)")
def rows_total(spark, sf):
    return reports.by_source(articles(spark, sf), total=True)


@query(
    "language_counts",
    f"WITH g AS (SELECT {language_sql('text')} AS language FROM documents) "
    "SELECT language, count(*) AS n FROM g WHERE language <> 'en' GROUP BY language",
)
def language_counts(spark, sf):
    from corpusflow.operators import filters

    from .extraction import LANGUAGES

    return reports.language_counts(filters.flag_language(table(spark, sf, "documents"), LANGUAGES))


@query("type_shares", f"WITH {COUNTS_SQL} SELECT country, type, n, round(share, 6) AS share FROM shares")
def type_shares(spark, sf):
    return reports.shares(known(spark, sf)).withColumn("share", F.round("share", 6))


_CELLS = ", ".join(
    f"CAST(coalesce(sum(n) FILTER (country = '{c}'), 0) AS BIGINT) AS n_{c}, "
    f"round(coalesce(sum(share) FILTER (country = '{c}'), 0), 6) AS share_{c}"
    for c in rules.COUNTRY_ORDER
)


@query(
    "share_table",
    f"WITH {COUNTS_SQL}, {TYPES_SQL} SELECT coalesce(t.type, 'total') AS type, {_CELLS} "
    "FROM types t LEFT JOIN shares s USING (type) GROUP BY ROLLUP (t.type)",
)
def share_table(spark, sf):
    wide = reports.pivot_shares(known(spark, sf), type_domain(spark))
    return wide.select(*[F.round(c, 6).alias(c) if c.startswith("share") else c for c in wide.columns])


_SLOTS = ", ".join(
    f"string_agg(DISTINCT institution_name, '; ' ORDER BY institution_name) FILTER (country = '{c}') AS {c}" for c in rules.COUNTRY_ORDER
)


@query(
    "slot_table",
    f"WITH {ENRICHED_SQL}, {TYPES_SQL} SELECT t.type, {_SLOTS} FROM types t LEFT JOIN enriched e USING (type) GROUP BY t.type",
)
def slot_table(spark, sf):
    return reports.slot_map(enriched(spark, sf), type_domain(spark))


_GRID = [(c, t) for c in rules.COUNTRY_ORDER for t in rules.TYPES]


@query(
    "missing_slots",
    f"WITH {ENRICHED_SQL}, grid AS (SELECT * FROM {values_sql(_GRID, 'country, type')}) "
    "SELECT country, type FROM grid EXCEPT SELECT country, type FROM enriched",
)
def missing_slots(spark, sf):
    return reports.missing_slots(enriched(spark, sf), reports.slot_domain(spark))


@query(
    "per_capita",
    f"WITH {ENRICHED_SQL}, {COUNTRY_SQL} SELECT country, count(*) AS n, millions, round(count(*) / millions, 3) AS per_million "
    "FROM enriched JOIN countries USING (country) GROUP BY country, millions",
)
def per_capita(spark, sf):
    return reports.per_capita(enriched(spark, sf), rules.country_dim(spark), 3)


WEEKS_SQL = (
    f"{ENRICHED_SQL}, {RUNS_SQL}, weeks AS (SELECT r.country, r.week, count(e.doc_id) AS n FROM runs r LEFT JOIN enriched e "
    "ON e.country = r.country AND e.date BETWEEN r.since AND r.until WHERE r.week IS NOT NULL GROUP BY r.country, r.week)"
)


@query("weekly_counts", f"WITH {WEEKS_SQL} SELECT country, week, n FROM weeks")
def weekly_counts(spark, sf):
    return reports.weekly_counts(enriched(spark, sf), runs(spark))


@query(
    "weekly_summary",
    f"WITH {WEEKS_SQL} SELECT country, count(*) AS weeks, min(n) AS min_n, max(n) AS max_n, CAST(sum(n) AS BIGINT) AS sum_n FROM weeks GROUP BY country",
)
def weekly_summary(spark, sf):
    return reports.weekly(enriched(spark, sf), runs(spark))


# runs without a start, without an end, overlapping ones and an empty one
OPEN_RUNS = [
    *RUNS, ("sco", 30, "2026-03-01", None), ("eng", 31, None, "2023-06-30"), ("irl", 32, None, None), ("irl", 33, "2026-01-20", "2026-01-10"),
]
OPEN_WINDOWS_SQL = (
    f"{ENRICHED_SQL}, {COUNTRY_SQL}, open_runs AS (SELECT o.country, CAST(week AS INTEGER) AS week, coalesce(CAST(since AS DATE), start) AS since, "
    "coalesce(CAST(until AS DATE), DATE '9999-12-31') AS until FROM " + values_sql(OPEN_RUNS, "country, week, since, until").replace("AS t(", "AS o(")
    + " JOIN countries USING (country)), placed AS (SELECT r.country, r.week, e.doc_id FROM open_runs r LEFT JOIN enriched e "
    "ON e.country = r.country AND e.date BETWEEN r.since AND r.until)"
)


@query(
    "weekly_counts_open",
    f"WITH {OPEN_WINDOWS_SQL} SELECT country, week, count(doc_id) AS n FROM placed WHERE week IS NOT NULL GROUP BY ALL",
)
def weekly_counts_open(spark, sf):
    """Runs that have no end yet count as well; a missing start is the country's."""
    return reports.weekly_counts(enriched(spark, sf), rules.calendar(spark, OPEN_RUNS), rules.country_dim(spark))


@query(
    "window_coverage_open",
    f"WITH {OPEN_WINDOWS_SQL}, m AS (SELECT e.doc_id, e.country, e.date, count(r.country) AS n_windows FROM enriched e "
    "LEFT JOIN open_runs r ON e.country = r.country AND e.date BETWEEN r.since AND r.until GROUP BY ALL) "
    "SELECT country, CAST(date AS VARCHAR) AS date, count(*) AS n, n_windows FROM m WHERE n_windows <> 1 GROUP BY country, date, n_windows",
)
def window_coverage_open(spark, sf):
    c = reports.coverage(enriched(spark, sf), rules.calendar(spark, OPEN_RUNS), rules.country_dim(spark))
    return c.select("country", F.col("date").cast("string").alias("date"), "n", "n_windows")


@query(
    "retention",
    f"WITH {CLEAN_SQL}, r AS (SELECT source, count(*) AS n_raw FROM dirty GROUP BY source), "
    "c AS (SELECT source, count(*) AS n_clean FROM cleaned GROUP BY source) "
    "SELECT source, n_raw, coalesce(n_clean, 0) AS n_clean, round(coalesce(n_clean, 0) / n_raw, 6) AS ratio FROM r LEFT JOIN c USING (source)",
)
def retention(spark, sf):
    return reports.retention(dirty(spark, sf), cleaned(spark, sf)).withColumn("ratio", F.round("ratio", 6))


@query(
    "batch_overlap",
    f"WITH {ROUTED_SQL} SELECT md5(text) AS url, count(DISTINCT batch) AS n_batches FROM routed GROUP BY md5(text) HAVING count(DISTINCT batch) > 1",
)
def batch_overlap(spark, sf):
    return reports.batch_overlap(routed(spark, sf).select(F.md5("text").alias("url"), "batch"))


GAPS = [
    ("eng", 1, "2023-01-01", "2023-12-31"), ("eng", 2, "2023-12-25", "2024-06-30"), ("irl", 1, "2023-02-01", "2026-01-31"),
    ("irl", 2, "2025-03-01", "2025-03-31"), ("irl", 3, "2025-03-15", "2025-04-15"), ("sco", 1, "2024-01-01", "2024-12-31"),
]


@query(
    "window_coverage",
    f"WITH {ENRICHED_SQL}, gaps AS (SELECT country, CAST(since AS DATE) AS since, CAST(until AS DATE) AS until FROM "
    + values_sql(GAPS, "country, week, since, until")
    + "), m AS (SELECT e.doc_id, e.country, e.date, count(g.since) AS n_windows FROM enriched e LEFT JOIN gaps g "
    "ON e.country = g.country AND e.date BETWEEN g.since AND g.until GROUP BY ALL) "
    "SELECT country, CAST(date AS VARCHAR) AS date, count(*) AS n, n_windows FROM m WHERE n_windows <> 1 GROUP BY country, date, n_windows",
)
def window_coverage(spark, sf):
    c = reports.coverage(enriched(spark, sf), rules.calendar(spark, GAPS))
    return c.select("country", F.col("date").cast("string").alias("date"), "n", "n_windows")


@query(
    "repeated_blocks",
    "WITH b AS (SELECT DISTINCT doc_id, source, " + trim_sql("x") + " AS block FROM (SELECT doc_id, source, unnest(string_split(text, chr(10))) AS x FROM documents)) "
    "SELECT source, block, count(*) AS n_docs FROM b WHERE block <> '' GROUP BY source, block HAVING count(*) >= 3",
)
def repeated_blocks(spark, sf):
    return reports.repeated_blocks(table(spark, sf, "documents"), 3)


@query(
    "text_profile",
    f"WITH {ARTICLES_SQL}, l AS (SELECT source, count(*) AS n, min(length(text)) AS min_len, quantile_cont(length(text), 0.5) AS median_len, "
    "max(length(text)) AS max_len, count(*) FILTER (length(text) < 150) AS n_short FROM articles GROUP BY source), "
    "d AS (SELECT source, date, count(*) AS c FROM articles GROUP BY source, date), "
    "t AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY c DESC, date) AS rn FROM d) "
    "SELECT source, n, CAST(min_len AS INTEGER) AS min_len, CAST(median_len AS DOUBLE) AS median_len, CAST(max_len AS INTEGER) AS max_len, n_short, "
    "CAST(date AS VARCHAR) AS top_date, c AS n_top, round(c / n, 6) AS top_share FROM l JOIN t USING (source) WHERE rn = 1",
)
def text_profile(spark, sf):
    return reports.profile(articles(spark, sf)).withColumns(
        {"top_date": F.col("top_date").cast("string"), "top_share": F.round("top_share", 6)}
    )


# a log line per (customer, day of orders): half of them in the older, wide layout
@query(
    "run_log_rows",
    "WITH o AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d, o_custkey, CAST(floor(o_totalprice) AS BIGINT) AS t, o_orderstatus AS s FROM orders), "
    "n AS (SELECT *, t % 100 AS a, t % 10 AS b FROM o) "
    "SELECT CAST(o_orderkey AS VARCHAR) AS file, CASE WHEN s = 'F' THEN 'eng' ELSE 'irl' END AS country, CAST(d AS VARCHAR) AS since, "
    "CAST(d + 6 AS VARCHAR) AS until, x.source, CASE x.k WHEN 1 THEN a WHEN 2 THEN b ELSE 0 END AS n, a + b AS total FROM n JOIN "
    + values_sql(
        [("F", "schoolsweek", 1), ("F", "gov", 2), ("F", "epi", 0), ("F", "nuffield", 0), ("F", "fft", 0), ("F", "fed", 0),
         ("L", "gov_ie", 1), ("L", "esri", 2)], "lay, source, k"
    ).replace("AS t(", "AS x(") + " ON (CASE WHEN s = 'F' THEN 'F' ELSE 'L' END) = x.lay",
)
def run_log_rows(spark, sf):
    a, b = F.col("t") % 100, F.col("t") % 10
    d = F.to_date("o_orderdate")
    span = F.concat(day(d), F.lit(" → "), day(F.date_add(d, 6)))
    lead = F.concat(F.lit("| "), day(d), F.lit(" 11:41 | "))
    key = F.col("o_orderkey").cast("string")
    whole = F.concat(F.lit(" | **"), (a + b).cast("string"), F.lit("** |"))
    wide = F.concat(lead, span, F.lit(" | "), key, F.lit(" | "), a.cast("string"), F.lit(" | "), b.cast("string"), F.lit(" | 0 | 0 | 0 | 0"), whole)
    listed = F.concat(
        lead, F.lit("irl | "), span, F.lit(" | "), key, F.lit(" | gov_ie="), a.cast("string"), F.lit(", esri="), b.cast("string"), whole
    )
    lines = table(spark, sf, "orders").withColumn("t", F.floor("o_totalprice").cast("long")).select(
        F.when(F.col("o_orderstatus") == "F", wide).otherwise(listed).alias("value")
    )
    return reports.parse_log(lines).select(
        "file", "country", F.col("since").cast("string").alias("since"), F.col("until").cast("string").alias("until"), "source", "n", "total"
    )


@query(
    "latest_log_runs",
    "WITH r AS (SELECT 'c' || o_custkey AS file, CAST(o_orderdate AS TIMESTAMP) AS t, count(*) AS k FROM orders GROUP BY ALL), "
    "m AS (SELECT file, max(t) AS t FROM r GROUP BY file) "
    "SELECT file, strftime(t, '%Y-%m-%d') AS run_day, k AS n FROM r JOIN m USING (file, t)",
)
def latest_log_runs(spark, sf):
    lines = (
        table(spark, sf, "orders").groupBy("o_custkey", "o_orderdate").agg(F.count("*").alias("k"))
        .select(
            F.concat(
                F.lit("| "), day("o_orderdate"), F.lit(" 00:10 | sco | 2026-01-08 → 2026-01-15 | c"), F.col("o_custkey").cast("string"),
                F.lit(" | gov_scot="), F.col("k").cast("string"), F.lit(" | **"), F.col("k").cast("string"), F.lit("** |"),
            ).alias("value")
        )
    )
    return reports.latest_runs(reports.parse_log(lines)).select("file", day("run_time").alias("run_day"), "n")


# ---- quality ---------------------------------------------------------------

@query(
    "orphan_sources",
    f"WITH {ENRICHED_SQL} SELECT source, count(*) AS n FROM enriched WHERE ordinal IS NULL GROUP BY source",
)
def orphan_sources(spark, sf):
    return quality.orphan_sources(articles(spark, sf), rules.source_dim(spark))


@query(
    "missing_fields",
    f"WITH {ENRICHED_SQL} SELECT 'country' AS field, count(*) FILTER (country IS NULL) AS n_missing FROM enriched UNION ALL "
    "SELECT 'type', count(*) FILTER (type IS NULL) FROM enriched UNION ALL "
    "SELECT 'institution_name', count(*) FILTER (institution_name IS NULL AND source <> 'gov') FROM enriched",
)
def missing_fields(spark, sf):
    return quality.missing_fields(enriched(spark, sf))


@query(
    "out_of_domain",
    "SELECT 'type' AS field, c_mktsegment AS value, count(*) AS n FROM customer WHERE c_mktsegment NOT IN ('BUILDING', 'MACHINERY') GROUP BY ALL UNION ALL "
    "SELECT 'country', CAST(c_nationkey AS VARCHAR), count(*) FROM customer WHERE c_nationkey NOT IN (1, 2, 3) GROUP BY ALL",
)
def out_of_domain(spark, sf):
    c = table(spark, sf, "customer").select(F.col("c_mktsegment").alias("type"), F.col("c_nationkey").cast("string").alias("country"))
    return quality.out_of_domain(c, {"type": ["BUILDING", "MACHINERY"], "country": ["1", "2", "3"]})


@query(
    "empty_countries",
    f"WITH {ENRICHED_SQL}, {COUNTRY_SQL} SELECT country FROM countries WHERE country NOT IN "
    "(SELECT CASE WHEN country = 'irl' THEN 'eng' ELSE country END FROM enriched WHERE country IS NOT NULL)",
)
def empty_countries(spark, sf):
    """All articles, with one country's under another name."""
    renamed = F.when(F.col("country") == "irl", "eng").otherwise(F.col("country"))
    return quality.empty_countries(enriched(spark, sf).withColumn("country", renamed), rules.country_dim(spark))


@query(
    "batch_validation",
    "SELECT source, count(*) AS n, count(*) FILTER (n_chars < 200) AS n_blank, 'date, country, type, institution_name, language' AS missing_columns, "
    "CAST(count(*) < 40 AS INTEGER) AS low_volume, 0 AS ok FROM documents GROUP BY source",
)
def batch_validation(spark, sf):
    d = table(spark, sf, "documents").select(
        F.col("doc_id").alias("url"), F.lit("t").alias("title"), "source", F.when(F.col("n_chars") >= 200, F.col("text")).otherwise("\t ").alias("text")
    )
    v = quality.validate(d, by="source", min_rows=40)
    return v.withColumns({"low_volume": flag(F.col("low_volume")), "ok": flag(F.col("ok"))})


@query(
    "corpus_validation",
    "WITH v AS (SELECT count(*) AS n, count(*) FILTER (n_chars < 200) AS b FROM documents) "
    "SELECT 'missing_columns' AS check_name, CAST(0 AS BIGINT) AS value, 0 AS warn FROM v UNION ALL SELECT 'blank_text', b, CAST(b > 0 AS INTEGER) FROM v UNION ALL "
    "SELECT 'no_rows', n, CAST(n = 0 AS INTEGER) FROM v UNION ALL SELECT 'few_rows', n, CAST(n > 0 AND n < 5 AS INTEGER) FROM v",
)
def corpus_validation(spark, sf):
    d = table(spark, sf, "documents").select(
        "source", F.when(F.col("n_chars") >= 200, F.col("text")).otherwise("\t ").alias("text"),
        *[F.lit("x").alias(c) for c in ARTICLE_COLS if c not in ("source", "text")],
    )
    v = quality.validate_all(d)
    return v.withColumn("warn", flag(F.col("warn")))


@query("store_non_empty", "SELECT CAST(count(*) > 0 AS INTEGER) AS non_empty FROM documents")
def store_non_empty(spark, sf):
    return quality.non_empty(table(spark, sf, "documents")).select(flag(F.col("non_empty")).alias("non_empty"))


# ---- divergence ------------------------------------------------------------

@query(
    "js_divergence",
    "WITH c AS (SELECT source AS unit, lang AS category, count(*) AS n FROM documents GROUP BY ALL), "
    "u AS (SELECT unit, sum(n) AS un FROM c GROUP BY unit), g AS (SELECT category, sum(n) AS gn FROM c GROUP BY category), "
    "f AS (SELECT u.unit, g.category, coalesce(c.n, 0) / un AS p, gn / (SELECT sum(n) FROM c) AS q FROM u CROSS JOIN g LEFT JOIN c ON c.unit = u.unit AND c.category = g.category) "
    "SELECT unit, round(sum(0.5 * CASE WHEN p > 0 THEN p * log2(2 * p / (p + q)) ELSE 0 END + 0.5 * q * log2(2 * q / (p + q))), 6) AS jsd FROM f GROUP BY unit",
)
def js_divergence(spark, sf):
    return reports.js_divergence(table(spark, sf, "documents"), "source", "lang").withColumn("jsd", F.round("jsd", 6))


@query(
    "js_divergence_weekly",
    "WITH e AS (SELECT strftime(time_bucket(INTERVAL '7 days', CAST(ts AS TIMESTAMP), TIMESTAMP '1970-01-02'), '%Y-%m-%d') AS unit, "
    "CASE WHEN value > 200 THEN 'top' ELSE event_type END AS category FROM events), "
    "c AS (SELECT unit, category, count(*) AS n FROM e GROUP BY ALL), "
    "u AS (SELECT unit, sum(n) AS un FROM c GROUP BY unit), g AS (SELECT category, sum(n) AS gn FROM c GROUP BY category), "
    "f AS (SELECT u.unit, g.category, coalesce(c.n, 0) / un AS p, gn / (SELECT sum(n) FROM c) AS q FROM u CROSS JOIN g LEFT JOIN c ON c.unit = u.unit AND c.category = g.category) "
    "SELECT unit, round(sum(0.5 * CASE WHEN p > 0 THEN p * log2(2 * p / (p + q)) ELSE 0 END + 0.5 * q * log2(2 * q / (p + q))), 6) AS jsd FROM f GROUP BY unit",
)
def js_divergence_weekly(spark, sf):
    from corpusflow.streaming.ingest import weekly_window

    e = table(spark, sf, "events").select(
        day(weekly_window(F.col("ts")).getField("start")).alias("unit"),
        F.when(F.col("value") > 200, "top").otherwise(F.col("event_type")).alias("category"),
    )
    return reports.js_divergence(e, "unit", "category").withColumn("jsd", F.round("jsd", 6))


@query(
    "concentration",
    "WITH c AS (SELECT source AS unit, lang, count(*) AS n FROM documents GROUP BY ALL), p AS (SELECT unit, n / sum(n) OVER (PARTITION BY unit) AS p FROM c) "
    "SELECT unit, round(sum(p * p), 6) AS hhi, count(*) AS n_categories FROM p GROUP BY unit",
)
def concentration(spark, sf):
    return reports.concentration(table(spark, sf, "documents"), "source", "lang").withColumn("hhi", F.round("hhi", 6))


@query(
    "kl_asymmetry",
    f"WITH {ENRICHED_SQL}, g AS (SELECT unnest({rules.TYPES!r}) AS type), "
    "a AS (SELECT g.type, count(e.doc_id) AS n FROM g LEFT JOIN enriched e ON e.type = g.type AND e.country = 'eng' GROUP BY g.type), "
    "b AS (SELECT g.type, count(e.doc_id) AS n FROM g LEFT JOIN enriched e ON e.type = g.type AND e.country = 'irl' GROUP BY g.type), "
    "p AS (SELECT a.type, (a.n + 1.0) / (sum(a.n) OVER () + 7.0) AS p, (b.n + 1.0) / (sum(b.n) OVER () + 7.0) AS q FROM a JOIN b USING (type)) "
    "SELECT 'eng' AS unit_a, 'irl' AS unit_b, round(sum(p * ln(p / q)), 6) AS kl_ab, round(sum(q * ln(q / p)), 6) AS kl_ba, "
    "round(sum(p * ln(p / q)) - sum(q * ln(q / p)), 6) AS asymmetry FROM p",
)
def kl_asymmetry(spark, sf):
    k = reports.kl_asymmetry(enriched(spark, sf), "country", "type", "eng", "irl", type_domain(spark))
    return k.select("unit_a", "unit_b", *[F.round(c, 6).alias(c) for c in ("kl_ab", "kl_ba", "asymmetry")])
