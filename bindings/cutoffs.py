"""Ordered cut-offs over listings made from events, newest first.

A listing page holds six hours of one event type; high values stand for pinned
old items, low ones for captures that failed.
"""

from pyspark.sql import functions as F

from corpusflow.operators import cutoff

from .base import flag, query, table

SINCE, UNTIL = "2024-01-10", "2024-01-25"
HOURS = 6


def listing(spark, sf):
    age = F.lit("2024-02-01").cast("timestamp_ntz")
    df = table(spark, sf, "events").select(
        F.col("event_type").alias("source"),
        F.when(F.col("user_id") < 75, "news").otherwise("publications").alias("section"),
        F.floor(F.timestamp_diff("MICROSECOND", F.col("ts").cast("timestamp_ntz"), age) / (3_600_000_000 * HOURS)).cast("int").alias("page"),
        F.concat(F.lit("e"), F.col("event_id").cast("string")).alias("url"),
        F.col("user_id").cast("string").alias("author"),
        F.when(F.col("value") > 300, F.lit("2023-12-01").cast("date")).otherwise(F.to_date("ts")).alias("date"),
        (F.col("value") < 5).alias("failed"),
        F.col("value").alias("value"),
        "ts", "event_id",
    )
    return df.withColumnRenamed("event_id", "pos").drop("ts")


def marked(spark, sf, until=UNTIL):
    return cutoff.mark(listing(spark, sf), SINCE, until)


LIST_SQL = (
    "l0 AS (SELECT event_type AS source, CASE WHEN user_id < 75 THEN 'news' ELSE 'publications' END AS section, "
    f"CAST(floor(date_diff('microsecond', CAST(ts AS TIMESTAMP), TIMESTAMP '2024-02-01') / {3_600_000_000 * HOURS}.0) AS INTEGER) AS page, "
    "'e' || event_id AS url, CAST(user_id AS VARCHAR) AS author, CASE WHEN value > 300 THEN DATE '2023-12-01' ELSE CAST(ts AS DATE) END AS date, "
    "value < 5 AS failed, value, ts, event_id FROM events), "
    "l1 AS (SELECT *, event_id AS pos, "
    f"date < DATE '{SINCE}' AS old, date > DATE '{UNTIL}' AS skip FROM l0), "
    "l AS (SELECT *, row_number() OVER (PARTITION BY source, section ORDER BY page, pos) AS n FROM l1)"
)


def _rows(df):
    return cutoff.cut(df).select("source", "section", "url")


def _sql(stop, at="n", extra="", until=UNTIL):
    rows = LIST_SQL if until else LIST_SQL.replace(f"date > DATE '{UNTIL}' AS skip", "false AS skip")
    return (
        f"WITH {rows}, {stop} SELECT source, section, url FROM l LEFT JOIN stops USING (source, section) "
        f"WHERE NOT old AND NOT skip {extra} AND (stop IS NULL OR {at})"
    )


FIRST_OLD = "stops AS (SELECT source, section, min(n) AS stop FROM l WHERE old GROUP BY ALL)"


@query("cut_first_old", _sql(FIRST_OLD, "n < stop"))
def cut_first_old(spark, sf):
    return _rows(cutoff.first_old(marked(spark, sf)))


# the k-th old row of a run without a break, as gaps and islands
STREAK3 = (
    "i AS (SELECT *, sum(CASE WHEN old AND NOT failed THEN 0 ELSE 1 END) OVER (PARTITION BY source, section ORDER BY n) AS island FROM l), "
    "s AS (SELECT *, sum(CASE WHEN old AND NOT failed THEN 1 ELSE 0 END) OVER (PARTITION BY source, section, island ORDER BY n) AS run FROM i), "
    "stops AS (SELECT source, section, min(n) AS stop FROM s WHERE run >= 3 GROUP BY ALL)"
)


@query("cut_streak_listing", _sql(STREAK3, "n < stop", "AND NOT failed"))
def cut_streak_listing(spark, sf):
    return _rows(cutoff.streak(marked(spark, sf), 3))


STREAK5 = (
    "u AS (SELECT * FROM l WHERE NOT failed), "
    "i AS (SELECT *, sum(CASE WHEN old THEN 0 ELSE 1 END) OVER (PARTITION BY source, section, page ORDER BY n) AS island FROM u), "
    "s AS (SELECT *, sum(CASE WHEN old THEN 1 ELSE 0 END) OVER (PARTITION BY source, section, page, island ORDER BY n) AS run FROM i), "
    "stops AS (SELECT source, section, min(n) AS stop FROM s WHERE run >= 5 GROUP BY ALL)"
)


@query("cut_streak_page", _sql(STREAK5, "n < stop", "AND NOT failed"))
def cut_streak_page(spark, sf):
    return _rows(cutoff.streak(marked(spark, sf), 5, scope="page", reset_on_failed=False))


def _pages_sql(good, k):
    return (
        f"p AS (SELECT source, section, page, bool_or({good}) AS good FROM l GROUP BY ALL), "
        "i AS (SELECT *, sum(CASE WHEN good THEN 1 ELSE 0 END) OVER (PARTITION BY source, section ORDER BY page) AS island FROM p), "
        "s AS (SELECT *, sum(CASE WHEN good THEN 0 ELSE 1 END) OVER (PARTITION BY source, section, island ORDER BY page) AS run FROM i), "
        f"stops AS (SELECT source, section, min(page) AS stop FROM s WHERE run >= {k} GROUP BY ALL)"
    )


@query("cut_stale_pages", _sql(_pages_sql(f"date >= DATE '{SINCE}' AND value > 100", 3), "page <= stop", until=None))
def cut_stale_pages(spark, sf):
    # rows that the source rule leaves out do not make a page recent
    df = marked(spark, sf, None)
    usable = F.col("date").isNotNull() & ~F.col("old") & ~F.col("skip") & (F.col("value") > 100)
    return _rows(cutoff.unproductive(df, usable, 3))


@query("cut_stale_pages_plain", _sql(_pages_sql(f"date >= DATE '{SINCE}'", 3), "page <= stop", until=None))
def cut_stale_pages_plain(spark, sf):
    return _rows(cutoff.stale_pages(marked(spark, sf, None), 3))


@query("cut_unproductive_range", _sql(_pages_sql(f"skip OR (date BETWEEN DATE '{SINCE}' AND DATE '{UNTIL}')", 1), "page <= stop"))
def cut_unproductive_range(spark, sf):
    good = F.col("skip") | (~F.col("old") & F.col("date").isNotNull())
    return _rows(cutoff.unproductive(marked(spark, sf), good, 1))


@query("cut_unproductive_text", _sql(_pages_sql("NOT old AND NOT skip AND NOT failed AND value > 60", 2), "page <= stop", until=None))
def cut_unproductive_text(spark, sf):
    good = ~F.col("old") & ~F.col("skip") & ~F.col("failed") & (F.col("value") > 60)
    return _rows(cutoff.unproductive(marked(spark, sf, None), good, 2))


NEW_SQL = (
    f"WITH {LIST_SQL}, f AS (SELECT *, row_number() OVER (PARTITION BY source, author ORDER BY section, n) = 1 AS is_new FROM l), "
)


@query(
    "cut_seen_pages",
    NEW_SQL + "p AS (SELECT source, section, page, bool_or(is_new) AS good FROM f GROUP BY ALL), "
    "stops AS (SELECT source, section, min(page) AS stop FROM p WHERE NOT good GROUP BY ALL) "
    "SELECT source, section, url FROM l LEFT JOIN stops USING (source, section) "
    "WHERE NOT old AND (stop IS NULL OR page <= stop)",
)
def cut_seen_pages(spark, sf):
    """Stop on a page without an author not met before."""
    df = cutoff.first_seen(marked(spark, sf, None), key="author")
    return _rows(cutoff.unproductive(df, F.col("is_new"), 1))


@query("first_seen_links", NEW_SQL[:-2] + " SELECT source, section, url, CAST(is_new AS INTEGER) AS is_new FROM f")
def first_seen_links(spark, sf):
    return cutoff.first_seen(listing(spark, sf), key="author").select(
        "source", "section", "url", flag(F.col("is_new")).alias("is_new")
    )


@query(
    "cut_loss",
    f"WITH {LIST_SQL}, {FIRST_OLD} SELECT source, section, count(*) AS n_lost FROM l JOIN stops USING (source, section) "
    "WHERE NOT old AND NOT skip AND n >= stop GROUP BY ALL",
)
def cut_loss(spark, sf):
    lost = cutoff.loss(cutoff.first_old(marked(spark, sf)))
    return lost.groupBy("source", "section").agg(F.count("*").alias("n_lost"))
