"""Incremental forms, run to the end over the given tables and compared with a batch."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusflow.functions import html as H
from corpusflow.functions.text import computed
from corpusflow.operators import clean as C
from corpusflow.session import work_folder
from corpusflow.streaming import compact, ingest, keys, weeks

from .base import TITLE_SQL, WS_SQL, query, table, text_sql, ARTICLE_SQL
from .extraction import LANGUAGES
from .filters import EXCLUDE, INCLUDE, language_sql, rejected_sql

EVENTS = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()),
])
PAGES = T.StructType([
    T.StructField("page_id", T.LongType()), T.StructField("url", T.StringType()), T.StructField("html", T.StringType()),
])


def _landing(sf, name):
    # as a pattern, which a stream accepts for a table of one file and for a folder
    return f"{sf}/{{{name}}}.parquet"


def _run(spark, name):
    root = work_folder(spark, name)
    return f"{root}/out", f"{root}/checkpoint"


@query(
    "incremental_clean",
    f"WITH x AS (SELECT page_id, url, {TITLE_SQL} AS title, {text_sql(ARTICLE_SQL)} AS text FROM pages), "
    f"f AS (SELECT *, {language_sql('text')} AS language FROM x WHERE trim(text, {WS_SQL}) <> '' AND NOT {rejected_sql('title')}), "
    "d AS (SELECT *, row_number() OVER (PARTITION BY title ORDER BY page_id) AS rn FROM f) "
    "SELECT page_id, language, md5(text) AS text FROM d WHERE rn = 1",
)
def incremental_clean(spark, sf):
    """Newly landed pages through extraction and the cleaning chain."""
    out, checkpoint = _run(spark, "ingest")

    def transform(batch):
        h = F.col("html")
        blocks = H.blocks(H.container(h, (("main", None), ("article", None))), ("p",))
        read = computed(batch, title=H.title(h), text=H.join_blocks(blocks)).drop("html")
        return C.clean(read, ("page_id",), EXCLUDE, INCLUDE, LANGUAGES, key="title")

    ingest.write_batches(ingest.landed(spark, _landing(sf, "pages"), PAGES), out, checkpoint, transform)
    return spark.read.parquet(out).select("page_id", "language", F.md5("text").alias("text"))


@query(
    "weekly_windows",
    "SELECT strftime(time_bucket(INTERVAL '7 days', CAST(ts AS TIMESTAMP), TIMESTAMP '1970-01-02'), '%Y-%m-%d') AS week_start, event_type, count(*) AS n FROM events GROUP BY ALL",
)
def weekly_windows(spark, sf):
    df = spark.read.parquet(f"{sf}/events.parquet")
    return ingest.weekly_window_counts(df, "ts", ("event_type",)).withColumn("week_start", F.col("week_start").cast("string"))


@query(
    "streamed_weekly_windows",
    "SELECT strftime(time_bucket(INTERVAL '7 days', CAST(ts AS TIMESTAMP), TIMESTAMP '1970-01-02'), '%Y-%m-%d') AS week_start, event_type, count(*) AS n FROM events GROUP BY ALL",
)
def streamed_weekly_windows(spark, sf):
    out, checkpoint = _run(spark, "weekly")
    ingest.write_weekly_counts(ingest.landed(spark, _landing(sf, "events"), EVENTS), out, checkpoint, "ts", ("event_type",))
    changes = spark.read.parquet(out)
    last = ingest.current_rows(changes, ("week_start", "event_type"), ())
    return last.select(F.col("week_start").cast("string").alias("week_start"), "event_type", "n")


@query(
    "streamed_upsert",
    "SELECT user_id, arg_max(event_type, event_id) AS event_type, max(event_id) AS event_id FROM events GROUP BY user_id",
)
def streamed_upsert(spark, sf):
    out, checkpoint = _run(spark, "upsert")
    stream = ingest.landed(spark, _landing(sf, "events"), EVENTS).select("user_id", "event_type", "event_id")
    ingest.upsert_batches(stream, out, checkpoint, "user_id", ("event_id",))
    return ingest.current_rows(spark.read.parquet(out), "user_id", ("event_id",)).drop("batch_id")


@query(
    "compacted_upsert",
    "SELECT user_id, arg_max(event_type, event_id) AS event_type, max(event_id) AS event_id FROM events GROUP BY user_id",
)
def compacted_upsert(spark, sf):
    """Seven micro batches, merged twice on the way into runs of two levels."""
    out, checkpoint = _run(spark, "upsert")
    landing, root = work_folder(spark, "landing"), work_folder(spark, "runs")
    events = table(spark, sf, "events").select("user_id", "event_type", "event_id")
    low, high = events.agg(F.min("event_id"), F.max("event_id")).first()
    step = (high - low) // 7 + 1
    for k in range(7):
        slice_ = events.filter(F.col("event_id").between(low + k * step, low + (k + 1) * step - 1))
        slice_.coalesce(1).write.mode("append").parquet(landing)
        if k in (4, 6):
            ingest.upsert_batches(ingest.landed(spark, landing, events.schema, 1), out, checkpoint, "user_id", ("event_id",))
            compact.compact(spark, out, root, "user_id", ("event_id",), fanout=2)
    return compact.current_rows(spark, out, root, "user_id", ("event_id",)).drop("batch_id")


@query("streamed_dedup", "SELECT DISTINCT CAST(user_id AS VARCHAR) AS url FROM events")
def streamed_dedup(spark, sf):
    """Three landings, the last one a backfill of older rows and repeats of known keys."""
    out, checkpoint = _run(spark, "dedup")
    landing = work_folder(spark, "landing")
    events = table(spark, sf, "events").select(
        F.col("user_id").cast("string").alias("url"), "event_id", F.col("ts").cast("timestamp").alias("ts")
    )
    days = F.dayofmonth("ts")
    for landed in (days.between(11, 20), days > 20, days <= 10):
        events.filter(landed).write.mode("append").parquet(landing)
        ingest.write_deduped(ingest.landed(spark, landing, events.schema), out, checkpoint, "url", ("ts", "event_id"))
    return spark.read.parquet(out).select("url")


@query("indexed_dedup", "SELECT DISTINCT CAST(user_id AS VARCHAR) AS url FROM events")
def indexed_dedup(spark, sf):
    """The three landings of streamed_dedup against the bucketed index of written keys."""
    out, checkpoint = _run(spark, "dedup")
    landing, index = work_folder(spark, "landing"), work_folder(spark, "index")
    events = table(spark, sf, "events").select(
        F.col("user_id").cast("string").alias("url"), "event_id", F.col("ts").cast("timestamp").alias("ts")
    )
    days = F.dayofmonth("ts")
    for landed in (days.between(11, 20), days > 20, days <= 10):
        events.filter(landed).write.mode("append").parquet(landing)
        keys.write_deduped(ingest.landed(spark, landing, events.schema), out, index, checkpoint, "url", ("ts", "event_id"), 16)
    return spark.read.parquet(out).select("url")


@query(
    "weekly_corrections",
    "WITH e AS (SELECT event_type, CAST(ts AS TIMESTAMP) AS ts, CASE WHEN day(ts) BETWEEN 11 AND 20 THEN 0 WHEN day(ts) > 20 THEN 1 ELSE 2 END AS landing, "
    "time_bucket(INTERVAL '7 days', CAST(ts AS TIMESTAMP), TIMESTAMP '1970-01-02') AS week FROM events), "
    "m AS (SELECT landing, max(max(ts)) OVER (ORDER BY landing ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - INTERVAL '7 days' AS closed_to FROM e GROUP BY landing), "
    "t AS (SELECT max(ts) - INTERVAL '7 days' AS closed_to FROM e) "
    "SELECT strftime(week, '%Y-%m-%d') AS week_start, event_type, count(*) AS n, "
    "count(*) FILTER (WHERE week + INTERVAL '7 days' <= m.closed_to) AS n_late, "
    "week + INTERVAL '7 days' <= any_value(t.closed_to) AS closed "
    "FROM e JOIN m USING (landing), t GROUP BY week, event_type",
)
def weekly_corrections(spark, sf):
    """Weekly counts over three landings; rows for weeks that are closed by then are corrections."""
    out, checkpoint = _run(spark, "weeks")
    landing = work_folder(spark, "landing")
    events = table(spark, sf, "events").select("event_id", "event_type", F.col("ts").cast("timestamp_ntz").alias("ts"))
    days = F.dayofmonth("ts")
    for landed in (days.between(11, 20), days > 20, days <= 10):
        events.filter(landed).write.mode("append").parquet(landing)
        weeks.write_weekly_increments(ingest.landed(spark, landing, events.schema), out, checkpoint, "ts", ("event_type",))
    total = weeks.weekly_totals(spark.read.parquet(out), ("event_type",))
    return total.withColumn("week_start", F.col("week_start").cast("string"))
