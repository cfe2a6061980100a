"""Article files, sinks, store records and upserts."""

from pyspark.sql import functions as F

from corpusflow import rules
from corpusflow.operators import dedup, enrich
from corpusflow.plans import corpus, load
from corpusflow.session import work_folder
from corpusflow.sources import files, sinks, split_csv, store

from .base import ENRICHED_SQL, articles, query, runs, table
from .filters import ROUTED_SQL, enriched, rejected_sql, routed

DEFAULT_REJECTED = rejected_sql("title", rules.TITLE_EXCLUDE, rules.TITLE_INCLUDE)


ARTICLE_CSV_SQL = f"WITH {ENRICHED_SQL} SELECT url, md5(title) AS title, CAST(date AS VARCHAR) AS date, md5(text) AS text, source, country, type, institution_name FROM enriched"


def written_csv(spark, sf, **options):
    folder = work_folder(spark, "csv")
    full = enriched(spark, sf).withColumn("language", F.lit("en"))
    sinks.write_articles_csv(enrich.conform(full), folder, **options)
    return folder


def csv_digest(back):
    return back.select(
        "url", F.md5("title").alias("title"), F.col("date").cast("string").alias("date"), F.md5("text").alias("text"),
        "source", "country", "type", "institution_name",
    )


@query("article_csv", ARTICLE_CSV_SQL)
def article_csv(spark, sf):
    return csv_digest(files.read_articles_csv(spark, written_csv(spark, sf, rows_per_file=500)))


@query("article_csv_split", ARTICLE_CSV_SQL)
def article_csv_split(spark, sf):
    """Files of any size, read in byte ranges."""
    return csv_digest(split_csv.read_articles_csv_split(spark, written_csv(spark, sf)))


def named_files(spark, sf):
    """Articles with the name of the file they would come from."""
    a = enriched(spark, sf)
    week = F.format_string("week%02d_%s.csv", F.weekofyear("date"), F.col("date").cast("string"))
    retro = F.concat(F.col("date").cast("string"), F.lit(".csv"))
    return a.withColumn(
        "file_name", F.when(F.col("country").isNull(), "notes.csv").when(F.col("country") == "sco", retro).otherwise(week)
    )


FILES_SQL = (
    f"{ENRICHED_SQL}, files AS (SELECT *, CASE WHEN country IS NULL OR country = 'sco' THEN NULL ELSE CAST(week(date) AS INTEGER) END AS week_number "
    "FROM enriched WHERE country IS NOT NULL)"
)


@query(
    "file_tags",
    f"WITH {FILES_SQL} SELECT week_number, CAST(date AS VARCHAR) AS batch_date, count(*) AS n FROM files GROUP BY ALL",
)
def file_tags(spark, sf):
    t = files.tag_files(named_files(spark, sf))
    return t.groupBy("week_number", F.col("batch_date").cast("string").alias("batch_date")).agg(F.count("*").alias("n"))


@query("file_tags_one_week", f"WITH {FILES_SQL} SELECT doc_id, week_number FROM files WHERE week_number = 7")
def file_tags_one_week(spark, sf):
    # the week filter is the operator's own parameter
    return files.tag_files(named_files(spark, sf), week=7).select("doc_id", "week_number")


@query(
    "training_sink",
    f"WITH {ROUTED_SQL} SELECT country, source, 2 * count(*) AS n FROM routed WHERE dataset_type = 'training' GROUP BY ALL",
)
def training_sink(spark, sf):
    """Overwrite, overwrite again, append: twice the rows."""
    root = work_folder(spark, "training")
    rows = routed(spark, sf).filter(F.col("dataset_type") == "training").select("doc_id", "url", "title", "date", "text", "country", "source")
    for append in (False, False, True):
        sinks.write_training(rows, root, append)
    return spark.read.parquet(root).groupBy("country", "source").agg(F.count("*").alias("n"))


@query(
    "training_runs",
    f"WITH {ROUTED_SQL} SELECT run, country, source, count(*) AS n FROM routed, (VALUES ('first'), ('second')) AS t(run) "
    "WHERE dataset_type = 'training' AND (run = 'first' OR country = 'eng') GROUP BY ALL",
)
def training_runs(spark, sf):
    """A run appended twice counts once; another one adds its rows."""
    root = work_folder(spark, "runs")
    rows = routed(spark, sf).filter(F.col("dataset_type") == "training").select("doc_id", "url", "title", "date", "text", "country", "source")
    for run, part in (("first", rows), ("second", rows.filter("country = 'eng'")), ("first", rows)):
        sinks.append_run(part, root, run)
    return sinks.read_runs(spark, root).groupBy("run", "country", "source").agg(F.count("*").alias("n"))


@query(
    "inference_sink",
    f"WITH {ROUTED_SQL} SELECT country, batch, count(*) AS n FROM routed WHERE dataset_type = 'inference' GROUP BY ALL",
)
def inference_sink(spark, sf):
    root = work_folder(spark, "inference")
    rows = routed(spark, sf).filter(F.col("dataset_type") == "inference").select(
        "doc_id", "url", "title", "date", "text", "source", "country", "week", F.col("run_until").alias("until")
    )
    for _ in range(2):  # a rerun replaces the batch
        sinks.write_inference(rows, root)
    return spark.read.parquet(root).groupBy("country", "batch").agg(F.count("*").alias("n"))


@query(
    "run_log",
    f"WITH {ROUTED_SQL}, c AS (SELECT country, batch, source, count(*) AS n FROM routed WHERE dataset_type = 'inference' GROUP BY ALL) "
    "SELECT country, batch, count(*) AS n_sources, CAST(sum(n) AS BIGINT) AS total FROM c GROUP BY ALL",
)
def run_log(spark, sf):
    path = work_folder(spark, "runlog")
    rows = routed(spark, sf).filter(F.col("dataset_type") == "inference")
    sinks.log_run(rows, path, "2026-03-22 11:33:00")
    return sinks.log_totals(spark.read.parquet(path)).drop("run_time")


@query(
    "planned_load",
    f"WITH {ROUTED_SQL} SELECT country, dataset_type, week AS week_number, count(*) AS n FROM routed GROUP BY ALL",
)
def planned_load(spark, sf):
    records = enrich.to_records(routed(spark, sf), F.col("dataset_type"), F.col("country"), F.col("week"))
    return sinks.plan_load(records)


# orders as articles: the customer is the url, some dates are empty
def order_articles(spark, sf):
    o = table(spark, sf, "orders")
    return o.select(
        F.when(F.col("o_orderpriority") != "5-LOW", F.concat(F.lit("c"), F.col("o_custkey").cast("string"))).alias("url"),
        F.col("o_orderkey").cast("string").alias("title"),
        F.when(F.col("o_orderstatus") == "P", "").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("date"),
        F.col("o_orderstatus").alias("text"),
        F.lit("gov").alias("source"),
        F.lit("elsewhere").alias("country"),
        F.lit("government").alias("type"),
        F.col("o_orderpriority").alias("institution_name"),
        F.when(F.col("o_orderstatus") == "O", "ga").alias("language"),
        F.weekofyear("o_orderdate").alias("week"),
        "o_orderkey",
    )


RECORDS_SQL = (
    "records AS (SELECT 'c' || o_custkey AS url, CAST(o_orderkey AS VARCHAR) AS title, CASE WHEN o_orderstatus <> 'P' THEN "
    "CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS article_date, o_orderstatus AS text, 'gov' AS source, 'eng' AS country, 'government' AS type, "
    "o_orderpriority AS institution_name, CASE WHEN o_orderstatus = 'O' THEN 'ga' END AS language, 'inference' AS dataset_type, "
    "CAST(week(o_orderdate) AS INTEGER) AS week_number, o_orderkey FROM orders WHERE o_orderpriority <> '5-LOW')"
)
_COLS = "url, title, article_date, text, source, country, type, institution_name, language, dataset_type, week_number"


def order_records(spark, sf, extra=()):
    return enrich.to_records(order_articles(spark, sf), "inference", "eng", F.col("week"), extra=extra)


def _dated(df):
    return df.withColumn("article_date", F.col("article_date").cast("string"))


@query("store_records", f"WITH {RECORDS_SQL} SELECT {_COLS} FROM records")
def store_records(spark, sf):
    return _dated(order_records(spark, sf))


@query("default_language", f"WITH {RECORDS_SQL} SELECT url, title, 'en' AS language FROM records")
def default_language(spark, sf):
    """Without a language column every record gets the default."""
    bare = order_articles(spark, sf).drop("language")
    return enrich.to_records(bare, "inference", "eng").select("url", "title", "language")


# the store holds urgent orders' records; all others arrive as updates
@query(
    "upserted_store",
    f"WITH {RECORDS_SQL}, w AS (SELECT *, row_number() OVER (PARTITION BY url ORDER BY CASE WHEN institution_name = '1-URGENT' THEN 0 ELSE 1 END DESC, "
    f"o_orderkey DESC) AS rn FROM records) SELECT {_COLS} FROM w WHERE rn = 1",
)
def upserted_store(spark, sf):
    rows = order_records(spark, sf, extra=["o_orderkey"])
    urgent = F.col("institution_name") == "1-URGENT"
    target = dedup.dedup_last(rows.filter(urgent), "url", ("o_orderkey",)).drop("o_orderkey")
    return _dated(dedup.upsert(target, rows.filter(~urgent), "url", ("o_orderkey",)))


# training rows and weekly files written to one store in the documented order
LOAD_SQL = (
    f"{ENRICHED_SQL}, w AS (SELECT md5(text) AS url, doc_id, country, date, CASE country WHEN 'eng' THEN 1 WHEN 'irl' THEN 2 WHEN 'sco' THEN 3 END AS co, "
    "CASE WHEN date <= DATE '2025-12-31' THEN 0 ELSE 1 END AS f, "
    "CASE WHEN country = 'sco' THEN CAST(date AS VARCHAR) || '.csv' ELSE 'week' || lpad(CAST(week(date) AS VARCHAR), 2, '0') || '_' || CAST(date AS VARCHAR) || '.csv' END AS fn, "
    "CASE WHEN country <> 'sco' THEN CAST(week(date) AS INTEGER) END AS wk FROM enriched WHERE country IS NOT NULL), "
    "x AS (SELECT *, CASE WHEN f = 0 THEN '' ELSE fn END AS fo FROM w), "
    "r AS (SELECT *, row_number() OVER (PARTITION BY url ORDER BY co DESC, f DESC, fo DESC, doc_id DESC) AS rn FROM x)"
)


@query(
    "loaded_store",
    f"WITH {LOAD_SQL} SELECT url, CAST(doc_id AS VARCHAR) AS title, country, CASE WHEN f = 0 THEN 'training' ELSE 'inference' END AS dataset_type, "
    "CASE WHEN f = 1 THEN wk END AS week_number FROM r WHERE rn = 1",
)
def loaded_store(spark, sf):
    a = named_files(spark, sf).filter(F.col("country").isNotNull()).withColumns(
        {"url": F.md5("text"), "title": F.col("doc_id").cast("string")}
    )
    early = F.col("date") <= F.lit(rules.TRAINING_CUTOFF).cast("date")
    at = F.col("doc_id")
    training = load.training_records(a.filter(early), F.col("country"), at)
    records = training.unionByName(load.inference_records(a.filter(~early), F.col("country"), row_order=at))
    # a load for each country, in order; each rewrites the buckets that it touches
    first, *later = [records.filter(F.col("country") == c) for c in rules.COUNTRY_ORDER]
    root = work_folder(spark, "store")
    load.make_store(first, root, buckets=16)
    for batch in later:
        load.load_store(batch, root)
    rows = store.read(spark, root)
    return rows.select("url", "title", "country", "dataset_type", "week_number")


@query(
    "updated_store",
    f"WITH {LOAD_SQL}, m AS (SELECT url, doc_id FROM r WHERE rn = 1), h AS (SELECT url, md5(url) < '4' AS changed FROM m) "
    "SELECT url, CASE WHEN changed THEN 'changed' ELSE CAST(doc_id AS VARCHAR) END AS title, 3 AS n_versions, "
    "CASE WHEN changed THEN 'en' END AS language FROM m JOIN h USING (url) "
    "UNION ALL SELECT md5(CAST(user_id AS VARCHAR)), 'new', 3, 'en' FROM (SELECT DISTINCT user_id FROM events)",
)
def updated_store(spark, sf):
    """A store after a load that changes some urls and one that adds others; older versions stay readable."""
    a = named_files(spark, sf).filter(F.col("country").isNotNull()).withColumns(
        {"url": F.md5("text"), "title": F.col("doc_id").cast("string"), "language": F.lit(None).cast("string")}
    )
    early = F.col("date") <= F.lit(rules.TRAINING_CUTOFF).cast("date")
    at = F.col("doc_id")
    records = load.training_records(a.filter(early), F.col("country"), at).unionByName(
        load.inference_records(a.filter(~early), F.col("country"), row_order=at)
    ).withColumn("language", F.lit(None).cast("string"))
    root = work_folder(spark, "store")
    load.make_store(records, root, buckets=16)
    later = records.withColumns({"country_order": F.lit(9), "title": F.lit("changed"), "language": F.lit("en")})
    load.load_store(later.filter(F.md5("url") < "4"), root)
    users = table(spark, sf, "events").select(F.md5(F.col("user_id").cast("string")).alias("url"))
    blank = {f.name: F.lit(None).cast(f.dataType) for f in later.schema if f.name not in ("url", "title", "language")}
    load.load_store(users.withColumns({**blank, "title": F.lit("new"), "language": F.lit("en")}), root)
    n = F.lit(store.newest(spark, root) + 1).cast("int").alias("n_versions")
    return store.read(spark, root).select("url", "title", n, "language")


@query(
    "corpus_build",
    f"WITH {ROUTED_SQL}, t AS (SELECT url, source, 'training' AS dataset_type, NULL AS batch FROM routed WHERE dataset_type = 'training'), "
    "i AS (SELECT *, row_number() OVER (PARTITION BY batch, country, url ORDER BY ordinal, date, title) AS rn FROM routed WHERE dataset_type = 'inference' "
    f"AND NOT {DEFAULT_REJECTED}) SELECT url, source, dataset_type, batch FROM t UNION ALL SELECT url, source, 'inference', batch FROM i WHERE rn = 1",
)
def corpus_build(spark, sf):
    """Articles to training rows and cleaned inference batches."""
    a = articles(spark, sf).drop("lang")
    all_rows = corpus.build([a], rules.source_dim(spark), runs(spark), rules.country_dim(spark))
    training, inference = corpus.split(all_rows, rules.source_dim(spark))
    return training.select("url", "source", F.lit("training").alias("dataset_type"), F.lit(None).cast("string").alias("batch")).unionByName(
        inference.select("url", "source", F.lit("inference").alias("dataset_type"), "batch")
    )
