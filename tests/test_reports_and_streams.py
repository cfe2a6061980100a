"""Reports with known results, sinks, and streams over several files."""

import datetime
import math

from pyspark.sql import functions as F

from corpusflow import rules
from corpusflow.operators import quality, reports
from corpusflow.session import work_folder
from corpusflow.sources import files, sinks
from corpusflow.streaming import ingest


def day(s):
    return datetime.date.fromisoformat(s)


LOG = [
    "| Run time | Date range | File | schoolsweek | gov | epi | nuffield | fft | fed | Total |",
    "|----------|------------|------|-------------|-----|-----|----------|-----|-----|-------|",
    "| 2024-05-06 08:30 | 2024-04-26 → 2024-05-03 | week02_2024-05-03.csv | 4 | 2 | 1 | 0 | 3 | 0 | **10** |",
    "| 2024-06-20 09:45 | eng | 2024-06-08 → 2024-06-14 | week08_2024-06-14.csv | schoolsweek=5, gov=2, epi=2, fft=1, fed=1 | **11** |",
    "| 2024-05-07 10:00 | irl | 2024-04-26 → 2024-05-03 | week02_2024-05-03.csv | gov_ie=2, esri=1, thejournal=5 | **8** |",
    "| 2024-05-09 17:20 | irl | 2024-04-26 → 2024-05-03 | week02_2024-05-03.csv | gov_ie=2, esri=4 | **6** |",
]


def test_log_totals_reconcile_in_both_layouts(spark):
    log = reports.parse_log(spark.createDataFrame([(x,) for x in LOG], "value string"))
    sums = log.groupBy("run_time", "country", "file", "total").agg(F.sum("n").alias("s")).collect()
    assert len(sums) == 4 and all(r.s == r.total for r in sums)
    latest = reports.latest_runs(log).filter("country = 'irl'").collect()
    assert {(r.source, r.n) for r in latest} == {("gov_ie", 2), ("esri", 4)}
    assert {str(r.since) for r in latest} == {"2024-04-26"}


def articles(spark):
    rows = [
        ("u1", "epi", "eng", "think_tank", "EPI", day("2024-01-01"), "a"), ("u2", "epi", "eng", "think_tank", "EPI", day("2024-01-02"), "bb"),
        ("u3", "gov", "eng", "government", "DfE", day("2024-01-09"), "c"), ("u4", "gtcs", "sco", "prof_body", "GTCS", day("2024-01-09"), "d"),
        ("u5", "ades", "sco", "prof_body", "ADES", None, "e"),
    ]
    return spark.createDataFrame(rows, "url string, source string, country string, type string, institution_name string, date date, text string")


def test_shares_and_tables(spark):
    df = articles(spark)
    domain = rules.rows_frame(spark, [(t,) for t in rules.TYPES], type="STRING")
    table = {r.type: r for r in reports.pivot_shares(df, domain).collect()}
    assert len(table) == len(rules.TYPES) + 1
    assert (table["total"].n_eng, table["total"].n_irl, table["total"].n_sco) == (3, 0, 2)
    assert math.isclose(table["total"].share_eng, 1.0) and math.isclose(table["think_tank"].share_eng, 2 / 3)
    assert table["funder"].n_eng == 0
    slots = {r.type: (r.eng, r.irl, r.sco) for r in reports.slot_map(df, domain).collect()}
    assert slots["prof_body"] == (None, None, "ADES; GTCS")
    missing = {(r.country, r.type) for r in reports.missing_slots(df, reports.slot_domain(spark)).collect()}
    assert len(missing) == 21 - 3 and ("irl", "funder") in missing


def test_coverage_and_weekly(spark):
    runs = rules.calendar(spark, [("eng", 1, "2024-01-01", "2024-01-07"), ("eng", 2, "2024-01-07", "2024-01-08"), ("sco", 1, "2024-01-08", "2024-01-09"), ("sco", 2, "2024-01-09", "2024-01-10")])
    got = {(r.country, str(r.date), r.n, r.n_windows) for r in reports.coverage(articles(spark), runs).collect()}
    assert got == {("eng", "2024-01-09", 1, 0), ("sco", "2024-01-09", 1, 2)}
    weekly = {r.country: (r.weeks, r.min_n, r.max_n, r.sum_n) for r in reports.weekly(articles(spark), runs).collect()}
    assert weekly == {"eng": (2, 0, 2, 2), "sco": (2, 1, 1, 2)}


def test_open_windows_count(spark):
    rows = [("eng", 1, None, "2024-01-01"), ("eng", 2, "2024-01-02", None), ("sco", 1, None, None), ("sco", 2, "2024-01-09", "2024-01-09"),
            ("irl", 1, None, None), ("eng", 3, "2024-01-05", "2024-01-01"), ("eng", 4, "2030-01-01", None)]
    runs = rules.calendar(spark, rows)
    weekly = {(r.country, r.week): r.n for r in reports.weekly_counts(articles(spark), runs).collect()}
    assert weekly == {("eng", 1): 1, ("eng", 2): 2, ("sco", 1): 1, ("sco", 2): 1, ("irl", 1): 0, ("eng", 3): 0, ("eng", 4): 0}
    got = {(r.country, str(r.date), r.n, r.n_windows) for r in reports.coverage(articles(spark), runs).collect()}
    assert got == {("sco", "2024-01-09", 1, 2)}
    starts = rules.rows_frame(spark, [("eng", "2024-01-02"), ("sco", "2024-01-01"), ("irl", "2024-01-01")], country="STRING", start="DATE")
    later = {(r.country, r.week): r.n for r in reports.weekly_counts(articles(spark), runs, starts).collect()}
    assert later["eng", 1] == 0 and later["eng", 2] == 2
    got = {(r.country, str(r.date), r.n, r.n_windows) for r in reports.coverage(articles(spark), runs, starts).collect()}
    assert got == {("eng", "2024-01-01", 1, 0), ("sco", "2024-01-09", 1, 2)}
    assert reports.coverage(articles(spark).filter("false"), runs).collect() == []


def test_many_windows_without_spreading_days(spark):
    many = spark.range(10_000).selectExpr(
        "'eng' AS country", "cast(id as int) AS week", "date_add(date'2000-01-01', cast(id as int)) AS since",
        "CASE WHEN id % 10 > 0 THEN date_add(date'2000-01-01', cast(id + 6 as int)) END AS until",
    )
    days = spark.range(20_000).selectExpr("'eng' AS country", "date_add(date'1999-01-01', cast(id % 12000 as int)) AS date")
    counts = reports.weekly_counts(days, many)
    assert "explode(sequence" not in counts._jdf.queryExecution().toString().lower()
    plain = many.join(days.withColumnRenamed("country", "c"), F.col("date").between(F.col("since"), F.coalesce("until", F.lit("9999-12-31").cast("date"))))
    assert counts.agg(F.sum("n")).first()[0] == plain.count() and counts.count() == 10_000


def test_empty_frames_give_counts_not_errors(spark):
    none = articles(spark).filter("false")
    checks = {r.check_name: (r.value, r.warn) for r in quality.validate_all(none).collect()}
    # the frame has neither title nor language
    assert checks["no_rows"] == (0, True) and checks["missing_columns"] == (2, True)
    assert not quality.non_empty(none).collect()[0].non_empty
    assert reports.total(none).collect()[0].n == 0


def test_divergence_bounds(spark):
    rows = [("a", "x")] * 4 + [("b", "y")] * 4
    jsd = {r.unit: r.jsd for r in reports.js_divergence(spark.createDataFrame(rows, "u string, c string"), "u", "c").collect()}
    p, q, m = 1.0, 0.5, 0.75
    assert math.isclose(jsd["a"], 0.5 * math.log2(p / m) + 0.5 * (q * math.log2(q / m) + 0.5 * math.log2(0.5 / 0.25)))
    same = spark.createDataFrame([("a", "x"), ("b", "x")], "u string, c string")
    assert all(abs(r.jsd) < 1e-12 for r in reports.js_divergence(same, "u", "c").collect())


def test_csv_round_trip_keeps_awkward_text(spark):
    texts = ['say "hi"', "two\nlines", "a,b", "back\\slash", " padded ", "\"\"", "ends\\"]
    df = spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "url string, text string")
    path = work_folder(spark, "csv")
    sinks.write_articles_csv(df, path, rows_per_file=2)
    back = files.read_articles_csv(spark, path, df.schema)
    assert [r.text for r in back.orderBy("url").collect()] == texts
    assert all(r.file_name.endswith(".csv") for r in back.collect())


def test_training_overwrite_replaces_only_its_sources(spark):
    root = work_folder(spark, "train")
    df = articles(spark).select("url", "country", "source")
    sinks.write_training(df, root, append=False)
    sinks.write_training(df.filter("source = 'epi'").limit(1), root, append=False)
    counts = {r.source: r.n for r in reports.by_source(spark.read.parquet(root)).collect()}
    assert counts == {"epi": 1, "gov": 1, "gtcs": 1, "ades": 1}


EVENT = "k string, ts timestamp, v int"


def _land(spark, folder, rows):
    spark.createDataFrame(rows, EVENT).coalesce(1).write.mode("append").parquet(folder)


def at(s):
    return datetime.datetime.fromisoformat(s)


def test_streaming_upsert_over_several_batches_and_runs(spark):
    root = work_folder(spark, "s")
    src, out, ckpt = f"{root}/in", f"{root}/out", f"{root}/ckpt"
    schema = spark.createDataFrame([], EVENT).schema

    def run():
        ingest.upsert_batches(ingest.landed(spark, src, schema, files_per_batch=1), out, ckpt, "k", ("v",))
        return {r.k: r.v for r in ingest.current_rows(spark.read.parquet(out), "k", ("v",)).collect()}

    _land(spark, src, [("a", at("2024-01-01"), 1), ("a", at("2024-01-01"), 3), ("b", at("2024-01-01"), 1)])
    assert run() == {"a": 3, "b": 1}
    assert run() == {"a": 3, "b": 1}  # nothing new
    _land(spark, src, [("a", at("2024-01-08"), 2), ("c", at("2024-01-08"), 9)])
    assert run() == {"a": 2, "b": 1, "c": 9}  # a later batch wins, whatever its values


def test_streaming_weekly_counts_equal_batch(spark):
    root = work_folder(spark, "w")
    src = f"{root}/in"
    for rows in ([("a", at("2024-01-04T23:59:59"), 1), ("a", at("2024-01-05"), 1)], [("a", at("2024-01-11"), 1), ("b", at("2024-01-12"), 1)]):
        _land(spark, src, rows)
    df = spark.read.parquet(src)
    ingest.write_weekly_counts(ingest.landed(spark, src, df.schema, 1), f"{root}/out", f"{root}/ckpt", "ts", ("k",))
    last = ingest.current_rows(spark.read.parquet(f"{root}/out"), ("week_start", "k"), ())
    stream = {(str(r.week_start), r.k, r.n) for r in last.collect()}
    batch = {(str(r.week_start), r.k, r.n) for r in ingest.weekly_window_counts(df, "ts", ("k",)).collect()}
    # weeks start on Fridays
    assert stream == batch == {("2023-12-29", "a", 1), ("2024-01-05", "a", 2), ("2024-01-12", "b", 1)}


def test_streaming_dedup_across_batches(spark):
    root = work_folder(spark, "d")
    src = f"{root}/in"
    schema = spark.createDataFrame([], EVENT).schema
    for rows in ([("a", at("2024-01-05"), 1), ("b", at("2024-01-05"), 1)], [("a", at("2024-01-06"), 2), ("c", at("2024-01-06"), 2)]):
        _land(spark, src, rows)
        ingest.write_deduped(ingest.landed(spark, src, schema), f"{root}/out", f"{root}/ckpt", "k")
    # a backfill of an unseen key, and a repeat long after
    _land(spark, src, [("d", at("2023-01-05"), 1), ("a", at("2025-01-06"), 3)])
    ingest.write_deduped(ingest.landed(spark, src, schema), f"{root}/out", f"{root}/ckpt", "k")
    assert sorted(r.k for r in spark.read.parquet(f"{root}/out").collect()) == ["a", "b", "c", "d"]


def test_work_folder_is_below_the_shared_folder(spark):
    assert work_folder(spark, "x").startswith(spark.sparkContext.getConf().get("spark.checkpoint.dir"))
