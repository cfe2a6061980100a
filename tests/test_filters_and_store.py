"""Filters, language, dedup, enrichment, routing, records and upsert on small inputs."""

import datetime

import pytest
from pyspark.sql import functions as F

from corpusflow import rules
from corpusflow.operators import clean, dedup, enrich, filters, quality, routing
from corpusflow.plans import corpus, load
from corpusflow.sources import files


def day(s):
    return datetime.date.fromisoformat(s)


def test_title_filter_matches_substrings(spark):
    rows = [("a", "University fees to rise"), ("b", "University snaps up site"), ("c", "Leaving Cert and CAO: university places"), ("d", "School news"), ("e", None)]
    df = spark.createDataFrame(rows, "k string, title string")
    assert {r.k for r in filters.title_filter(df).collect()} == {"b", "c", "d", "e"}
    assert [r.k for r in filters.title_rejects(df, ["k"]).collect()] == ["a"]


def test_language_counts_distinct_terms(spark):
    eight, seven = "".join(rules.IRISH_TERMS[:8]), "".join(rules.IRISH_TERMS[:7])
    pad = "x" * 50
    rows = [
        ("eight", eight + pad), ("seven", seven + pad), ("repeated", " agus " * 20 + pad),
        ("short", "".join(rules.IRISH_TERMS[:8])[:49]), ("lines", eight.replace(" ", "\n") + pad), ("upper", eight.upper() + pad), ("none", None),
    ]
    assert len(eight) < 50
    df = filters.flag_language(spark.createDataFrame(rows, "k string, text string"))
    got = {r.k: r.language for r in df.collect()}
    assert got == {"eight": "ga", "seven": "en", "repeated": "en", "short": "en", "lines": "en", "upper": "ga", "none": "en"}


def test_dedup_first_follows_registry_order(spark):
    rows = [("u", 1, 5), ("u", 0, 9), ("u", 0, 7), (None, 2, 1), (None, 1, 1), ("v", 3, 1)]
    df = spark.createDataFrame(rows, "url string, ordinal int, pos int")
    assert {tuple(r) for r in dedup.dedup_first(df).collect()} == {("u", 0, 7), (None, 1, 1), ("v", 3, 1)}


def test_dedup_survives_a_hot_key(spark):
    df = spark.range(100_000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("url"), F.lit(0).alias("ordinal"), F.col("id").alias("pos")
    )
    out = dedup.dedup_first(df)
    assert "WindowGroupLimit" in out._jdf.queryExecution().executedPlan().toString()
    assert out.count() == 1 + 66_666
    assert out.filter("url = 'hot'").collect()[0].pos == 0


def test_wide_dedup_equals_the_window_and_moves_no_text(spark):
    rows = [("u", 1, 5), ("u", 0, 9), ("u", 0, 7), (None, 2, 1), (None, 1, 1), ("v", 3, 1), ("w", None, 4), ("w", 2, 3)]
    df = spark.createDataFrame(rows, "url string, ordinal int, pos int").withColumn("text", F.lit("x"))
    wide = dedup.dedup_first_wide(df)
    assert sorted(map(str, wide.collect())) == sorted(map(str, dedup.dedup_first(df).collect()))
    plan = wide._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan
    tied = df.unionByName(df.filter("pos = 7 or ordinal is null"))
    assert sorted(map(str, dedup.dedup_first_wide(tied).collect())) == sorted(map(str, wide.collect()))


def test_clean_is_idempotent_and_accounts_for_all_rows(spark):
    rows = [
        ("u1", "School news", "text one", 0, 0), ("u1", "School again", "text two", 1, 1), ("u2", "University rankings", "t", 0, 2),
        ("u3", "x", "   ", 0, 3), ("u4", None, "t", 0, 4), (None, "n1", "t", 0, 5), (None, "n2", "t", 0, 6),
    ]
    df = spark.createDataFrame(rows, "url string, title string, text string, ordinal int, pos int")
    once = clean.clean(df)
    twice = clean.clean(once)
    assert sorted(map(str, once.collect())) == sorted(map(str, twice.collect()))
    steps = {r.step: (r.n_before, r.n_after, r.n_removed) for r in clean.step_counts(df).collect()}
    assert steps == {"blank_text": (7, 6, 1), "title": (6, 5, 1), "duplicate": (5, 3, 2)}
    assert once.count() == 3


def test_enrich_and_source_rule(spark):
    rows = [("gov", "Ofsted; Department for Education"), ("gov", "Home Office"), ("gov", ""), ("epi", ""), ("nobody", "")]
    df = enrich.enrich(spark.createDataFrame(rows, "source string, `from` string"), rules.source_dim(spark))
    flagged = enrich.primary_org(enrich.flag_core(df))
    got = sorted((r.source, r.institution_name) for r in enrich.apply_source_rule(flagged).fillna("-").collect())
    assert got == [("epi", "Education Policy Institute"), ("gov", "Department for Education"), ("nobody", "-")]
    bare = enrich.apply_source_rule(df)
    assert {r.institution_name for r in bare.filter("source = 'gov'").collect()} == {"Government"}
    assert [r.source for r in quality.orphan_sources(df, rules.source_dim(spark)).collect()] == ["nobody"]


def test_configuration_is_consistent():
    names = [s[0] for s in rules.SOURCES]
    assert len(names) == len(set(names)) == 18
    assert set(names) == set(rules.EXTRACT)
    assert {s[1] for s in rules.SOURCES} == {c[0] for c in rules.COUNTRIES} == set(rules.COUNTRY_ORDER)
    assert {s[2] for s in rules.SOURCES} <= set(rules.TYPES)
    assert all(s[3] for s in rules.SOURCES if s[0] != "gov")
    assert {s for s, r in rules.EXTRACT.items() if r.on_null_date == "drop"} == {"gov", "epi", "fft", "fed", "nuffield"}


def test_small_dimensions_are_broadcast_by_their_size(spark):
    df = spark.range(10).withColumn("source", F.when(F.col("id") > 5, "epi").otherwise("gov"))
    plan = enrich.enrich(df, rules.source_dim(spark))._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan


def test_records_language_default_and_country(spark):
    schema = "url string, title string, date string, text string, source string, country string, type string, institution_name string"
    row = ("u", "t", "", "x", "epi", "sco", "think_tank", "E")
    no_url = ("", "t", "2024-01-02", "x", "epi", "sco", "think_tank", "E")
    bare = enrich.to_records(spark.createDataFrame([row, no_url], schema), "inference", "irl", 7).collect()
    assert [(r.language, r.country, r.article_date, r.week_number) for r in bare] == [("en", "irl", None, 7)]
    with_null = spark.createDataFrame([(*row, None)], schema + ", language string")
    assert enrich.to_records(with_null, "training", "eng").collect()[0].language is None


def test_file_names_and_write_order(spark):
    names = ["2025-12-31.csv", "week02_2026-01-22.csv", "week11_2026-03-27.csv", "week100_2027-12-10.csv", "notes.csv", "week2.csv"]
    df = spark.createDataFrame([(n,) for n in names], "file_name string")
    got = {r.file_name: (r.week_number, str(r.batch_date)) for r in files.tag_files(df).collect()}
    assert got == {
        "2025-12-31.csv": (None, "2025-12-31"), "week02_2026-01-22.csv": (2, "2026-01-22"),
        "week11_2026-03-27.csv": (11, "2026-03-27"), "week100_2027-12-10.csv": (100, "2027-12-10"),
    }
    assert [r.file_name for r in files.tag_files(df, week=11).collect()] == ["week11_2026-03-27.csv"]
    place = files.write_precedence(F.lit("eng"), F.lit("inference"), F.col("file_name"))
    order = [r.file_name for r in files.tag_files(df).select("file_name", *place).orderBy("file_order").collect()]
    assert order == ["2025-12-31.csv", "week02_2026-01-22.csv", "week100_2027-12-10.csv", "week11_2026-03-27.csv"]


def test_load_last_write_wins_with_its_nulls(spark):
    cols = "url string, title string, date date, text string, source string, type string, institution_name string, language string"
    base = ("u", "old", day("2025-01-01"), "t", "epi", "think_tank", "E", "en")
    newer = ("u", None, day("2026-01-20"), "t2", "epi", "think_tank", "E", None)
    training = load.training_records(spark.createDataFrame([base, ("v", *base[1:])], cols), "eng")
    weekly = load.inference_records(
        spark.createDataFrame([(*newer, "week02_2026-01-22.csv"), (*base, "2025-12-31.csv")], cols + ", file_name string"), "eng"
    )
    target = load.initial(training)
    loaded = load.load(target, weekly)
    got = {r.url: (r.title, r.text, r.language, r.week_number, r.dataset_type) for r in loaded.collect()}
    assert got == {"u": (None, "t2", None, 2, "inference"), "v": ("old", "t", "en", None, "training")}
    again = load.load(loaded, weekly)
    assert sorted(map(str, again.collect())) == sorted(map(str, loaded.collect()))


def test_union_fills_missing_columns(spark):
    a, b = spark.createDataFrame([("u", 1)], "url string, x int"), spark.createDataFrame([("v",)], "url string")
    assert {tuple(r) for r in dedup.union_sources(a, b).collect()} == {("u", 1), ("v", None)}


def test_routing_follows_the_run_not_the_article(spark):
    runs = rules.calendar(
        spark,
        [("eng", None, None, "2025-12-31"), ("eng", 1, "2025-12-26", "2026-01-01"), ("irl", None, None, None), ("sco", 3, "2025-01-01", "2025-12-31")],
    )
    rows = [("a", "eng", day("2025-12-30")), ("b", "eng", day("2022-12-31")), ("c", "irl", day("2026-05-01")), ("d", "sco", day("2025-06-01"))]
    df = spark.createDataFrame(rows, "k string, country string, date date")
    out = routing.route(df, runs, countries=rules.country_dim(spark)).collect()
    # the article of 30 December lies in a training run and in one that ends after the cutoff
    assert sorted((r.k, r.dataset_type, r.append, r.batch) for r in out) == [
        ("a", "inference", False, "week01_2026-01-01"), ("a", "training", False, "2025-12-31"),
        ("c", "training", False, "present"), ("d", "training", True, "week03_2025-12-31"),
    ]


def test_date_range_and_null_dates(spark):
    df = spark.createDataFrame([("a", day("2024-01-01")), ("b", day("2024-01-31")), ("c", None), ("d", day("2024-02-01"))], "k string, date date")
    assert {r.k for r in filters.date_range(df, "2024-01-01", "2024-01-31").collect()} == {"a", "b", "c"}
    assert {r.k for r in filters.null_dates(df, "drop").collect()} == {"a", "b", "d"}
    with pytest.raises(ValueError):
        filters.null_dates(df, "other")


def test_posts_fall_back_to_the_feed(spark):
    import json

    def post(link, title, content):
        return json.dumps({"id": 1, "date": "2024-05-01T23:10:00", "link": link, "title": {"rendered": title}, "content": {"rendered": content}})

    posts = spark.createDataFrame(
        [
            ("teaching_council", post("u1", "A &#8211; B", "<p>feed <b>one</b></p>")), ("teaching_council", post("u2", "C", "<p>feed two</p>")),
            ("teaching_council", post("u3", "D", "<p> </p>")), ("erc", post("u4", "E", "<p>Kept</p><p>Download the report</p>")),
            ("ades", post("u5", "F", "")), ("sera", post("u6", "G", "")), ("erc", "not json"),
        ],
        "source string, body string",
    )
    pages = spark.createDataFrame([("u1", "<main><p>Published 1 May</p><p>page one</p></main>"), ("u2", "<p>no main</p>")], "url string, html string")
    got = {r.url: (r.title, str(r.date), r.text) for r in corpus.articles_from_posts(posts, pages).collect()}
    assert {k: v for k, v in got.items() if k} == {
        "u1": ("A – B", "2024-05-01", "page one"), "u2": ("C", "2024-05-01", "feed two"),
        "u4": ("E", "2024-05-01", "Kept"), "u6": ("G", "2024-05-01", ""),
    }


def test_one_article_per_url_however_often_captured(spark):
    listing = spark.createDataFrame([("epi", "u", "listed", day("2024-05-01"), 1, 0)], "source string, url string, title string, date date, page int, pos int")
    captures = [(3, "u", "third"), (1, "u", "first"), (2, "u", "second"), (1, "u", "first"), (9, "other", "x")]
    schema = "page_id long, url string, html string"
    pages = spark.createDataFrame(captures, schema)
    assert [r.html for r in corpus.one_capture(pages).orderBy("url").collect()] == ["x", "first"]
    assert [r.html for r in corpus.one_capture(pages.drop("page_id")).filter("url = 'u'").collect()][0] in {"first", "second", "third"}
    assert corpus.one_capture(pages.drop("page_id")).count() == 2
    timed = pages.withColumn("captured_at", F.lit("2024-01-05").cast("date") - F.col("page_id").cast("int"))
    assert corpus.one_capture(timed).filter("url = 'u'").first().html == "third"
    assert corpus.one_capture(timed, ["page_id"]).filter("url = 'u'").first().html == "first"
    assert corpus.articles_from_listing(listing, pages).count() <= 1
