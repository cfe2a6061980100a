"""Every registered query against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as entry_points
import compare

SF = "/root/testdata/sf0.001"
QUERIES, ORACLE = entry_points.queries(), entry_points.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return compare.connect(SF)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_same_rows_as_sql(spark, con, name):
    assert compare.differences(QUERIES[name](spark, SF), con, ORACLE[name]) == []


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_runs(spark, name):
    assert QUERIES[name](spark, SF).count() > 0


def test_streamed_dedup_keeps_each_key_once(spark):
    urls = [r.url for r in QUERIES["streamed_dedup"](spark, SF).collect()]
    events = spark.read.parquet(f"{SF}/events.parquet")
    assert sorted(urls) == sorted(str(r.user_id) for r in events.select("user_id").distinct().collect())


def test_entry(spark):
    df = entry_points.entry(spark)
    assert df.columns == ["host", "language", "n", "share"]
    assert df.count() > 0


def test_sql_only_for_known_queries():
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize(
    "name", ["run_windows", "cut_streak_listing", "cleaned_articles_wide", "upserted_store", "weekly_summary", "share_table"]
)
def test_same_rows_without_broadcasts(spark, con, name):
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        assert compare.differences(QUERIES[name](spark, SF), con, ORACLE[name]) == []
    finally:
        spark.conf.set(key, before)
