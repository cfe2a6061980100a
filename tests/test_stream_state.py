"""Streams without state in memory: indexed keys and weekly increments."""

import datetime

import pytest
from pyspark.sql import functions as F

from corpusflow.session import work_folder
from corpusflow.sources.store import bucket_of
from corpusflow.streaming import ingest, keys, weeks

EVENT = "k string, ts timestamp, v int"


def at(text):
    return datetime.datetime.fromisoformat(text)


def land(spark, folder, rows):
    spark.createDataFrame(rows, EVENT).coalesce(1).write.mode("append").parquet(folder)


@pytest.fixture
def folders(spark):
    root = work_folder(spark, "state")
    return [f"{root}/{name}" for name in ("in", "out", "index", "checkpoint")]


def test_keys_are_written_once(spark, folders):
    src, out, index, checkpoint = folders
    schema = spark.createDataFrame([], EVENT).schema

    def run(rows):
        land(spark, src, rows)
        keys.write_deduped(ingest.landed(spark, src, schema), out, index, checkpoint, "k", ("ts", "v"), 8)
        return sorted((str(r.k), r.v) for r in spark.read.parquet(out).collect())

    assert run([("a", at("2024-01-05"), 2), ("a", at("2024-01-05"), 1), (None, at("2024-01-05"), 7)]) == [("None", 7), ("a", 1)]
    # repeats, one of them long after, a backfill of an unseen key, and the null key again
    rows = [("a", at("2025-01-05"), 3), ("b", at("2023-01-05"), 4), (None, at("2024-01-06"), 8), ("b", at("2023-01-06"), 5)]
    assert run(rows) == [("None", 7), ("a", 1), ("b", 4)]
    assert run([("a", at("2024-01-05"), 9)]) == [("None", 7), ("a", 1), ("b", 4)]  # a batch of repeats only
    assert run([]) == [("None", 7), ("a", 1), ("b", 4)]
    assert run([("c", None, 1)]) == [("None", 7), ("a", 1), ("b", 4), ("c", 1)]


def test_a_batch_reads_the_buckets_of_its_keys(spark, folders):
    src, out, index, checkpoint = folders
    land(spark, src, [(f"k{n}", at("2024-01-05"), n) for n in range(200)])
    schema = spark.createDataFrame([], EVENT).schema
    keys.write_deduped(ingest.landed(spark, src, schema), out, index, checkpoint, "k", ("ts",), 8)
    one = spark.createDataFrame([("k3",)], "k string").select(bucket_of("k", 8)).first()[0]
    read = keys.written(spark, index, schema["k"].dataType, 1, [one])
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(batch_id" in plan and "key_bucket#" in plan.split("PartitionFilters")[1].split("PushedFilters")[0]
    assert 0 < read.count() < 200
    assert keys.written(spark, index, schema["k"].dataType, 0, list(range(8))).count() == 0  # a retry of batch 0


def test_equal_hashes_of_different_keys_lose_nothing(spark):
    rows = spark.createDataFrame([("a", 1), ("b", 1), ("c", 2)], "k string, key_hash long")
    seen = spark.createDataFrame([(1, "b"), (2, "x"), (3, "c")], "key_hash long, written_key string")
    assert sorted(r.k for r in keys.unseen(rows, seen, "k").collect()) == ["a", "c"]


def test_reserved_names_are_refused(spark, folders):
    src, out, index, checkpoint = folders
    land(spark, src, [])
    stream = ingest.landed(spark, src, spark.createDataFrame([], EVENT).schema).withColumn("key_hash", F.lit(1))
    with pytest.raises(ValueError, match="key_hash"):
        keys.write_deduped(stream, out, index, checkpoint, "k")


def test_closed_weeks_get_corrections(spark, folders):
    src, out, _, checkpoint = folders
    schema = spark.createDataFrame([], EVENT).schema

    def run(rows):
        land(spark, src, rows)
        weeks.write_weekly_increments(ingest.landed(spark, src, schema), out, checkpoint, "ts", ("k",))
        total = weeks.weekly_totals(spark.read.parquet(out), ("k",))
        return {(str(r.week_start), r.k): (r.n, r.n_late, r.closed) for r in total.collect()}

    assert run([]) == {}
    assert run([("a", at("2024-01-05"), 1), ("a", at("2024-01-11T23:59:59"), 1), ("x", None, 1)]) == {("2024-01-05", "a"): (2, 0, False)}
    # the first week is closed once a row is seven days past its end
    assert run([("a", at("2024-01-19"), 1), (None, at("2024-01-06"), 1)]) == {
        ("2024-01-05", "a"): (2, 0, True), ("2024-01-05", None): (1, 0, True), ("2024-01-19", "a"): (1, 0, False),
    }
    found = run([("a", at("2024-01-08"), 1), ("a", at("2024-01-20"), 1)])
    assert found[("2024-01-05", "a")] == (3, 1, True) and found[("2024-01-19", "a")] == (2, 0, False)
    rows = spark.read.parquet(src)
    whole = {(str(r.week_start), r.k): r.n for r in ingest.weekly_window_counts(rows, "ts", ("k",)).collect()}
    assert whole == {key: value[0] for key, value in found.items()}
