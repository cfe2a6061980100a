"""The bucketed store: which folders an upsert writes, what readers see, what a failure leaves."""

import pytest
from pyspark.sql import functions as F

from corpusflow.session import work_folder
from corpusflow.sources import sinks, store


def rows(spark, ids, text, at=0):
    return spark.range(1).select(F.explode(F.array(*[F.lit(i) for i in ids])).alias("i")).select(
        F.when(F.col("i") >= 0, F.concat(F.lit("u"), F.col("i").cast("string"))).alias("url"), F.lit(text).alias("text"), F.lit(at).alias("precedence")
    )


def seen(df):
    return {r.url: r.text for r in df.collect()}


def test_an_upsert_rewrites_the_buckets_of_its_keys_only(spark):
    root = work_folder(spark, "store")
    assert store.create(rows(spark, range(200), "a"), root, buckets=32) == 0
    before = {p.bucket: p.folder for p in store.version(spark, root)}
    assert len(before) == 32 and len(set(before.values())) == 1
    # one known key twice, one new key
    updates = rows(spark, [7], "old", 1).unionByName(rows(spark, [7, 500], "b", 2))
    assert store.apply(updates, root) == 1
    after = {p.bucket: p.folder for p in store.version(spark, root)}
    touched = {r.b for r in updates.select(store.bucket_of("url", 32).alias("b")).collect()}
    assert {b for b in after if after[b] != before[b]} == touched and len(touched) <= 2
    written = spark.read.parquet(f"{root}/data/{after[min(touched)]}")
    assert {r.store_bucket for r in written.collect()} == touched
    want = {f"u{i}": "a" for i in range(200)}
    assert seen(store.read(spark, root, 0)) == want
    assert seen(store.read(spark, root)) == {**want, "u7": "b", "u500": "b"}
    assert store.read(spark, root).columns == ["url", "text"] and store.read(spark, root).count() == 201


def test_a_failed_load_leaves_the_store(spark):
    root = work_folder(spark, "store")
    store.create(rows(spark, range(20), "a"), root, buckets=4)
    bad = rows(spark, [1, 2], "b").withColumn("text", F.raise_error(F.lit("stop")).cast("string"))
    with pytest.raises(Exception, match="stop"):
        store.apply(bad, root)
    # rows written, but no version: the next load does not see them
    store._write_rows(rows(spark, [3], "lost").drop("precedence"), root, "url", 4)
    assert store.newest(spark, root) == 0 and set(seen(store.read(spark, root)).values()) == {"a"}
    assert store.apply(rows(spark, [1], "c"), root) == 1
    with pytest.raises(Exception):  # a version is written once
        store._commit(spark, root, 1, [(0, None, 4, "{}")])
    assert seen(store.read(spark, root))["u1"] == "c"
    with pytest.raises(ValueError):
        store.read(spark, root, 9)


def test_empty_stores_null_keys_and_other_columns(spark):
    root = work_folder(spark, "store")
    store.create(rows(spark, [1], "a").filter("false"), root, buckets=3)
    assert store.read(spark, root).collect() == [] and store.read(spark, root).columns == ["url", "text"]
    assert store.apply(rows(spark, [1], "a").filter("false"), root) == 0
    assert store.apply(rows(spark, [-1, 2], "x").withColumn("more", F.lit(1)), root) == 1
    assert store.apply(rows(spark, [-1], "y"), root) == 2
    assert seen(store.read(spark, root)) == {None: "y", "u2": "x"} and store.read(spark, root).count() == 2


def test_keys_of_several_columns(spark):
    root = work_folder(spark, "store")
    df = spark.createDataFrame([(1, "a", 10, 0), (1, "b", 11, 0), (2, "a", 12, 0), (1, "a", 13, 1)], "k long, s string, v int, at int")
    store.create(df, root, ("k", "s"), ("at",), buckets=5)
    store.apply(df.filter("v = 11").withColumn("v", F.lit(99)), root, ("k", "s"), ("at",))
    assert sorted(map(tuple, store.read(spark, root).collect())) == [(1, "a", 13), (1, "b", 99), (2, "a", 12)]


def test_a_run_is_appended_once(spark):
    root = work_folder(spark, "runs")
    df = spark.createDataFrame([("u1", "eng", "gov"), ("u2", "eng", "epi"), ("u3", "sco", "sera")], "url string, country string, source string")

    def held():
        return sorted((r.run, r.url, r.country, r.source) for r in sinks.read_runs(spark, root).collect())

    sinks.append_run(df, root, "r1")
    first = held()
    sinks.append_run(df, root, "r1")
    assert held() == first and len(first) == 3
    bad = df.withColumn("url", F.raise_error(F.lit("stop")).cast("string"))
    with pytest.raises(Exception, match="stop"):
        sinks.append_run(bad, root, "r1")
    assert held() == first
    sinks.append_run(df.filter("country = 'sco'"), root, "it's 2")
    assert held() == sorted([*first, ("it's 2", "u3", "sco", "sera")])
    # a rerun with fewer sources leaves nothing of the earlier one
    sinks.append_run(df.filter("source = 'gov'"), root, "r1")
    assert held() == [("it's 2", "u3", "sco", "sera"), ("r1", "u1", "eng", "gov")]
