"""Levelled merges of change folders: the same state, few folders, nothing lost by a failure."""

import pytest
from pyspark.sql import functions as F

from corpusflow.session import work_folder
from corpusflow.streaming import compact, ingest

KEY, ORDER = "url", ("at",)


def write(spark, out, batch, rows):
    df = spark.createDataFrame(rows, "url string, text string, at long")
    df.coalesce(1).write.mode("overwrite").parquet(f"{out}/batch_id={batch}")


def state(df):
    return sorted((str(r.url), r.text, r.batch_id) for r in df.collect())


def test_state_stays_the_same_while_runs_stay_few(spark):
    out, root = work_folder(spark, "out"), work_folder(spark, "runs")
    for batch in range(20):
        rows = [(f"u{k}", f"{batch}", batch * 100 + k) for k in range(30) if (k * 7 + batch) % 5 == 0]
        write(spark, out, batch, [*rows, ("hot", str(batch), 5), ("hot", "lower", 4), (None, str(batch), 1)])
        runs = compact.compact(spark, out, root, KEY, ORDER, fanout=3) if batch % 2 else compact._levels(spark, root)[1]
        levels = [r[0] for r in runs]
        assert all(levels.count(level) < 3 for level in levels) and levels == sorted(levels, reverse=True)
        spans = [(low, high) for _, low, high, _ in runs]
        assert all(a[1] + 1 == b[0] for a, b in zip(spans, spans[1:])) and compact.covered(spark, root) < batch
        if batch in (0, 7, 19):
            whole = ingest.current_rows(spark.read.parquet(out), KEY, ORDER)
            assert state(compact.current_rows(spark, out, root, KEY, ORDER)) == state(whole)
    assert max(r[0] for r in runs) >= 2 and len(runs) <= 4
    files = compact.current_rows(spark, out, root, KEY, ORDER).inputFiles()
    assert len(files) < 12  # of 20 batches


def test_a_failed_merge_changes_nothing(spark, monkeypatch):
    out, root = work_folder(spark, "out"), work_folder(spark, "runs")
    for batch in range(4):
        write(spark, out, batch, [("a", str(batch), batch), (f"b{batch}", "x", 0)])
    want = state(compact.current_rows(spark, out, root, KEY, ORDER))

    def fails(*rows, **columns):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(compact, "rows_frame", fails)  # behind the run, before the table
        with pytest.raises(RuntimeError):
            compact.compact(spark, out, root, KEY, ORDER, fanout=2)
    assert compact.covered(spark, root) == -1
    assert state(compact.current_rows(spark, out, root, KEY, ORDER)) == want
    compact.compact(spark, out, root, KEY, ORDER, fanout=2)
    assert compact.covered(spark, root) == 2 and state(compact.current_rows(spark, out, root, KEY, ORDER)) == want
    # the newest batch is not in a run: writing it again takes effect
    write(spark, out, 3, [("a", "again", 9)])
    assert ("a", "again", 3) in state(compact.current_rows(spark, out, root, KEY, ORDER))


def test_nothing_to_merge_and_empty_batches(spark):
    out, root = work_folder(spark, "out"), work_folder(spark, "runs")
    for batch in range(3):
        write(spark, out, batch, [])
    assert compact.current_rows(spark, out, root, KEY, ORDER).collect() == []
    assert compact.compact(spark, out, root, KEY, ORDER, fanout=8) == []
    assert compact.current_rows(spark, out, root, KEY, ORDER).filter(F.lit(True)).collect() == []
