"""Weekly counts as increments: windows end at a watermark, later rows become corrections.

Counts add up, so a micro batch writes only what it adds to each week and group and no
state is kept between batches: memory depends on one batch, however many weeks and
groups there have been. The watermark is the latest event time of the batches before,
less ``delay``. A week that ended before it is closed; what a batch still brings for a
closed week is marked late, which is the correction of a count already reported. No
row is dropped.
"""

import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .ingest import _run, weekly_window

DELAY = datetime.timedelta(days=7)


def _watermark(changes: DataFrame, delay: datetime.timedelta):
    """Event time up to which weeks are closed, as a column; None before the first row.

    One row reaches the driver, as text, so that its time zone is the session's both ways.
    """
    latest = changes.agg(F.max("latest").cast("string")).first()[0]
    return None if latest is None else F.lit(latest).cast(changes.schema["latest"].dataType) - F.lit(delay)


def weekly_increments(df: DataFrame, closed_to=None, ts: str = "ts", by=("source",)) -> DataFrame:
    """What rows add to their weeks: week_start, week_end, the groups, n, latest and late.

    ``late`` says that the week ended at or before ``closed_to``. Rows without a time have no
    week and are left out, as in weekly_window_counts; NULL is a group like any other.
    """
    late = F.lit(False) if closed_to is None else F.col("w.end") <= closed_to
    return (
        df.groupBy(weekly_window(F.col(ts)).alias("w"), *by)
        .agg(F.count("*").alias("n"), F.max(ts).alias("latest"))
        .select(F.to_date("w.start").alias("week_start"), F.to_date("w.end").alias("week_end"), *by, "n", "latest", late.alias("late"))
    )


def write_weekly_increments(
    stream: DataFrame, out: str, checkpoint: str, ts: str = "ts", by=("source",), delay: datetime.timedelta = DELAY
):
    """Append each micro batch's increments; a retried batch replaces its own folder.

    The watermark of a batch comes from the batches before it alone, so a retry marks
    the same rows late.
    """
    schema = weekly_increments(stream, None, ts, by).schema.add("batch_id", "long")

    def write(batch: DataFrame, batch_id: int) -> None:
        closed_to = None
        if batch_id:
            before = batch.sparkSession.read.schema(schema).parquet(out).filter(F.col("batch_id") < batch_id)
            closed_to = _watermark(before, delay)
        weekly_increments(batch, closed_to, ts, by).write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

    return _run(stream.writeStream.foreachBatch(write), checkpoint)


def weekly_totals(changes: DataFrame, by=("source",), delay: datetime.timedelta = DELAY) -> DataFrame:
    """Counts per week and group: n, n_late of them corrections, and whether the week is closed.

    n equals the count over all rows at once. No increments: no rows. Runs a job.
    """
    closed_to = _watermark(changes, delay)
    closed = F.lit(False) if closed_to is None else F.col("week_end") <= closed_to
    return (
        changes.groupBy("week_start", "week_end", *by)
        .agg(F.sum("n").alias("n"), F.sum(F.when(F.col("late"), F.col("n")).otherwise(0)).alias("n_late"))
        .select("week_start", *by, "n", "n_late", closed.alias("closed"))
    )
