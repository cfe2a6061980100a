"""Incremental forms on Structured Streaming.

Each runs on what has newly landed and stops (availableNow), as a weekly job
would. Sinks write one folder per micro batch and replace it when a batch is
retried after a lost executor or driver, so results do not depend on retries.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.dedup import dedup_first, dedup_last


def landed(spark: SparkSession, path: str, schema, files_per_batch: int | None = None) -> DataFrame:
    """A stream over Parquet files as they land in a folder, or match a path pattern."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def _run(writer, checkpoint: str):
    query = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def write_batches(stream: DataFrame, out: str, checkpoint: str, transform=None):
    """Apply a batch transform to each micro batch and write it under batch_id=N.

    Suits transforms that look at one batch as a whole, such as the cleaning
    chain: batches are cleaned one by one and not deduplicated across.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        done = transform(batch) if transform else batch
        done.write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

    return _run(stream.writeStream.foreachBatch(write), checkpoint)


def upsert_batches(
    stream: DataFrame, out: str, checkpoint: str, key="url", precedence=("precedence",)
):
    """Streaming upsert: each micro batch becomes one set of changes, one row per key.

    A batch writes only its own rows, however large the store has grown; readers
    use current_rows.
    """
    return write_batches(stream, out, checkpoint, lambda b: dedup_last(b, key, precedence))


def current_rows(changes: DataFrame, key="url", precedence=("precedence",)) -> DataFrame:
    """State of the store: per key the change of the latest batch."""
    return dedup_last(changes, key, ("batch_id", *precedence))


def weekly_window(ts: Column) -> Column:
    """Seven-day windows that start on Fridays (the epoch was a Thursday)."""
    return F.window(ts, "7 days", "7 days", "1 day")


def weekly_window_counts(df: DataFrame, ts: str = "ts", by=("source",)) -> DataFrame:
    """Rows per week and group; the same for a batch and a stream."""
    return (
        df.groupBy(weekly_window(F.col(ts)).alias("w"), *by)
        .agg(F.count("*").alias("n"))
        .select(F.to_date("w.start").alias("week_start"), *by, "n")
    )


def write_weekly_counts(stream: DataFrame, out: str, checkpoint: str, ts: str = "ts", by=("source",)):
    """Running weekly counts; every batch writes the counts that it changed."""
    counts = weekly_window_counts(stream, ts, by)

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

    return _run(counts.writeStream.outputMode("update").foreachBatch(write), checkpoint)


def write_deduped(stream: DataFrame, out: str, checkpoint: str, key="url", order=("ts",)):
    """First row per key, each key written once however late its other rows arrive.

    A micro batch keeps its first row per key (``order`` must be total) whose key no
    earlier batch has written; only the key column of the written rows is read. No
    watermark: a backfill of unseen keys stays, a late repeat goes. A retried batch
    sees the batches before it only, and replaces its own folder.
    """
    schema = T.StructType([stream.schema[key], T.StructField("batch_id", T.LongType())])

    def write(batch: DataFrame, batch_id: int) -> None:
        first = dedup_first(batch, key, order)
        if batch_id:
            written = batch.sparkSession.read.schema(schema).parquet(out).filter(F.col("batch_id") < batch_id)
            first = first.join(written.select(key), key, "left_anti").select(*batch.columns)
        first.write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

    return _run(stream.writeStream.foreachBatch(write), checkpoint)
