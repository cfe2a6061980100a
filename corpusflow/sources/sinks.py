"""Writers. Rows are rebalanced before a partitioned write, which splits a hot
partition value over several tasks and merges small ones, so a write makes
neither one huge file nor thousands of tiny ones."""

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.dedup import dedup_last
from ..operators.routing import batch_name
from ..rules import rows_frame
from .files import CSV_OPTIONS


def write_training(df: DataFrame, root: str, append: bool) -> None:
    """One folder per (country, source); a source is added to or replaced as a whole."""
    writer = df.hint("rebalance", "country", "source").write.partitionBy("country", "source")
    if append:
        writer.mode("append").parquet(root)
    else:
        writer.mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(root)


def append_run(df: DataFrame, root: str, run: str) -> None:
    """Add a run's training rows once, however often it is tried.

    Rows go to a folder of their own; a commit record then names it as the run's. A
    run that is appended again takes the place of its earlier rows, whole: what a
    reader sees is one committed folder per run, never a part of one. See read_runs.
    """
    spark, folder = df.sparkSession, f"r{uuid.uuid4().hex}"
    df.hint("rebalance", "country", "source").write.partitionBy("country", "source").parquet(f"{root}/data/folder={folder}")
    record = rows_frame(spark, [(run, folder)], run="STRING", folder="STRING")
    record.withColumn("committed", F.current_timestamp()).coalesce(1).write.mode("append").parquet(f"{root}/commits")


def read_runs(spark: SparkSession, root: str) -> DataFrame:
    """The rows of all committed runs, with their run; the last commit of a run holds.

    A run may be empty, but not all of them. The driver reads one record per commit.
    """
    commits = dedup_last(spark.read.parquet(f"{root}/commits"), "run", ("committed", "folder")).collect()
    paths = [f"{root}/data/folder={c.folder}" for c in commits]
    names = rows_frame(spark, [(c.run, c.folder) for c in commits], run="STRING", folder="STRING")
    rows = spark.read.option("basePath", f"{root}/data").parquet(*paths)
    return rows.join(names, "folder").drop("folder")


def write_inference(df: DataFrame, root: str) -> None:
    """One folder per (country, batch), from the week and until columns; reruns replace it."""
    named = df.withColumn("batch", batch_name(F.col("week"), F.col("until"))).drop("week", "until")
    (
        named.hint("rebalance", "country", "batch")
        .write.partitionBy("country", "batch")
        .mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .parquet(root)
    )


def write_articles_csv(df: DataFrame, path: str, rows_per_file: int = 50_000) -> None:
    """Article CSV, in files small enough that each reads well as one task."""
    df.write.options(**CSV_OPTIONS).option("maxRecordsPerFile", rows_per_file).mode("overwrite").csv(path)


def run_log_rows(df: DataFrame, run_time, batch: str = "batch") -> DataFrame:
    """Rows per run and source, counted before cleaning; a run total per row.

    ``df`` has country, run_since, run_until, the batch and the source.
    """
    keys = ["country", "run_since", "run_until", batch]
    return (
        df.groupBy(*keys, "source").agg(F.count("*").alias("n"))
        .withColumn("run_time", F.lit(run_time).cast("timestamp"))
        .withColumnsRenamed({"run_since": "since", "run_until": "until", batch: "batch"})
        .select("run_time", "country", "since", "until", "batch", "source", "n")
    )


def log_run(df: DataFrame, path: str, run_time, batch: str = "batch") -> None:
    """Append a run's counts to the log table."""
    run_log_rows(df, run_time, batch).write.mode("append").parquet(path)


def log_totals(log: DataFrame) -> DataFrame:
    """Source counts and total per run."""
    return log.groupBy("run_time", "country", "batch").agg(
        F.count("*").alias("n_sources"), F.sum("n").alias("total")
    )


def plan_load(records: DataFrame) -> DataFrame:
    """What a load would write, per country, dataset type and week."""
    return records.groupBy("country", "dataset_type", "week_number").agg(F.count("*").alias("n"))
