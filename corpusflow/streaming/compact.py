"""Levelled merges of the change folders that a streaming upsert leaves behind.

A run is the last change per key of consecutive micro batches. Once ``fanout`` batches
are there they become a run of level 1, ``fanout`` runs of a level become one of the
next, so the state is read from a number of folders that grows with the logarithm of
the number of batches, and a row is rewritten once for each level. Which runs hold is
one small table below ``levels``, written as one file after the run itself: a merge
that fails leaves some files that nobody reads. Batch folders are not touched; those up
to ``covered`` may be deleted by whoever owns them.
"""

import re
import uuid
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.dedup import dedup_last
from ..rules import rows_frame

FANOUT = 8
_LEVELS = {"level": "INT", "low": "BIGINT", "high": "BIGINT", "folder": "STRING"}


def _levels(spark: SparkSession, root: str) -> tuple[int, list]:
    """Number of the newest table of runs, and its rows (level, low, high, folder); -1 before the first."""
    schema = T.StructType.fromDDL(", ".join(f"{c} {t}" for c, t in _LEVELS.items()) + ", version BIGINT")
    try:
        table = spark.read.schema(schema).parquet(f"{root}/levels")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return -1, []
    found = [int(re.search(r"/version=(\d+)/", f).group(1)) for f in table.inputFiles()]
    if not found:
        return -1, []
    rows = table.filter(F.col("version") == max(found)).drop("version").collect()
    return max(found), sorted((tuple(r) for r in rows), key=lambda r: r[1])


def covered(spark: SparkSession, root: str) -> int:
    """The last micro batch that a run holds; -1 if there is none."""
    return max((high for _, _, high, _ in _levels(spark, root)[1]), default=-1)


def _batches(spark: SparkSession, out: str, above: int) -> list[int]:
    # folder names only; a row for each batch behind the last run
    names = spark.read.schema("batch_id BIGINT").parquet(out).filter(F.col("batch_id") > above)
    return sorted(r.batch_id for r in names.distinct().collect())


def _read(spark: SparkSession, out: str, root: str, runs) -> list[DataFrame]:
    """The rows of runs; one without a folder is a micro batch as it was written."""
    frames = []
    for _, low, _, folder in runs:
        if folder is None:
            frames.append(spark.read.parquet(f"{out}/batch_id={low}").withColumn("batch_id", F.lit(low).cast("long")))
        else:
            frames.append(spark.read.parquet(f"{root}/runs/{folder}"))
    return frames


def _last(frames: list[DataFrame], key, precedence) -> DataFrame:
    return dedup_last(reduce(DataFrame.unionByName, frames), key, ("batch_id", *precedence))


def compact(spark: SparkSession, out: str, root: str, key="url", precedence=("precedence",), fanout: int = FANOUT) -> list:
    """Merge what is due; returns the runs that hold afterwards as (level, low, high, folder).

    The newest batch is left out, as the stream may still write it again. Empty batches
    hold nothing and are passed over. Run it by one job at a time, beside the stream if wanted.
    """
    number, runs = _levels(spark, root)
    fresh = _batches(spark, out, max((r[2] for r in runs), default=-1))[:-1]
    pending = [*runs, *[(0, b, b, None) for b in fresh]]
    level = 0
    while level <= max((r[0] for r in pending), default=-1):
        due = [r for r in pending if r[0] == level]
        if len(due) >= fanout:
            folder = uuid.uuid4().hex
            _last(_read(spark, out, root, due), key, precedence).write.parquet(f"{root}/runs/{folder}")
            merged = (level + 1, due[0][1], due[-1][2], folder)
            pending = sorted([r for r in pending if r[0] != level] + [merged], key=lambda r: r[1])
        level += 1
    kept = [r for r in pending if r[3] is not None]
    if kept != runs:
        table = rows_frame(spark, kept, **_LEVELS).coalesce(1)
        table.write.mode("error").parquet(f"{root}/levels/version={number + 1}")
    return kept


def current_rows(spark: SparkSession, out: str, root: str, key="url", precedence=("precedence",)) -> DataFrame:
    """State of the store, from its runs and the batches behind them; as current_rows of all changes."""
    _, runs = _levels(spark, root)
    fresh = _batches(spark, out, max((r[2] for r in runs), default=-1))
    frames = _read(spark, out, root, [*runs, *[(0, b, b, None) for b in fresh]])
    return _last(frames or [spark.read.parquet(out)], key, precedence)
