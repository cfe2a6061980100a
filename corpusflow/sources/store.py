"""A keyed store in hash buckets: an upsert rewrites the buckets of its keys, and no others.

Rows lie in ``data/<folder>/store_bucket=<n>``, a key always in the same bucket. A version is
one small table below ``versions``: the folder that holds each bucket. An upsert reads
the buckets that its keys fall into, writes their new state to a folder of its own and
then the next version, in which the other buckets keep their folders. Files are never
changed, and a version is one file, so readers see a whole version or the one before
it; a load that fails leaves the store as it was.

The number of buckets is set when the store is made: rows of the store divided by what
one task should rewrite. Versions have a row per bucket, which is all that the driver
reads.
"""

import json
import re
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.dedup import dedup_last
from ..rules import rows_frame
from ..session import sized

BUCKETS = 64
_BUCKET = "store_bucket"
_VERSION = "bucket INT, folder STRING, buckets INT, schema STRING"


def bucket_of(key, buckets: int) -> Column:
    """Bucket of a key: one column name or several. NULL is a key like any other."""
    names = [key] if isinstance(key, str) else list(key)
    return F.pmod(F.xxhash64(*names), F.lit(buckets)).cast("int")


def _versions(spark: SparkSession, root: str) -> DataFrame:
    schema = T.StructType.fromDDL(f"{_VERSION}, version BIGINT")
    return spark.read.schema(schema).parquet(f"{root}/versions")


def newest(spark: SparkSession, root: str) -> int:
    """Number of the newest version, from the names of their files."""
    return max(int(re.search(r"/version=(\d+)/", f).group(1)) for f in _versions(spark, root).inputFiles())


def version(spark: SparkSession, root: str, number: int | None = None) -> list:
    """A version's rows (bucket, folder, buckets, schema); the newest one by default."""
    number = newest(spark, root) if number is None else number
    rows = _versions(spark, root).filter(F.col("version") == number).collect()
    if not rows:
        raise ValueError(f"the store has no version {number}")
    return rows


def _schema(parts) -> T.StructType:
    return T.StructType.fromJson(json.loads(next(p.schema for p in parts if p.schema)))


def _rows(spark: SparkSession, root: str, parts, schema: T.StructType) -> DataFrame:
    """Rows of those buckets that hold any."""
    paths = [f"{root}/data/{p.folder}/{_BUCKET}={p.bucket}" for p in parts if p.folder]
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def read(spark: SparkSession, root: str, number: int | None = None) -> DataFrame:
    """Rows of a version, the newest one by default."""
    parts = version(spark, root, number)
    return _rows(spark, root, parts, _schema(parts))


def _write_rows(df: DataFrame, root: str, key, buckets: int) -> str:
    folder = uuid.uuid4().hex
    placed = df.withColumn(_BUCKET, bucket_of(key, buckets)).hint("rebalance", _BUCKET)
    placed.write.partitionBy(_BUCKET).parquet(f"{root}/data/{folder}")
    return folder


def _commit(spark: SparkSession, root: str, number: int, rows) -> None:
    # one file, and never over another one of that number
    names = dict(c.split(" ") for c in _VERSION.split(", "))
    rows_frame(spark, rows, **names).coalesce(1).write.mode("error").parquet(f"{root}/versions/version={number}")


def create(df: DataFrame, root: str, key="url", precedence=("precedence",), buckets: int = BUCKETS) -> int:
    """Version 0: one row per key, the last one by ``precedence``, which is not stored."""
    spark = df.sparkSession
    rows = dedup_last(df, key, precedence).drop(*precedence)
    folder = _write_rows(rows, root, key, buckets)
    written = spark.read.schema(f"{_BUCKET} INT").parquet(f"{root}/data/{folder}").distinct()
    held = {r[_BUCKET] for r in written.collect()}
    _commit(spark, root, 0, [(b, folder if b in held else None, buckets, None if b else rows.schema.json()) for b in range(buckets)])
    return 0


def apply(updates: DataFrame, root: str, key="url", precedence=("precedence",)) -> int:
    """The next version: new keys inserted, known ones replaced. Returns its number.

    Updates are computed once and reduced to a row per key. Two loads at a time: the
    second one to finish fails and may be run again.
    """
    spark = updates.sparkSession
    number = newest(spark, root)
    parts = version(spark, root, number)
    buckets = parts[0].buckets
    latest = sized(dedup_last(updates, key, precedence), "updates")
    touched = {r[0] for r in latest.select(bucket_of(key, buckets)).distinct().collect()}
    if not touched:
        return number
    names = [key] if isinstance(key, str) else list(key)
    keys = latest.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(names)])
    same = [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(names)]
    old = [p for p in parts if p.bucket in touched]
    kept = _rows(spark, root, old, _schema(parts)).join(keys, same, "left_anti")
    folder = _write_rows(kept.unionByName(latest.select(*kept.columns)), root, key, buckets)
    _commit(spark, root, number + 1, [(p.bucket, folder if p.bucket in touched else p.folder, buckets, p.schema) for p in parts])
    return number + 1
