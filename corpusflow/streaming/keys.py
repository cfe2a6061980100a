"""Streaming dedup against an index of written keys, in hash buckets.

The index holds a row per written key below ``batch_id=<n>/key_bucket=<b>``: its 64-bit hash
and the key. A micro batch is reduced to its first row per key and looks up the buckets
its keys fall into, first by hash alone (eight bytes a key, sorted, so row groups prune);
the keys themselves are read only to settle hashes that were met, so equal hashes of
different keys lose nothing. No state stays in memory between batches.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.dedup import dedup_first
from ..session import sized
from ..sources.store import bucket_of
from .ingest import _run

BUCKETS = 256
_BUCKET, _HASH, _KEY = "key_bucket", "key_hash", "written_key"


def written(spark: SparkSession, index: str, key_type: T.DataType, before: int, buckets: list[int]) -> DataFrame:
    """Hashes and keys that batches before one have written, in the given buckets only."""
    schema = T.StructType([
        T.StructField(_HASH, T.LongType()), T.StructField(_KEY, key_type),
        T.StructField("batch_id", T.LongType()), T.StructField(_BUCKET, T.IntegerType()),
    ])
    table = spark.read.schema(schema).parquet(index)
    return table.filter((F.col("batch_id") < before) & F.col(_BUCKET).isin(buckets))


def unseen(rows: DataFrame, seen: DataFrame, key: str) -> DataFrame:
    """Rows, one per key with its key_hash, whose key is not among the written ones."""
    met = sized(rows.select(_HASH).join(seen.select(_HASH), _HASH, "left_semi"), "met-hashes")
    known = seen.join(met, _HASH, "left_semi").select(_KEY)
    return rows.join(known, F.col(key).eqNullSafe(F.col(_KEY)), "left_anti")


def write_deduped(
    stream: DataFrame, out: str, index: str, checkpoint: str, key: str = "url", order=("ts",), buckets: int = BUCKETS
):
    """First row per key, each key written once however late its other rows arrive.

    As ingest.write_deduped, but a batch reads of the written keys only the buckets
    that its own keys fall into. ``order`` must be total within a key. NULL is a key like any
    other: one row of it is written. A retried batch reads the batches before it only,
    and replaces its own rows and index folder. An empty batch writes no rows. The number
    of buckets is set once and belongs to the index. Columns named key_hash, key_bucket or
    written_key are refused.
    """
    clash = {_BUCKET, _HASH, _KEY} & set(stream.columns)
    if clash:
        raise ValueError(f"reserved column names: {sorted(clash)}")
    key_type = stream.schema[key].dataType

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = sized(dedup_first(batch, key, order).withColumn(_HASH, F.xxhash64(key)), "batch-first")
        if batch_id:
            # at most one row per bucket
            touched = [r[0] for r in rows.select(bucket_of(key, buckets)).distinct().collect()]
            rows = unseen(rows, written(batch.sparkSession, index, key_type, batch_id, touched), key)
        new = sized(rows, "batch-new")
        keys = new.select(_HASH, F.col(key).alias(_KEY), bucket_of(key, buckets).alias(_BUCKET))
        keys = keys.hint("rebalance", _BUCKET).sortWithinPartitions(_BUCKET, _HASH)
        keys.write.mode("overwrite").partitionBy(_BUCKET).parquet(f"{index}/batch_id={batch_id}")
        new.drop(_HASH).write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

    return _run(stream.writeStream.foreachBatch(write), checkpoint)
