"""Keep-first, last-wins and set operators.

A key may be held by a large share of all rows. Rank-one windows are safe then:
Catalyst turns ``row_number() = 1`` into a group limit that runs before the
exchange, so a task sends at most one row per key. Anti joins take distinct keys.
"""

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import sized


def _keys(key):
    return [key] if isinstance(key, str) else list(key)


def _rank_one(df: DataFrame, keys, order) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")


def dedup_first(df: DataFrame, key="url", order=("ordinal", "pos")) -> DataFrame:
    """One row per key: the first in ``order``, which must be a total order.

    NULL keys count as equal, so one row without a key stays.
    """
    return _rank_one(df, _keys(key), order)


def dedup_first_wide(df: DataFrame, key="url", order=("ordinal", "pos")) -> DataFrame:
    """dedup_first for wide rows of which few are duplicates.

    Only keys and order columns are shuffled, counted on the map side first. The
    keys that occur more than once are written out, so that their real size is
    known; where it is small they are broadcast and no text moves at all. Only
    rows that tie for first place, if there are any, go through a window. Runs
    a job.
    """
    keys, order = _keys(key), list(order)
    repeated = (
        df.groupBy(*keys, *order).agg(F.count("*").alias("_c"))
        .groupBy(*keys).agg(F.min(F.struct(*order, "_c")).alias("_m"), F.sum("_c").alias("_n"))
        .filter("_n > 1")
        .select(
            *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)],
            F.struct(*[f"_m.{c}" for c in order]).alias("_first"), F.col("_m._c").alias("_ties"),
        )
    )
    side = sized(repeated, "repeated-keys")
    same = [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)]
    first = df.join(side, same, "left").filter(
        F.col("_first").isNull() | (F.struct(*order) == F.col("_first"))
    )
    single = first.filter(F.coalesce(F.col("_ties") == 1, F.lit(True))).select(*df.columns)
    if side.filter("_ties > 1").limit(1).count() == 0:
        return single
    return single.unionByName(_rank_one(first.filter("_ties > 1").select(*df.columns), keys, order))


def dedup_last(df: DataFrame, key="url", precedence=("precedence",)) -> DataFrame:
    """One row per key: the last write wins, its NULLs included."""
    return _rank_one(df, _keys(key), [F.col(c).desc() for c in precedence])


def dedup_scope(df: DataFrame, scope=("source",), key="url", order=("page", "pos")) -> DataFrame:
    """Keep-first within a scope: per source, per source and section, or none at all."""
    if scope is None:
        return df
    return _rank_one(df, [*_keys(scope), *_keys(key)], order)


def frontier(links: DataFrame, captured: DataFrame, key: str = "url") -> DataFrame:
    """Distinct links that are not captured yet."""
    return (
        links.select(key).distinct().filter(F.col(key).isNotNull())
        .join(captured.select(key), key, "left_anti")
    )


def union_sources(*frames: DataFrame) -> DataFrame:
    """Concatenate frames; a column that one of them lacks is NULL there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def upsert(
    target: DataFrame, updates: DataFrame, key="url", precedence=("precedence",), write_keys: bool = False
) -> DataFrame:
    """Target with updates applied: insert new keys, replace known ones.

    Updates are reduced to one row per key first. The target is only filtered
    against their keys, so its wide rows are not sorted, and not moved either
    where those keys are small enough to broadcast. ``write_keys`` writes the
    keys out first, so that Catalyst knows their size (runs a job). NULL keys count
    as equal: an update without a key replaces the row without one.
    """
    latest = dedup_last(updates, key, precedence)
    keys = updates.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(_keys(key))]).distinct()
    keys = sized(keys, "keys") if write_keys else keys
    same = [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(_keys(key))]
    kept = target.join(keys, same, "left_anti")
    return kept.unionByName(latest.select(*target.columns))
