"""The cleaning chain and its accounting."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import is_blank
from ..session import sized
from .dedup import dedup_first, dedup_first_wide
from .filters import drop_blank, flag_language, is_title_rejected, title_filter


def clean(
    df: DataFrame, order=("ordinal", "pos"), exclude=None, include=None, lists=None, key="url", wide: bool = True,
    once: bool = True,
) -> DataFrame:
    """Blank text out, title filter, language flag, keep-first by key; in this order.

    The first three are one narrow stage; the last is the only exchange, which
    carries keys instead of texts (see dedup_first_wide; runs a job); languages are
    flagged after it, for the rows that stay. Keys and rows are two readings of that
    stage, so it is written to the shared folder ``once``: then whatever computes
    ``df``, an extraction say, runs a single time, and the first reading takes key
    columns only. Without ``once`` both read ``df`` itself, which is right for a plain
    scan. Without ``wide`` all is lazy, and texts move.
    """
    kept = df.transform(drop_blank).transform(title_filter, exclude, include)
    if wide:
        kept = sized(kept, "narrow") if once else kept
        return kept.transform(dedup_first_wide, key, order).transform(flag_language, lists)
    return kept.transform(flag_language, lists).transform(dedup_first, key, order)


def step_counts(df: DataFrame, exclude=None, include=None, key: str = "url") -> DataFrame:
    """Rows before, after and removed for each cleaning step, in one pass.

    Counts are summed per key first, which also tells how many distinct keys
    survive; a hot key collapses on the map side.
    """
    blank = is_blank(F.col("text"))
    rejected = ~blank & is_title_rejected(F.col("title"), exclude, include)

    def n(test):
        return F.sum(test.cast("long"))

    per_key = (
        df.select(key, blank.alias("_b"), rejected.alias("_r"))
        .groupBy(key)
        .agg(F.count("*").alias("n"), n(F.col("_b")).alias("b"), n(F.col("_r")).alias("r"))
    )
    totals = per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n"),
        F.coalesce(F.sum("b"), F.lit(0)).alias("b"),
        F.coalesce(F.sum("r"), F.lit(0)).alias("r"),
        F.count(F.when(F.col("n") > F.col("b") + F.col("r"), 1)).alias("keys"),
    )
    a, b = F.col("n") - F.col("b"), F.col("n") - F.col("b") - F.col("r")
    steps = [
        (1, "blank_text", F.col("n"), a),
        (2, "title", a, b),
        (3, "duplicate", b, F.col("keys")),
    ]
    rows = F.array(*[
        F.struct(
            F.lit(i).alias("step_no"), F.lit(name).alias("step"),
            before.alias("n_before"), after.alias("n_after"), (before - after).alias("n_removed"),
        )
        for i, name, before, after in steps
    ])
    return totals.select(F.inline(rows))
