"""Ordered cut-offs: which rows of a listing, read newest first, enter the corpus.

A listing is read page by page and position by position until a stop rule fires;
``old`` rows lie before the date range, ``skip`` rows after it, rows without a
date are neither. What follows the stop is lost, in range or not.

One source may hold a large share of all rows, so no window sorts the rows of a
source. Each rule finds its stop with aggregates over a few pages at a time and
combines one small row for each such chunk in order. The stops, a row per group, are
written out, so that Catalyst knows their size and need not shuffle the listing
on the few groups it has. So a rule runs a job when it is called.
"""

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import sized

GROUP = ("source", "section")


def mark(df: DataFrame, since=None, until=None, date: str = "date") -> DataFrame:
    """Add old and skip flags."""

    def flag(test):
        return F.coalesce(test, F.lit(False))

    d = F.col(date)
    old = F.lit(False) if since is None else flag(d < F.lit(since).cast("date"))
    skip = F.lit(False) if until is None else flag(d > F.lit(until).cast("date"))
    return df.withColumns({"old": old, "skip": skip})


def _ord(df: DataFrame) -> DataFrame:
    # page and position as one number, so the stop is a hash aggregate over longs
    return df.withColumn(
        "_ord", F.shiftleft(F.col("page").cast("long"), 32) + F.col("pos").cast("long")
    )


def _with_stop(df: DataFrame, stops: DataFrame, group) -> DataFrame:
    return df.join(sized(stops, "stops"), list(group), "left")


def _finish(df: DataFrame, reached, extra=()) -> DataFrame:
    return df.withColumn("kept", reached & ~F.col("old") & ~F.col("skip")).drop(*extra)


def first_old(df: DataFrame, group=GROUP) -> DataFrame:
    """Stop at the first old row. Adds kept."""
    rows = _ord(df)
    stops = rows.filter("old").groupBy(*group).agg(F.min("_ord").alias("_stop"))
    out = _with_stop(rows, stops, group)
    return _finish(out, F.coalesce(F.col("_ord") < F.col("_stop"), F.lit(True)), ("_ord", "_stop"))


def _streak(df: DataFrame, part, order: str, counts: str):
    """Add _n (running length of the current streak) and _open (no reset yet)."""
    w = Window.partitionBy(*part).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    run = F.sum(F.col(counts).cast("long")).over(w)
    base = F.max(F.when(~F.col(counts), F.col("_run"))).over(w)
    return (
        df.withColumn("_run", run)
        .withColumn("_base", base)
        .withColumn("_n", F.col("_run") - F.coalesce("_base", F.lit(0)))
        .withColumn("_open", F.col("_base").isNull())
    )


def streak_stops(
    df: DataFrame, k: int, counts: str, group=GROUP, order: str = "_ord", chunk="_chunk"
) -> DataFrame:
    """Per group, the first ``order`` at which k consecutive rows have ``counts`` set.

    Streaks may run across chunks. A chunk is summed up in one row: its first
    streak of k, its trailing streak, whether anything in it resets the streak,
    and where its leading streak would reach k given 1 .. k-1 rows carried in.
    Chunk rows are then combined in order; only those pass through one window.
    """
    inner = _streak(df, (*group, chunk), order, counts)
    o = F.col(order)
    summary = inner.groupBy(*group, chunk).agg(
        F.max_by("_n", o).alias("tail"),
        F.max(~F.col(counts)).alias("resets"),
        F.min(F.when(F.col("_n") >= k, o)).alias("hit"),
        *[
            F.min(F.when(F.col("_open") & F.col(counts) & (F.col("_n") >= k - j), o)).alias(f"lead{j}")
            for j in range(1, k)
        ],
    )
    w = Window.partitionBy(*group).orderBy(chunk)
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    carried = (
        summary.withColumn("cum", F.sum("tail").over(upto))
        .withColumn("base", F.max(F.when(F.col("resets"), F.col("cum") - F.col("tail"))).over(upto))
        .withColumn("out", F.col("cum") - F.coalesce("base", F.lit(0)))
        .withColumn("carry", F.lag("out", 1, 0).over(w))
    )
    lead = reduce(
        lambda acc, j: acc.when(F.col("carry") == j, F.col(f"lead{j}")),
        range(1, k),
        F.when(F.lit(False), F.lit(None).cast("long")),
    )
    stop = F.least(F.col("hit"), lead) if k > 1 else F.col("hit")
    return carried.groupBy(*group).agg(F.min(stop).alias("_stop"))


def streak(
    df: DataFrame, k: int, scope: str = "listing", reset_on_failed: bool = True,
    group=GROUP, chunk_pages: int = 32,
) -> DataFrame:
    """Stop at the k-th consecutive old row. Adds kept.

    scope "listing": the count runs on across pages; "page": it starts anew on
    each page. ``failed`` rows (a captured page that could not be used) are never
    kept; they reset the count, or with reset_on_failed=False are passed over.
    """
    rows = _ord(df if "failed" in df.columns else df.withColumn("failed", F.lit(False)))
    narrow = rows.select(*group, "page", "_ord", (F.col("old") & ~F.col("failed")).alias("_old"), "failed")
    if not reset_on_failed:
        narrow = narrow.filter(~F.col("failed"))
    if scope == "page":
        inner = _streak(narrow, (*group, "page"), "_ord", "_old")
        stops = inner.filter(F.col("_n") >= k).groupBy(*group).agg(F.min("_ord").alias("_stop"))
    else:
        chunked = narrow.withColumn("_chunk", F.floor(F.col("page") / chunk_pages))
        stops = streak_stops(chunked, k, "_old", group)
    out = _with_stop(rows, stops, group)
    reached = F.coalesce(F.col("_ord") < F.col("_stop"), F.lit(True)) & ~F.col("failed")
    extra = ("_ord", "_stop") if "failed" in df.columns else ("_ord", "_stop", "failed")
    return _finish(out, reached, extra)


def _page_stop(df: DataFrame, flag, k: int, group, chunk_pages: int) -> DataFrame:
    """Per group, the page that is the k-th consecutive one without a flagged row."""
    flags = df.groupBy(*group, "page").agg(F.max(F.coalesce(flag, F.lit(False))).alias("_good"))
    chunked = flags.select(
        *group,
        F.col("page").cast("long").alias("_ord"),
        (~F.col("_good")).alias("_bad"),
        F.floor(F.col("page") / chunk_pages).alias("_chunk"),
    )
    return streak_stops(chunked, k, "_bad", group)


def unproductive(df: DataFrame, flag, k: int = 1, group=GROUP, chunk_pages: int = 512) -> DataFrame:
    """Stop after k consecutive pages without a row for which ``flag`` holds. Adds kept.

    Rows of the stopping page itself still count.
    """
    stops = _page_stop(df, flag, k, group, chunk_pages)
    out = _with_stop(df, stops, group)
    reached = F.coalesce(F.col("page") <= F.col("_stop"), F.lit(True))
    return _finish(out, reached, ("_stop",))


def stale_pages(df: DataFrame, k: int = 3, group=GROUP, chunk_pages: int = 512) -> DataFrame:
    """Stop after k consecutive pages with no dated row inside the range. Adds kept."""
    in_range = F.col("date").isNotNull() & ~F.col("old") & ~F.col("skip")
    return unproductive(df, in_range, k, group, chunk_pages)


def first_seen(df: DataFrame, scope=("source",), key: str = "url", group=GROUP) -> DataFrame:
    """Add is_new: the link's first occurrence within the scope.

    Sections are read one after the other, in the order of their names.

    The first positions are joined back on (group, position), which is unique per
    row, so a link that stands on every page makes no hot join key.
    """
    rows = _ord(df)
    place = F.struct(*[c for c in group if c not in scope], "_ord")
    firsts = (
        rows.groupBy(*scope, key).agg(F.min(place).alias("_first"))
        .select(*scope, "_first.*", F.lit(True).alias("is_new"))
    )
    out = rows.join(firsts, [*group, "_ord"], "left")
    return out.withColumn("is_new", F.coalesce("is_new", F.lit(False))).drop("_ord")


def cut(marked: DataFrame) -> DataFrame:
    """Rows a rule kept."""
    return marked.filter("kept").drop("kept", "old", "skip")


def loss(marked: DataFrame) -> DataFrame:
    """Rows inside the date range that a rule did not reach."""
    return marked.filter(~F.col("kept") & ~F.col("old") & ~F.col("skip")).drop("kept", "old", "skip")
