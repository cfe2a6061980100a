"""Data-quality checks: each returns the offending groups or one row per check."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import rules
from ..functions.text import is_blank
from ..schema import ARTICLE_COLS


def orphan_sources(df: DataFrame, dim: DataFrame) -> DataFrame:
    """Sources in the data without a dimension row, and their rows."""
    counts = df.groupBy("source").agg(F.count("*").alias("n"))
    return counts.join(dim.select("source"), "source", "left_anti")


def missing_fields(df: DataFrame, fields=("country", "type", "institution_name"), may_lack=None) -> DataFrame:
    """NULLs per field. ``may_lack`` names, per field, the sources that may have none."""
    may_lack = {"institution_name": ["gov"]} if may_lack is None else may_lack

    def missing(f):
        excused = F.coalesce(F.col("source").isin(*may_lack[f]), F.lit(False)) if f in may_lack else F.lit(False)
        return F.count(F.when(F.col(f).isNull() & ~excused, 1))

    one = df.agg(*[missing(f).alias(f) for f in fields])
    pairs = ", ".join(f"'{f}', `{f}`" for f in fields)
    return one.select(F.expr(f"stack({len(fields)}, {pairs}) AS (field, n_missing)"))


def out_of_domain(df: DataFrame, domains=None) -> DataFrame:
    """Values outside their domain, per field. NULLs are missing_fields' business."""
    domains = {"type": rules.TYPES, "country": rules.COUNTRY_ORDER} if domains is None else domains
    counts = df.groupBy(*domains).agg(F.count("*").alias("n"))
    rows = F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).alias("value"), "n") for f in domains])
    tests = [(F.col("field") == f) & ~F.col("value").isin(list(v)) for f, v in domains.items()]
    bad = tests[0]
    for t in tests[1:]:
        bad = bad | t
    return (
        counts.select(F.inline(rows)).filter(bad).groupBy("field", "value").agg(F.sum("n").alias("n"))
    )


def empty_countries(df: DataFrame, countries: DataFrame) -> DataFrame:
    """Countries of the domain without articles."""
    return countries.select("country").join(df.select("country").distinct(), "country", "left_anti")


def validate(df: DataFrame, by: str = "batch", columns=ARTICLE_COLS, min_rows: int = 5) -> DataFrame:
    """Warnings per batch: missing columns, blank texts, low volume. Never an error."""
    lacking = [c for c in columns if c not in df.columns]
    text = is_blank(F.col("text")) if "text" in df.columns else F.lit(True)
    return (
        df.groupBy(by)
        .agg(F.count("*").alias("n"), F.count(F.when(text, 1)).alias("n_blank"))
        .withColumns({
            "missing_columns": F.lit(", ".join(lacking)),
            "low_volume": F.col("n") < min_rows,
            "ok": (F.col("n_blank") == 0) & (F.col("n") >= min_rows) & F.lit(not lacking),
        })
    )


def validate_all(df: DataFrame, columns=ARTICLE_COLS, min_rows: int = 5) -> DataFrame:
    """One row per check for the whole frame, also where it has no rows."""
    lacking = [c for c in columns if c not in df.columns]
    text = is_blank(F.col("text")) if "text" in df.columns else F.lit(True)
    one = df.agg(F.count("*").alias("n"), F.count(F.when(text, 1)).alias("n_blank"))
    n, blank = F.col("n"), F.col("n_blank")
    found = [
        ("missing_columns", F.lit(len(lacking)).cast("long"), F.lit(bool(lacking))),
        ("blank_text", blank, blank > 0),
        ("no_rows", n, n == 0),
        ("few_rows", n, (n > 0) & (n < min_rows)),
    ]
    checks = F.array(*[
        F.struct(F.lit(name).alias("check_name"), value.alias("value"), warn.alias("warn"))
        for name, value, warn in found
    ])
    return one.select(F.inline(checks))


def non_empty(df: DataFrame) -> DataFrame:
    """One row: is there anything in the store? Reads one row at most."""
    return df.limit(1).agg((F.count("*") > 0).alias("non_empty"))


def source_status(extracted: DataFrame, dim: DataFrame) -> DataFrame:
    """One row per registered source: pages, usable articles, and a status.

    Extraction yields NULL rather than an error on a page it cannot read, so one
    broken source shows here and leaves the others' rows alone.
    """
    good = F.col("title").isNotNull() & ~is_blank(F.col("text"))
    counts = extracted.groupBy("source").agg(
        F.count("*").alias("n_pages"), F.count(F.when(good, 1)).alias("n_usable")
    )
    n, ok = F.coalesce("n_pages", F.lit(0)), F.coalesce("n_usable", F.lit(0))
    return dim.select("source").join(counts, "source", "left").select(
        "source",
        n.alias("n_pages"),
        ok.alias("n_usable"),
        F.when(n == 0, "empty").when(ok == 0, "failed").when(ok < n, "partial").otherwise("ok").alias("status"),
    )
