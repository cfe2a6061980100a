"""Publisher metadata, core-body rules, final columns and store records."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import rules
from ..schema import ARTICLE_COLS


def enrich(df: DataFrame, dim: DataFrame) -> DataFrame:
    """Add country, type and institution by source.

    A source without a dimension row keeps its rows with NULL metadata; the
    quality report orphan_sources names it.
    """
    added = ["country", "type", "institution_name"]
    return df.drop(*added).join(dim.select("source", *added), "source", "left")


def flag_core(df: DataFrame, bodies=None, col: str = "from") -> DataFrame:
    """core_education: one of the bodies is named in the publishing organisations."""
    bodies = rules.CORE_BODIES if bodies is None else bodies
    names = F.array(*[F.lit(b) for b in bodies])
    found = F.exists(names, lambda b: F.contains(F.coalesce(F.col(col), F.lit("")), b))
    return df.withColumn("core_education", found)


def primary_org_of(orgs: Column, bodies=None) -> Column:
    """First of the bodies, in their order of preference, that is named; else Other."""
    bodies = rules.CORE_BODIES if bodies is None else bodies
    return F.coalesce(*[F.when(F.contains(orgs, F.lit(b)), F.lit(b)) for b in bodies], F.lit("Other"))


def primary_org(df: DataFrame, bodies=None, col: str = "from") -> DataFrame:
    return df.withColumn("primary_org", primary_org_of(F.col(col), bodies))


def apply_source_rule(df: DataFrame, source: str = "gov", fallback: str = "Government") -> DataFrame:
    """For one source: keep core rows only, and name the primary organisation.

    A frame without core_education keeps all its rows, one without primary_org
    uses the fallback name; other sources pass through.
    """
    ours = F.col("source") == source
    if "core_education" in df.columns:
        df = df.filter(~ours | F.col("core_education"))
    org = F.col("primary_org") if "primary_org" in df.columns else F.lit(fallback)
    return df.withColumn("institution_name", F.when(ours, org).otherwise(F.col("institution_name")))


def conform(df: DataFrame, cols=ARTICLE_COLS) -> DataFrame:
    """The final columns that exist, in their order."""
    return df.select(*[c for c in cols if c in df.columns])


def to_records(df: DataFrame, dataset_type, country, week=None, extra=()) -> DataFrame:
    """Article rows to store records.

    ``dataset_type``, ``country`` and ``week`` are literals or Columns; country
    replaces what the rows say. Language defaults to "en" only where the frame
    has no such column: a NULL language stays NULL. ``extra`` columns ride along.
    """

    def lit(v, kind):
        return (v if isinstance(v, Column) else F.lit(v)).cast(kind)

    text_date = dict(df.dtypes)["date"] == "string"
    date = F.try_to_date(F.nullif(F.col("date"), F.lit(""))) if text_date else F.col("date")
    shaped = df.select(
        "url",
        "title",
        date.alias("article_date"),
        "text",
        "source",
        lit(country, "string").alias("country"),
        "type",
        "institution_name",
        (F.col("language") if "language" in df.columns else F.lit("en")).alias("language"),
        lit(dataset_type, "string").alias("dataset_type"),
        lit(week, "int").alias("week_number"),
        *extra,
    )
    return shaped.filter(F.col("url").isNotNull() & (F.col("url") != ""))
