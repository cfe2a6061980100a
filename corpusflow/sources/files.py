"""Article files, captured pages and post feeds as DataFrames."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import rules
from ..functions.dates import iso_date
from ..functions.text import computed, plain
from ..operators.extraction import with_text
from ..schema import ARTICLE, PAGE, POST

# Article files hold multi-line quoted text with doubled quotes. White space and
# empty strings are kept as they are.
CSV_OPTIONS = {
    "header": "true",
    "multiLine": "true",
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


def read_articles_csv(spark: SparkSession, path: str, schema=ARTICLE) -> DataFrame:
    """Article CSV files with their file_name.

    A file with multi-line text is one task here: keep the files small
    (write_articles_csv bounds their rows), or use read_articles_csv_split.
    """
    return (
        spark.read.schema(schema).options(**CSV_OPTIONS).csv(path)
        .withColumn("file_name", F.col("_metadata.file_name"))
    )


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Captured pages."""
    return spark.read.schema(PAGE).parquet(path)


# File names of weekly and retrospective batches.
_WEEK_FILE = "^week([0-9]+)_([0-9]{4}-[0-9]{2}-[0-9]{2})\\.csv$"
_RETRO_FILE = "^([0-9]{4}-[0-9]{2}-[0-9]{2})\\.csv$"


def tag_files(df: DataFrame, week: int | None = None, name: str = "file_name") -> DataFrame:
    """Add week_number and batch_date from the file name; other files are ignored.

    With ``week``, only that week's files stay and retrospective files go.
    """
    f = F.col(name)
    number = F.regexp_extract(f, _WEEK_FILE, 1).try_cast("int")
    day = F.coalesce(
        F.nullif(F.regexp_extract(f, _WEEK_FILE, 2), F.lit("")),
        F.nullif(F.regexp_extract(f, _RETRO_FILE, 1), F.lit("")),
    )
    tagged = df.filter(F.rlike(f, F.lit(f"{_WEEK_FILE}|{_RETRO_FILE}"))).withColumns(
        {"week_number": number, "batch_date": F.try_to_date(day, "yyyy-MM-dd")}
    )
    return tagged if week is None else tagged.filter(F.col("week_number") == week)


def write_precedence(country: Column, dataset_type: Column, file_name: Column) -> list[Column]:
    """Order in which the store is written: country, training before files, file name.

    File names compare as text, so week100 precedes week11.
    """
    order = F.array_position(F.array(*[F.lit(c) for c in rules.COUNTRY_ORDER]), country)
    return [
        order.cast("int").alias("country_order"),
        (dataset_type != "training").cast("int").alias("is_file"),
        F.coalesce(file_name, F.lit("")).alias("file_order"),
    ]


def parse_posts(df: DataFrame, body: str = "body") -> DataFrame:
    """Post JSON to url, title, date and the content's html; other columns stay."""
    rest = [c for c in df.columns if c != body]
    return computed(df, _p=F.from_json(F.col(body), POST)).select(
        *rest,
        F.col("_p.link").alias("url"),
        plain(F.col("_p.title.rendered")).alias("title"),
        iso_date(F.col("_p.date")).alias("date"),
        F.col("_p.content.rendered").alias("html"),
    )


def flatten_posts(df: DataFrame, body: str = "body", extract_rules=None) -> DataFrame:
    """Post JSON to url, title, date, text by the source's extraction rule."""
    return with_text(parse_posts(df, body), extract_rules)
