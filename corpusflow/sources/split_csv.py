"""Article CSV whose large files are read by many tasks, quoted multi-line text included.

Spark's reader gives a file with multi-line text to one task. Here files are read as
lines in byte ranges. Inside quotes an odd number of quotes precedes, so the quotes of
the ranges before, summed up per file, tell of each line whether it starts a record.
Lines become records within their range; the lines at the head of a range that belong to
a record of an earlier one, one piece a range, are joined to it.
"""

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import ARTICLE
from ..session import sized
from .files import CSV_OPTIONS

_RANGE = ("file", "range")


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines with their file, byte range, order within the range, and number of quotes."""
    text = spark.read.option("lineSep", "\n").text(path)
    meta = F.col("_metadata")
    return text.select(
        "value",
        meta["file_path"].alias("file"), meta["file_name"].alias("file_name"), meta["file_block_start"].alias("range"),
        F.monotonically_increasing_id().alias("at"),
        (F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))).alias("quotes"),
    )


def _joined(pieces, order: str) -> F.Column:
    """Texts of a group, in order, one under the other."""
    rows = F.array_sort(F.collect_list(F.struct(order, pieces)))
    return F.array_join(F.transform(rows, lambda r: r[pieces]), "\n")


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    """Records as far as they lie in one range; number 0 is what an earlier range began."""
    ranges = _lines(spark, path).groupBy(*_RANGE).agg(F.sum("quotes").alias("q"))
    # a row per range: its task reads the ranges of a file, not the lines
    before = F.sum("q").over(Window.partitionBy("file").orderBy("range").rowsBetween(Window.unboundedPreceding, -1))
    inside = sized(ranges.select(*_RANGE, F.coalesce(before, F.lit(0)).alias("before")), "csv-ranges")
    row = Window.partitionBy(*_RANGE).orderBy("at")
    ahead = F.col("before") + F.sum("quotes").over(row) - F.col("quotes")
    numbered = (
        _lines(spark, path).join(inside, list(_RANGE))
        .withColumn("starts", (ahead % 2 == 0).cast("int"))
        .withColumn("number", F.sum("starts").over(row))
    )
    return numbered.groupBy(*_RANGE, "number").agg(F.first("file_name").alias("file_name"), _joined("value", "at").alias("text"))


def read_articles_csv_split(spark: SparkSession, path: str, schema: T.StructType = ARTICLE) -> DataFrame:
    """The rows of read_articles_csv, with file_name, from files of any size.

    For files as write_articles_csv and other strict writers leave them: one header line
    a file, fields that hold quotes, commas or line breaks are quoted, quotes are doubled,
    text is UTF-8. A quote inside an unquoted field, which a lenient reader takes as it
    is, is not allowed. Lines without a character are passed over; files without rows
    give none. A task sorts the lines of one byte range (spark.sql.files.maxPartitionBytes),
    so only a single record is ever held whole. Runs jobs.
    """
    pieces = sized(_pieces(spark, path), "csv-records")
    # the last record begun up to a range, from one row per range
    last = pieces.groupBy(*_RANGE).agg(F.max("number").alias("last"))
    began = F.when(F.col("last") > 0, F.struct("range", "last"))
    earlier = Window.partitionBy("file").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    owners = last.select(*_RANGE, F.last(began, ignorenulls=True).over(earlier).alias("owner"))
    heads = pieces.filter("number = 0").join(owners, list(_RANGE))
    rest = (
        heads.select("file", "range", "text", F.col("owner.range").alias("owner_range"), F.col("owner.last").alias("owner_number"))
        .groupBy("file", F.col("owner_range"), F.col("owner_number")).agg(_joined("text", "range").alias("rest"))
        .select("file", F.col("owner_range").alias("range"), F.col("owner_number").alias("number"), "rest")
    )
    records = pieces.filter("number > 0 AND NOT (range = 0 AND number = 1)").join(rest, [*_RANGE, "number"], "left")
    text = F.regexp_replace(F.concat_ws("\n", "text", "rest"), "\r$", "")
    read = records.select("file_name", text.alias("record")).filter("record <> ''")
    options = {k: v for k, v in CSV_OPTIONS.items() if k != "header"}
    return read.select(F.from_csv("record", schema.toDDL(), options).alias("r"), "file_name").select("r.*", "file_name")
