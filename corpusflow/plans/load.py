"""The job from article files to the keyed store."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.dedup import dedup_last, upsert
from ..operators.enrich import to_records
from ..sources import store
from ..sources.files import tag_files, write_precedence

# Columns that order the writes to one url; the last one settles rows of one file.
PRECEDENCE = ("country_order", "is_file", "file_order", "row_order")


def _column(v) -> Column:
    return v if isinstance(v, Column) else F.lit(v)


def _row_order(given: Column | None) -> Column:
    """Place of a row in its file where it is known, else an order by content."""
    by_content = F.xxhash64("title", F.col("date").cast("string"), "text")
    return (by_content if given is None else given.cast("long")).alias("row_order")


def training_records(df: DataFrame, country, row_order: Column | None = None) -> DataFrame:
    """Training articles as records, with their place in the write order."""
    place = write_precedence(_column(country), F.lit("training"), F.lit(None).cast("string"))
    return to_records(df, "training", country, extra=[*place, _row_order(row_order)])


def inference_records(
    df: DataFrame, country, week: int | None = None, row_order: Column | None = None
) -> DataFrame:
    """Inference articles (with file_name) as records, weeks read from the file names."""
    place = write_precedence(_column(country), F.lit("inference"), F.col("file_name"))
    return to_records(tag_files(df, week), "inference", country, F.col("week_number"), extra=[*place, _row_order(row_order)])


def load(target: DataFrame, records: DataFrame) -> DataFrame:
    """Store after a load: the last write per url wins. Runs a job for the updates' keys."""
    return upsert(target, records, "url", PRECEDENCE, write_keys=True)


def initial(records: DataFrame) -> DataFrame:
    return dedup_last(records, "url", PRECEDENCE).drop(*PRECEDENCE)


def make_store(records: DataFrame, root: str, buckets: int = store.BUCKETS) -> int:
    """``initial`` as a bucketed store below ``root``."""
    return store.create(records, root, "url", PRECEDENCE, buckets)


def load_store(records: DataFrame, root: str) -> int:
    """``load`` into it: only the buckets of the records' urls are rewritten. Returns the version."""
    return store.apply(records, root, "url", PRECEDENCE)
