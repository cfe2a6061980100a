"""Sorts and limits."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def newest_first(df: DataFrame, date: str = "date", tie: str = "url") -> DataFrame:
    return df.orderBy(F.col(date).desc_nulls_last(), F.col(tie))


def newest_per_source(df: DataFrame, k: int, date: str = "date", tie: str = "url", by=("source",)) -> DataFrame:
    """The k newest rows of each source; a rank limit runs before the exchange."""
    w = Window.partitionBy(*by).orderBy(F.col(date).desc_nulls_last(), F.col(tie))
    return df.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
