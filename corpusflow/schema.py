"""Fixed schemas. Nothing in the library infers a schema from data."""

from pyspark.sql import types as T

_str = T.StringType()

ARTICLE_COLS = [
    "url", "title", "date", "text", "source",
    "country", "type", "institution_name", "language",
]

ARTICLE = T.StructType(
    [T.StructField(c, T.DateType() if c == "date" else _str) for c in ARTICLE_COLS]
)

# One row of the keyed store.
RECORD = T.StructType([
    T.StructField("url", _str),
    T.StructField("title", _str),
    T.StructField("article_date", T.DateType()),
    T.StructField("text", _str),
    T.StructField("source", _str),
    T.StructField("country", _str),
    T.StructField("type", _str),
    T.StructField("institution_name", _str),
    T.StructField("language", _str),
    T.StructField("dataset_type", _str),
    T.StructField("week_number", T.IntegerType()),
])

PAGE = T.StructType([
    T.StructField("page_id", T.LongType()),
    T.StructField("url", _str),
    T.StructField("html", _str),
])

# A listing row: where a link stood (page, position in the page) and what the
# listing said about it.
LISTING = T.StructType([
    T.StructField("source", _str),
    T.StructField("section", _str),
    T.StructField("page", T.IntegerType()),
    T.StructField("pos", T.IntegerType()),
    T.StructField("url", _str),
    T.StructField("title", _str),
    T.StructField("date", T.DateType()),
])

_rendered = T.StructType([T.StructField("rendered", _str)])

# The part of a WordPress post object that the corpus uses.
POST = T.StructType([
    T.StructField("date", _str),
    T.StructField("link", _str),
    T.StructField("title", _rendered),
    T.StructField("content", _rendered),
])

RUN_LOG = T.StructType([
    T.StructField("run_time", T.TimestampType()),
    T.StructField("country", _str),
    T.StructField("since", T.DateType()),
    T.StructField("until", T.DateType()),
    T.StructField("batch", _str),
    T.StructField("source", _str),
    T.StructField("n", T.LongType()),
])
