"""Run windows: which run an article belongs to and where that run's output goes."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import rules


def default_since(articles: DataFrame, countries: DataFrame, since=None) -> DataFrame:
    """Keep articles on or after the run's since date, or their country's start date.

    An unknown date passes, as in date_range, and so does a country without a start.
    """
    starts = countries.select("country", "start")
    first = F.col("start") if since is None else F.lit(since).cast("date")
    inside = F.col("date").isNull() | first.isNull() | (F.col("date") >= first)
    return articles.join(starts, "country", "left").filter(inside).drop("start")


def run_id(country: Column, week: Column, until: Column) -> Column:
    """Name of a run: its country and batch."""
    return F.concat(country, F.lit("/"), batch_name(week, until))


def windows_of(calendar: DataFrame, countries: DataFrame | None) -> DataFrame:
    """Windows under the names run_since and run_until; a missing start is the country's."""
    if countries is not None:
        calendar = calendar.join(countries.select("country", "start"), "country", "left").withColumn(
            "since", F.coalesce("since", "start")
        ).drop("start")
    return calendar.withColumnsRenamed({"since": "run_since", "until": "run_until"})


def in_window(articles: DataFrame, calendar: DataFrame, how: str = "inner", countries=None) -> DataFrame:
    """Articles with the run windows (both ends included) that cover their date.

    Windows are irregular and may overlap, leave gaps or be open at either end; an
    open window reaches on. Each window is one row of the join side, so Catalyst
    knows its true size: a small calendar is broadcast, a large one is shuffled by
    country with the range tested in the join.
    """
    windows = windows_of(calendar, countries).withColumnRenamed("country", "_country")
    covers = (
        (F.col("country") == F.col("_country"))
        & (F.col("run_since").isNull() | (F.col("date") >= F.col("run_since")))
        & (F.col("run_until").isNull() | (F.col("date") <= F.col("run_until")))
        & F.col("date").isNotNull()
    )
    return articles.join(windows, covers, how).drop("_country")


def is_training(country: Column, until: Column, cutoff=None, countries=None) -> Column:
    """A run is training where its country has training data and it ends by the cutoff.

    A run without an end counts as training.
    """
    cutoff = rules.TRAINING_CUTOFF if cutoff is None else cutoff
    countries = rules.TRAINING_COUNTRIES if countries is None else countries
    return country.isin(*countries) & F.coalesce(until <= F.lit(cutoff).cast("date"), F.lit(True))


def route_runs(calendar: DataFrame, cutoff=None, countries=None) -> DataFrame:
    """Run windows with dataset_type and append (does the write add to what is there)."""
    training = is_training(F.col("country"), F.col("until"), cutoff, countries)
    return calendar.withColumns({
        "dataset_type": F.when(training, "training").otherwise("inference"),
        "append": training & F.col("since").isNotNull(),
    })


def _runs(calendar: DataFrame, cutoff=None, training_countries=None) -> DataFrame:
    runs = route_runs(calendar, cutoff, training_countries)
    return runs.withColumn("batch", batch_name(F.col("week"), F.col("until")))


def route(
    articles: DataFrame, calendar: DataFrame, cutoff=None, training_countries=None, countries=None
) -> DataFrame:
    """Articles with their run's window, dataset_type, append flag and batch name.

    Every article takes the decision of its run, never one of its own date. Rows that
    name their run in run_id (see run_id) belong to it whatever their date, unknown
    dates included; the others to every run whose window covers their date. Rows
    without any run are left to ``unrouted``.
    """
    runs = _runs(calendar, cutoff, training_countries)
    if "run_id" not in articles.columns:
        return in_window(articles, runs, countries=countries)
    dated = in_window(articles.filter("run_id is null"), runs, countries=countries)
    windows = windows_of(runs, countries)
    named = windows.withColumn("run_id", run_id(F.col("country"), F.col("week"), F.col("run_until"))).drop("country")
    return articles.join(named, "run_id").unionByName(dated)


def unrouted(articles: DataFrame, calendar: DataFrame, countries=None) -> DataFrame:
    """Articles that no run takes, with a reason: unknown run, no date, or no window."""
    windows = windows_of(calendar, countries)
    with_id = "run_id" in articles.columns
    by_date = articles.filter("run_id is null") if with_id else articles
    late = windows.withColumnRenamed("country", "_country")
    covers = (
        (F.col("country") == F.col("_country"))
        & (F.col("run_since").isNull() | (F.col("date") >= F.col("run_since")))
        & (F.col("run_until").isNull() | (F.col("date") <= F.col("run_until")))
        & F.col("date").isNotNull()
    )
    reason = F.when(F.col("date").isNull(), "no date").otherwise("no window")
    out = by_date.join(late, covers, "left_anti").withColumn("reason", reason)
    if with_id:
        known = windows.select(run_id(F.col("country"), F.col("week"), F.col("run_until")).alias("run_id")).distinct()
        lost = articles.join(known, "run_id", "left_anti").filter("run_id is not null")
        out = out.unionByName(lost.withColumn("reason", F.lit("unknown run")))
    return out


def batch_name(week: Column, until: Column) -> Column:
    """weekNN_DATE, DATE without a week, "present" without an end."""
    end = F.coalesce(F.date_format(until, "yyyy-MM-dd"), F.lit("present"))
    return F.when(week.isNull(), end).otherwise(
        F.concat(F.lit("week"), F.format_string("%02d", week), F.lit("_"), end)
    )
