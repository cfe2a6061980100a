"""Corpus reports.

Every report aggregates the articles once, map side first, down to a few rows per
source, country, type, day or week; windows, pivots and joins run on those rows.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import rules
from ..functions.text import trim_ws
from .routing import windows_of


def by_source(df: DataFrame, total: bool = False) -> DataFrame:
    """Rows per source; with ``total``, one more row with a NULL source."""
    counts = df.groupBy("source").agg(F.count("*").alias("n"))
    return counts.rollup("source").agg(F.sum("n").alias("n")) if total else counts


def total(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("n"))


def language_counts(df: DataFrame, default: str = "en") -> DataFrame:
    return (
        df.filter(F.col("language") != default).groupBy("language").agg(F.count("*").alias("n"))
    )


def shares(df: DataFrame, by=("country",), category: str = "type") -> DataFrame:
    """Count and share of each category within its group."""
    counts = df.groupBy(*by, category).agg(F.count("*").alias("n"))
    whole = F.sum("n").over(Window.partitionBy(*by))
    return counts.withColumn("share", F.col("n") / whole)


def pivot_shares(df: DataFrame, domain: DataFrame, countries=None) -> DataFrame:
    """Category by country: n_<country> and share_<country>, zero filled, with a total row.

    ``domain`` has one row per category, so categories without articles show too.
    """
    countries = rules.COUNTRY_ORDER if countries is None else countries
    wide = (
        shares(df)
        .groupBy("type")
        .pivot("country", countries)
        .agg(F.sum("n").alias("n"), F.sum("share").alias("share"))
    )
    named = wide.select(
        "type",
        *[F.col(f"{c}_{m}").alias(f"{m}_{c}") for c in countries for m in ("n", "share")],
    )
    full = domain.select("type").join(named, "type", "left").na.fill(0)
    values = [c for c in full.columns if c != "type"]
    summed = full.rollup("type").agg(*[F.sum(c).alias(c) for c in values])
    return summed.withColumn("type", F.coalesce("type", F.lit("total")))


def slot_map(df: DataFrame, domain: DataFrame, countries=None) -> DataFrame:
    """Organisations that publish in each (category, country), joined by "; "; NULL where none."""
    countries = rules.COUNTRY_ORDER if countries is None else countries
    orgs = df.select("type", "country", "institution_name").distinct()
    wide = (
        orgs.groupBy("type").pivot("country", countries)
        .agg(F.array_join(F.sort_array(F.collect_set("institution_name")), "; "))
    )
    cells = [F.nullif(F.col(c), F.lit("")).alias(c) for c in countries]
    return domain.select("type").join(wide, "type", "left").select("type", *cells)


def slot_domain(spark, countries=None, types=None) -> DataFrame:
    """All (country, type) pairs, written out from the two short domain lists."""
    countries = rules.COUNTRY_ORDER if countries is None else countries
    types = rules.TYPES if types is None else types
    pairs = [(c, t) for c in countries for t in types]
    return rules.rows_frame(spark, pairs, country="STRING", type="STRING")


def missing_slots(df: DataFrame, domain: DataFrame) -> DataFrame:
    """Pairs of the domain without an article."""
    return domain.join(df.select("country", "type").distinct(), ["country", "type"], "left_anti")


def per_capita(df: DataFrame, countries: DataFrame, digits: int = 0) -> DataFrame:
    """Articles per million people."""
    counts = df.groupBy("country").agg(F.count("*").alias("n"))
    return counts.join(countries.select("country", "millions"), "country").select(
        "country", "n", "millions", F.round(F.col("n") / F.col("millions"), digits).alias("per_million")
    )


def _per_day(df: DataFrame) -> DataFrame:
    return df.groupBy("country", "date").agg(F.count("*").alias("n"))


# Ends of windows that are open.
_FIRST, _LAST = "0001-01-01", "9999-12-31"


def _closed(calendar: DataFrame, countries: DataFrame | None) -> DataFrame:
    """Windows with both ends: a missing start is the country's or the first day, a missing end the last.

    A window that ends before it starts is empty.
    """
    since = F.coalesce("run_since", F.lit(_FIRST).cast("date"))
    until = F.greatest(F.coalesce("run_until", F.lit(_LAST).cast("date")), F.date_sub("run_since", 1))
    return windows_of(calendar, countries).withColumn("run_since", since).withColumn("run_until", until)


def _swept(value: str) -> Column:
    """Running total over a country's days; ``place`` orders the events of one day.

    The line is swept over counts per day and the windows' ends, so its length is that
    of the calendar however many articles there are, and windows are never spread over days.
    """
    line = Window.partitionBy("country").orderBy("date", "place")
    return F.sum(value).over(line.rowsBetween(Window.unboundedPreceding, Window.currentRow))


def weekly_counts(df: DataFrame, calendar: DataFrame, countries: DataFrame | None = None) -> DataFrame:
    """Articles per run window; windows without any count 0, open ones reach on.

    A window's count is the total of its country up to its end less that before its start.
    """
    ends = F.array(
        F.struct(F.col("run_since").alias("date"), F.lit(0).alias("place"), F.lit(-1).alias("sign")),
        F.struct(F.col("run_until").alias("date"), F.lit(2).alias("place"), F.lit(1).alias("sign")),
    )
    marks = _closed(calendar.filter(F.col("week").isNotNull()), countries).select("country", "week", F.inline(ends))
    days = _per_day(df.filter(F.col("date").isNotNull())).withColumns({"place": F.lit(1), "sign": F.lit(0)})
    events = marks.unionByName(days, allowMissingColumns=True).withColumn("n", F.coalesce("n", F.lit(0)))
    return (
        events.withColumn("total", _swept("n")).filter("sign <> 0")
        .groupBy("country", "week").agg(F.sum(F.col("sign") * F.col("total")).alias("n"))
    )


def weekly(df: DataFrame, calendar: DataFrame, countries: DataFrame | None = None) -> DataFrame:
    """Smallest, largest and summed weekly count per country."""
    return weekly_counts(df, calendar, countries).groupBy("country").agg(
        F.count("*").alias("weeks"),
        F.min("n").alias("min_n"),
        F.max("n").alias("max_n"),
        F.sum("n").alias("sum_n"),
    )


def retention(raw: DataFrame, cleaned: DataFrame) -> DataFrame:
    """Rows per source before and after cleaning, and the share that stayed."""
    both = raw.select("source", F.lit(1).alias("r"), F.lit(0).alias("c")).unionByName(
        cleaned.select("source", F.lit(0).alias("r"), F.lit(1).alias("c"))
    )
    return (
        both.groupBy("source")
        .agg(F.sum("r").alias("n_raw"), F.sum("c").alias("n_clean"))
        .withColumn("ratio", F.try_divide(F.col("n_clean"), F.col("n_raw")))
    )


def batch_overlap(df: DataFrame) -> DataFrame:
    """URLs that occur in more than one batch."""
    return (
        df.groupBy("url").agg(F.countDistinct("batch").alias("n_batches")).filter("n_batches > 1")
    )


def coverage(df: DataFrame, calendar: DataFrame, countries: DataFrame | None = None) -> DataFrame:
    """Articles on days that lie in no run window, or in more than one; open windows reach on.

    Per country and day: articles are counted per day first, and the number of windows
    is the running total of those that have started less those that have ended.
    """
    ends = F.array(
        F.struct(F.col("run_since").alias("date"), F.lit(1).alias("change")),
        F.struct(F.date_add("run_until", 1).alias("date"), F.lit(-1).alias("change")),
    )
    changes = _closed(calendar, countries).select("country", F.inline(ends)).withColumn("place", F.lit(0))
    days = _per_day(df.filter(F.col("date").isNotNull())).withColumns({"place": F.lit(1), "change": F.lit(0)})
    events = days.unionByName(changes, allowMissingColumns=True)
    return (
        events.withColumn("n_windows", _swept("change")).filter("place = 1 AND n_windows <> 1")
        .select("country", "date", "n", "n_windows")
    )


def repeated_blocks(df: DataFrame, min_docs: int = 3, sep: str = "\n") -> DataFrame:
    """Paragraphs that many articles of a source share; the frame has a row per article.

    A paragraph is taken once per article before the explode, so a plain count
    is the number of articles and combines on the map side.
    """
    found = F.array_distinct(F.transform(F.split("text", sep), trim_ws))
    return (
        df.select("source", F.explode(found).alias("block"))
        .filter(F.col("block") != "")
        .groupBy("source", "block")
        .agg(F.count("*").alias("n_docs"))
        .filter(F.col("n_docs") >= min_docs)
    )


def profile(df: DataFrame, short_chars: int = 150) -> DataFrame:
    """Text lengths per source, short texts, and the day with most articles and its share.

    The median is exact: it is taken over (length, count) pairs.
    """
    lengths = (
        df.select("source", F.coalesce(F.length("text"), F.lit(0)).alias("len"))
        .groupBy("source", "len")
        .agg(F.count("*").alias("n"))
        .groupBy("source")
        .agg(
            F.sum("n").alias("n"),
            F.min("len").alias("min_len"),
            F.expr("percentile(len, 0.5, n)").alias("median_len"),
            F.max("len").alias("max_len"),
            F.sum(F.when(F.col("len") < short_chars, F.col("n")).otherwise(0)).alias("n_short"),
        )
    )
    top = (
        df.filter(F.col("date").isNotNull())
        .groupBy("source", "date")
        .agg(F.count("*").alias("n_day"))
        # most articles first, earliest day on a tie
        .groupBy("source")
        .agg(
            F.max_by("date", F.struct("n_day", -F.unix_date("date"))).alias("top_date"),
            F.max("n_day").alias("n_top"),
        )
    )
    return lengths.join(top, "source", "left").withColumn(
        "top_share", F.coalesce(F.col("n_top") / F.col("n"), F.lit(0.0))
    )


# ---- run log ---------------------------------------------------------------

# Source columns of the older, wide log layout (England only).
WIDE_LOG_SOURCES = ["schoolsweek", "gov", "epi", "nuffield", "fft", "fed"]


def parse_log(lines: DataFrame, wide_sources=None, wide_country: str = "eng") -> DataFrame:
    """Run-log table lines (column value) to one row per run and source.

    Two layouts: one column per source, or a "source=n, ..." list with a country.
    """
    wide_sources = WIDE_LOG_SOURCES if wide_sources is None else wide_sources
    cells = F.transform(F.split(F.btrim("value"), "\\|"), lambda c: F.btrim(c))
    rows = lines.filter(F.rlike("value", F.lit("^\\| *[0-9]{4}-[0-9]{2}-[0-9]{2} "))).select(
        F.slice(cells, F.lit(2), F.size(cells) - 2).alias("c")
    )
    is_list = F.col("c")[1].rlike("^[a-z]+$")
    wide = F.create_map(
        *[x for i, s in enumerate(wide_sources) for x in (F.lit(s), F.get("c", F.lit(i + 3)))]
    )
    listed = F.str_to_map(F.get("c", F.lit(4)), F.lit(", "), F.lit("="))

    def pick(a, b):
        return F.when(is_list, a).otherwise(b)

    span = pick(F.get("c", F.lit(2)), F.get("c", F.lit(1)))
    last = F.element_at("c", -1)
    return (
        rows.select(
            F.try_to_timestamp(F.col("c")[0], F.lit("yyyy-MM-dd HH:mm")).alias("run_time"),
            pick(F.col("c")[1], F.lit(wide_country)).alias("country"),
            F.try_to_date(F.btrim(F.split(span, "→")[0]), "yyyy-MM-dd").alias("since"),
            F.try_to_date(F.btrim(F.get(F.split(span, "→"), F.lit(1))), "yyyy-MM-dd").alias("until"),
            pick(F.get("c", F.lit(3)), F.get("c", F.lit(2))).alias("file"),
            F.replace(last, F.lit("*"), F.lit("")).try_cast("long").alias("total"),
            F.explode(pick(listed, wide)).alias("source", "n"),
        )
        .withColumn("n", F.col("n").try_cast("long"))
    )


def latest_runs(log: DataFrame) -> DataFrame:
    """Rows of each batch's latest run."""
    newest = log.groupBy("country", "file").agg(F.max("run_time").alias("run_time"))
    return log.join(newest, ["country", "file", "run_time"], "left_semi")


# ---- divergence of category distributions ----------------------------------

def distribution(df: DataFrame, unit: str, category: str) -> DataFrame:
    """unit, category, n and p: each unit's distribution over categories."""
    return shares(
        df.select(F.col(unit).alias("unit"), F.col(category).alias("category")), ("unit",), "category"
    ).withColumnRenamed("share", "p")


def concentration(df: DataFrame, unit: str, category: str) -> DataFrame:
    """Sum of squared shares and number of categories present, per unit."""
    return distribution(df, unit, category).groupBy("unit").agg(
        F.sum(F.col("p") * F.col("p")).alias("hhi"), F.count("*").alias("n_categories")
    )


def js_divergence(df: DataFrame, unit: str, category: str) -> DataFrame:
    """Jensen-Shannon divergence (base 2) of each unit from all rows together.

    Category counts are small tables; a category a unit lacks adds half of its
    reference share, which is what is left of 1 after the shares it has.
    """
    counts = df.groupBy(F.col(unit).alias("unit"), F.col(category).alias("category")).agg(
        F.count("*").alias("n")
    )
    per_cat = F.sum("n").over(Window.partitionBy("category"))
    per_unit = F.sum("n").over(Window.partitionBy("unit"))
    whole = counts.agg(F.sum("n")).scalar()
    p, q = F.col("p"), F.col("q")
    m = (p + q) / 2
    return (
        counts.withColumns({"cat_n": per_cat, "unit_n": per_unit})
        .select("unit", (F.col("n") / F.col("unit_n")).alias("p"), (F.col("cat_n") / whole).alias("q"))
        .groupBy("unit")
        .agg(
            (
                0.5 * F.sum(p * F.log2(p / m))
                + 0.5 * F.sum(q * F.log2(q / m))
                + 0.5 * (1 - F.sum("q"))
            ).alias("jsd")
        )
    )


def kl_asymmetry(df: DataFrame, unit: str, category: str, a, b, domain: DataFrame, alpha: float = 1.0) -> DataFrame:
    """KL divergence (nats) between two units in both directions.

    ``domain`` has one row per category, in a column of that name. Shares are
    smoothed by adding alpha to each category's count. With smoothed counts x, y
    and totals X, Y the divergence is sum(x ln(x/y)) / X - ln(X/Y), so one
    aggregate over the category counts is enough.
    """
    u = F.col(unit)
    counts = df.filter(u.isin(a, b)).groupBy(category).agg(
        F.count(F.when(u == a, 1)).alias("a"), F.count(F.when(u == b, 1)).alias("b")
    )
    x, y = F.coalesce("a", F.lit(0)) + alpha, F.coalesce("b", F.lit(0)) + alpha
    sums = (
        domain.join(counts, category, "left")
        .select(x.alias("x"), y.alias("y"))
        .agg(
            F.sum("x").alias("x"), F.sum("y").alias("y"),
            F.sum(F.col("x") * F.log(F.col("x") / F.col("y"))).alias("xy"),
            F.sum(F.col("y") * F.log(F.col("y") / F.col("x"))).alias("yx"),
        )
    )
    ratio = F.log(F.col("x") / F.col("y"))
    return sums.select(
        F.lit(a).alias("unit_a"), F.lit(b).alias("unit_b"),
        (F.col("xy") / F.col("x") - ratio).alias("kl_ab"), (F.col("yx") / F.col("y") + ratio).alias("kl_ba"),
    ).withColumn("asymmetry", F.col("kl_ab") - F.col("kl_ba"))
