"""The job from captured pages and listings to training and inference tables."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import rules
from ..functions.text import first_present
from ..operators.clean import clean
from ..operators.dedup import dedup_first_wide, dedup_scope, union_sources
from ..operators.enrich import apply_source_rule, conform, enrich, flag_core, primary_org
from ..operators.extraction import extract, join_pages, usable, with_text
from ..functions.links import URL_RULES
from ..operators.filters import date_range, null_dates_by_source, skip_titles_by_source, url_shapes
from ..operators.routing import route
from ..schema import ARTICLE_COLS
from ..session import sized
from ..sources.files import parse_posts


def one_capture(pages: DataFrame, order=None) -> DataFrame:
    """One capture per url: the first in ``order``, whole rows that tie for it once.

    By default captured_at and page_id, as far as the pages have them, then the html's
    digest. Urls and order columns alone are grouped, so no html moves for a page that
    was captured once; the digest is read only where nothing else orders captures.
    Runs a job.
    """
    given = [c for c in ("captured_at", "page_id") if c in pages.columns] if order is None else list(order)
    if given:
        return dedup_first_wide(pages, "url", given)
    return dedup_first_wide(pages.withColumn("_digest", F.xxhash64("html")), "url", ["_digest"]).drop("_digest")


def articles_from_listing(
    listing: DataFrame, pages: DataFrame, since=None, until=None, order=None
) -> DataFrame:
    """Listing items (already cut off) with their page's title, date and text.

    Addresses that are no articles, and dates known from the listing, are tested
    before any html is read. A page captured several times counts once (one_capture).
    Other columns of the listing, its run_id say, stay. Runs a job.
    """
    wanted = date_range(url_shapes(dedup_scope(listing), URL_RULES), since, until)
    found = usable(extract(join_pages(wanted, one_capture(pages, order))))
    return null_dates_by_source(date_range(found, since, until))


def articles_from_posts(posts: DataFrame, pages: DataFrame | None = None, since=None, until=None) -> DataFrame:
    """Feed posts as articles; sources whose feed holds excerpts read the page first."""
    parsed = date_range(parse_posts(posts), since, until).withColumn("html", F.coalesce("html", F.lit("")))
    articles = with_text(parsed, rules.FEED_EXTRACT)
    if pages is not None:
        wanted = parsed.filter(F.col("source").isin(rules.PAGE_FIRST)).select("source", "url").distinct()
        paged = with_text(wanted.join(one_capture(pages).select("url", "html"), "url"), to="page_text")
        articles = articles.join(paged, ["source", "url"], "left").withColumn(
            "text", F.coalesce(first_present(F.col("page_text"), F.col("text")), F.lit(""))
        ).drop("page_text")
    return usable(articles)


def build(
    frames: list[DataFrame], dim: DataFrame, calendar: DataFrame, countries: DataFrame
) -> DataFrame:
    """Article frames of any sources to one routed frame, before cleaning."""
    return route(selected(frames, dim), calendar, countries=countries)


def selected(frames: list[DataFrame], dim: DataFrame) -> DataFrame:
    """Enriched articles of all frames that their source's rules let in.

    Pages that name their publishers are flagged and kept by the core bodies among
    them; administrative titles go.
    """
    articles = skip_titles_by_source(enrich(union_sources(*frames), dim))
    if "from" in articles.columns:
        articles = primary_org(flag_core(articles))
    return apply_source_rule(articles) if "core_education" in articles.columns else articles


def split(routed: DataFrame, dim: DataFrame, once: bool = True) -> tuple[DataFrame, DataFrame]:
    """Training rows as they are, inference rows cleaned per batch.

    Runs a job: the keys that repeat are found before any text is moved. Three readings
    are made of the routed rows, so they are written ``once`` (see clean).
    """
    routed = sized(routed, "routed") if once else routed
    training = routed.filter(F.col("dataset_type") == "training")
    ranked = routed.filter(F.col("dataset_type") == "inference").join(
        dim.select("source", "ordinal"), "source", "left"
    )
    # captures of one page on one day differ by their text at least
    ranked = ranked.withColumn("_capture", F.xxhash64("text"))
    cleaned = clean(ranked, order=("ordinal", "date", "title", "_capture"), key=("batch", "country", "url"), once=False)
    return conform(training), cleaned.select(*ARTICLE_COLS, "batch")
