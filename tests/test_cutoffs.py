"""Cut-offs: hand-worked traces, and the scan over chunks against a plain loop."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

from corpusflow.operators import cutoff

OLD, IN, NEW = datetime.date(2023, 1, 1), datetime.date(2024, 1, 15), datetime.date(2025, 1, 1)
SINCE, UNTIL = "2024-01-01", "2024-12-31"
KINDS = {"o": OLD, "k": IN, "s": NEW, "n": None, "f": OLD}
SCHEMA = "source string, section string, page int, pos int, url string, date date, failed boolean"


def listing(spark, pages, source="s"):
    """pages: one string per page, a letter per row (old, kept, skip, null date, failed)."""
    rows = [
        (source, "all", p, i, f"{source}{p}.{i}", KINDS[c], c == "f")
        for p, page in enumerate(pages) for i, c in enumerate(page)
    ]
    return cutoff.mark(spark.createDataFrame(rows, SCHEMA), SINCE, UNTIL)


def urls(df):
    return sorted(r.url for r in cutoff.cut(df).collect())


def test_first_old_hides_what_follows_a_pinned_row(spark):
    df = listing(spark, ["kok", "kk"])
    assert urls(cutoff.first_old(df)) == ["s0.0"]
    assert sorted(r.url for r in cutoff.loss(cutoff.first_old(df)).collect()) == ["s0.2", "s1.0", "s1.1"]
    assert urls(cutoff.streak(df, 3)) == ["s0.0", "s0.2", "s1.0", "s1.1"]


def test_streak_resets_at_a_skipped_row(spark):
    assert urls(cutoff.streak(listing(spark, ["koosoook"]), 3)) == ["s0.0"]
    assert urls(cutoff.streak(listing(spark, ["kook", "ook"]), 3)) == ["s0.0", "s0.3", "s1.2"]
    assert urls(cutoff.streak(listing(spark, ["ko", "o", "ok"]), 3, chunk_pages=1)) == ["s0.0"]


def test_streak_per_page_passes_over_failed_rows(spark):
    assert urls(cutoff.streak(listing(spark, ["koooo", "foooo", "k"]), 5, scope="page", reset_on_failed=False)) == ["s0.0", "s2.0"]
    assert urls(cutoff.streak(listing(spark, ["koofooo", "k"]), 5, scope="page", reset_on_failed=False)) == ["s0.0"]
    assert urls(cutoff.streak(listing(spark, ["koofooo", "k"]), 5, scope="page")) == ["s0.0", "s1.0"]


def test_stale_pages_stop_after_three_in_a_row(spark):
    df = listing(spark, ["k", "o", "s", "k", "o", "o", "o", "k"])
    assert urls(cutoff.stale_pages(df, 3)) == ["s0.0", "s3.0"]
    # pages that are entirely too new count as stale
    assert urls(cutoff.stale_pages(listing(spark, ["s", "s", "s", "k"]), 3)) == []


def test_unproductive_page(spark):
    df = listing(spark, ["k", "s", "k"])
    good = ~F.col("old") & ~F.col("skip")
    assert urls(cutoff.unproductive(df, good, 1)) == ["s0.0"]
    assert urls(cutoff.unproductive(df, good | F.col("skip"), 1)) == ["s0.0", "s2.0"]


def test_first_seen_within_source_or_section(spark):
    rows = [("s", "a", 0, 0, "x"), ("s", "a", 1, 0, "x"), ("s", "b", 0, 0, "x"), ("s", "b", 0, 1, "y"), ("t", "a", 0, 0, "x")]
    df = spark.createDataFrame(rows, "source string, section string, page int, pos int, url string")

    def new(scope):
        return sorted((r.source, r.section, r.page, r.pos) for r in cutoff.first_seen(df, scope).filter("is_new").collect())

    assert new(("source",)) == [("s", "a", 0, 0), ("s", "b", 0, 1), ("t", "a", 0, 0)]
    assert new(("source", "section")) == [("s", "a", 0, 0), ("s", "b", 0, 0), ("s", "b", 0, 1), ("t", "a", 0, 0)]


def loop_streak(pages, k, per_page, reset_on_failed):
    kept, run = [], 0
    for p, page in enumerate(pages):
        if per_page:
            run = 0
        for i, c in enumerate(page):
            if c == "f":
                run = 0 if reset_on_failed else run
            elif c == "o":
                run += 1
                if run >= k:
                    return kept
            else:
                run = 0
                if c != "s":
                    kept.append((p, i))
    return kept


@pytest.mark.parametrize("k", [1, 2, 3, 5])
@pytest.mark.parametrize("chunk", [1, 2, 7, 1024])
def test_streak_matches_a_loop_for_any_chunking(spark, k, chunk):
    rng = random.Random(k * 100 + chunk)
    frames, expected = [], {}
    for s in range(40):
        weights = (rng.choice([0.5, 0.75, 0.9]), 0.4, 0.1, 0.05, 0.1)
        pages = ["".join(rng.choices("oksnf", weights, k=rng.randint(1, 4))) for _ in range(rng.randint(1, 12))]
        frames.append((f"s{s:02d}_", pages))
        expected[f"s{s:02d}_"] = pages
    rows = [
        (name, "all", p, i, f"{name}{p}.{i}", KINDS[c], c == "f")
        for name, pages in frames for p, page in enumerate(pages) for i, c in enumerate(page)
    ]
    df = cutoff.mark(spark.createDataFrame(rows, SCHEMA), SINCE, UNTIL)
    for per_page, reset in [(False, True), (False, False), (True, False)]:
        got = urls(cutoff.streak(df, k, "page" if per_page else "listing", reset, chunk_pages=chunk))
        want = sorted(f"{n}{p}.{i}" for n, pages in expected.items() for p, i in loop_streak(pages, k, per_page, reset))
        assert got == want
