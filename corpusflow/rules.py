"""Reference data as plain rows: sources, countries, term lists, extraction rules.

A new source is one row in SOURCES and one in EXTRACT.
"""

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from .functions.html import class_attr, class_like, id_attr

# ---------------------------------------------------------------------------
# Publishers, in registry order within a country.
# (source, country, type, institution_name)
SOURCES = [
    ("schoolsweek", "eng", "ed_media", "Schools Week"),
    ("gov", "eng", "government", None),
    ("epi", "eng", "think_tank", "Education Policy Institute"),
    ("nuffield", "eng", "funder", "Nuffield Foundation"),
    ("fft", "eng", "research_org", "FFT Education Datalab"),
    ("fed", "eng", "prof_body", "Foundation for Educational Development"),
    ("gov_scot", "sco", "government", "Scottish Government"),
    ("sera", "sco", "think_tank", "SERA"),
    ("gtcs", "sco", "prof_body", "GTCS"),
    ("ades", "sco", "prof_body", "ADES"),
    ("children_in_scotland", "sco", "civil_society", "Children in Scotland"),
    ("gov_ie", "irl", "government", "Department of Education (Ireland)"),
    ("esri", "irl", "think_tank", "ESRI"),
    ("erc", "irl", "research_org", "Educational Research Centre"),
    ("teaching_council", "irl", "prof_body", "Teaching Council"),
    ("education_matters", "irl", "ed_media", "Education Matters"),
    ("thejournal", "irl", "ed_media", "TheJournal.ie"),
    ("rte", "irl", "ed_media", "RTÉ News"),
]

# The order in which countries are run and loaded.
COUNTRY_ORDER = ["eng", "irl", "sco"]

# Fixed values: (country, folder, default first date, population in millions)
COUNTRIES = [
    ("eng", "england", "2023-01-01", 56.0),
    ("irl", "ireland", "2023-01-01", 5.0),
    ("sco", "scotland", "2023-01-01", 5.5),
]

# Publisher types.
TYPES = [
    "government", "think_tank", "funder", "research_org",
    "prof_body", "ed_media", "civil_society",
]

# Last day of training data, and the countries that have any.
TRAINING_CUTOFF = "2025-12-31"
TRAINING_COUNTRIES = ["eng", "irl", "sco"]

# Titles with one of these are out of scope ...
TITLE_EXCLUDE = [
    "university", "universities", "college fees", "college ranking",
    "undergraduate", "postgraduate", "phd", "doctoral",
    "campus", "tuition fees", "university ranking",
    "lecturer", "lecturers", "higher education",
    "third level", "third-level",
]

# ... unless they also have one of these.
TITLE_INCLUDE = [
    "school", "schools", "teacher", "teachers", "pupil", "pupils",
    "principal", "classroom", "headteacher", "head teacher",
    "leaving cert", "junior cycle", "senior cycle", "transition year",
    "junior cert", "sna", "special needs assistant", "deis",
    "national school", "post-primary", "special school",
    "school meals", "school transport", "school building",
    "school staff", "school secretary", "school closure",
    "curriculum", "inspectorate", "enrolment",
    "primary", "secondary", "education minister",
    "curriculum for excellence", "additional support needs",
]

# Language terms (with their spaces), how many must be present,
# and the length below which a text is never flagged.
IRISH_TERMS = [
    " agus ", " na ", " ar ", " le ", " do ", " sa ", " den ",
    " ag ", " ón ", " go ", " tá ", " bhí ", " seo ", " sin ",
    " scoil ", " oideachas ", " gaeilge ", " múinteoirí ",
    " an t", " i g", " i m", " i n", " i d", " i b",
]
IRISH_THRESHOLD = 8
LANGUAGE_MIN_CHARS = 50

# Bodies whose government news counts as core, preferred one first.
CORE_BODIES = [
    "Department for Education",
    "Education and Skills Funding Agency",
    "Ofsted",
    "Ofqual",
    "Office for Students",
    "Standards and Testing Agency",
    "Institute for Apprenticeships",
    "Skills England",
]

# Administrative titles to skip, by source.
SKIP_TITLES = {
    "gov_scot": [
        "foi release", "foi review", "foi request",
        "minutes:", "minutes -", "meeting minutes",
        "equality impact assessment", "impact assessment",
        "child rights and wellbeing impact",
        "terms of reference",
    ],
    "teaching_council": ["maintenance", "downtime", "scheduled outage", "system update"],
}

# Sources whose pages list the publishing organisations.
WITH_PUBLISHERS = ["gov"]


@dataclass(frozen=True)
class ExtractRule:
    """How the text of one source's pages is read."""

    containers: tuple  # (tag, attribute regex or None) in order of preference; None is the page
    removed: tuple = ()
    drop: tuple | None = None  # one more element to remove: (tag, attribute regex)
    elements: tuple = ("p",)
    sep: str = " "
    joiner: str = "\n"
    stops: tuple = ()
    stop_tag: str | None = None
    skip_phrases: tuple = ()
    skip_prefix: str | None = None
    literals: tuple = ()
    on_null_date: str = "keep"
    title: tuple = ("h1", None)
    # False: a page without the container is no article and is left out
    allow_missing: bool = True
    # True: a listed page that was not captured is an article without text
    keep_uncaptured: bool = False


_BASIC = ("script", "style", "figure", "aside")
_NAV = _BASIC + ("nav",)
_NAV_FOOT = _NAV + ("footer",)
_PAGE = (None,)
_ARTICLE = (("article", None), ("div", class_like("article")))

# Containers, removed elements, markers and phrases per source.
EXTRACT = {
    "gov": ExtractRule(
        (("main", id_attr("content")),), elements=("p", "li", "h2"), sep="",
        stops=("share this page",), stop_tag="h2", on_null_date="drop", allow_missing=False,
        title=("h1", class_like("(?:gem-c-heading__text|govuk-heading-l)")),
    ),
    "epi": ExtractRule(
        (("div", class_attr("detail-page-content")),), _BASIC, on_null_date="drop",
        title=("h1", class_attr("single-title")),
    ),
    "fft": ExtractRule(
        (("div", class_attr("post-content")),), ("script", "style", "aside"),
        drop=("div", id_attr("footnotes_section")), sep="", on_null_date="drop",
        allow_missing=False, title=("h2", class_attr("entry-title")),
    ),
    "fed": ExtractRule(
        (("div", class_attr("elementor-widget-theme-post-content")),), sep="",
        stops=("The FED are happy to share blogs",), on_null_date="drop", allow_missing=False,
        title=("h1", class_attr("elementor-heading-title")),
    ),
    "nuffield": ExtractRule(
        (("div", class_attr("article-area")),), _BASIC, elements=("h2", "h3", "p"), joiner="\n\n",
        on_null_date="drop", allow_missing=False, title=("h1", class_attr("medium-heading")),
    ),
    "schoolsweek": ExtractRule(_PAGE, _BASIC),
    "gov_scot": ExtractRule(
        (("main", None), ("div", class_attr("body-content")), ("article", None)), _NAV,
        keep_uncaptured=True,
    ),
    "sera": ExtractRule(_PAGE, _BASIC),
    "gtcs": ExtractRule((("main", None),), _NAV_FOOT + ("header",)),
    "ades": ExtractRule(_PAGE),
    "children_in_scotland": ExtractRule((("main", None),), _NAV_FOOT),
    "gov_ie": ExtractRule(
        (("main", None), ("article", None)), _NAV,
        literals=("From: Department of Education and Youth", "(PDF)"),
    ),
    "esri": ExtractRule(
        _PAGE,
        stops=(
            "The Economic and Social Research Institute Whitaker Square",
            "ESRI Accessibility Statement",
            "ESRI Governance Policies",
            "Web Design and Development by Annertech",
        ),
    ),
    "erc": ExtractRule(
        _PAGE, _BASIC,
        skip_phrases=(
            "can be downloaded here",
            "Read the full report here",
            "Check out the infographic here",
            "Explore the appendices",
            "Download the report",
        ),
    ),
    "teaching_council": ExtractRule((("main", None),), _NAV, sep="", skip_prefix="Published"),
    "education_matters": ExtractRule(_PAGE, _BASIC),
    "thejournal": ExtractRule(_ARTICLE, _NAV_FOOT),
    "rte": ExtractRule(_ARTICLE, _NAV_FOOT),
}

# Feed content of these sources is the whole fragment, whatever their pages look like.
FEED_EXTRACT = {**EXTRACT, "teaching_council": ExtractRule(_PAGE, _BASIC)}

# Sources whose feed may hold excerpts: their page's text comes first.
PAGE_FIRST = ["teaching_council"]

# Sources whose captured pages must have text, headings and dates to count.
DROP_BLANK_TEXT = ["gtcs", "ades", "children_in_scotland", "teaching_council"]
# ... and those that also need a heading.
NEED_TITLE = ["fft", "fed"]


def _literal(value, kind: str) -> str:
    if value is None:
        return f"CAST(NULL AS {kind})"
    if kind == "DATE":
        return f"DATE '{value}'"
    if kind == "STRING":
        return "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"
    return f"CAST({value} AS {kind})"


def rows_frame(spark: SparkSession, rows, **columns: str) -> DataFrame:
    """A literal table. Catalyst knows its size, so its own size check decides on
    broadcasting it; no hint is needed or given."""
    body = ", ".join(
        "(" + ", ".join(_literal(v, k) for v, k in zip(row, columns.values(), strict=True)) + ")"
        for row in rows
    )
    return spark.sql(f"SELECT * FROM VALUES {body} AS t({', '.join(columns)})")


def source_dim(spark: SparkSession, sources=None) -> DataFrame:
    """ordinal, source, country, type, institution_name; ordinal is the registry order."""
    rows = SOURCES if sources is None else sources
    ranked = sorted(rows, key=lambda r: COUNTRY_ORDER.index(r[1]))
    return rows_frame(
        spark,
        [(i, *r) for i, r in enumerate(ranked)],
        ordinal="INT", source="STRING", country="STRING", type="STRING", institution_name="STRING",
    )


def country_dim(spark: SparkSession) -> DataFrame:
    return rows_frame(
        spark,
        [(i, *c) for i, c in enumerate(COUNTRIES)],
        country_order="INT", country="STRING", folder="STRING", start="DATE", millions="DOUBLE",
    )


def calendar(spark: SparkSession, runs) -> DataFrame:
    """Run windows: rows of (country, week, since, until), dates as yyyy-MM-dd or None."""
    return rows_frame(spark, runs, country="STRING", week="INT", since="DATE", until="DATE")
