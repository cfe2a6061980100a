"""Large CSV files read by many tasks: the same rows as the reader of whole files."""

import random

import pytest

from corpusflow.session import work_folder
from corpusflow.sources import files, sinks
from corpusflow.sources.split_csv import read_articles_csv_split

SCHEMA = "url string, text string, n int"
AWKWARD = [
    'say "hi"', "two\nlines", "a,b", "back\\slash", " padded ", '""', '"', "ends\\", "\n", "\n\n\n", "x\r\ny", "\r", "é猫\n😀", None,
    'long "quoted"\n' * 60, "\n" * 300, "plain", '"\n"', "tab\tand, comma\n", "last",
]


def written(spark, texts, rows_per_file=10_000):
    path = work_folder(spark, "csv")
    df = spark.createDataFrame([(f"u{k}", t, k) for k, t in enumerate(texts)], SCHEMA).coalesce(1)
    sinks.write_articles_csv(df, path, rows_per_file)
    return df, path


@pytest.fixture
def small_ranges(spark):
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = [spark.conf.get(n) for n in names]

    def use(size):
        spark.conf.set(names[0], size)
        spark.conf.set(names[1], 0)

    yield use
    for n, value in zip(names, before, strict=True):
        spark.conf.set(n, value)


def rows(df):
    return sorted(((r.url, r.text, r.n, r.file_name) for r in df.collect()), key=lambda r: (str(r[0]), r[2] or 0))


@pytest.mark.parametrize("size", [64, 333, 1 << 20])
def test_same_rows_as_the_reader(spark, small_ranges, size):
    rng = random.Random(size)
    texts = AWKWARD + ["".join(rng.choice('ab",\n ') for _ in range(rng.randrange(40))) for _ in range(80)]
    df, path = written(spark, texts, rows_per_file=70)
    want = rows(files.read_articles_csv(spark, path, df.schema))
    small_ranges(size)
    got = rows(read_articles_csv_split(spark, path, df.schema))
    assert got == want and len({r[3] for r in got}) == 2


def test_one_file_is_many_tasks(spark, small_ranges):
    _, path = written(spark, ["some text\nof two lines"] * 400)
    small_ranges(1000)
    lines = spark.read.option("lineSep", "\n").text(path)
    assert files.read_articles_csv(spark, path, "url string, text string, n int").rdd.getNumPartitions() == 1
    assert lines.rdd.getNumPartitions() > 5


def test_empty_files(spark):
    df, path = written(spark, [])
    assert read_articles_csv_split(spark, path, df.schema).collect() == []


def test_crlf_and_blank_lines(spark, tmp_path, small_ranges):
    (tmp_path / "a.csv").write_bytes(b'url,text,n\r\nu1,"a\r\nb",1\r\n\r\nu2,plain,2\r\n')
    small_ranges(12)
    schema = spark.createDataFrame([], SCHEMA).schema
    got = rows(read_articles_csv_split(spark, str(tmp_path), schema))
    assert [r[:3] for r in got] == [("u1", "a\r\nb", 1), ("u2", "plain", 2)]
