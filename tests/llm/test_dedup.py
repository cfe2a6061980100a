"""Suffix-array, SimHash and embedding deduplication against plain versions."""

import random

import brute
import numpy as np
import pyarrow as pa
import pytest

from corpusflow.llm import suffix_dedup
from corpusflow.llm.common import components, forest
from corpusflow.llm.embedding_dedup import near_vectors
from corpusflow.llm.simhash_dedup import BKForest, near_duplicates
from corpusflow.llm.suffix_dedup import remove_repeats

EMPTY = "doc_id long, text string"


@pytest.fixture(scope="module")
def rows(spark):
    return brute.documents(spark)


def test_repeats_as_by_hand(spark, rows):
    want = brute.repeats(rows)
    got = remove_repeats(brute.frame(spark, rows)).collect()
    assert len(got) == len(rows)
    for r in got:
        if r.doc_id is None:
            assert r.n_removed == 0
        else:
            assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == want[r.doc_id], r.doc_id
    assert sum(v[1] for v in want.values()) > 10_000
    text = {r.doc_id: r.kept_text for r in got}
    assert text[9000] == "" and text[9004] == "One two"


def test_long_texts_are_cut_without_loss(monkeypatch):
    monkeypatch.setattr(suffix_dedup, "SEGMENT", 2048)
    rng = np.random.default_rng(3)
    texts = [bytes(rng.integers(97, 123, n, dtype=np.uint8)).decode() for n in (50, 99, 100, 9000, 0, 700, 2048, 2047, 4000)]
    batch = pa.record_batch([pa.array(range(len(texts))), pa.array(texts)], ["doc_id", "text"])
    starts = {}
    for out in suffix_dedup._cut(25, 100)([batch]):
        for doc, span in zip(out.column("doc_id").to_pylist(), out.column("span").to_pylist(), strict=True):
            starts.setdefault(doc, []).extend((span >> 9) + k for k in range((span >> 1) & 255))
    assert {d: sorted(s) for d, s in starts.items()} == {d: list(range(len(t) - 99)) for d, t in enumerate(texts) if len(t) > 99}


def test_carried_columns(spark):
    df = spark.createDataFrame([(1, "a" * 300, "en"), (2, None, None)], "doc_id long, text string, rest string")
    got = {r.doc_id: r for r in remove_repeats(df, carry=True).collect()}
    assert got[1]["rest"]["rest"] == "en" and got[1].kept_text == "a" and got[2].kept_text == ""


def test_simhash_as_by_hand(spark, rows):
    prints, want = brute.simhash_groups(rows)
    got = near_duplicates(brute.frame(spark, rows), chunk=16).collect()
    assert len(got) == len(rows)
    for r in got:
        if r.doc_id is None:
            assert r.component_id is None
        else:
            assert r.component_id == want[r.doc_id]
            assert r.fp % 2**64 == prints[r.doc_id]
    assert len(set(want.values())) < len(want) - 20


def test_bk_forest_finds_all(spark):
    rng = np.random.default_rng(2)
    base = rng.integers(0, 1 << 63, 30, dtype=np.uint64)
    values = np.unique(np.concatenate([base, base ^ np.uint64(5), base ^ np.uint64(1 << 40), base ^ np.uint64(7)]))
    group = (np.arange(len(values)) % 3).astype(np.int64)
    found = set(zip(*(x.tolist() for x in BKForest(values, group).search(values, group, 2)), strict=True))
    want = {
        (a, b) for a in range(len(values)) for b in range(len(values))
        if group[a] == group[b] and np.bitwise_count(values[a] ^ values[b]) <= 2
    }
    assert found == want


def test_vectors_as_by_hand(spark):
    rows = [(r.vec_id, r.embedding, r.label) for r in spark.read.parquet(f"{brute.SF}/embeddings.parquet").collect()]
    rng = np.random.default_rng(1)
    centre = rng.standard_normal(64)
    rows += [(5000 + k, (centre + rng.standard_normal(64) * 0.1 * rng.random()).tolist(), 3) for k in range(150)]
    rows += [(6000 + k, rows[7][1], rows[7][2]) for k in range(20)]
    rows += [
        (7000, None, 1), (7001, [0.0] * 64, 1), (7002, [float("nan")] + [1.0] * 63, 1), (7003, [None] + [1.0] * 63, 1),
        (7004, rows[7][1], None), (7005, [1.0, 2.0], 1), (7006, [2.0, 4.0], 1), (7007, [], 1), (None, rows[7][1], rows[7][2]),
    ]
    links, want = brute.cosine_groups(rows)
    schema = "vec_id long, embedding array<float>, label int"
    got = near_vectors(brute.frame(spark, rows, schema), chunk=32).collect()
    assert len(got) == len(rows)
    for r in got:
        if r.vec_id is None:
            assert (r.n_links, r.component_id, r.kept) == (0, None, None)
        else:
            assert (r.n_links, r.component_id, r.kept) == (links[r.vec_id], want[r.vec_id], want[r.vec_id] == r.vec_id)
    assert sum(links.values()) > 10_000


def test_empty_tables(spark):
    df = spark.createDataFrame([], EMPTY)
    assert remove_repeats(df).count() == 0
    assert near_duplicates(df).count() == 0
    assert near_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>, label int")).count() == 0


def test_components(spark):
    edges = [(1, 2), (3, 2), (9, 8), (8, 7), (7, 6), (6, 5), (5, 5), (20, 21)] + [(100, k) for k in range(101, 160)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {k: min(k, 1 if k < 4 else 5 if k < 10 else 20 if k < 30 else 100) for k in got} and len(got) == 70
    assert forest(np.array([0, 3, 2]), np.array([1, 2, 1]), 5).tolist() == [0, 0, 0, 0, 4]


def test_repeats_where_one_id_has_several_texts(spark):
    rng = random.Random(6)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(300))
    alone, shared, other = word(), word(), word()
    rows = [(1, shared + "x"), (4, alone), (4, "y" + shared), (4, other), (4, other), (9, other + shared), (None, shared)]
    out = remove_repeats(brute.frame(spark, rows), carry=True).collect()
    got = sorted((r.doc_id or 0, r.n_bytes, r.n_removed) for r in out)
    assert got == sorted([(1, 301, 0), (4, 300, 0), (4, 301, 300), (4, 300, 0), (4, 300, 0), (9, 600, 600), (0, 300, 0)])
    assert {r.kept_text for r in out if r.doc_id == 4} == {alone, "y", other}
    assert all(r.rest.doc_id == r.doc_id for r in out)
