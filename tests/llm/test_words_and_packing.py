"""Spelling variants, the filter audit and packing against plain versions of themselves."""

import collections
import itertools
import random
import re
import zlib
from fractions import Fraction

import brute
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from corpusflow.llm import filter_audit, packing, spelling


def near(a, b):
    """One inserted, deleted or replaced code point."""
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(a) + 1 == len(b) and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def forms_of(words):
    out = {}
    for w, n in words.items():
        others = [v for v in words if near(w, v)]
        best = min(others, key=lambda v: (-words[v], v), default=None)
        form = best if best is not None and words[best] >= 2 * n else None
        out[w] = (form, n, len(others), words[form] if form else None)
    root = {}
    for w in words:
        at = w
        while out[at][0]:
            at = out[at][0]
        root[w] = at
    return {w: (f, root[w], n, k, fn) for w, (f, n, k, fn) in out.items()}


def counted(rows, damage):
    total = collections.Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = brute.lower(run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if damage and h % damage == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            total[run] += 1
    return total


def read(df):
    out = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect()}
    assert df.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    return out


@pytest.mark.parametrize("pairs", [1, 6, 100_000])
def test_forms_with_buckets_split_to_the_end(spark, pairs):
    rng = random.Random(3)
    words = {"ab": 9, "abc": 4, "abcd": 2, "aaaa": 7, "aaaaa": 3, "aaaaaa": 1, "éà": 3, "éàé": 6, "x" * 40: 5, "x" * 41: 10, "x" * 42: 21}
    for k in range(60):  # one hot half: all words begin alike
        words["common" + "".join(rng.choice("abc") for _ in range(rng.randrange(1, 5)))] = rng.randrange(1, 40)
    for k in range(60):
        words["".join(rng.choice("ab") for _ in range(rng.randrange(2, 8)))] = rng.randrange(1, 40)
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    found = spelling.near_pairs(df, pairs).collect()
    want = {frozenset((a, b)) for a, b in itertools.combinations(words, 2) if near(a, b)}
    assert len(found) == len(want) and {frozenset((r.a, r.b)) for r in found} == want
    assert read(spelling.forms(df, pairs=pairs)) == forms_of(words)


@pytest.mark.parametrize("damage", [0, 5, 97])
def test_variants_of_odd_texts(spark, damage):
    rows = brute.documents(spark) + [(9100 + k, "Grüße grüsse GRUESSE Äpfel äpfel ×÷× " * 3) for k in range(4)]
    words = {w: n for w, n in counted(rows, damage).items() if len(w) >= 5 and n >= 3}
    assert read(spelling.spelling_variants(brute.frame(spark, rows), damage=damage)) == forms_of(words)


def test_variants_of_nothing(spark):
    empty = brute.frame(spark, [(1, None), (2, ""), (3, "1 2 3")])
    assert spelling.spelling_variants(empty).collect() == []
    assert spelling.spelling_variants(empty.limit(0)).collect() == []
    with pytest.raises(ValueError):
        spelling.spelling_variants(empty, least_length=1)


def test_runs_that_cross_slices(spark, monkeypatch):
    monkeypatch.setattr(spelling, "SLICE", 7)
    monkeypatch.setattr(spelling, "KEPT", 3)
    text = "alpha beta gammagammagamma delta alpha beta"
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    got = {r.word: r.n for r in spelling.word_counts(df).collect()}
    assert got == collections.Counter(text.split())


def audited(rows, labels):
    """Documents (doc_id, text, part) taken through all orders, one by one."""
    words = lambda t: re.findall(r"[^\x20\x09-\x0D]+", t)
    least = {}
    for i, t, _ in rows:
        if i is not None:
            least[t or ""] = min(least.get(t or "", i), i)
    kinds = collections.Counter()
    good = {i for i, q, x in labels if q == 1 and i is not None}
    toxic = {i for i, q, x in labels if x == 1 and i is not None}
    for i, t, part in rows:
        t = t or ""
        w = words(t)
        fails = "".join(
            f for f, bad in zip("ABCDE", (
                len(w) < 200, 100 * len(set(w)) < 50 * len(w), 100 * len(re.findall("[A-Z]", t)) > 2 * len(t),
                bool(re.search(r"[#$%&*|]", t)), i is not None and least[t] < i,
            ), strict=True) if bad
        )
        kinds[part or "", fails, i in good, i in toxic] += 1
    out = {}
    for part in {p for p, *_ in kinds}:
        share = collections.Counter()
        mine = [(f, g, x, n) for (p, f, g, x), n in kinds.items() if p == part]
        for order in itertools.permutations("ABCDE"):
            left = mine
            for k, f in enumerate(order):
                gone = [m for m in left if f in m[0]]
                left = [m for m in left if f not in m[0]]
                share[f] += sum(m[3] for m in gone)
                out[part, "".join(order), k + 1] = [
                    sum(m[3] for m in left), sum(m[3] for m in gone),
                    sum(m[3] for m in mine if f in m[0]) - sum(m[3] for m in gone), sum(m[3] for m in mine if m[0] == f),
                    sum(m[3] for m in gone if m[1]), sum(m[3] for m in gone if m[2]),
                ]
        for (p, order, k), values in out.items():
            if p == part:
                values.append(share[order[k - 1]])
    return {k: tuple(v) for k, v in out.items()}


def test_audit_of_odd_rows(spark):
    rng = random.Random(2)
    base = brute.documents(spark)
    rows = [(i, t, rng.choice(["a", "b", None, ""])) for i, t in base]
    rows += [(i, t, "other") for i, t in base[:40]]  # the same ids again
    rows += [(None, base[3][1], "a")] * 3 + [(50_000 + k, base[3][1], "c") for k in range(30)]
    rows += [(60_000, "ABC def # " * 90, "b"), (60_001, "ABC def # " * 90, "a"), (-9, "ABC def # " * 90, "a")]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for i, _, _ in rows[::2] if i is not None]
    labels += [(50_001, 1, 0), (50_001, 0, 1), (None, 1, 1), (999_999, 1, 1)]
    df = brute.frame(spark, rows, "doc_id long, text string, source string").withColumn("mask", F.lit("x")).withColumn("part", F.lit("y"))
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int").withColumn("salt", F.lit("x"))
    out = filter_audit.audit(df, marks)
    got = {(r.part, r.filter_order, r.step): tuple(r)[3:] for r in out.collect()}
    assert got == audited(rows, labels)
    assert out.count() == len(got)
    assert filter_audit.audit(df.limit(0), marks).collect() == []
    assert filter_audit.audit(df, marks.limit(0)).agg(F.sum("good_lost")).first()[0] == 0


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5])
def test_shares_are_averages_over_orders(n):
    rng = random.Random(n)
    value = [0] + [rng.randrange(1000) for _ in range((1 << n) - 1)]
    weights = filter_audit.shares(n)
    want = [0] * n
    for order in itertools.permutations(range(n)):
        seen = 0
        for f in order:
            want[f] += value[seen | 1 << f] - value[seen]
            seen |= 1 << f
    assert [sum(w * v for w, v in zip(ws, value, strict=True)) for ws in weights] == want


def test_solve_in_rationals():
    a = [[Fraction(0), Fraction(2), Fraction(4)], [Fraction(3), Fraction(1), Fraction(5)]]
    assert filter_audit.solve(a) == [[Fraction(1)], [Fraction(2)]]


def library():
    from tokenizers import Tokenizer

    tool = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tool.no_truncation()
    tool.no_padding()
    return tool


def bounds(lengths, capacity):
    return -(-sum(lengths) // capacity)


@pytest.mark.parametrize("capacity, open_bins, block", [(2048, 1024, 1024), (64, 4, 8), (64, 1, 1), (1, 2, 3)])
def test_packing_as_the_library_encodes(spark, capacity, open_bins, block):
    rows = brute.documents(spark) + [(9200, "a  <|endoftext|><|endoftext|> b"), (9201, " <|endoftext|> \n\n"), (9202, "it's  it'll　x\x85y")]
    if capacity == 1:
        rows = [(i, (t or "")[:200]) for i, t in rows]
    df = brute.frame(spark, rows)
    out = packing.pack(df, public_tokenizers.path("byte_bpe_50k.json"), 0, capacity, open_bins, block)
    assert out.columns == ["doc_id", "piece", "start", "length", "ids", "sequence_id", "offset"]
    got = out.collect()
    tool = library()
    want = collections.Counter()
    for i, t in rows:
        ids = tool.encode(t or "", add_special_tokens=False).ids + [0]
        cuts = [0, *range(len(ids) % capacity or capacity, len(ids) + 1, capacity)]
        for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
            want[i, k, a, b - a, np.array(ids[a:b], "<u4").tobytes()] += 1
    assert collections.Counter((r.doc_id, r.piece, r.start, r.length, bytes(r.ids)) for r in got) == want
    places = collections.defaultdict(list)
    for r in got:
        places[r.sequence_id].append((r.offset, r.length, bytes(r.ids)))
    for found in places.values():
        found.sort()
        assert [o for o, _, _ in found] == [0, *itertools.accumulate(n for _, n, _ in found)][:-1]
        assert sum(n for _, n, _ in found) <= capacity
    joined = {r.sequence_id: (r.length, bytes(r.ids), r.offsets) for r in packing.sequences(out).collect()}
    assert joined == {s: (sum(n for _, n, _ in f), b"".join(b for *_, b in f), [o for o, *_ in f]) for s, f in places.items()}
    if capacity == 2048:  # five tasks
        assert len(places) <= bounds([r.length for r in got], capacity) + 5
    assert packing.pack(df.limit(0), public_tokenizers.path("byte_bpe_50k.json"), 0).collect() == []


def test_best_fit_takes_the_fullest_bin_that_fits_and_closes_the_fullest():
    bins = packing.OpenBins(10, 3)
    assert [bins.put(n) for n in (6, 7, 8)] == [(0, 0), (1, 0), (2, 0)]
    assert bins.put(2) == (2, 8)  # full: no longer open
    assert bins.put(3) == (1, 7)
    assert bins.put(9) == (3, 0) and bins.put(9) == (4, 0)
    assert bins.put(10) == (5, 0)  # a whole sequence closes nothing
    assert bins.put(5) == (6, 0)  # closes one with 1 free
    assert bins.put(4) == (0, 6) and bins.put(1) == (3, 9)


def test_packing_is_near_the_bound_and_keeps_few_bins_open():
    rng = random.Random(7)
    lengths = [min(2047, 1 + int(rng.lognormvariate(6.4, 1))) for _ in range(30_000)]
    bins, used = packing.OpenBins(2048, packing.OPEN), collections.Counter()
    for lo in range(0, len(lengths), packing.BLOCK):
        for n in sorted(lengths[lo : lo + packing.BLOCK], reverse=True):
            place, offset = bins.put(n)
            assert offset == used[place]
            used[place] += n
            assert bins.open <= packing.OPEN
    assert max(used.values()) <= 2048 and len(used) <= 1.005 * bounds(lengths, 2048)


def test_codes_like_the_library():
    coder, tool = packing.Coder(public_tokenizers.path("byte_bpe_50k.json")), library()
    rng = random.Random(1)
    alphabet = ["a", "B", " ", "  ", "\n", "\t", "'s", "'", "é", "中", "😀", "½", "3", "<|endoftext|>", "\x85", "　", "-", "\x00"]
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(40))) for _ in range(500)]
    letters = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    texts += [f"a{c}1 {c} {c}{c}b  {c}" for c in rng.sample(letters, 20_000)] + [" " * 3_000_000 + "a", "x" * 200_000]
    want = [e.ids for e in tool.encode_batch_fast(texts, add_special_tokens=False)]
    assert all(coder.encode(t) == np.array(ids, "<u4").tobytes() for t, ids in zip(texts, want, strict=True))
