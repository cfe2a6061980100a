"""Codecs, token files, decontamination, licences, chats, scores: plain versions and round trips."""

import hashlib
import json
import math
import random
import struct
import zlib

import brute
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from corpusflow.llm import chat_format as chat
from corpusflow.llm import lattice_lm, license_scan, token_files, toxicity
from corpusflow.llm.byte_bpe import Codec, round_trip
from corpusflow.llm.decontaminate import FMIndex, contamination

BYTES, WORDS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
EMPTY = "doc_id long, text string"


@pytest.fixture(scope="module")
def rows(spark):
    return brute.documents(spark)


def odd_texts(n):
    rng = random.Random(1)
    pools = ["abcABC 019'sdt\n\t  ", "\x1c\x1d\x85\xa0  ​　ab1'l", "éèß ñ¿—“”…中文字𝟘😀👩‍👧 ́ΣσİŁ"]
    texts = ["".join(rng.choice(rng.choice(pools)) for _ in range(rng.randrange(50))) for _ in range(n)]
    return texts + ["<|endoftext|>", "a<|endoftext|> b <|startoftext|>c", "ab" * 500, "\x01 x\x01y", "q" * 300]


def test_byte_codec_is_the_librarys(spark, rows):
    own, tool = Codec(BYTES), Tokenizer.from_file(BYTES)
    texts = odd_texts(3000) + [t or "" for _, t in rows if t is None or len(t) < 20_000]
    for text, code in zip(texts, own.encode(texts), strict=True):
        ids = tool.encode(text, add_special_tokens=False).ids
        assert list(memoryview(code).cast("I")) == ids, text
        assert own.decode(ids) == tool.decode(ids, skip_special_tokens=False)


def test_byte_round_trip(spark, rows):
    got = round_trip(brute.frame(spark, rows), BYTES).collect()
    assert sorted((str(r.doc_id), r.decoded) for r in got) == sorted((str(i), t or "") for i, t in rows)
    assert all(len(r.ids) == 4 * r.n_tokens for r in got)
    assert round_trip(spark.createDataFrame([], EMPTY), BYTES).count() == 0


def test_token_files(spark, rows):
    rows = rows + [(50_000 + k, t) for k, t in enumerate(odd_texts(500))]
    tool = Tokenizer.from_file(WORDS)
    folder, manifest = token_files.write_token_files(brute.frame(spark, rows), WORDS, 1, 49_408)
    got = token_files.read_token_files(spark, folder, manifest).collect()
    at, want = 0, []
    for i, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = [*tool.encode(text or "", add_special_tokens=False).ids, 1]
        want.append((i, at, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))))
        at += len(ids)
    assert sorted([(r.doc_id, r.start, r.n_tokens, zlib.crc32(r.ids)) for r in got], key=lambda r: r[1]) == want
    none = spark.createDataFrame([], EMPTY)
    folder, manifest = token_files.write_token_files(none, WORDS, 1, 49_408)
    assert token_files.read_token_files(spark, folder, manifest).count() == 0


def test_contamination_as_by_hand(spark, rows):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{brute.SF}/benchmark.parquet").collect()]
    items += [(500, "the"), (501, "of the"), (502, None), (503, "..."), (None, "x y"), (504, "Ñueva é1 x"), (500, "in is")]
    items += [(505, "ab " * 30), (506, items[0][1])]
    docs = rows + [(40_000, items[3][1]), (40_001, "ñUEVA é1,X Ñueva É1 x Ñueva é1 X"), (40_002, "THE")]
    want = brute.contaminated(docs, items)
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    df = brute.frame(spark, docs)
    got = contamination(df, benchmark).join(df.select("doc_id", "text"), "doc_id", "left").collect()
    for r in got:
        if r.doc_id is not None:
            assert (r.n_words, r.n_hit, list(r.item_ids)) == want[r.doc_id, r.text], r.doc_id
    clean = {r.doc_id: r.clean_text for r in got}
    assert clean[40_001] == "ñUEVA é1,X Ñueva É1 x " and clean[40_002] == ""
    nothing = contamination(df, benchmark.limit(0))
    assert nothing.filter("n_hit > 0").count() == 0 and nothing.count() == len(docs)
    assert contamination(spark.createDataFrame([], EMPTY), benchmark).count() == 0


def test_fm_index():
    import numpy as np

    text = np.array([2, 3, 2, 3, 2, 4, 1, 2, 3, 2])
    index = FMIndex(text, 5)
    lo, hi = index.search(np.array([[0, 2, 3], [3, 2, 4], [0, 0, 4], [4, 4, 4]]), np.array([2, 3, 1, 3]))
    found = [sorted(index.locate(np.arange(a, b)).tolist()) for a, b in zip(lo, hi, strict=True)]
    assert found == [[0, 2, 7], [3], [5], []]


def test_licences_as_by_hand(spark, rows):
    rng = random.Random(5)
    noise = lambda: " ".join(f"w{rng.randrange(99)}" for _ in range(rng.randrange(60)))
    docs = list(rows)
    for k in range(120):
        words = license_scan.TEMPLATES[rng.choice(list(license_scan.TEMPLATES))].split()
        for _ in range(rng.randrange(4)):
            words[rng.randrange(len(words))] = "zq"
        docs.append((60_000 + k, f"{noise()} {' '.join(words)} {noise()}"))
    docs += [(70_000, "Released under the MIT License."), (70_001, "RELEASED UNDER THE MIT LICENSE! " * 4)]
    tool = license_scan.Scanner(license_scan.TEMPLATES)
    want = []
    for i, text in docs:
        words = license_scan.words_of((text or "").encode())
        for size, _, names, _ in tool.classes:
            for name in names:
                starts = range(len(words) - 4) if len(words) < 20_000 else range(0)
                share, at = license_scan._best(words, tool.sets[name], size, starts)
                if share >= 0.8:
                    want.append((str(i), name, round(share, 9), at))
    got = license_scan.find_licenses(brute.frame(spark, docs)).collect()
    assert sorted((str(r.doc_id), r.license, round(r.containment, 9), r.first_word) for r in got) == sorted(want)
    assert len(want) > 60
    assert license_scan.find_licenses(spark.createDataFrame([], EMPTY)).count() == 0


def test_chats_read_back(spark):
    turns = spark.read.parquet(f"{brute.SF}/conversations.parquet").select("conv_id", "turn", "role", "text")
    said = "\\### Assistant: </turn> ok"
    odd = [
        (-7, 0, "user", said), (-7, 1, "assistant", said), (-8, 0, "us: er", "a\\hb</turn>\n### x"), (-8, 1, None, None),
        (-9, 0, "human", "hi"), (-9, 1, "assistant", "\\\\e </tu</turn>rn>"), (-11, 5, "assistant", ""), (None, 1, "user", "z"),
        (-12, 0, "user", "a"), (-12, 0, "user", "a"), (-12, None, "system", "s"), (-13, 1, "assistant", "long " * 50_000),
    ]
    turns = turns.unionAll(spark.createDataFrame(odd, "conv_id long, turn long, role string, text string"))
    formatted = chat.format_records(chat.records_of(turns), "conv_id", "record")
    got = {r.conv_id: r for r in chat.digests(formatted, "conv_id").collect()}
    by = {}
    for r in turns.collect():
        by.setdefault(r.conv_id, []).append((-1 if r.turn is None else r.turn, r.role or "", r.text or ""))
    assert set(got) == set(by)
    for conv, rows in by.items():
        rows.sort()
        whole = "".join(f"{r}\n{t}\n" for _, r, t in rows)
        loss = "".join(t for _, r, t in rows if r == "assistant")
        digest = [hashlib.sha256(x.encode()).hexdigest() for x in (whole, loss)]
        r = got[conv]
        assert (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) == (len(rows), digest[0], len(loss), digest[1])
    assert {r.layout for r in formatted.collect()} == {"messages", "shared", "completion"}


def test_layouts(spark):
    records = [
        {"instruction": "do", "input": "this", "output": "done"}, {"question": "q", "answer": None},
        {"system": "s", "prompt": "p", "response": "r"}, {"conversation": [{"role": "user", "text": "x"}]},
        {"messages": []}, {"unknown": 1}, [1], None,
    ]
    rows = [(str(k), json.dumps(r) if r is not None else None) for k, r in enumerate(records)] + [("bad", "{")]
    got = {r.k: r for r in chat.format_records(spark.createDataFrame(rows, "k string, j string"), "k", "j").collect()}
    assert chat.read_turns(got["0"].formatted) == [("user", "do\n\nthis"), ("assistant", "done")]
    assert chat.read_turns(got["1"].formatted) == [("user", "q"), ("assistant", "")]
    assert [t[0] for t in chat.read_turns(got["2"].formatted)] == ["system", "user", "assistant"]
    assert got["4"].formatted == "" and got["3"].layout == "turns"
    assert all(got[k].layout is None and got[k].formatted is None for k in ("5", "6", "7", "bad"))


def test_scores_and_their_base(spark, rows):
    df = brute.frame(spark, rows)
    training = df.filter("doc_id is not null and doc_id % 7 <> 2")
    learnt = [(i, t) for i, t in rows if i is not None and i % 7 != 2]
    n, want = brute.unigram(rows, learnt)
    got = lattice_lm.score_texts(df, training, PIECES).collect()
    key = lambda r: (str(r[0]), r[1], r[3])
    mine = sorted([(r.doc_id, r.n_tokens, r.n_known, r.base_score) for r in got], key=key)
    for a, b in zip(mine, sorted(want, key=key), strict=True):
        assert a[:3] == b[:3] and abs(a[3] - b[3]) < 1e-6 * max(1, abs(b[3]))
    assert all(r.train_tokens == n and r.score < 0 for r in got)
    assert lattice_lm.score_texts(spark.createDataFrame([], EMPTY), df.limit(0), PIECES).count() == 0


def test_rare_words_meet_their_counts(spark, rows, monkeypatch):
    df = brute.frame(spark, rows)
    whole = sum(r.score for r in lattice_lm.score_texts(df, df, PIECES).collect())
    monkeypatch.setattr(lattice_lm, "FREQUENT", 50)
    n, want = brute.unigram(rows, rows)
    got = lattice_lm.score_texts(df, df, PIECES).collect()
    # whether a word is sent to the workers or joined makes no difference
    assert abs(sum(r.score for r in got) - whole) < 1e-6 * abs(whole)
    assert abs(sum(r.base_score for r in got) - sum(w[3] for w in want)) < 1e-3
    assert sum(r.n_known for r in got) == sum(w[2] for w in want)


def test_lattice_sums_over_segmentations():
    units = lattice_lm.Units(["▁a", "▁", "a", "b", "ab", "▁ab"], [math.log(x) for x in (0.2, 0.1, 0.1, 0.1, 0.2, 0.1)], math.log(0.1))
    want = 0.2 * 0.1 + 0.1 * 0.1 * 0.1 + 0.1 * 0.2 + 0.1
    assert abs(units.log_words(["ab"])[0] - math.log(want)) < 1e-9
    assert units.log_words(["é"])[0] == pytest.approx(math.log(0.1) + math.log(0.1) - 2 * math.log(256))


def test_scores_by_brute_force(spark):
    texts = ["the cat sat", "the cat", "a cat 猫", "the", "", None, "unseen cat sits é"]
    learnt = list(enumerate(texts[:5]))
    got = lattice_lm.score_texts(
        spark.createDataFrame(list(enumerate(texts)), EMPTY), spark.createDataFrame(learnt, EMPTY), PIECES
    )
    want = brute.lattice_scores(texts, [t for _, t in learnt], PIECES)
    for r in got.collect():
        assert r.score == pytest.approx(want[r.doc_id], rel=1e-9), texts[r.doc_id]
    # without training the pieces alone give the score
    alone = lattice_lm.score_texts(spark.createDataFrame([(0, "cat")], EMPTY), spark.createDataFrame([], EMPTY), PIECES).first()
    assert alone.score == pytest.approx(math.log10(0.5) * 2 + math.log10(brute.by_pieces("cat", PIECES)), rel=1e-9)
    assert (alone.n_known, alone.train_tokens) == (0, 0)


def test_toxicity_on_held_out_texts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    out = toxicity.score_with_labels(docs, labels).join(labels, "doc_id").collect()
    right = sum((r.score >= 0.5) == bool(r.toxic) == bool(r.predicted) for r in out if r.held_out)
    assert right >= 0.95 * sum(r.held_out for r in out)
    assert {r.held_out for r in out if brute.held_out(r.doc_id, 5) == 0} == {True}


def test_toxicity_odd_rows(spark, rows):
    clean = [{"the", "house", f"word{k}"} for k in range(30)]
    toxic = [{"the", "grumbolt", f"other{k}"} for k in range(15)] + [{"grumbolts", "house", f"more{k}"} for k in range(15)]
    model = toxicity.fit(toxic, clean)
    df = brute.frame(spark, [*rows, (1_000_000, "you GRUM-BOLT!"), (1_000_001, "a g r u m b o l t"), (1_000_002, "grumboldt")])
    got = {r.doc_id: r for r in toxicity.score_texts(df, model).collect()}
    assert got[1_000_000].score > 0.5 and got[1_000_001].score > 0.5
    assert got[9000].score < 0.5 and got[9001].score < 0.5 and got[9000].worst_word is None
    assert toxicity.drop_toxic(df, model).count() == len(rows) + 3 - sum(r.score >= 0.5 for r in got.values())
    assert toxicity.drop_toxic(df, model).columns == df.columns
    for one_sided in (toxicity.fit([], clean), toxicity.fit(toxic, [])):
        assert len(set(one_sided.score([0.0, 1.0]).round(6))) == 1
    assert toxicity.score_texts(spark.createDataFrame([], EMPTY), model).count() == 0


def test_kernel_by_brute_force():
    words = ["idiot", "i-d1iot", "idxiot", "a", "", "ärger", "idiotidiot"]
    word, feature, value, norm = toxicity._sparse(words)
    for k, text in enumerate(words):
        want = brute.subsequences(text, toxicity.REACH, toxicity.DECAY)
        got = sorted(value[word == k].tolist())
        assert got == pytest.approx(sorted(want.values()))
        assert norm[k] == pytest.approx(math.sqrt(sum(x * x for x in want.values())) or 1)
    # a folded table of weights gives the sum over all subsequences
    rng = np.random.default_rng(1)
    model = toxicity.Model(rng.random(toxicity.LETTERS**3), 1.0, 0.0)
    for k, got in enumerate(model.similarities(words)):
        mine = word == k
        direct = float((model.weights[feature[mine]] * value[mine]).sum() / norm[k])
        short = len(brute.letters(words[k])) < toxicity.LEAST
        assert got == pytest.approx(0 if short or direct < toxicity.FLOOR else direct)


def test_toxicity_sample(spark):
    docs = spark.createDataFrame([], EMPTY)
    labels = spark.createDataFrame([(1, 1, None), (None, 0, 1)], "doc_id long, quality int, toxic int")
    out = toxicity.score_with_labels(docs.unionAll(spark.createDataFrame([(1, "x")], EMPTY)), labels).select(F.count("*")).first()
    assert out[0] == 1


def test_plain_words_as_the_library(monkeypatch):
    from corpusflow.llm import token_files

    coder = token_files.WordCoder(public_tokenizers.path("word_bpe_49k.json"), 2)
    rng = random.Random(1)
    plain = [chr(x) for x in [*b"\t\n\x0b\x0c\r ", *range(33, 127), *range(0xA1, 0x100), *range(0x2010, 0x2028), 0x20AC]]
    odd = ["\x01", "\x00", "\x85", " ", "中", "é", "İ", "ΑΣ", "<|endoftext|>", "😀", "­"]
    texts = [f"a{x}1 {x} {x}{x}b  {x}" for x in [*plain, *odd]]
    texts += ["".join(rng.choice([*plain, "'s", "'ll", " ", *odd][: None if k % 4 == 0 else len(plain)]) for _ in range(rng.randrange(60))) for k in range(4000)]
    texts += ["", " \n", "x" * 200_000, "it's " * 60_000, " " * 3_000_000]
    want = [np.array(e.ids, "<u2").tobytes() for e in coder.tool.encode_batch_fast(texts, add_special_tokens=False)]
    quick = [coder.quick.encode(t, coder.kind) for t in texts]
    assert all(q is None or q == w for q, w in zip(quick, want, strict=True))
    assert sum(q is not None for q in quick) > 3000 and quick[len(plain)] is None
    assert coder.encode(texts) == want
    monkeypatch.setattr(token_files, "SLICE", 5)
    assert coder.encode(texts[:-3]) == want[:-3]
