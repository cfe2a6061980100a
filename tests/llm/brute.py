"""Plain versions of the operators, for small inputs, and rows with all the odd cases."""

import collections
import hashlib
import itertools
import math
import random
import re
import zlib

import numpy as np
import xxhash

SF = "/root/testdata/sf0.001"


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def documents(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    rng = random.Random(5)
    words = rows[5][1].split()
    for k in range(40):  # near copies
        changed = list(words)
        changed[rng.randrange(len(changed))] = f"zz{k}"
        rows.append((20_000 + k, " ".join(changed)))
    rows += [(30_000 + k, rows[7][1]) for k in range(5)]  # exact copies
    rows += [
        (9000, None), (9001, ""), (9002, " \n\t"), (9003, "one"), (9004, "One two"), (9005, "ab " * 400), (9006, "x" * 3000),
        (9007, "é" * 500), (9008, "i d i o t and 中文字 ½ 😀 a\x1cb\x85c d"), (9009, "ab" * 300 + rows[3][1]),
        (9010, rows[11][1] + " tail"), (9010, rows[11][1] + " tail"), (None, rows[12][1]), (None, None),
        (9011, "The  end <|endoftext|> it's\n\n  ok "), (-3, rows[13][1]), (9012, "longer " * 60_000),
    ]
    return rows


def frame(spark, rows, schema="doc_id long, text string"):
    """Rows over several partitions, with columns whose names operators use themselves."""
    df = spark.createDataFrame(rows, schema).repartition(5)
    for name in ("key", "span", "spans", "fp", "node", "score", "ids", "word", "n", "rest", "value", "whole", "_n"):
        if name not in df.columns:
            df = df.selectExpr("*", f"'x' AS `{name}`")
    return df


def with_id(rows):
    return list({(i, t or "") for i, t in rows if i is not None})


def repeats(rows, size=100):
    seen, out = set(), {}
    for i, text in sorted(with_id(rows)):
        data = text.encode()
        gone = bytearray(len(data))
        for p in range(len(data) - size + 1):
            part = data[p : p + size]
            if part in seen:
                gone[p : p + size] = b"\1" * size
            seen.add(part)
        kept = bytes(b for b, g in zip(data, gone, strict=True) if not g)
        runs = sum(1 for k, g in enumerate(gone) if g and not (k and gone[k - 1]))
        out[i] = (len(data), sum(gone), runs, hashlib.sha256(kept).hexdigest())
    return out


def find(parent, x):
    while parent[x] != x:
        parent[x] = parent[parent[x]]
        x = parent[x]
    return x


def groups(ids, pairs):
    parent = {i: i for i in ids}
    for a, b in pairs:
        a, b = find(parent, a), find(parent, b)
        parent[max(a, b)] = min(a, b)
    return {i: find(parent, i) for i in ids}


def simhash(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", lower(text))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    bits = collections.Counter(b for h, n in collections.Counter(hashes).items() for b in range(64) if h >> b & 1 for _ in range(n))
    return sum(1 << b for b in range(64) if bits[b] * 2 > len(hashes))


def simhash_groups(rows):
    prints = {i: simhash(t) for i, t in with_id(rows)}
    ids = sorted(prints)
    near = [(a, b) for a in ids for b in ids if a < b and (prints[a] ^ prints[b]).bit_count() <= 2]
    return prints, groups(ids, near)


def shingle_set(text):
    words = (text or "").lower().split()
    return {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set()


def jaccard_groups(rows):
    """Groups by Jaccard similarities of 0.8 or more, counted over shared shingles."""
    sets = {i: shingle_set(t) for i, t in with_id(rows)}
    holders = collections.defaultdict(list)
    for i, s in sets.items():
        for x in s or [()]:
            holders[x].append(i)
    near = []
    for a, s in sets.items():
        both = collections.Counter(b for x in s or [()] for b in holders[x] if b < a)
        near += [(b, a) for b, n in both.items() if not s or n / (len(s) + len(sets[b]) - n) >= 0.8]
    return groups(sorted(sets), near)


def cosine_groups(rows):
    good = {}
    for i, v, label in rows:
        if i is not None and v and label is not None and all(x is not None and math.isfinite(x) for x in v) and any(v):
            good[i] = np.array(v, np.float32).astype(float), label
    links = collections.Counter()
    pairs = []
    for a, (x, p) in good.items():
        for b, (y, q) in good.items():
            if a < b and p == q and len(x) == len(y) and x @ y / math.sqrt((x @ x) * (y @ y)) >= 0.98:
                links.update((a, b))
                pairs.append((a, b))
    return links, groups([i for i, _, _ in rows if i is not None], pairs)


def contaminated(docs, items, size=10):
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(t))
    windows = collections.defaultdict(set)
    for item, text in items:
        ws = words(text)
        if item is not None and ws:
            for k in range(max(1, len(ws) - size + 1)):
                windows[tuple(ws[k : k + size])].add(item)
    lengths = sorted({len(w) for w in windows})
    out = {}
    for i, text in docs:
        ws, hit, found = words(text), set(), set()
        for n in lengths:
            for p in range(len(ws) - n + 1):
                if (w := tuple(ws[p : p + n])) in windows:
                    hit.update(range(p, p + n))
                    found |= windows[w]
        out[i, text] = (len(ws), len(hit), sorted(found))
    return out


def unigram(rows, learnt):
    split = lambda t: re.findall(r"[^\x20\x09-\x0D]+", lower(t))
    counts, ends = collections.Counter(), 0
    for i, text in learnt:
        counts.update(split(text))
        ends += 1
    n, v = sum(counts.values()) + ends, len(counts) + (ends > 0)
    part = lambda c: math.log10((c + 1) / (n + v + 1))
    return n, [
        (i, len(split(t)) + 1, sum(w in counts for w in split(t)) + (ends > 0), sum(part(counts[w]) for w in split(t)) + part(ends))
        for i, t in rows
    ]


def by_pieces(word, path):
    """Probability of a word: the sum over every way to cut it, each written out."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    plain = [i for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]
    ranked = sorted(plain, key=lambda i: (-model.get_score(i), i))
    zipf = {model.id_to_piece(i): 1 / (at + 10) for at, i in enumerate(ranked)}
    total, text, out = sum(zipf.values()), "▁" + word, 0.0
    for cuts in itertools.product([0, 1], repeat=len(text) - 1):
        ends = [k + 1 for k, cut in enumerate(cuts) if cut] + [len(text)]
        p = 1.0
        for a, b in zip([0, *ends], ends):
            piece = text[a:b]
            p *= 0.99 * zipf[piece] / total if piece in zipf else 0.01 / 256 ** len(piece.encode()) if b == a + 1 else 0
        out += p
    return out


def lattice_scores(texts, learnt, path):
    split = lambda t: re.findall(r"[^\x20\x09-\x0D]+", lower(t))
    counts = collections.Counter(w for t in learnt for w in split(t))
    n, v = sum(counts.values()) + len(learnt), len(counts) + 1
    base = lambda c: (c + 1) / (n + v + 1)
    memo = {w: by_pieces(w, path) * 0.5 * len(counts) / n for t in [*texts, *learnt] for w in split(t)}
    lattice = lambda w, c, out=0: memo[w] + max(c - 0.5, 0) / (n - out)
    fit = lambda m: sum(c * math.log10(m * base(c - 1) + (1 - m) * lattice(w, c - 1, 1)) for w, c in counts.items())
    m = max((0.05, 0.1, 0.2, 0.3, 0.5, 0.7, 0.8, 0.9, 0.95), key=fit)
    end = math.log10(m * base(len(learnt)) + (1 - m) * len(learnt) / n)
    return [sum(math.log10(m * base(counts[w]) + (1 - m) * lattice(w, counts[w])) for w in split(t)) + end for t in texts]


def letters(word):
    return re.sub(r"[\W\d_]+", "", word)


def subsequences(word, reach, decay):
    """Weight of each three-letter subsequence of a word with its start and end, gaps decayed."""
    text, out = ["<", *letters(word), ">"], collections.Counter()
    for i, j, k in itertools.combinations(range(len(text)), 3):
        if j - i <= reach and k - j <= reach:
            out[text[i], text[j], text[k]] += decay ** (k - i - 2)
    return out


def held_out(doc_id, of):
    return zlib.crc32(str(doc_id).encode()) % of
