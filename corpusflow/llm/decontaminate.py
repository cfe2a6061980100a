"""Benchmark decontamination: an FM-index per shard of texts, searched for benchmark windows.

A shard is a batch of whole texts. Its words become numbers (those of the benchmark
only); stretches that cannot hold a window, because two neighbouring words never
follow each other in the benchmark, are left out, which loses nothing. The rest gets
a suffix array, its Burrows-Wheeler transform, a wavelet matrix for ranks, and every
RATE-th suffix position. Windows are searched backwards, all at once; occurrences
are located by walking to a sampled position; their words merge into spans.

The benchmark, not the corpus, is sent to the workers, in blocks of bounded size.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import documents, utf8, with_rest

WINDOW = 10
RATE = 8
SHARD_BYTES = 8 << 20
BLOCK_BYTES = 16 << 20  # of benchmark text in one broadcast

# a-z, 0-9 and all bytes of non-ASCII characters are word bytes; A-Z are lowered
_TABLE = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)
)


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_TABLE).split()


class Patterns:
    """Windows of one block of the benchmark as numbers, and the items each belongs to."""

    def __init__(self, items: list[tuple[int, bytes]], window: int):
        self.number: dict[bytes, int] = {}
        found: dict[tuple, set] = {}
        for item, text in items:
            ids = [self.number.setdefault(w, len(self.number) + 2) for w in words_of(text)]
            for at in range(max(1, len(ids) - window + 1) if ids else 0):
                found.setdefault(tuple(ids[at : at + window]), set()).add(item)
        keys = sorted(found, key=len)
        self.symbols = len(self.number) + 2
        self.lengths = np.array([len(k) for k in keys], np.int64)
        self.words = np.zeros((len(keys), window), np.int64)  # right-aligned
        for row, k in enumerate(keys):
            self.words[row, window - len(k) :] = k
        pairs = {a * self.symbols + b for k in keys for a, b in zip(k, k[1:])}
        self.pairs = np.array(sorted(pairs), np.int64)
        self.singles = np.array(sorted(k[0] for k in keys if len(k) == 1), np.int64)
        longer = self.lengths[self.lengths > 1]
        self.shortest = int(longer.min()) if len(longer) else 0
        self.item_start = np.concatenate([[0], np.cumsum([len(found[k]) for k in keys])]).astype(np.int64)
        self.items = np.array([i for k in keys for i in sorted(found[k])], np.int64)


def _member(values: np.ndarray, among: np.ndarray) -> np.ndarray:
    if not len(among):
        return np.zeros(len(values), bool)
    return among[np.minimum(np.searchsorted(among, values), len(among) - 1)] == values


def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """Starts of the suffixes in order, by doubling the compared length."""
    n = len(symbols)
    rank = np.unique(symbols, return_inverse=True)[1].astype(np.int64)
    step = 1
    while True:
        second = np.zeros(n, np.int64)
        second[:-step] = rank[step:] + 1
        key = rank * (n + 1) + second
        order = np.argsort(key, kind="stable")
        key = key[order]
        new = np.zeros(n, np.int64)
        new[order[1:]] = np.cumsum(key[1:] != key[:-1])
        rank = new
        if rank[order[-1]] == n - 1:
            return order
        step *= 2


class WaveletMatrix:
    """Ranks of symbols in a sequence: one bit per level, zeros counted."""

    def __init__(self, sequence: np.ndarray, symbols: int):
        self.levels = []
        for bit in range(max(1, int(symbols - 1).bit_length()) - 1, -1, -1):
            one = (sequence >> bit & 1).astype(bool)
            zeros = np.zeros(len(sequence) + 1, np.int64)
            np.cumsum(~one, out=zeros[1:])
            self.levels.append((bit, zeros))
            sequence = np.concatenate([sequence[~one], sequence[one]])

    def rank(self, symbol: np.ndarray, end: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before each end."""
        start = np.zeros_like(end)
        for bit, zeros in self.levels:
            one = (symbol >> bit & 1).astype(bool)
            a, b, total = zeros[start], zeros[end], zeros[-1]
            start = np.where(one, total + start - a, a)
            end = np.where(one, total + end - b, b)
        return end - start


class FMIndex:
    def __init__(self, sequence: np.ndarray, symbols: int):
        """sequence: symbols from 1 on; 0 is put at its end."""
        sequence = np.append(sequence, 0)
        order = suffix_array(sequence)
        self.bwt = sequence[order - 1]
        self.ranks = WaveletMatrix(self.bwt, symbols)
        self.before = np.concatenate([[0], np.cumsum(np.bincount(sequence, minlength=symbols))])
        self.sampled = order % RATE == 0
        self.positions = order[self.sampled]
        self.sample_rank = np.cumsum(self.sampled) - 1
        self.n = len(sequence)

    def search(self, words: np.ndarray, lengths: np.ndarray):
        """Rows [lo, hi) of each right-aligned pattern."""
        lo, hi = np.zeros(len(words), np.int64), np.full(len(words), self.n)
        live = np.arange(len(words))
        for step in range(words.shape[1]):
            live = live[(lengths[live] > step) & (lo[live] < hi[live])]
            symbol = words[live, words.shape[1] - 1 - step]
            lo[live] = self.before[symbol] + self.ranks.rank(symbol, lo[live])
            hi[live] = self.before[symbol] + self.ranks.rank(symbol, hi[live])
        return lo, np.maximum(lo, hi)

    def locate(self, row: np.ndarray) -> np.ndarray:
        """Positions of rows: step back until a sampled one."""
        out, steps = np.zeros(len(row), np.int64), np.zeros(len(row), np.int64)
        open_ = np.arange(len(row))
        row = row.copy()
        while len(open_):
            at = row[open_]
            here = self.sampled[at]
            done = open_[here]
            out[done] = self.positions[self.sample_rank[row[done]]] + steps[done]
            open_ = open_[~here]
            symbol = self.bwt[row[open_]]
            row[open_] = self.before[symbol] + self.ranks.rank(symbol, row[open_])
            steps[open_] += 1
        return out


def _occurrences(words: list[list[bytes]], patterns: Patterns):
    """(word position in the shard, length, pattern) of every window in a shard of texts."""
    get = patterns.number.get
    # 1 keeps texts apart
    flat = np.array([x for ws in words for x in (*[get(w, 0) for w in ws], 1)], np.int64)
    kept = np.zeros(len(flat), bool)
    joined = _member(flat[:-1] * patterns.symbols + flat[1:], patterns.pairs) & (flat[:-1] > 1) & (flat[1:] > 1)
    edge = np.flatnonzero(np.diff(np.concatenate([[False], joined, [False]]).astype(np.int8)))
    for lo, hi in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True):
        if hi - lo + 1 >= patterns.shortest:
            kept[lo : hi + 1] = True
    kept |= _member(flat, patterns.singles)
    place = np.flatnonzero(kept)
    none = np.zeros(0, np.int64)
    if not len(place):
        return none, none, none
    # a separator wherever two kept words are no neighbours that the benchmark knows
    apart = np.ones(len(place), bool)
    apart[:-1] = ~(joined[np.minimum(place[:-1], len(joined) - 1)] & (place[1:] == place[:-1] + 1))
    sequence = np.ones(len(place) + int(apart.sum()), np.int64)
    at = np.arange(len(place)) + np.cumsum(apart) - apart
    sequence[at] = flat[place]
    origin = np.zeros(len(sequence), np.int64)
    origin[at] = place
    index = FMIndex(sequence, patterns.symbols)
    lo, hi = index.search(patterns.words, patterns.lengths)
    count = hi - lo
    pattern = np.repeat(np.arange(len(count)), count)
    rows = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count) + np.repeat(lo, count)
    return origin[index.locate(rows)], patterns.lengths[pattern], pattern


def _mark(blocks):
    def run(batches):
        for batch in batches:
            data, offsets = utf8(batch.column("text"))
            ids, lo = batch.column("doc_id"), 0
            while lo < len(ids):
                hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + SHARD_BYTES, side="right")) - 1)
                texts = [data[a:b].tobytes() for a, b in zip(offsets[lo:hi], offsets[lo + 1 : hi + 1])]
                out = _shard(ids.slice(lo, hi - lo), texts, [b.value for b in blocks])
                if "rest" in batch.schema.names:
                    out = out.append_column("rest", batch.column("rest").slice(lo, hi - lo))
                yield out
                lo = hi

    return run


def _shard(ids, texts: list[bytes], blocks) -> pa.RecordBatch:
    words = [words_of(t) for t in texts]
    sizes = np.array([len(w) for w in words])
    starts = np.concatenate([[0], np.cumsum(sizes + 1)])
    change = np.zeros(int(starts[-1]) + 1, np.int64)
    pairs = []
    for patterns in blocks:
        at, length, pattern = _occurrences(words, patterns)
        np.add.at(change, at, 1)
        np.add.at(change, at + length, -1)
        doc = np.searchsorted(starts, at, side="right") - 1
        seen = np.unique(np.stack([doc, pattern]), axis=1) if len(doc) else np.zeros((2, 0), np.int64)
        first, count = patterns.item_start[seen[1]], np.diff(patterns.item_start)[seen[1]]
        ramp = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
        pairs.append(np.stack([np.repeat(seen[0], count), patterns.items[ramp + np.repeat(first, count)]]))
    pairs = np.unique(np.concatenate(pairs, axis=1), axis=1)
    hit = np.cumsum(change)[:-1] > 0
    n_hit = np.add.reduceat(np.append(hit, False).astype(np.int64), starts[:-1]) if len(texts) else sizes
    items = [[] for _ in texts]
    for doc, item in pairs.T.tolist():
        items[doc].append(item)
    spans, cleaned = [], []
    for k, text in enumerate(texts):
        runs = _byte_runs(text, hit[starts[k] : starts[k] + sizes[k]]) if n_hit[k] else []
        spans.append([{"start": a, "end": b} for a, b in runs])
        cleaned.append(_without(text, runs).decode("utf-8", "ignore"))
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    return pa.record_batch(
        [
            ids, pa.array(sizes, pa.int64()), pa.array(n_hit, pa.int64()), pa.array(items, pa.list_(pa.int64())),
            pa.array(spans, kind), pa.array(cleaned, pa.string()),
        ],
        ["doc_id", "n_words", "n_hit", "item_ids", "spans", "clean_text"],
    )


def _byte_runs(text: bytes, hit: np.ndarray) -> list[tuple[int, int]]:
    """Byte ranges of the hit words, neighbours merged."""
    word = np.frombuffer(text.translate(_TABLE), np.uint8) != 32
    edge = np.flatnonzero(np.diff(np.concatenate([[False], word, [False]]).astype(np.int8)))
    first, last = edge[::2], edge[1::2]
    turn = np.flatnonzero(np.diff(np.concatenate([[False], hit, [False]]).astype(np.int8)))
    return list(zip(first[turn[::2]].tolist(), last[turn[1::2] - 1].tolist(), strict=True))


def _without(text: bytes, runs) -> bytes:
    parts, at = [], 0
    for a, b in runs:
        parts.append(text[at:a])
        at = b
    return b"".join([*parts, text[at:]])


def _blocks(benchmark: DataFrame, item_col: str, text_col: str, window: int):
    spark = benchmark.sparkSession
    rows = benchmark.select(F.col(item_col).cast("long").alias("i"), F.col(text_col).alias("t")).filter(
        "i is not null and t is not null"
    )
    blocks, held, size = [], [], 0
    for row in rows.toLocalIterator():
        held.append((row.i, row.t.encode()))
        size += len(held[-1][1])
        if size > BLOCK_BYTES:
            blocks.append(spark.sparkContext.broadcast(Patterns(held, window)))
            held, size = [], 0
    if held or not blocks:
        blocks.append(spark.sparkContext.broadcast(Patterns(held, window)))
    return blocks


def contamination(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW,
    carry: bool = False,
) -> DataFrame:
    """Words of each text that lie in an occurrence of ``window`` successive benchmark words.

    An item of fewer words, but not none, is one window. Returns doc_id, n_words,
    n_hit (hit words), item_ids (items with occurring windows, ascending), spans (byte
    ranges of merged hit words) and clean_text (the text without them).

    Null text: no words. Null item_id or item text: no windows. Empty benchmark: no
    hits. Rows are kept one for one, repeated or with a null doc_id too. No rows: no
    rows. Other columns are ignored, or with carry returned in a struct named rest.
    One pass over the texts, no shuffle; the benchmark passes the driver in blocks of BLOCK_BYTES of text.
    """
    blocks = _blocks(benchmark, item_col, item_text_col, window)
    texts = documents(docs, id_col, text_col, carry)
    schema = (
        "doc_id long, n_words long, n_hit long, item_ids array<long>, spans array<struct<start:long,end:long>>, clean_text string"
    )
    return texts.mapInArrow(_mark(blocks), with_rest(schema, texts))
