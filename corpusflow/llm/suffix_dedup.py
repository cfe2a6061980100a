"""Removal of repeated byte strings by distributed prefix doubling.

Every start of a ``threshold``-byte window is a suffix. The names (ranks) of its
prefixes are built at doubling lengths, threshold/4, /2 and the threshold: a name
of length 2L is the pair of the names of length L at the start and at offset L,
composed by a polynomial, so no lookup is needed. Spark sorts (name, class,
position) in each round and reranks:

* positions whose name is unique are settled: they repeat nothing;
* positions whose whole stretch is the same as an earlier one are settled: removed;
* the others go on with the next length, and end at the threshold.

One row for each byte would be many times the input, so a round keeps
synchronising positions only: among all names of length L inside a window the
smallest stands for the window. Equal windows choose the same one, and consecutive
windows mostly share it, so a row stands for a run of starts and no equal pair can
be lost. At the threshold itself each window stands alone.
"""

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import documents, longs, stored, utf8, with_rest

THRESHOLD = 100
SEGMENT = 1 << 20  # bytes hashed at once; longer texts are cut into overlapping segments
_PLACE = 22  # low bits of a key that hold the place in a segment

_BASE = 0x9E3779B97F4A7C15
ITEMS = "key long, whole long, doc_id long, span long"
# span = ((first start * 256) + number of starts) * 2 + 1 if settled as removed


def _mix(x):
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


_TABLES: dict = {}


def _tables():
    """Random values of the bytes, and powers of the base and of its inverse mod 2**64."""
    if not _TABLES:
        rng = np.random.default_rng(20)
        n = SEGMENT + 1024
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            steps = np.full(n, base, np.uint64)
            steps[0] = 1
            _TABLES[name] = np.multiply.accumulate(steps)
        _TABLES["bytes"] = rng.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return _TABLES


def _runs(data: np.ndarray, wanted: np.ndarray, text_of: np.ndarray, length: int, threshold: int):
    """Runs of wanted window starts that share their smallest name of the given length.

    wanted: sorted starts in data; text_of: the text each belongs to. Returns name,
    name of the whole stretch, index into wanted of the first start, number of starts.
    """
    t = _tables()
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(t["bytes"][data] * t["up"][: len(data)], out=sums[1:])
    names = _mix((sums[length:] - sums[:-length]) * t["down"][: len(data) - length + 1])
    width = threshold - length + 1
    if width == 1:
        place = wanted
    else:
        low = (names & ~np.uint64((1 << _PLACE) - 1)) | np.arange(len(names), dtype=np.uint64)
        step = 1
        while step * 2 <= width:
            low = np.minimum(low[:-step], low[step:])
            step *= 2
        if step < width:
            low = np.minimum(low[: len(low) - (width - step)], low[width - step :])
        place = (low[wanted] & np.uint64((1 << _PLACE) - 1)).astype(np.int64)
    new = np.ones(len(wanted), bool)
    new[1:] = (place[1:] != place[:-1]) | (text_of[1:] != text_of[:-1]) | (wanted[1:] != wanted[:-1] + 1)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(wanted)) - 1
    lo, hi = wanted[first], wanted[last]
    shape = ((hi - lo) * 256 + place[first] - lo).astype(np.uint64)
    whole = _mix((sums[hi + threshold] - sums[lo]) * t["down"][lo]) ^ _mix(shape + np.uint64(_BASE & 0xFFFFFFFF))
    return names[place[first]], whole, first, last - first + 1


def _segments(offsets: np.ndarray, threshold: int):
    """(first text, end text, byte range): several short texts, or a piece of a long one."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + SEGMENT, side="right")) - 1
        if j > i:
            yield i, j, int(offsets[i]), int(offsets[j])
            i = j
        else:
            for lo in range(int(offsets[i]), int(offsets[i + 1]), SEGMENT - threshold):
                yield i, i + 1, lo, min(lo + SEGMENT - 1, int(offsets[i + 1]))
            i += 1


def _rows(key, whole, doc, lo, count, settled=None):
    span = ((lo * 256 + count) << 1) + (0 if settled is None else settled)
    return pa.record_batch(
        [
            pa.array(key.view(np.int64)), pa.array(whole.view(np.int64)),
            pa.array(doc.astype(np.int64)), pa.array(span.astype(np.int64)),
        ],
        ["key", "whole", "doc_id", "span"],
    )


def _combined(key, whole, doc, lo, count):
    """Settle what repeats inside this batch already, so that no copy of it is shuffled by its name."""
    order = np.lexsort((lo, doc, whole, key))
    key, whole, doc, lo, count = (x[order] for x in (key, whole, doc, lo, count))
    same = np.zeros(len(key), bool)
    same[1:] = (key[1:] == key[:-1]) & (whole[1:] == whole[:-1])
    head = np.maximum.accumulate(np.where(same, 0, np.arange(len(key))))
    settled = same & ((doc != doc[head]) | (lo != lo[head]))
    spread = _mix(doc.astype(np.uint64) * np.uint64(_BASE) + lo.astype(np.uint64))
    return _rows(np.where(settled, spread, key), np.where(settled, spread, whole), doc, lo, count, settled)


def _cut(length: int, threshold: int):
    """Items of one round. Texts may come with the spans that the round before left open."""

    def run(batches):
        for batch in batches:
            ids, spans = batch.column("doc_id"), None
            if "spans" in batch.schema.names:
                batch = batch.filter(pc.is_valid(batch.column("spans")))
                ids, spans = batch.column("doc_id"), batch.column("spans")
            known = ids.is_valid().to_numpy(zero_copy_only=False)
            ids = longs(ids.fill_null(0))
            data, offsets = utf8(batch.column("text"))
            if spans is not None:
                owner = np.repeat(np.arange(len(ids)), spans.value_lengths().to_numpy(zero_copy_only=False))
                values = longs(spans.flatten())
                done = (values & 1) == 1
                if done.any():
                    doc, lo = ids[owner[done]], values[done] >> 9
                    spread = _mix(doc.astype(np.uint64) * np.uint64(_BASE) + lo.astype(np.uint64))
                    yield _rows(spread, spread, doc, lo, (values[done] >> 1) & 255, 1)
                owner, values = owner[~done], values[~done]
                order = np.lexsort((values, owner))
                owner, values = owner[order], values[order]
                count = (values >> 1) & 255
                at = np.repeat(offsets[owner] + (values >> 9), count) + _ramp(count)
                owner = np.repeat(owner, count)
                at = np.unique(at[at + threshold <= offsets[owner + 1]])
                owner = np.searchsorted(offsets, at, side="right") - 1
            for i, j, lo, hi in _segments(offsets, threshold):
                if spans is None:
                    starts = np.maximum(offsets[i:j], lo)
                    size = np.maximum(np.minimum(offsets[i + 1 : j + 1], hi) - starts - threshold + 1, 0) * known[i:j]
                    text_of = np.repeat(np.arange(i, j), size)
                    wanted = np.repeat(starts - lo, size) + _ramp(size)
                else:
                    a, b = np.searchsorted(at, [lo, hi - threshold + 1])
                    wanted, text_of = at[a:b] - lo, owner[a:b]
                if len(wanted):
                    key, whole, first, count = _runs(data[lo:hi], wanted, text_of, length, threshold)
                    text = text_of[first]
                    yield _combined(key, whole, ids[text], wanted[first] + lo - offsets[text], count)

    return run


def _ramp(count: np.ndarray) -> np.ndarray:
    """0, 1, .. count - 1 for each count."""
    total = int(count.sum())
    return np.arange(total) - np.repeat(np.cumsum(count) - count, count)


def _rank(items: DataFrame) -> DataFrame:
    """Settle unique positions and copies; the rest, and what is removed, as (doc_id, span)."""
    in_class = Window.partitionBy("key", "whole").orderBy("doc_id", "span")
    in_key = Window.partitionBy("key")
    return (
        items.repartition("key")
        .select("*", F.rank().over(in_class).alias("nth"))
        .select("*", (F.min("whole").over(in_key) != F.max("whole").over(in_key)).alias("open"))
        .select("doc_id", "open", F.when(F.col("nth") > 1, F.col("span").bitwiseOR(F.lit(1))).otherwise(F.col("span")).alias("span"))
        .filter("open or span % 2 = 1")
        .select("doc_id", "span")
    )


def _with_spans(texts: DataFrame, marks: DataFrame) -> DataFrame:
    # a left join each time, so that all rounds share one exchange of the texts
    return texts.join(marks.groupBy("doc_id").agg(F.collect_list("span").alias("spans")), "doc_id", "left")


def _remove(threshold: int, keep_text: bool):
    def run(batches):
        for batch in batches:
            data, offsets = utf8(batch.column("text"))
            own = batch.column("own_id" if "own_id" in batch.schema.names else "doc_id")
            rows = []
            for i, marks in enumerate(batch.column("spans")):
                text = data[offsets[i] : offsets[i + 1]]
                runs = _merged(marks.values.to_numpy(), len(text), threshold) if marks.is_valid else []
                parts, at = [], 0
                for lo, hi in runs:
                    parts.append(text[at:lo].tobytes())
                    at = hi
                parts.append(text[at:].tobytes())
                rest = b"".join(parts)
                digest = hashlib.sha256(rest).hexdigest()
                kept = rest.decode("utf-8", "ignore") if keep_text else None
                rows.append((len(text), len(text) - len(rest), len(runs), digest, kept))
            n_bytes, n_removed, n_spans, digests, kept = zip(*rows, strict=True) if rows else [()] * 5
            out = pa.record_batch(
                [
                    own, pa.array(n_bytes, pa.int64()), pa.array(n_removed, pa.int64()),
                    pa.array(n_spans, pa.int64()), pa.array(digests, pa.string()), pa.array(kept, pa.string()),
                ],
                ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept_text"],
            )
            if "rest" in batch.schema.names:
                out = out.append_column("rest", batch.column("rest"))
            yield out

    return run


def _merged(values: np.ndarray, size: int, threshold: int) -> list[tuple[int, int]]:
    """Maximal removed byte runs of one text; what lies beyond its end is left out."""
    lo = values >> 9
    hi = np.minimum(lo + ((values >> 1) & 255) + threshold - 1, size)
    order = np.argsort(lo)
    lo, hi = lo[order], np.maximum.accumulate(hi[order])
    keep = lo < size
    lo, hi = lo[keep], hi[keep]
    if not len(lo):
        return []
    new = np.ones(len(lo), bool)
    new[1:] = lo[1:] > hi[:-1]
    first = np.flatnonzero(new)
    return list(zip(lo[first].tolist(), hi[np.append(first[1:], len(lo)) - 1].tolist(), strict=True))


def _told_apart(texts: DataFrame) -> DataFrame:
    """texts, with ids of their own where one id has different texts: own_id, doc_id in the order of id and text.

    Most inputs have none, and cost one pass that hashes the texts.
    """
    rows = texts.withColumn("digest", F.xxhash64("text"))
    mixed = (
        rows.filter("doc_id is not null").groupBy("doc_id")
        .agg(F.min("digest").alias("low"), F.max("digest").alias("high")).filter("low <> high")
    )
    if not mixed.take(1):
        return texts
    # ranges hold ids in order, and so do the numbers of their rows; written, as another run may cut other ranges
    pairs = rows.filter("doc_id is not null").select("doc_id", "digest").distinct()
    ranked = pairs.repartitionByRange("doc_id", "digest").sortWithinPartitions("doc_id", "digest")
    ranks = stored(ranked.withColumn("rank", F.monotonically_increasing_id()), "ranks")
    others = [c for c in texts.columns if c != "doc_id"]
    return rows.join(ranks, ["doc_id", "digest"], "left").select(F.col("rank").alias("doc_id"), F.col("doc_id").alias("own_id"), *others)


def remove_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: int = THRESHOLD,
    keep_text: bool = True, carry: bool = False,
) -> DataFrame:
    """Remove each byte covered by a ``threshold``-byte string that also starts earlier.

    Earlier: in a smaller doc_id, or in the same text before. Strings never cross
    texts and are judged on the input. Returns doc_id, n_bytes, n_removed, n_spans
    (maximal removed runs), kept_sha256 (of the kept bytes) and kept_text (the kept
    bytes as text; a character that is cut through is dropped; null if not asked for).

    Null text: empty. Empty or short text: kept whole. Null doc_id: kept whole, and
    the source of nothing. Rows repeated with the same doc_id and text are one text,
    each returned; different texts with the same doc_id are different ones, in the order
    of a hash. No rows: no rows. Other columns are ignored, or with carry returned
    in a struct named rest. Runs a job.
    """
    if threshold % 4 or threshold > 255:
        raise ValueError("threshold must be a multiple of 4 below 256")
    texts = _told_apart(documents(docs, id_col, text_col, carry))
    first = stored(_rank(texts.select("doc_id", "text").mapInArrow(_cut(threshold // 4, threshold), ITEMS)), "repeats")
    marks = first.filter("span % 2 = 0")
    for length in (threshold // 2, threshold):
        marks = _rank(_with_spans(texts, marks).mapInArrow(_cut(length, threshold), ITEMS))
    removed = first.unionAll(marks).filter("span % 2 = 1")
    return _with_spans(texts, removed).mapInArrow(
        _remove(threshold, keep_text),
        with_rest("doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept_text string", texts),
    )
