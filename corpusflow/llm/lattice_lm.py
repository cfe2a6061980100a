"""Language-model scores: the marginal probability of a text over all its segmentations.

Units are the pieces of an existing vocabulary, one unit for a character that no
piece covers, and every training word as a whole. The pieces weigh what the
vocabulary's scores say: its scores are ranks, read by Zipf's law (first_units),
fixed and never fitted. A word's lattice probability sums over all its segmentations
in log space: those into pieces, by forward recursion, and the one edge that spans
it, with its count less DISCOUNT; what is discounted is the weight of the pieces.

A token's probability mixes the lattice with the add-one base (which gives every
unknown word one and the same share). The weight of the base is the one of WEIGHTS
under which the training words, each occurrence left out in turn, are likeliest. A
text's probability is the product of its tokens'.

Corpus counts cover all words, and each distinct word meets the lattice once: the
most frequent ones, a bounded table, go to the workers; each text's other words
meet their probabilities in a shuffled join.
"""

import math

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import documents, stored, utf8

FREQUENT = 200_000  # words whose counts are sent to the workers
DISCOUNT = 0.5  # of each word's count, for the pieces
WEIGHTS = (0.05, 0.1, 0.2, 0.3, 0.5, 0.7, 0.8, 0.9, 0.95)  # of the base, to choose from
MARK = "▁"
BATCH_BYTES = 2 << 20
_BASE = np.uint64(0x9E3779B97F4A7C15)


def _hash_letters(codes: np.ndarray) -> np.ndarray:
    x = codes.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93) + np.uint64(0x2545F4914F6CDD1D)
    return (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)


def _by_length(words: list[str]):
    """(indexes, letters as a matrix) of the words of each length."""
    sizes = np.array([len(w) for w in words])
    order = np.argsort(sizes, kind="stable")
    cuts = np.flatnonzero(np.diff(sizes[order])) + 1
    for rows in np.split(order, cuts):
        for at in range(0, len(rows), 20_000):
            part = rows[at : at + 20_000]
            text = "".join([words[k] for k in part]).encode("utf-32-le")
            yield part, np.frombuffer(text, np.uint32).reshape(len(part), -1)


class Units:
    """Strings with log probabilities, found in words by a rolling hash."""

    def __init__(self, strings: list[str], logs: np.ndarray, unknown: float):
        self.strings, self.logs, self.unknown = strings, np.asarray(logs), unknown
        keys = np.zeros(len(strings), np.uint64)
        for rows, letters in _by_length(strings):
            keys[rows] = self._sums(letters)[:, -1]
        self._fill(keys)
        self.longest = max(map(len, strings), default=1)

    def _fill(self, keys: np.ndarray):
        """An open-addressing table, sparse enough that a key is at most a few places off."""
        bits = max(8, int(len(keys) * 8).bit_length())
        self.shift, size = np.uint64(64 - bits), 1 << bits
        self.keys, self.unit = np.zeros(size + 64, np.uint64), np.full(size + 64, -1, np.int32)
        self.reach = 0
        for unit, (key, slot) in enumerate(zip(keys.tolist(), (keys >> self.shift).tolist(), strict=True)):
            at = slot
            while self.unit[at] >= 0:
                at += 1
            self.keys[at], self.unit[at] = key, unit
            self.reach = max(self.reach, at - slot)

    def _find(self, key: np.ndarray) -> np.ndarray:
        """The unit of each key, -1 where there is none."""
        slot = (key >> self.shift).astype(np.int64)
        found = np.where(self.keys[slot] == key, self.unit[slot], -1)
        for step in range(1, self.reach + 1):
            found = np.where(self.keys[slot + step] == key, self.unit[slot + step], found)
        return found

    @staticmethod
    def _sums(letters: np.ndarray) -> np.ndarray:
        value = _hash_letters(letters)
        sums = np.zeros((len(letters), letters.shape[1] + 1), np.uint64)
        for j in range(letters.shape[1]):
            sums[:, j + 1] = sums[:, j] * _BASE + value[:, j]
        return sums

    def _edges(self, letters: np.ndarray):
        """(start, end, unit or -1, log weight) for all substrings of words of one length."""
        sums, n = self._sums(letters), letters.shape[1]
        power = np.ones(self.longest + 1, np.uint64)
        power[1:] = _BASE
        power = np.multiply.accumulate(power)
        code = letters.astype(np.int64)
        n_bytes = 1 + (code >= 0x80) + (code >= 0x800) + (code >= 0x10000)
        for j in range(1, n + 1):
            for i in range(max(0, j - self.longest), j):
                key = sums[:, j] - sums[:, i] * power[j - i]
                unit = self._find(key)
                found = unit >= 0
                weight = np.where(found, self.logs[unit], -np.inf)
                if j - i == 1:
                    weight = np.where(found, weight, self.unknown - n_bytes[:, i] * math.log(256))
                if found.any() or j - i == 1:
                    yield i, j, unit, weight

    def log_words(self, words: list[str]) -> np.ndarray:
        """Natural log of each word's marginal probability, by forward recursion."""
        out = np.zeros(len(words))
        marked = [MARK + w for w in words]
        for rows, letters in _by_length(marked):
            forward = np.full((len(rows), letters.shape[1] + 1), -np.inf)
            forward[:, 0] = 0
            for i, j, _, weight in self._edges(letters):
                forward[:, j] = np.logaddexp(forward[:, j], forward[:, i] + weight)
            out[rows] = forward[:, -1]
        return out


def first_units(pieces: list[str]) -> Units:
    """Weights by the rank of the pieces in their vocabulary."""
    zipf = 1 / (np.arange(len(pieces)) + 10.0)
    return Units(pieces, np.log(0.99 * zipf / zipf.sum()), math.log(0.01))


def vocabulary_pieces(path: str) -> list[str]:
    """Ordinary pieces of a sentencepiece vocabulary, the best score first."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    found = [
        (-model.get_score(i), i, model.id_to_piece(i))
        for i in range(model.get_piece_size())
        if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))
    ]
    return [p for _, _, p in sorted(found)]


def _batches_of_words(batches):
    """(batch, first row, words of each text): A-Z lowered, cut at ASCII white space."""
    for batch in batches:
        data, offsets = utf8(batch.column("text"))
        lo, n = 0, batch.num_rows
        while lo < n:
            hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + BATCH_BYTES, side="right")) - 1)
            yield batch, lo, [data[a:b].tobytes().lower().split() for a, b in zip(offsets[lo:hi], offsets[lo + 1 : hi + 1])]
            lo = hi


def count_words(texts: DataFrame) -> DataFrame:
    """word (binary) and its count c over whole texts; counts are added up before the shuffle."""

    def run(batches):
        for _, _, words in _batches_of_words(batches):
            counts: dict[bytes, int] = {}
            for ws in words:
                for w in ws:
                    counts[w] = counts.get(w, 0) + 1
            keys = list(counts)
            for at in range(0, len(keys), 50_000):
                part = keys[at : at + 50_000]
                yield pa.record_batch(
                    [pa.array(part, pa.binary()), pa.array([counts[k] for k in part], pa.int64())], ["word", "c"]
                )

    return texts.mapInArrow(run, "word binary, c long").groupBy("word").agg(F.sum("c").alias("c"))


def _frequent(counts: DataFrame) -> DataFrame:
    """The words above the lowest count level, an eighth of an octave, that lets FREQUENT of them in at most."""
    level = F.floor(F.log2("c") * 8)
    sizes = {r.level: r.n for r in counts.groupBy(level.alias("level")).agg(F.count("*").alias("n")).collect()}
    kept, lowest = 0, 1 << 60
    for at in sorted(sizes, reverse=True):
        kept += sizes[at]
        if kept > FREQUENT:
            break
        lowest = at
    return counts.filter(level >= lowest)


def with_pieces(words: DataFrame, vocabulary: str) -> DataFrame:
    """Add pieces, the log10 of each word's marginal probability over its segmentations into pieces."""
    shared = words.sparkSession.sparkContext.broadcast(first_units(vocabulary_pieces(vocabulary)))

    def run(batches):
        for batch in batches:
            found = shared.value.log_words([w.decode() for w in batch.column("word").to_pylist()])
            yield pa.record_batch([*batch.columns, pa.array(found / math.log(10))], [*batch.schema.names, "pieces"])

    return words.mapInArrow(run, "word binary, c long, pieces double")


class Mixture:
    """The token probabilities of a model, as columns of a word's count c and its pieces."""

    def __init__(self, words: int, tokens: int, ends: int):
        self.n, self.v, self.words, self.ends = tokens + ends, words + (ends > 0), words, ends
        self.weight = 0.0

    def base(self, c) -> Column:
        return F.log10((c + 1) / F.lit(float(self.n + self.v + 1)))

    def lattice(self, c, out: int = 0) -> Column:
        """Log10 of whole edge and pieces together; with ``out`` occurrences of the word left out."""
        if not self.n:
            return F.col("pieces") + math.log10(0.5)
        whole = F.greatest(c - F.lit(DISCOUNT), F.lit(0.0)) / F.lit(float(max(1, self.n - out)))
        return _log_sum(F.col("pieces") + F.lit(math.log10(max(DISCOUNT, DISCOUNT * self.words) / self.n)), F.log10(whole))

    def mixed(self, base: Column, lattice: Column, weight: float) -> Column:
        if not weight:
            return lattice
        return _log_sum(base + math.log10(weight), lattice + math.log10(1 - weight))

    def fit(self, counts: DataFrame) -> None:
        """Choose the weight of the base by leaving out one occurrence of each training word in turn."""
        c = F.col("c") - 1
        parts = counts.select("c", self.base(c).alias("base"), self.lattice(c, 1).alias("lattice"))
        sums = [F.sum(F.col("c") * self.mixed(F.col("base"), F.col("lattice"), w)) for w in WEIGHTS]
        found = parts.agg(*sums).first()
        self.weight = max(zip(found, WEIGHTS, strict=True))[1] if found[0] is not None else 0.0

    def columns(self, c: Column) -> list[Column]:
        return [self.base(c).alias("base"), self.mixed(self.base(c), self.lattice(c), self.weight).alias("value")]

    def end(self) -> tuple[float, float]:
        """Log10 of the end's base and mixed probability."""
        base = (self.ends + 1) / (self.n + self.v + 1)
        share = self.ends / self.n if self.n else 0.5
        return math.log10(base), math.log10(self.weight * base + (1 - self.weight) * share)


def _log_sum(a: Column, b: Column) -> Column:
    """Log10 of the sum of two probabilities; the larger is taken out, so that neither vanishes. b may be null."""
    low, high = F.least(a, b), F.greatest(a, b)
    return F.when(b.isNull(), a).otherwise(high + F.log10(1 + F.pow(F.lit(10.0), low - high)))


def score_texts(docs: DataFrame, training: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Score whole texts by a model learnt from the training texts.

    Tokens are words and one end for each text. Returns doc_id, n_tokens, n_known
    (tokens that occur in training), train_tokens, base_score (add-one unigram) and
    score (the model), both log10 probabilities of the text.

    Null or empty text: the end alone. No training rows: all counts are zero, the
    score is that of the pieces alone. Rows are kept one for one, repeated or with a
    null doc_id too. No rows: no rows. Other columns are ignored. Runs jobs.
    """
    spark = docs.sparkSession
    learnt = documents(training, id_col, text_col)
    counts = stored(with_pieces(count_words(learnt), vocabulary), "words")
    words, tokens = counts.agg(F.count("*"), F.coalesce(F.sum("c"), F.lit(0))).first()
    model = Mixture(words, tokens, learnt.count())
    if tokens:
        model.fit(counts)
    top = _frequent(counts).select("word", *model.columns(F.col("c"))).toArrow()
    frequent = dict(zip(top.column("word").to_pylist(), zip(*(top.column(k).to_pylist() for k in ("base", "value")), strict=True), strict=True))
    shared = spark.sparkContext.broadcast(frequent)
    end_known, (end_base, end_value) = int(model.ends > 0), model.end()

    def run(batches):
        table = shared.value
        row = TaskContext.get().partitionId() << 33
        for batch, lo, texts in _batches_of_words(batches):
            ids = batch.column("doc_id").slice(lo, len(texts)).to_pylist()
            out, rare = [], []
            for doc, ws in zip(ids, texts, strict=True):
                seen = [x for w in ws if (x := table.get(w))]
                if len(seen) < len(ws):
                    tail: dict[bytes, int] = {}
                    for w in ws:
                        if w not in table:
                            tail[w] = tail.get(w, 0) + 1
                    rare += [(row, w, k) for w, k in tail.items()]
                base, value = (math.fsum([x[k] for x in seen]) for k in (0, 1))
                out.append((row, doc, len(ws) + 1, len(seen) + end_known, base + end_base, value + end_value))
                row += 1
            yield _rows(out, rare)

    schema = "row long, word binary, times long, doc_id long, n_tokens long, n_known long, base_score double, score double"
    scored = stored(documents(docs, id_col, text_col).mapInArrow(run, schema), "scores")
    rare = scored.filter("word is not null").select("row", "word", "times")
    unknown = rare.select("word").distinct().join(counts, "word", "left_anti").select("word", F.lit(0).cast("long").alias("c"))
    known = counts.unionAll(with_pieces(unknown, vocabulary)).select("word", "c", *model.columns(F.col("c")))
    tail = (
        rare.join(known, "word")
        .groupBy("row")
        .agg(
            F.sum(F.col("times") * F.col("base")).alias("rare_base"),
            F.sum(F.when(F.col("c") > 0, F.col("times")).otherwise(0)).alias("rare_known"),
            F.sum(F.col("times") * F.col("value")).alias("rare_score"),
        )
    )
    return (
        scored.filter("word is null")
        .join(tail, "row", "left")
        .select(
            "doc_id", "n_tokens", (F.col("n_known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
            F.lit(model.n).cast("long").alias("train_tokens"),
            (F.col("base_score") + F.coalesce("rare_base", F.lit(0.0))).alias("base_score"),
            (F.col("score") + F.coalesce("rare_score", F.lit(0.0))).alias("score"),
        )
    )


def _rows(texts: list[tuple], rare: list[tuple]) -> pa.RecordBatch:
    row, doc, tokens, known, base, score = zip(*texts, strict=True) if texts else [()] * 6
    of, word, times = zip(*rare, strict=True) if rare else [()] * 3
    a, b = len(row), len(of)
    return pa.record_batch(
        [
            pa.array([*row, *of], pa.int64()), pa.array([*[None] * a, *word], pa.binary()),
            pa.array([*[None] * a, *times], pa.int64()), pa.array([*doc, *[None] * b], pa.int64()),
            pa.array([*tokens, *[None] * b], pa.int64()), pa.array([*known, *[None] * b], pa.int64()),
            pa.array([*base, *[None] * b], pa.float64()), pa.array([*score, *[None] * b], pa.float64()),
        ],
        ["row", "word", "times", "doc_id", "n_tokens", "n_known", "base_score", "score"],
    )
