"""Toxicity: a support vector machine on a subsequence string kernel with Nystroem landmarks.

The kernel of two words sums over all three-letter subsequences they share, each
weighted by DECAY for every letter left out in between (REACH letters from one to
the next at most), and is normalised; word starts and ends are letters too, other
characters are dropped. So inserted letters, gaps, spaced-out spelling and unseen
inflections of an insult stay close to it.

Training takes a bounded, deterministic sample of labelled texts. A toxic text is a
bag of words of which at least one, its witness, is toxic; no word of a clean text
is. Witnesses, landmarks, hard negatives and the machine are fitted in turn. The
kernel has finitely many features, so landmarks and weights fold into one table of
subsequence weights of fixed size, which is what the workers get. A text's score is
a logistic function of its most toxic word.
"""

import re
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Memory, documents

DECAY = 0.5
REACH = 3
LETTERS = 64
LANDMARKS = 256
# Bounds of the training sample
TOXIC_TEXTS, CLEAN_TEXTS, TEXT_CHARS = 3000, 3000, 8000
NEGATIVES, HARD, ROUNDS = 12_000, 3_000, 3
SPECTRUM, RIDGE = 0.02, 1.0  # least eigenvalue of the landmark kernel, weight of the norm
STEM, SUPPORT = 4, 4  # letters of a stem, toxic texts that must share it
SLOPE = 12.0
LEAST = 3  # letters of a scored word
FLOOR = 0.25  # similarities below count as none
KEPT = 120_000  # remembered words for each worker
BATCH_BYTES = 1 << 20
WORDS = 8192  # compared at once

_OTHER = re.compile(r"[\W\d_]+")
_SPELLED = re.compile(r"(?<!\S)[^\W\d_](?:\s[^\W\d_]){2,}(?!\S)")
_FIRST, _LAST = LETTERS - 2, LETTERS - 1


def words_of(text: str) -> list[str]:
    text = text.lower()
    words = text.split()
    if _SPELLED.search(text):
        words += ["".join(m.split()) for m in _SPELLED.findall(text)]
    return words


def _codes(words: list[str]):
    """Letters of all words in a row, and the word each belongs to."""
    plain = [_OTHER.sub("", w) for w in words]
    raw = np.frombuffer("".join(f"\x01{p}\x02" for p in plain).encode("utf-32-le"), np.uint32).astype(np.int64)
    code = np.where((raw >= 97) & (raw <= 122), raw - 96, 27 + raw % (LETTERS - 29))
    code[raw == 1], code[raw == 2] = _FIRST, _LAST
    return code, np.repeat(np.arange(len(words)), [len(p) + 2 for p in plain])


def _features(words: list[str]):
    """(word, feature, weight) for each subsequence occurrence, one array triple for each pair of gaps."""
    code, owner = _codes(words)
    for a in range(1, REACH + 1):
        for b in range(1, REACH + 1):
            n = len(code) - a - b
            if n <= 0:
                continue
            same = np.flatnonzero(owner[:n] == owner[a + b :])
            feature = (code[same] * LETTERS + code[same + a]) * LETTERS + code[same + a + b]
            yield owner[same], feature, DECAY ** (a + b - 2)


def _sparse(words: list[str]):
    """Summed features: (word, feature, value), and the norm of each word."""
    size = LETTERS**3
    parts = [(w * size + f, np.full(len(w), x)) for w, f, x in _features(words)]
    if not parts:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0), np.ones(len(words))
    key, back = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
    value = np.bincount(back, np.concatenate([p[1] for p in parts]), len(key))
    word = key // size
    norm = np.sqrt(np.bincount(word, value**2, len(words)))
    return word, key % size, value, np.where(norm > 0, norm, 1)


@dataclass
class Model:
    """Folded subsequence weights; a text scores 1 / (1 + exp(-slope (best word - cut)))."""

    weights: np.ndarray
    slope: float
    cut: float

    def similarities(self, words: list[str]) -> np.ndarray:
        parts = [self._similarities(words[at : at + WORDS]) for at in range(0, len(words), WORDS)]
        return np.concatenate([np.zeros(0), *parts])

    def _similarities(self, words: list[str]) -> np.ndarray:
        raw, least = np.zeros(len(words)), np.zeros(len(words))
        for word, feature, x in _features(words):
            raw += np.bincount(word, self.weights[feature] * x, len(words))
            least += np.bincount(word, minlength=len(words)) * x * x
        # the norm is at least sqrt(least); exact norms only where they can matter
        letters = np.array([len(_OTHER.sub("", w)) for w in words])
        maybe = np.flatnonzero((letters >= LEAST) & (raw > FLOOR * np.sqrt(np.maximum(least, 1e-12))))
        out = np.zeros(len(words))
        if len(maybe):
            norm = _sparse([words[k] for k in maybe])[3]
            value = raw[maybe] / norm
            out[maybe] = np.where(value >= FLOOR, value, 0)
        return out

    def score(self, best) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * (np.asarray(best, float) - self.cut), -30, 30)))


def _machine(positive: list[str], negative: list[str], rng) -> np.ndarray:
    """Squared-hinge machine in the space of Nystroem landmarks, folded into feature weights."""
    marks = positive[: LANDMARKS // 2] + negative[: LANDMARKS // 2]
    word, feature, value, norm = _sparse(marks)
    table = np.unique(feature)
    dense = np.zeros((len(marks), len(table)))
    dense[word, np.searchsorted(table, feature)] = value / norm[word]
    spectrum, basis = np.linalg.eigh(dense @ dense.T)
    keep = spectrum > SPECTRUM
    whiten = basis[:, keep] / np.sqrt(spectrum[keep])
    projected = dense.T @ whiten  # feature to Nystroem coordinate

    def mapped(words):
        word, feature, value, norm = _sparse(words)
        at = np.minimum(np.searchsorted(table, feature), len(table) - 1)
        known = table[at] == feature
        out = np.zeros((len(words), projected.shape[1]))
        for lo in range(0, len(words), 500):
            a, b = np.searchsorted(word, [lo, lo + 500])
            part = np.zeros((min(500, len(words) - lo), len(table)))
            k = np.flatnonzero(known[a:b]) + a
            part[word[k] - lo, at[k]] = value[k] / norm[word[k]]
            out[lo : lo + 500] = part @ projected
        return out

    x = np.concatenate([mapped(positive), mapped(negative)])
    y = np.concatenate([np.ones(len(positive)), np.zeros(len(negative))])  # clean words have no margin to gain below 0
    cost = np.where(y > 0, max(1.0, len(negative) / max(1, len(positive)) / 4), 1.0)
    w = np.zeros(x.shape[1])
    for _ in range(25):
        value = x @ w
        live = np.where(y > 0, value < 1, value > 0)
        a = x[live] * cost[live, None]
        new = np.linalg.solve(x[live].T @ a + RIDGE * np.eye(len(w)), a.T @ y[live])
        if np.allclose(new, w, atol=1e-6):
            break
        w = new
    weights = np.zeros(LETTERS**3)
    weights[table] = projected @ w
    return weights


def _stems(word: str) -> list[str]:
    plain = _OTHER.sub("", word)
    return [plain[:n] for n in range(STEM, len(plain))] + [plain + "$"] if len(plain) >= LEAST else []


def _witnesses(bags: list[set[str]], clean: list[set[str]]) -> list[str]:
    """Words that can make a text toxic, the best supported first.

    A word is supported by its stems: how many toxic texts hold a word with that stem,
    against clean texts. Each text nominates its best supported words.
    """
    for_, against = {}, {}
    for table, texts in ((for_, bags), (against, clean)):
        for words in texts:
            for stem in {x for w in words for x in _stems(w)}:
                table[stem] = table.get(stem, 0) + 1
    share = len(clean) / len(bags)
    support: dict[str, float] = {}
    for bag in bags:
        for w in bag:
            if w not in support:
                support[w] = max(
                    (n * np.log(n * share / (against.get(x, 0) + 1)) for x in _stems(w) if (n := for_[x]) >= SUPPORT),
                    default=0.0,
                )
    chosen: dict[str, int] = {}
    for bag in bags:
        top = max((support[w] for w in bag), default=0.0)
        for w in bag:
            if top > 0 and support[w] >= top / 2:
                chosen[w] = chosen.get(w, 0) + 1
    return sorted(chosen, key=lambda w: (-support[w], w))


def fit(toxic: list[set[str]], clean: list[set[str]], seed: int = 3) -> Model:
    """Fit on the word sets of labelled texts. Without both labels, all texts score as the label there is."""
    none = np.zeros(LETTERS**3)
    if not toxic or not clean:
        return Model(none, 1.0, -30.0 if toxic else 30.0)
    rng = np.random.default_rng(seed)
    clean_words = sorted(set().union(*clean))
    innocent = set(clean_words)
    # near copies of one toxic text count once: same smallest word among those of toxic texts only
    bags = list({min(odd, key=hash_of): s for s in toxic if (odd := s - innocent)}.values())
    positive = [w for w in _witnesses(bags, clean) if w not in innocent] if bags else []
    if not positive:
        return Model(none, 1.0, 30.0)
    easy = [clean_words[k] for k in rng.permutation(len(clean_words))[:NEGATIVES]]
    hard: list[str] = []
    for _ in range(ROUNDS):
        model = Model(_machine(positive, [*hard, *easy], rng), 1.0, 0.0)
        value = model.similarities(clean_words)
        worst = [clean_words[k] for k in np.argsort(-value, kind="stable")[:HARD] if value[k] > 0]
        hard = list(dict.fromkeys([*hard, *worst]))
    words = sorted(innocent.union(*toxic))
    known = dict(zip(words, model.similarities(words).tolist(), strict=True))
    best = np.array([max((known[w] for w in s), default=0.0) for s in toxic + clean])
    label = np.array([1] * len(toxic) + [0] * len(clean))
    order = np.argsort(best)
    wrong = np.concatenate([[0], np.cumsum(label[order] * 2.0 - 1)])  # toxic below the cut less clean below it
    steps = np.flatnonzero(np.concatenate([[True], np.diff(best[order]) > 0, [True]]))
    k = int(steps[np.argmin(wrong[steps])])
    low = best[order[k - 1]] if k else 0.0
    high = best[order[k]] if k < len(best) else 1.0
    return Model(model.weights, SLOPE, float((low + high) / 2))


def hash_of(word: str) -> int:
    return zlib.crc32(word.encode())


def train(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic"
) -> Model:
    """Fit on at most TOXIC_TEXTS and CLEAN_TEXTS labelled texts of up to TEXT_CHARS characters.

    Which ones is decided by a hash of the id, so the sample is the same each time.
    """
    known = labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("label")).filter(
        "doc_id is not null and label in (0, 1)"
    )
    texts = documents(docs, id_col, text_col)
    short = texts.filter(F.length("text") <= TEXT_CHARS).select("doc_id")
    order = F.xxhash64("doc_id", F.lit("sample"))
    usable = known.join(short, "doc_id").withColumn("at", order)
    picked = [
        usable.filter(f"label = {label}").orderBy("at", "doc_id").limit(n)
        for label, n in ((1, TOXIC_TEXTS), (0, CLEAN_TEXTS))
    ]
    sample = F.broadcast(picked[0].unionAll(picked[1]).select("doc_id", "label"))  # at most 6,000 rows
    toxic, clean = [], []
    for row in texts.join(sample, "doc_id").select("doc_id", "label", "text").orderBy("doc_id", "text").toLocalIterator():
        (toxic if row.label else clean).append({w for w in words_of(row.text) if len(w) >= LEAST})
    return fit(toxic, clean)


def _scored(shared):
    """Each batch in pieces of bounded text, with the scores and worst words of its texts."""
    memory = Memory(KEPT)

    def run(batches):
        tool = shared.value
        for batch in batches:
            texts, lo = batch.column("text"), 0
            while lo < batch.num_rows:
                hi, size = lo, 0
                while hi < batch.num_rows and size < BATCH_BYTES:
                    size += len(texts[hi].as_buffer() or b"")
                    hi += 1
                words = [words_of(t or "") for t in texts.slice(lo, hi - lo).to_pylist()]
                new = memory.missing({w for ws in words for w in ws})
                known = memory.now
                known.update(zip(new, tool.similarities(new).tolist(), strict=True))
                worst = [max(ws, key=known.__getitem__, default=None) for ws in words]
                best = [known[w] if w is not None else 0.0 for w in worst]
                words = [w if b > 0 else None for w, b in zip(worst, best, strict=True)]
                yield batch.slice(lo, hi - lo), tool.score(best), words
                lo = hi

    return run


def score_texts(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, score (0 to 1) and worst_word, over whole texts.

    Null and empty texts have no words and score as a text without any toxic word.
    Rows are kept one for one, repeated or with a null doc_id too. No rows: no rows.
    Other columns are ignored. One pass, no shuffle.
    """
    scored = _scored(docs.sparkSession.sparkContext.broadcast(model))

    def run(batches):
        for batch, scores, words in scored(batches):
            yield pa.record_batch(
                [batch.column("doc_id"), pa.array(scores), pa.array(words, pa.string())], ["doc_id", "score", "worst_word"]
            )

    return documents(docs, id_col, text_col).mapInArrow(run, "doc_id long, score double, worst_word string")


def drop_toxic(docs: DataFrame, model: Model, text_col: str = "text", limit: float = 0.5) -> DataFrame:
    """The rows of docs, all columns, whose text scores below ``limit``. One pass, no shuffle.

    Null and empty texts score as a text without any toxic word. Each row is judged by
    its own text, repeated rows and rows with a null or shared id too; no rows: no rows.
    """
    scored = _scored(docs.sparkSession.sparkContext.broadcast(model))
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("whole"), F.col(text_col).alias("text"))

    def run(batches):
        for batch, scores, _ in scored(batches):
            yield batch.select(["whole"]).filter(pa.array(scores < limit))

    return whole.mapInArrow(run, whole.select("whole").schema).select("whole.*")


def held_out(id_col: str = "doc_id", of: int = 5) -> F.Column:
    """Rows that are never learnt from: crc32 of the id as text is divisible."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % of == 0


def score_with_labels(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Learn from labelled rows that are not held out; doc_id, held_out, score, predicted. Runs jobs.

    Rows are scored one for one, as score_texts does; held_out is null for a null doc_id,
    which is not learnt from. Null labels and labels of unknown documents are not used.
    No rows: no rows. Other columns are ignored.
    """
    model = train(docs.filter(~held_out()), labels)
    out = score_texts(docs, model)
    return out.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
