"""Spelling variants: words one edit apart, each led to its most frequent form.

Words one edit apart are found by asymmetric q-chunks. The longer word of a pair (or
either of two equally long ones) contributes two disjoint chunks, its halves; the
shorter contributes positional grams of the same lengths. One inserted, deleted or
replaced character leaves one of the two chunks whole, and moves it by one place at
most: a chunk in front of the edit stays where it is, one behind it moves by the
difference of the lengths. Only grams at such a place can show an edit, so only those
are sent, and the join is on (length, gram, place). Pairs that meet are verified.

A chunk that many words share would make many pairs. Such buckets are not joined: the
edit lies in what the chunk leaves of the word, so the words of the bucket are chunked
there once more, until buckets are small or one character is left, where a bucket holds
no more words than there are letters. Nothing is dropped, and no task meets the square
of a large bucket.
"""

import collections
import re
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import documents, stored

# The letters of a word, after A-Z are lower-cased.
LETTERS = "a-zÀ-ÿ"
SLICE = 1 << 20  # characters searched at once
KEPT = 200_000  # words counted before a worker hands them on
PAIRS = 1024  # of a bucket that is joined as it is


def word_counts(docs: DataFrame, damage: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """word and n, over all runs of letters of all texts, A-Z lower-cased.

    With ``damage``, a run loses one character wherever it divides the unsigned CRC-32
    h of '<doc_id>:<run>': the one at h % length. This plants misspellings at a fixed
    rate. Null text: no words; a null doc_id counts as an empty one. Counts are combined
    in the worker and before the shuffle, so a frequent word is few rows.
    """
    find = re.compile(f"[{LETTERS}]+")
    stop = re.compile(f"[^{LETTERS}]")

    def runs(text):
        lo = 0
        while lo < len(text):
            end = stop.search(text, lo + SLICE) if lo + SLICE < len(text) else None
            hi = end.start() if end else len(text)
            yield find.findall(text, lo, hi)
            lo = hi

    def run(batches):
        total = collections.Counter()

        def emptied():
            out = pa.record_batch([pa.array(total.keys(), pa.string()), pa.array(total.values(), pa.int64())], ["word", "n"])
            total.clear()
            return out

        for batch in batches:
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                lowered = text.as_buffer().to_pybytes().lower().decode("utf-8", "replace")
                if not damage:
                    for found in runs(lowered):
                        total.update(found)
                else:
                    start = zlib.crc32(b"%s:" % (b"" if doc is None else str(doc).encode()))
                    for found in runs(lowered):
                        for word, n in collections.Counter(found).items():
                            h = zlib.crc32(word.encode(), start)
                            if h % damage == 0:
                                at = h % len(word)
                                word = word[:at] + word[at + 1 :]
                            total[word] += n
                if len(total) >= KEPT:
                    yield emptied()
        if total:
            yield emptied()

    parts = documents(docs, id_col, text_col).mapInArrow(run, "word string, n long")
    return parts.groupBy("word").agg(F.sum("n").alias("n"))


def _chunks(members: DataFrame) -> DataFrame:
    """Both halves of what is left of each chunked word; the edit lies in the other one."""
    half = F.floor(F.col("size") / 2).cast("int")
    return members.select(
        "word", "n", "d",
        F.explode(
            F.array(
                F.struct(F.lit(0).alias("side"), F.col("lo").alias("at"), half.alias("q"), (F.col("lo") + half).alias("lo"), (F.col("size") - half).alias("size")),
                F.struct(F.lit(1).alias("side"), (F.col("lo") + half).alias("at"), (F.col("size") - half).alias("q"), F.col("lo").alias("lo"), half.alias("size")),
            )
        ).alias("c"),
        "path",
    )


def _grams(members: DataFrame) -> DataFrame:
    """The grams of the same lengths in the other word, whose rest is shorter by d."""
    size = F.col("size") + F.col("d")  # of the chunked word's rest
    half = F.floor(size / 2).cast("int")
    return members.select(
        "word", "n", "d",
        F.explode(
            F.array(
                F.struct(F.lit(0).alias("side"), F.col("lo").alias("at"), half.alias("q"), (F.col("lo") + half).alias("lo"), (F.col("size") - half).alias("size")),
                F.struct(F.lit(1).alias("side"), (F.col("lo") + half - F.col("d")).alias("at"), (size - half).alias("q"), F.col("lo").alias("lo"), (half - F.col("d")).alias("size")),
            )
        ).alias("c"),
        "path",
    )


def _keyed(sent: DataFrame) -> DataFrame:
    """word, n, what is left of it, and the bucket: earlier chunks, side and the chunk itself."""
    text = F.substring("word", F.col("c.at") + 1, F.col("c.q"))
    return sent.select(
        "word", "n", "d", "c.lo", "c.size", F.xxhash64("path", "c.side", text).alias("path")
    )


def near_pairs(words: DataFrame, pairs: int = PAIRS) -> DataFrame:
    """All pairs of words one edit apart, once each: a, a_n, b, b_n (b is longer, or as long and larger).

    words: word (distinct, at least two characters) and n. Runs jobs: one for each depth at which a bucket is split,
    at most the logarithm of the longest word's length.
    """
    length = F.length("word")
    chunked = words.select("word", "n", F.explode(F.array(F.lit(0), F.lit(1))).alias("d"), F.lit(0).alias("lo"), length.alias("size"))
    chunked = chunked.withColumn("path", F.xxhash64("size", "d"))
    # the other word is shorter by d
    asked = words.select("word", "n", F.explode(F.array(F.lit(0), F.lit(1))).alias("d"), F.lit(0).alias("lo"), length.alias("size"))
    asked = asked.withColumn("path", F.xxhash64(F.col("size") + F.col("d"), "d"))
    found = []
    while True:
        chunked, asked = _keyed(_chunks(chunked)), _keyed(_grams(asked))
        counts = (
            chunked.groupBy("path").agg(F.count("*").alias("c"), F.max("size").alias("size"))
            .join(asked.groupBy("path").agg(F.count("*").alias("g")), "path")
        )
        large = stored(counts.filter((F.col("c") * F.col("g") > pairs) & (F.col("size") > 1)).select("path"), "large")
        small_c, small_g = chunked.join(large, "path", "left_anti"), asked.join(large, "path", "left_anti")
        b = small_c.select("path", F.col("word").alias("b"), F.col("n").alias("b_n"), "d")
        a = small_g.select("path", F.col("word").alias("a"), F.col("n").alias("a_n"))
        near = ((F.col("d") == 1) | (F.col("a") < F.col("b"))) & (F.levenshtein("a", "b", 1) == 1)
        found.append(stored(b.join(a, "path").filter(near).select("a", "a_n", "b", "b_n"), "near"))
        if not large.take(1):
            break
        chunked, asked = (stored(x.join(large, "path", "left_semi"), "rest") for x in (chunked, asked))
    out = found[0]
    for more in found[1:]:
        out = out.unionAll(more)
    return out.distinct()


def forms(words: DataFrame, ratio: int = 2, pairs: int = PAIRS) -> DataFrame:
    """word, n, form, form_n, n_near, root for every row of words (word, n).

    Two words are near if one inserted, deleted or replaced character turns one into the
    other. The form is the near word of largest n, the smallest one of several, if its n
    is ``ratio`` times the word's n or more; else null. The root is where the forms lead:
    the word itself without a form. n grows along a chain, so it ends; chains are
    shortened by half in each round. Runs jobs.
    """
    linked = near_pairs(words, pairs)
    ends = F.array(
        F.struct(F.col("a").alias("word"), F.col("a_n").alias("n"), F.col("b").alias("near"), F.col("b_n").alias("near_n")),
        F.struct(F.col("b").alias("word"), F.col("b_n").alias("n"), F.col("a").alias("near"), F.col("a_n").alias("near_n")),
    )
    best = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("form")))
    chosen = (
        linked.select(F.explode(ends).alias("e")).select("e.*")
        .groupBy("word").agg(F.count("*").alias("n_near"), F.max("n").alias("n"), best.alias("best"))
    )
    enough = -F.col("best.less") >= F.col("n") * ratio
    named = stored(
        chosen.select(
            "word", "n_near", F.when(enough, F.col("best.form")).alias("form"), F.when(enough, -F.col("best.less")).alias("form_n")
        ),
        "forms",
    )
    roots = stored(named.filter("form is not null").select("word", F.col("form").alias("root")), "roots")
    while True:
        further = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = stored(
            roots.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("on")),
            "roots",
        )
        roots = moved.select("word", "root")
        if not moved.filter("on").take(1):
            break
    return (
        words.join(named, "word", "left").join(roots, "word", "left")
        .select("word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form_n")
    )


def spelling_variants(
    docs: DataFrame, least_length: int = 5, least_count: int = 3, ratio: int = 2, damage: int = 0,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """The forms of all words with ``least_length`` characters and ``least_count`` occurrences in all texts.

    Null, empty texts and texts without letters have no words; repeated rows count each;
    no rows: no rows; other columns are ignored. See ``word_counts`` and ``forms``.
    """
    if least_length < 2:
        raise ValueError("words of one character are all near each other")
    counts = word_counts(docs, damage, id_col, text_col)
    words = stored(counts.filter((F.length("word") >= least_length) & (F.col("n") >= least_count)), "words")
    return forms(words, ratio)
