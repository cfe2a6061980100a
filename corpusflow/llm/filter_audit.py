"""How filters interact: what each one removes in every order, and its Shapley share.

Every document becomes a bit mask of the filters that it fails. For each part of the
corpus the removals of all coalitions of filters are tabulated (32 for five filters):
v(S) documents fail some filter of S. Everything else is arithmetic on that table:

* a step of an order removes v(S + f) - v(S), where S are the filters before it;
* a filter's Shapley share is the least squares fit of v by a sum of one weight per
  filter, with the Shapley kernel as weight of a coalition, under the constraint that
  the weights add up to v(all). Its normal equations are the same for every part, so
  they are solved once, in rationals, for all 32 unit tables (``shares``); a part's
  shares are then whole numbers times its table.
"""

import itertools
import math
from fractions import Fraction

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# White space that parts words.
SPACE = r"[ \t-\r]+"
SALTS = 256  # parts of the rows without an id, which no label can meet


def text_filters(text: Column) -> dict[str, Column]:
    """Failure conditions of the filters A to D, which look at one text only."""
    words = F.array_remove(F.split(text, SPACE), "")
    capitals = F.length(text) - F.length(F.regexp_replace(text, "[A-Z]+", ""))
    return {
        "A": F.size(words) < 200,
        "B": F.size(F.array_distinct(words)) * 100 < F.size(words) * 50,
        "C": capitals.cast("long") * 100 > F.length(text).cast("long") * 2,
        "D": text.rlike(r"[#$%&*|]"),
    }


def solve(rows: list[list[Fraction]]) -> list[list[Fraction]]:
    """Gauss-Jordan elimination of the left square of an augmented matrix, exactly."""
    rows, n = [list(r) for r in rows], len(rows)
    for k in range(n):
        at = next(i for i in range(k, n) if rows[i][k])
        rows[k], rows[at] = rows[at], [x for x in rows[k]]
        rows[k] = [x / rows[k][k] for x in rows[k]]
        for i in range(n):
            if i != k and rows[i][k]:
                rows[i] = [x - rows[i][k] * y for x, y in zip(rows[i], rows[k], strict=True)]
    return [r[n:] for r in rows]


def shares(n: int) -> list[list[int]]:
    """Whole numbers w with n! * share of filter f = sum over coalitions S of w[f][S] * v(S).

    Minimises the sum over S (not empty, not all) of k(S) * (v(S) - sum of x_f, f in S)^2
    with k(S) = (n - 1) / (C(n, |S|) |S| (n - |S|)), under sum of x_f = v(all): the
    equations for x and one multiplier, with the 2^n unit tables as right-hand sides.
    """
    if n == 1:
        return [[-1, 1]]
    full, size = (1 << n) - 1, 1 << n
    inner = [s for s in range(1, full)]
    kernel = {s: Fraction(n - 1, math.comb(n, s.bit_count()) * s.bit_count() * (n - s.bit_count())) for s in inner}
    rows = []
    for f in range(n):
        left = [sum((kernel[s] for s in inner if s >> f & 1 and s >> g & 1), Fraction(0)) for g in range(n)]
        right = [kernel[s] if s in kernel and s >> f & 1 else Fraction(0) for s in range(size)]
        rows.append([*left, Fraction(1), *right])
    rows.append([*[Fraction(1)] * n, Fraction(0), *[Fraction(int(s == full)) for s in range(size)]])
    scaled = [[x * math.factorial(n) for x in r] for r in solve(rows)[:n]]
    assert all(x.denominator == 1 for r in scaled for x in r)
    return [[int(x) for x in r] for r in scaled]


def failing(docs: DataFrame, filters, id_col: str, text_col: str, part_col: str) -> DataFrame:
    """doc_id, part, digest of the text, mask of its text filters, and n equal rows."""
    bits = filters(F.col("text"))
    mask = sum((F.when(c, 1 << k).otherwise(0) for k, c in enumerate(bits.values())), F.lit(0))
    return (
        docs.select(
            F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"),
            F.coalesce(F.col(text_col), F.lit("")).alias("text"),
        )
        .select("doc_id", "part", F.unhex(F.sha2("text", 256)).alias("digest"), mask.alias("mask"))
        .groupBy("doc_id", "part", "digest", "mask")
        .agg(F.count("*").alias("n"))
    )


def labelled(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """rows with good and toxic (0 or 1), which a document is if any of its labels says 1."""
    known = (
        labels.filter("quality = 1 or toxic = 1")
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
        .withColumn("salt", F.lit(0).cast("long"))
    )
    salt = F.when(F.col("doc_id").isNull(), 1 + F.pmod(F.xxhash64("digest"), F.lit(SALTS))).otherwise(0).cast("long")
    return (
        rows.withColumn("salt", salt)
        .join(known, ["doc_id", "salt"], "left")
        .select("doc_id", "part", "digest", "mask", "n", *[F.coalesce(F.col(c), F.lit(0)).alias(c) for c in ("good", "toxic")])
    )


def with_copies(rows: DataFrame, bit: int) -> DataFrame:
    """part, mask, good, toxic, n, where ``bit`` marks texts that a smaller doc_id has too.

    Copies are combined before any of them is moved by its digest: of a text there is a
    row for each part and label, however many copies it has.
    """
    first = F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "n"))
    groups = rows.groupBy("digest", "part", "mask", "good", "toxic").agg(
        F.sum("n").alias("n"), F.sum(F.when(F.col("doc_id").isNotNull(), F.col("n")).otherwise(0)).alias("with_id"),
        F.min(first).alias("first"),
    )
    least = F.min("first.doc_id").over(Window.partitionBy("digest"))
    own = F.when(F.col("first.doc_id") == F.col("least"), F.col("first.n")).otherwise(0)
    apart = groups.withColumn("least", least).withColumn("again", F.col("with_id") - own)
    kinds = F.array(
        F.struct(F.col("mask"), (F.col("n") - F.col("again")).alias("n")),
        F.struct((F.col("mask") + (1 << bit)).alias("mask"), F.col("again").alias("n")),
    )
    return apart.select("part", "good", "toxic", F.explode(kinds).alias("k")).select("part", "good", "toxic", "k.mask", "k.n")


def coalitions(masks: DataFrame, n_filters: int) -> DataFrame:
    """part, n documents, and for each set of filters how many (all, good, toxic) fail one of it."""

    def table(weight):
        failed = [F.sum(F.when(F.col("mask").bitwiseAND(F.lit(s)) != 0, weight).otherwise(0)) for s in range(1 << n_filters)]
        return F.array(*failed)

    n, good, toxic = F.col("n"), F.col("n") * F.col("good"), F.col("n") * F.col("toxic")
    few = masks.groupBy("part", "mask").agg(
        F.sum("n").alias("n"), F.sum(good).alias("good"), F.sum(toxic).alias("toxic")
    )
    return few.groupBy("part").agg(
        F.sum("n").alias("n"), table(F.col("n")).alias("v"), table(F.col("good")).alias("good"), table(F.col("toxic")).alias("toxic")
    )


def audit(
    docs: DataFrame, labels: DataFrame, filters=text_filters, copies: str = "E",
    id_col: str = "doc_id", text_col: str = "text", part_col: str = "source",
) -> DataFrame:
    """One row per part, order of the filters and step: what the filter of the step does there.

    filters: function from a text column to failure conditions by letter; ``copies`` is
    the letter of the last filter, which texts fail that a smaller doc_id has as well,
    in whatever part and whether removed or not. Returns part, filter_order, step, and
    as longs kept, removed, redundant, unique_fails, good_lost, toxic_lost and shapley
    (removed by the step's filter, summed over all orders).

    A null text is empty, a null part the empty string. Rows with a null doc_id count,
    but neither are copies nor make others so, and have no labels. A row repeated with
    its doc_id counts each time; the same doc_id is not smaller than itself. Several
    labels of a document: it is good or toxic if one says so. No rows: no rows. Other
    columns are ignored. Lazy.
    """
    letters = [*filters(F.lit("")), copies]
    n, size = len(letters), 1 << len(letters)
    rows = labelled(failing(docs, filters, id_col, text_col, part_col), labels)
    table = coalitions(with_copies(rows, n - 1), n)
    steps = []
    for order in itertools.permutations(range(n)):
        for k, f in enumerate(order):
            steps.append(("".join(letters[g] for g in order), k + 1, sum(1 << g for g in order[:k]), f))
    column = {name: F.lit(list(values)) for name, values in zip(("order", "step", "before", "f"), zip(*steps, strict=True), strict=True)}
    at = F.col("at")
    placed = table.select("*", F.explode(F.sequence(F.lit(0), F.lit(len(steps) - 1))).alias("at")).select(
        "*", *[F.get(values, at).alias(name) for name, values in column.items()]
    )
    own = F.get(F.lit([1 << g for g in range(n)]), F.col("f"))
    after = F.col("before") + own
    removed = F.get("v", after) - F.get("v", F.col("before"))
    weights = [
        sum((F.get("v", F.lit(s)) * w for s, w in enumerate(ws) if w), F.lit(0).cast("long")) for ws in shares(n)
    ]
    return placed.select(
        "part", F.col("order").alias("filter_order"), F.col("step").cast("int").alias("step"),
        (F.col("n") - F.get("v", after)).alias("kept"), removed.alias("removed"),
        (F.get("v", own) - removed).alias("redundant"),
        (F.get("v", F.lit(size - 1)) - F.get("v", F.lit(size - 1) - own)).alias("unique_fails"),
        (F.get("good", after) - F.get("good", F.col("before"))).alias("good_lost"),
        (F.get("toxic", after) - F.get("toxic", F.col("before"))).alias("toxic_lost"),
        F.get(F.array(*weights), F.col("f")).alias("shapley"),
    )
