"""Helpers that several operators share: Arrow texts, bucket cells, components."""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusflow.session import sized


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder and read back: ends the lineage, survives lost executors."""
    return sized(df, name)


def documents(docs: DataFrame, id_col: str, text_col: str, carry: bool = False) -> DataFrame:
    """The two columns an operator needs, named doc_id and text; a null text is empty.

    With carry, all columns but the text go along in a struct named rest.
    """
    rest = [F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text_col]).alias("rest")] if carry else []
    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), *rest
    )


def with_rest(schema: str, texts: DataFrame) -> T.StructType:
    """An output schema, with the carried columns at its end if there are any."""
    out = T.StructType.fromDDL(schema)
    return out.add(texts.schema["rest"]) if "rest" in texts.columns else out


def carried(out: DataFrame, docs: DataFrame, text_col: str, text) -> DataFrame:
    """The columns of docs again, with another text and the n_chars that belong to it."""
    new = {text_col: text, "n_chars": F.length(text).cast("long")}
    return out.select(*[(new[c] if c in new else F.col("rest")[c]).alias(c) for c in docs.columns])


def longs(column) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False).astype(np.int64, copy=False)


def utf8(column) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column and its offsets, without a Python object per row."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    binary = column.fill_null("").cast(pa.binary()).cast(pa.large_binary())
    offsets = np.frombuffer(binary.buffers()[1], np.int64)[binary.offset : binary.offset + len(binary) + 1]
    data = binary.buffers()[2]
    return np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8), offsets


class Memory:
    """Bounded memory of results by key, in two generations: what is still in use moves on."""

    def __init__(self, kept: int):
        self.kept, self.now, self.before = kept, {}, {}

    def missing(self, wanted: set) -> list:
        """Those keys that have to be computed; the others are in ``now`` afterwards."""
        new = wanted.difference(self.now)
        if self.now and len(self.now) + len(new) > self.kept:
            self.before, self.now = self.now, {}
            new = wanted
        self.now.update({k: v for k in new if (v := self.before.get(k)) is not None})
        return [k for k in new if k not in self.now]


def whole_groups(batches, keys):
    """Regroup sorted batches into tables of whole groups; yields (table, start of each group)."""

    def starts_of(table):
        new = np.zeros(table.num_rows, bool)
        new[:1] = True
        for k in keys:
            values = longs(table.column(k))
            new[1:] |= values[1:] != values[:-1]
        return np.flatnonzero(new)

    held = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        if held is not None:
            table = pa.concat_tables([held, table])
        starts = starts_of(table)
        if len(starts) > 1:
            yield table.slice(0, starts[-1]), starts[:-1]
            held = table.slice(starts[-1])
        elif table.num_rows:
            held = table
    if held is not None:
        yield held, starts_of(held)


def cells(members: DataFrame, keys: list[str], node: str, size: int) -> DataFrame:
    """Cut each bucket into chunks of about ``size`` members and pair the chunks.

    Adds cell_i <= cell_j and chunk. A bucket of one chunk is the cell (0, 0);
    others send each member to every cell of its chunk, so that all pairs of a
    bucket meet in exactly one cell and no task holds more than two chunks. Only
    the list of large buckets is joined, so that members are not shuffled twice
    where it is small enough for Spark to broadcast.
    """
    counted = members.groupBy(*keys).agg(F.count("*").alias("_n"))
    large = stored(counted.filter(F.col("_n") > size), "buckets")
    many = F.ceil(F.coalesce(F.col("_n"), F.lit(1)) / F.lit(size)).cast("int")
    chunk = F.when(many > 1, F.pmod(F.xxhash64(F.col(node)), many)).otherwise(0).cast("int")
    return (
        members.join(large, keys, "left")
        .withColumn("_many", many)
        .withColumn("chunk", chunk)
        .withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_many") - 1)))
        .withColumn("cell_i", F.least("chunk", "_other"))
        .withColumn("cell_j", F.greatest("chunk", "_other"))
        .drop("_n", "_many", "_other")
    )


def forest(left: np.ndarray, right: np.ndarray, n: int) -> np.ndarray:
    """Smallest index reachable from each of n items over the given links."""
    root = np.arange(n)
    while len(left):
        low = np.minimum(root[left], root[right])
        new = root.copy()
        np.minimum.at(new, root[left], low)
        np.minimum.at(new, root[right], low)
        while True:
            jumped = new[new]
            if (jumped == new).all():
                break
            new = jumped
        root = new
        open_ = root[left] != root[right]
        left, right = left[open_], right[open_]
    return root


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """Connected components of edges (a, b) as rows (node, component = smallest node).

    Large-star and small-star steps in turn: each node hands its neighbours to the
    smallest of them, until every edge points at a component's smallest node. Minima
    are combined before the shuffle; each step is written to the shared folder.
    """

    def low(df):
        return df.groupBy("u").agg(F.min("v").alias("m"))

    def both(df):
        return df.unionAll(df.select(F.col("v").alias("u"), F.col("u").alias("v")))

    def large(df):
        sym = both(df)
        mins = low(sym).select("u", F.least("u", "m").alias("m"))
        return sym.filter("v > u").join(mins, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))

    def small(df):
        down = df.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        mins = low(down)
        moved = down.join(mins, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v")
        return moved.unionAll(mins.select("u", F.col("m").alias("v")))

    current = stored(
        edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct(), "edges"
    )
    mark = None
    for _ in range(rounds):
        seen = current.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(seen) == mark or not seen[0]:
            break
        mark = tuple(seen)
        current = stored(small(large(current).distinct()).distinct(), "edges")
    else:
        raise RuntimeError("components did not settle")
    stars = current.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return stars.unionAll(stars.select("component").distinct().select(F.col("component").alias("node"), "component"))
