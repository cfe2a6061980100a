"""Near duplicates by SimHash: fingerprints linked within a Hamming radius by BK-trees.

Only distinct fingerprints are searched. Within radius r, one of r + 1 bit blocks
must agree (pigeonhole), so a shard is all fingerprints with one block's value, and
a fingerprint meets r + 1 shards instead of all. Large shards are cut into chunks;
each chunk's tree is sent to the cells that hold the shard's other chunks as
queries (see common.cells), so neither a tree nor a task grows with the data and
nothing of unknown size is broadcast. A search follows only the edges whose
distance differs from that of the node by the radius at most.
"""

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cells, components, documents, forest, longs, stored, utf8, whole_groups

SHINGLE = 3
RADIUS = 2
SEED = 42
CHUNK = 2048  # fingerprints of one tree in a cut shard
HASHED = 1 << 16  # shingles whose bits are added up at once
_QUERIES = 4096  # searched side by side


def fingerprint(text: bytes, size: int = SHINGLE) -> int:
    """Bits set in over half of the shingles' hashes; zero without words."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    n = max(1, len(words) - size + 1)
    ends = np.cumsum([len(w) + 1 for w in words])
    lo = [0, *ends[: n - 1].tolist()]
    hi = (ends[min(size, len(words)) - 1 :] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    return majority(
        np.array([digest(joined[a:b], SEED) for a, b in zip(lo[at : at + HASHED], hi[at : at + HASHED], strict=True)], "<u8")
        for at in range(0, n, HASHED)
    )


def majority(parts) -> int:
    """The SimHash of hashes given in arrays: bits set in over half of them, zero for none."""
    counts, n = np.zeros(64, np.int64), 0
    for hashes in parts:
        bits = np.unpackbits(hashes.astype("<u8", copy=False).view(np.uint8), bitorder="little")
        counts += bits.reshape(-1, 64).sum(0, dtype=np.int64)
        n += len(hashes)
    return int(np.packbits(counts * 2 > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and fp, the SimHash as a signed long. One pass, no shuffle, whole texts.

    Null, empty and blank texts have fp 0. Rows are kept one for one, repeated or with a
    null doc_id too. No rows: no rows. Other columns are ignored.
    """

    def run(batches):
        for batch in batches:
            data, offsets = utf8(batch.column("text"))
            prints = [fingerprint(data[a:b].tobytes()) for a, b in zip(offsets, offsets[1:])]
            yield pa.record_batch(
                [batch.column("doc_id"), pa.array(np.array(prints, np.uint64).view(np.int64))], ["doc_id", "fp"]
            )

    return documents(docs, id_col, text_col).mapInArrow(run, "doc_id long, fp long")


class BKForest:
    """BK-trees of many groups at once: children keyed by their distance to the parent.

    A node's children are rows of ``edges`` (node * 65 + distance), sorted. ``closest`` is,
    for each value, the nearest of the nodes that it met on its way down (a root: itself),
    ``apart`` the bits in which they differ.
    """

    def __init__(self, values: np.ndarray, group: np.ndarray):
        self.values = values
        _, first, inverse = np.unique(group, return_index=True, return_inverse=True)
        self.groups, self.roots = group[first], first
        at = first[inverse]
        left = np.flatnonzero(at != np.arange(len(values)))
        self.closest, self.apart = at.copy(), np.zeros(len(values), np.int64)
        self.apart[left] = 65
        at = at[left]
        keys, children = [], []
        while len(left):
            distance = np.bitwise_count(values[left] ^ values[at]).astype(np.int64)
            nearer = distance < self.apart[left]
            self.closest[left[nearer]], self.apart[left[nearer]] = at[nearer], distance[nearer]
            key, first, inverse = np.unique(at * 65 + distance, return_index=True, return_inverse=True)
            keys.append(key)
            children.append(left[first])
            at = left[first][inverse]
            more = at != left
            left, at = left[more], at[more]
        key = np.concatenate(keys) if keys else np.zeros(0, np.int64)
        child = np.concatenate(children) if children else np.zeros(0, np.int64)
        order = np.argsort(key)
        self.edges, self.children = key[order], child[order]

    def search(self, values: np.ndarray, group: np.ndarray, radius: int):
        """Pairs (query, node) of one group within the radius."""
        place = np.minimum(np.searchsorted(self.groups, group), len(self.groups) - 1)
        query = np.flatnonzero(self.groups[place] == group) if len(self.groups) else np.zeros(0, np.int64)
        node = self.roots[place[query]] if len(query) else query
        found = []
        while len(query):
            distance = np.bitwise_count(values[query] ^ self.values[node]).astype(np.int64)
            hit = distance <= radius
            found.append((query[hit], node[hit]))
            low = np.searchsorted(self.edges, node * 65 + np.maximum(distance - radius, 0))
            high = np.searchsorted(self.edges, node * 65 + np.minimum(distance + radius, 64), side="right")
            count = high - low
            total = int(count.sum())
            place = np.arange(total) - np.repeat(np.cumsum(count) - count, count) + np.repeat(low, count)
            query, node = np.repeat(query, count), self.children[place]
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def _links(radius: int):
    """Spanning links of each cell, as edges (a, b) between the nodes of fingerprints."""

    def run(batches):
        for table, starts in whole_groups(batches, ["block", "value", "cell_i", "cell_j"]):
            values = longs(table.column("fp").combine_chunks()).view(np.uint64)
            node = longs(table.column("node").combine_chunks())
            chunk, i, j = (longs(table.column(c).combine_chunks()) for c in ("chunk", "cell_i", "cell_j"))
            group = np.zeros(len(values), np.int64)
            group[starts[1:]] = 1
            group = np.cumsum(group)
            member, asked = np.flatnonzero(chunk == i), np.flatnonzero(chunk == j)
            trees = BKForest(values[member], group[member])
            root = np.arange(len(values))
            for at in range(0, len(asked), _QUERIES):
                part = asked[at : at + _QUERIES]
                q, n = trees.search(values[part], group[part], radius)
                left, right = part[q], member[n]
                apart = left != right
                low = forest(np.append(left[apart], np.arange(len(values))), np.append(right[apart], root), len(values))
                root = low
            moved = np.flatnonzero(root != np.arange(len(root)))
            yield pa.record_batch([pa.array(node[moved]), pa.array(node[root[moved]])], ["a", "b"])

    return run


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = RADIUS, chunk: int = CHUNK
) -> DataFrame:
    """Groups of texts whose fingerprints are chained by steps of ``radius`` bits at most.

    Returns doc_id, fp (long) and component_id, the smallest doc_id reachable, the own
    one included. Null, empty and blank texts have the fingerprint zero, linked like
    any other. Rows repeated with one doc_id are each returned. A null doc_id links
    nothing and has a null component. No rows: no rows. Other columns are ignored.
    Runs jobs.
    """
    prints = stored(fingerprints(docs, id_col, text_col), "fingerprints")
    nodes = stored(prints.filter("doc_id is not null").groupBy("fp").agg(F.min("doc_id").alias("node")), "nodes")
    blocks = radius + 1
    cuts = [64 * k // blocks for k in range(blocks + 1)]
    values = [
        F.struct(
            F.lit(k).alias("block"),
            F.shiftrightunsigned("fp", cuts[k]).bitwiseAND(F.lit((1 << (cuts[k + 1] - cuts[k])) - 1)).alias("value"),
        )
        for k in range(blocks)
    ]
    members = nodes.withColumn("b", F.explode(F.array(*values))).select("fp", "node", "b.block", "b.value")
    keys = ["block", "value", "cell_i", "cell_j"]
    met = cells(members, ["block", "value"], "fp", chunk).repartition(*keys).sortWithinPartitions(*keys)
    linked = components(met.mapInArrow(_links(radius), "a long, b long"))
    named = (
        nodes.join(linked, nodes.node == linked.node, "left")
        .select("fp", F.coalesce("component", nodes.node).alias("component_id"))
    )
    return (
        prints.join(named, "fp", "left")
        .select("doc_id", "fp", F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id"))
    )


def hex_digits(fp) -> F.Column:
    """A fingerprint as 16 lowercase hex digits."""
    return F.lpad(F.lower(F.hex(fp)), 16, "0")
