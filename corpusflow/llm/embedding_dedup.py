"""Near-duplicate vectors: random-hyperplane signs in several tables, exact cosines, components.

Equal vectors are one row with a count. A bucket is one table, label and sign
pattern; large buckets are cut into cells (see common.cells) and compared by matrix
products in double precision. A pair that shares several buckets counts in the
first table where it meets, so links are counted in the tasks and never shuffled as
pairs: a cell sends each vector's count of links and a spanning forest.

With b bits and T tables a pair at angle t meets with probability
1 - (1 - (1 - t/pi)^b)^T: at cosine 0.98, b = 12 and T = 16, over 0.9999.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cells, components, forest, longs, stored, whole_groups

THRESHOLD = 0.98
TABLES = 16
BITS = 12
CHUNK = 1024  # vectors of one side of a cell
_KEYS = ["table", "label", "size", "pattern", "cell_i", "cell_j"]


def _signs(tables: int, bits: int, seed: int, real):
    def run(batches):
        planes = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            vectors, counts = batch.column("vector"), batch.column("size").to_numpy()
            flat = vectors.flatten().to_numpy().astype(np.float64)
            ends = np.cumsum(counts)
            for size in np.unique(counts).tolist():
                rows = np.flatnonzero(counts == size)
                if size not in planes:
                    planes[size] = np.random.default_rng([seed, size]).standard_normal((size, tables * bits))
                x = flat[(ends[rows] - size)[:, None] + np.arange(size)]
                side = (x @ planes[size] > 0).reshape(len(rows), tables, bits)
                patterns = (side * (1 << np.arange(bits))).sum(2).astype(np.int32)
                part = batch.take(pa.array(rows))
                raw = pa.array([v.tobytes() for v in x.astype(real)], pa.binary())
                all_keys = pa.array([k.tobytes() for k in patterns], pa.binary())
                for t in range(tables):
                    yield pa.record_batch(
                        [
                            pa.array(np.full(len(rows), t, np.int32)), part.column("label"), part.column("size"),
                            pa.array(patterns[:, t]), part.column("node"), part.column("copies"), all_keys, raw,
                        ],
                        ["table", "label", "size", "pattern", "node", "copies", "patterns", "raw"],
                    )

    return run


def _compare(tables: int, threshold: float, real):
    """Rows (node, other, links): a link count without other, or an edge of the cell's forest."""

    def run(batches):
        for table, starts in whole_groups(batches, _KEYS):
            node, copies, chunk, i, j, t = (
                longs(table.column(c).combine_chunks()) for c in ("node", "copies", "chunk", "cell_i", "cell_j", "table")
            )
            raw, patterns = table.column("raw").combine_chunks(), table.column("patterns").combine_chunks()
            nodes, others, links = [], [], []
            ends = np.append(starts[1:], table.num_rows)
            several = ends - starts > 1
            for lo, hi in zip(starts[several], ends[several], strict=True):
                left, right = (lo + np.flatnonzero(chunk[lo:hi] == side[lo]) for side in (i, j))
                if not len(left) or not len(right):
                    continue
                x = np.frombuffer(b"".join(raw[lo:hi].to_pylist()), real).reshape(hi - lo, -1).astype(np.float64)
                x = x / np.sqrt((x * x).sum(1))[:, None]
                near = x[left - lo] @ x[right - lo].T >= threshold
                if i[lo] == j[lo]:
                    near = np.triu(near, 1)
                a, b = np.nonzero(near)
                if not len(a):
                    continue
                a, b = left[a], right[b]
                if t[lo]:
                    keys = np.frombuffer(b"".join(patterns[lo:hi].to_pylist()), np.int32).reshape(hi - lo, tables)
                    met = np.zeros(len(a), bool)
                    for k in range(int(t[lo])):
                        met |= keys[a - lo, k] == keys[b - lo, k]
                    a, b = a[~met], b[~met]
                n = hi - lo
                count = np.bincount(a - lo, copies[b], n) + np.bincount(b - lo, copies[a], n)
                some = np.flatnonzero(count)
                root = forest(a - lo, b - lo, n)
                moved = np.flatnonzero(root != np.arange(n))
                nodes += [node[lo + some], node[lo + moved]]
                links += [count[some].astype(np.int64), np.zeros(len(moved), np.int64)]
                others += [np.full(len(some), -1), node[lo + root[moved]]]
            if nodes:
                other, link = np.concatenate(others), np.concatenate(links)
                yield pa.record_batch(
                    [pa.array(np.concatenate(nodes)), pa.array(other, mask=link > 0), pa.array(link)],
                    ["node", "other", "links"],
                )

    return run


def near_vectors(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
    threshold: float = THRESHOLD, tables: int = TABLES, bits: int = BITS, seed: int = 5, chunk: int = CHUNK,
) -> DataFrame:
    """Links between vectors of one label with a cosine of ``threshold`` or more, and their groups.

    Returns vec_id, n_links (other vectors linked directly), component_id (smallest
    vec_id reachable, the own one included) and kept (vec_id = component_id). A vector
    that is null, empty, zero or holds a null or non-finite component, and one with a
    null label, links nothing. Only vectors of one length are compared. Labels that
    are not whole numbers are compared by a 64-bit hash. Repeated rows count as
    vectors of their own. Null vec_id: links nothing, null component and kept. No
    rows: no rows. Other columns are ignored. Runs jobs.
    """
    kind = vectors.schema[label_col].dataType.typeName()
    label = F.col(label_col).cast("long") if kind in ("byte", "short", "integer", "long") else F.when(
        F.col(label_col).isNotNull(), F.xxhash64(F.col(label_col))
    )
    # components travel as they are stored, and are compared in double precision
    real = np.float32 if vectors.schema[vector_col].dataType.simpleString() == "array<float>" else np.float64
    rows = vectors.select(
        F.col(id_col).cast("long").alias("vec_id"), label.alias("label"),
        F.col(vector_col).cast("array<double>").alias("vector"),
    )
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    usable = F.coalesce(
        F.col("vec_id").isNotNull() & F.col("label").isNotNull() & finite & F.exists("vector", lambda x: x != 0), F.lit(False)
    )
    valid = rows.filter(usable)
    classes = valid.groupBy("label", "vector").agg(F.min("vec_id").alias("node"), F.count("*").alias("copies"))
    signed = classes.withColumn("size", F.size("vector")).mapInArrow(
        _signs(tables, bits, seed, real),
        "table int, label long, size int, pattern int, node long, copies long, patterns binary, raw binary",
    )
    met = cells(signed, ["table", "label", "size", "pattern"], "node", chunk)
    met = met.repartition(*_KEYS).sortWithinPartitions(*_KEYS)
    found = stored(met.mapInArrow(_compare(tables, threshold, real), "node long, other long, links long"), "links")
    linked = components(found.filter("other is not null").select(F.col("node").alias("a"), F.col("other").alias("b")))
    counted = found.groupBy("node").agg(F.sum("links").alias("links"))
    named = (
        valid.join(classes, ["label", "vector"])
        .join(counted, "node", "left")
        .join(linked, "node", "left")
        .select(
            "vec_id",
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.coalesce("component", "node").alias("component_id"),
        )
    )
    alone = rows.filter(~usable).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return named.unionAll(alone).withColumn("kept", F.col("vec_id") == F.col("component_id"))
