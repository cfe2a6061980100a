"""Best-fit packing of token ids into sequences of a fixed length.

Each task encodes its documents and packs them as they come, so nothing is shuffled
and a sequence never spans two tasks. A fixed number of bins is open at a time; a
bitset holds which free spaces the open bins have, so the best fit for a piece is the
lowest set bit at its length or above. Where no bin fits and all are open, the fullest
is closed. Pieces wait in blocks of a fixed number and are taken longest first, so that
short ones find the gaps that long ones leave. A task ends with its open bins: that is
all it can waste beyond the packing itself, however much it packs.
"""

import functools

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .byte_bpe import PATTERN, codec
from .common import documents

OPEN = 1024  # bins open at a time
BLOCK = 1024  # pieces that wait for each other
KINDS = {
    "doc_id": pa.int64(), "piece": pa.int32(), "start": pa.int64(), "length": pa.int64(), "ids": pa.binary(),
    "sequence_id": pa.int64(), "offset": pa.int64(),
}


class Coder:
    """The ids that the vocabulary file gives, by the merges of a compiled library.

    Its pattern and its ranks are those of the file, so the ids are too. Its pattern
    gives up on very long white space; such a text is merged by ``Codec``.
    """

    def __init__(self, path: str):
        import tiktoken

        self.own = codec(path)
        special = self.own.special
        ranks = {b: i for i, b in self.own.bytes_of.items() if i not in special.values()}
        self.tool = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special)

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        try:
            return self.tool.encode_to_numpy(text, allowed_special="all").astype("<u4", copy=False).tobytes()
        except ValueError:
            return self.own.encode([text])[0]


@functools.lru_cache(maxsize=4)
def coder_of(path: str) -> Coder:
    return Coder(path)


class OpenBins:
    """Bounded-space best fit: at most ``limit`` open bins, found by their free space."""

    def __init__(self, capacity: int, limit: int):
        self.capacity, self.limit, self.open, self.started = capacity, limit, 0, 0
        self.bits = 0  # bit f is set if an open bin has f free
        self.bins: list[list[int]] = [[] for _ in range(capacity + 1)]

    def _take(self, free: int) -> int:
        found = self.bins[free].pop()
        if not self.bins[free]:
            self.bits ^= 1 << free
        self.open -= 1
        return found

    def put(self, size: int) -> tuple[int, int]:
        """The number of the bin that takes a piece, and the place in it."""
        fitting = self.bits >> size
        if fitting:
            free = size + (fitting & -fitting).bit_length() - 1
            place = self._take(free)
        else:
            if self.open == self.limit and size < self.capacity:  # the fullest one closes
                self._take((self.bits & -self.bits).bit_length() - 1)
            free, place = self.capacity, self.started
            self.started += 1
        left = free - size
        if left:  # a full bin needs no place among the open ones
            self.bins[left].append(place)
            self.bits |= 1 << left
            self.open += 1
        return place, self.capacity - free


def pack(
    docs: DataFrame, path: str, end_id: int, capacity: int = 2048, open_bins: int = OPEN, block: int = BLOCK,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """Pieces of all documents with their places in sequences of up to ``capacity`` ids.

    path: the tokenizer's file, at the same place on every worker. A document is the
    ids of its whole text and ``end_id``; only one longer than ``capacity`` is cut, into
    pieces of that length after a first one of the rest. Returns doc_id, piece (from 0),
    start (ids of the document before it), length, ids (binary, unsigned 32-bit),
    sequence_id and offset. Sequences have no gaps and no overlaps; their numbers hold
    the task's in the high bits.

    Null or empty text: the end id only. Rows are packed each, repeated or with a null
    doc_id too; no rows: no rows; other columns are ignored. One pass, no shuffle, lazy;
    a task run again packs the same rows anew, and no other task depends on it.
    """

    def run(batches):
        coder, bins = coder_of(path), OpenBins(capacity, open_bins)
        base = (TaskContext.get().partitionId() if TaskContext.get() else 0) << 32
        end, width = np.array([end_id], "<u4").tobytes(), 4 * capacity
        waiting, out = [], []

        def place(pieces):
            for doc, piece, start, ids in sorted(pieces, key=lambda p: -len(p[3])):
                sequence, offset = bins.put(len(ids) >> 2)
                out.append((doc, piece, start, len(ids) >> 2, ids, base + sequence, offset))

        def emptied():
            columns = [pa.array(list(c), k) for c, k in zip(zip(*out, strict=True), KINDS.values(), strict=True)]
            out.clear()
            return pa.record_batch(columns, list(KINDS))

        for batch in batches:
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                code = coder.encode(text.as_py()) + end
                cuts = [0, *range(len(code) % width or width, len(code) + 1, width)]
                for piece, (a, b) in enumerate(zip(cuts, cuts[1:])):
                    if b - a == width:
                        place([(doc, piece, a >> 2, code[a:b])])
                    else:
                        waiting.append((doc, piece, a >> 2, code[a:b]))
                    if len(waiting) >= block:
                        place(waiting)
                        waiting = []
                    if len(out) >= block:
                        yield emptied()
        place(waiting)
        if out:
            yield emptied()

    schema = "doc_id long, piece int, start long, length long, ids binary, sequence_id long, offset long"
    return documents(docs, id_col, text_col).mapInArrow(run, schema)


def sequences(pieces: DataFrame) -> DataFrame:
    """The sequences themselves: sequence_id, length, ids (binary), and the start and document of each piece.

    A group holds at most a sequence, so its size is bounded. One shuffle.
    """
    parts = F.array_sort(F.collect_list(F.struct("offset", "length", "doc_id", "ids")))
    joined = F.aggregate("parts", F.lit(b""), lambda all_, p: F.concat(all_, p["ids"]))
    return (
        pieces.groupBy("sequence_id").agg(parts.alias("parts"))
        .select(
            "sequence_id", F.aggregate("parts", F.lit(0).cast("long"), lambda n, p: n + p["length"]).alias("length"),
            joined.alias("ids"), F.col("parts.offset").alias("offsets"), F.col("parts.doc_id").alias("doc_ids"),
        )
    )
