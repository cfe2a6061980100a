"""Byte-pair encoding and decoding with an existing vocabulary.

Texts are cut at special tokens, then into chunks at white space, then by the
tokenizer's pattern. A short piece is merged over a contiguous array of the ranks
of adjacent parts: find the minimum, delete a boundary, refresh both neighbours.
Long pieces use a heap over linked parts, which gives the same merges. Codes of
chunks are remembered, up to a bound; a forgotten chunk is merged again.
"""

import collections
import functools
import heapq
import json
import re

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from .common import Memory, documents

# The pattern that splits text in front of the merges.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
# Unicode white space.
SPACE = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"

SHORT = 64  # parts; longer pieces go to the heap
ROWS = 1 << 14  # pieces merged side by side
NONE = np.int32(1 << 30)
KEPT = 150_000  # remembered chunks for each worker
OUTPUT_BYTES = 2 << 20  # of texts in one output batch


def byte_letters() -> dict[str, int]:
    """The letters that stand for bytes in the vocabulary: printable ones for themselves, the rest from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Codec:
    """Ranks, ids and bytes of one vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            data = json.load(f)
        letters = byte_letters()
        vocab = data["model"]["vocab"]
        self.bytes_of = {i: bytes(letters[c] for c in token) for token, i in vocab.items()}
        self.special = {t["content"]: t["id"] for t in data["added_tokens"]}
        self.bytes_of |= {i: s.encode() for s, i in self.special.items()}
        self.of_byte = [0] * 256
        for c, b in letters.items():
            self.of_byte[b] = vocab[c]
        merges = [m if isinstance(m, list) else m.split(" ") for m in data["model"]["merges"]]
        self.rank = {vocab[a] << 20 | vocab[b]: r for r, (a, b) in enumerate(merges)}
        self.merged = np.array([vocab[a + b] for a, b in merges])
        self.pairs, self.pair_rank = (np.array(x) for x in zip(*sorted(self.rank.items()), strict=True))
        self.byte_ids = np.array(self.of_byte)
        self.byte_ranks = self._ranks(self.byte_ids[:, None], self.byte_ids[None, :]).astype(np.int32)
        self.pieces = regex.compile(PATTERN.replace(r"\s", f"[{SPACE}]").replace(f"[^[{SPACE}]", f"[^{SPACE}").replace(r"\S", f"[^{SPACE}]")).findall
        self.chunks = re.compile(f" ?[^{SPACE}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+").findall
        self.cut = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")").split if self.special else None
        self.known = Memory(KEPT)

    def merge(self, pieces: list[bytes]) -> list[bytes]:
        """Codes of pieces. Short ones of like length are merged side by side, a row each."""
        out: list[bytes] = [b""] * len(pieces)
        sizes = np.array([len(p) for p in pieces])
        for k in np.flatnonzero(sizes > SHORT):
            out[k] = np.array(self._merge_long([self.of_byte[b] for b in pieces[k]]), "<u4").tobytes()
        low = 0
        for high in (4, 8, 12, 16, 24, SHORT):
            rows = np.flatnonzero((sizes > low) & (sizes <= high))
            for at in range(0, len(rows), ROWS):
                part = rows[at : at + ROWS]
                for k, code in zip(part.tolist(), self._merge_rows([pieces[k] for k in part], high), strict=True):
                    out[k] = code
            low = high
        return out

    def _ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of each adjacent pair; NONE where the vocabulary has no such merge."""
        pair = a.astype(np.int64) << 20 | b
        at = np.minimum(np.searchsorted(self.pairs, pair), len(self.pairs) - 1)
        return np.where(self.pairs[at] == pair, self.pair_rank[at], NONE)

    def _merge_rows(self, pieces: list[bytes], width: int) -> list[bytes]:
        n = len(pieces)
        done: list[bytes] = [b""] * n
        raw = np.frombuffer(b"".join([p.ljust(width, b"\0") for p in pieces]), np.uint8).reshape(n, width)
        count = np.array([len(p) for p in pieces])
        column = np.arange(width)
        parts = np.where(column < count[:, None], self.byte_ids[raw], 0)
        ranks = np.full((n, width), NONE, np.int32)
        ranks[:, :-1] = np.where(column[1:] < count[:, None], self.byte_ranks[raw[:, :-1], raw[:, 1:]], NONE)
        rows = np.arange(n)
        while len(rows):
            at = ranks.argmin(1)
            line = np.arange(len(rows))
            low = ranks[line, at]
            if (low == NONE).any():
                for k in np.flatnonzero(low == NONE):
                    done[rows[k]] = parts[k, : count[k]].astype("<u4").tobytes()
                go = low != NONE
                rows, parts, ranks, count, at, low = rows[go], parts[go], ranks[go], count[go], at[go], low[go]
                line = np.arange(len(rows))
                if not len(rows):
                    break
            # delete the boundary behind the smallest rank, close the gap
            count -= 1
            beyond = np.minimum(column + (column > at[:, None]), width - 1)
            parts = np.take_along_axis(parts, beyond, 1)
            parts[line, at] = self.merged[low]
            beyond = np.minimum(column + (column >= at[:, None]), width - 1)
            ranks = np.take_along_axis(ranks, beyond, 1)
            ranks[line, count - 1] = NONE
            # refresh the ranks on both sides
            more = np.flatnonzero(at + 1 < count)
            ranks[more, at[more]] = self._ranks(parts[more, at[more]], parts[more, at[more] + 1])
            more = np.flatnonzero(at > 0)
            ranks[more, at[more] - 1] = self._ranks(parts[more, at[more] - 1], parts[more, at[more]])
        return done

    def _merge_long(self, parts: list[int]) -> list[int]:
        get, merged, n = self.rank.get, self.merged, len(parts)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i, a, b) for i, (a, b) in enumerate(zip(parts, parts[1:])) if (r := get(a << 20 | b)) is not None]
        heapq.heapify(heap)
        while heap:
            r, i, a, b = heapq.heappop(heap)
            j = after[i]
            if parts[i] != a or j >= n or parts[j] != b:
                continue
            parts[i], parts[j] = int(merged[r]), -1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if (x := get(parts[i] << 20 | parts[k])) is not None:
                    heapq.heappush(heap, (x, i, parts[i], parts[k]))
            h = before[i]
            if h >= 0 and (x := get(parts[h] << 20 | parts[i])) is not None:
                heapq.heappush(heap, (x, h, parts[h], parts[i]))
        return [p for p in parts if p >= 0]

    def _learn(self, chunks: list[str]) -> dict[str, bytes]:
        split = [[c] if c[c[0] == " " :].isalpha() else self.pieces(c) for c in chunks]
        pieces = list({p for ps in split for p in ps})
        code = dict(zip(pieces, self.merge([p.encode() for p in pieces]), strict=True))
        return {c: b"".join([code[p] for p in ps]) for c, ps in zip(chunks, split, strict=True)}

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        cut = [self.cut(t) if self.cut else [t] for t in texts]
        chunks = [[self.chunks(p) if k % 2 == 0 else [p] for k, p in enumerate(ps)] for ps in cut]
        learnt = self._learn(self.known.missing(set().union(*(c for ps in chunks for c in ps[::2]))))
        long = {c: code for c, code in learnt.items() if len(c) > SHORT}
        self.known.now |= {c: code for c, code in learnt.items() if len(c) <= SHORT} if long else learnt
        get = collections.ChainMap(self.known.now, long).__getitem__ if long else self.known.now.__getitem__
        special = {s: i.to_bytes(4, "little") for s, i in self.special.items()}
        return [
            b"".join([b"".join(map(get, c)) if k % 2 == 0 else special[c[0]] for k, c in enumerate(ps)]) for ps in chunks
        ]

    def decode(self, ids) -> str:
        return b"".join(map(self.bytes_of.__getitem__, ids)).decode("utf-8", "replace")


@functools.lru_cache(maxsize=4)
def codec(path: str) -> Codec:
    return Codec(path)


def round_trip(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode every text and decode its ids: doc_id, n_tokens, ids (binary, uint32), decoded.

    path: the tokenizer's file, at the same place on every worker. Strings of special
    tokens become those tokens. Null or empty text: no ids, empty decoded text. Rows
    are kept as they are, repeated or with a null doc_id too; no rows: no rows; other
    columns are ignored. One pass, no shuffle, whole texts.
    """

    def run(batches):
        tool = codec(path)
        for batch in batches:
            docs, texts, lo = batch.column("doc_id"), batch.column("text"), 0
            while lo < len(docs):
                hi, size = lo, 0
                while hi < len(docs) and size < OUTPUT_BYTES:
                    size += len(texts[hi].as_buffer())
                    hi += 1
                codes = tool.encode(texts.slice(lo, hi - lo).to_pylist())
                yield pa.record_batch(
                    [
                        docs.slice(lo, hi - lo), pa.array([len(c) >> 2 for c in codes], pa.int64()),
                        pa.array(codes, pa.binary()),
                        pa.array([tool.decode(memoryview(c).cast("I")) for c in codes], pa.string()),
                    ],
                    ["doc_id", "n_tokens", "ids", "decoded"],
                )
                lo = hi

    schema = "doc_id long, n_tokens long, ids binary, decoded string"
    return documents(docs, id_col, text_col).mapInArrow(run, schema)

