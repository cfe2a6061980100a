"""Token ids in flat binary files with 64-bit document offsets, and reading them back.

Texts are range-partitioned by id, so that the files in order hold the documents in
order. Each task streams one pair of files; names differ by attempt, and only those
in the manifest count, so a repeated or speculative task does no harm. The base of a
file in the whole sequence is a prefix sum over the manifest (a row per file).

* ``.bin``: ids, unsigned 16-bit where the vocabulary allows, else 32-bit
* ``.idx``: n + 1 unsigned 64-bit offsets into the ids, then n signed 64-bit document ids
"""

import collections
import functools
import json
import os
import re
import uuid

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusflow.session import work_folder

from .byte_bpe import byte_letters
from .common import Memory, documents, stored

KEPT = 300_000  # remembered words for each worker
LONGEST = 64  # characters of a remembered word
OUTPUT_BYTES = 4 << 20
MANIFEST = "first long, part string, n_docs long, n_tokens long, width int"


# Letters and digits of lower-cased Latin-1, and how the vocabulary parts words.
_LETTERS, _DIGITS, _SPACE = "a-zªµºß-öø-ÿ", "0-9²³¹¼-¾", " \\t\\n\\x0b\\x0c\\r"
_WORDS = f"'(?:s|t|re|ve|m|ll|d)|[{_LETTERS}]+|[{_DIGITS}]|[^{_SPACE}{_LETTERS}{_DIGITS}]+"
# characters that are their own normal form, and that lower() treats alike everywhere
_PLAIN = f"[{_SPACE}!-~¡-ÿ\u2010-\u2027€]*"
_END = "\x01"  # ends each word on its way to the merges
SLICE = 1 << 20  # characters parted into words at once


class PlainCoder:
    """Codes of plain Latin texts by compiled merges over the vocabulary file.

    The vocabulary has units of a byte and the end of a word. Written as a byte and a
    control character they have the lowest ranks, so each is merged first, and a word
    that ends in that character is merged as the file says.
    """

    def __init__(self, data: dict, special):
        import tiktoken

        letters = byte_letters()
        vocab = data["model"]["vocab"]
        ends = data["model"]["end_of_word_suffix"]
        named = {t: i for t, i in vocab.items() if t not in special}

        def raw(token):
            body = token.removesuffix(ends)
            return bytes(letters[c] for c in body) + (_END.encode() if body != token else b"")

        self.tool = tiktoken.Encoding("own", pat_str=f"[^{_END}]+{_END}", mergeable_ranks={raw(t): i for t, i in named.items()}, special_tokens={})
        self.plain, self.words, self.gap = re.compile(_PLAIN).fullmatch, re.compile(_WORDS).findall, re.compile(f"[{_SPACE}]")
        self.special = re.compile("|".join(map(re.escape, special)) or r"(?!)").search

    @classmethod
    def of(cls, path: str):
        """None where the file is of another kind: ranks, word ends and normal forms are as expected here."""
        with open(path, encoding="utf-8") as f:
            data = json.load(f)
        special = [t["content"] for t in data.get("added_tokens") or []]
        vocab, merges = data["model"].get("vocab"), data["model"].get("merges") or []
        pairs = [m if isinstance(m, list) else m.split(" ") for m in merges]
        fits = (
            data["model"].get("end_of_word_suffix")
            and json.dumps(data["normalizer"]) == _NORMALIZER and _PARTS in json.dumps(data["pre_tokenizer"])
            and all(vocab[a + b] == 512 + k for k, (a, b) in enumerate(pairs))
            and {i for t, i in vocab.items() if len(t.removesuffix(data["model"]["end_of_word_suffix"])) == 1} == set(range(512))
        )
        return cls(data, special) if fits else None

    def encode(self, text: str, kind) -> bytes | None:
        """None for a text that is not plain."""
        if not self.plain(text) or self.special(text):
            return None
        out, lo = [], 0
        while lo < len(text):
            end = self.gap.search(text, lo + SLICE) if lo + SLICE < len(text) else None
            hi = end.start() if end else len(text)
            words = self.words(text[lo:hi].lower())
            if words:
                out.append(self.tool.encode_to_numpy(_END.join([*words, ""])).astype(kind).tobytes())
            lo = hi
        return b"".join(out)


# Settings of the vocabulary file that the plain way relies on.
_NORMALIZER = json.dumps(
    {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]}
)
_PARTS = json.dumps({"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"})


class WordCoder:
    """The library's codes of white-space separated words, remembered; plain texts go to PlainCoder.

    Only for tokenizers that treat white space as a separator and drop it: then the
    code of a text is the codes of its words in a row.
    """

    def __init__(self, path: str, width: int):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tool = Tokenizer.from_file(path)
        self.tool.no_truncation()
        self.tool.no_padding()
        self.mark = "\x01"
        (self.mark_id,) = self.tool.encode(self.mark, add_special_tokens=False).ids
        self.kind = np.dtype(f"<u{width}")
        self.known = Memory(KEPT)
        self.quick = PlainCoder.of(path)

    def _learn(self, words) -> dict[str, bytes]:
        """Many words in one call, kept apart by a control character with one id; words that hold it go by themselves."""
        words = list(words)
        alone = [w for w in words if self.mark in w]
        rest = [w for w in words if self.mark not in w] if alone else words
        found = {w: np.array(self.tool.encode(w, add_special_tokens=False).ids, self.kind).tobytes() for w in alone}
        for lo in range(0, len(rest), 2000):
            part = rest[lo : lo + 2000]
            ids = np.array(self.tool.encode_batch_fast([f" {self.mark} ".join(part)], add_special_tokens=False)[0].ids, self.kind)
            cuts = np.concatenate([[-1], np.flatnonzero(ids == self.mark_id), [len(ids)]]).tolist()
            raw, w = ids.tobytes(), self.kind.itemsize
            found |= {x: raw[(a + 1) * w : b * w] for x, a, b in zip(part, cuts, cuts[1:], strict=False)}
        return found

    def encode(self, texts: list[str]) -> list[bytes]:
        out = [self.quick.encode(t, self.kind) if self.quick else None for t in texts]
        rest = self.encode_words([t for t, code in zip(texts, out, strict=True) if code is None])
        return [next(rest) if code is None else code for code in out]

    def encode_words(self, texts: list[str]):
        """Codes of any texts, word by word."""
        split = re.compile(r"[^ \t\n\r\x0b\x0c]+").findall
        words = [split(t) for t in texts]
        learnt = self._learn(self.known.missing(set().union(*words)))
        long = {w: code for w, code in learnt.items() if len(w) > LONGEST}
        self.known.now |= {w: code for w, code in learnt.items() if len(w) <= LONGEST} if long else learnt
        get = collections.ChainMap(self.known.now, long).__getitem__ if long else self.known.now.__getitem__
        return iter([b"".join(map(get, ws)) for ws in words])


@functools.lru_cache(maxsize=4)
def word_coder(path: str, width: int) -> WordCoder:
    return WordCoder(path, width)


def _open(folder: str):
    if "://" in folder or folder.startswith("file:"):
        system, base = fs.FileSystem.from_uri(folder)
    else:
        system, base = fs.LocalFileSystem(), folder
    return system, base.rstrip("/")


def write_token_files(
    docs: DataFrame, path: str, end_id: int, vocab_size: int, folder: str | None = None,
    id_col: str = "doc_id", text_col: str = "text",
) -> tuple[str, DataFrame]:
    """Encode whole texts, each followed by ``end_id``, into files below ``folder``.

    path: tokenizer file, at the same place on every worker; vocab_size decides the
    width of an id. folder: a place that all executors share (a fresh one in the
    shared folder by default). Documents are in ascending doc_id order, null first;
    rows with the same doc_id are all written, ordered by their text. Null or empty
    text: the end id only. No rows: no files. Returns the folder and the manifest
    (first, part, n_docs, n_tokens, width). Runs a job.
    """
    folder = folder or work_folder(docs.sparkSession, "tokens")
    width = 2 if vocab_size <= 1 << 16 else 4

    def run(batches):
        coder = word_coder(path, width)
        end = np.array([end_id], coder.kind).tobytes()
        system, base = _open(folder)
        part, out, offsets, ids = f"part-{uuid.uuid4().hex}", None, [0], []
        first = None
        for batch in batches:
            docs, texts = batch.column("doc_id").to_pylist(), batch.column("text")
            lo = 0
            while lo < len(docs):
                hi, size = lo, 0
                while hi < len(docs) and size < OUTPUT_BYTES:
                    size += len(texts[hi].as_buffer())
                    hi += 1
                if out is None:
                    system.create_dir(base, recursive=True)
                    out = system.open_output_stream(f"{base}/{part}.bin")
                    first = docs[0]
                for doc, code in zip(docs[lo:hi], coder.encode(texts.slice(lo, hi - lo).to_pylist()), strict=True):
                    out.write(code)
                    out.write(end)
                    offsets.append(offsets[-1] + len(code) // width + 1)
                    ids.append(-(1 << 63) if doc is None else doc)
                lo = hi
        if out is not None:
            out.close()
            with system.open_output_stream(f"{base}/{part}.idx") as idx:
                idx.write(np.array(offsets, "<u8").tobytes())
                idx.write(np.array(ids, "<i8").tobytes())
            yield pa.RecordBatch.from_pylist(
                [{"first": first, "part": part, "n_docs": len(ids), "n_tokens": offsets[-1], "width": width}],
                pa.schema([("first", pa.int64()), ("part", pa.string()), ("n_docs", pa.int64()), ("n_tokens", pa.int64()), ("width", pa.int32())]),
            )

    texts = documents(docs, id_col, text_col)
    ordered = texts.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    return folder, stored(ordered.mapInArrow(run, MANIFEST), "manifest")


def read_token_files(spark: SparkSession, folder: str, manifest: DataFrame) -> DataFrame:
    """Documents from the files: doc_id, start (ids before it in all files), n_tokens, ids (binary, uint32).

    Counts the manifest to deal its files out. Files are memory-mapped where the folder is a local path, read whole otherwise.
    """
    in_order = Window.orderBy(F.col("first").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
    based = manifest.withColumn("base", F.coalesce(F.sum("n_tokens").over(in_order), F.lit(0)))

    def run(batches):
        system, base = _open(folder)
        local = isinstance(system, fs.LocalFileSystem)

        def array(name, kind):
            if local:
                return np.memmap(name, kind, "r")
            with system.open_input_file(name) as f:
                return np.frombuffer(f.read(), kind)

        for batch in batches:
            for row in batch.to_pylist():
                index = array(f"{base}/{row['part']}.idx", "<u8")
                n = row["n_docs"]
                offsets, ids = index[: n + 1].astype(np.int64), index[n + 1 :].view("<i8")
                tokens = array(f"{base}/{row['part']}.bin", f"<u{row['width']}")
                lo = 0
                while lo < n:
                    hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + OUTPUT_BYTES // 4, side="right")) - 1)
                    piece = tokens[offsets[lo] : offsets[hi]].astype("<u4").tobytes()
                    cuts = (offsets[lo : hi + 1] - offsets[lo]) * 4
                    yield pa.record_batch(
                        [
                            pa.array([None if d == -(1 << 63) else int(d) for d in ids[lo:hi]], pa.int64()),
                            pa.array(offsets[lo:hi] + row["base"]),
                            pa.array(np.diff(offsets[lo : hi + 1])),
                            pa.array([piece[a:b] for a, b in zip(cuts, cuts[1:])], pa.binary()),
                        ],
                        ["doc_id", "start", "n_tokens", "ids"],
                    )
                    lo = hi

    # a number, or adaptive execution would put the few rows of the manifest into one task
    n = max(1, manifest.count())
    return based.repartition(n, "part").mapInArrow(run, "doc_id long, start long, n_tokens long, ids binary")
