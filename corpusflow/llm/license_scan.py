"""License scans: MinHash bands of text windows retrieve templates, shingle containment verifies.

Templates of like length share a window size. Windows overlap (a step of an eighth of
their length, one word for short ones); each has BANDS x ROWS minima of its five-word
shingles. A window that agrees with a template in one band is checked exactly, at
every start nearby: which share of the template's shingles it holds.

A window that holds 0.8 of a template has a Jaccard similarity of 0.8 / 1.2 to it at
least; with ROWS = 2 and BANDS = 16 it is retrieved with probability
1 - (1 - (2/3)^2)^16, over 0.9999.
"""

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame

from .common import documents, utf8
from .decontaminate import words_of

SHINGLE = 5
CONTAINMENT = 0.8
BANDS, ROWS = 16, 2
BATCH_BYTES = 2 << 20
KEPT = 200_000  # remembered words for each worker

# Notices and openings of public licences.
TEMPLATES = {
    "mit_line": "Released under the MIT License.",
    "apache_2_line": "Licensed under the Apache License, Version 2.0.",
    "gpl_3_line": "This work is licensed under the GNU General Public License, version 3.",
    "cc_by_nc_4_line": "Licensed under CC BY-NC 4.0.",
    "mit": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
        "permit persons to whom the Software is furnished to do so, subject to the following conditions:"
    ),
    "apache_2": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance "
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless "
        "required by applicable law or agreed to in writing, software distributed under the License is distributed on an "
        "\"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."
    ),
    "gpl_3": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any "
        "later version."
    ),
    "bsd": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met: Redistributions of source code must retain the above copyright notice, this list of "
        "conditions and the following disclaimer."
    ),
}


def _mix(x):
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


_MULTIPLIERS = np.random.default_rng(11).integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_NONE = np.uint64(0xFFFFFFFFFFFFFFFF)


def shingle_hashes(words: np.ndarray) -> np.ndarray:
    """Hash of the shingle at each word that starts one, from the hashes of the words."""
    n = len(words) - SHINGLE + 1
    out = np.zeros(max(0, n), np.uint64)
    for k in range(SHINGLE if n > 0 else 0):
        out = out * np.uint64(0x9E3779B97F4A7C15) + words[k : k + n]
    return _mix(out)


class Scanner:
    def __init__(self, templates: dict[str, str]):
        self.known: dict[bytes, int] = {}
        self.sets: dict[str, set] = {}
        classes: dict[int, list] = {}
        for name, text in templates.items():
            words = words_of(text.encode())
            if len(words) < SHINGLE:
                raise ValueError(f"template {name} has fewer than {SHINGLE} words")
            hashes = shingle_hashes(np.array([xxhash.xxh64_intdigest(w) for w in words], np.uint64))
            self.sets[name] = {tuple(words[i : i + SHINGLE]) for i in range(len(hashes))}
            classes.setdefault(len(hashes), []).append((name, hashes))
        self.classes = []
        for size, found in sorted(classes.items()):
            minima = np.stack([(h[None, :] * _MULTIPLIERS[:, None]).min(1) for _, h in found])
            bands = minima.reshape(len(found), BANDS, ROWS)
            self.classes.append((size, max(1, size // 8), [n for n, _ in found], bands))

    def hashes(self, words: list[bytes]) -> list[int]:
        get = self.known.get
        out = []
        for w in words:
            h = get(w)
            if h is None:
                h = xxhash.xxh64_intdigest(w)
                if len(self.known) >= KEPT:
                    self.known.clear()
                self.known[w] = h
            out.append(h)
        return out

    def candidates(self, shingles: np.ndarray):
        """(window start, size, step, template) of windows that share a band with a template."""
        for size, step, names, bands in self.classes:
            n = len(shingles)
            blocks = -(-n // step)
            padded = np.full(blocks * step, _NONE)
            agree = [None] * len(names)
            for band in range(BANDS):
                same = [None] * len(names)
                for row in range(ROWS):
                    padded[:n] = shingles * _MULTIPLIERS[band * ROWS + row]
                    padded[:n][shingles == _NONE] = _NONE
                    low = padded.reshape(blocks, step).min(1) if step > 1 else padded
                    low = _sliding_min(low, -(-size // step))
                    for k in range(len(names)):
                        hit = low == bands[k, band, row]
                        same[k] = hit if same[k] is None else same[k] & hit
                for k in range(len(names)):
                    agree[k] = same[k] if agree[k] is None else agree[k] | same[k]
            for k, name in enumerate(names):
                for at in np.flatnonzero(agree[k]).tolist():
                    yield at * step, size, step, name


def _sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` successive values, fewer at the end."""
    out, done = values, 1
    while done < width:
        step = min(done, width - done)
        moved = np.full(len(out), _NONE)
        moved[: max(0, len(out) - step)] = out[step:]
        out = np.minimum(out, moved)
        done += step
    return out


def _best(words: list[bytes], template: set, size: int, starts) -> tuple[float, int]:
    """Largest containment of the template in a window of ``size`` shingles, and its first start."""
    best, place = 0.0, -1
    for at in starts:
        end = min(at + size, len(words) - SHINGLE + 1)
        found = {s for i in range(at, end) if (s := tuple(words[i : i + SHINGLE])) in template}
        share = len(found) / len(template)
        if share > best:
            best, place = share, at
    return best, place


def find_licenses(
    docs: DataFrame, templates: dict[str, str] | None = None, id_col: str = "doc_id", text_col: str = "text",
    containment: float = CONTAINMENT,
) -> DataFrame:
    """Templates that a text holds: doc_id, license, containment (best window), first_word (its start).

    A row for each text and template with a window of the template's length that
    holds ``containment`` of its five-word shingles or more. Words are runs of letters
    and digits, A-Z lowered. Null, empty and short texts hold nothing. A null doc_id
    and repeated rows are each reported. No rows: no rows. Other columns are ignored.
    One pass over whole texts, no shuffle.
    """
    templates = TEMPLATES if templates is None else templates

    def run(batches):
        tool = Scanner(templates)
        for batch in batches:
            data, offsets = utf8(batch.column("text"))
            ids, lo = batch.column("doc_id").to_pylist(), 0
            while lo < len(ids):
                hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + BATCH_BYTES, side="right")) - 1)
                texts = [words_of(data[a:b].tobytes()) for a, b in zip(offsets[lo:hi], offsets[lo + 1 : hi + 1])]
                yield _scan(tool, ids[lo:hi], texts, containment)
                lo = hi

    return documents(docs, id_col, text_col).mapInArrow(
        run, "doc_id long, license string, containment double, first_word long"
    )


def _scan(tool: Scanner, ids: list, texts: list[list[bytes]], containment: float) -> pa.RecordBatch:
    sizes = np.array([len(t) for t in texts])
    starts = np.concatenate([[0], np.cumsum(sizes)])
    words = np.array([h for t in texts for h in tool.hashes(t)], np.uint64)
    shingles = shingle_hashes(words)
    # shingles that would cross from one text to the next are none
    for k in range(1, SHINGLE):
        across = starts[1:-1] - k
        shingles[across[(across >= 0) & (across < len(shingles))]] = _NONE
    found: dict[tuple, tuple] = {}
    if len(shingles):
        seen = set()
        for at, size, step, name in tool.candidates(shingles):
            # texts that the window touches
            first = int(np.searchsorted(starts, at, side="right")) - 1
            for text in range(first, int(np.searchsorted(starts, min(at + size, starts[-1] - 1), side="right"))):
                low, high = max(0, at - step - starts[text]), min(sizes[text] - SHINGLE + 1, at + step + 1 - starts[text])
                todo = [i for i in range(low, max(high, low + 1) if sizes[text] >= SHINGLE else low) if (text, name, i) not in seen]
                seen.update((text, name, i) for i in todo)
                best = _best(texts[text], tool.sets[name], size, todo)
                old = found.get((text, name), (0.0, -1))
                found[text, name] = min((old, best), key=lambda x: (-x[0], x[1] if x[1] >= 0 else 1 << 60))
    rows = [(ids[t], name, share, at) for (t, name), (share, at) in sorted(found.items()) if share >= containment]
    doc, name, share, at = zip(*rows, strict=True) if rows else [()] * 4
    return pa.record_batch(
        [pa.array(doc, pa.int64()), pa.array(name, pa.string()), pa.array(share, pa.float64()), pa.array(at, pa.int64())],
        ["doc_id", "license", "containment", "first_word"],
    )
