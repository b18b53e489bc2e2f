"""License notices: MinHash bands over overlapping windows, then containment.

A template is a notice's words as shingles of five words (a shorter notice is
one shingle of all its words). Templates of similar length share a scale: the
power of two, m, that their shingle count does not exceed. At each scale a
document's shingles are cut into windows of 2m that start every m, so every
occurrence lies wholly inside some window. A window that contains 3/4 of a
template's shingles has at least the Jaccard similarity ``least_similarity``
with it; the number of one-row bands is chosen from that so that the window
misses the template in all bands with a probability of at most ``MISS``. A
window that collides in any band is then verified: the share of the template's
shingles that occur in it, counted exactly.

A window without any template shingle shares no MinHash value with a template,
so signatures are computed only for windows that hold one.

All work is inside the scan of the documents: templates are a fixed list.

Defined results: null and empty texts match nothing. Repeated rows are scanned
each on its own, a null doc_id stays null, an empty table gives an empty
result. A notice that occurs often is one match of that template (its best
window, the first of equals). Other columns are not read.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import byte_codes, lower_ascii_table, mix64, shingle_hashes, slices, words_of

SHINGLE, CONTAINMENT, MISS = 5, 0.75, 1e-4

# Public license notices, as written by their stewards.
NOTICES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("all-rights-reserved", "All rights reserved."),
]

MATCH = "array<struct<license:string,template:int,containment:double,start:int,stop:int>>"
_MATCH_TYPE = pa.list_(pa.struct([("license", pa.string()), ("template", pa.int32()), ("containment", pa.float64()), ("start", pa.int32()), ("stop", pa.int32())]))


def scale_of(shingles: int) -> int:
    return 1 << max(0, shingles - 1).bit_length()


def least_similarity(containment: float = CONTAINMENT) -> float:
    """The least Jaccard similarity of a window of 2m shingles and a template of
    more than m/2 that it contains to the given share."""
    return containment / (4 + (1 - containment))


def bands_for(similarity: float, rows: int = 1, miss: float = MISS) -> int:
    """The fewest bands of ``rows`` rows that miss a pair of that similarity with
    probability ``miss`` at most."""
    return math.ceil(math.log(miss) / math.log(1 - similarity**rows))


@functools.lru_cache(maxsize=1)
def _tables() -> tuple[np.ndarray, np.ndarray]:
    is_word = np.zeros(256, np.int8)
    is_word[48:58] = is_word[97:123] = is_word[65:91] = is_word[128:] = 1
    return is_word, byte_codes(10)[lower_ascii_table()]


def word_hashes(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    _, _, rows, hashes = words_of(data, at, *_tables())
    return rows, hashes


class Index:
    """Templates by shingle size and scale, with their band signatures."""

    def __init__(self, notices: list[tuple[str, str]], containment: float = CONTAINMENT):
        self.notices, self.containment = notices, containment
        bands = bands_for(least_similarity(containment))
        seeds = np.random.default_rng(10).integers(0, 1 << 63, bands, dtype=np.uint64)
        self.seeds = seeds * np.uint64(2) + np.uint64(1)
        self.sets: list[np.ndarray] = []
        self.lanes: dict[int, dict[int, list[int]]] = {}
        for i, (_, text) in enumerate(notices):
            raw = np.frombuffer(text.encode(), np.uint8)
            _, words = word_hashes(raw, np.array([0, len(raw)]))
            if not len(words):
                raise ValueError(f"notice {i} has no word")
            size = min(SHINGLE, len(words))
            self.sets.append(np.unique(shingle_hashes(words, size)))
            self.lanes.setdefault(size, {}).setdefault(scale_of(len(self.sets[-1])), []).append(i)
        self.known = {size: np.unique(np.concatenate([self.sets[i] for ids in scales.values() for i in ids])) for size, scales in self.lanes.items()}
        self.signatures = [self.signature(s) for s in self.sets]

    def signature(self, shingles: np.ndarray) -> np.ndarray:
        return mix64(shingles[None, :] * self.seeds[:, None] + (self.seeds[:, None] >> np.uint64(7))).min(1)

    def windows(self, hashes: np.ndarray, rows: np.ndarray, size: int) -> Iterator[tuple[int, int, int, int]]:
        """(row, scale, first shingle, shingle behind the last) of windows with a known shingle."""
        grams = shingle_hashes(hashes, size)
        if not len(grams):
            return
        known = self.known[size]
        spot = np.minimum(np.searchsorted(known, grams), len(known) - 1)
        hits = np.flatnonzero((known[spot] == grams) & (rows[: len(grams)] == rows[size - 1 :]))
        if not len(hits):
            return
        row = rows[hits]
        first = np.searchsorted(rows, row, "left")
        end = np.searchsorted(rows, row, "right") - size + 1
        for scale in self.lanes[size]:
            number = (hits - first) // scale
            pairs = {(int(r), int(f), int(e), int(j)) for r, f, e, n in zip(row, first, end, number) for j in (n - 1, n) if j >= 0}
            for r, f, e, j in sorted(pairs):
                yield r, scale, f + j * scale, min(e, f + (j + 2) * scale)

    def matches(self, data: np.ndarray, at: np.ndarray) -> list[list[dict]]:
        """Each text's verified templates, by number."""
        rows, hashes = word_hashes(data, at)
        best: list[dict[int, dict]] = [{} for _ in range(len(at) - 1)]
        for size, scales in self.lanes.items():
            grams = shingle_hashes(hashes, size)
            for row, scale, start, stop in self.windows(hashes, rows, size):
                window = grams[start:stop]
                signature = self.signature(window)
                for i in scales[scale]:
                    if not (signature == self.signatures[i]).any():
                        continue
                    inside = np.flatnonzero(np.isin(window, self.sets[i]))
                    share = len(np.unique(window[inside])) / len(self.sets[i])
                    if share >= self.containment and share > best[row].get(i, {"containment": 0})["containment"]:
                        text_start = int(np.searchsorted(rows, row))
                        best[row][i] = {"license": self.notices[i][0], "template": i, "containment": share, "start": start + int(inside[0]) - text_start, "stop": start + int(inside[-1]) + size - text_start}
        return [[found[i] for i in sorted(found)] for found in best]


def scan_licenses(docs: DataFrame, notices: list[tuple[str, str]] | None = None, containment: float = CONTAINMENT) -> DataFrame:
    """One row per row: doc_id, n_licenses, licenses (sorted names, comma-joined), matches."""
    notices = NOTICES if notices is None else notices

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Index(notices, containment)
        for batch, data, at in slices(batches, most=2 << 20):
            found = index.matches(data, at)
            names = [sorted({m["license"] for m in f}) for f in found]
            columns = [batch.column(0), pa.array([len(n) for n in names], pa.int32()), pa.array([",".join(n) for n in names]), pa.array(found, _MATCH_TYPE)]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_licenses", "licenses", "matches"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(scan, f"doc_id long, n_licenses int, licenses string, matches {MATCH}")
