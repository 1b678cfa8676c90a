"""License scan: MinHash bands over text windows, exact shingle containment.

Templates are license statements and texts.  Texts are read in overlapping
windows of a few widths, an eighth of the width apart; the widths grow by a
fifth, and a template belongs to the least width that holds it.  ``BANDS`` bands
of ``ROWS`` MinHash values are the keys of one table of all templates; the bands
of a window that are in that table under its width retrieve the templates to
verify, whatever their number.  A passage that contains 75 % of a template's
five-word shingles has, in the window nearest to it, a Jaccard similarity of at
least 0.68 / 1.52 = 0.44 with the template, so some band agrees with probability
``1 - (1 - 0.44**2)**48 > 0.9999``.  Retrieved pairs are verified by the exact
share of the template's shingles in the window and its margins.

Only windows with a shingle of a template of their width are hashed: in any other, no minimum
can be a template's.

Defined results: null and empty texts and texts shorter than five words match
nothing; of overlapping windows of one template the best, then the first,
stands; of templates of one license a match inside a longer one is told once;
repeated rows each give their rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from loadstone.llm.decontam import trimmed_words
from loadstone.llm.textnum import buffers, mix, shingles, slices

BANDS, ROWS = 48, 2
GROWTH = 1.2  # from one width of windows to the next
SHARE = 0.75
WIDTH = 5

#: License statements and texts.
TEMPLATES: dict[str, list[str]] = {
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.',
    ],
    "MIT": [
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.',
    ],
    "BSD-3-Clause": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    ],
    "ISC": ["Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ],
    "GPL-2.0": ["This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."],
    "Unlicense": ["This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."],
    "CC-BY-4.0": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "CC-BY-SA-4.0": ["Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
}


def _signature(values: np.ndarray) -> np.ndarray:
    """(windows, BANDS): band hashes of rows of shingles."""
    out = np.empty((len(values), BANDS), dtype=np.uint64)
    for band in range(BANDS):
        key = np.zeros(len(values), dtype=np.uint64)
        for row in range(ROWS):
            seed = np.uint64(0x9E3779B97F4A7C15 * (band * ROWS + row + 1) & 0xFFFFFFFFFFFFFFFF)
            key = mix(key + mix(values ^ seed).min(axis=1))
        out[:, band] = key
    return out


def _words(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(shingles, first shingle of each text, words of each text)."""
    data, offsets = buffers(pa.array(texts, pa.string()))
    hashes, _, first = trimmed_words(data, offsets)
    values, at = shingles(hashes, first, WIDTH)
    return values, at, np.diff(first)


def width_class(size: int) -> int:
    """The width of windows for templates of so many shingles."""
    width = 1
    while width < size:
        width = max(width + 1, int(width * GROWTH))
    return width


class Templates:
    def __init__(self, templates: dict[str, list[str]] | None = None):
        pairs = [(name, text) for name, texts in (TEMPLATES if templates is None else templates).items() for text in texts]
        values, at, n_words = _words([t for _, t in pairs])
        chosen = [i for i, n in enumerate(n_words) if n >= WIDTH]
        self.names = [pairs[i][0] for i in chosen]
        self.sets = [np.unique(values[at[i] : at[i + 1]]) for i in chosen]
        self.all = np.unique(np.concatenate([np.zeros(0, np.uint64), *self.sets]))
        self.low = np.zeros(1 << 16, dtype=bool)
        self.low[(self.all & np.uint64(0xFFFF)).astype(np.int64)] = True
        # by width: the sorted band keys of its templates, whose each is, and the shingles of these templates
        self.tables: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        widths = np.array([width_class(at[i + 1] - at[i]) for i in chosen], dtype=np.int64)
        for width in np.unique(widths).tolist():
            own = np.flatnonzero(widths == width)
            keys = np.concatenate([_signature(values[at[chosen[t]] : at[chosen[t] + 1]][None, :])[0] for t in own])
            owner = np.repeat(own, BANDS)
            order = np.argsort(keys, kind="stable")
            self.tables[width] = (keys[order], owner[order], np.unique(np.concatenate([self.sets[t] for t in own])))

    def retrieved(self, values: np.ndarray, hit: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
        """(template, start, width, step) of windows that share a band with a template."""
        for width, (keys, owner, known) in self.tables.items():
            own = hit[np.isin(values[hit], known)]
            if not len(own):
                continue
            step = max(1, width // 8)
            size = min(width, len(values))
            # windows of the grid that touch a hit; the last window ends with the text
            starts = np.unique((own[:, None] // step - np.arange(-(-size // step) + 1)[None, :]) * step)
            starts = np.unique(np.clip(starts, 0, len(values) - size))
            for k in range(0, len(starts), 4096):
                some = starts[k : k + 4096]
                bands = _signature(values[some[:, None] + np.arange(size)])
                a, b = np.searchsorted(keys, bands, "left"), np.searchsorted(keys, bands, "right")
                window, band = np.nonzero(b > a)
                found = {(int(t), int(some[w])) for w, j in zip(window, band, strict=True) for t in owner[a[w, j] : b[w, j]]}
                for t, s in sorted(found):
                    yield t, s, size, step

    def scan(self, values: np.ndarray) -> Iterator[tuple[int, int, int, float]]:
        """(template, first shingle, last shingle + 1, share) in one text's shingles."""
        hit = np.flatnonzero(self.low[(values & np.uint64(0xFFFF)).astype(np.int64)])
        hit = hit[np.isin(values[hit], self.all)]
        if not len(hit):
            return
        spans: dict[int, list[tuple[int, int, float]]] = {}
        mine: dict[int, np.ndarray] = {}
        for t, s, size, step in self.retrieved(values, hit):
            own = mine[t] = mine[t] if t in mine else hit[np.isin(values[hit], self.sets[t])]
            a, b = np.searchsorted(own, (s - step, s + size + step))
            share = len(np.unique(values[own[a:b]])) / len(self.sets[t])
            if share >= SHARE:
                spans.setdefault(t, []).append((int(own[a]), int(own[b - 1]) + 1, share))
        for t, found in sorted(spans.items()):
            best = None
            for span in sorted(set(found)):
                if best and span[0] < last:
                    best = span if span[2] > best[2] else best
                else:
                    if best:
                        yield t, *best
                    best, last = span, 0
                last = max(last, span[1])
            yield t, *best


def scan_licenses(docs: DataFrame, templates: dict[str, list[str]] | None = None) -> DataFrame:
    """doc_id, license, start_word, end_word, containment of each match in docs (doc_id, text)."""
    held = docs.sparkSession.sparkContext.broadcast(Templates(templates))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = held.value
        for batch in batches:
            data, offsets = buffers(batch.column(1))
            found: list[tuple[int, str, int, int, float]] = []
            for a, b in slices(offsets):
                part = data[offsets[a] : offsets[b]]
                hashes, _, first = trimmed_words(part, offsets[a : b + 1] - offsets[a])
                values, at = shingles(hashes, first, WIDTH)
                near = np.flatnonzero(known.low[(values & np.uint64(0xFFFF)).astype(np.int64)])
                near = near[np.isin(values[near], known.all)]
                for i in np.unique(np.searchsorted(at, near, side="right") - 1).tolist():
                    if first[i + 1] - first[i] < WIDTH:
                        continue
                    best: dict[str, list] = {}
                    for t, s, e, share in known.scan(values[at[i] : at[i + 1]]):
                        best.setdefault(known.names[t], []).append((s, e + WIDTH - 1, share))
                    for name, spans in sorted(best.items()):
                        end = -1
                        for s, e, share in sorted(spans, key=lambda x: (x[0], -x[1])):
                            if s >= end:  # a statement inside a longer one is told once
                                found.append((a + i, name, s, e, share))
                                end = e
            rows = pa.array([f[0] for f in found], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(rows), pa.array([f[1] for f in found], pa.string()), pa.array([f[2] for f in found], pa.int32()), pa.array([f[3] for f in found], pa.int32()), pa.array([f[4] for f in found], pa.float64())], names=["doc_id", "license", "start_word", "end_word", "containment"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, license string, start_word int, end_word int, containment double")
