"""License scans: MinHash bands over text windows, then exact shingle containment.

Texts and templates are lower-cased runs of letters and digits; shingles are
``SHINGLE`` words. A template is cut into windows of 1, 4 or 16 shingles (the largest
that fits, ends aligned), and every text into windows of the same sizes, at a stride of
an eighth of the size (one shingle at least), so that some window lies within a
sixteenth of every place. Windows are compared by MinHash in ``BANDS`` bands of
``ROWS`` values; a window that collides with a template window retrieves the template.

The bands are set for recall. If a text holds a share of 0.8 of a template's shingles
in place, one template window has that share at least. For 4 shingles that means all
four (collides surely); for 16 it means 13 of them, 12 of which the nearest text window
has, of 20 in both: similarity 0.6, so a band collides with chance 0.36 and any of 24
with 1 - 0.64 ** 24 > 0.9999. ``collision_chance`` gives the figure.

Verification is exact: of the template's distinct shingles (the words themselves), the
share found in the text around the window must reach ``CONTAINMENT``. Candidates only
come from real collisions, so a text pays for its license lines, not for its length.
Templates are a parameter of the scan and small; they travel with the job. There is no
shuffle.

Defined cases: null and empty texts, and texts or templates of fewer than ``SHINGLE``
words, have no match; repeated rows are scanned each; an empty table gives an empty
result; only key and text are read; texts are scanned whole, in one pass per text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import chunked, col

SHINGLE = 5
CONTAINMENT = 0.8
SIZES = (1, 4, 16)
BANDS = 24
ROWS = 2
SEED = 9

# Notices and license texts as their publishers word them.
TEMPLATES: dict[str, str] = {
    "MIT-line": "Released under the MIT License.",
    "Apache-2.0-line": "Licensed under the Apache License, Version 2.0.",
    "GPL-3.0-line": "This work is licensed under the GNU General Public License, version 3.",
    "CC-BY-NC-4.0-line": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0-line": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-SA-4.0-line": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "MIT": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
        "Software, and to permit persons to whom the Software is furnished to do so, subject to the following "
        "conditions: The above copyright notice and this permission notice shall be included in all copies or "
        "substantial portions of the Software."),
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 "
        "Unless required by applicable law or agreed to in writing, software distributed under the License is "
        "distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See "
        "the License for the specific language governing permissions and limitations under the License."),
    "GPL-3.0-or-later": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY "
        "WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU "
        "General Public License for more details."),
    "BSD-2-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met: Redistributions of source code must retain the above copyright notice, this "
        "list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above "
        "copyright notice, this list of conditions and the following disclaimer in the documentation and/or other "
        "materials provided with the distribution."),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies."),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was "
        "not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    "Unlicense": (
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, "
        "publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, "
        "for any purpose, commercial or non-commercial, and by any means."),
}

_P = 0x9E3779B97F4A7C15 | 1
_WORD_BYTES = np.zeros(256, bool)
_WORD_BYTES[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_TOKEN = re.compile(rb"[0-9A-Za-z\x80-\xff]+")


def collision_chance(similarity: float, bands: int = BANDS, rows: int = ROWS) -> float:
    """Chance that two windows of this Jaccard similarity share a band."""
    return 1.0 - (1.0 - similarity ** rows) ** bands


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _inverse_powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base modulo 2**64, and their inverses."""
    inverse = pow(_P, -1, 1 << 64)
    up, down = np.full(n, _P, np.uint64), np.full(n, inverse, np.uint64)
    up[:1], down[:1] = 1, 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


def _word_hashes(data: np.ndarray, powers: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, start, end) of the words in a byte array, case folded."""
    inside = _WORD_BYTES[data]
    edge = np.flatnonzero(np.diff(np.concatenate(([False], inside, [False])).astype(np.int8)))
    start, end = edge[0::2], edge[1::2]
    up, down = powers
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((_FOLD[data].astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=total[1:])
    return _mix((total[end] - total[start]) * down[start]), start, end


def _shingle_hashes(words: np.ndarray) -> np.ndarray:
    """Hashes of the runs of ``SHINGLE`` words."""
    n = len(words) - SHINGLE + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    h = np.zeros(n, np.uint64)
    for k in range(SHINGLE):
        h = h * np.uint64(_P) + words[k:k + n]
    return _mix(h)


def _bands(shingles: np.ndarray, starts: np.ndarray, size: int) -> Iterator[np.ndarray]:
    """The key of each band, for the windows of ``size`` shingles at ``starts``."""
    for band in range(BANDS):
        key = np.full(len(starts), band * 3 + 1, np.uint64)
        for row in range(ROWS):
            value = _mix(shingles ^ _mix(np.array([SEED + band * ROWS + row], np.uint64)))
            width = 1
            while width < size:  # minimum over the window by doubling (sizes are powers of two)
                value = np.minimum(value[: len(value) - width], value[width:])
                width *= 2
            key = _mix(key * np.uint64(_P) + value[starts])
        yield key


def _template_starts(n: int, size: int) -> np.ndarray:
    starts = list(range(0, n - size + 1, size))
    return np.array(sorted({*starts, n - size}))


def compile_templates(templates: Mapping[str, str]) -> dict:
    """Index of the template windows: per size the sorted band keys and whose they are."""
    names, words, exact = [], [], []
    keys = {s: ([], [], []) for s in SIZES}     # band key, template, place in words
    for name, text in templates.items():
        data = text.encode()
        tokens = [t.lower() for t in _TOKEN.findall(data)]
        if len(tokens) < SHINGLE:
            continue
        at = len(names)
        names.append(name)
        words.append(len(tokens))
        exact.append(frozenset(zip(*(tokens[k:] for k in range(SHINGLE)))))
        array = np.frombuffer(data, np.uint8)
        hashes, _, _ = _word_hashes(array, _inverse_powers(len(array) + 1))
        shingles = _shingle_hashes(hashes)
        size = max(s for s in SIZES if s <= len(shingles))
        starts = _template_starts(len(shingles), size)
        for key in [next(_bands(shingles, starts, 1))] if size == 1 else _bands(shingles, starts, size):
            keys[size][0].append(key)
            keys[size][1].append(np.full(len(starts), at))
            keys[size][2].append(starts)
    index = {}
    for size, parts in keys.items():
        if parts[0]:
            key, owner, place = (np.concatenate(p) for p in parts)
            order = np.argsort(key)
            index[size] = (key[order], owner[order], place[order])
    return {"names": names, "words": words, "shingles": exact, "index": index}


def _candidates(shingles: np.ndarray, index: dict) -> set[tuple[int, int]]:
    """(template, first word it may start at) for every colliding window."""
    out: set[tuple[int, int]] = set()
    for size, (keys, owner, place) in index.items():
        if len(shingles) == 0:
            continue
        fits = min(size, len(shingles))
        if fits < size:     # a text shorter than the window: padded with its last shingle
            padded = np.concatenate((shingles, np.repeat(shingles[-1:], size - fits)))
        else:
            padded = shingles
        stride = max(1, size // 8)
        last = len(padded) - size
        starts = np.unique(np.append(np.arange(0, last + 1, stride), last))
        seen = np.zeros(1 << 16, bool)
        seen[keys >> np.uint64(48)] = True
        found = [next(_bands(padded, starts, 1))] if size == 1 else _bands(padded, starts, size)
        for band in found:
            for w in np.flatnonzero(seen[band >> np.uint64(48)]):
                lo, hi = np.searchsorted(keys, [band[w]], "left")[0], np.searchsorted(keys, [band[w]], "right")[0]
                for k in range(lo, hi):
                    out.add((int(owner[k]), max(0, int(starts[w]) - int(place[k]))))
    return out


def _tightest(held: list[tuple[int, tuple]], n: int) -> tuple[int, int, int]:
    """(distinct shingles, first place, last place) of the run of places that holds every
    distinct shingle of ``held``, none to spare at its start, and is nearest to ``n``
    places long (the end of one copy and the start of the next hold them too)."""
    wanted = len({s for _, s in held})
    count: dict[tuple, int] = {}
    best, i = (held[0][0], held[-1][0]), 0
    off = abs(best[1] - best[0] + 1 - n)
    for place, s in held:
        count[s] = count.get(s, 0) + 1
        while count[held[i][1]] > 1:
            count[held[i][1]] -= 1
            i += 1
        if len(count) == wanted and abs(place - held[i][0] + 1 - n) < off:
            best, off = (held[i][0], place), abs(place - held[i][0] + 1 - n)
    return wanted, *best


def scan_text(data: bytes, words: np.ndarray, start: np.ndarray, end: np.ndarray, compiled: dict,
              containment: float) -> list[tuple[str, float, int, int]]:
    """(license, containment, byte start, byte end) of every region of each license; the
    regions of one license do not overlap, better ones are taken first."""
    by_template: dict[int, list[int]] = {}
    for template, first in sorted(_candidates(_shingle_hashes(words), compiled["index"])):
        by_template.setdefault(template, []).append(first)
    out: list[tuple[int, float, int, int]] = []
    for template, firsts in by_template.items():
        n = compiled["words"][template]
        slack = max(2, n // 4)
        wanted = compiled["shingles"][template]
        taken = bytearray(len(words))

        def regions(first: int) -> Iterator[tuple[float, int, int]]:
            """Per stretch of free words around a candidate: share, first and last word."""
            low, high = max(0, first - slack), min(len(words), first + n + slack)
            tokens = [data[a:b].lower() for a, b in zip(start[low:high], end[low:high])]
            held: list[tuple[int, tuple]] = []
            for k, s in enumerate([*zip(*(tokens[j:] for j in range(SHINGLE))), None], low):
                free = s is not None and not any(taken[k:k + SHINGLE])
                if free and s in wanted:
                    held.append((k, s))
                if not free and held:
                    got, a, b = _tightest(held, n - SHINGLE + 1)
                    if got / len(wanted) >= containment:
                        yield got / len(wanted), a, b + SHINGLE - 1
                    held = []

        found = {region for first in firsts for region in regions(first)}
        ranked = sorted(found, key=lambda r: (-r[0], abs(r[2] - r[1] + 1 - n), r[1]))
        for whole in (True, False):     # then what is left beside the regions taken
            for region in ranked:
                free = [region] if not any(taken[region[1]:region[2] + 1]) else []
                for share, a, b in free if whole else [*regions(region[1])]:
                    taken[a:b + 1] = b"\1" * (b + 1 - a)
                    out.append((template, share, int(start[a]), int(end[b])))
    return [(compiled["names"][t], *region) for t, *region in sorted(out, key=lambda r: (r[0], r[2]))]


def scan(df: DataFrame, key: str = "doc_id", text: str = "text", templates: Mapping[str, str] = TEMPLATES,
         containment: float = CONTAINMENT) -> DataFrame:
    """(key, license, containment, start, end) for every region of a license in a text.

    ``start`` and ``end`` are byte offsets of the region in the UTF-8 text.
    """
    rows = df.select(col(key).alias("_k"), col(text).alias("_t"))
    compiled = compile_templates(templates)
    kind = rows.schema["_k"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunked(batches, 1):
            texts = [t or b"" for t in batch.column(1).cast(pa.binary()).to_pylist()]
            size = np.array([len(t) + 1 for t in texts])
            data = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
            words, start, end = _word_hashes(data, _inverse_powers(len(data) + 1))
            first = np.cumsum(size) - size
            cuts = np.searchsorted(start, np.append(first, len(data)))
            hit = _worth(words, cuts, compiled["index"])
            owner, found = [], []
            for i in hit:
                a, b = cuts[i], cuts[i + 1]
                for match in scan_text(texts[i], words[a:b], start[a:b] - first[i], end[a:b] - first[i], compiled,
                                       containment):
                    owner.append(i)
                    found.append(match)
            names, share, low, high = zip(*found) if found else ((), (), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(owner, pa.int64())), pa.array(names, pa.string()),
                 pa.array(share, pa.float64()), pa.array(low, pa.int64()), pa.array(high, pa.int64())],
                names=["_k", "license", "containment", "start", "end"])

    got = rows.mapInArrow(run, f"_k {kind}, license string, containment double, start long, end long")
    return got.withColumnRenamed("_k", key)


def _worth(words: np.ndarray, cuts: np.ndarray, index: dict) -> np.ndarray:
    """Texts of a chunk with a colliding window: the bands run over the whole chunk at
    once; windows that reach into the next text only add a text to look at."""
    shingles = _shingle_hashes(words)
    hit = np.zeros(len(cuts) - 1, bool)
    # Texts too short for the largest window are looked at one by one, padded.
    short = np.diff(cuts) < SHINGLE + max(index, default=1) - 1
    hit |= short & (np.diff(cuts) >= SHINGLE)
    for size, (keys, _, _) in index.items():
        if len(shingles) < size:
            continue
        seen = np.zeros(1 << 16, bool)
        seen[keys >> np.uint64(48)] = True
        stride = max(1, size // 8)
        starts = np.arange(0, len(shingles) - size + 1)
        if stride > 1:      # strides count from the start of each text, and its last window counts
            begin = np.repeat(cuts[:-1], np.diff(cuts))
            stop = np.repeat(cuts[1:], np.diff(cuts))
            offset = (starts - begin[starts]) % stride
            starts = starts[(offset == 0) | (starts + size + SHINGLE - 1 == stop[starts])]
        found = [next(_bands(shingles, starts, 1))] if size == 1 else _bands(shingles, starts, size)
        for band in found:
            maybe = np.flatnonzero(seen[band >> np.uint64(48)])
            if len(maybe):
                at = np.searchsorted(keys, band[maybe]).clip(0, len(keys) - 1)
                same = keys[at] == band[maybe]
                hit[np.searchsorted(cuts, starts[maybe[same]], "right") - 1] = True
    return np.flatnonzero(hit)
