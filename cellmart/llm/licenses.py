"""License scan: MinHash bands over text windows, verified by exact shingle containment.

A template is the text of a license notice; its set holds its n distinct ``K``-word shingles. A place
matches when ``2 * n`` neighbouring shingles of the text, from any one on, hold at least ``CONTAINMENT`` of
them. Texts are cut into blocks of an eighth of n shingles; as many neighbours as every such run
lies in make a window, so windows start at every block. ``BANDS`` minima of independent hashes are kept for
every block, the least of its blocks' is the window's. A window is retrieved for a template when any
band (one minimum) is equal; in the retrieved stretch the template's distinct shingles are then counted
exactly for the run from every shingle on.

Band settings: a window has at most 2.25 n shingles. One with a match holds ``c >= 0.8`` of the template's
n, so its Jaccard similarity is at least 0.8 / 2.45 = 0.327 and one of 24 bands agrees with
probability 1 - (1 - 0.327)**24 > 0.9999 (``collision_probability``).

All documents are read whole and no row is shuffled: a task keeps the templates' sets (a given
query set) and one block of text. Defined results: words are runs of digits, letters and non-ASCII
characters, A-Z in lower case; null and empty texts match nothing; a template without words is an error;
a document matches a license once, at its best run, the first of equals; rows that repeat are scanned
row by row; other columns are ignored.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .textkit import alphanumeric, blocks, expand, lower_ascii, shingle_hashes, word_hashes

K = 5
CONTAINMENT = 0.8
BANDS = 24

#: Notices of public licenses.
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
     "compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("Apache-2.0", "Unless required by applicable law or agreed to in writing, software distributed under the License is "
     "distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."),
    ("MIT", "Released under the MIT License"),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
     "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
     "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
     "granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
     "following conditions are met"),
    ("GPL", "This work is licensed under the GNU General Public License, version"),
    ("GPL", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
     "License as published by the Free Software Foundation, either version"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was "
     "not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0"),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
]


def collision_probability(similarity: float, bands: int = BANDS) -> float:
    return 1 - (1 - similarity) ** bands


def _multipliers() -> np.ndarray:
    return np.random.default_rng(20240101).integers(0, 1 << 63, BANDS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def template_sets(templates, k: int = K) -> list[tuple[str, np.ndarray]]:
    """(license, sorted distinct shingle hashes) of each template."""
    out = []
    for name, text in templates:
        raw = np.frombuffer(text.encode(), np.uint8)
        words, _, _, first = word_hashes(raw, np.array([0, len(raw)]), alphanumeric(), lower_ascii())
        shingles, _ = shingle_hashes(words, first, k)
        if not len(shingles):
            raise ValueError(f"template of {name} has no words")
        out.append((name, np.unique(shingles)))
    return out


def shape(size: int) -> tuple[int, int]:
    """Shingles of a block, and blocks of a window: any ``2 * size`` neighbours lie in one window."""
    step = max(1, size // 8)
    return step, -(-(2 * size - 1) // step) + 1


def _around(places: np.ndarray, begin: np.ndarray, step: int, wide: int):
    """The blocks that share a window with one of the places: their numbers, rows, first shingles and sizes.
    Blocks of ``step`` shingles are numbered on from each row's start."""
    count = -(-np.diff(begin) // step)
    base = np.concatenate(([0], np.cumsum(count)))
    row = np.searchsorted(begin, places, "right") - 1
    block = np.unique(np.column_stack([base[row] + (places - begin[row]) // step, row]), axis=0)
    low = np.maximum(block[:, 0] - wide + 1, base[block[:, 1]])
    high = np.minimum(block[:, 0] + wide, base[block[:, 1] + 1])
    kept = np.unique(expand(low, high - low))
    row = np.searchsorted(base, kept, "right") - 1
    first = begin[row] + (kept - base[row]) * step
    return kept, row, first, np.minimum(step, begin[row + 1] - first)


def _shifts(number: np.ndarray, row: np.ndarray, blocks_of_window: int):
    """Steps by which minima of ever more blocks meet, and where the next lies in the same row."""
    out, width = [], 1
    while width < blocks_of_window:
        d = min(width, blocks_of_window - width)
        out.append((d, (row[d:] == row[:-d]) & (number[d:] - number[:-d] == d)))
        width += d
    return out


def retrieve(shingles: np.ndarray, begin: np.ndarray, sets) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """(template number, rows, first shingles) of the windows retrieved by a band. A hash multiplies by an odd
    number, which is one to one: a band can agree only where the window holds a shingle of the template.
    So the minima are taken around these places alone; windows elsewhere agree in no band."""
    by_size: dict[int, list[int]] = {}
    for i, (_, own) in enumerate(sets):
        by_size.setdefault(len(own), []).append(i)
    low_bits = np.zeros(1 << 16, bool)
    for _, own in sets:
        low_bits[own.astype(np.uint16)] = True
    places = np.flatnonzero(low_bits[shingles.astype(np.uint16)])
    out = []
    for size, members in by_size.items():
        step, wide = shape(size)
        own = np.concatenate([sets[i][1] for i in members])
        kept, row, first, length = _around(places[np.isin(shingles[places], own)], begin, step, wide)
        if not len(kept):
            continue
        near, start = shingles[expand(first, length)], np.cumsum(length) - length
        shifts = _shifts(kept, row, wide)
        found = {i: np.zeros(len(kept), bool) for i in members}
        for factor in _multipliers():
            least = np.minimum.reduceat(near * factor, start)
            for d, same in shifts:
                least[:-d] = np.where(same, np.minimum(least[:-d], least[d:]), least[:-d])
            for i in members:
                found[i] |= least == (sets[i][1] * factor).min()
        out.extend((i, row[hit], first[hit]) for i, hit in found.items() if hit.any())
    return out


def stretches(rows: np.ndarray, at: np.ndarray, begin: np.ndarray, span: int):
    """(row, first shingle, end) of the unions of overlapping retrieved windows."""
    out: list[list[int]] = []
    for row, lo in zip(rows.tolist(), at.tolist()):
        hi = min(lo + span, int(begin[row + 1]))
        if out and out[-1][0] == row and lo <= out[-1][2]:
            out[-1][2] = hi
        else:
            out.append([row, lo, hi])
    return out


def densest(text: np.ndarray, own: np.ndarray, width: int) -> tuple[int, int, int]:
    """The most distinct shingles of ``own`` that ``width`` neighbours hold, and the first and last
    place of them, in the first run that does."""
    place = np.flatnonzero(np.isin(text, own))
    if not len(place):
        return 0, 0, 0
    order = np.argsort(text[place], kind="stable")
    again = text[place][order][1:] == text[place][order][:-1]
    before = np.full(len(place), -1)
    before[order[1:][again]] = place[order[:-1][again]]
    # A place counts for the runs that reach it and start behind the same shingle's place before.
    change = np.zeros(len(text) + 1, np.int64)
    np.add.at(change, np.maximum(before + 1, place - width + 1), 1)
    np.add.at(change, place + 1, -1)
    count = np.cumsum(change)[:-1]
    start = int(np.argmax(count))
    less = np.flatnonzero(count[start:] < count[start])
    start += (int(less[0]) if len(less) else len(count) - start) - 1
    inside = (place >= start) & (place < start + width) & (before < start)
    return int(count[start]), int(place[inside][0]), int(place[inside][-1])


def _scan(batches, templates, containment: float):
    sets = template_sets(templates)
    fold, keep = lower_ascii(), alphanumeric()
    for batch in batches:
        for row0, data, off in blocks(batch.column(1)):
            words, starts, ends, first = word_hashes(data, off, keep, fold)
            shingles, begin = shingle_hashes(words, first, K)
            best: dict[tuple[int, str], tuple[float, int, int]] = {}
            for i, rows, at in retrieve(shingles, begin, sets) if len(shingles) else ():
                name, own = sets[i]
                step, wide = shape(len(own))
                for row, lo, hi in stretches(rows, at, begin, step * wide):
                    held, start, last = densest(shingles[lo:hi], own, 2 * len(own))
                    share = held / len(own)
                    if share >= containment and share > best.get((row, name), (0.0,))[0]:
                        # From the first to the last word of the matching shingles.
                        a = first[row] + lo + start - begin[row]
                        b = min(first[row] + lo + last - begin[row] + K, first[row + 1]) - 1
                        best[row, name] = (share, int(starts[a]), int(ends[b]))
            if not best:
                continue
            chars = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))
            keys = sorted(best)
            base = [int(chars[off[r]]) for r, _ in keys]
            yield pa.RecordBatch.from_arrays([
                batch.column(0).take(pa.array([row0 + r for r, _ in keys])), pa.array([n for _, n in keys]),
                pa.array([best[k][0] for k in keys]),
                pa.array([int(chars[best[k][1]]) - x for k, x in zip(keys, base)], pa.int64()),
                pa.array([int(chars[best[k][2]]) - x for k, x in zip(keys, base)], pa.int64())],
                ["doc_id", "license", "containment", "start", "end"])


def scan_licenses(docs: DataFrame, templates=TEMPLATES, containment: float = CONTAINMENT, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """One row per document and license found: id, license, containment, start, end (code points)."""
    template_sets(templates)
    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(
        partial(_scan, templates=list(templates), containment=containment),
        f"doc_id {kind}, license string, containment double, start long, end long").withColumnRenamed("doc_id", id_col)
