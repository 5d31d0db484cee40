"""Token counts by section with offset-mapped attribution.

Each document is encoded once, as a whole (cutting it first would change the tokens at the
cuts). A byte-level token stands for a known number of bytes, so running sums give the byte span
of every token; the spans are joined to the sections of the document by their bounds. A token
that crosses a bound is counted once, by the rule:

``first``     the section that holds its first byte,
``last``      the section that holds its last byte,
``majority``  the section that holds most of its bytes, the earlier one of equals.

Sections are character ranges ``[start, end)``, in order, without overlap. Without a section
column they are the lines of the text, each with its line feed, so they tile it. Tokens that no
section holds (in gaps) are counted in a row with a null section.

Defined results: a null text counts as empty; a text without characters has no lines and gives no
row; a section without tokens gives a row with 0; rows that repeat are counted row by row; a null
section list counts as no sections. Characters count as code points.
"""

from __future__ import annotations

import base64
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .textkit import blocks

RULES = ("first", "last", "majority")

#: Fixed value: the pattern that cuts texts before the merges of the rank files.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def load_encoding(path: str):
    """The byte-level encoding of a rank file and the number of bytes of each id."""
    import tiktoken

    with open(path, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    encoding = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    size = np.zeros(max(ranks.values()) + 1, np.int64)
    for token, i in ranks.items():
        size[i] = len(token)
    return encoding, size


def line_bounds(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    ends = np.flatnonzero(raw == 10) + 1
    if len(raw) and (not len(ends) or ends[-1] < len(raw)):
        ends = np.append(ends, len(raw))
    return np.concatenate(([0], ends[:-1])).astype(np.int64) if len(ends) else ends, ends


def attribute(begin: np.ndarray, end: np.ndarray, starts: np.ndarray, ends: np.ndarray, rule: str) -> np.ndarray:
    """The section of each token (-1: none), by the byte bounds of tokens and sections."""
    def holding(place):
        at = np.searchsorted(starts, place, "right") - 1
        return np.where((at >= 0) & (place < ends[np.maximum(at, 0)]) if len(ends) else False, at, -1)

    first, last = holding(begin), holding(end - 1)
    if rule == "first":
        return first
    if rule == "last":
        return last
    out = first.copy()
    for i in np.flatnonzero((first != last) | (first < 0)).tolist():
        lo, hi = np.searchsorted(ends, begin[i], "right"), np.searchsorted(starts, end[i], "left")
        held = np.minimum(ends[lo:hi], end[i]) - np.maximum(starts[lo:hi], begin[i])
        out[i] = lo + int(np.argmax(held)) if len(held) and held.max() > 0 else -1
    return out


def _count(batches, path: str, rule: str, given: bool):
    encoding, size = load_encoding(path)
    for batch in batches:
        for row, data, off in blocks(batch.column(1)):
            parts = []
            for i in range(len(off) - 1):
                raw = data[off[i]:off[i + 1]]
                ids = np.asarray(encoding.encode_to_numpy(raw.tobytes().decode(), disallowed_special=()), np.int64)
                end = np.cumsum(size[ids])
                begin = end - size[ids]
                chars = np.concatenate(([0], np.cumsum((raw & 0xC0) != 0x80)))
                if given:
                    own = batch.column(2)[row + i].as_py() or []
                    starts = np.searchsorted(chars, [s["start"] for s in own], "left")
                    ends = np.searchsorted(chars, [s["end"] for s in own], "left")
                else:
                    starts, ends = line_bounds(raw)
                to = attribute(begin, end, starts, ends, rule)
                count = np.bincount(to[to >= 0], minlength=len(starts))
                crossing = (np.searchsorted(starts, begin, "right") != np.searchsorted(starts, end - 1, "right"))
                crossed = np.bincount(to[crossing & (to >= 0)], minlength=len(starts))
                gap = int((to < 0).sum())
                number = list(range(len(starts))) + [None] * (gap > 0)
                parts.append((i, number, chars[starts].tolist() + [None] * (gap > 0), chars[ends].tolist() + [None] * (gap > 0),
                              count.tolist() + [gap] * (gap > 0), crossed.tolist() + [0] * (gap > 0)))
            rows = [i for p in parts for i in [p[0]] * len(p[1])]
            ids = batch.column(0).slice(row, len(off) - 1).take(pa.array(rows, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [ids, *(pa.array([x for p in parts for x in p[k]], pa.int64()) for k in range(1, 6))],
                ["doc_id", "section", "start_char", "end_char", "n_tokens", "n_crossing"])


def section_tokens(docs: DataFrame, path: str, rule: str = "first", id_col: str = "doc_id",
                   text_col: str = "text", section_col: str | None = None) -> DataFrame:
    """Per document and section: id, ``section`` (from 0), ``start_char``, ``end_char``,
    ``n_tokens`` and ``n_crossing`` (those of them that cross a bound)."""
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")
    columns = [id_col, text_col] + ([section_col] if section_col else [])
    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(*columns).mapInArrow(
        partial(_count, path=path, rule=rule, given=section_col is not None),
        f"doc_id {kind}, section long, start_char long, end_char long, n_tokens long, n_crossing long",
    ).withColumnRenamed("doc_id", id_col)
