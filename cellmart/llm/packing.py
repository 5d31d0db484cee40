"""Packing token sequences into as few training sequences as possible by minimum bin slack.

1. Every text is encoded whole and closed by an end token. A longer one than ``capacity`` is cut from
   the back into full pieces, so only its first piece may be shorter. Tasks number their pieces of each length.
2. A packing depends on the lengths alone. Their histogram (``capacity`` numbers at any size of the
   input) goes to the driver, where ``minimum_bin_slack`` fills one bin after the other: the longest piece left
   and, by a subset-sum bitset over the lengths that are left, the fullest combination beside it. Bins that
   repeat are planned at once: a combination is taken as often as its lengths last. After that one of its lengths
   has fewer pieces than the combination takes of it, so a length limits a plan at most some
   log2(capacity / length) times: the plan has a few entries a length, however many bins it fills.
3. A piece's rank among all pieces of its length is its rank in its task plus the pieces of earlier
   tasks. The plan gives every rank its bin and place. So a length that a third of all pieces share
   is spread like any other; no task sees all pieces of a length, and no bin is built in one place.

Ids are those of the tokenizers library for the file (byte-level BPE, special tokens' strings in a text
are special tokens); the merges are applied by tiktoken, on ranks read from the same file.

Defined results: a null text is empty and has one piece, the end token. Rows that repeat an id are packed
each; a null id stays null. An empty table has no pieces. Other columns are ignored.
"""

from __future__ import annotations

import json
import zlib
from array import array
from collections import defaultdict
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .tables import written

CAPACITY, END = 1024, 2
#: How byte-level vocabularies split a text before merging.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
FLUSH_PIECES = 1 << 16


class Encoder:
    """Ids of whole texts for a byte-level BPE file."""

    def __init__(self, path: str):
        import tiktoken

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        # Printable bytes stand for themselves, the others for the characters from 256 on, in order.
        shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
        other = [b for b in range(256) if b not in set(shown)]
        byte = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(other)}
        self.specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
        ranks = {bytes(byte[c] for c in token): i for token, i in spec["model"]["vocab"].items() if token not in self.specials}
        self.core = tiktoken.Encoding("packing", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=self.specials)

    def ids(self, text: str) -> array:
        if any(s in text for s in self.specials):
            return array("I", self.core.encode(text, allowed_special="all"))
        return array("I", self.core.encode_ordinary(text))


def _pieces(batches, path: str, end: int, capacity: int, keep_ids: bool):
    encoder, part, seen = Encoder(path), TaskContext.get().partitionId(), defaultdict(int)
    columns = ["piece", "start", "length", "ids_crc32", "rank"]

    def block(rows, out, ids):
        arrays = [rows, *[pa.array(out[c], pa.int32() if c == "piece" else pa.int64()) for c in columns], pa.array([part] * len(rows), pa.int32())]
        names = ["doc_id", *columns, "part"]
        return pa.RecordBatch.from_arrays(arrays + [pa.array(ids, pa.binary())] * keep_ids, names + ["ids"] * keep_ids)

    for batch in batches:
        at, out, ids = [], defaultdict(list), []
        for row, text in enumerate(batch.column(1)):
            tokens = encoder.ids(text.as_py() or "")
            tokens.append(end)
            raw, begin = memoryview(tokens).cast("B"), 0
            stop = (len(tokens) - 1) % capacity + 1
            piece = 0
            while begin < len(tokens):
                at.append(row)
                size = stop - begin
                for c, v in zip(columns, (piece, begin, size, zlib.crc32(raw[4 * begin:4 * stop]), seen[size])):
                    out[c].append(v)
                if keep_ids:
                    ids.append(bytes(raw[4 * begin:4 * stop]))
                seen[size] += 1
                begin, stop, piece = stop, stop + capacity, piece + 1
            if len(at) >= FLUSH_PIECES or keep_ids and len(at) >= FLUSH_PIECES >> 6:
                yield block(batch.column(0).take(pa.array(at)), out, ids)
                at, out, ids = [], defaultdict(list), []
        if at:
            yield block(batch.column(0).take(pa.array(at)), out, ids)


def fullest(counts: dict[int, int], room: int) -> dict[int, int]:
    """The combination of available lengths with the greatest sum up to ``room``. Bit ``s`` of the set says
    that some lengths add up to ``s``; long ones come first, and none is added once the room can be filled."""
    reach, steps, limit = 1, [], (1 << room + 1) - 1
    for length in sorted(counts, reverse=True):
        copies = min(counts[length], room // length)
        if not copies:
            continue
        steps.append((length, copies, reach))
        # Bounded copies by doubling: 1, 2, 4, ..., rest.
        block = 1
        while copies:
            take = min(block, copies)
            reach |= reach << take * length & limit
            copies -= take
            block *= 2
        if reach >> room & 1:
            break
    total, chosen = reach.bit_length() - 1, {}
    for length, copies, before in reversed(steps):
        used = next(m for m in range(copies + 1) if m * length <= total and before >> total - m * length & 1)
        if used:
            chosen[length] = used
            total -= used * length
    return chosen


def minimum_bin_slack(counts: dict[int, int], capacity: int) -> list[tuple[dict[int, int], int]]:
    """(combination, bins that take it) until all pieces are packed."""
    left, plan = {k: n for k, n in counts.items() if n}, []
    while left:
        longest = max(left)
        left[longest] -= 1
        chosen = fullest({k: n for k, n in left.items() if n}, capacity - longest)
        left[longest] += 1
        chosen[longest] = chosen.get(longest, 0) + 1
        times = min(left[k] // m for k, m in chosen.items())
        plan.append((chosen, times))
        for k, m in chosen.items():
            left[k] -= m * times
            if not left[k]:
                del left[k]
    return plan


def slots(plan: list[tuple[dict[int, int], int]]) -> np.ndarray:
    """Rows (length, first rank, first bin, copies in a bin, offset of the first copy), sorted."""
    rows, ranks, bins = [], defaultdict(int), 0
    for chosen, times in plan:
        place = 0
        for length in sorted(chosen, reverse=True):
            copies = chosen[length]
            rows.append((length, ranks[length], bins, copies, place))
            ranks[length] += copies * times
            place += copies * length
        bins += times
    return np.array(sorted(rows), np.int64).reshape(-1, 5)


def _place(batches, table: np.ndarray):
    # Starts of the slots' ranks as one rising key; ranks are far below 2**48.
    key = (table[:, 0] << 48) + table[:, 1]
    for batch in batches:
        length, rank = (batch.column(c).to_numpy() for c in ("length", "rank"))
        slot = table[np.searchsorted(key, (length << 48) + rank, "right") - 1]
        turn = rank - slot[:, 1]
        kept = [n for n in batch.schema.names if n != "rank"]
        yield pa.RecordBatch.from_arrays(
            [*[batch.column(n) for n in kept], pa.array(slot[:, 2] + turn // slot[:, 3]), pa.array(slot[:, 4] + turn % slot[:, 3] * length)],
            [*kept, "sequence_id", "offset"])


def pack(docs: DataFrame, path: str, capacity: int = CAPACITY, end: int = END, id_col: str = "doc_id",
         text_col: str = "text", keep_ids: bool = False) -> DataFrame:
    """Per piece: id, piece (from 0), start (its document's ids before it), length, ids_crc32, the sequence that
    holds it and its offset there; with ``keep_ids`` also its ids (little-endian unsigned 32-bit)."""
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, rank long, part int" + ", ids binary" * keep_ids
    pieces = written(docs.select(id_col, text_col).mapInArrow(
        partial(_pieces, path=path, end=end, capacity=capacity, keep_ids=keep_ids), schema), "packing-pieces")
    counts = written(pieces.groupBy("part", "length").agg(F.count("*").alias("n")), "packing-counts")
    histogram = counts.groupBy("length").agg(F.sum("n").alias("n")).collect()
    table = slots(minimum_bin_slack({r["length"]: r["n"] for r in histogram}, capacity))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    ranked = pieces.join(base, ["part", "length"]).select(
        "doc_id", "piece", "start", "length", "ids_crc32", *["ids"] * keep_ids, (F.col("rank") + F.col("base")).alias("rank"))
    out = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long" + ", ids binary" * keep_ids + ", sequence_id long, offset long"
    return ranked.mapInArrow(partial(_place, table=table), out).withColumnRenamed("doc_id", id_col)
