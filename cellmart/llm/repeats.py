"""Removal of repeated byte strings with a column-wise multi-document suffix order.

Every byte covered by a ``LENGTH``-byte string that also starts anywhere else goes. Strings
never cross documents; overlaps count; strings are judged on the input.

1. Anchors. Each ``LENGTH``-byte window is assigned to the leftmost of its ``GRAM``-byte grams with
   the smallest hash. Equal windows have equal grams, so they are assigned to equal grams at the
   same distance: only windows whose gram occurs again can repeat. Counting the grams that any
   window is assigned to (about one in 70 bytes) drops all unique text before it is moved.
2. Collections. The text around each remaining anchor, cut to the windows assigned to it, goes to
   the task of its gram: a collection of short strings, aligned at the gram.
3. Column-wise construction. A collection's suffix order is built from its last column to its
   first: each round reads one column from a sequential external file (one symbol of every
   string), moves the strings to their places in the order of the suffixes that begin there
   (the Burrows-Wheeler step of all strings at once) and updates the common prefix of every two
   neighbours. Where a neighbour's common prefix reaches ``LENGTH``, the window repeats. As the
   strings are aligned, suffixes are compared within a column only; unaligned ones cannot be
   equal windows.
4. The covered ranges go back to their documents, which are cut.

A gram that occurs in more than ``COLLECTION`` places is split over several collections by a hash
of the place. Each of them reports its repeats and one hash of every different window; counting
those hashes finds the windows that occur in two collections. So a gram that a third of all rows
share is spread over many tasks, and nothing is dropped.

Defined results: a null text counts as empty; texts under ``LENGTH`` bytes lose nothing; rows that
repeat an id and a text are separate documents and so lose every byte of a long text; documents of
any length are read in overlapping parts of ``textkit.BLOCK_BYTES``; other columns are ignored.
"""

from __future__ import annotations

import tempfile
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import written
from .textkit import BLOCK_BYTES, blocks, expand, mix, powers, prefix_sums

LENGTH = 200
GRAM = 64
COLLECTION = 4096
BATCH = 8192

# A mark is one number: the anchor's place, the bytes from its first window to it (12 bits), and the
# number of further windows (12 bits).
_AT, _LEAD, _LOW = 24, 12, (1 << 12) - 1
_CODEC = "zstd"

_INDEX = np.uint64((1 << 24) - 1)
#: A byte that UTF-8 never holds marks columns outside a string.
_NONE = 255


def _parts(data: np.ndarray, off: np.ndarray, length: int):
    """Bytes to look at together: whole rows, or overlapping parts of a row longer than a block:
    (bytes, offsets, first byte of each row in its document, first row)."""
    if len(off) > 2 or len(data) <= 2 * BLOCK_BYTES:
        yield data, off, 0
        return
    for at in range(0, max(1, len(data) - length + 1), BLOCK_BYTES):
        part = data[at:at + BLOCK_BYTES + length - 1]
        yield part, np.array([0, len(part)]), at


def gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    sums = prefix_sums(data)
    _, down = powers(len(sums))
    return mix((sums[gram:] - sums[:-gram]) * down[:len(sums) - gram])


def window_anchors(data: np.ndarray, off: np.ndarray, length: int, gram: int):
    """The anchors that windows of the rows are assigned to: (row, gram hash, place, first
    window, last window), places from the start of the bytes."""
    span = length - gram + 1
    size = np.diff(off)
    count = np.maximum(size - length + 1, 0)
    if not count.sum():
        return (np.zeros(0, np.int64),) * 5
    hashes = gram_hashes(data, gram)
    key = (hashes & ~_INDEX) | np.arange(len(hashes), dtype=np.uint64)
    full = -len(key) % span
    table = np.concatenate([key, np.full(full, ~np.uint64(0))]).reshape(-1, span)
    # The minimum of a sliding window: of the rest of one stretch and the beginning of the next.
    ahead = np.minimum.accumulate(table, axis=1).ravel()
    behind = np.minimum.accumulate(table[:, ::-1], axis=1)[:, ::-1].ravel()
    window = expand(off[:-1], count)
    row = np.repeat(np.arange(len(count)), count)
    anchor = (np.minimum(behind[window], ahead[window + span - 1]) & _INDEX).astype(np.int64)
    first = np.flatnonzero(np.concatenate(([True], (anchor[1:] != anchor[:-1]) | (row[1:] != row[:-1]))))
    last = np.concatenate((first[1:], [len(window)])) - 1
    at = anchor[first]
    return row[first], hashes[at], at, window[first], window[last]


def _anchors(batches, length: int, gram: int):
    for batch in batches:
        for row, data, off in blocks(batch.column(2)):
            for part, part_off, base in _parts(data, off, length):
                doc, hashes, place, first, last = window_anchors(part, part_off, length, gram)
                start = part_off[doc] - base
                doc = pa.array(doc + row)
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).take(doc), batch.column(1).take(doc), pa.array(hashes.astype(np.int64)),
                    pa.array(((place - start) << _AT) | ((place - first) << _LEAD) | (last - first))],
                    ["doc_id", "text_hash", "gram", "mark"])


def _pack(batches):
    """Documents with their bytes compressed, for the two shuffles of whole texts."""
    codec = pa.Codec(_CODEC)
    for batch in batches:
        for row, data, off in blocks(batch.column(2)):
            n = len(off) - 1
            yield pa.RecordBatch.from_arrays([
                batch.column(0).slice(row, n), batch.column(1).slice(row, n), pa.array(np.diff(off).astype(np.int64)),
                pa.array([codec.compress(data[off[i]:off[i + 1]], asbytes=True) for i in range(n)], pa.binary())],
                ["doc_id", "text_hash", "n_bytes", "packed"])


def _unpacked(batch):
    """Runs of rows of at most a block: (first row, bytes, offsets)."""
    codec = pa.Codec(_CODEC)
    off = np.concatenate(([0], np.cumsum(batch.column("n_bytes").to_numpy())))
    packed = batch.column("packed")
    row = 0
    while row < batch.num_rows:
        last = max(row + 1, int(np.searchsorted(off, off[row] + BLOCK_BYTES, "right")) - 1)
        parts = [codec.decompress(packed[i].as_buffer(), int(off[i + 1] - off[i])) for i in range(row, last)]
        data = np.concatenate([np.frombuffer(x, np.uint8) for x in parts])
        yield row, data, off[row:last + 1] - off[row]
        row = last


def _cut(batches, length: int):
    """The strings around the surviving anchors of each document."""
    for batch in batches:
        marks = batch.column("marks")
        for row, data, off in _unpacked(batch):
            own = marks.slice(row, len(off) - 1)
            flat = own.flatten()
            count = np.asarray(own.value_lengths().fill_null(0), np.int64)
            mark = flat.field("mark").to_numpy(zero_copy_only=False).astype(np.int64)
            place, lead, more = mark >> _AT, (mark >> _LEAD) & _LOW, mark & _LOW
            doc = np.repeat(np.arange(len(count)), count)
            begin = off[doc] + place - lead
            size = more + length
            bounds = np.concatenate(([0], np.cumsum(size)))
            take = pa.array(doc + row)
            # Slices of at most a block, so a document of many anchors stays bounded.
            at = 0
            while at < len(doc):
                to = max(at + 1, int(np.searchsorted(bounds, bounds[at] + BLOCK_BYTES, "right")) - 1)
                body = data[expand(begin[at:to], size[at:to])]
                strings = pa.Array.from_buffers(pa.binary(), to - at, [
                    None, pa.py_buffer((bounds[at:to + 1] - bounds[at]).astype(np.int32)), pa.py_buffer(body)])
                ids = take.slice(at, to - at)
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).take(ids), batch.column(1).take(ids),
                    *(flat.field(k).slice(at, to - at) for k in ("gram", "mark", "share", "many")), strings],
                    ["doc_id", "text_hash", "gram", "mark", "share", "many", "string"])
                at = to


def repeated_windows(group: np.ndarray, lead: np.ndarray, bounds: np.ndarray, body: np.ndarray, length: int, gram: int):
    """Column-wise suffix order of strings aligned at their anchors. ``group`` is sorted.
    Returns flags (string, column before the anchor) of windows that repeat within a group, and
    flags of the first window of each set of equal ones."""
    n, before = len(group), length - gram
    width = before + length
    size = np.diff(bounds)
    table = np.full((n, width), _NONE, np.uint8)
    table.ravel()[expand(np.arange(n) * width + before - lead, size)] = body
    repeat = np.zeros((n, before + 1), bool)
    head = np.zeros((n, before + 1), bool)
    with tempfile.TemporaryFile() as file:
        # The columns in the order in which the rounds read them: the last one first.
        file.write(np.ascontiguousarray(table[:, ::-1].T))
        del table
        file.seek(0)
        order = np.arange(n)
        common = np.zeros(n + 1, np.int32)
        for column in range(width - 1, -1, -1):
            symbol = np.frombuffer(file.read(n), np.uint8)[order]
            key = group[order] * 256 + symbol
            if (key[1:] >= key[:-1]).all():
                moved = np.arange(n)
            else:
                moved = np.argsort(key, kind="stable")
                key, symbol = key[moved], symbol[moved]
            # Neighbours in the new order share one symbol more than the least of all common
            # prefixes between their old places.
            least = np.zeros(n, np.int32)
            same = np.flatnonzero((key[1:] == key[:-1]) & (symbol[1:] != _NONE)) + 1
            if len(same):
                pairs = np.column_stack([moved[same - 1] + 1, moved[same] + 1]).ravel()
                least[same] = np.minimum.reduceat(common, pairs)[::2] + 1
            order = order[moved]
            common[:n] = np.minimum(least, length)
            if column <= before:
                equal = np.flatnonzero(common[:n] >= length)
                if len(equal):
                    repeat[order[equal], column] = True
                    repeat[order[equal - 1], column] = True
                started = symbol != _NONE
                started[equal] = False
                head[order[started], column] = True
    return repeat, head


def _runs(flags: np.ndarray):
    """(row, first, last) of the runs of set flags in each row."""
    edge = np.zeros((len(flags), flags.shape[1] + 2), np.int8)
    edge[:, 1:-1] = flags
    change = np.diff(edge, axis=1)
    row, first = np.nonzero(change == 1)
    _, after = np.nonzero(change == -1)
    return row, first, after - 1


def _order(batches, length: int, gram: int):
    """Ranges of repeated windows of each collection, and the different windows of collections
    that are a share of a gram's places. Input rows come sorted by gram and share."""
    def flush(held):
        column = {k: pa.concat_arrays([b.column(k) for b in held]) for k in held[0].schema.names}
        gram_id, share, mark, many = (
            column[k].to_numpy(zero_copy_only=False).astype(np.int64) for k in ("gram", "share", "mark", "many"))
        place, lead = mark >> _AT, (mark >> _LEAD) & _LOW
        strings = column["string"].cast(pa.large_binary())
        _, offsets, body = strings.buffers()
        bounds = np.frombuffer(offsets, np.int64)[strings.offset:strings.offset + len(strings) + 1]
        body = np.frombuffer(body, np.uint8)[bounds[0]:bounds[-1]]
        bounds = bounds - bounds[0]
        new = np.concatenate(([False], (gram_id[1:] != gram_id[:-1]) | (share[1:] != share[:-1])))
        repeat, head = repeated_windows(np.cumsum(new), lead, bounds, body, length, gram)
        row, first, last = _runs(repeat)
        start = place[row] + first - (length - gram)
        take = pa.array(row)
        none = pa.nulls(len(row), pa.int64())
        yield pa.RecordBatch.from_arrays([
            column["doc_id"].take(take), column["text_hash"].take(take), pa.array(start),
            pa.array(place[row] + last - (length - gram) + length), none, none, pa.nulls(len(row), pa.bool_())], RANGES)
        # Shares of one gram: a hash of every different window, to be counted over the shares.
        wide = np.flatnonzero(many > 1)
        if len(wide):
            row, at = np.nonzero(head[wide])
            row = wide[row]
            whole = at - (length - gram) + lead[row] + length <= np.diff(bounds)[row]
            row, at = row[whole], at[whole]
            sums = prefix_sums(body)
            _, down = powers(len(sums))
            begin = bounds[row] + at - (length - gram) + lead[row]
            hashes = mix((sums[begin + length] - sums[begin]) * down[begin])
            start = place[row] + at - (length - gram)
            take = pa.array(row)
            yield pa.RecordBatch.from_arrays([
                column["doc_id"].take(take), column["text_hash"].take(take), pa.array(start), pa.array(start + length),
                pa.array(gram_id[row]), pa.array(hashes.astype(np.int64)), pa.array(~repeat[row, at])], RANGES)

    held, rows = [], 0
    for batch in batches:
        keys = list(zip(batch.column("gram").to_pylist(), batch.column("share").to_pylist()))
        at = 0
        while at < len(keys):
            # Up to BATCH rows, then on to the end of the collection.
            to = min(len(keys), at + max(1, BATCH - rows))
            if rows >= BATCH and keys[at] != last:
                yield from flush(held)
                held, rows = [], 0
                continue
            if rows >= BATCH:
                to = at + 1
                while to < len(keys) and keys[to] == last:
                    to += 1
            held.append(batch.slice(at, to - at))
            rows += to - at
            last = keys[to - 1]
            at = to
    if held:
        yield from flush(held)


RANGES = ["doc_id", "text_hash", "start", "end", "gram", "window", "single"]


def _remove(batches):
    for batch in batches:
        ranges = batch.column("ranges")
        for row, data, off in _unpacked(batch):
            own = ranges.slice(row, len(off) - 1)
            count = np.asarray(own.value_lengths().fill_null(0), np.int64)
            flat = own.flatten()
            doc = np.repeat(np.arange(len(count)), count)
            change = np.zeros(len(data) + 1, np.int64)
            np.add.at(change, off[doc] + flat.field("start").to_numpy(zero_copy_only=False).astype(np.int64), 1)
            np.add.at(change, off[doc] + flat.field("end").to_numpy(zero_copy_only=False).astype(np.int64), -1)
            gone = np.cumsum(change)[:-1] > 0
            begins = gone.copy()
            begins[1:] &= ~gone[:-1]
            inner = off[1:-1][off[1:-1] < len(data)]
            begins[inner] = gone[inner]
            removed = np.diff(np.concatenate(([0], np.cumsum(gone)))[off])
            spans = np.diff(np.concatenate(([0], np.cumsum(begins)))[off])
            ends = gone.copy()
            ends[:-1] &= ~gone[1:]
            ends[inner - 1] = gone[inner - 1]
            where = np.flatnonzero(begins)
            local = off[np.searchsorted(off, where, "right") - 1]
            pairs = pa.StructArray.from_arrays([pa.array(where - local), pa.array(np.flatnonzero(ends) + 1 - local)], ["start", "end"])
            bounds = np.concatenate(([0], np.cumsum(np.diff(off) - removed)))
            kept = pa.Array.from_buffers(pa.large_binary(), len(removed), [None, pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(data[~gone])])
            yield pa.RecordBatch.from_arrays([
                batch.column(0).slice(row, len(removed)), pa.array(np.diff(off).astype(np.int64)), pa.array(removed.astype(np.int64)),
                pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(spans))), pa.int32()), pairs),
                kept.cast(pa.binary())], ["doc_id", "n_bytes", "n_removed", "removed", "kept"])


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH,
                   gram: int = GRAM, collection: int = COLLECTION) -> DataFrame:
    """One row per document: id, ``n_bytes``, ``n_removed``, ``removed`` (maximal runs as byte
    ranges) and ``kept`` (the remaining bytes)."""
    kind = docs.schema[id_col].dataType.simpleString()
    if length - gram > _LOW:
        raise ValueError(f"length - gram must be below {_LOW + 1}")
    key = f"doc_id {kind}, text_hash long"
    texts = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("text_hash"), F.col(text_col).alias("text"))
    rows = texts.mapInArrow(_pack, f"{key}, n_bytes long, packed binary")

    anchors = written(texts.mapInArrow(
        partial(_anchors, length=length, gram=gram), f"{key}, gram long, mark long"), "repeat-anchors")
    often = written(anchors.groupBy("gram").agg(F.count("*").alias("n")).where("n > 1"), "repeat-grams")
    many = F.ceil(F.col("n") / collection).cast("int")
    marks = anchors.join(often, "gram").select(
        "doc_id", "text_hash", F.struct(
            "gram", "mark", many.alias("many"),
            F.pmod(F.xxhash64("doc_id", "text_hash", "mark"), many.cast("long")).cast("int").alias("share")).alias("m"))
    marks = marks.groupBy("doc_id", "text_hash").agg(F.collect_set("m").alias("marks"))

    strings = _by_document(rows, marks).select("doc_id", "text_hash", "n_bytes", "packed", "marks").mapInArrow(
        partial(_cut, length=length), f"{key}, gram long, mark long, share int, many int, string binary")
    ranges = written(
        strings.repartition("gram", "share").sortWithinPartitions("gram", "share").mapInArrow(
            partial(_order, length=length, gram=gram),
            f"{key}, start long, end long, gram long, window long, single boolean"), "repeat-ranges")

    shared = ranges.where("gram IS NOT NULL")
    twice = shared.groupBy("gram", "window").agg(F.count("*").alias("n")).where("n > 1").select("gram", "window")
    across = shared.where("single").join(twice, ["gram", "window"], "left_semi").select("doc_id", "text_hash", "start", "end")
    found = ranges.where("gram IS NULL").select("doc_id", "text_hash", "start", "end").unionByName(across)
    found = found.groupBy("doc_id", "text_hash").agg(F.collect_set(F.struct("start", "end")).alias("ranges"))
    return _by_document(rows, found, "left").select("doc_id", "text_hash", "n_bytes", "packed", "ranges").mapInArrow(
        _remove, f"doc_id {kind}, n_bytes long, n_removed long, removed array<struct<start:long,end:long>>, kept binary",
    ).withColumnRenamed("doc_id", id_col)


def _by_document(rows: DataFrame, found: DataFrame, how: str = "inner") -> DataFrame:
    other = found.withColumnsRenamed({"doc_id": "_id", "text_hash": "_hash"})
    return rows.join(other, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_hash") == F.col("_hash")), how)
