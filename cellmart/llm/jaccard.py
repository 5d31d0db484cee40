"""N-gram Jaccard join by a grouped prefix join.

A document's set holds its distinct ``k``-word shingles (64-bit hashes); two documents link when
``100 * |A & B| >= percent * |A | B|``. The join finds the components of all links:

1. Documents with equal sets are one class; only its smallest id is joined further.
2. Every set is sorted by one global order, rare shingles first. (Frequencies come from a table
   of 2**SKETCH_BITS counters over all shingles of all documents. A counter adds up several
   shingles, so it can only make a shingle look too frequent; any order gives the right result.)
   Sets that link share a shingle within their first ``n - ceil(percent * n / 100) + 1``: the prefix.
3. Classes with the same prefix and size are collapsed into one group. Only groups enter the
   lists of prefix shingles, so many near copies cost one entry. A shingle of one prefix alone has no list: marks
   of those that occur again are found from 32 bits of each hash and sent to the tasks (a fixed number; shingles that
   share a mark only make it keep too much), and only marked shingles become entries.
4. First round: each group is paired with the smallest and the largest of each list, each member
   of a group with the group's smallest. Pairs are filtered by size and by the parity bitmaps of
   the sets (the bits that differ cannot outnumber the shingles that differ), the rest is verified
   on the full sets. This links large families of near copies in a number of pairs that is linear in
   their size.
5. Second round: lists and groups that still hold different components are paired in full across
   components, filtered by size, position and short parity bitmaps (the bits that all members of a
   group have in common), expanded to members, filtered by full bitmaps and verified. Lists of the same groups are joined once. So no link between components is missed,
   and no pair inside a component is made.

Links within a component are not all listed; every component is exact. Sets, lists and labels are
written tables; nothing that grows with the input is broadcast or brought to the driver except the
counters (a fixed number).

Defined results: words are runs of other bytes than 20 and 09-0D, A-Z in lower case; a text with
fewer than ``k`` words, but not none, has one shingle, the whole sequence; null and empty texts and
texts without words have an empty set, size 0, and are components of their own. Rows that repeat
an id with different texts are one document: what links with one of them is linked with all. A
null id is not linked; its component is null. Other columns are ignored.
"""

from __future__ import annotations

import uuid
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import components
from .tables import sifted, written
from .textkit import blocks, lower_ascii, mix, non_space, shingle_hashes, word_hashes

K = 4
PERCENT = 85
SKETCH_BITS = 20
_CHUNK = 1 << 12
_ENTRIES = 1 << 16
#: Leading bits of a shingle's hash that choose its segment, and all bits that choose its mark (32 MB of marks).
SEGMENT_BITS, MARK_BITS = 12, 28
#: Width of the short parity bitmap that the second round's join compares.
FOLD_BITS = 512


def _row_shingles(data, off, k: int):
    """(row, hash) of the distinct shingles of each row of a block, sorted; shingles per row."""
    words, _, _, first = word_hashes(data, off, non_space(), lower_ascii())
    hashes, begin = shingle_hashes(words, first, k)
    row = np.repeat(np.arange(len(off) - 1), np.diff(begin))
    order = np.lexsort((hashes, row))
    row, hashes = row[order], hashes[order]
    new = np.concatenate(([True], (row[1:] != row[:-1]) | (hashes[1:] != hashes[:-1])))[:len(row)]
    row, hashes = row[new], hashes[new]
    return row, hashes, np.bincount(row, minlength=len(off) - 1)


def _count(batches, k: int):
    counts = np.zeros(1 << SKETCH_BITS, np.int64)
    for batch in batches:
        for _, data, off in blocks(batch.column(0)):
            _, hashes, _ = _row_shingles(data, off, k)
            counts += np.bincount((hashes >> np.uint64(64 - SKETCH_BITS)).astype(np.int64), minlength=len(counts))
    yield from _chunks(counts.reshape(-1, _CHUNK), range(len(counts) // _CHUNK))


def _chunks(counts, numbers):
    for i in numbers:
        yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([counts[i].tobytes()], pa.binary())], ["chunk", "counts"])


def _add(batches):
    """Sums of the counter chunks of a partition: one running sum for each chunk."""
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for i, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            total[i] = total.get(i, 0) + np.frombuffer(raw, np.int64)
    yield from _chunks(total, total)


def frequency_classes(docs: DataFrame, text_col: str, k: int) -> np.ndarray:
    """The binary logarithm of each counter, over all shingles of all documents. A task sends its
    counters once; the driver gets ``2**SKETCH_BITS`` of them (8 MB) at any size of the input."""
    schema = "chunk int, counts binary"
    # Counters meet in two steps, so no task reads those of all others.
    sums = docs.select(text_col).mapInArrow(partial(_count, k=k), schema)
    sums = sums.withColumn("part", F.pmod(F.xxhash64("counts"), F.lit(8))).repartition("chunk", "part").drop("part")
    sums = sums.mapInArrow(_add, schema).repartition("chunk").mapInArrow(_add, schema)
    counts = np.zeros((1 << SKETCH_BITS) // _CHUNK * _CHUNK, np.int64).reshape(-1, _CHUNK)
    for r in sums.toLocalIterator():
        counts[r["chunk"]] += np.frombuffer(r["counts"], np.int64)
    return np.log2(np.maximum(counts.ravel(), 1)).astype(np.uint8)


def _fingerprints(batches):
    """Per segment of the hashes, the next 32 bits of the shingles of a batch: each at most twice."""
    for batch in batches:
        tokens = np.sort(batch.column(0).flatten().to_numpy().view(np.uint64) >> np.uint64(64 - SEGMENT_BITS - 32))
        tokens = tokens[np.concatenate((tokens[:2] == tokens[:2], tokens[2:] != tokens[:-2]))]
        segment = (tokens >> np.uint64(32)).astype(np.int32)
        first = np.flatnonzero(np.concatenate(([True], segment[1:] != segment[:-1]))[:len(segment)])
        marks = tokens.astype("<u4").tobytes()
        bounds = [*first.tolist(), len(tokens)]
        yield pa.RecordBatch.from_arrays([
            pa.array(segment[first]), pa.array([marks[4 * a:4 * b] for a, b in zip(bounds, bounds[1:])], pa.binary())], ["segment", "marks"])


def _repeated(batches):
    """Per segment, the marks of the shingles that occur again."""
    found: dict[int, list[bytes]] = {}
    for batch in batches:
        for i, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            found.setdefault(i, []).append(raw)
    for i in found:
        values = np.sort(np.frombuffer(b"".join(found[i]), "<u4"))
        again = values[1:][values[1:] == values[:-1]] >> np.uint32(32 - (MARK_BITS - SEGMENT_BITS))
        if len(again):
            bits = np.zeros(1 << (MARK_BITS - SEGMENT_BITS), np.uint8)
            bits[again] = 1
            yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([np.packbits(bits).tobytes()], pa.binary())], ["segment", "marks"])


def repeated_marks(prefixes: DataFrame) -> np.ndarray:
    """A bit for each value of the leading ``MARK_BITS`` of the hashes: set where a shingle of two prefixes
    lies. The driver gets 32 MB of them at any size of the input."""
    schema = "segment int, marks binary"
    marks = prefixes.mapInArrow(_fingerprints, schema).repartition("segment").mapInArrow(_repeated, schema)
    out = np.zeros((1 << SEGMENT_BITS, 1 << (MARK_BITS - SEGMENT_BITS - 3)), np.uint8)
    for r in marks.toLocalIterator():
        out[r["segment"]] = np.frombuffer(r["marks"], np.uint8)
    return out


def _entries(batches, marks):
    """The marked shingles of each prefix: place, shingle, group, size."""
    bits = np.frombuffer(marks.value, np.uint8)
    for batch in batches:
        prefix = batch.column(2)
        tokens, count = prefix.flatten(), pc.list_value_length(prefix).to_numpy()
        at = tokens.to_numpy().view(np.uint64) >> np.uint64(64 - MARK_BITS)
        keep = np.flatnonzero(bits[at >> np.uint64(3)] >> (7 - (at & np.uint64(7))).astype(np.uint8) & 1)
        row = np.repeat(np.arange(len(count)), count)
        place = np.arange(len(row)) - (np.cumsum(count) - count)[row]
        for part in (keep[i:i + _ENTRIES] for i in range(0, len(keep), _ENTRIES)):
            yield pa.RecordBatch.from_arrays([
                pa.array(place[part].astype(np.int32)), tokens.take(pa.array(part)), *(batch.column(c).take(pa.array(row[part])) for c in (0, 1))],
                ["pos", "token", "gid", "n"])


def _sums(values: np.ndarray, begin: np.ndarray) -> pa.Array:
    total = np.concatenate(([0], np.cumsum(values, dtype=np.uint64))).astype(np.uint64)
    return pa.array((total[begin[1:]] - total[begin[:-1]]).view(np.int64))


def _sets(batches, k: int, percent: int, classes):
    """Per document: size, two sums that identify the set, its prefix, a sum that identifies the
    prefix, and the parity bitmap."""
    rank = np.frombuffer(classes.value, np.uint8)
    for batch in batches:
        for row0, data, off in blocks(batch.column(1)):
            row, hashes, n = _row_shingles(data, off, k)
            begin = np.concatenate(([0], np.cumsum(n)))
            # Bitmaps: a power of two of bits, about one for each shingle, at least 64.
            width = np.where(n > 0, 1 << np.maximum(6, np.ceil(np.log2(np.maximum(n, 1))).astype(np.int64)), 0)
            bit0 = np.concatenate(([0], np.cumsum(width)))
            at = bit0[row] + (hashes & (width[row] - 1).astype(np.uint64)).astype(np.int64)
            bits = np.packbits((np.bincount(at, minlength=bit0[-1]) & 1).astype(np.uint8))
            bitmap = pa.Array.from_buffers(pa.binary(), len(n), [None, pa.py_buffer((bit0 // 8).astype(np.int32)), pa.py_buffer(bits)])
            cell = row * FOLD_BITS + (hashes % np.uint64(FOLD_BITS)).astype(np.int64)
            cells = np.packbits((np.bincount(cell, minlength=len(n) * FOLD_BITS) & 1).astype(np.uint8)).view(np.int64)
            fold = pa.ListArray.from_arrays(pa.array(np.arange(len(n) + 1) * (FOLD_BITS // 64), pa.int32()), pa.array(cells))
            order = np.lexsort((hashes, rank[(hashes >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)], row))
            place = np.arange(len(row)) - begin[row]
            size = np.where(n > 0, n - -(-percent * n // 100) + 1, 0)
            prefix = hashes[order][place < size[row]]
            cut = np.concatenate(([0], np.cumsum(size)))
            yield pa.RecordBatch.from_arrays([
                batch.column(0).slice(row0, len(n)), pa.array(n.astype(np.int64)),
                _sums(mix(hashes ^ np.uint64(0x5851F42D4C957F2D)), begin), _sums(mix(hashes + np.uint64(0x14057B7EF767814F)), begin),
                _sums(mix(prefix ^ np.uint64(0x2545F4914F6CDD1D)), cut),
                pa.ListArray.from_arrays(pa.array(cut, pa.int32()), pa.array(prefix.view(np.int64))), bitmap, fold],
                ["id", "n", "s1", "s2", "ps", "prefix", "bits", "fold"])


def _arrays(batches, k: int):
    for batch in batches:
        for row0, data, off in blocks(batch.column(1)):
            _, hashes, n = _row_shingles(data, off, k)
            bounds = np.concatenate(([0], np.cumsum(n)))
            yield pa.RecordBatch.from_arrays([
                batch.column(0).slice(row0, len(n)),
                pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(hashes.view(np.int64)))], ["id", "set"])


def _near(batches, percent: int):
    """Pairs whose sizes and bitmaps allow a link."""
    for batch in batches:
        na, nb = (batch.column(k).to_numpy().astype(np.int64) for k in ("na", "nb"))
        # Shared shingles needed: ceil(percent * (na + nb) / (100 + percent)).
        need = -(-percent * (na + nb) // (100 + percent))
        keep = np.minimum(na, nb) >= need
        a, b = batch.column("bits_a"), batch.column("bits_b")
        for i in np.flatnonzero(keep).tolist():
            x, y = (np.frombuffer(c[i].as_buffer(), np.uint8) for c in (a, b))
            if len(x) != len(y):
                # A wider bitmap folds onto a narrower one: bits are hashes modulo the width.
                x, y = (x, y) if len(x) > len(y) else (y, x)
                x = np.bitwise_xor.reduce(x.reshape(-1, len(y)), axis=0)
            keep[i] = int(np.bitwise_count(x ^ y).sum()) <= na[i] + nb[i] - 2 * need[i]
        yield batch.select(["a", "b"]).filter(pa.array(keep))


def fold_width(step: int, percent: int) -> int:
    """Bits of the bitmaps that are compared for a size step: about one for each shingle of the smallest set
    of the step below, so no set of the pair has a narrower bitmap of its own."""
    return 1 << max(6, int(np.ceil(np.log2((100 / percent) ** (step - 1) * (1 - 1e-6)))))


def _folds(batches, percent: int):
    """The bitmap of each set at the widths of its own size step and the next, in words of 64 bits; only
    widths over ``FOLD_BITS``."""
    for batch in batches:
        out = []
        for gid, step, bits in zip(*(c.to_pylist() for c in batch.columns)):
            full = np.frombuffer(bits, np.uint8)
            for at in (step, step + 1):
                if (width := fold_width(at, percent)) > FOLD_BITS:
                    out.append((gid, at, np.bitwise_xor.reduce(full.reshape(-1, width // 8), axis=0).view(np.int64)))
        for part in (out[i:i + 256] for i in range(0, len(out), 256)):
            yield pa.RecordBatch.from_arrays([
                pa.array([x[0] for x in part], pa.int64()), pa.array([x[1] for x in part], pa.int64()),
                pa.array([x[2] for x in part], pa.list_(pa.int64()))], ["gid", "step", "words"])


class Join:
    """The written tables of one join."""

    def __init__(self, docs: DataFrame, id_col: str, text_col: str, k: int, percent: int):
        self.k, self.percent = k, percent
        self.docs = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
        spark = docs.sparkSession
        classes = spark.sparkContext.broadcast(frequency_classes(self.docs, "text", k).tobytes())
        self.sets = written(self.docs.mapInArrow(
            partial(_sets, k=k, percent=percent, classes=classes),
            "id long, n long, s1 long, s2 long, ps long, prefix array<long>, bits binary, fold array<long>"), "jaccard-sets")
        key = ["s1", "s2", "n"]
        classes = written(self.sets.where("n > 0 AND id IS NOT NULL").groupBy(*key).agg(
            F.min("id").alias("node"), F.count("*").alias("rows")), "jaccard-classes")
        self.classes = classes.drop("rows")
        # Only sets of several rows are shuffled; the others are nodes as they are.
        several = classes.where("rows > 1").select(F.xxhash64(*key).alias("key"))
        maybe, single = sifted(self.sets.where("n > 0 AND id IS NOT NULL"), F.xxhash64(*key), several)
        nodes = maybe.join(self.classes.withColumnRenamed("node", "id"), [*key, "id"]).dropDuplicates(["id", *key])
        columns = ["id", "n", "ps", "prefix", "bits", "fold"]
        self.nodes = single.select(*columns).unionByName(written(nodes.select(*columns), "jaccard-nodes"))
        groups = written(self.nodes.groupBy("ps", "n").agg(F.min("id").alias("gid"), F.count("*").alias("members")), "jaccard-groups")
        self.members = written(self.nodes.join(groups, ["ps", "n"]).select("gid", "id", "members"), "jaccard-members")
        several = groups.where("members > 1").select(F.xxhash64("ps", "n").alias("key"))
        maybe, single = sifted(self.nodes.select("ps", "n", "id", "prefix"), F.xxhash64("ps", "n"), several)
        heads = maybe.join(groups.withColumnRenamed("gid", "id"), ["ps", "n", "id"])
        heads = single.select("id", "n", "prefix").unionByName(heads.select("id", "n", "prefix"))
        marks = spark.sparkContext.broadcast(repeated_marks(heads.select("prefix")).tobytes())
        own = f"jaccard-{uuid.uuid4().hex[:12]}"
        entries = written(heads.mapInArrow(partial(_entries, marks=marks), "pos int, token long, gid long, n long"), f"{own}/jaccard-marked")
        lists = written(entries.groupBy("token").agg(
            F.count("*").alias("entries"), F.min("gid").alias("low"), F.max("gid").alias("high")).where("entries > 1"), "jaccard-lists")
        self.entries = written(entries.join(lists, "token"), f"{own}/jaccard-entries")

    def verify(self, pairs: DataFrame) -> DataFrame:
        """The linked pairs among candidate pairs (a, b), a < b."""
        pairs = written(pairs.select("a", "b").distinct(), "jaccard-pairs")
        bits = self.nodes.select("id", "n", "bits")
        near = pairs
        for side in ("a", "b"):
            near = near.join(bits.select(F.col("id").alias(side), F.col("n").alias(f"n{side}"), F.col("bits").alias(f"bits_{side}")), side)
        near = written(near.mapInArrow(partial(_near, percent=self.percent), "a long, b long"), "jaccard-near")
        wanted = written(near.select(F.explode(F.array("a", "b")).alias("id")).distinct(), "jaccard-wanted")
        texts, _ = sifted(self.docs, F.xxhash64("id"), wanted.select(F.xxhash64("id").alias("key")))
        arrays = written(texts.join(wanted, "id", "left_semi").mapInArrow(
            partial(_arrays, k=self.k), "id long, set array<long>"), "jaccard-full")
        for side in ("a", "b"):
            near = near.join(arrays.select(F.col("id").alias(side), F.col("set").alias(f"set_{side}")), side)
        both = F.size(F.array_intersect("set_a", "set_b"))
        total = F.size("set_a") + F.size("set_b") - both
        return written(near.where(100 * both >= self.percent * total).select("a", "b"), "jaccard-links")

    def first_round(self) -> DataFrame:
        ends = F.explode(F.array("low", "high"))
        lists = self.entries.select(F.col("gid").alias("x"), ends.alias("y"))
        groups = self.members.select(F.col("id").alias("x"), F.col("gid").alias("y"))
        return self.verify(_ordered(lists.unionByName(groups)))

    def second_round(self, labels: DataFrame) -> DataFrame:
        members = written(self.members.join(labels.withColumnRenamed("node", "id"), "id", "left").select(
            "gid", "id", "members", F.coalesce("label", "id").alias("label")), "jaccard-labelled")
        groups = written(members.groupBy("gid").agg(
            F.min("label").alias("lo"), F.max("label").alias("hi"), F.max("members").alias("members")), "jaccard-group-labels")
        entries = written(self.entries.select("token", "gid", "n", "pos", "entries").join(groups, "gid"), "jaccard-open")
        mixed = entries.groupBy("token").agg(
            F.min("lo").alias("l"), F.max("hi").alias("h"), F.max("members").alias("m"), F.max("entries").alias("e"),
            F.bit_xor(F.xxhash64("gid")).alias("x"), F.bit_xor(F.xxhash64("gid", F.lit(1))).alias("y"))
        # Lists of up to three single classes are complete after the first round. A passage that
        # documents share gives many lists of the same groups: one of them will do.
        mixed = mixed.where("l < h AND (e > 3 OR m > 1)").groupBy("e", "x", "y").agg(F.min("token").alias("token"))
        mixed = written(mixed.select("token"), "jaccard-mixed")
        # Members share prefix and size, not the rest of their sets: a group is known by the bits that
        # are set in all (a) and in any (o) of its members.
        fold = self.nodes.join(self.members.select("gid", "id"), "id").groupBy("gid").agg(*[
            end(F.col("fold")[i]).alias(f"{name}{i}")
            for i in range(FOLD_BITS // 64) for name, end in (("a", F.bit_and), ("o", F.bit_or))])
        # Most groups have one member: words that are equal are kept once.
        fold = fold.withColumns({f"o{i}": F.when(F.col(f"o{i}") != F.col(f"a{i}"), F.col(f"o{i}")) for i in range(FOLD_BITS // 64)})
        # Sizes of a link differ by less than one step, so a group meets its own and the next.
        step = F.floor(F.log(F.col("n")) / F.log(F.lit(100 / self.percent)) + F.lit(1e-9))
        entries, _ = sifted(entries, F.xxhash64("token"), mixed.select(F.xxhash64("token").alias("key")))
        entries = written(entries.join(mixed, "token", "left_semi").join(fold, "gid").withColumn("step", step), "jaccard-mixed-entries")
        # Within a list only the sizes that hold an entry to meet, of another component, are joined.
        x = entries.withColumn("own", F.col("step")).withColumn("step", F.explode(F.array("step", F.col("step") + 1)))
        cells = x.groupBy("token", "step").agg(
            F.min("lo").alias("l"), F.max("hi").alias("h"), F.count("*").alias("c"), F.max(F.col("own") == F.col("step")).alias("o"))
        cells = written(cells.where("l < h AND c > 1 AND o").select(F.xxhash64("token", "step").alias("key")), "jaccard-cells")
        (x, _), (y, _) = (sifted(side, F.xxhash64("token", "step"), cells) for side in (x, entries))
        # Short bitmaps tell large sets apart no longer: from a size on, wider ones are compared as well.
        large = F.col("n") > FOLD_BITS
        large = x.where(large).select("gid", F.col("own").alias("step")).unionByName(y.where(large).select("gid", "step")).distinct()
        wide = self.members.select("gid", "id").join(large, "gid").join(self.nodes.select("id", "bits"), "id").select(
            "gid", "step", "bits").mapInArrow(partial(_folds, percent=self.percent), "gid long, step long, words array<long>")
        wide = wide.select("gid", "step", F.posexplode("words").alias("i", "w")).groupBy("gid", "step", "i").agg(
            F.bit_and("w").alias("a"), F.bit_or("w").alias("o"))
        wide = wide.groupBy("gid", "step").agg(F.sort_array(F.collect_list(F.struct("i", "a", "o"))).alias("w"))
        wide = written(wide.select("gid", "step", F.col("w.a").alias("wa"), F.col("w.o").alias("wo")), "jaccard-wide")
        x, y = _with_words(x, wide).alias("x"), _with_words(y, wide).alias("y")
        need = F.ceil(self.percent * (F.col("x.n") + F.col("y.n")) / (100 + self.percent))
        shared = (F.least("x.pos", "y.pos") + 1
                  + F.least(F.col("x.n") - F.col("x.pos"), F.col("y.n") - F.col("y.pos")) - 1)
        pairs = x.join(y, (F.col("x.token") == F.col("y.token")) & (F.col("x.step") == F.col("y.step"))
                       & ((F.col("x.n") < F.col("y.n")) | (F.col("x.n") == F.col("y.n")) & (F.col("x.gid") < F.col("y.gid")))
                       & (F.least("x.lo", "y.lo") < F.greatest("x.hi", "y.hi"))
                       & (F.col("x.n") >= need) & (shared >= need)
                       & (_differing_bits() <= F.col("x.n") + F.col("y.n") - 2 * need)
                       & (F.col("x.wa").isNull() | F.col("y.wa").isNull()
                          | (_differing_words() <= F.col("x.n") + F.col("y.n") - 2 * need))).select(
            F.col("x.gid").alias("ga"), F.col("y.gid").alias("gb")).distinct()
        pairs = written(pairs, "jaccard-group-pairs")
        own = members.where("members > 1").join(groups.where("lo < hi").select("gid"), "gid", "left_semi")
        pairs = pairs.unionByName(own.select(F.col("gid").alias("ga"), F.col("gid").alias("gb")).distinct())
        left = members.select(F.col("gid").alias("ga"), F.col("id").alias("x"), F.col("label").alias("lx"))
        right = members.select(F.col("gid").alias("gb"), F.col("id").alias("y"), F.col("label").alias("ly"))
        wide = pairs.join(left, "ga").join(right, "gb").where("lx <> ly")
        return self.verify(_ordered(wide))

    def result(self) -> DataFrame:
        labels = components(self.first_round())
        links = self.second_round(labels)
        # The second round's links join components: they are contracted as links between labels.
        for side in ("a", "b"):
            links = links.join(labels.select(F.col("node").alias(side), F.col("label").alias(f"l{side}")), side, "left")
        links = links.select(F.coalesce("la", "a").alias("a"), F.coalesce("lb", "b").alias("b"))
        named = written(self.classes.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node")), "jaccard-classified")
        # An id with several texts is one document: the components of its texts are one.
        several = self.sets.where("id IS NOT NULL AND n > 0").groupBy("id").agg(F.min("s1").alias("low"), F.max("s1").alias("high")).where("low < high")
        own = self.sets.join(several.select("id"), "id", "left_semi").select("id", "s1", "s2", "n").distinct().join(named, ["s1", "s2", "n"])
        least = own.groupBy("id").agg(F.min("label").alias("b"))
        same = own.join(least, "id").select(F.col("label").alias("a"), "b")
        more = components(links.unionByName(same))
        named = named.join(more.select(F.col("node").alias("label"), F.col("label").alias("root")), "label", "left")
        named = written(named.select("s1", "s2", "n", F.coalesce("root", "label").alias("component_id")), "jaccard-named")
        rows = self.sets.select("id", "n", "s1", "s2").join(named, ["s1", "s2", "n"], "left")
        # Rows without words go with the other rows of their id.
        empty = rows.where("n > 0").groupBy("id").agg(F.min("component_id").alias("of_id"))
        empty = empty.join(self.sets.where("n = 0").select("id").distinct(), "id", "left_semi")
        rows = rows.join(empty, "id", "left").withColumn("component_id", F.coalesce("component_id", "of_id"))
        return rows.select("id", F.col("n").alias("n_shingles"), F.when(
            F.col("id").isNotNull(), F.coalesce("component_id", "id")).alias("component_id"))


def _with_words(entries: DataFrame, wide: DataFrame) -> DataFrame:
    """Entries with the wide bitmaps of their group. Only large sets have any, so the others are not shuffled."""
    large = entries.where(F.col("n") > FOLD_BITS).join(wide, ["gid", "step"], "left")
    none = {c: F.lit(None).cast(wide.schema[c].dataType) for c in ("wa", "wo")}
    return entries.where(F.col("n") <= FOLD_BITS).withColumns(none).unionByName(large)


def _differing_bits():
    """Bits in which the short bitmaps of all members of groups x and y differ: not more than the
    shingles in which any two members differ. The words in which any member has a bit (o) are null where
    they equal those of all members (a)."""
    return F.expr(" + ".join(
        f"bit_count((x.a{i} & ~coalesce(y.o{i}, y.a{i})) | (y.a{i} & ~coalesce(x.o{i}, x.a{i})))" for i in range(FOLD_BITS // 64)))


def _differing_words():
    """The same for the wide bitmaps."""
    return F.expr("""aggregate(zip_with(zip_with(x.wa, y.wo, (p, q) -> p & ~q), zip_with(y.wa, x.wo, (p, q) -> p & ~q),
                                       (p, q) -> bit_count(p | q)), 0, (s, b) -> s + b)""")


def _ordered(pairs: DataFrame) -> DataFrame:
    return pairs.where("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = K,
                       percent: int = PERCENT) -> DataFrame:
    """Per document: id, ``n_shingles``, ``component_id`` (the smallest id reachable by links)."""
    return Join(docs, id_col, text_col, k, percent).result().withColumnRenamed("id", id_col)


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5,
                     percent: int = 80) -> DataFrame:
    """The rows of the smallest id of each component, with their columns."""
    found = jaccard_components(docs, id_col, text_col, k, percent)
    gone = written(found.where(F.col("component_id") < F.col(id_col)).select(
        F.col(id_col).cast("long").alias("__copy_id")).distinct(), "jaccard-dropped")
    # Rows of other ids stay where they are.
    maybe, rest = sifted(docs, F.xxhash64(F.col(id_col).cast("long")), gone.select(F.xxhash64("__copy_id").alias("key")))
    return rest.unionByName(maybe.join(gone, F.col(id_col) == F.col("__copy_id"), "left_anti"))
