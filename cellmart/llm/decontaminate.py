"""Benchmark decontamination with suffix arrays over the training documents.

Each task builds suffix arrays over shards of its own documents: the positions of a shard's words
sorted by the word sequence that starts there (prefix doubling over 64-bit word hashes, as deep as
the window, ``SORT_WORDS`` words at least). Every suffix of every benchmark item is then binary-searched
in every shard. The neighbours at the insertion point give the longest match of the suffix within that
depth, the range of suffixes that begin with it all its places; a match of the whole depth is followed
word by word to its end (``longest_matches``). The range of suffixes that begin with the item's window
gives all the window's occurrences (``contamination``): hits need every occurrence of a window, also
where a longer match stands elsewhere, so they are searched by themselves.

The benchmark is the stated query set. It is read in blocks of at most ``BLOCK_WORDS`` words (a
block's broadcast takes 170 bytes a word), ``PASS_BLOCKS`` of them in a pass over the documents: tasks
hold the blocks of one pass, the driver those of two, whatever the size of the benchmark. An item of more words is cut
into pieces that overlap by a window less a word, so it has all its windows (``longest_matches`` does
not cut it: its suffixes go on to the item's end). A benchmark of one pass is judged where the documents
are read, without a shuffle. With more passes each writes the texts that it hits, with the words hit, once
a text however many documents share it; the driver then releases its blocks and goes on. A document finds
the hits of its text by the SHA-256 of the text.

Words are lower-cased (A-Z) and match ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+``. A window is
``window`` consecutive words of an item; an item with fewer words, but not none, is one window.
Defined results: a null or empty text, or one without words, has no words and no hits; an empty
benchmark hits nothing; items that repeat a text are hit alike and each is reported; rows that
repeat an id are judged one by one; a null item id is reported as the text ``null``. A document
longer than ``SHARD_WORDS`` words is cut into shards that overlap by a window.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import partial, reduce
from itertools import chain, islice
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tables import written
from .textkit import BLOCK_BYTES, alphanumeric, blocks, expand, lower_ascii, word_hashes

WINDOW = 13
SHARD_WORDS = 1 << 19
SORT_WORDS = 16
BLOCK_WORDS = 1 << 17
PASS_BLOCKS = 4
PAIRS = 1 << 20


class Shard:
    """A suffix array over the words of a run of documents."""

    def __init__(self, words: np.ndarray, row_end: np.ndarray, vocabulary: np.ndarray, sort_words: int = SORT_WORDS):
        """``row_end[i]``: where the document of word ``i`` ends. Only suffixes that begin with
        a word of ``vocabulary`` (the benchmark's sorted words) are kept: no other is ever
        found by a search. Queries may have ``sort_words`` words."""
        self.ids = np.searchsorted(vocabulary, words)
        known = np.take(vocabulary, self.ids, mode="clip") == words if len(vocabulary) else np.zeros(len(words), bool)
        # Benchmark words get 1, 2, ...; all others are 0, which no query holds.
        self.ids = np.where(known, self.ids + 1, 0).astype(np.int64)
        self.row_end = row_end
        at = np.flatnonzero(known)
        rank = self.ids.copy()
        depth = 1
        while depth < sort_words and len(at):
            # Rank by 2 * depth words: the rank of the first half, then that of the second.
            after = np.minimum(at + depth, len(rank) - 1)
            second = np.where(at + depth < row_end[at], rank[after] + 1, 0)
            key = rank[at] * (len(rank) + len(vocabulary) + 2) + second
            order = np.argsort(key, kind="stable")
            at, key = at[order], key[order]
            rank = np.zeros_like(rank)
            rank[at] = np.concatenate(([1], 1 + np.cumsum(key[1:] != key[:-1])))
            depth *= 2
        self.suffixes = at

    def compare(self, suffix: np.ndarray, query: np.ndarray, length: np.ndarray):
        """Common words of each suffix with its query (rows of ``query``), and the sign of the
        first difference; a suffix that begins with the whole query compares as equal."""
        common = np.zeros(len(suffix), np.int64)
        sign = np.zeros(len(suffix), np.int64)
        live = np.arange(len(suffix))
        for i in range(query.shape[1]):
            live = live[i < length[live]]
            if not len(live):
                break
            place = suffix[live] + i
            inside = place < self.row_end[suffix[live]]
            word = np.where(inside, self.ids[np.minimum(place, len(self.ids) - 1)], -1)
            difference = np.sign(word - query[live, i])
            sign[live] = difference
            live = live[difference == 0]
            common[live] = i + 1
        return common, sign

    def bounds(self, query: np.ndarray, length: np.ndarray):
        """For each query: the range of suffixes that begin with it."""
        bounds = []
        for upper in (False, True):
            low = np.zeros(len(query), np.int64)
            high = np.full(len(query), len(self.suffixes), np.int64)
            while len(live := np.flatnonzero(low < high)):
                middle = (low[live] + high[live]) // 2
                _, sign = self.compare(self.suffixes[middle], query[live], length[live])
                right = sign <= 0 if upper else sign < 0
                low[live[right]] = middle[right] + 1
                high[live[~right]] = middle[~right]
            bounds.append(low)
        return bounds

    def longest(self, query: np.ndarray, length: np.ndarray):
        """For each query: the words of its longest match with any suffix."""
        insertion, _ = self.bounds(query, length)
        longest = np.zeros(len(query), np.int64)
        for neighbour in (insertion - 1, insertion):
            live = np.flatnonzero((neighbour >= 0) & (neighbour < len(self.suffixes)))
            common, _ = self.compare(self.suffixes[neighbour[live]], query[live], length[live])
            longest[live] = np.maximum(longest[live], common)
        return longest


class Queries:
    """The suffixes of a block of benchmark items, as rows of word numbers."""

    def __init__(self, texts: list[str], window: int):
        column = pa.array(texts, pa.large_string())
        fold, keep = lower_ascii(), alphanumeric()
        words, first = [], [0]
        for _, data, off in blocks(column):
            hashes, _, _, begin = word_hashes(data, off, keep, fold)
            words.append(hashes)
            first.extend((first[-1] + begin[1:]).tolist())
        flat = np.concatenate([*words, np.zeros(0, np.uint64)])
        self.vocabulary, numbers = np.unique(flat, return_inverse=True)
        first = np.asarray(first)
        count = np.diff(first)
        item = np.repeat(np.arange(len(texts)), count)
        start = np.arange(len(flat))
        left = first[1:][item] - start
        depth = max(window, SORT_WORDS)
        self.length = np.minimum(left, depth)
        self.rows = np.zeros((len(flat), depth), np.int64)
        for i in range(depth):
            inside = i < left
            self.rows[inside, i] = numbers[start[inside] + i] + 1
        # Suffixes that begin with a window: those of at least ``window`` words, and the first
        # of a shorter item.
        self.window = np.where(left >= window, window, np.where((count[item] < window) & (start == first[:-1][item]), left, 0))
        self.item, self.word = item, start - first[:-1][item]
        # The whole suffixes: ``left`` words of ``flat`` from ``start`` on.
        self.flat, self.start, self.left = flat, start, left
        # Each distinct window and suffix is searched once.
        if len(flat):
            self.rows, back = np.unique(np.column_stack([self.rows, self.length, self.window]), axis=0, return_inverse=True)
            self.length, self.window, self.rows = self.rows[:, -2], self.rows[:, -1], self.rows[:, :-2]
            order = np.argsort(back, kind="stable")
            self.item, self.word, self.start, self.left = item[order], self.word[order], start[order], left[order]
            self.of = np.searchsorted(back[order], np.arange(len(self.rows) + 1))
        else:
            self.of = np.zeros(1, np.int64)


def shards(words: np.ndarray, first: np.ndarray, overlap: int) -> Iterator[tuple[int, int, np.ndarray]]:
    """Runs of whole rows of about ``SHARD_WORDS`` words; a longer row in overlapping parts:
    (first word, last word, where each word's row ends within the run)."""
    row, n = 0, len(first) - 1
    while row < n:
        last = max(row + 1, int(np.searchsorted(first, first[row] + SHARD_WORDS, "right")) - 1)
        lo, hi = int(first[row]), int(first[last])
        if last == row + 1 and hi - lo > SHARD_WORDS:
            for at in range(lo, hi, SHARD_WORDS):
                to = min(hi, at + SHARD_WORDS + overlap)
                yield at, to, np.full(to - at, to - at)
        elif hi > lo:
            yield lo, hi, np.repeat(first[row + 1:last + 1] - lo, np.diff(first[row:last + 1]))
        row = last


def _blocks_of(batch):
    """(ids, word hashes, first word of each row) for runs of rows of a batch."""
    fold, keep = lower_ascii(), alphanumeric()
    for row, data, off in blocks(batch.column(1)):
        words, _, _, first = word_hashes(data, off, keep, fold)
        yield batch.column(0).slice(row, len(off) - 1), words, first


def _extend(words: np.ndarray, place: np.ndarray, end: np.ndarray, q, entry: np.ndarray, common: np.ndarray):
    """Words that the text at each place has in common with a whole suffix, known to be ``common`` at least."""
    n = common.copy()
    live = np.arange(len(n))
    while len(live):
        live = live[(place[live] + n[live] < end[live]) & (n[live] < q.left[entry[live]])]
        live = live[words[place[live] + n[live]] == q.flat[q.start[entry[live]] + n[live]]]
        n[live] += 1
    return n


def _matches(words: np.ndarray, first: np.ndarray, q, best: np.ndarray):
    """(suffix of an item, place, words) of the longest matches of every shard, all places of each,
    without suffixes of which a longer match is known (``best``, kept up)."""
    depth = q.rows.shape[1]
    for lo, hi, row_end in shards(words, first, depth):
        shard = Shard(words[lo:hi], row_end, q.vocabulary, depth)
        # A suffix in the overlap belongs to the next part.
        shard.suffixes = shard.suffixes[shard.suffixes < SHARD_WORDS]
        longest = shard.longest(q.rows, q.length)
        some = np.flatnonzero(longest > 0)
        low, high = shard.bounds(q.rows[some], longest[some])
        copies = q.of[some + 1] - q.of[some]
        entry, of = expand(q.of[some], copies), np.repeat(np.arange(len(some)), copies)
        able = (longest[some][of] == depth) | (longest[some][of] >= best[entry])
        entry, of = entry[able], of[able]
        count = (high - low)[of]
        # About PAIRS places at a time, all those of a suffix together.
        part = np.cumsum(count) // PAIRS
        for own in np.split(np.arange(len(entry)), np.flatnonzero(np.diff(part)) + 1):
            pair = np.repeat(own, count[own])
            place = lo + shard.suffixes[expand(low[of[own]], count[own])]
            end = first[np.searchsorted(first, place, "right")]
            n = longest[some][of[pair]]
            full = np.flatnonzero(n == depth)
            n[full] = _extend(words, place[full], end[full], q, entry[pair[full]], n[full])
            np.maximum.at(best, entry[pair], n)
            most = n == best[entry[pair]]
            yield entry[pair[most]], place[most], n[most]


def _longest(batches, parts, first_block: int):
    best = [np.zeros(len(sent.value.item), np.int64) for _, sent in parts]
    for batch in batches:
        for ids, words, first in _blocks_of(batch):
            for k, (names, sent) in enumerate(parts):
                q = sent.value
                for entry, place, n in _matches(words, first, q, best[k]):
                    doc = np.searchsorted(first, place, "right") - 1
                    yield pa.RecordBatch.from_arrays([
                        pa.array(np.full(len(entry), first_block + k), pa.int32()), pa.array(entry),
                        pa.array([names[i] for i in q.item[entry].tolist()], pa.string()), pa.array(q.word[entry]),
                        pa.array(n), ids.take(pa.array(doc)), pa.array(place - first[doc])],
                        ["block", "entry", "item_id", "item_word", "n_words", "doc_id", "doc_word"])


def _hits(words: np.ndarray, first: np.ndarray, q):
    """A flag for each word inside an occurrence of a window, and the pairs (row, window)."""
    lead = np.flatnonzero(q.window > 0)
    change = np.zeros(len(words) + 1, np.int64)
    pairs = [np.zeros((0, 2), np.int64)]
    for lo, hi, row_end in shards(words, first, q.rows.shape[1]):
        shard = Shard(words[lo:hi], row_end, q.vocabulary, q.rows.shape[1])
        low, high = shard.bounds(q.rows[lead], q.window[lead])
        count = high - low
        places = lo + shard.suffixes[expand(low, count)]
        np.add.at(change, places, 1)
        np.add.at(change, places + np.repeat(q.window[lead], count), -1)
        pairs.append(np.column_stack([np.searchsorted(first, places, "right") - 1, np.repeat(lead, count)]))
    return np.cumsum(change)[:-1] > 0, np.unique(np.concatenate(pairs), axis=0)


def _searched(batches, parts):
    """For runs of rows: ids, first word of each row, the words that are hit, the items of each row."""
    for batch in batches:
        for ids, words, first in _blocks_of(batch):
            hit = np.zeros(len(words), bool)
            items = [set() for _ in range(len(first) - 1)]
            for names, sent in parts:
                q = sent.value
                mask, pairs = _hits(words, first, q)
                hit |= mask
                for row, window in pairs.tolist():
                    items[row].update(names[i] for i in q.item[q.of[window]:q.of[window + 1]].tolist())
            yield ids, first, hit, items


def _judge(batches, parts):
    """Per document: its words, the hit ones over all blocks of the benchmark, the items."""
    for ids, first, hit, items in _searched(batches, parts):
        covered = np.concatenate(([0], np.cumsum(hit)))[first]
        yield pa.RecordBatch.from_arrays([
            ids, pa.array(np.diff(first).astype(np.int64)), pa.array(np.diff(covered).astype(np.int64)),
            pa.array([sorted(x) for x in items], pa.list_(pa.string()))], ["doc_id", "n_words", "n_hit", "items"])


def _hit_spans(batches, parts):
    """Per document with a hit: its words, the runs of hit words as (start, end), the items."""
    for ids, first, hit, items in _searched(batches, parts):
        rows = np.flatnonzero([len(x) > 0 for x in items])
        spans = []
        for row in rows.tolist():
            edge = np.diff(np.concatenate(([0], hit[first[row]:first[row + 1]], [0])))
            spans.append([{"start": a, "end": b} for a, b in zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist())])
        yield pa.RecordBatch.from_arrays([
            ids.take(pa.array(rows)), pa.array(np.diff(first)[rows].astype(np.int64)),
            pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
            pa.array([sorted(items[row]) for row in rows.tolist()], pa.list_(pa.string()))], ["text_key", "n_words", "spans", "items"])


def _pieces(text: str, window: int | None) -> Iterator[str]:
    """A text of more than a block's bytes in pieces of ``BLOCK_WORDS`` words that together hold all its windows."""
    if window is None or len(text.encode()) <= 2 * BLOCK_WORDS:
        yield text
        return
    words = re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", text)
    size = max(BLOCK_WORDS, window)
    for at in range(0, max(1, len(words) - window + 1), size - window + 1):
        yield " ".join(words[at:at + size])


def benchmark_blocks(benchmark: DataFrame, item_col: str, text_col: str, window: int | None = None) -> Iterator[tuple[list, list]]:
    """The benchmark in blocks of at most ``BLOCK_WORDS`` words (one piece of an item at least, the whole item
    without ``window``): a word has at least two bytes with its separator, so bytes bound words."""
    names, texts, size = [], [], 0
    rows = benchmark.select(F.col(item_col).cast("string"), F.coalesce(F.col(text_col), F.lit(""))).orderBy(item_col)
    for name, text in rows.toLocalIterator():
        for piece in _pieces(text, window):
            if texts and size + len(piece.encode()) > 2 * BLOCK_WORDS:
                yield names, texts
                names, texts, size = [], [], 0
            names.append("null" if name is None else name)
            texts.append(piece)
            size += len(piece.encode())
    yield names, texts


def _passes(docs: DataFrame, block_texts: Iterator[tuple[list, list]], window: int) -> Iterator[list]:
    """The blocks of one pass after the other, as names and broadcast queries."""
    context = docs.sparkSession.sparkContext
    while part := list(islice(block_texts, PASS_BLOCKS)):
        yield [(names, context.broadcast(SimpleNamespace(**vars(Queries(texts, window))))) for names, texts in part]


def _release(parts) -> None:
    """Free the blocks of a pass whose rows are written: nothing computes them again."""
    for _, sent in parts:
        sent.destroy()


def _text_key(text: Column) -> Column:
    return F.sha2(F.coalesce(text, F.lit("")), 256)


def _hits_by_text(docs: DataFrame, text_col: str, passes: Iterator[list]) -> DataFrame:
    """One row per text that a pass hits: ``text_key``, ``n_words``, ``n_hit``, ``items``. The rows of a text are alike
    within a pass and are made one in their tasks first; over the passes a text has a row each at most."""
    found = []
    for parts in passes:
        hits = docs.select(_text_key(docs[text_col]).alias("text_key"), text_col).mapInArrow(
            partial(_hit_spans, parts=parts),
            "text_key string, n_words long, spans array<struct<start: long, end: long>>, items array<string>")
        once = hits.groupBy("text_key").agg(*[F.first(c).alias(c) for c in ("n_words", "spans", "items")])
        found.append(written(once, "hits-of-pass"))
        _release(parts)
    covered = F.expr("""aggregate(array_sort(flatten(collect_list(spans))), named_struct('n', 0L, 'upto', 0L),
        (a, s) -> named_struct('n', a.n + greatest(0L, s.end - greatest(a.upto, s.start)), 'upto', greatest(a.upto, s.end)), a -> a.n)""")
    return reduce(DataFrame.unionByName, found).groupBy("text_key").agg(
        F.first("n_words").alias("n_words"), covered.alias("n_hit"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))


def longest_matches(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    item_col: str = "item_id", item_text: str = "text", window: int = WINDOW) -> DataFrame:
    """For each benchmark suffix (the words of an item from one on) its longest verbatim match with any
    document, of any length, and all places of it: item_id, item_word, n_words, doc_id, doc_word.
    Suffixes without a match have no row."""
    kind = docs.schema[id_col].dataType.simpleString()
    found = []
    for k, parts in enumerate(_passes(docs, benchmark_blocks(benchmark, item_col, item_text), window)):
        places = docs.select(id_col, text_col).mapInArrow(
            partial(_longest, parts=parts, first_block=k * PASS_BLOCKS),
            f"block int, entry long, item_id string, item_word long, n_words long, doc_id {kind}, doc_word long")
        found.append(written(places, "matches-of-shards"))
        _release(parts)
    found = reduce(DataFrame.unionByName, found)
    most = written(found.groupBy("block", "entry").agg(F.max("n_words").alias("n_words")), "matches-longest")
    return found.join(most, ["block", "entry", "n_words"]).select("item_id", "item_word", "n_words", "doc_id", "doc_word")


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text: str = "text", window: int = WINDOW) -> DataFrame:
    """One row per document: id, ``n_words``, ``n_hit``, ``items`` (item ids as sorted strings),
    ``contaminated`` (a hit, and at least a twentieth of the words)."""
    kind = docs.schema[id_col].dataType.simpleString()
    passes = _passes(docs, benchmark_blocks(benchmark, item_col, item_text, window), window)
    parts, more = list(islice(passes, 2)), passes
    if len(parts) == 1:
        hits = docs.select(id_col, text_col).mapInArrow(
            partial(_judge, parts=parts[0]), f"doc_id {kind}, n_words long, n_hit long, items array<string>")
    else:
        texts = _hits_by_text(docs, text_col, chain(parts, more)).drop("n_words")
        key = F.struct(F.col(id_col).alias("id"), _text_key(docs[text_col]).alias("text_key"))
        own = docs.select(key.alias("doc_id"), text_col).mapInArrow(
            partial(_judge, parts=[]), f"doc_id struct<id: {kind}, text_key: string>, n_words long, n_hit long, items array<string>")
        hits = own.select(F.col("doc_id.id").alias("doc_id"), F.col("doc_id.text_key").alias("text_key"), "n_words").join(texts, "text_key", "left")
        hits = hits.withColumn("n_hit", F.coalesce("n_hit", F.lit(0).cast("long"))) \
                   .withColumn("items", F.coalesce("items", F.array().cast("array<string>")))
    return hits.select(
        F.col("doc_id").alias(id_col), "n_words", "n_hit", "items",
        _over_a_twentieth().alias("contaminated"))


def _over_a_twentieth():
    return (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))


def _clean(batches, parts, at: int):
    for batch in batches:
        column = pa.RecordBatch.from_arrays([pa.array(np.arange(batch.num_rows)), batch.column(at)], ["doc_id", "text"])
        gone = np.concatenate([np.zeros(0, bool), *(_contaminated(x) for x in _judge([column], parts))])
        yield batch.filter(pa.array(~gone))


def _contaminated(judged) -> np.ndarray:
    words, hit = (judged.column(k).to_numpy() for k in ("n_words", "n_hit"))
    return (hit > 0) & (20 * hit >= words)


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text",
                        item_col: str = "item_id", item_text: str = "text", window: int = WINDOW) -> DataFrame:
    """The rows that are not contaminated, with their columns; with a benchmark of one pass no row is
    shuffled."""
    passes = _passes(docs, benchmark_blocks(benchmark, item_col, item_text, window), window)
    parts, more = list(islice(passes, 2)), passes
    if len(parts) == 1:
        return docs.mapInArrow(partial(_clean, parts=parts[0], at=docs.columns.index(text_col)), docs.schema)
    gone = _hits_by_text(docs, text_col, chain(parts, more)).filter(_over_a_twentieth()).select("text_key")
    gone = written(gone, "contaminated-texts")
    return docs.join(gone, _text_key(docs[text_col]) == gone["text_key"], "left_anti")
