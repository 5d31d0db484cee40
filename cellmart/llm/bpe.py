"""BPE encoding and decoding with a minimal acyclic transducer as the lexicon.

1. ``count_words`` counts the pre-tokenised words of all documents; the most
   frequent ones, at most ``LEXICON_WORDS`` (a documented bound), are brought to the driver.
2. ``Transducer`` compiles them into a minimal automaton: words share prefixes and suffixes, and
   integers on its arcs add up to a word's number, which selects its row of token ids. Its
   arrays (a few MB, bounded by ``LEXICON_WORDS``) are sent to the tasks, which memory-map them.
3. ``encode`` cuts whole blocks of text into words, looks all words of a block up symbol by
   symbol at once, and merges the words the lexicon does not hold by the merge list (exact, with
   a bounded cache). The lexicon only saves work: any lexicon gives the same ids.

The word pattern is that of the tokenizer file: contractions, letter runs, single numbers, runs
of other characters; lower case, white space dropped, NFC. Texts of Latin-1 characters are cut
on their bytes; texts with any other character, or with the special tokens' strings, are cut by
the tokenizers library's own normaliser and pre-tokeniser and merged the same way.

Defined results: a null text counts as empty and has no ids; rows that repeat are encoded row
by row; other columns are ignored.
"""

from __future__ import annotations

import heapq
import io
import json
import re
import tempfile
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import written
from .textkit import blocks, prefix_sums, span_hashes

LEXICON_WORDS = 1 << 16
CACHED_WORDS = 1 << 14
FLUSH_WORDS = 1 << 15
SHORT_WORD = 64


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies: printable
    Latin-1 characters stand for themselves, the rest take code points from 256 on."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = iter(range(256, 512))
    return [chr(b) if b in set(own) else chr(next(rest)) for b in range(256)]


class Merges:
    """Exact byte-pair merges of one word by the tokenizer's merge list."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self.suffix = spec["model"].get("end_of_word_suffix") or ""
        self.vocab = spec["model"]["vocab"]
        pairs = (tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in spec["model"]["merges"])
        self.ranks = {pair: rank for rank, pair in enumerate(pairs)}
        self.specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.alphabet = byte_alphabet()
        self.bytes_of = {c: b for b, c in enumerate(self.alphabet)}

    def tokens(self, word: bytes) -> list[str]:
        """The word's tokens: of all adjacent pairs the one of lowest rank, leftmost first, is
        merged until no pair has a rank."""
        parts = [self.alphabet[b] for b in word]
        parts[-1] += self.suffix
        if len(parts) <= SHORT_WORD:
            return self._short(parts)
        after = list(range(1, len(parts))) + [-1]
        before = list(range(-1, len(parts) - 1))
        heap = [(self.ranks[p], i, p) for i, p in enumerate(zip(parts, parts[1:])) if p in self.ranks]
        heapq.heapify(heap)
        while heap:
            _, i, pair = heapq.heappop(heap)
            j = after[i]
            if j < 0 or parts[i] is None or (parts[i], parts[j]) != pair:
                continue
            parts[i], parts[j] = parts[i] + parts[j], None
            after[i] = after[j]
            if after[j] >= 0:
                before[after[j]] = i
            for a, b in ((before[i], i), (i, after[i])):
                if a >= 0 and b >= 0 and (parts[a], parts[b]) in self.ranks:
                    heapq.heappush(heap, (self.ranks[parts[a], parts[b]], a, (parts[a], parts[b])))
        return [p for p in parts if p is not None]

    def _short(self, parts: list[str]) -> list[str]:
        """The same for short words, without a heap."""
        none = len(self.ranks)
        ranks = [self.ranks.get(p, none) for p in zip(parts, parts[1:])]
        while ranks and (best := min(ranks)) < none:
            i = ranks.index(best)
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
            del ranks[i]
            if i:
                ranks[i - 1] = self.ranks.get((parts[i - 1], parts[i]), none)
            if i < len(ranks):
                ranks[i] = self.ranks.get((parts[i], parts[i + 1]), none)
        return parts

    def row(self, word: bytes) -> tuple[bytes, bytes]:
        """Ids as little-endian 32-bit integers, and the tokens as decoding writes them."""
        tokens = self.tokens(word)
        return np.array([self.vocab[t] for t in tokens], "<u4").tobytes(), " ".join(tokens).encode()


class Transducer:
    """A minimal acyclic automaton over sorted distinct words; the integers on a word's arcs add
    up to the word's place in that order. Arcs lie in one array: the arc of a state for a byte
    is at ``base[state] + byte`` if ``owner`` there is the state."""

    FIELDS = ("base", "final", "owner", "target", "add")

    @classmethod
    def build(cls, words: list[bytes]) -> "Transducer":
        arcs: list[dict] = [{}]
        final = [False]
        register: dict[tuple, int] = {}

        def minimise(path: list[tuple[int, int, int]], down_to: int) -> None:
            # Replace the states of the last word's tail by equal registered ones.
            while len(path) > down_to:
                parent, byte, child = path.pop()
                key = (final[child], tuple(arcs[child].items()))
                same = register.setdefault(key, child)
                if same != child:
                    arcs[parent][byte] = same

        path: list[tuple[int, int, int]] = []
        last = b""
        for word in words:
            shared = 0
            while shared < min(len(word), len(last)) and word[shared] == last[shared]:
                shared += 1
            minimise(path, shared)
            state = path[-1][2] if path else 0
            for byte in word[shared:]:
                arcs.append({})
                final.append(False)
                arcs[state][byte] = len(arcs) - 1
                path.append((state, byte, len(arcs) - 1))
                state = len(arcs) - 1
            final[state] = True
            last = word
        minimise(path, 0)
        return cls._packed(arcs, final)

    @classmethod
    def _packed(cls, arcs: list[dict], final: list[bool]) -> "Transducer":
        order, seen, stack = [], {0}, [0]
        while stack:
            state = stack.pop()
            order.append(state)
            for child in arcs[state].values():
                if child not in seen:
                    seen.add(child)
                    stack.append(child)
        # Words that can be completed from a state; children have larger old numbers or were
        # registered earlier, so a depth-first count with memory is used.
        below: dict[int, int] = {}
        stack = [0]
        while stack:
            state = stack[-1]
            open_ = [c for c in arcs[state].values() if c not in below]
            if open_:
                stack.extend(open_)
            else:
                below[state] = int(final[state]) + sum(below[c] for c in arcs[state].values())
                stack.pop()
        number = {state: i for i, state in enumerate(order)}
        size = 4096 + 8 * sum(len(arcs[s]) for s in order)
        owner, target, add = (np.full(size, -1, np.int32) for _ in range(3))
        base = np.zeros(len(order), np.int32)
        free = np.ones(size, bool)
        low = min((b for s in order for b in arcs[s]), default=0)
        for state in sorted(order, key=lambda s: -len(arcs[s])):
            own = sorted(arcs[state])
            if not own:
                continue
            # The first place where all arcs of the state fall on free slots, a window at a time.
            while not free[low]:
                low += 1
            begin, places = max(0, low - own[0]), []
            while not len(places):
                places = begin + np.flatnonzero(free[begin + own[0]:begin + own[0] + 1024])
                for byte in own[1:]:
                    places = places[free[places + byte]]
                begin += 1024
            at = int(places[0])
            base[number[state]] = at
            passed = int(final[state])
            for byte in own:
                free[at + byte] = False
                owner[at + byte], target[at + byte], add[at + byte] = number[state], number[arcs[state][byte]], passed
                passed += below[arcs[state][byte]]
        out = cls()
        out.base, out.owner, out.target, out.add = base, owner, target, add
        out.final = np.array([final[s] for s in order], bool)
        return out

    def dump(self) -> bytes:
        file = io.BytesIO()
        for name in self.FIELDS:
            np.save(file, getattr(self, name))
        return file.getvalue()

    @classmethod
    def mapped(cls, data: bytes) -> "Transducer":
        """The automaton as read-only memory maps of one unnamed temporary file."""
        out = cls()
        with tempfile.TemporaryFile() as file:
            file.write(data)
            file.seek(0)
            for name in cls.FIELDS:
                version = np.lib.format.read_magic(file)
                shape, _, kind = np.lib.format.read_array_header_1_0(file) if version == (1, 0) else np.lib.format.read_array_header_2_0(file)
                at = file.tell()
                setattr(out, name, np.memmap(file, kind, "r", at, shape) if np.prod(shape) else np.zeros(shape, kind))
                file.seek(at + int(np.prod(shape)) * kind.itemsize)
        return out

    def numbers(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The number of each byte span, -1 where the lexicon does not hold it; one symbol of
        all spans is followed at a time."""
        state = np.zeros(len(starts), np.int32)
        total = np.zeros(len(starts), np.int32)
        live = np.arange(len(starts))
        column = 0
        while len(live := live[ends[live] - starts[live] > column]):
            slot = self.base[state[live]] + data[starts[live] + column]
            found = self.owner[slot] == state[live]
            state[live[~found]] = -1
            live, slot = live[found], slot[found]
            total[live] += self.add[slot]
            state[live] = self.target[slot]
            column += 1
        return np.where((state >= 0) & self.final[np.maximum(state, 0)], total, -1)


def _tables() -> tuple[np.ndarray, np.ndarray]:
    """Classes of ASCII bytes and of second bytes after C2 and C3: 0 white space, 1 letter,
    2 number, 3 other."""
    one = np.full(256, 3, np.uint8)
    one[[0x20, *range(0x09, 0x0E)]] = 0
    one[65:91] = one[97:123] = 1
    one[48:58] = 2
    two = np.full((2, 256), 3, np.uint8)
    two[0, [0x85, 0xA0]] = 0
    two[0, [0xAA, 0xB5, 0xBA]] = 1
    two[0, [0xB2, 0xB3, 0xB9, 0xBC, 0xBD, 0xBE]] = 2
    two[1, 0x80:0xC0] = 1
    two[1, [0x97, 0xB7]] = 3
    return one, two


_ONE, _TWO = _tables()


def latin_words(data: np.ndarray, off: np.ndarray):
    """Folded bytes, starts and ends of the words of Latin-1 texts in UTF-8."""
    folded = data.copy()
    upper = (data >= 65) & (data <= 90)
    second = np.zeros(len(data), bool)
    second[1:] = data[:-1] >= 0xC2
    capital = np.zeros(len(data), bool)
    capital[1:] = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)
    folded[upper | capital] += 32
    kind = _ONE[data]
    at = np.flatnonzero(second)
    kind[at] = kind[at - 1] = _TWO[data[at - 1] - 0xC2, data[at]]
    edge = np.zeros(len(data) + 1, bool)
    edge[off] = True
    border = edge.copy()
    border[-1] = True
    border[1:-1] |= kind[1:] != kind[:-1]
    border[:-1] |= (kind == 2) & ~second
    places = np.flatnonzero(border)
    starts, ends = places[:-1], places[1:]
    word = kind[starts] > 0 if len(data) else np.zeros(0, bool)
    starts, ends = starts[word], ends[word]
    # 's 't 'm 'd 're 've 'll after a lone apostrophe belong to it.
    lone = np.flatnonzero((ends[:-1] - starts[:-1] == 1) & (folded[starts[:-1]] == 39) & (starts[1:] == ends[:-1]) & ~edge[starts[1:]]) if len(starts) > 1 else np.zeros(0, np.int64)
    if len(lone):
        begin, end = starts[lone + 1], ends[lone + 1]
        first, next_ = folded[begin], folded[np.minimum(begin + 1, len(folded) - 1)]
        two = (end - begin >= 2) & (((first == 114) | (first == 118)) & (next_ == 101) | (first == 108) & (next_ == 108))
        taken = np.where(np.isin(first, [115, 116, 109, 100]), 1, np.where(two, 2, 0))
        ends[lone] += taken
        starts[lone + 1] += taken
        left = starts < ends
        starts, ends = starts[left], ends[left]
    return folded, starts, ends


class Cutter:
    """Words of any text: Latin-1 blocks on their bytes, other rows through the library."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        library = Tokenizer.from_file(path)
        self.normalise, self.cut = library.normalizer.normalize_str, library.pre_tokenizer.pre_tokenize_str
        self.merges = Merges(path)
        self.special = re.compile("(" + "|".join(map(re.escape, self.merges.specials)) + ")")

    def rows(self, column):
        """(first row, rows, folded bytes, starts, ends, first word of each row, other words by row)."""
        for row, data, off in blocks(column):
            plain = np.concatenate(([0], np.cumsum(data >= 0xC4)))
            wide = plain[off[1:]] > plain[off[:-1]]
            if any(s.encode() in data.tobytes() for s in self.merges.specials):
                for i in range(len(wide)):
                    text = data[off[i]:off[i + 1]].tobytes()
                    wide[i] |= any(s.encode() in text for s in self.merges.specials)
            other = {i: self.words(data[off[i]:off[i + 1]].tobytes().decode()) for i in np.flatnonzero(wide).tolist()}
            if other:
                keep = np.repeat(~wide, np.diff(off))
                data = data[keep]
                off = np.concatenate(([0], np.cumsum(np.where(wide, 0, np.diff(off)))))
            folded, starts, ends = latin_words(data, off)
            yield row, len(off) - 1, folded, starts, ends, np.searchsorted(starts, off), other

    def words(self, text: str) -> list[bytes | int]:
        """Words of a text by the library; a special token's id stands for itself."""
        out: list[bytes | int] = []
        for i, part in enumerate(self.special.split(text)):
            if i % 2:
                out.append(self.merges.specials[part])
            elif part:
                out.extend(bytes(self.merges.bytes_of[c] for c in w) for w, _ in self.cut(self.normalise(part)))
        return out


def _count(batches, path: str):
    cutter, counts = Cutter(path), {}

    def flush():
        out = pa.RecordBatch.from_arrays([pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())], ["word", "n"])
        counts.clear()
        return out

    for batch in batches:
        for _, _, folded, starts, ends, _, other in cutter.rows(batch.column(0)):
            hashes = span_hashes(prefix_sums(folded), starts, ends)
            _, at, n = np.unique(hashes, return_index=True, return_counts=True)
            raw = folded.tobytes()
            for s, e, k in zip(starts[at].tolist(), ends[at].tolist(), n.tolist()):
                word = raw[s:e]
                counts[word] = counts.get(word, 0) + k
            for words in other.values():
                for word in words:
                    if isinstance(word, bytes):
                        counts[word] = counts.get(word, 0) + 1
            if len(counts) > FLUSH_WORDS:
                yield flush()
    yield flush()


def count_words(docs: DataFrame, path: str, text_col: str = "text") -> DataFrame:
    """Occurrences of every pre-tokenised word of all documents: word (bytes), n."""
    return (docs.select(text_col).mapInArrow(partial(_count, path=path), "word binary, n long")
            .groupBy("word").agg(F.sum("n").alias("n")))


def build_lexicon(docs: DataFrame, path: str, size: int = LEXICON_WORDS, text_col: str = "text"):
    """The most frequent words, ``size`` at most, as a transducer with their ids and decoded
    tokens. Words are taken by whole bands of frequency (eighths of a doubling), so the cut needs
    only the number of words in each band, and the driver gets the chosen words alone."""
    counts = count_words(docs, path, text_col).where("n > 1").withColumn("band", F.floor(F.log2("n") * 8))
    counts = written(counts, "word-counts")
    bands = sorted(counts.groupBy("band").agg(F.count("*").alias("words")).collect(), reverse=True)
    total, least = 0, None
    for band, words in bands:
        total += words
        if total > size:
            break
        least = band
    top = counts.where(F.col("band") >= least).select("word").collect() if least is not None else []
    words = sorted(bytes(r["word"]) for r in top)
    merges = Merges(path)
    return Transducer.build(words).dump(), [merges.row(w) for w in words]


def _encode(batches, path: str, lexicon):
    cutter = Cutter(path)
    arrays, rows = lexicon.value
    automaton = Transducer.mapped(arrays)
    ids, shown = [r[0] for r in rows], [r[1] for r in rows]
    special = {i: (np.array([i], "<u4").tobytes(), s.encode()) for s, i in cutter.merges.specials.items()}
    known, size = {}, len(ids)

    def number(word) -> int:
        at = known.get(word)
        if at is None:
            at = known[word] = len(ids)
            a, b = cutter.merges.row(word) if isinstance(word, bytes) else special[word]
            ids.append(a)
            shown.append(b)
        return at

    for batch in batches:
        for row, n, folded, starts, ends, first, other in cutter.rows(batch.column(1)):
            if len(known) > CACHED_WORDS:
                known.clear()
                del ids[size:], shown[size:]
            numbers = automaton.numbers(folded, starts, ends).tolist()
            raw = folded.tobytes()
            for i, x in enumerate(numbers):
                if x < 0:
                    numbers[i] = number(raw[starts[i]:ends[i]])
            bounds = first.tolist()
            lists = [[number(w) for w in other[i]] if i in other else numbers[bounds[i]:bounds[i + 1]] for i in range(n)]
            coded = [b"".join(map(ids.__getitem__, x)) for x in lists]
            yield pa.RecordBatch.from_arrays([
                batch.column(0).slice(row, n), pa.array([len(x) // 4 for x in coded], pa.int64()),
                pa.array(coded, pa.binary()),
                pc.cast(pa.array([b" ".join(map(shown.__getitem__, x)) for x in lists], pa.binary()), pa.string())],
                ["doc_id", "n_tokens", "ids", "decoded"])


def encode(docs: DataFrame, path: str, size: int = LEXICON_WORDS, id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """Per row: id, ``n_tokens``, ``ids`` (little-endian unsigned 32-bit integers) and
    ``decoded`` (the tokens joined by spaces: the file has no decoder)."""
    sent = docs.sparkSession.sparkContext.broadcast(build_lexicon(docs, path, size, text_col))
    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(
        partial(_encode, path=path, lexicon=sent),
        f"doc_id {kind}, n_tokens long, ids binary, decoded string").withColumnRenamed("doc_id", id_col)
