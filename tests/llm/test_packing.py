"""Packing: ids of the tokenizers library, gapless sequences, bin counts near the lower bound."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from cellmart.llm import packing

PATH = public_tokenizers.path("byte_bpe_50k.json")
SCHEMA = "doc_id long, text string, piece string, length string, rank string"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "clash", "clash", "clash") for i, t in rows], SCHEMA).repartition(3)


def least_bins(counts, capacity):
    """No packing has fewer bins: pieces over half a bin cannot meet, and fill up with what fits them at most."""
    best = 0
    for edge in range(capacity // 2 + 1):
        alone = sum(n for k, n in counts.items() if k > capacity - edge)
        half = {k: n for k, n in counts.items() if capacity // 2 < k <= capacity - edge}
        small = sum(k * n for k, n in counts.items() if edge <= k <= capacity // 2)
        spare = sum((capacity - k) * n for k, n in half.items())
        best = max(best, alone + sum(half.values()) + max(0, -(-(small - spare) // capacity)))
    return best


def check(rows, got, capacity):
    library = Tokenizer.from_file(PATH)
    want = Counter()
    for i, text in rows:
        ids = np.array(library.encode(text or "", add_special_tokens=False).ids + [2], "<u4")
        first = (len(ids) - 1) % capacity + 1
        cuts = [0, *range(first, len(ids) + 1, capacity)]
        for p, (a, b) in enumerate(zip(cuts, cuts[1:])):
            want[i, p, a, b - a, zlib.crc32(ids[a:b].tobytes())] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == want
    bins = defaultdict(list)
    for r in got:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for pieces in bins.values():
        place = 0
        for offset, length in sorted(pieces):
            assert offset == place
            place += length
        assert place <= capacity
    return len(bins), least_bins(Counter(r["length"] for r in got), capacity)


def test_pieces_and_places(spark):
    rnd = random.Random(3)
    words = ["the", "Übung", "漢字", "  x", "\n\n", "<|endoftext|>", "don't", "1234", "é́", " ", "\x00", "aaaaaaaaaaaa"]
    rows = [(i, " ".join(rnd.choice(words) for _ in range(rnd.choice([1, 5, 40, 300])))) for i in range(300)]
    rows += [(1000, None), (1001, ""), (1002, "long word " * 20_000), (1003, "<|endoftext|"), (None, "no id"), (7, "again"), (7, "again")]
    rows += [(2000 + i, "same text") for i in range(500)]
    got = packing.pack(frame(spark, rows), PATH).collect()
    bins, least = check(rows, got, packing.CAPACITY)
    assert bins <= least + 1
    assert packing.pack(frame(spark, []), PATH).count() == 0
    with_ids = packing.pack(frame(spark, rows[:50]), PATH, capacity=16, keep_ids=True).collect()
    check(rows[:50], with_ids, 16)
    assert all(zlib.crc32(bytes(r["ids"])) == r["ids_crc32"] and len(r["ids"]) == 4 * r["length"] for r in with_ids)


def test_long_runs_are_encoded():
    encoder, library = packing.Encoder(PATH), Tokenizer.from_file(PATH)
    for text in ("a" * 30_000, " " * 30_000, "^" * 30_000, "\n" * 30_000, "漢" * 10_000, "x" + " " * 20_000 + "y"):
        assert list(encoder.ids(text)) == library.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("seed", range(6))
def test_fullest_is_the_fullest(seed):
    rnd = random.Random(seed)
    counts = {rnd.randint(1, 30): rnd.randint(1, 3) for _ in range(5)}
    room = rnd.randint(5, 60)
    chosen = packing.fullest(counts, room)
    assert all(n <= counts[k] for k, n in chosen.items())
    items = [k for k, n in counts.items() for _ in range(n)]
    best = max(sum(k for i, k in enumerate(items) if mask >> i & 1) for mask in range(1 << len(items))
               if sum(k for i, k in enumerate(items) if mask >> i & 1) <= room)
    assert sum(k * n for k, n in chosen.items()) == best


def test_plan_is_small_and_tight():
    rnd = random.Random(8)
    counts = {n: rnd.randint(1, 10 ** 9) for n in range(1, 1025)}
    plan = packing.minimum_bin_slack(counts, 1024)
    used = Counter()
    for chosen, times in plan:
        assert sum(k * n for k, n in chosen.items()) <= 1024
        for k, n in chosen.items():
            used[k] += n * times
    assert used == Counter(counts) and len(plan) < 4096
    assert sum(times for _, times in plan) <= 1.01 * least_bins(counts, 1024)


def test_slots_cover_every_rank_once():
    plan = [({5: 2, 3: 1}, 4), ({5: 1}, 3)]
    table = packing.slots(plan)
    got = set()
    for length, total in ((5, 11), (3, 4)):
        for rank in range(total):
            row = [r for r in table.tolist() if r[0] == length and r[1] <= rank][-1]
            turn = rank - row[1]
            got.add((row[2] + turn // row[3], row[4] + turn % row[3] * length, length))
    assert got == {(b, o, n) for b in range(4) for o, n in ((0, 5), (5, 5), (10, 3))} | {(b, 0, 5) for b in range(4, 7)}
