"""The trie against a dictionary of all prefixes."""

import hashlib
import math
import random
import re
import zlib
from collections import defaultdict

from cellmart.llm import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string, depth string, rep string"


def brute(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    turns = {c: [x[2:] for x in sorted(v)] for c, v in own.items()}
    built = {}
    for c, mine in turns.items():
        h = zlib.crc32(str(c).encode()) % 4
        built[c] = turns.get(c - int(math.fmod(c, 20)), [])[:h] + mine[h:]
    members = defaultdict(list)
    for c in sorted(built):
        for d in range(len(built[c]) + 1):
            members[tuple(built[c][:d])].append(c)
    kids, saved, leaves, out = defaultdict(list), {}, {}, []
    for node in members:
        if node:
            kids[node[:-1]].append(node)
    for node in sorted(members, key=len, reverse=True):
        words = len(re.findall(r"[^\x20\x09-\x0D]+", node[-1][1])) if node else 0
        saved[node] = (len(members[node]) - 1) * words + sum(saved[k] for k in kids[node])
        leaves[node] = sum(leaves[k] for k in kids[node]) or 1
    for node, m in members.items():
        ends = ",".join(str(c) for c in m if len(built[c]) == len(node))
        out.append((m[0], len(node), members[node[:-1]][0] if node else None, len(m), len(kids[node]), leaves[node],
                    saved[node], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def found(spark, rows):
    df = spark.createDataFrame([(*r, "clash", "clash") for r in rows], SCHEMA).repartition(3)
    return sorted((tuple(r)[:8] for r in prefix_trie.conversation_trie(df).collect()), key=str)


def test_random_tries(spark, monkeypatch):
    # Pieces and chunks small enough to be crossed.
    monkeypatch.setattr(prefix_trie, "PIECE", 4)
    monkeypatch.setattr(prefix_trie, "CHUNK", 3)
    monkeypatch.setattr(prefix_trie, "BATCHES", (2, 5, 9))
    rnd = random.Random(11)
    rows = []
    for c in [*range(0, 60), 100, 119, 1_000_007, -7]:
        for t in range(rnd.choice([1, 2, 3, 5, 9, 14])):
            rows.append((c, t, rnd.choice(["user", "assistant"]) if rnd.random() < .2 else "user", rnd.choice(["a b", "a b", "a b", "c\td  e", "é"])))
    rnd.shuffle(rows)
    assert found(spark, rows) == brute(rows)


def test_edges(spark):
    long = "w " * 50_000
    rows = [(20, None, None, None), (20, 1, "user", "x"), (20, 1, "user", "x"), (20, 1, "user", "b"), (21, 5, "user", long),
            (22, 0, "a", "bc"), (23, 0, "ab", "c"), (None, 0, "user", "lost"), (25, None, "user", ""), (25, None, "", "user"),
            *[(c, t, "user", "same") for c in range(40, 60) for t in range(6)]]
    assert found(spark, rows) == brute(rows)
    assert found(spark, []) == []
    assert found(spark, [(None, 1, "user", "x")]) == []


def test_one_conversation_holds_most_turns(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "CHUNK", 64)
    rows = [(40, t, "user", f"t{t % 7}") for t in range(600)] + [(41, t, "user", f"t{t % 7}") for t in range(500)] + [(47, 0, "user", "t0")]
    assert found(spark, rows) == brute(rows)


def test_two_fattest(spark):
    from pyspark.sql import functions as F
    pairs = [(a, b) for a in range(40) for b in range(a + 1, 41)]
    rows = spark.createDataFrame(pairs, "a long, b long").withColumn("f", prefix_trie.two_fattest(F.col("a"), F.col("b"))).collect()
    for a, b, f in rows:
        assert f == max(range(a + 1, b + 1), key=lambda x: x & -x)
