"""Repeated byte strings against a brute-force count of all windows."""

import random
from collections import Counter

import pytest

from cellmart.llm.repeats import remove_repeats

WORDS = ["thing", "or", "ënd", "the", "a", "ness", "漢", "."]


def brute(texts, length):
    raw = [(t or "").encode() for t in texts]
    count = Counter(r[i:i + length] for r in raw for i in range(len(r) - length + 1))
    out = []
    for r in raw:
        gone = [False] * len(r)
        for i in range(len(r) - length + 1):
            if count[r[i:i + length]] > 1:
                gone[i:i + length] = [True] * length
        kept = bytes(b for b, g in zip(r, gone) if not g)
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out.append((len(r), sum(gone), spans, kept))
    return out


def corpus(seed, n=60):
    rnd = random.Random(seed)

    def words(k):
        return " ".join(rnd.choice(WORDS) + str(rnd.randint(0, 99)) for _ in range(k))

    passages = [words(rnd.randint(5, 30)) for _ in range(4)]
    texts = []
    for _ in range(n):
        kind = rnd.random()
        if kind < 0.2 and texts:
            texts.append(rnd.choice(texts))
        elif kind < 0.4 and texts:
            t = list(rnd.choice(texts) or "x")
            for _ in range(rnd.randint(1, 3)):
                t[rnd.randrange(len(t))] = rnd.choice("xyz é")
            texts.append("".join(t))
        else:
            texts.append(" ".join(rnd.choice([words(rnd.randint(0, 40)), rnd.choice(passages)]) for _ in range(3)))
    line = words(12) + "\n"
    return texts + [None, "", "a" * 150, "a" * 90 + "b" + "a" * 90, line * 4, "ab" * 100, words(10), "短い"]


@pytest.mark.parametrize("length,gram,collection", [(40, 16, 4096), (40, 16, 3), (25, 20, 5)])
def test_against_brute_force(spark, length, gram, collection):
    texts = corpus(length + collection)
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, kept string").repartition(3)
    rows = {r["doc_id"]: r for r in remove_repeats(df, length=length, gram=gram, collection=collection).collect()}
    assert len(rows) == len(texts)
    for i, want in enumerate(brute(texts, length)):
        r = rows[i]
        assert (r["n_bytes"], r["n_removed"], len(r["removed"]), bytes(r["kept"])) == want, (i, texts[i])
        assert sum(s["end"] - s["start"] for s in r["removed"]) == r["n_removed"]


def test_long_text_in_parts(spark, monkeypatch):
    import cellmart.llm.repeats as m

    monkeypatch.setattr(m, "BLOCK_BYTES", 700)
    texts = corpus(9, 20) + [" ".join(corpus(9, 20)[:12])]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    got = {r["doc_id"]: bytes(r["kept"]) for r in remove_repeats(df, length=40, gram=16).collect()}
    assert got == {i: w[3] for i, w in enumerate(brute(texts, 40))}


def test_repeated_rows_and_empty_table(spark):
    text = "x1 y2 z3 " * 30
    df = spark.createDataFrame([(1, text), (1, text), (None, text), (2, "short")], "doc_id long, text string")
    got = sorted((str(r["doc_id"]), r["n_removed"]) for r in remove_repeats(df).collect())
    assert got == [("1", 270), ("1", 270), ("2", 0), ("None", 270)]
    assert remove_repeats(df.where("doc_id > 5")).count() == 0


def test_many_rows_of_a_null_id(spark):
    text = "".join(chr(97 + (i * i + i // 7) % 26) for i in range(700))
    rows = [(None, text)] * 1000 + [(1, "x" + text[:350])]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = remove_repeats(df)
    assert {(r["doc_id"], r["n_bytes"], r["n_removed"]) for r in got.collect()} == {(None, 700, 700), (1, 351, 350)}
    assert got.count() == 1001
