"""Exact dedup, token counts, BPE, quality and decontamination on small tables."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest

from cellmart.llm import bpe, decontaminate, exact_dedup, quality, token_counts
from cellmart.llm.queries import tokenizer_file

SPACES = re.compile(r"[\x20\x09-\x0D]")


# ---- operator 2

def dedup_rows():
    rnd = random.Random(1)
    texts = ["a b", "ab", "a\tb ", None, "", " \n", "x" * 100 + "y", "x" * 100 + "z", "x" * 100 + " y", "é ", "é", "long " * 30_000]
    return [(i, rnd.choice(texts)) for i in range(80)]


def test_exact_dedup(spark):
    rows = dedup_rows()
    df = spark.createDataFrame([(i, t, 1, "k") for i, t in rows], "doc_id long, text string, kept int, _hash string").repartition(3)
    got = {r["doc_id"]: (r["keep_id"], r["group_size"], r["kept"]) for r in exact_dedup.exact_dedup(df).collect()}
    groups = {}
    for i, t in rows:
        groups.setdefault(SPACES.sub("", t or ""), []).append((-len(t or ""), i))
    want = {}
    for members in groups.values():
        keep = min(members)[1]
        want.update({i: (keep, len(members), i == keep) for _, i in members})
    assert got == want
    kept = exact_dedup.drop_copies(df)
    assert kept.columns == df.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(i for i, w in want.items() if w[2])


def test_exact_dedup_repeated_null_empty(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (None, "a"), (4, "b"), (5, "c"), (None, "c ")], "doc_id long, text string")
    got = sorted(((str(r["doc_id"]), r["keep_id"], r["group_size"], r["kept"]) for r in exact_dedup.exact_dedup(df).collect()), key=str)
    # A null id loses a tie, but a longer original stays whatever its id.
    assert got == [("1", 1, 3, True), ("1", 1, 3, True), ("4", 4, 1, True), ("5", None, 2, False),
                   ("None", 1, 3, False), ("None", None, 2, True)]
    assert exact_dedup.exact_dedup(df.where("doc_id > 9")).count() == 0


def test_drop_copies_judges_texts_not_ids(spark):
    long = "p" * 70
    rows = [(None, "a"), (None, "b"), (5, "a"), (6, "c"), (7, "c"), (7, "d"), (8, long + "x"), (9, long + "x"), (9, long + "y")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    got = sorted(((r["doc_id"], r["text"]) for r in exact_dedup.drop_copies(df).collect()), key=str)
    assert got == sorted([(None, "b"), (5, "a"), (6, "c"), (7, "d"), (8, long + "x"), (9, long + "y")], key=str)


# ---- operator 3

def test_section_tokens(spark):
    path = tokenizer_file("byte_bpe_50k.tiktoken")
    encoding, size = token_counts.load_encoding(path)
    rnd = random.Random(2)
    texts = ["".join(rnd.choice("ab é漢\n .x") for _ in range(rnd.randint(0, 80))) for _ in range(60)] + [None, "", "\n\n", "a" * 5000]
    df = spark.createDataFrame([(i, t, 3) for i, t in enumerate(texts)], "doc_id long, text string, section int").repartition(2)
    for rule in token_counts.RULES:
        got = {}
        for r in token_counts.section_tokens(df, path, rule).collect():
            got.setdefault(r["doc_id"], {})[r["section"]] = (r["start_char"], r["end_char"], r["n_tokens"])
        for i, text in enumerate(texts):
            lines = [m.span() for m in re.finditer(r"[^\n]*\n|[^\n]+", text or "")]
            owner = [k for k, (a, b) in enumerate(lines) for _ in text[a:b].encode()] if text else []
            count, place = [0] * len(lines), 0
            for token in encoding.encode_ordinary(text or ""):
                own = owner[place:place + size[token]]
                place += size[token]
                k = {"first": own[0], "last": own[-1], "majority": max(sorted(set(own)), key=own.count)}[rule]
                count[k] += 1
            assert got.get(i, {}) == {k: (a, b, count[k]) for k, (a, b) in enumerate(lines)}, (rule, text)


def test_given_sections(spark):
    path = tokenizer_file("byte_bpe_50k.tiktoken")
    rows = [(1, "hello world again", [(0, 5), (6, 11)]), (2, "hello", None), (None, "", [])]
    df = spark.createDataFrame(rows, "doc_id long, text string, fields array<struct<start:int,end:int>>")
    got = sorted((str(r["doc_id"]), str(r["section"]), r["n_tokens"]) for r in token_counts.section_tokens(df, path, "majority", section_col="fields").collect())
    assert got == [("1", "0", 1), ("1", "1", 1), ("1", "None", 1), ("2", "None", 1)]
    with pytest.raises(ValueError):
        token_counts.section_tokens(df, path, "both")


# ---- operator 6

def test_bpe_against_the_library(spark):
    from tokenizers import Tokenizer

    path = tokenizer_file("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    rnd = random.Random(3)
    alphabet = "abAB zé'É ÀßÿµªºÖ×÷²³½ \t\n\r\x0b\x1c\x85\xa0'’s't'll've'd're019!?.<|>Ω漢İ́"
    latin = [c for c in alphabet if ord(c) < 256]
    texts = ["".join(rnd.choice(a) for _ in range(rnd.randint(0, 60))) for a in (alphabet, latin) for _ in range(400)]
    texts += [None, "", " ", "<|startoftext|>Hi<|endoftext|> x", "a" * 3000, "it's don't 'S'LL ''vet'", "word " * 20_000]
    df = spark.createDataFrame([(i, t, b"x") for i, t in enumerate(texts)], "doc_id long, text string, ids binary").repartition(3)
    for size in (0, 50, 5000):
        for r in bpe.encode(df, path, size).collect():
            ids = library.encode(texts[r["doc_id"]] or "", add_special_tokens=False).ids
            assert np.frombuffer(bytes(r["ids"]), "<u4").tolist() == ids and r["n_tokens"] == len(ids)
            assert r["decoded"] == library.decode(ids, skip_special_tokens=False)
    assert bpe.encode(df.where("doc_id < 0"), path).count() == 0


def test_transducer_numbers_every_word():
    rnd = random.Random(4)
    words = sorted({bytes(rnd.choice(b"abcz\xc3\xa9") for _ in range(rnd.randint(1, 7))) for _ in range(3000)})
    lexicon = bpe.Transducer.mapped(bpe.Transducer.build(words).dump())
    other = [bytes(rnd.choice(b"abcz\xc3") for _ in range(rnd.randint(1, 9))) for _ in range(3000)]
    data = np.frombuffer(b"".join(words + other), np.uint8)
    ends = np.cumsum([len(w) for w in words + other])
    starts = np.concatenate(([0], ends[:-1]))
    place = {w: i for i, w in enumerate(words)}
    assert lexicon.numbers(data, starts, ends).tolist() == [place.get(w, -1) for w in words + other]
    assert len(lexicon.final) < len(words)


# ---- operator 8

def quality_tables(spark):
    rnd = random.Random(5)
    docs, labels = [], []
    for i in range(400):
        good = i % 4 > 0
        words = ["".join(rnd.choice("aeiounrst") for _ in range(rnd.randint(2, 8))) for _ in range(rnd.randint(20, 200))]
        docs.append((i, " ".join(w if good or rnd.random() < 0.4 else w.upper() + "$$" for w in words) + "."))
        labels.append((i, int(good), 0))
    docs += [(1000, None), (1001, ""), (1002, " "), (1003, "x " * 100_000), (None, "a word"), (7, docs[7][1])]
    labels += [(2000, None, 1), (3, 1, 0), (None, 0, 0)]
    return (spark.createDataFrame([(i, t, "s") for i, t in docs], "doc_id long, text string, score string").repartition(3),
            spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), len(docs))


def test_quality_scores(spark):
    import zlib

    docs, labels, n = quality_tables(spark)
    rows = quality.quality_scores(docs, labels).collect()
    assert len(rows) == n and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in rows)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in rows if r["doc_id"] is not None)
    held = [r for r in rows if r["held_out"] and r["doc_id"] < 1000]
    right = sum(r["predicted"] == int(r["doc_id"] % 4 > 0) for r in held)
    assert len(held) > 80 and right / len(held) > 0.95
    kept = quality.drop_rejected(docs, labels)
    assert kept.columns == docs.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(str(r["doc_id"]) for r in rows if r["predicted"])


def test_labels_of_held_out_rows_are_not_learnt(spark):
    from pyspark.sql import functions as F

    docs, labels, _ = quality_tables(spark)
    turned = labels.withColumn("quality", F.when(quality.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = ({(r["doc_id"], r["score"]) for r in quality.quality_scores(docs.coalesce(1), x.coalesce(1)).collect()} for x in (labels, turned))
    assert a == b


def test_quality_without_labels(spark):
    docs, labels, n = quality_tables(spark)
    assert {r["score"] for r in quality.quality_scores(docs, labels.where("doc_id < 0")).collect()} == {0.5}
    assert quality.quality_scores(docs.where("doc_id < 0"), labels).count() == 0


def test_moments_match_numpy():
    rnd = np.random.default_rng(0)
    x, y = rnd.normal(size=(50, 3)), rnd.integers(0, 2, 50)
    batch = pa.RecordBatch.from_arrays([pa.array(y, pa.int32()), pa.array(x.tolist())], ["a", "x"])
    rows = [r for out in quality._moments([batch]) for r in out.to_pylist()]
    got = {(r["label"], r["i"], r["j"]): r["value"] for r in rows}
    assert np.isclose(got[1, 2, 1], (x[y == 1, 0] * x[y == 1, 1]).sum()) and got[0, 0, 0] == (y == 0).sum()


# ---- operator 9

def words_of(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def brute_hits(docs, bench, window):
    out = []
    for _, text in docs:
        w = words_of(text)
        hit, items = [False] * len(w), set()
        for item, passage in bench:
            b = words_of(passage)
            size = min(window, len(b))
            own = {tuple(b[i:i + size]) for i in range(len(b) - size + 1)} if size else set()
            for i in range(len(w) - size + 1 if size else 0):
                if tuple(w[i:i + size]) in own:
                    hit[i:i + size] = [True] * size
                    items.add("null" if item is None else str(item))
        out.append((len(w), sum(hit), sorted(items), sum(hit) > 0 and 20 * sum(hit) >= len(w)))
    return out


def contamination_tables(seed):
    rnd = random.Random(seed)
    vocabulary = ["the", "of", "é", "漢字", "A1"] + [f"w{i}" for i in range(12)]

    def words(n):
        return [rnd.choice(vocabulary) for _ in range(n)]

    bench = [(i, " ".join(words(rnd.choice([0, 1, 2, 4, 6, 30])))) for i in range(12)] + [(99, None), (None, "w1 w2, W3 w4 w5 w6")]
    bench.append((100, bench[5][1]))
    docs = []
    for i in range(150):
        parts = [" ".join(words(rnd.randint(0, 60)))]
        for _ in range(rnd.randint(0, 2)):
            b = (rnd.choice(bench)[1] or "").split(" ")
            parts.append("; ".join(b[rnd.randrange(3):]))
        docs.append((i, rnd.choice(["\n", "-", " "]).join(parts)))
    return docs + [(500, None), (501, ""), (502, "w1"), (503, " ".join(words(3000)))], bench


@pytest.mark.parametrize("window,shard,block", [(4, 1 << 19, 1 << 17), (13, 50, 1 << 17), (4, 40, 20)])
def test_contamination(spark, monkeypatch, window, shard, block):
    monkeypatch.setattr(decontaminate, "SHARD_WORDS", shard)
    monkeypatch.setattr(decontaminate, "BLOCK_WORDS", block)
    docs, bench = contamination_tables(window + shard)
    df = spark.createDataFrame([(i, t, "x") for i, t in docs], "doc_id long, text string, items string").repartition(2)
    items = spark.createDataFrame(bench, "item_id long, text string")
    got = {r["doc_id"]: (r["n_words"], r["n_hit"], r["items"], r["contaminated"])
           for r in decontaminate.contamination(df, items, window=window).collect()}
    want = dict(zip((i for i, _ in docs), brute_hits(docs, bench, window)))
    assert got == want
    clean = decontaminate.remove_contaminated(df, items, window=window)
    assert clean.columns == df.columns
    assert sorted(r["doc_id"] for r in clean.collect()) == [i for i, w in sorted(want.items()) if not w[3]]


def test_passes_over_repeated_texts_and_a_cut_item(spark, monkeypatch):
    """Blocks of six words, one in a pass: an item of more words is cut, hits of several passes overlap in one text,
    and rows that repeat a text or have no id are judged one by one."""
    monkeypatch.setattr(decontaminate, "BLOCK_WORDS", 6)
    monkeypatch.setattr(decontaminate, "PASS_BLOCKS", 1)
    item = "a b c d e f g h i j k l m n"
    bench = [(1, item), (2, "c d e f q"), (3, None), (4, "short")]
    texts = [f"x {item} y", "b c d e f", "nothing of it", None, "", "a b c e f g short", "c d e f Q c d e f q"]
    docs = [(None if k % 3 else k, t, "x") for k in range(4) for t in texts]
    df = spark.createDataFrame(docs, "doc_id long, text string, text_key string").repartition(3)
    items = spark.createDataFrame(bench, "item_id long, text string")
    got = decontaminate.contamination(df, items, window=4).collect()
    want = [(i, *w) for (i, _, _), w in zip(docs, brute_hits([d[:2] for d in docs], bench, 4))]
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))
    assert any(w[2] == 14 for w in want)
    clean = decontaminate.remove_contaminated(df, items, window=4)
    assert clean.columns == df.columns
    assert sorted(map(repr, map(tuple, clean.collect()))) == sorted(repr(d) for d, w in zip(docs, want) if not w[4])
    longest = decontaminate.longest_matches(df.filter("doc_id is not null"), items, window=4).collect()
    assert {("1", 0, 14, 0, 1), ("2", 0, 5, 3, 0)} <= set(map(tuple, longest))


def test_longest_matches_and_empty(spark):
    docs = spark.createDataFrame([(1, "x a b c d y"), (2, "a b q"), (2, "a b q")], "doc_id long, text string").coalesce(1)
    items = spark.createDataFrame([(7, "a b c z")], "item_id long, text string")
    got = {(r["item_word"], r["n_words"], r["doc_id"], r["doc_word"]) for r in decontaminate.longest_matches(docs, items).collect()}
    assert {(0, 3, 1, 1), (1, 2, 1, 2), (2, 1, 1, 3)} <= got
    none = decontaminate.contamination(docs, items.where("item_id < 0")).collect()
    assert [r["n_hit"] for r in none] == [0, 0, 0]
    assert decontaminate.contamination(docs.where("doc_id > 5"), items).count() == 0


def brute_longest(docs, bench):
    out = []
    for item, passage in bench:
        b = words_of(passage)
        for at in range(len(b)):
            found = []
            for doc, text in docs:
                w = words_of(text)
                for i in range(len(w)):
                    n = 0
                    while at + n < len(b) and i + n < len(w) and b[at + n] == w[i + n]:
                        n += 1
                    found.append((n, doc, i))
            most = max(n for n, _, _ in found)
            out += [(str(item), at, n, doc, i) for n, doc, i in found if n == most and n]
    return sorted(out)


@pytest.mark.parametrize("shard,pairs", [(1 << 19, 1 << 20), (50, 40)])
def test_longest_matches_end_where_the_texts_differ(spark, monkeypatch, shard, pairs):
    monkeypatch.setattr(decontaminate, "SHARD_WORDS", shard)
    monkeypatch.setattr(decontaminate, "PAIRS", pairs)
    rnd = random.Random(9)
    vocabulary = [f"w{i}" for i in range(40)]
    item = [rnd.choice(vocabulary) for _ in range(150)]
    bench = [(1, " ".join(item)), (2, " ".join(item[20:60] + ["other"])), (3, "w1 w2 unseen")]
    docs = [(1, " ".join(["x", *item, "y"])), (2, " ".join(item[:130])), (3, " ".join(item + ["z"])), (4, "w1 w2 w1"), (5, None)]
    docs += [(6 + i, " ".join(rnd.choice(vocabulary) for _ in range(60))) for i in range(4)]
    got = decontaminate.longest_matches(spark.createDataFrame(docs, "doc_id long, text string").repartition(2),
                                        spark.createDataFrame(bench, "item_id long, text string")).collect()
    want = brute_longest(docs, bench)
    assert sorted(map(tuple, got)) == want
    assert {("1", 0, 150, 1, 1), ("1", 0, 150, 3, 0)} <= set(want)


def test_windows_longer_than_the_least_order(spark):
    rnd = random.Random(10)
    lead = [f"w{i}" for i in range(16)]
    tails = [[rnd.choice("abcdef") for _ in range(14)] for _ in range(60)]
    docs = [(i, " ".join(lead + tail)) for i, tail in enumerate(tails)]
    bench = [(i, " ".join(lead + tails[i])) for i in range(0, 60, 3)]
    got = decontaminate.contamination(spark.createDataFrame(docs, "doc_id long, text string").coalesce(1),
                                      spark.createDataFrame(bench, "item_id long, text string"), window=28).collect()
    assert [(r["n_words"], r["n_hit"], r["items"], r["contaminated"]) for r in sorted(got, key=lambda r: r["doc_id"])] == brute_hits(docs, bench, 28)
