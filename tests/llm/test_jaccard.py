"""The grouped prefix join against all pairs."""

import random
import re

import pytest
from pyspark.sql import functions as F

from cellmart.llm import jaccard
from cellmart.llm.components import components
from cellmart.llm.jaccard import drop_near_copies, jaccard_components
from cellmart.llm.tables import sifted


def shingles(text, k):
    low = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return frozenset()
    return frozenset(tuple(words[i:i + k]) for i in range(max(1, len(words) - k + 1)))


def brute(rows, k, percent):
    sets = [(i, shingles(t, k)) for i, t in rows]
    parent = {i: i for i, _ in rows}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for x in range(len(sets)):
        for y in range(x):
            (i, a), (j, b) = sets[x], sets[y]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                i, j = sorted((find(i), find(j)))
                parent[j] = i
    return {i: (len(s), find(i)) for i, s in sets}


def corpus(seed):
    rnd = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)] + ["the", "of", "Édouard", "漢字", "THE"]

    def words(n):
        return [rnd.choice(vocabulary) for _ in range(n)]

    def edit(ws, n):
        ws = list(ws)
        for _ in range(n):
            ws[rnd.randrange(len(ws))] = rnd.choice(vocabulary)
        return ws

    out = []
    passage = words(40)
    for _ in range(25):
        base = words(rnd.choice([1, 3, 4, 5, 30, 120, 400]))
        out += [base, base, [w.upper() for w in base]]
        for _ in range(rnd.randint(0, 5)):
            base = edit(base, rnd.randint(0, 4))
            out.append(base)
    star = words(150)
    out += [edit(star, rnd.randint(1, 3)) for _ in range(40)]
    out += [words(rnd.randint(5, 60)) + passage for _ in range(20)]
    out += [passage + [w] for w in vocabulary[:6]]
    texts = [rnd.choice([" ", "\n", "\t "]).join(w) for w in out] + [None, "", " \n", "one"]
    rnd.shuffle(texts)
    return list(enumerate(texts))


@pytest.mark.parametrize("seed,k,percent", [(1, 4, 85), (2, 5, 80)])
def test_against_all_pairs(spark, seed, k, percent):
    rows = corpus(seed)
    df = spark.createDataFrame([(i, t, 7) for i, t in rows], "doc_id long, text string, n long").repartition(3)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_components(df, k=k, percent=percent).collect()}
    assert got == brute(rows, k, percent)


def shared_passages():
    """Families of texts with a rare passage in common, so one prefix and size, and tails that many
    other texts quote; some members have a near copy outside the group."""
    rnd = random.Random(3)
    count = iter(range(10**6))

    def fresh(n):
        return [f"v{next(count)}" for _ in range(n)]

    texts = []
    for members in (2, 3, 5):
        passage, bridge = fresh(20), fresh(3)
        tails = [bridge + fresh(80) for _ in range(members)]
        for tail in tails:
            texts.append(passage + tail)
        for tail in tails[1:]:
            texts.append(passage + tail[:-rnd.randint(1, 3)])
        # Quoted often, the tails come after the passage in the order of shingles.
        texts += [fresh(250) + tail for tail in tails for _ in range(40)]
    return [(i, " ".join(t)) for i, t in enumerate(texts)]


@pytest.mark.parametrize("k,percent", [(4, 85), (5, 80)])
def test_links_of_members_that_differ_from_their_group(spark, k, percent):
    rows = shared_passages()
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_components(df, k=k, percent=percent).collect()}
    assert got == brute(rows, k, percent)


def test_odd_rows_and_stage(spark):
    rows = [(5, "a b c d e f"), (5, "a b c d e f"), (3, "A b  c d e f"), (None, "a b c d e f"), (9, None), (8, ""), (7, "x")]
    df = spark.createDataFrame([(i, t, "s", 1) for i, t in rows], "doc_id long, text string, label string, component_id int")
    got = sorted((str(r["doc_id"]), r["n_shingles"], str(r["component_id"])) for r in jaccard_components(df).collect())
    assert got == [("3", 3, "3"), ("5", 3, "3"), ("5", 3, "3"), ("7", 1, "7"), ("8", 0, "8"), ("9", 0, "9"), ("None", 3, "None")]
    kept = drop_near_copies(df)
    assert kept.columns == df.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == ["3", "7", "8", "9", "None"]
    assert jaccard_components(df.where("doc_id > 50")).count() == 0


def test_rows_of_one_id_are_one_document(spark):
    a, b, c = ("a b c d e f g", "h i j k l m n", "o p q r s t")
    rows = [(3, a), (5, a), (5, b), (9, b), (11, c), (9, ""), (12, ""), (None, c)]
    got = {(r["doc_id"], r["n_shingles"]): r["component_id"]
           for r in jaccard_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {(3, 4): 3, (5, 4): 3, (9, 4): 3, (9, 0): 3, (11, 3): 11, (12, 0): 12, (None, 3): None}


def test_large_texts_with_a_common_half_make_no_pairs(spark, monkeypatch):
    """The lists of the common half hold all texts; the wide bitmaps tell them apart within the join."""
    rnd = random.Random(6)
    common = [f"c{i}" for i in range(1100)]
    texts = [[f"{d}-{rnd.random()}" for _ in range(900)] + common for d in range(30)]
    texts += [t[:700] + [f"x{i}" for i in range(60)] + t[760:] for t in texts[:3]]
    counts = {}
    plain = jaccard.written

    def counted(df, name):
        out = plain(df, name)
        counts[name] = counts.get(name, 0) + out.count()
        return out

    monkeypatch.setattr(jaccard, "written", counted)
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"])
           for r in jaccard_components(spark.createDataFrame(rows, "doc_id long, text string"), k=5, percent=80).collect()}
    assert got == brute(rows, 5, 80)
    assert counts["jaccard-group-pairs"] <= 3


def test_only_large_sets_meet_the_wide_bitmaps(spark):
    small, large = jaccard.FOLD_BITS, jaccard.FOLD_BITS + 1
    entries = spark.createDataFrame([(1, 3, small), (2, 3, small), (3, 5, large), (4, 5, large)], "gid long, step long, n long")
    wide = spark.createDataFrame([(3, 5, [7], [9])], "gid long, step long, wa array<long>, wo array<long>")
    found = jaccard._with_words(entries, wide)
    assert sorted((r["gid"], r["n"], r["wa"], r["wo"]) for r in found.collect()) == [
        (1, small, None, None), (2, small, None, None), (3, large, [7], [9]), (4, large, None, None)]
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    joined = plan[plan.index("Join LeftOuter"):]
    assert "(n#" in joined and f"> {jaccard.FOLD_BITS})" in joined


def test_words_kept_once_differ_by_the_same_bits(spark):
    rnd, words = random.Random(5), range(jaccard.FOLD_BITS // 64)
    one, two, three = ([rnd.getrandbits(63) for _ in words] for _ in range(3))
    both, any_ = [p & q for p, q in zip(two, three)], [p | q for p, q in zip(two, three)]
    names = ", ".join(f"a{i} long, o{i} long" for i in words)
    x = spark.createDataFrame([tuple(v for w in one for v in (w, None))], names).alias("x")
    y = spark.createDataFrame([tuple(v for w in zip(both, any_) for v in w)], names).alias("y")
    want = sum(((p & ~q) | (b & ~p)).bit_count() for p, b, q in zip(one, both, any_))
    assert x.crossJoin(y).select(jaccard._differing_bits().alias("d")).head()["d"] == want
    assert x.crossJoin(x.alias("y")).select(jaccard._differing_bits().alias("d")).head()["d"] == 0


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(7, i) for i in range(200, 260)] + [(260, 7), (1, 159), (300, 300)]
    df = spark.createDataFrame(edges, "a long, b long")
    got = {r["node"]: r["label"] for r in components(df).collect()}
    assert got == {1: 1, **{i: 1 for i in range(100, 161)}, 7: 7, **{i: 7 for i in range(200, 261)}}


def test_only_repeated_shingles_become_entries(spark):
    """A shingle of one prefix alone makes no entry and is not shuffled; those of two prefixes keep both entries."""
    texts = [f"only{i} a{i} b{i} c{i} d{i} e{i}" for i in range(40)] + ["x y z u v w one", "x y z u v w two"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    join = jaccard.Join(docs, "doc_id", "text", 2, 60)
    prefixes = [(r["id"], t) for r in join.nodes.select("id", "prefix").collect() for t in r["prefix"]]
    again = {t for i, t in prefixes for j, u in prefixes if i < j and t == u}
    assert again
    assert sorted((r["gid"], r["token"]) for r in join.entries.collect()) == sorted((i, t) for i, t in prefixes if t in again)
    marked = spark.read.parquet(join.entries.inputFiles()[0].split("/jaccard-entries")[0] + "/jaccard-marked-*")
    assert marked.where("gid < 40").count() == 0


def test_sifted_parts_hold_all_rows(spark):
    rows = spark.createDataFrame([(i % 500 if i % 7 else None, i) for i in range(2000)], "id long, v long")
    wanted = spark.createDataFrame([(i,) for i in range(0, 500, 50)] + [(None,)], "id long")
    maybe, rest = sifted(rows, F.xxhash64("id"), wanted.select(F.xxhash64("id").alias("key")))
    held = {None, *range(0, 500, 50)}
    assert sorted(r["v"] for r in maybe.unionByName(rest).collect()) == list(range(2000))
    assert not any(r["id"] in held for r in rest.collect())
    assert "SortMergeJoin" not in rest._jdf.queryExecution().executedPlan().toString()
