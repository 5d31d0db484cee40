"""License scan against exact containment of every window."""

import random
import re

import numpy as np

from cellmart.llm import licenses


def words_of(text):
    return re.findall(r"[0-9a-z\x80-\U0010FFFF]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def shingle_list(text):
    w = words_of(text)
    return [tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))] if w else []


def brute(text):
    out = {}
    own = shingle_list(text)
    for name, template in licenses.TEMPLATES:
        t = set(shingle_list(template))
        for at in range(0, len(own), len(t)):
            share = len(t & set(own[at:at + 2 * len(t)])) / len(t)
            if share >= 0.8:
                out[name] = max(share, out.get(name, 0))
    return out


def corpus():
    rnd = random.Random(8)
    noise = ["the", "of", "license", "under", "software", "copy", "é", "漢"] + [f"w{i}" for i in range(300)]
    texts = [None, "", "MIT", "Released under the MIT License."]
    for _ in range(150):
        parts = []
        for _ in range(rnd.randint(1, 4)):
            parts.append(" ".join(rnd.choice(noise) for _ in range(rnd.randint(0, 80))))
            if rnd.random() < 0.5:
                notice = rnd.choice(licenses.TEMPLATES)[1].split()
                for _ in range(rnd.choice([0, 0, 1, 2])):
                    notice[rnd.randrange(len(notice))] = rnd.choice(noise)
                parts.append(" ".join(notice))
        texts.append(rnd.choice([" ", "\n * "]).join(parts))
    return texts


def test_against_all_windows(spark):
    texts = corpus()
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, license string").repartition(3)
    got = {}
    for r in licenses.scan_licenses(df).collect():
        got.setdefault(r["doc_id"], {})[r["license"]] = r["containment"]
        part = words_of(texts[r["doc_id"]][r["start"]:r["end"]])
        assert part and texts[r["doc_id"]][r["start"]:r["end"]].strip() == texts[r["doc_id"]][r["start"]:r["end"]]
    want = {i: found for i, t in enumerate(texts) if (found := brute(t))}
    assert got == want and len(want) > 60


def test_settings_and_odd_rows(spark):
    assert licenses.collision_probability(0.8 / 2.2) > 0.9999
    row = (1, "Released under the MIT License. é")
    df = spark.createDataFrame([row, row, (None, row[1])], "doc_id long, text string")
    got = [(r["doc_id"], r["license"], r["containment"], r["start"], r["end"]) for r in licenses.scan_licenses(df).collect()]
    assert sorted(got, key=str) == [(1, "MIT", 1.0, 0, 30), (1, "MIT", 1.0, 0, 30), (None, "MIT", 1.0, 0, 30)]
    assert licenses.scan_licenses(df.where("doc_id = 9")).count() == 0


def test_copies_stretched_by_an_insertion(spark):
    own = [f"t{i}" for i in range(64)]
    rows = []
    for at in range(60):
        lead, foreign = [f"a{i}" for i in range(at)], [f"f{i}" for i in range(30)]
        rows.append((at, " ".join(lead + own[:32] + foreign + own[32:] + ["z"] * 70)))
    rows.append((100, " ".join(own[:32] + [f"f{i}" for i in range(90)] + own[32:])))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    got = {r["doc_id"]: (r["containment"], words_of(rows[r["doc_id"]][1][r["start"]:r["end"]]))
           for r in licenses.scan_licenses(df, [("T", " ".join(own))]).collect()}
    want = own[:32] + [f"f{i}" for i in range(30)] + own[32:]
    assert got == {at: (56 / 60, want) for at in range(60)}


def test_minima_around_shared_shingles_are_those_of_all_windows():
    """Every window of every row is hashed whole; a retrieved one agrees with the template in a band."""
    rnd = np.random.default_rng(3)
    words = rnd.integers(0, 1 << 63, 90, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    sets = [("A", np.unique(words[:7])), ("B", np.unique(words[5:45])), ("C", np.unique(words[20:27])), ("D", words[:1])]
    length = np.array([0, 1, 3, 700, 0, 40, 2000, 1, 0])
    begin = np.concatenate(([0], np.cumsum(length)))
    shingles = rnd.integers(0, 1 << 63, begin[-1], dtype=np.uint64) * np.uint64(2)
    some = rnd.random(begin[-1]) < 0.1
    shingles[some] = rnd.choice(words, some.sum())
    got = {(i, int(r), int(a)) for i, rows, at in licenses.retrieve(shingles, begin, sets) for r, a in zip(rows, at)}
    want = set()
    for i, (_, own) in enumerate(sets):
        step, wide = licenses.shape(len(own))
        for r in range(len(length)):
            for a in range(begin[r], begin[r + 1], step):
                window = shingles[a:min(a + step * wide, begin[r + 1])]
                if any((window * f).min() == (own * f).min() for f in licenses._multipliers()):
                    want.add((i, r, int(a)))
    assert got == want and len(want) > 500
