"""Base spans against the plain patterns, disclosing terms against counts made by hand."""

import hashlib
import math
import random
import re

from cellmart.llm import pii
from cellmart.llm.queries import op10_personal_data

PLAIN = {
    0: r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    1: r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    2: r"[0-9]([\x20-]?[0-9])+",
    3: r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    odd = [int(c) for c in reversed(digits)]
    return sum(d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(odd)) % 10 == 0


def plain(text):
    out = []
    for kind, pattern in PLAIN.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            good = {0: True, 1: all(int(p) <= 255 for p in m.group().split(".")) if kind == 1 else True,
                    2: 16 <= len(digits) <= 19 and luhn(digits), 3: 8 <= len(digits) <= 15}[kind]
            if good:
                out.append((kind, m.start(), m.end()))
    return out


def spans(spark, rows, **limits):
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    return {r["doc_id"]: [(s["kind"], s["start"], s["end"], s["action"]) for s in r["spans"]]
            for r in pii.find_personal_data(df, **limits).collect()}


def test_base_spans(spark):
    rnd = random.Random(5)
    pieces = ["a@b.c", "é", "x.y+z@mail-1.example.com", "_q@r.st", "@", ".", "1.2.3.4", "10.0.0.256", "4111 1111 1111 1111", "5-5-5",
              "+1 (743) 555-3824", "+49", "4111111111111111", "0000000000000000", "  ", "-", "7", "12", "+", "(", " w ", "漢", "%", "\n", "000255.1.1.1"]
    rows = [(i, "".join(rnd.choice(pieces) for _ in range(rnd.randint(0, 14)))) for i in range(1500)]
    rows += [(5000, None), (5001, ""), (5002, "9" * 20000), (5003, "a" * 20000), (5004, "a@b.c" * 2000), (5005, "1." * 5000)]
    got = spans(spark, rows, min_contexts=10**6)
    for i, text in rows:
        assert [s[:3] for s in got[i]] == plain(text), (i, text)


def test_counts_of_the_query(spark, tmp_path):
    rows = [(1, "a@b.c d@e.f 1.2.3.4 g@h.i"), (2, "+49 30 1234567, +49 30 7654321"), (3, None), (4, "4111 1111 1111 1111 x@y.zz"), (4, "1.2.3.4")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    out = [tuple(r)[:6] for r in op10_personal_data(spark, str(tmp_path)).collect()]

    def wanted(i, text):
        found = plain(text)
        line = ",".join(f"{pii.KINDS[k]}:{a}:{b}" for k, a, b in found)
        return (i, *[sum(s[0] == k for s in found) for k in range(4)], hashlib.sha256(line.encode()).hexdigest())

    assert sorted(out) == sorted(wanted(*r) for r in rows)


def corpus():
    rnd = random.Random(6)
    common = [f"w{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(200)]
    rows = [(i, " ".join(rnd.choice(common) for _ in range(60))) for i in range(150)]
    secret = "jo@corp.example.org"
    for i in range(5):
        words = [rnd.choice(common) for _ in range(12)]
        rows.append((1000 + i, " ".join(words[:6] + ["Zorbulon", secret] + words[6:])))
    copied = " ".join(rnd.choice(common) for _ in range(5)) + " blorxy " + secret
    rows += [(2000 + i, copied) for i in range(6)]
    rows.append((3000, "é the zorbulon alone and blorxy"))
    return rows


def test_disclosing_terms(spark):
    rows = corpus()
    got = spans(spark, rows)
    terms = {i: [t[a:b].lower() for k, a, b, _ in got[i] if k == 4] for i, t in rows}
    assert all(terms[1000 + i] == ["zorbulon"] for i in range(5))
    # Also where no entity stands; a term of one copied context is not enough.
    assert terms[3000] == ["zorbulon"]
    assert all(not terms[i] for i, _ in rows if i < 1000 or 2000 <= i < 3000)
    assert all(s[3] == "mask" for i, _ in rows for s in got[i] if s[0] < 4)


def test_terms_of_one_signature_and_of_rare_values(spark):
    rnd = random.Random(7)
    common = [f"w{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(200)]
    rows = corpus()
    # One context in many different texts; the name stands once elsewhere.
    signature = " ".join(common[:7]) + " Quillfeather quill@corp.example.org"
    rows += [(4000 + i, " ".join(rnd.choice(common) for _ in range(20)) + " " + signature) for i in range(6)]
    rows.append((4100, "the quillfeather alone"))
    # Values that occur once and twice.
    rows.append((4200, " ".join(common[10:15]) + " Xanthippe solo@corp.example.org " + common[20]))
    rows += [(4300 + i, f"{common[i]} Mirabelle twice@corp.example.org {common[30 + i]}") for i in range(2)]
    # A term that stands only with a frequent value, twice.
    rows += [(4400 + i, f"{common[40 + i]} Oberon jo@corp.example.org {common[50 + i]}") for i in range(2)]
    got = spans(spark, rows)
    terms = {i: [(t[a:b].lower(), action) for k, a, b, action in got[i] if k == 4] for i, t in rows}
    assert all(terms[4000 + i] == [("quillfeather", "generalise")] for i in range(6)) and terms[4100] == [("quillfeather", "generalise")]
    assert terms[4200] == [("xanthippe", "remove")]
    assert terms[4300] == terms[4301] == [("mirabelle", "remove")]
    assert terms[4400] == terms[4401] == [("oberon", "remove")]
    assert all(not terms[i] for i, _ in rows if i < 1000 or 2000 <= i < 3000)


def test_disclosure_values(spark):
    rows = corpus()
    near = [re.findall("[a-z]+", t.split(" jo@")[0].lower())[-8:] + re.findall("[a-z]+", t.split("org")[1].lower())[:8]
            for i, t in rows if "jo@" in t]
    words = [w for _, t in rows for w in re.findall("[a-zé]+", re.sub(r"\S+@\S+", "jo corp example org", t.lower()))]
    share = sum(w.count("zorbulon") for w in near) / words.count("zorbulon")
    information = -math.log2(sum(map(len, near)) / len(words))
    want = 1 + math.log2(share) / information
    assert pii.GENERALISE <= want < pii.REMOVE
    got = spans(spark, rows)
    assert got[3000][0][3] == "generalise"
    assert not spans(spark, rows, generalise=want + 0.001)[3000]
    assert spans(spark, rows, generalise=want - 0.001)[3000]


def test_sanitised_text_and_odd_rows(spark):
    rows = corpus() + [(1, None), (None, "mail me at jo@corp.example.org"), (3000, "x"), (3000, "x")]
    df = spark.createDataFrame([(i, t, 0) for i, t in rows], "doc_id long, text string, spans int")
    out = [(r["doc_id"], r["text"]) for r in pii.sanitise(df).collect()]
    assert len(out) == len(rows)
    assert (3000, "é the [TERM] alone and blorxy") in out
    assert (None, "mail me at [EMAIL]") in out and (1, None) in out
    assert not any("@" in (t or "") for _, t in out)
    assert pii.find_personal_data(df.where("doc_id = -1")).count() == 0
