"""Archives: what is written, what is read back, which records are revisits."""

import gzip
import hashlib
import random

from cellmart.llm import warc
from cellmart.session import scratch_path


def pages(spark, rows):
    return spark.createDataFrame([(i, u, h, "x") for i, u, h in rows], "page_id long, url string, html string, payload string").repartition(3)


def sample():
    rnd = random.Random(4)
    big = ["<p>" + "".join(rnd.choice("aé漢\r\n <>") for _ in range(200)) for _ in range(5)]
    rows = [(i, f"http://a.example/{i}", rnd.choice(big)) for i in range(60)]
    tricky = "x\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\nContent-Length: 5\r\n\r\n" + "y" * 100
    rows += [(100, None, None), (101, "http://b.example/ \n\u0085x", ""), (102, "u", "short"), (103, "u", "short"),
             (104, "u", tricky), (105, "u", tricky), (106, "u", "z" * 99), (107, "u", "z" * 99), (108, "u", "z" * 100),
             (99, "u", "z" * 100), (110, "u", "\r\n" * 80), (111, "u", "long " * 100_000)]
    return rows


def want(rows):
    first = {}
    for i, _, h in sorted(rows):
        first.setdefault(h or "", i)
    out = {}
    for i, _, h in rows:
        raw = (h or "").encode()
        revisit = len(raw) >= 100 and first[h or ""] != i
        out[i] = (len(raw), hashlib.sha256(raw).hexdigest(), "revisit" if revisit else "response", first[h] if revisit else None)
    return out


def test_round_trip(spark):
    rows = sample()
    got = {r["page_id"]: (r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"])
           for r in warc.archive_round_trip(pages(spark, rows)).collect()}
    assert got == want(rows)


def test_archive_files(spark):
    rows = sample()
    path = scratch_path(spark, "warc-test")
    mark = warc.write_archives(pages(spark, rows), path)
    raw = b"".join(gzip.decompress(f.read_bytes()) for f in __import__("pathlib").Path(path.removeprefix("file:")).glob("*.gz"))
    starts = (warc.VERSION + mark).encode()
    assert raw.count(starts) == len(rows)
    assert raw.count(b"\r\nWARC-Type: revisit\r\n") == sum(w[2] == "revisit" for w in want(rows).values())
    # Walk one record after the other by Content-Length.
    place = seen = 0
    while place < len(raw):
        assert raw.startswith(starts, place)
        head, _, _ = raw[place:].partition(b"\r\n\r\n")
        fields = dict(line.split(b": ", 1) for line in head.split(b"\r\n")[1:])
        place += len(head) + 4 + int(fields[b"Content-Length"])
        assert raw[place:place + 4] == b"\r\n\r\n"
        place += 4
        seen += 1
    assert seen == len(rows)
    payloads = {r["page"]: r["payload"] for r in warc.read_archives(spark, path, mark).collect() if r["record_type"] == "response"}
    html = {str(i): h or "" for i, _, h in rows}
    assert all(html[p] == text for p, text in payloads.items())


def test_repeated_null_and_empty(spark):
    body = "b" * 120
    got = sorted((str(r["page_id"]), r["record_type"], str(r["refers_to"]), r["payload_bytes"]) for r in warc.archive_round_trip(
        pages(spark, [(1, "u", body), (1, "u", body), (2, "v", body), (None, "w", body)])).collect())
    assert got == [("1", "response", "None", 120), ("1", "response", "None", 120), ("2", "revisit", "1", 120), ("None", "revisit", "1", 120)]
    assert warc.archive_round_trip(pages(spark, [(1, "u", body)]).where("page_id > 5")).count() == 0
