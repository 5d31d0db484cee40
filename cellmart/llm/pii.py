"""Personal data and the terms that disclose it (information-theoretic sanitisation).

Base spans are e-mail addresses, IP addresses, card numbers and phone numbers (``BASE``). Each
distinct value is a protected entity. Terms are words of letters; the terms within ``WINDOW`` words
of a value are its context. From counts over all documents a term ``t`` is judged for an entity
``e`` by the share of the entity's information that it gives away:

    IC(e) = -log2 p(e)            p(e): share of the corpus' words in contexts of e
    PMI(t, e) = log2 (p(t, e) / (p(t) p(e)))
    disclosure(t, e) = PMI / IC = 1 + log2 (n(t, e) / n(t)) / IC(e)

A term whose disclosure for an entity reaches ``GENERALISE`` is generalised wherever it stands; from
``REMOVE`` on it is removed. Ordinary words stand mostly elsewhere and fall far below. It needs support:
``MIN_CONTEXTS`` contexts that differ in their words or in the text around them (copies of a text count
once), or an entity with fewer contexts than that, or two occurrences or more that all stand in the
entity's contexts. So these are left although their disclosure may reach the threshold, all of
entities with ``MIN_CONTEXTS`` contexts or more: terms that occur once in the corpus, and terms in fewer
contexts of the entity that also stand elsewhere.

Nothing that grows is broadcast: tasks get a bitmap of ``2**BITMAP_BITS`` bits over the hashes of the
risky terms (1 MB at any size), mark the words that hit it, and only those are joined to the exact
terms. Counts combine in the tasks; a word near two occurrences of a value counts once.

Defined results: a null or empty text has no spans; matches of a kind are leftmost and do not
overlap; a match that fails its check is dropped without a retry; a term span never overlaps a base
span; rows that repeat are marked alike; other columns are ignored. Offsets are code points.
"""

from __future__ import annotations

import math
import re
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tables import written
from .textkit import blocks, lower_ascii, word_hashes

WINDOW = 8
MIN_CONTEXTS = 3
GENERALISE = 0.9
REMOVE = 0.99
BITMAP_BITS = 23
KINDS = ("email", "ip", "card", "phone", "term")

_LOCAL = rb"[A-Za-z0-9._%+-]"
_ADDRESS = _LOCAL + rb"++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
#: The contract's patterns, with possessive repeats and starts at run bounds, where they find the same.
BASE = {
    "email": re.compile(rb"(?<!" + _LOCAL + rb")" + _ADDRESS),
    "ip": re.compile(rb"(?<![0-9])[0-9]++(?:\.[0-9]++){3}"),
    "card": re.compile(rb"[0-9](?:[ -]?[0-9])++"),
    "phone": re.compile(rb"\+[0-9][ ().0-9-]+[0-9]"),
}
_HERE = re.compile(_ADDRESS)
_DIGITS = re.compile(rb"[^0-9]+")


def _emails(raw: bytes):
    place = 0
    while match := BASE["email"].search(raw, place):
        # The rest of a run of address characters may follow a match directly.
        while match:
            yield match
            place = match.end()
            match = _HERE.match(raw, place)


def luhn(digits: bytes) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        d -= 48
        if i % 2:
            d = 2 * d - 9 * (d > 4)
        total += d
    return total % 10 == 0


def base_spans(raw: bytes) -> list[tuple[int, int, int]]:
    """(kind number, start byte, end byte), by kind, then start."""
    out = []
    if b"@" in raw:
        out += [(0, m.start(), m.end()) for m in _emails(raw)]
    for m in BASE["ip"].finditer(raw):
        if all(len(p.lstrip(b"0")) <= 3 and int(p.lstrip(b"0") or b"0") <= 255 for p in m.group().split(b".")):
            out.append((1, m.start(), m.end()))
    for m in BASE["card"].finditer(raw):
        digits = _DIGITS.sub(b"", m.group())
        if 16 <= len(digits) <= 19 and luhn(digits):
            out.append((2, m.start(), m.end()))
    if b"+" in raw:
        for m in BASE["phone"].finditer(raw):
            if 8 <= len(_DIGITS.sub(b"", m.group())) <= 15:
                out.append((3, m.start(), m.end()))
    return out


def letters() -> np.ndarray:
    keep = np.zeros(256, bool)
    keep[97:123] = True
    keep[0x80:] = True
    return keep


def _overlaps(starts, ends, spans) -> np.ndarray:
    hit = np.zeros(len(starts), bool)
    for _, s, e in spans:
        hit[np.searchsorted(ends, s, "right"):np.searchsorted(starts, e, "left")] = True
    return hit


def _find(batches):
    """Per document its base spans (code points) and the contexts of their values."""
    import xxhash

    fold, keep = lower_ascii(), letters()
    for batch in batches:
        for row, data, off in blocks(batch.column(2)):
            words, starts, ends, first = word_hashes(data, off, keep, fold)
            chars = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))
            spans, contexts = [], []
            for i in range(len(off) - 1):
                lo, hi = int(off[i]), int(off[i + 1])
                raw = data[lo:hi].tobytes()
                found = base_spans(raw)
                spans.append([{"kind": k, "start": int(chars[lo + s] - chars[lo]), "end": int(chars[lo + e] - chars[lo])} for k, s, e in found])
                own = slice(first[i], first[i + 1])
                w, s0, e0 = words[own], starts[own] - lo, ends[own] - lo
                clear = ~_overlaps(s0, e0, found) if found else None
                rows, counted = [], {}
                for k, s, e in found:
                    left = np.searchsorted(e0, s, "right")
                    right = np.searchsorted(s0, e, "left")
                    near = np.concatenate([np.arange(max(0, left - WINDOW), left), np.arange(right, min(len(w), right + WINDOW))])
                    near = near[clear[near]]
                    entity = xxhash.xxh64_intdigest(bytes([k]) + raw[s:e].lower()) - (1 << 63)
                    own_words = counted.setdefault(entity, set())
                    new = [i for i in near.tolist() if i not in own_words]
                    own_words.update(new)
                    rows.append({"entity": entity,
                                 "context": xxhash.xxh64_intdigest(w[near].tobytes()) - (1 << 63),
                                 "terms": w[new].view(np.int64).tolist()})
                contexts.append(rows)
            n = len(off) - 1
            yield pa.RecordBatch.from_arrays([
                batch.column(0).slice(row, n), batch.column(1).slice(row, n),
                pa.array(spans, pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int64()), ("end", pa.int64())]))),
                pa.array(contexts, pa.list_(pa.struct([("entity", pa.int64()), ("context", pa.int64()), ("terms", pa.list_(pa.int64()))])))],
                ["doc_id", "text_hash", "spans", "contexts"])


def _count(batches):
    """Occurrences of each term in each part of the input."""
    fold, keep = lower_ascii(), letters()

    def unique(parts):
        words = np.concatenate([p[0] for p in parts])
        n = np.concatenate([p[1] for p in parts])
        terms, at = np.unique(words, return_inverse=True)
        return terms, np.bincount(at, weights=n).astype(np.int64)

    def batch_of(terms, n):
        return pa.RecordBatch.from_arrays([pa.array(terms.view(np.int64)), pa.array(n)], ["term", "n"])

    held, size = [], 0
    for batch in batches:
        for _, data, off in blocks(batch.column(0)):
            words, _, _, _ = word_hashes(data, off, keep, fold)
            held.append(np.unique(words, return_counts=True))
            size += len(held[-1][0])
            if size > 1 << 20:
                held = [unique(held)]
                size = len(held[0][0])
                if size > 1 << 19:
                    yield batch_of(*held[0])
                    held, size = [], 0
    if held:
        yield batch_of(*unique(held))


def _mark(batches, bitmap):
    """Words that hit the bitmap of risky terms, for the documents that have any."""
    fold, keep = lower_ascii(), letters()
    bits = np.frombuffer(bitmap.value, np.uint64)
    for batch in batches:
        for row, data, off in blocks(batch.column(2)):
            words, starts, ends, first = word_hashes(data, off, keep, fold)
            at = words >> np.uint64(64 - BITMAP_BITS)
            hit = np.flatnonzero((bits[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1))
            if not len(hit):
                continue
            chars = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))
            doc = np.searchsorted(first, hit, "right") - 1
            base = chars[off[doc]]
            take = pa.array(doc + row)
            yield pa.RecordBatch.from_arrays([
                batch.column(0).take(take), batch.column(1).take(take), pa.array(words[hit].view(np.int64)),
                pa.array((chars[starts[hit]] - base).astype(np.int64)), pa.array((chars[ends[hit]] - base).astype(np.int64))],
                ["doc_id", "text_hash", "term", "start", "end"])


def term_disclosure(found: DataFrame, counts: DataFrame, generalise: float = GENERALISE,
                    min_contexts: int | None = None) -> DataFrame:
    """term, disclosure: the largest over the entities for which a term has support, if it reaches
    ``generalise``. ``found`` is the table of contexts by document, ``counts`` the occurrences of every
    term. Given ``min_contexts``, every term needs so many contexts."""
    seen = found.select("text_hash", F.explode("contexts").alias("c")).select("text_hash", "c.entity", "c.context", "c.terms")
    # Copies of a text first: what is copied very often combines in the tasks.
    entities = seen.groupBy("entity", "text_hash", "context").agg(F.sum(F.size("terms")).alias("words")).groupBy("entity").agg(
        F.sum("words").alias("words"), F.count("*").alias("contexts")).where("words > 0")
    pairs = seen.select("entity", "text_hash", "context", F.explode("terms").alias("term"))
    pairs = pairs.groupBy("entity", "term", "text_hash", "context").agg(F.count("*").alias("n")).groupBy("entity", "term").agg(
        F.sum("n").alias("near"), F.count("*").alias("support"))
    if min_contexts is not None:
        pairs = pairs.where(F.col("support") >= min_contexts)
    pairs = written(pairs, "pii-pairs")
    total = counts.agg(F.sum("n")).first()[0] or 1
    # No entity has more information than log2(total): terms that stand elsewhere too often for any
    # entity leave before pairs are joined.
    least = 2 ** ((generalise - 1) * max(math.log2(total), 1e-9)) * (1 - 1e-9)
    close = pairs.groupBy("term").agg(F.max("near").alias("most")).join(counts, "term").where(
        F.col("most") >= F.lit(least) * F.col("n")).select("term", "n")
    judged = pairs.join(written(close, "pii-close"), "term").join(written(entities, "pii-entities"), "entity")
    if min_contexts is None:
        judged = judged.where((F.col("support") >= MIN_CONTEXTS) | (F.col("contexts") < MIN_CONTEXTS)
                              | (F.col("n") > 1) & (F.col("near") >= F.col("n")))
    information = -F.log2(F.col("words") / total)
    share = F.least(F.col("near") / F.col("n"), F.lit(1.0))
    judged = judged.withColumn("disclosure", 1 + F.log2(share) / F.greatest(information, F.lit(1e-9)))
    return judged.groupBy("term").agg(F.max("disclosure").alias("disclosure")).where(F.col("disclosure") >= generalise)


def find_personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", generalise: float = GENERALISE,
                       remove: float = REMOVE, min_contexts: int | None = None) -> DataFrame:
    """Per document: id, ``text_hash`` and ``spans``: array of (kind, start, end, action), by kind as
    in ``KINDS``, then start; kind 4 are disclosing terms, action is ``mask``, ``generalise`` or
    ``remove``."""
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("text_hash"), F.col(text_col).alias("text"))
    key = f"doc_id {kind}, text_hash long"
    found = written(rows.mapInArrow(
        _find, f"{key}, spans array<struct<kind:int,start:long,end:long>>, "
        "contexts array<struct<entity:long,context:long,terms:array<long>>>"), "pii-base")
    counts = written(rows.select("text").mapInArrow(_count, "term long, n long").groupBy("term").agg(
        F.sum("n").alias("n")), "pii-counts")
    risky = written(term_disclosure(found, counts, generalise, min_contexts), "pii-risky")

    place = F.shiftrightunsigned("term", 64 - BITMAP_BITS)
    # One row for each 64 bits of the bitmap: a fixed number.
    cells = risky.select(F.shiftrightunsigned(place, 6).alias("cell"), F.expr(f"shiftleft(1L, int(shiftrightunsigned(term, {64 - BITMAP_BITS}) & 63))").alias("bit"))
    bits = np.zeros((1 << BITMAP_BITS) // 64, np.int64)
    for cell, bit in cells.groupBy("cell").agg(F.bit_or("bit").alias("bit")).collect():
        bits[cell] = bit
    sent = docs.sparkSession.sparkContext.broadcast(bits.tobytes())
    marked = written(rows.mapInArrow(partial(_mark, bitmap=sent), f"{key}, term long, start long, end long"), "pii-marked")
    action = F.when(F.col("disclosure") >= remove, "remove").otherwise("generalise")
    # A document's own spans: bounded by its length. Repeated rows give each span once.
    terms = marked.join(risky, "term").groupBy("doc_id", "text_hash").agg(F.collect_set(F.struct(
        F.lit(4).alias("kind"), "start", "end", action.alias("action"))).alias("terms"))
    terms = written(terms, "pii-terms").withColumnsRenamed({"doc_id": "_id", "text_hash": "_hash"})
    joined = found.join(terms, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_hash") == F.col("_hash")), "left")
    base = F.transform("spans", lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"), F.lit("mask").alias("action")))
    free = F.filter("terms", lambda t: ~F.exists("spans", lambda s: (s["start"] < t["end"]) & (t["start"] < s["end"])))
    spans = F.concat(base, F.coalesce(F.array_sort(free), F.array().cast("array<struct<kind:int,start:long,end:long,action:string>>")))
    return joined.select(F.col("doc_id").alias(id_col), "text_hash", spans.alias("spans"))


def span_text(spans: Column) -> Column:
    """``kind:start:end`` of each span, joined by commas."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat(
        F.element_at(names, s["kind"] + 1), F.lit(":"), s["start"].cast("string"), F.lit(":"), s["end"].cast("string"))), ",")


def _redact(batches):
    labels = [f"[{k.upper()}]" for k in KINDS]
    for batch in batches:
        texts = []
        for text, spans in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist()):
            out, place = [], 0
            for s in sorted(spans or (), key=lambda s: (s["start"], -s["end"])):
                if s["end"] <= place:
                    continue
                out.append(text[place:max(place, s["start"])])
                out.append("" if s["action"] == "remove" else labels[s["kind"]])
                place = s["end"]
            texts.append(None if text is None else "".join(out) + text[place:])
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])


def sanitise(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **thresholds) -> DataFrame:
    """id and text with masked values, generalised terms (``[TERM]``) and without removed terms."""
    found = find_personal_data(docs, id_col, text_col, **thresholds).where(F.size("spans") > 0)
    found = written(found.dropDuplicates([id_col, "text_hash"]), "pii-found").withColumnsRenamed({id_col: "_id", "text_hash": "_hash"})
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    joined = rows.join(found, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.xxhash64("text") == F.col("_hash")), "left")
    return joined.select("doc_id", "text", "spans").mapInArrow(_redact, f"doc_id {kind}, text string").withColumnsRenamed(
        {"doc_id": id_col, "text": text_col})

