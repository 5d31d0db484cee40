"""One registered query per operator: production parameters, the whole intended table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, decontaminate, exact_dedup, jaccard, licenses, packing, pii, prefix_trie, quality, repeats, token_counts, warc, whitening
from .tables import table


def op1_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_components(table(spark, sf_dir, "documents"))


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = exact_dedup.exact_dedup(
        table(spark, sf_dir, "documents").select("doc_id", "text"),
        carry={"text_sha256": F.sha2("_norm", 256)})
    return rows.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def _of_kind(kind: int):
    return lambda s: s["kind"] == kind


def op10_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = pii.find_personal_data(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["kind"] < 4)
    # F.filter takes functions of one argument alone for the entry: a second would be its place in the array.
    counts = [F.size(F.filter("spans", _of_kind(k))).cast("long").alias(f"n_{name}") for k, name in enumerate(pii.KINDS[:4])]
    return rows.select("doc_id", *counts, F.sha2(pii.span_text(base), 256).alias("base_sha256"),
                       pii.span_text(F.col("spans")).alias("spans"))


def tokenizer_file(name: str) -> str:
    """Place of a public tokenizer's file on this machine; every machine has the package."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.section_tokens(
        table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.tiktoken"), rule="majority")


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = warc.archive_round_trip(table(spark, sf_dir, "pages"))
    return rows.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = repeats.remove_repeats(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "n_bytes", "n_removed", F.size("removed").cast("long").alias("n_spans"),
                       F.sha2("kept", 256).alias("kept_sha256"))


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = bpe.encode(table(spark, sf_dir, "documents"), tokenizer_file("word_bpe_49k.json"))
    return rows.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                       F.sha2("decoded", 256).alias("decoded_sha256"))


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, sf_dir, "documents"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return rows.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), "contaminated")


def op11_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.conversation_trie(table(spark, sf_dir, "conversations")).drop("rep")


QUERIES = {
    "op1_ngram_jaccard": op1_ngram_jaccard,
    "op2_exact_dedup": op2_exact_dedup,
    "op3_token_counts": op3_token_counts,
    "op4_warc": op4_warc,
    "op5_suffix_dedup": op5_suffix_dedup,
    "op6_bpe": op6_bpe,
    "op7_license_scan": op7_license_scan,
    "op8_quality": op8_quality,
    "op9_decontamination": op9_decontamination,
    "op10_personal_data": op10_personal_data,
    "op11_packing": op11_packing,
    "op12_whitening": op12_whitening,
    "op13_prefix_trie": op13_prefix_trie,
}

ORACLES = {
    "op1_ngram_jaccard": r"""
        WITH RECURSIVE words AS (
            SELECT doc_id, regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x20\x09-\x0D]+') AS w FROM documents),
        shingles AS (
            SELECT DISTINCT doc_id, array_to_string(w[i:i + 3], ' ') AS s
            FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS i FROM words WHERE len(w) > 0)),
        sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
        common AS (
            SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS hits
            FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2),
        links AS (
            SELECT x, y FROM common JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y
            WHERE 100 * hits >= 85 * (p.n + q.n - hits)),
        reach(node, seen) AS (
            SELECT doc_id, doc_id FROM documents
            UNION SELECT r.node, l.y FROM reach r JOIN links l ON l.x = r.seen)
        SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, min(r.seen) AS component_id
        FROM documents d LEFT JOIN sizes s ON s.doc_id = d.doc_id JOIN reach r ON r.node = d.doc_id
        GROUP BY d.doc_id, s.n""",
    "op2_exact_dedup": r"""
        WITH n AS (
            SELECT doc_id, length(coalesce(text, '')) AS chars,
                   regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm
            FROM documents),
        g AS (
            SELECT *, count(*) OVER (PARTITION BY norm) AS group_size,
                   first_value(doc_id) OVER (PARTITION BY norm ORDER BY chars DESC, doc_id) AS keep_id
            FROM n)
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256 FROM g""",
    "op4_warc": r"""
        WITH p AS (
            SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest
            FROM pages),
        f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM p)
        SELECT page_id, payload_bytes, payload_digest,
               CASE WHEN payload_bytes >= 100 AND first <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN payload_bytes >= 100 AND first <> page_id THEN first END AS refers_to FROM f""",
    "op9_decontamination": r"""
        WITH folded AS (
            SELECT 'd' AS kind, CAST(doc_id AS VARCHAR) AS id, coalesce(text, '') AS text FROM documents
            UNION ALL SELECT 'b', CAST(item_id AS VARCHAR), coalesce(text, '') FROM benchmark),
        words AS (
            SELECT kind, id, regexp_extract_all(
                translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM folded),
        windows AS (
            SELECT DISTINCT id AS item, least(len(w), 13) AS size, array_to_string(w[i:i + 12], ' ') AS phrase
            FROM (SELECT id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS i FROM words
                  WHERE kind = 'b' AND len(w) > 0)),
        places AS (
            SELECT id, w, unnest(range(1, len(w) + 1)) AS i FROM words WHERE kind = 'd'),
        found AS (
            SELECT p.id, p.i, v.size, v.item FROM (SELECT DISTINCT size FROM windows) s, places p, windows v
            WHERE v.size = s.size AND p.i + s.size - 1 <= len(p.w)
              AND array_to_string(p.w[p.i:p.i + s.size - 1], ' ') = v.phrase),
        hit AS (
            SELECT id, count(DISTINCT k) AS n FROM (SELECT id, unnest(range(i, i + size)) AS k FROM found) GROUP BY id),
        items AS (
            SELECT id, count(DISTINCT item) AS n, string_agg(DISTINCT item, ',' ORDER BY item) AS list
            FROM found GROUP BY id)
        SELECT d.doc_id, CAST(len(w.w) AS BIGINT) AS n_words, coalesce(h.n, 0) AS n_hit, coalesce(t.n, 0) AS n_items,
               sha256(coalesce(t.list, '')) AS items_sha256,
               coalesce(h.n, 0) > 0 AND 20 * coalesce(h.n, 0) >= len(w.w) AS contaminated
        FROM documents d JOIN words w ON w.kind = 'd' AND w.id = CAST(d.doc_id AS VARCHAR)
        LEFT JOIN hit h ON h.id = w.id LEFT JOIN items t ON t.id = w.id""",
    "op13_prefix_trie": r"""
        WITH turns AS (
            SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text, row_number() OVER (
                PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) - 1 AS pos
            FROM conversations WHERE conv_id IS NOT NULL),
        -- CRC-32, bit by bit: a byte is followed by eight shifts.
        ids AS (
            SELECT conv_id, conv_id - conv_id % 20 AS base, xor(list_reduce(list_prepend(
                CAST(4294967295 AS BIGINT), flatten(list_transform(
                    string_split(CAST(conv_id AS VARCHAR), ''),
                    lambda c: [CAST(ascii(c) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1]))),
                lambda a, e: CASE WHEN e >= 0 THEN xor(a, e) ELSE xor(a >> 1, 3988292384 * (a & 1)) END), 4294967295) % 4 AS h
            FROM (SELECT DISTINCT conv_id FROM turns)),
        built AS (
            SELECT i.conv_id, 0 AS part, t.pos, t.role, t.text FROM ids i JOIN turns t ON t.conv_id = i.base AND t.pos < i.h
            UNION ALL
            SELECT i.conv_id, 1, t.pos, t.role, t.text FROM ids i JOIN turns t ON t.conv_id = i.conv_id AND t.pos >= i.h),
        whole AS (
            SELECT i.conv_id, coalesce(list({'role': b.role, 'text': b.text} ORDER BY b.part, b.pos)
                                       FILTER (WHERE b.part IS NOT NULL), []) AS s
            FROM ids i LEFT JOIN built b ON b.conv_id = i.conv_id GROUP BY i.conv_id),
        prefixes AS (
            SELECT conv_id, d, s[1:d] AS p, d = len(s) AS ending,
                   CASE WHEN d > 0 THEN len(regexp_extract_all(s[d].text, '[^\x20\x09-\x0D]+')) ELSE 0 END AS words
            FROM (SELECT conv_id, s, unnest(range(0, len(s) + 1)) AS d FROM whole)),
        nodes AS (
            SELECT p, d, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(words) AS words,
                   sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE ending), '')) AS ends_sha256
            FROM prefixes GROUP BY p, d),
        runs AS (SELECT x.conv_id, x.d, n.conv_id AS node FROM prefixes x JOIN nodes n ON n.d = x.d AND n.p = x.p),
        links AS (
            SELECT n.conv_id, n.d, n.n_convs, n.words, n.ends_sha256, r.node AS parent
            FROM nodes n LEFT JOIN runs r ON r.conv_id = n.conv_id AND r.d = n.d - 1),
        kids AS (SELECT parent AS conv_id, d - 1 AS d, count(*) AS n FROM links WHERE d > 0 GROUP BY ALL),
        below AS (
            SELECT r.node AS conv_id, r.d, sum((l.n_convs - 1) * l.words) AS saved, count(*) FILTER (WHERE k.n IS NULL) AS leaves
            FROM links l JOIN runs r ON r.conv_id = l.conv_id AND r.d <= l.d
            LEFT JOIN kids k ON k.conv_id = l.conv_id AND k.d = l.d GROUP BY r.node, r.d)
        SELECT l.conv_id, l.d AS depth, l.parent AS parent_conv_id, l.n_convs, coalesce(k.n, 0) AS n_children,
               b.leaves AS n_leaves, CAST(b.saved AS BIGINT) AS saved_tokens, l.ends_sha256
        FROM links l JOIN below b ON b.conv_id = l.conv_id AND b.d = l.d
        LEFT JOIN kids k ON k.conv_id = l.conv_id AND k.d = l.d""",
}
