"""WARC archives with revisit resolution.

1. Headers. Each page becomes a header row: id, target URI, payload length, SHA-256 of the payload.
   Headers alone are shuffled by digest; of the records with equal payloads of at least
   ``MIN_BYTES`` bytes the smallest id is the response, the others revisit it. The originals are a
   written table, so a digest that very many pages share is joined in parallel.
2. Archives. Every record is written with fresh headers: a response carries its payload, a revisit
   the response's record id, URI and digest and no payload. The archives are written by Spark's
   text writer, one record a row, ``CRLF CRLF`` between records, in gzip files of any store.
3. Reading. ``read_archives`` splits the files at record bounds, parses the headers and checks
   ``Content-Length``; ``resolve`` joins revisits to the responses they refer to.

A payload may hold any text, also the bytes of a WARC record. Each set of archives therefore
writes a random ``WARC-Block-Mark`` right after the version line of its records (an extension field,
as the format allows), chosen after the payloads are known, and is split where it occurs.

Defined results: a null or empty html has a payload of 0 bytes; a null URL is written as
``urn:none`` and read as null; rows that repeat an id are separate records, and those that repeat a
response's id and payload are responses too; a null id comes after all others and its records are never
revisited by pages with an id; an empty table makes archives without records; other columns are
ignored.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cellmart.session import scratch_path

from .tables import written

MIN_BYTES = 100
CRLF = "\r\n"
VERSION = "WARC/1.1" + CRLF
HTTP = "HTTP/1.1 200 OK" + CRLF + "Content-Type: text/html; charset=utf-8" + CRLF + "Content-Length: "


def page_headers(pages: DataFrame, id_col: str = "page_id", uri_col: str = "url", html_col: str = "html") -> DataFrame:
    """id, uri, payload, payload_bytes, payload_digest (bare lower-case hex SHA-256)."""
    payload = F.coalesce(F.col(html_col), F.lit(""))
    return pages.select(F.col(id_col).alias("id"), F.col(uri_col).alias("uri"), payload.alias("payload")).select(
        "*", F.octet_length("payload").cast("long").alias("payload_bytes"), F.sha2("payload", 256).alias("payload_digest"))


def originals(headers: DataFrame, min_bytes: int = MIN_BYTES) -> DataFrame:
    """The response's id of every digest that several records of at least ``min_bytes`` share."""
    shared = headers.where(F.col("payload_bytes") >= min_bytes).groupBy("payload_digest").agg(
        F.min("id").alias("original"), F.count("*").alias("records"))
    return written(shared.where("records > 1").select("payload_digest", "original"), "warc-originals")


def record_id(id_: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(id_.cast("string"), F.lit("")), F.lit(">"))


def write_archives(pages: DataFrame, path: str, min_bytes: int = MIN_BYTES, id_col: str = "page_id",
                   uri_col: str = "url", html_col: str = "html", date: str = "2024-01-01T00:00:00Z") -> str:
    """Write deduplicated archives below ``path``; returns the mark that separates their records."""
    mark = f"WARC-Block-Mark: {uuid.uuid4().hex}" + CRLF
    rows = page_headers(pages, id_col, uri_col, html_col)
    thin = rows.select("id", "uri", "payload_bytes", "payload_digest")
    first = originals(thin, min_bytes)
    # The response's own URI goes into the headers of its revisits.
    targets = written(thin.join(first, (F.col("id") == F.col("original")) & (thin["payload_digest"] == first["payload_digest"])).groupBy(
        first["payload_digest"], "original").agg(F.min("uri").alias("original_uri")), "warc-targets")
    known = (F.col("original").isNotNull() & ~F.col("id").eqNullSafe(F.col("original"))
             & (F.col("payload_bytes") >= min_bytes))
    rows = rows.join(targets, "payload_digest", "left").withColumn("revisit", known)

    def line(name: str, value: Column) -> Column:
        return F.concat(F.lit(f"{name}: "), value, F.lit(CRLF))

    http = F.concat(F.lit(HTTP), F.col("payload_bytes").cast("string"), F.lit(CRLF + CRLF))
    block = F.when(F.col("revisit"), http).otherwise(F.concat(http, "payload"))
    kind = F.when(F.col("revisit"), "revisit").otherwise("response")
    none = F.lit("urn:none")
    record = F.concat(
        F.lit(VERSION + mark), line("WARC-Type", kind), line("WARC-Record-ID", record_id(F.col("id"))),
        line("WARC-Date", F.lit(date)), line("WARC-Target-URI", _uri(F.coalesce("uri", none))),
        line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), "payload_digest")),
        F.when(F.col("revisit"), F.concat(
            line("WARC-Refers-To", record_id(F.col("original"))),
            line("WARC-Refers-To-Target-URI", _uri(F.coalesce("original_uri", none))),
            line("WARC-Profile", F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")))).otherwise(""),
        line("Content-Type", F.lit("application/http;msgtype=response")),
        line("Content-Length", F.octet_length(block).cast("string")), F.lit(CRLF), block)
    (rows.select(record.alias("value")).write.option("lineSep", CRLF + CRLF).option("compression", "gzip").text(path))
    return mark


def _uri(uri: Column) -> Column:
    """A URI in one line: control characters and spaces are percent-encoded."""
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(uri, "\r", "%0D"), "\n", "%0A"), " ", "%20")


def read_archives(spark: SparkSession, path: str, mark: str) -> DataFrame:
    """Records of archives: record_type, page (text of the id), uri, digest, refers_to (text),
    payload_bytes (as the HTTP header states), payload (null for revisits). A record whose block does not have
    its Content-Length fails the read."""
    lines = spark.read.option("lineSep", CRLF + CRLF + VERSION + mark).schema("value string").text(path)
    # The first record of a file still has its version line, the last one its closing line.
    own = F.when(F.startswith("value", F.lit(VERSION + mark)), F.substr("value", F.lit(len(VERSION + mark) + 1))).otherwise(F.col("value"))
    at = F.locate(CRLF + CRLF, F.col("record"))
    split = lines.select(own.alias("record")).select(
        F.substring(F.col("record"), F.lit(1), at - 1).alias("head"),
        F.substr(F.col("record"), at + F.lit(4)).alias("block"))

    def field(name: str) -> Column:
        return F.nullif(F.regexp_extract("head", rf"(?md)^{name}: ([^\r\n]*)", 1), F.lit(""))

    def page(name: str) -> Column:
        return F.regexp_extract("head", rf"(?md)^{name}: <urn:page:([^\r\n]*)>", 1)

    rows = split.select(
        field("WARC-Type").alias("record_type"), page("WARC-Record-ID").alias("page"),
        F.nullif(field("WARC-Target-URI"), F.lit("urn:none")).alias("uri"),
        F.substr(field("WARC-Payload-Digest"), F.lit(8)).alias("digest"), page("WARC-Refers-To").alias("refers_to"),
        field("Content-Length").cast("long").alias("length"), "block")
    exact = F.octet_length("block") - F.col("length")
    body = F.when(exact == 0, F.col("block")).when(
        (exact == 4) & F.endswith("block", F.lit(CRLF + CRLF)), F.expr("substr(block, 1, length(block) - 4)")).otherwise(
        F.raise_error(F.concat(F.lit("record "), F.coalesce("page", F.lit("?")), F.lit(": block and Content-Length differ"))).cast("string"))
    cut = F.locate(CRLF + CRLF, F.col("body"))
    return rows.withColumn("body", body).select(
        "record_type", F.nullif("page", F.lit("")).alias("page"), "uri", "digest",
        F.when(F.col("record_type") == "revisit", F.nullif("refers_to", F.lit(""))).alias("refers_to"),
        F.regexp_extract("body", r"(?md)^Content-Length: ([0-9]+)", 1).cast("long").alias("payload_bytes"),
        F.when(F.col("record_type") == "response", F.substr(F.col("body"), cut + F.lit(4))).alias("payload"))


def resolve(records: DataFrame) -> DataFrame:
    """Revisits get length and digest of the response they refer to, as read from its payload;
    a revisit without its response keeps a null digest."""
    own = records.select("record_type", "page", "uri", "digest", "refers_to",
                         F.octet_length("payload").cast("long").alias("payload_bytes"), F.sha2("payload", 256).alias("payload_digest"))
    own = written(own, "warc-index")
    # One row for each response that is referred to; the join to it can be split.
    targets = own.where("record_type = 'response'").join(
        own.where("refers_to IS NOT NULL").select(F.col("refers_to").alias("page")).distinct(), "page", "left_semi")
    targets = written(targets.groupBy(F.col("page").alias("refers_to"), F.col("digest").alias("digest")).agg(
        F.max("payload_bytes").alias("target_bytes"), F.max("payload_digest").alias("target_digest")), "warc-resolved")
    return own.join(targets, ["refers_to", "digest"], "left").select(
        "record_type", "page", "uri", "refers_to", F.coalesce("payload_bytes", "target_bytes").alias("payload_bytes"),
        F.coalesce("payload_digest", "target_digest").alias("payload_digest"))


def archive_round_trip(pages: DataFrame, id_col: str = "page_id", uri_col: str = "url", html_col: str = "html") -> DataFrame:
    """Write the pages to deduplicated archives, read them back and resolve the revisits."""
    spark = pages.sparkSession
    path = scratch_path(spark, "warc")
    mark = write_archives(pages, path, id_col=id_col, uri_col=uri_col, html_col=html_col)
    kind = pages.schema[id_col].dataType
    rows = resolve(read_archives(spark, path, mark))
    return rows.select(F.col("page").cast(kind).alias(id_col), "uri", "payload_bytes", "payload_digest", "record_type",
                       F.col("refers_to").cast(kind).alias("refers_to"))
