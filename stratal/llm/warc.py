"""WARC archives: writing captures, reading records, assembling transactions.

Method. Every page becomes three WARC/1.1 records: a request, a response (or
a revisit, if another page holds the same payload) and a metadata record; the
request and the metadata name the response in WARC-Concurrent-To. Records are
built as text by Spark expressions and written by Spark's text writer with
the record terminator as line separator, so files are committed by Spark and
may live in any store. Reading parses each archive file by Content-Length.
Assembly resolves the concurrent-to links of either direction by joins and
emits one nested row per capture.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from stratal.session import materialize

FILE_BYTES = 32 << 20
DATE = "2024-01-01T00:00:00Z"
# Fixed values of the format.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
END = "\r\n\r\n"
BASE32_HEX, BASE32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def sha1_base32(payload: Column) -> Column:
    """SHA-1 in base 32: each 40-bit quarter of the hex digest as 8 digits."""
    quarters = [F.lpad(F.conv(F.substring(F.sha1(payload), 1 + 10 * k, 10), 16, 32), 8, "0") for k in range(4)]
    return F.translate(F.concat(*quarters), BASE32_HEX, BASE32)


def _record_id(kind: str) -> Column:
    h = F.md5(F.concat_ws("|", F.lit(kind), "id_key", "digest", F.col("copy").cast("string")))
    cuts = [(1, 8), (9, 4), (13, 4), (17, 4), (21, 12)]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *[F.substring(h, a, n) for a, n in cuts]), F.lit(">"))


def _record(fields: list[tuple[str, Column]], block: Column) -> Column:
    head = [F.lit("WARC/1.1\r\n")]
    for name, value in fields:
        head.append(F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit("\r\n")), F.lit("")))
    return F.concat(*head, F.lit("Content-Length: "), F.octet_length(block).cast("string"), F.lit(END), block)


def write_captures(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url",
                   html_col: str = "html", file_bytes: int = FILE_BYTES, date: str = DATE,
                   compression: str = "gzip") -> None:
    """Write the request, response or revisit, and metadata record of every
    row of ``pages`` as WARC files of about ``file_bytes`` (before
    compression) under ``path``.

    Of the rows with equal payloads (the html in UTF-8) the one with the
    largest id is the response, the others revisit it: their block holds the
    HTTP head only, with the full payload's length, digest and the response's
    record id.

    Defined cases: a null html is an empty payload; a null id sorts below
    every id and is written without a page id; a null url is about:blank;
    control characters and spaces of a url are percent-encoded; repeated rows
    are separate captures; an empty table writes no records.
    """
    rows = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).alias("url"),
                        F.coalesce(F.col(html_col), F.lit("")).alias("html"))
    rows = (rows.withColumn("id_key", F.coalesce(F.col("id").cast("string"), F.lit("")))
            .withColumn("digest", sha1_base32(F.encode("html", "UTF-8"))))
    shared = materialize(rows.groupBy("digest").agg(F.max("id").alias("keeper"), F.count("*").alias("n"))
                         .where("n > 1").drop("n"), "warc-shared")
    # narrow: only the revisits' keys and what they revisit
    revisits = materialize(rows.select("id", "id_key", "digest").join(shared, "digest")
                           .where(~F.col("id").eqNullSafe(F.col("keeper")))
                           .select("id_key", "digest", "keeper").distinct(), "warc-revisits")
    total = rows.agg(F.sum(F.octet_length("html")), F.count("*")).first()
    files = int(((total[0] or 0) + 1500 * total[1]) // file_bytes) + 1
    dealt = (rows.join(revisits.withColumn("again", F.lit(True)), ["id_key", "digest"], "left")
             .repartition(files, "id_key", "digest")
             .withColumn("copy", F.row_number().over(W.partitionBy("id_key", "digest").orderBy("url"))))
    again = F.coalesce("again", F.lit(False))
    uri = F.coalesce(F.regexp_replace("url", r"[\x00-\x20\x7f]", "%20"), F.lit("about:blank"))
    host = F.regexp_extract("uri", r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)
    # the response's own record id: first copy of (keeper, digest)
    target = F.md5(F.concat_ws("|", F.lit("response"), F.coalesce(F.col("keeper").cast("string"), F.lit("")), "digest", F.lit("1")))
    cuts = [(1, 8), (9, 4), (13, 4), (17, 4), (21, 12)]
    refers = F.when(again, F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *[F.substring(target, a, n) for a, n in cuts]), F.lit(">")))
    length = F.octet_length("html").cast("string")
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), length,
                    F.lit(END), F.when(again, F.lit("")).otherwise(F.col("html")))
    when, own = F.lit(date), F.col("own")
    response = _record([
        ("WARC-Type", F.when(again, F.lit("revisit")).otherwise(F.lit("response"))), ("WARC-Record-ID", own),
        ("WARC-Date", when), ("WARC-Target-URI", F.col("uri")),
        ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "digest")),
        ("WARC-Profile", F.when(again, F.lit(PROFILE))), ("WARC-Refers-To", refers),
        ("Content-Type", F.lit("application/http; msgtype=response"))], http)
    request = _record([
        ("WARC-Type", F.lit("request")), ("WARC-Record-ID", _record_id("request")), ("WARC-Date", when),
        ("WARC-Target-URI", F.col("uri")), ("WARC-Concurrent-To", own),
        ("Content-Type", F.lit("application/http; msgtype=request"))],
        F.concat(F.lit("GET "), F.col("uri"), F.lit(" HTTP/1.1\r\nHost: "), host, F.lit(END)))
    metadata = _record([
        ("WARC-Type", F.lit("metadata")), ("WARC-Record-ID", _record_id("metadata")), ("WARC-Date", when),
        ("WARC-Target-URI", F.col("uri")), ("WARC-Concurrent-To", own),
        ("Content-Type", F.lit("application/warc-fields"))],
        F.coalesce(F.concat(F.lit("page_id: "), F.col("id").cast("string"), F.lit("\r\n")), F.lit("")))
    lines = (dealt.withColumn("uri", uri).withColumn("own", _record_id("response"))
             .select(F.explode(F.array(request, response, metadata)).alias("value")))
    lines.write.option("lineSep", END).option("compression", compression).mode("overwrite").text(path)


def parse_records(content: bytes) -> Iterator[tuple[dict[str, list[str]], bytes]]:
    """(header fields, block) of each record; names lowered, values in order."""
    if content[:2] == b"\x1f\x8b":
        content = gzip.decompress(content)
    at = 0
    while True:
        while content[at:at + 2] == b"\r\n":
            at += 2
        if at >= len(content):
            return
        end = content.index(b"\r\n\r\n", at)
        lines = content[at:end].decode("utf-8", "replace").split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no WARC record at byte {at}: {lines[0][:40]!r}")
        fields: dict[str, list[str]] = {}
        for line in lines[1:]:
            name, _, value = line.partition(":")
            fields.setdefault(name.strip().lower(), []).append(value.strip())
        start = end + 4
        at = start + int(fields["content-length"][0])
        if at > len(content):
            raise ValueError("a WARC record is cut short")
        yield fields, content[start:at]


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """One row per record of the archives under ``path``: record_id, kind,
    concurrent_to, refers_to, uri, digest (bare), payload_bytes, digest_ok,
    page_id, body.

    ``body`` is the HTTP entity of responses (empty for revisits) or the
    block of other records; payload_bytes is the full payload's length (from
    the HTTP head for revisits); a response's digest is computed from its
    body, and digest_ok compares it with the header. Plain and gzip files are
    read; a file must fit the binary-file source (2 GiB; the writer stays far
    below). A damaged file raises.
    """
    names = ["record_id", "kind", "concurrent_to", "refers_to", "uri", "digest", "payload_bytes", "digest_ok",
             "page_id", "body"]
    kinds = [pa.string(), pa.string(), pa.list_(pa.string()), pa.string(), pa.string(), pa.string(), pa.int64(),
             pa.bool_(), pa.int64(), pa.binary()]

    def row(fields: dict[str, list[str]], block: bytes) -> tuple:
        def one(name):
            return fields.get(name, [None])[0]

        kind, page, ok = one("warc-type"), None, None
        digest = (one("warc-payload-digest") or "").removeprefix("sha1:") or None
        body, size = block, len(block)
        if kind in ("response", "revisit"):
            head, _, body = block.partition(b"\r\n\r\n")
            size = len(body)
            if kind == "revisit":
                for line in head.split(b"\r\n"):
                    if line.lower().startswith(b"content-length:"):
                        size = int(line[15:])
            else:
                own = base64.b32encode(hashlib.sha1(body).digest()).decode()
                ok, digest = digest is None or own == digest, own
        elif kind == "metadata":
            for line in block.decode("utf-8", "replace").split("\r\n"):
                if line.startswith("page_id: "):
                    page = int(line[9:])
        return (one("warc-record-id"), kind, fields.get("warc-concurrent-to", []), one("warc-refers-to"),
                one("warc-target-uri"), digest, size, ok, page, body)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for content in b.column("content"):
                rows, held = [], 0
                for fields, block in parse_records(content.as_py()):
                    rows.append(row(fields, block))
                    held += len(block)
                    if held > 8 << 20 or len(rows) >= 4096:
                        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)
                        rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    schema = ("record_id string, kind string, concurrent_to array<string>, refers_to string, uri string, digest string, "
              "payload_bytes long, digest_ok boolean, page_id long, body binary")
    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(run, schema)


def assemble_captures(records: DataFrame) -> DataFrame:
    """One nested row per capture: capture_id, response struct, requests and
    metadata arrays of structs.

    A record belongs to the response, revisit or resource record it names in
    concurrent_to, or that names it. Defined cases: a record that is linked to
    no such record forms a capture of its own with a null response; a record
    that names several belongs to each; a response without request or
    metadata has empty arrays; repeated links count once; repeated responses
    give repeated rows; no records give no rows.
    """
    mains = records.where(F.col("kind").isin("response", "revisit", "resource"))
    others = records.where(~F.col("kind").isin("response", "revisit", "resource") | F.col("kind").isNull())
    main_ids = mains.select(F.col("record_id").alias("capture_id")).distinct()
    named = (others.select(F.col("record_id").alias("member"), F.explode("concurrent_to").alias("capture_id"))
             .join(main_ids, "capture_id", "left_semi"))
    naming = mains.select(F.col("record_id").alias("capture_id"), F.explode("concurrent_to").alias("member"))
    links = named.select("capture_id", "member").unionByName(naming).distinct()
    detail = F.struct("kind", "record_id", "uri", "page_id", "payload_bytes", "body")
    linked = others.join(links.withColumnRenamed("member", "record_id"), "record_id", "left")
    members = (linked.select(F.coalesce("capture_id", "record_id").alias("capture_id"), detail.alias("member"))
               .groupBy("capture_id").agg(F.array_distinct(F.collect_list("member")).alias("members")))
    whole = F.struct("kind", "record_id", "uri", "digest", "digest_ok", "payload_bytes", "refers_to", "body")
    out = mains.select(F.col("record_id").alias("capture_id"), whole.alias("response")).join(members, "capture_id", "full")
    kept = F.coalesce("members", F.array().cast(dict(members.dtypes)["members"]))
    return out.select("capture_id", "response",
                      F.filter(kept, lambda m: m["kind"] == "request").alias("requests"),
                      F.filter(kept, lambda m: ~m["kind"].eqNullSafe("request")).alias("metadata"))
