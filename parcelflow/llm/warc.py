"""ARC archives converted to WARC 1.1, written as gzip files and read back.

The converter reads each ARC file's version block, which names the fields of
its record lines (version 1 has five, version 2 has ten), takes every record's
block by its declared length, and synthesises what WARC asks for and ARC lacks:
record ids, ISO timestamps, record types and payload digests. Records with
equal payloads become revisits of one response.

Archives hold about ``ARCHIVE_BYTES`` of payload, dealt by a hash of the whole
page, so many pages without id or of one URL spread too. Each is written by a
task of its own, which holds one such file (and one record more) at a time, as
one gzip stream.

Cases: a null payload is empty; null page ids are left out of the record and
rank below every other id; null or blank URLs become ``urn:none`` and blanks
inside a URL are escaped; repeated rows are records of their own, and the last
of equal ids by record id is the response; unreadable header lines are skipped
to the next readable one; blocks cut short are marked ``WARC-Truncated``; other
columns are ignored; an empty table gives empty archives and results.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelflow.llm.common import salted_left_join, shared_path, stored, table

ARCHIVE_BYTES = 12 << 20
REVISIT_BYTES = 1000
# Revisit lists up to this many rows (about 150 bytes each) are broadcast, longer ones shuffled.
BROADCAST_REVISITS = 50_000
CRAWL_DATE = "20260101000000"
BATCH_BYTES = 4 << 20

# The record-line fields of the two ARC versions.
ARC_FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

CONVERTED = (
    "record_id string, warc_type string, warc_date string, target_uri string, ip string, content_type string, "
    "truncated boolean, page_id long, payload_bytes long, payload_digest string, head_bytes long, block binary"
)
READ_BACK = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


# ---- legacy archives ------------------------------------------------------------------------------------------


def archive_count(pages: DataFrame, payload: str = "html") -> int:
    total = pages.agg(F.sum(F.octet_length(payload)).alias("n")).first()["n"] or 0
    return 2 * max(1, -(-total // (2 * ARCHIVE_BYTES)))


def write_arc(pages: DataFrame, path: str, crawl_date: str = CRAWL_DATE) -> None:
    """``page_id, url, html`` as ARC files under ``path``, half of them version 1 and half version 2."""
    n = archive_count(pages)
    spread = F.pmod(F.xxhash64("page_id", "url", "html"), F.lit(n)).cast("int")
    body = F.coalesce(F.col("html").cast("string"), F.lit(""))
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.octet_length(body).cast("string"),
        F.coalesce(F.concat(F.lit("\r\nX-Page-Id: "), F.col("page_id").cast("string")), F.lit("")),
        F.lit("\r\n\r\n"),
        body,
    )
    url = F.regexp_replace(F.trim(F.coalesce("url", F.lit(""))), r"[\x00-\x20]", "%20")
    records = pages.select(
        spread.alias("archive"),
        F.lit(1).alias("part"),
        F.when(url == "", "urn:none").otherwise(url).alias("url"),
        http.alias("block"),
    )
    versions = F.when(F.col("archive") % 2 == 0, F.lit(1)).otherwise(F.lit(2))
    about = F.when(versions == 1, F.lit(f"1 0 crawl\n{ARC_FIELDS[1]}\n")).otherwise(F.lit(f"2 0 crawl\n{ARC_FIELDS[2]}\n"))
    first = pages.sparkSession.range(n).select(
        F.col("id").cast("int").alias("archive"),
        F.lit(0).alias("part"),
        F.concat(F.lit("filedesc://archive-"), F.col("id").cast("string"), F.lit(".arc")).alias("url"),
    ).withColumn("block", about)
    kind = F.when(F.col("part") == 0, "text/plain").otherwise("text/html")
    extra = F.when(versions == 1, F.lit("")).otherwise(F.lit("200 - - 0 archive.arc "))
    line = F.concat(
        F.col("url"), F.lit(" 0.0.0.0 "), F.lit(crawl_date), F.lit(" "), kind, F.lit(" "), extra,
        F.octet_length("block").cast("string"), F.lit("\n"), F.col("block"),
    )
    (
        records.unionByName(first)
        .repartitionById(n, F.col("archive"))
        .sortWithinPartitions("archive", "part")
        .select("archive", line.alias("value"))
        .write.partitionBy("archive")
        .option("compression", "gzip")
        .option("zlib.compress.level", "BEST_SPEED")
        .option("lineSep", "\n")
        .text(path)
    )


@dataclass
class ArcRecord:
    offset: int
    fields: dict[str, str]
    block: bytes
    truncated: bool
    version_block: bool = False


def unzipped(data: bytes) -> bytes:
    """All gzip members of ``data``; data that isn't gzip comes back as it is."""
    if data[:2] != b"\x1f\x8b":
        return data
    out = []
    while data[:2] == b"\x1f\x8b":
        member = zlib.decompressobj(31)
        out.append(member.decompress(data))
        data = member.unused_data
    return b"".join(out)


def arc_records(data: bytes) -> Iterator[ArcRecord]:
    """Records of one ARC file, its version block first; a ``filedesc:`` URL further on is a page's."""
    names = ARC_FIELDS[1].split()
    at, first = 0, True
    while at < len(data):
        end = data.find(b"\n", at)
        if end < 0:
            return
        line = data[at:end].decode("utf-8", "replace").rstrip("\r")
        # the URL of an old record may hold blanks, so fields count from the right
        values = line.rsplit(" ", len(names) - 1)
        about_archive = first and line.startswith("filedesc:")
        if about_archive:
            values = line.rsplit(" ", len(ARC_FIELDS[1].split()) - 1)
        if len(values) < 5 or not values[-1].isdigit():
            at = end + 1
            continue
        length = int(values[-1])
        block = data[end + 1 : end + 1 + length]
        if about_archive:
            fields = dict(zip(ARC_FIELDS[1].split(), values, strict=True))
            about = block.decode("utf-8", "replace").split("\n")
            version = int(about[0][:1]) if about[0][:1] in ("1", "2") else 1
            declared = about[1].split() if len(about) > 1 else []
            names = declared if len(declared) >= 5 else ARC_FIELDS[version].split()
        else:
            fields = dict(zip(names, values, strict=True))
        yield ArcRecord(at, fields, block, len(block) < length, about_archive)
        first = False
        at = end + 1 + length
        if data[at : at + 1] == b"\n":
            at += 1


def iso_date(digits: str) -> str:
    """A 14-digit ARC date in WARC's form; dates cut short begin their period, others are 1970."""
    if not re.fullmatch(r"\d{8,14}", digits):
        return "1970-01-01T00:00:00Z"
    d = digits.ljust(14, "0")
    return f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z"


def record_type(record: ArcRecord) -> str:
    if record.version_block:
        return "warcinfo"
    if record.block[:5] == b"HTTP/":
        return "response"
    return "resource"


def split_http(block: bytes) -> tuple[int, dict[bytes, bytes]]:
    """Length of the HTTP head (with its blank line) and its header fields."""
    end = block.find(b"\r\n\r\n")
    if block[:5] != b"HTTP/" or end < 0:
        return 0, {}
    lines = (x.partition(b":") for x in block[:end].split(b"\r\n")[1:])
    return end + 4, {k.strip().lower(): v.strip() for k, _, v in lines}


def _page_id(head: dict[bytes, bytes]) -> int | None:
    value = head.get(b"x-page-id", b"")
    return int(value) if re.fullmatch(rb"-?\d+", value) else None


def convert_record(name: str, record: ArcRecord) -> tuple:
    f = record.fields
    url, date = f.get("URL", "urn:none"), f.get("Archive-date", "")
    kind = record_type(record)
    head_bytes, head = split_http(record.block)
    payload = record.block[head_bytes:]
    return (
        f"urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{name}/{record.offset}/{date}/{url}')}",
        kind, iso_date(date), url, f.get("IP-address", "0.0.0.0"),
        "application/warc-fields" if kind == "warcinfo" else "application/http; msgtype=response" if kind == "response" else f.get("Content-type", "application/octet-stream"),
        record.truncated, _page_id(head), len(payload), hashlib.sha1(payload).hexdigest(), head_bytes, record.block,
    )


def _batched(rows: Iterator[tuple], schema: pa.Schema, size) -> Iterator[pa.RecordBatch]:
    """Batches of about ``BATCH_BYTES``."""
    held, total = [], 0
    for row in rows:
        held.append(row)
        total += size(row)
        if total >= BATCH_BYTES:
            yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)
            held, total = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)


def archive_name(file: str, root: str) -> str:
    """The file's path below ``root``. Files of one write task are named alike in every folder.

    Spark gives ``file`` with its scheme, which may differ from the root's.
    """
    inside = urlsplit(root).path.strip("/") + "/"
    return file[file.index(inside) + len(inside) :] if inside in file else file


def archives(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "content")


def convert_arc(spark: SparkSession, path: str) -> DataFrame:
    """Every ARC record under ``path`` as a WARC record in the making."""
    schema = pa.schema(
        [("record_id", pa.string()), ("warc_type", pa.string()), ("warc_date", pa.string()), ("target_uri", pa.string()), ("ip", pa.string()),
         ("content_type", pa.string()), ("truncated", pa.bool_()), ("page_id", pa.int64()), ("payload_bytes", pa.int64()),
         ("payload_digest", pa.string()), ("head_bytes", pa.int64()), ("block", pa.binary())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path_, content in zip(batch.column("path"), batch.column("content"), strict=True):
                name = archive_name(path_.as_py(), path)
                rows = (convert_record(name, r) for r in arc_records(unzipped(content.as_py())))
                yield from _batched(rows, schema, lambda row: len(row[-1]) + 300)

    return archives(spark, path).mapInArrow(run, CONVERTED)


# ---- duplicates and WARC files --------------------------------------------------------------------------------


def revisits(converted: DataFrame, least: int = REVISIT_BYTES) -> DataFrame:
    """``record_id, refers_to_id, refers_to_page`` of the records whose payload another record keeps."""
    large = converted.where((F.col("warc_type") == "response") & (F.col("payload_bytes") >= least)).select(
        "payload_digest", "page_id", "record_id"
    )
    large = stored(large, "payload-digests")
    kept = (
        large.groupBy("payload_digest")
        .agg(F.max(F.struct("page_id", "record_id")).alias("keep"), F.count(F.lit(1)).alias("n"))
        .where("n > 1")
        .select("payload_digest", F.col("keep.record_id").alias("refers_to_id"), F.col("keep.page_id").alias("refers_to_page"))
    )
    # a digest may hold a third of all records
    return (
        salted_left_join(large, kept, ["payload_digest"], "record_id", how="inner")
        .where(F.col("record_id") != F.col("refers_to_id"))
        .select("record_id", "refers_to_id", "refers_to_page")
    )


def write_warc(converted: DataFrame, repeated: DataFrame, path: str) -> None:
    """WARC 1.1 files; ``repeated`` (see ``revisits``) become revisit records without payload."""
    repeated = stored(repeated, "revisits")
    if repeated.count() <= BROADCAST_REVISITS:
        repeated = F.broadcast(repeated)
    rows = converted.join(repeated, "record_id", "left")
    again = F.col("refers_to_id").isNotNull()
    block = F.when(again, F.expr("substring(block, 1, CAST(head_bytes AS INT))")).otherwise(F.col("block"))

    def field(name: str, value, when=None):
        text = F.concat(F.lit(f"\r\n{name}: "), value)
        return text if when is None else F.when(when, text).otherwise(F.lit(""))

    payload = F.col("warc_type") != "warcinfo"
    head = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: "),
        F.when(again, F.lit("revisit")).otherwise(F.col("warc_type")),
        field("WARC-Record-ID", F.concat(F.lit("<"), F.col("record_id"), F.lit(">"))),
        field("WARC-Date", F.col("warc_date")),
        field("WARC-Target-URI", F.col("target_uri"), payload),
        field("WARC-IP-Address", F.col("ip"), payload),
        field("WARC-Payload-Digest", F.concat(F.lit("sha1:"), base32(F.col("payload_digest"))), payload),
        field("WARC-Truncated", F.lit("length"), F.col("truncated")),
        field("WARC-Profile", F.lit(PROFILE), again),
        field("WARC-Refers-To", F.concat(F.lit("<"), F.col("refers_to_id"), F.lit(">")), again),
        field("X-Refers-To-Page-Id", F.col("refers_to_page").cast("string"), F.col("refers_to_page").isNotNull()),
        field("Content-Type", F.col("content_type")),
        field("Content-Length", F.length(block).cast("string")),
        F.lit("\r\n\r\n"),
    )
    # a record ends with two line breaks, which is what separates the lines of this text file
    (
        rows.select(F.concat(F.encode(head, "UTF-8"), block).cast("string").alias("value"))
        .write.option("compression", "gzip")
        .option("zlib.compress.level", "BEST_SPEED")
        .option("lineSep", "\r\n\r\n")
        .text(path)
    )


def base32(hex_digest):
    """A hex SHA-1 in base 32, as WARC digests are written."""
    bits = F.concat(*(F.lpad(F.conv(F.substring(hex_digest, 1 + 10 * k, 10), 16, 32), 8, "0") for k in range(4)))
    return F.translate(bits, "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def warc_records(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Named fields (lower case) and block of each record of one WARC file, by declared lengths."""
    at = 0
    while (at := data.find(b"WARC/1.", at)) >= 0:
        end = data.find(b"\r\n\r\n", at)
        if end < 0:
            return
        lines = (x.partition(":") for x in data[at:end].decode("utf-8", "replace").split("\r\n")[1:])
        fields = {k.strip().lower(): v.strip() for k, _, v in lines}
        length = int(fields.get("content-length", "0"))
        yield fields, data[end + 4 : end + 4 + length]
        at = end + 4 + length


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """``page_id, payload_bytes, payload_digest, record_type, refers_to`` of every response and revisit."""
    schema = pa.schema(
        [("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64())]
    )

    def rows_of(data: bytes) -> Iterator[tuple]:
        for fields, block in warc_records(data):
            kind = fields.get("warc-type")
            head_bytes, head = split_http(block)
            if kind == "response":
                payload = memoryview(block)[head_bytes:]
                yield _page_id(head), len(payload), hashlib.sha1(payload).hexdigest(), kind, None
            elif kind == "revisit":
                digest = base64.b32decode(fields["warc-payload-digest"].removeprefix("sha1:")).hex()
                to = fields.get("x-refers-to-page-id")
                yield _page_id(head), int(head[b"content-length"]), digest, kind, None if to is None else int(to)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content"):
                yield from _batched(rows_of(unzipped(content.as_py())), schema, lambda row: 100)

    return archives(spark, path).mapInArrow(run, READ_BACK)


def archive_pages(pages: DataFrame) -> DataFrame:
    """Pages to ARC files, converted to WARC files, read back."""
    spark = pages.sparkSession
    arc, warc = shared_path(spark, "arc"), shared_path(spark, "warc")
    write_arc(pages.select(F.col("page_id").cast("long"), "url", "html"), arc)
    converted = convert_arc(spark, arc)
    write_warc(converted, revisits(converted), warc)
    return read_warc(spark, warc)


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive_pages(table(spark, sf_dir, "pages"))


OP1_SQL = """
WITH p AS (
    SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest
    FROM pages
),
k AS (SELECT payload_digest, max(page_id) AS keep FROM p WHERE payload_bytes >= 1000 GROUP BY payload_digest)
SELECT p.page_id, p.payload_bytes, p.payload_digest,
       CASE WHEN k.keep IS NULL OR k.keep = p.page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN k.keep <> p.page_id THEN k.keep END AS refers_to
FROM p LEFT JOIN k ON p.payload_bytes >= 1000 AND k.payload_digest = p.payload_digest
"""
