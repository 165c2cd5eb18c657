"""Legacy web archives: ARC files of both versions, converted to WARC and read back.

An ARC file begins with a version block that names the fields of its record header lines; the last
field is the declared length of what follows.  Version 1 has five fields, version 2 ten.  The converter reads header
lines by their version, takes exactly the declared bytes, and writes WARC records with the
identifiers, timestamps, types and digests that ARC lacks.  A payload that another record holds too is
stored once; the others become revisit records that point to it.  Records are bytes throughout: pages in any
encoding, images, and records that are no HTTP response (name look-ups and the like), which become resource records.

Files are written and read by Spark's own sources, so they may lie in any store: a task packs
records into rows of about ``ARCHIVE_BYTES``, each row becomes one gzip file.  No payload is collected, and only
compressed archives, joined with the short list of their revisits, are shuffled.

Defined results: a null html is an empty payload; null urls get a placeholder; of equal payloads the record with the
largest page id is the response, a null id ranking lowest, and of tied ids the one later in the archives.  Ids of any
text come back as they were.  Header bytes that are no UTF-8 are percent-encoded.  Columns other than id, url and html are not carried along.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterloom.llm.skew import join_counted
from rosterloom.sources.staging import materialize, staging_path

ARCHIVE_BYTES = 8 << 20
MIN_REVISIT_BYTES = 1000
ARCHIVE_DATE = "20240101000000"
NO_URL = "urn:none:page"

# Fixed values of the two formats.
ARC_FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
WARC_VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


@dataclass
class ArcRecord:
    offset: int
    version: int
    fields: dict[str, str]
    block: bytes


def one_line(value: str | None) -> str:
    """A URL that fits into a header line: white space and control characters are percent-encoded."""
    if not value:
        return NO_URL
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m.group()):02X}", value)


def header_text(raw: bytes) -> str:
    """A header line as text; where it is no UTF-8, all its bytes beyond ASCII are percent-encoded."""
    try:
        return raw.decode()
    except UnicodeDecodeError:
        return re.sub(rb"[\x80-\xff]", lambda m: b"%%%02X" % m.group()[0], raw).decode()


def http_block(page_id: str | None, payload: bytes) -> bytes:
    own = "" if page_id is None else f"X-Page-Id: {quote(page_id, safe='')}\r\n"
    return f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n{own}\r\n".encode() + payload


def split_http(block: bytes) -> tuple[dict[str, str] | None, bytes]:
    """(header fields in lower case, payload) of an HTTP response; (None, block) of anything else."""
    if not block.startswith(b"HTTP/"):
        return None, block
    end = re.search(rb"\r?\n\r?\n", block)
    head, payload = (block[: end.start()], block[end.end() :]) if end else (block, b"")
    pairs = (header_text(line).partition(":") for line in re.split(rb"\r?\n", head)[1:])
    return {name.strip().lower(): value.strip() for name, _, value in pairs}, payload


def page_of(fields: dict[str, str] | None, name: str = "x-page-id") -> str | None:
    value = (fields or {}).get(name)
    return None if value is None else unquote(value)


def arc_header(version: int, url: str, date: str, mime: str, length: int, payload: bytes = b"") -> bytes:
    if version == 1:
        return f"{url} 0.0.0.0 {date} {mime} {length}\n".encode()
    checksum = hashlib.md5(payload).hexdigest() if payload else "-"
    return f"{url} 0.0.0.0 {date} {mime} 200 {checksum} - 0 - {length}\n".encode()


def arc_version_block(version: int, date: str = ARCHIVE_DATE) -> bytes:
    body = f"{version} 0 rosterloom\n{ARC_FIELDS[version]}\n".encode()
    return arc_header(version, "filedesc://pages.arc", date, "text/plain", len(body)) + body


def parse_arc(data: bytes) -> Iterator[ArcRecord]:
    """Records of an ARC file; raises ValueError where a header line or a length cannot be right."""
    at, fields, version = 0, None, 0
    while at < len(data):
        end = data.find(b"\n", at)
        line = data[at : len(data) if end < 0 else end].rstrip(b"\r")
        if not line:  # the line end after a record
            at = (len(data) if end < 0 else end) + 1
            continue
        length = line.rpartition(b" ")[2]
        if end < 0 or not length.isdigit() or end + 1 + int(length) > len(data):
            raise ValueError(f"damaged ARC record at byte {at}")
        block = data[end + 1 : end + 1 + int(length)]
        if line.startswith(b"filedesc://"):
            first, names = block.decode("latin-1").split("\n")[:2]
            version, fields = int(first.split(" ")[0]), names.split(" ")
            if version not in ARC_FIELDS:
                raise ValueError(f"unknown ARC version {version}")
        else:
            if fields is None:
                raise ValueError("an ARC file begins with its version block")
            values = header_text(line).rsplit(" ", len(fields) - 1)  # only the URL can hold blanks
            if len(values) != len(fields):
                raise ValueError(f"damaged ARC header at byte {at}")
            yield ArcRecord(at, version, dict(zip(fields, values)), block)
        at = end + 1 + int(length)


def unzipped(content: bytes) -> bytes:
    """All members of a gzip file; other content as it is."""
    if content[:2] != b"\x1f\x8b":
        return content
    out = []
    while content:
        member = zlib.decompressobj(31)
        out.append(member.decompress(content) + member.flush())
        content = member.unused_data
    return b"".join(out)


def record_id(archive: str, offset: int) -> str:
    """The same identifier whenever the same place of the same archive is converted."""
    digest = hashlib.sha1(f"{archive}|{offset}".encode()).digest()
    return f"<urn:uuid:{uuid.UUID(bytes=digest[:16], version=5)}>"


def iso_date(stamp: str) -> str:
    """An ARC date of 14 digits (or fewer, to be filled up) in ISO form."""
    stamp = stamp[:14] + "00000101000000"[len(stamp[:14]) :]
    return f"{stamp[:4]}-{stamp[4:6]}-{stamp[6:8]}T{stamp[8:10]}:{stamp[10:12]}:{stamp[12:14]}Z"


def digest_label(raw: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(raw).digest()).decode()


def bare_digest(label: str | None) -> str | None:
    """The SHA-1 of a digest header in lower-case hex; null for other digests."""
    value = (label or "").removeprefix("sha1:")
    return base64.b32decode(value).hex() if re.fullmatch("[A-Z2-7]{32}", value) else value.lower() if re.fullmatch("[0-9A-Fa-f]{40}", value) else None


def warc_record(fields: dict[str, str], block: bytes) -> bytes:
    lines = [WARC_VERSION, *(f"{k}: {v}" for k, v in fields.items()), f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block


def parse_warc(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header fields in lower case, block) of each record, by the declared lengths."""
    at = 0
    while at < len(data):
        if data[at : at + 5] != b"WARC/":
            raise ValueError(f"damaged WARC record at byte {at}")
        end = data.index(b"\r\n\r\n", at)
        pairs = (header_text(line).partition(":") for line in data[at:end].split(b"\r\n")[1:])
        fields = {name.strip().lower(): value.strip() for name, _, value in pairs}
        length = int(fields["content-length"])
        yield fields, data[end + 4 : end + 4 + length]
        at = end + 4 + length
        if data[at : at + 4] != b"\r\n\r\n":
            raise ValueError(f"damaged WARC record before byte {at}")
        at += 4


def _as_row(content: bytes) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([content], pa.binary())], ["value"])


def _write_files(rows: DataFrame, path: str, separator: str) -> None:
    """One gzip file per row, closed by the separator that ends the last record; Spark's text sink writes any bytes as they are."""
    rows.select(F.col("value").cast("string")).write.option("maxRecordsPerFile", 1).option("compression", "gzip").option("lineSep", separator).text(path)


def _read_files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select(F.col("path").alias("archive"), "content")


def write_arc(pages: DataFrame, path: str, page_id: str = "page_id", url: str = "url", html: str = "html", archive_bytes: int = ARCHIVE_BYTES) -> None:
    """Pages as ARC files; the versions take turns."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        version, parts, size = 1, [], 0
        for batch in batches:
            ids, urls = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for k, payload in enumerate(batch.column(2).cast(pa.binary())):
                payload = payload.as_py() or b""
                block = http_block(ids[k], payload)
                parts.append(arc_header(version, one_line(urls[k]), ARCHIVE_DATE, "text/html", len(block), payload) + block)
                size += len(parts[-1])
                if size >= archive_bytes:
                    yield _as_row(b"\n".join([arc_version_block(version), *parts]))
                    version, parts, size = 3 - version, [], 0
        if parts:
            yield _as_row(b"\n".join([arc_version_block(version), *parts]))

    _write_files(pages.select(F.col(page_id).cast("string"), url, html).mapInArrow(pack, "value binary"), path, "\n")


def read_arc(spark: SparkSession, path: str) -> DataFrame:
    """A row per ARC record, without its payload: archive, offset, version, url, date, mime, page_id, payload_bytes, payload_digest, http."""

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for archive, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                rows = []
                for r in parse_arc(unzipped(content.as_py())):
                    http, payload = split_http(r.block)
                    rows.append(
                        {
                            "archive": archive, "offset": r.offset, "version": r.version, "url": r.fields["URL"], "date": r.fields["Archive-date"],
                            "mime": r.fields["Content-type"], "page_id": page_of(http), "payload_bytes": len(payload),
                            "payload_digest": hashlib.sha1(payload).hexdigest(), "http": http is not None,
                        }
                    )
                yield pa.RecordBatch.from_pylist(rows, _ARC_ROW)

    return _read_files(spark, path).mapInArrow(
        parse, "archive string, offset bigint, version int, url string, date string, mime string, page_id string, payload_bytes bigint, payload_digest string, http boolean"
    )


_ARC_ROW = pa.schema(
    [
        ("archive", pa.string()), ("offset", pa.int64()), ("version", pa.int32()), ("url", pa.string()), ("date", pa.string()),
        ("mime", pa.string()), ("page_id", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("http", pa.bool_()),
    ]
)


def revisits(records: DataFrame, id_type: str, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """(archive, offset, response) of the HTTP records whose payload another record keeps."""
    large = records.where(F.col("http") & (F.col("payload_bytes") >= min_bytes)).select(
        "archive", "offset", F.struct(F.col("page_id").cast(id_type).alias("page"), "archive", "offset", "url", "date").alias("own"), "payload_digest"
    )
    groups = large.groupBy("payload_digest").agg(F.max("own").alias("response"), F.count(F.lit(1)).alias("n")).where("n > 1")
    joined = join_counted(large, groups, ["payload_digest"], "n", max(1, large.count()))
    return joined.where("own != response").select("archive", "offset", "response")


def write_warc(spark: SparkSession, arc_path: str, path: str, found: DataFrame) -> None:
    """Converts ARC files to WARC files, one for one; ``found`` are their :func:`revisits`."""
    lists = found.groupBy("archive").agg(  # at most the records of an archive
        F.collect_list(
            F.struct("offset", F.col("response.page").cast("string").alias("page"), F.col("response.archive").alias("archive"),
                     F.col("response.offset").alias("at"), F.col("response.url").alias("url"), F.col("response.date").alias("date"))
        ).alias("revisits")
    )

    def convert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for archive, content, seen in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist()):
                targets = {r["offset"]: r for r in seen or ()}
                info = b"software: rosterloom\r\nformat: WARC File Format 1.1\r\n"
                out = [
                    warc_record(
                        {"WARC-Type": "warcinfo", "WARC-Record-ID": record_id(archive, -1), "WARC-Date": iso_date(ARCHIVE_DATE), "Content-Type": "application/warc-fields"}, info
                    )
                ]
                for r in parse_arc(unzipped(content.as_py())):
                    http, payload = split_http(r.block)
                    kind, content_type = ("resource", r.fields["Content-type"]) if http is None else ("response", "application/http; msgtype=response")
                    fields = {
                        "WARC-Type": kind, "WARC-Record-ID": record_id(archive, r.offset), "WARC-Date": iso_date(r.fields["Archive-date"]),
                        "WARC-Target-URI": r.fields["URL"], "Content-Type": content_type, "WARC-Payload-Digest": digest_label(payload),
                    }
                    block = r.block
                    if target := targets.get(r.offset):
                        block = r.block[: len(r.block) - len(payload)]
                        fields |= {
                            "WARC-Type": "revisit", "WARC-Profile": REVISIT_PROFILE, "WARC-Refers-To": record_id(target["archive"], target["at"]),
                            "WARC-Refers-To-Target-URI": target["url"], "WARC-Refers-To-Date": iso_date(target["date"]),
                            "X-Payload-Length": str(len(payload)),
                        }
                        if target["page"] is not None:
                            fields["X-Refers-To-Page-Id"] = quote(target["page"], safe="")
                    fields["WARC-Block-Digest"] = digest_label(block)
                    out.append(warc_record(fields, block))
                yield _as_row(b"\r\n\r\n".join(out))

    archives = _read_files(spark, arc_path).join(lists, "archive", "left")
    _write_files(archives.select("archive", "content", "revisits").mapInArrow(convert, "value binary"), path, "\r\n\r\n")


_WARC_ROW = pa.schema(
    [
        ("record_id", pa.string()), ("record_type", pa.string()), ("date", pa.string()), ("url", pa.string()), ("page_id", pa.string()),
        ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("refers_to_id", pa.string()), ("refers_to", pa.string()),
    ]
)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """A row per response, resource or revisit record; the digests that are given of blocks and stored payloads are checked.

    The size of a revisited payload is null where the record does not tell it.
    """

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(1):
                rows = []
                for fields, block in parse_warc(unzipped(content.as_py())):
                    kind = fields["warc-type"]
                    if kind not in ("response", "resource", "revisit"):
                        continue
                    http, payload = split_http(block)
                    told = fields.get("x-payload-length") or (http or {}).get("content-length") or ""
                    stored = None if kind == "revisit" else digest_label(payload)
                    digest = fields.get("warc-payload-digest", stored)
                    if fields.get("warc-block-digest", "").startswith("sha1:") and digest_label(block) != fields["warc-block-digest"] or stored and digest.startswith("sha1:") and stored != digest:
                        raise ValueError(f"a digest does not fit in {fields['warc-record-id']}")
                    rows.append(
                        {
                            "record_id": fields["warc-record-id"], "record_type": kind, "date": fields["warc-date"], "url": fields.get("warc-target-uri"),
                            "page_id": page_of(http), "payload_bytes": len(payload) if stored else int(told) if told.isdigit() else None,
                            "payload_digest": bare_digest(stored or digest), "refers_to_id": fields.get("warc-refers-to"),
                            "refers_to": page_of(fields, "x-refers-to-page-id"),
                        }
                    )
                yield pa.RecordBatch.from_pylist(rows, _WARC_ROW)

    return _read_files(spark, path).mapInArrow(
        parse,
        "record_id string, record_type string, date string, url string, page_id string, payload_bytes bigint, payload_digest string, refers_to_id string, refers_to string",
    )


def through_archives(pages: DataFrame, folder: str, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Writes ARC files, converts them, and reads the WARC files back; ``folder`` keeps both."""
    spark = pages.sparkSession
    id_type = pages.schema[page_id].dataType.simpleString()
    write_arc(pages, f"{folder}/arc", page_id, url, html)
    records = materialize(read_arc(spark, f"{folder}/arc"))
    write_warc(spark, f"{folder}/arc", f"{folder}/warc", revisits(records, id_type))
    back = read_warc(spark, f"{folder}/warc")
    return back.withColumn("page_id", F.col("page_id").cast(id_type)).withColumn("refers_to", F.col("refers_to").cast(id_type))


def op3_warc(spark, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    found = through_archives(pages, staging_path(spark, "archives"))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP3_SQL = f"""
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, '')))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
q AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS last FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= {MIN_REVISIT_BYTES} AND page_id <> last THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= {MIN_REVISIT_BYTES} AND page_id <> last THEN last END AS refers_to
FROM q
"""
