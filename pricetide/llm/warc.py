"""Legacy ARC archives to WARC, and WARC archives written and read by Spark.

An ARC file starts with a ``filedesc:`` record that names its version; each record is one header
line and as many bytes as the line declares. Version 1 lines have five fields (URL, IP address,
date, type, length), version 2 lines ten (URL, IP address, date, type, result code, checksum,
location, offset, file name, length). Fields are taken from the right, as old crawlers left
spaces in URLs. The converter gives every record its WARC equivalent: an identifier made from
file name and offset (the same on every run), the date in ISO form, the type (warcinfo,
response for HTTP, resource for the rest, revisit for a copy) and SHA-1 digests.

Spark writes archives as text files whose line separator is the blank lines that end a WARC
record, and reads them back whole, file by file, cutting records by their declared lengths.
Files are bounded by ``FILE_BYTES`` of records on average.

Defined cases: null html is an empty payload; null or odd URLs are replaced or percent-encoded
where a header line could not hold them; rows that repeat a page_id get records of their own
under one identifier, and of such rows with equal payloads the one is response whose id no other
exceeds (all of them, if they tie); null page_ids are never revisits of, nor revisited by, others;
an empty table writes no records.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricetide.llm.shared import shared_path, ship, stage, table

ARC_FILE, ARC_DATE, ARC_IP = "pages.arc", "20000101000000", "0.0.0.0"
LEAST_BYTES = 1000  # shorter payloads are never revisits
FILE_BYTES = 1 << 23
_ROWS = 256  # pages worked on at a time
CRLF = b"\r\n"
# The field names of ARC header lines, by version of the format.
FIELDS = {
    1: "url ip date type length".split(),
    2: "url ip date type code checksum location offset filename length".split(),
}
# Characters that a header line cannot hold.
_ODD = re.compile(r"[\x00-\x20\x7f]")


@dataclass
class Archived:
    """A record of an ARC file; ``name`` and ``offset`` say where it stands."""

    fields: dict[str, str]
    block: bytes
    name: str
    offset: str


def parse_arc(data: bytes) -> Iterator[Archived]:
    """Records of an ARC file, the file description first."""
    version, name, at, first = 1, "", 0, True
    while at < len(data):
        if data[at : at + 1] in (b"\n", b"\r"):  # blank lines between records
            at += 1
            continue
        end = data.find(b"\n", at)
        if end < 0:
            raise ValueError(f"ARC header line at byte {at} does not end")
        line = data[at:end].rstrip(b"\r").decode("utf-8", "replace")
        described = first and line.startswith("filedesc:")  # later, it is a page of that name
        first = False
        if described:  # the first line comes before its block names the version
            version = 2 if line.count(" ") >= len(FIELDS[2]) - 1 else 1
        names = FIELDS[version]
        parts = line.rsplit(" ", len(names) - 1)
        if len(parts) != len(names) or not parts[-1].isdigit():
            raise ValueError(f"not an ARC version {version} header line at byte {at}: {line[:80]!r}")
        fields, size = dict(zip(names, parts)), int(parts[-1])
        block = data[end + 1 : end + 1 + size]
        if len(block) < size:
            raise ValueError(f"ARC record at byte {at} declares {size} bytes, {len(block)} are there")
        if described:
            version = int(block.split(b" ", 1)[0])
            name = fields["url"].removeprefix("filedesc://")
        yield Archived(fields, block, fields.get("filename") or name, fields.get("offset") or str(at))
        at = end + 1 + size


def record_id(name: str, offset: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{name}#{offset}')}>"


def iso_date(date: str) -> str:
    """14 digits, or fewer as old files have, as a WARC date."""
    d = (date + "00000101000000"[len(date) :])[:14] if len(date) < 14 else date[:14]
    return f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z"


def digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def payload_of(block: bytes) -> tuple[bytes, bytes]:
    """HTTP head (with its blank line) and body."""
    head, blank, body = block.partition(CRLF + CRLF)
    return (head + blank, body) if blank else (b"", block)


def convert(record: Archived, refers_to: str | None = None) -> bytes:
    """The WARC record of an ARC record, without the two line ends that follow it.

    ``refers_to`` is the identifier of the response that holds the same payload.
    """
    fields, block, url = record.fields, record.block, record.fields["url"]
    http = url.lower().startswith(("http:", "https:")) or block.startswith(b"HTTP/")
    head, body = payload_of(block) if http else (b"", block)
    kind = "warcinfo" if url.startswith("filedesc:") else "revisit" if refers_to else "response" if http else "resource"
    lines = [
        "WARC/1.0",
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: {record_id(record.name, record.offset)}",
        f"WARC-Date: {iso_date(fields['date'])}",
    ]
    if kind == "warcinfo":
        lines.append(f"WARC-Filename: {record.name}")
    else:
        lines += [f"WARC-Target-URI: {url}", f"WARC-IP-Address: {fields['ip']}", f"WARC-Payload-Digest: {digest(body)}"]
    if refers_to:
        lines += [f"WARC-Refers-To: {refers_to}", "WARC-Profile: http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"]
        block = head
    kinds = {"warcinfo": "text/plain", "resource": fields["type"]}
    lines += [
        f"Content-Type: {kinds.get(kind, 'application/http; msgtype=response')}",
        f"WARC-Block-Digest: {digest(block)}",
        f"Content-Length: {len(block)}",
    ]
    return "\r\n".join(lines).encode() + CRLF + CRLF + block


def parse_warc(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers (names in lower case) and block of each record, cut by declared lengths."""
    at = 0
    while at < len(data):
        if data[at : at + 2] == CRLF:
            at += 2
            continue
        end = data.index(CRLF + CRLF, at)
        first, *lines = data[at:end].decode("utf-8").split("\r\n")
        if not first.startswith("WARC/"):
            raise ValueError(f"no WARC record at byte {at}")
        headers = {k.lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}
        size = int(headers["content-length"])
        yield headers, data[end + 4 : end + 4 + size]
        at = end + 4 + size


def arc_description(name: str) -> bytes:
    body = b"2 0 pricetide\nURL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length\n"
    return f"filedesc://{name} {ARC_IP} {ARC_DATE} text/plain 200 - - 0 {name} {len(body)}\n".encode() + body + b"\n"


def arc_record(page_id: int | None, url: str | None, payload: bytes) -> bytes:
    """A page as a version 2 ARC record with an HTTP head."""
    url = f"urn:page:{page_id}" if url is None else _ODD.sub(lambda m: f"%{ord(m[0]):02X}", url) or "about:blank"
    mark = "" if page_id is None else page_id
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\nX-Page-Id: {mark}\r\n\r\n"
    block = head.encode() + payload
    checksum = hashlib.sha1(payload).hexdigest()
    line = f"{url} {ARC_IP} {ARC_DATE} text/html 200 {checksum} - {mark if mark != '' else 'none'} {ARC_FILE} {len(block)}\n"
    return line.encode() + block + b"\n"


def _archive(batches):
    """Every page becomes an ARC record, and that a WARC record; one warcinfo record per task."""
    described = False
    for batch in batches:
        for lo in range(0, batch.num_rows, _ROWS):
            part = batch.slice(lo, _ROWS)
            pages = zip(*(part[c].to_pylist() for c in ("page_id", "url", "payload", "keeper")))
            out = []
            for page_id, url, payload, keeper in pages:
                info, record = parse_arc(arc_description(ARC_FILE) + arc_record(page_id, url, payload))
                if not described:
                    out.append(convert(info))
                    described = True
                out.append(convert(record, None if keeper is None else record_id(ARC_FILE, str(keeper))))
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary()).view(pa.string())], names=["value"])


def write_archives(pages: DataFrame, path: str) -> None:
    """Write (page_id, url, html) as WARC files, copies of a payload as revisits."""
    ship(pages.sparkSession)
    payload = F.coalesce(F.col("html").cast("binary"), F.lit(b""))
    rows = pages.select("page_id", "url", payload.alias("payload"))
    rows = rows.withColumn("sum", F.sha1("payload")).withColumn("size", F.octet_length("payload"))
    copies = rows.where(f"size >= {LEAST_BYTES} and page_id is not null").groupBy("sum")
    copies = stage(copies.agg(F.max("page_id").alias("last"), F.count("*").alias("n")).where("n > 1").select("sum", "last"), "copies")
    size, n = rows.agg(F.sum("size"), F.count("*")).first()
    rows = rows.join(copies, "sum", "left")
    keeper = F.when((F.col("size") >= LEAST_BYTES) & (F.col("last") > F.col("page_id")), F.col("last"))
    records = rows.select("page_id", "url", "payload", keeper.alias("keeper")).mapInArrow(_archive, "value string")
    per_file = max(1, int(FILE_BYTES * (n or 1) / max(1, size or 1)))
    records.write.options(lineSep="\r\n\r\n", compression="gzip", maxRecordsPerFile=per_file).text(path)


def _contents(blob: bytes) -> bytes:
    """All gzip members of a file."""
    out = []
    while blob:
        member = zlib.decompressobj(31)
        out.append(member.decompress(blob) + member.flush())
        blob = member.unused_data
    return b"".join(out)


def _read(batches):
    names = ["page_id", "record_type", "record_id", "refers_id", "payload_bytes", "payload_digest"]
    for batch in batches:
        for blob in batch["content"]:
            out = {name: [] for name in names}
            for headers, block in parse_warc(_contents(blob.as_py())):
                if headers["warc-type"] not in ("response", "revisit"):
                    continue
                head, body = payload_of(block)
                http = {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in head.decode().split("\r\n"))}
                revisit = headers["warc-type"] == "revisit"
                stated = base64.b32decode(headers["warc-payload-digest"].removeprefix("sha1:")).hex()
                row = (
                    int(http["x-page-id"]) if http["x-page-id"] else None,
                    headers["warc-type"],
                    headers["warc-record-id"],
                    headers.get("warc-refers-to"),
                    int(http["content-length"]) if revisit else len(body),
                    stated if revisit else hashlib.sha1(body).hexdigest(),
                )
                for name, value in zip(names, row):
                    out[name].append(value)
            yield pa.RecordBatch.from_pydict(out, schema=READ_TYPE)


READ = "page_id bigint, record_type string, record_id string, refers_id string, payload_bytes bigint, payload_digest string"
READ_TYPE = pa.schema(
    [("page_id", pa.int64()), ("record_type", pa.string()), ("record_id", pa.string()), ("refers_id", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string())]
)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """One row per response or revisit record of the WARC files in a folder."""
    ship(spark)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("content")
    rows = stage(files.mapInArrow(_read, READ), "records")
    wanted = rows.where("refers_id is not null").select(F.col("refers_id").alias("record_id")).distinct()
    targets = rows.where("record_type = 'response'").select("record_id", "page_id").join(wanted, "record_id", "left_semi")
    targets = targets.groupBy("record_id").agg(F.max("page_id").alias("refers_to")).withColumnRenamed("record_id", "refers_id")
    return rows.join(targets, "refers_id", "left").select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "record_id"
    )


def op10_warc(spark: SparkSession, folder: str) -> DataFrame:
    path = shared_path(spark, "warc")
    write_archives(table(spark, folder, "pages"), path)
    return read_archives(spark, path).drop("record_id")


SQL = """
WITH p AS (
  SELECT page_id, encode(coalesce(html, '')) AS b FROM pages
), d AS (
  SELECT page_id, octet_length(b)::BIGINT AS payload_bytes, sha1(b) AS payload_digest FROM p
), k AS (
  SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS last_id FROM d
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND last_id > page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND last_id > page_id THEN last_id END AS refers_to
FROM k
"""
