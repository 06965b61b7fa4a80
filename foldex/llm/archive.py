"""Legacy web archives: ARC files are parsed and written again as WARC records.

ARC version 1 and 2 differ in the fields of the line that heads a record; the first record of a file
(``filedesc``) declares the version and the field names. A record's length is declared, so contents
may hold anything. WARC records get an identifier made from the record's name, time and digest, a
type, a date and SHA-1 digests. Of records with equal payloads one is written as response and the
others as revisits of it. Archives are ordinary ``.warc.gz`` files of bounded numbers of records in
the shared folder, written and read by Spark.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import re
import uuid
from collections.abc import Iterator
from typing import BinaryIO

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foldex.llm.common import utf8, written
from foldex.session import scratch

FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
#: Bounds of an archive before compression: its bytes, unless one record alone has more, and its records.
BYTES_PER_FILE = 128 << 20
RECORDS_PER_FILE = 5_000


# --- ARC ---------------------------------------------------------------------------------------

def arc_file(records: list[tuple[str, str, str, bytes]], version: int) -> bytes:
    """An ARC file of (url, 14-digit date, content type, HTTP response) in version 1 or 2."""
    about = f"{version} 0 own\n{FIELDS[version]}\n".encode()
    out = [arc_line(version, "filedesc://own.arc", "19700101000000", "text/plain", len(about)), about, b"\n"]
    for url, date, kind, content in records:
        out += [arc_line(version, url, date, kind, len(content)), content, b"\n"]
    return b"".join(out)


def arc_line(version: int, url: str, date: str, kind: str, length: int) -> bytes:
    name = re.sub(r"\s", lambda m: "".join(f"%{b:02X}" for b in m[0].encode()), url) or "-"
    fields = [name, "0.0.0.0", date, kind] + ["200", "-", "-", "0", "own.arc"] * (version == 2) + [str(length)]
    return " ".join(fields).encode() + b"\n"


def parse_arc(data: bytes) -> Iterator[dict]:
    """The records of an ARC file: a value for each field its version has, and ``content``.

    The field names are those the file declares, or else its version's. Raises ValueError for a line
    that does not fit them and for contents shorter than declared.
    """
    names, at, begun = FIELDS[1].split(" "), 0, False
    while at < len(data):
        if data[at] in b"\r\n":
            at += 1
            continue
        end = data.find(b"\n", at)
        values = data[at:end if end >= 0 else len(data)].rstrip(b"\r").decode("utf-8", "replace").split(" ")
        # Only the first record heads a file: any other may have such a name.
        first, begun = not begun and values[0].startswith("filedesc:"), True
        own = next((f.split(" ") for f in FIELDS.values() if len(f.split(" ")) == len(values)), None) if first else names
        if own is None or len(values) != len(own) or not values[-1].isdigit() or end < 0:
            raise ValueError(f"not an ARC header at byte {at}")
        start, length = end + 1, int(values[-1])
        if start + length > len(data):
            raise ValueError(f"content at byte {start} ends before its declared {length} bytes")
        content, at = data[start:start + length], start + length
        if not first:
            yield dict(zip(own, values)) | {"content": content}
            continue
        lines = content.decode("utf-8", "replace").splitlines()
        version = int(lines[0].split(" ")[0]) if lines and lines[0][:1].isdigit() else 1
        names = lines[1].split(" ") if len(lines) > 1 else FIELDS[version].split(" ")


# --- WARC --------------------------------------------------------------------------------------

def payload_of(content: bytes) -> bytes:
    """What follows the HTTP headers; everything if there are none."""
    return content.partition(b"\r\n\r\n")[2] if content.startswith(b"HTTP/") else content


def sha1_base32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def warc_id(url: str, date: str, digest: str) -> str:
    """An identifier that a second conversion makes again."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{url} {date} {digest}')}>"


def warc_date(date: str) -> str:
    """14 digits (or fewer, then filled up) as an ISO time."""
    d = (date + "00000101000000"[len(date):])[:14] if date.isdigit() else "19700101000000"
    return f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:]}Z"


def warc_record(arc: dict, extra: dict[str, str], revisit_of: tuple[str, str] | None = None) -> bytes:
    """A WARC record for an ARC record. A revisit keeps the HTTP headers and names what it revisits."""
    content, payload = arc["content"], payload_of(arc["content"])
    digest = sha1_base32(payload)
    block = content[:len(content) - len(payload)] if revisit_of else content
    http = content.startswith(b"HTTP/")
    kind = "revisit" if revisit_of else "response" if http else "metadata" if arc["URL"].startswith("dns:") else "resource"
    head = {
        "WARC-Type": kind, "WARC-Target-URI": arc["URL"], "WARC-Date": warc_date(arc["Archive-date"]),
        "WARC-Record-ID": warc_id(arc["URL"], arc["Archive-date"], digest), "WARC-IP-Address": arc["IP-address"],
        "WARC-Payload-Digest": f"sha1:{digest}", "WARC-Block-Digest": f"sha1:{sha1_base32(block)}",
        "Content-Type": "application/http; msgtype=response" if http else arc["Content-type"],
        **extra, "Content-Length": str(len(block)),
    }
    if revisit_of:
        head["WARC-Profile"] = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
        head["WARC-Refers-To"], head["WARC-Refers-To-Target-URI"] = revisit_of
    lines = "".join(f"{k}: {v}\r\n" for k, v in head.items())
    return b"WARC/1.0\r\n" + lines.encode() + b"\r\n" + block + b"\r\n\r\n"


def parse_warc(stream: BinaryIO) -> Iterator[tuple[dict[str, str], bytes]]:
    """The records of a WARC file, one after another: header fields and block, by declared lengths."""
    while first := stream.readline():
        if not first.startswith(b"WARC/"):
            raise ValueError(f"not the first line of a WARC record: {first[:40]!r}")
        fields = {}
        while (line := stream.readline().rstrip(b"\r\n")):
            name, _, value = line.decode().partition(": ")
            fields[name] = value
        block = stream.read(int(fields["Content-Length"]))
        if stream.read(4) != b"\r\n\r\n":
            raise ValueError(f"{fields.get('WARC-Record-ID')}: the block does not end where its length says")
        yield fields, block


# --- Spark -------------------------------------------------------------------------------------

def http_response(html: bytes) -> bytes:
    return b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(html) + html


def page_date(page_id: int | None) -> str:
    """Pages have no time of their own; their number stands for seconds of the year 2000."""
    s = (page_id or 0) % 31_536_000
    day, s = divmod(s, 86_400)
    month, day = divmod(day, 28)
    return f"2000{month % 12 + 1:02d}{day + 1:02d}{s // 3600:02d}{s // 60 % 60:02d}{s % 60:02d}"


def page_url(url: bytes | None, page_id: int | None) -> str:
    return (url or b"").decode("utf-8", "replace") or f"urn:page:{page_id}"


def converted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pages as ARC files (in turn of version 1 and 2), and these as WARC records, one row each."""
    for n, whole in enumerate(batches):
        for start in range(0, max(1, whole.num_rows), 256):
            batch = whole.slice(start, 256)
            rows = batch.select(["page_id", "refers_to", "refers_url"]).to_pylist()
            rows = [r | {"url": page_url(u, r["page_id"])} for r, u in zip(rows, utf8(batch.column("url")))]
            records = [(r["url"], page_date(r["page_id"]), "text/html", http_response(h or b""))
                       for r, h in zip(rows, utf8(batch.column("html")))]
            out = []
            for row, arc in zip(rows, parse_arc(arc_file(records, 1 + (n + start // 256) % 2)), strict=True):
                extra = {"X-Page-ID": str(row["page_id"])} if row["page_id"] is not None else {}
                target = None
                if row["refers_to"] is not None:
                    extra["X-Refers-To-Page"] = str(row["refers_to"])
                    url, digest = page_url((row["refers_url"] or "").encode(), row["refers_to"]), sha1_base32(payload_of(arc["content"]))
                    target = (warc_id(re.sub(r"\s", lambda m: "".join(f"%{b:02X}" for b in m[0].encode()), url),
                                      page_date(row["refers_to"]), digest), url)
                extra["X-Payload-Length"] = str(len(payload_of(arc["content"])))
                out.append(warc_record(arc, extra, target))
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["record"])


def read_back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Page number, payload length and digest, type and reference of each record of WARC files."""
    kinds = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                       ("record_type", pa.string()), ("refers_to", pa.int64()), ("warc_id", pa.string()),
                       ("warc_date", pa.string()), ("target_uri", pa.string())])
    number = lambda text: int(text) if text is not None else None
    for batch in batches:
        for data in batch.column("content").to_pylist():
            stream = io.BytesIO(data)
            rows = []
            for fields, block in parse_warc(gzip.GzipFile(fileobj=stream) if data.startswith(b"\x1f\x8b") else stream):
                digest, size = fields["WARC-Payload-Digest"].partition(":")[2], int(fields["X-Payload-Length"])
                if fields["WARC-Type"] != "revisit" and (sha1_base32(payload_of(block)), len(payload_of(block))) != (digest, size):
                    raise ValueError(f"{fields['WARC-Record-ID']}: the payload is not what its header says")
                rows.append((number(fields.get("X-Page-ID")), size, digest, fields["WARC-Type"],
                             number(fields.get("X-Refers-To-Page")), fields["WARC-Record-ID"], fields["WARC-Date"],
                             fields["WARC-Target-URI"]))
            yield pa.RecordBatch.from_pylist([dict(zip(kinds.names, r)) for r in rows], schema=kinds)


def write_warc(pages: DataFrame, path: str, min_revisit_bytes: int = 0) -> None:
    """Writes ``pages`` (page_id, url, html) as WARC archives below ``path``.

    Of pages with equal payloads of at least ``min_revisit_bytes`` the one with the largest page_id
    (null last; of repeated rows all) is a response and the others are revisits.
    """
    html = F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html")
    rows = pages.select(F.col("page_id").cast("bigint"), F.col("url").cast("string"), html)
    size, digest = F.octet_length("html"), F.sha1(F.col("html").cast("binary"))
    keys = rows.select("page_id", "url", digest.alias("digest"), size.alias("size")).where(F.col("size") >= min_revisit_bytes)
    first = keys.groupBy("digest", "size").agg(
        F.max_by("url", "page_id").alias("refers_url"), F.max("page_id").alias("refers_to"), F.count(F.lit(1)).alias("n"))
    # Written first: a join of two shuffled sides can deal a hot digest to many tasks.
    shared = written(first.where("n > 1 and refers_to is not null").drop("n"), "payloads")
    linked = rows.withColumns({"digest": digest, "size": size}).join(shared, ["digest", "size"], "left")
    own = F.col("page_id") == F.col("refers_to")
    linked = linked.select("page_id", "url", "html", *[
        F.when(F.coalesce(own, F.lit(False)), None).otherwise(F.col(c)).alias(c) for c in ("refers_to", "refers_url")])
    # Pages are written by classes of size, each twice the last one's, so that a number of records bounds the bytes.
    least, longest = BYTES_PER_FILE // RECORDS_PER_FILE, F.octet_length("html") + 4 * F.coalesce(F.octet_length("url"), F.lit(0)) + 1024
    kind = F.greatest(F.ceil(F.log2(longest / least)), F.lit(0)).cast("int")
    kinds = sorted(r[0] for r in rows.select(kind.alias("kind")).distinct().collect()) or [0]
    for k in kinds:
        write_records(linked.where(kind == k) if len(kinds) > 1 else linked, path, max(1, RECORDS_PER_FILE >> k))


def write_records(linked: DataFrame, path: str, records_per_file: int) -> None:
    # A record ends with two line ends: the second is the writer's.
    records = linked.mapInArrow(converted, "record binary").select(
        F.substring("record", 1, F.octet_length("record") - 2).cast("string").alias("value"))
    records.write.mode("append").option("lineSep", "\r\n").option("compression", "gzip").option(
        "maxRecordsPerFile", records_per_file).text(path)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """One row per record of the archives below ``path``."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content")
    return files.mapInArrow(read_back, (
        "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long,"
        " warc_id string, warc_date string, target_uri string"))


def archived(pages: DataFrame) -> DataFrame:
    """Per page: page_id, payload_bytes, payload_digest, record_type and refers_to, read from archives just written.

    Null html is an empty payload; an empty table gives no rows. A page without number is a response
    if no numbered page shares its payload.
    """
    path = scratch(pages.sparkSession, "llm-warc")
    write_warc(pages, path)
    return read_warc(pages.sparkSession, path)
