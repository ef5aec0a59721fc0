"""Legacy ARC archives to WARC, written as real archive files by Spark and read back.

An ARC file opens with a version block whose second line names the version and whose third names the fields of
every later header line; each record is a header line, the declared number of bytes and a line feed. The
converter takes frames shaped like Spark's ``binaryFile`` source (path, content), so an archive is one row.

WARC identifiers are UUIDs of the record's content (URL, date, sequence number, payload digest): a task that
runs again makes the same ones. Of equal payloads the first record in sequence is a response, the rest become
revisits that keep their HTTP header and name the response. Which one is first is decided on narrow rows;
payloads are shuffled once, by identifier, so a payload that many pages share does not meet in one task.

Records end in CR LF CR LF, which is given to the text writer as its line separator. So the files are plain
WARC, compressed as a whole, on whatever store the path names.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
import uuid
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scorepipe.llm import common
from scorepipe.session import work_path

SPACE = uuid.UUID("8f6f2c3a-52a2-5d0c-9a53-0f3b6f0f0b11")
SEQUENCE = b"x-page-id"
ARCHIVE_BYTES = 4 << 20
FILE_BYTES = 16 << 20
FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
"""Header fields of the two ARC versions."""
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
FETCHED = "20000101000000"


class ArcRecord(NamedTuple):
    header: dict[str, str]
    block: bytes


def digest(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def arc_line(version: int, url: str, ip: str, date: str, mime: str, length: int, status: str = "-", at: int = 0, name: str = "-") -> bytes:
    some = {"URL": url, "IP-address": ip, "Archive-date": date, "Content-type": mime, "Result-code": status, "Checksum": "-", "Location": "-", "Offset": str(at), "Filename": name, "Archive-length": str(length)}
    return (" ".join(some[f] for f in FIELDS[version].split(" ")) + "\n").encode()


def arc_bytes(name: str, version: int, records: list[tuple[str, bytes]], date: str = FETCHED) -> bytes:
    """One archive; records are (URL without white space, block)."""
    about = f"{version} 0 scorepipe\n{FIELDS[version]}\n\n".encode()
    out = [arc_line(version, f"filedesc://{name}", "0.0.0.0", date, "text/plain", len(about), "200", 0, name), about, b"\n"]
    at = sum(map(len, out))
    for url, block in records:
        head = arc_line(version, url, "0.0.0.0", date, "text/html", len(block), "200", at, name)
        out += [head, block, b"\n"]
        at += len(head) + len(block) + 1
    return b"".join(out)


def arc_records(content: bytes) -> Iterator[ArcRecord]:
    """Records of an archive, the version block first. Raises on lengths or field counts that don't fit."""
    at, fields, n = 0, FIELDS[1].split(" "), len(content)
    first = True
    while at < n:
        end = content.find(b"\n", at)
        if end < 0:
            raise ValueError("ARC header line without an end")
        line = content[at:end].rstrip(b"\r").decode("utf-8", "replace")
        if not line:  # some writers leave blank lines between records
            at = end + 1
            continue
        if first:
            length = int(line.rsplit(" ", 1)[1])
            about = content[end + 1 : end + 1 + length].decode("utf-8", "replace").split("\n")
            version = about[0].split(" ")[0]
            if version not in ("1", "2"):
                raise ValueError(f"ARC version {version!r}")
            fields = FIELDS[int(version)].split(" ")
            if len(about) > 1 and about[1].strip():
                fields = about[1].strip().split(" ")
        values = line.split(" ")
        if len(values) != len(fields):  # a URL may hold spaces: the other fields count from the end
            if len(values) < len(fields):
                raise ValueError(f"ARC header line with {len(values)} of {len(fields)} fields")
            extra = len(values) - len(fields)
            values = [" ".join(values[: extra + 1]), *values[extra + 1 :]]
        header = dict(zip(fields, values))
        length = int(header["Archive-length"])
        if end + 1 + length > n:
            raise ValueError("ARC record ends before its declared length")
        yield ArcRecord(header, content[end + 1 : end + 1 + length])
        at = end + 1 + length
        first = False


def http_parts(block: bytes) -> tuple[bytes, bytes]:
    """(header with its closing blank line, body); a block that is no HTTP message is all body."""
    if not block.startswith(b"HTTP/"):
        return b"", block
    m = re.search(rb"\r?\n\r?\n", block)
    return (block, b"") if not m else (block[: m.end()], block[m.end() :])


def http_field(header: bytes, name: bytes) -> str | None:
    m = re.search(rb"(?im)^" + re.escape(name) + rb":[ \t]*([^\r\n]*)", header)
    return m[1].decode("latin-1").strip() if m else None


def record_of(arc: ArcRecord) -> dict:
    """What the WARC record says, from the ARC header and block."""
    h = arc.header
    url, stamp = h["URL"], (h["Archive-date"] + "00000000000000")[:14]
    date = f"{stamp[:4]}-{stamp[4:6]}-{stamp[6:8]}T{stamp[8:10]}:{stamp[10:12]}:{stamp[12:14]}Z"
    head, body = http_parts(arc.block)
    kind = "warcinfo" if url.startswith("filedesc:") else "response" if head else "resource"
    sequence = http_field(head, SEQUENCE) if head else None
    name = digest(body)
    made = uuid.uuid5(SPACE, f"{url} {date} {sequence} {name}")
    return {
        "record_id": f"<urn:uuid:{made}>", "kind": kind, "url": url, "date": date, "ip": h["IP-address"], "mime": h["Content-type"],
        "sequence": int(sequence) if sequence and re.fullmatch(r"-?\d{1,19}", sequence) else None, "head": head, "body": body, "digest": name,
    }


def warc_bytes(r: dict, response: str | None) -> bytes:
    """One WARC record without the closing separator; a revisit of ``response`` when that is given."""
    block = r["head"] if response else r["head"] + r["body"]
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if response else r['kind']}", f"WARC-Record-ID: {r['record_id']}", f"WARC-Date: {r['date']}", f"WARC-Target-URI: {r['url']}"]
    if r["ip"] and r["ip"] != "0.0.0.0":
        lines.append(f"WARC-IP-Address: {r['ip']}")
    lines.append(f"WARC-Payload-Digest: sha1:{r['digest']}")
    lines.append(f"WARC-Block-Digest: sha1:{digest(block)}")
    if response:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {response}"]
    lines += [f"Content-Type: {'application/http; msgtype=response' if r['head'] else r['mime']}", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block


def warc_records(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header fields in lower case, block) of every record of a WARC file; block digests are checked."""
    at = 0
    while at < len(content):
        if content[at : at + 5] != b"WARC/":
            raise ValueError(f"no WARC record at byte {at}")
        end = content.index(b"\r\n\r\n", at)
        pairs = (line.split(": ", 1) for line in content[at:end].decode().split("\r\n")[1:])
        header = {k.lower(): v for k, v in pairs}
        block = content[end + 4 : end + 4 + int(header["content-length"])]
        if "warc-block-digest" in header and header["warc-block-digest"] != f"sha1:{digest(block)}":
            raise ValueError(f"block digest of {header['warc-record-id']} does not hold")
        yield header, block
        at = end + 4 + len(block) + 4


def parsed(arcs: DataFrame, bodies: bool) -> DataFrame:
    """(record_id, sequence, digest, size[, header line values, head, body]) of the records of archives."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                raw = content.as_py()
                if raw[:2] == b"\x1f\x8b":
                    raw = gzip.decompress(raw)
                found = [r for r in map(record_of, arc_records(raw)) if r["kind"] != "warcinfo"]
                for i in range(0, len(found), 512):
                    part = found[i : i + 512]
                    columns = {"record_id": [r["record_id"] for r in part], "sequence": pa.array([r["sequence"] for r in part], pa.int64()), "digest": [r["digest"] for r in part], "size": [len(r["body"]) for r in part]}
                    if bodies:
                        columns |= {k: [r[k] for r in part] for k in ("kind", "url", "date", "ip", "mime", "head", "body")}
                    yield pa.RecordBatch.from_pydict(columns)

    narrow = "record_id STRING, sequence BIGINT, digest STRING, size BIGINT"
    return arcs.select("content").mapInArrow(common.lean(work), narrow + (", kind STRING, url STRING, date STRING, ip STRING, mime STRING, head BINARY, body BINARY" if bodies else ""))


def arc_to_warc(arcs: DataFrame, path: str, least_bytes: int = 0, file_bytes: int = FILE_BYTES) -> None:
    """Write the records of ARC archives (column ``content``, plain or gzipped) as gzipped WARC files below ``path``.

    Of records with equal payloads of at least ``least_bytes`` the one with the smallest sequence number (then
    identifier; records without a number come last) stays whole and the rest become revisits. Equal records
    (same URL, date, number and payload) are one record that occurs several times: all stay whole or none.
    """
    narrow = common.settled(parsed(arcs, bodies=False))
    order = F.struct(F.col("sequence").isNull().alias("last"), "sequence", "record_id")
    first = narrow.filter(F.col("size") >= least_bytes).groupBy("digest", "size").agg(F.min(order).alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    refers = narrow.join(first, ["digest", "size"]).filter("record_id <> first.record_id").select("record_id", F.col("first.record_id").alias("response")).distinct()
    total = narrow.agg(F.sum("size")).first()[0] or 0
    files = max(1, -(-total // file_bytes))

    def serialise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        started = False
        for batch in batches:
            if not started:
                about = b"software: scorepipe\r\nformat: WARC File Format 1.1\r\n"
                lines = f"WARC/1.1\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: <urn:uuid:{uuid.uuid5(SPACE, f'part {part}')}>\r\nWARC-Date: 2000-01-01T00:00:00Z\r\nContent-Type: application/warc-fields\r\nContent-Length: {len(about)}\r\n\r\n"
                yield pa.RecordBatch.from_pydict({"record": pa.array([lines.encode() + about], pa.binary())})
                started = True
            for i in range(0, batch.num_rows, 256):
                rows = batch.slice(i, 256).to_pylist()
                yield pa.RecordBatch.from_pydict({"record": pa.array([warc_bytes(r, r["response"]) for r in rows], pa.binary())})

    whole = parsed(arcs, bodies=True).repartition(files, "record_id").join(refers, "record_id", "left")
    records = whole.mapInArrow(common.lean(serialise), "record BINARY")
    records.select(F.col("record").cast("string").alias("value")).write.option("lineSep", "\r\n\r\n").option("compression", "gzip").text(path)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """(record_id, record_type, url, refers_to_id, sequence, payload_bytes, payload_digest, payload) of all but warcinfo records.

    The size of a revisit's payload comes from its HTTP header; its payload is null. A digest that a response
    does not keep raises.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                raw = content.as_py()
                raw = gzip.decompress(raw) if raw[:2] == b"\x1f\x8b" else raw
                rows = []
                for header, block in warc_records(raw):
                    kind = header["warc-type"]
                    if kind == "warcinfo":
                        continue
                    head, body = http_parts(block)
                    named = header["warc-payload-digest"].split(":", 1)[1]
                    if kind != "revisit" and digest(body) != named:
                        raise ValueError(f"payload digest of {header['warc-record-id']} does not hold")
                    size = http_field(head, b"content-length") if kind == "revisit" else str(len(body))
                    sequence = http_field(head, SEQUENCE)
                    rows.append((header["warc-record-id"], kind, header.get("warc-target-uri"), header.get("warc-refers-to"), int(sequence) if sequence else None, int(size) if size else None, named, None if kind == "revisit" else body))
                for i in range(0, len(rows), 512):
                    columns = list(zip(*rows[i : i + 512]))
                    kinds = (pa.string(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary())
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["record_id", "record_type", "url", "refers_to_id", "sequence", "payload_bytes", "payload_digest", "payload"])

    schema = "record_id STRING, record_type STRING, url STRING, refers_to_id STRING, sequence BIGINT, payload_bytes BIGINT, payload_digest STRING, payload BINARY"
    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(common.lean(work), schema)


def pages_to_arc(pages: DataFrame, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """(path, content): the pages as ARC archives of about ``archive_bytes``, versions 1 and 2 in turn.

    A record's block is an HTTP response whose header carries the page id; a null html has an empty body, a
    null id no such field, a null URL stands as ``about:blank``. White space in a URL is percent-encoded.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, made = TaskContext.get().partitionId(), 0
        held, size = [], 0

        def archive():
            name = f"pages-{part:06d}-{made:06d}.arc"
            return pa.RecordBatch.from_pydict({"path": [name], "content": pa.array([arc_bytes(name, 1 + made % 2, held)], pa.binary())})

        for batch in batches:
            for page, url, html in zip(*(c.to_pylist() for c in batch.columns)):
                body = (html or "").encode()
                own = f"X-Page-Id: {page}\r\n" if page is not None else ""
                head = f"HTTP/1.1 200 OK\r\n{own}Content-Type: text/html; charset=utf-8\r\nContent-Length: {len(body)}\r\n\r\n".encode()
                plain = re.sub(r"\s", lambda m: "".join(f"%{b:02X}" for b in m[0].encode()), url or "") or "about:blank"
                held.append((plain, head + body))
                size += len(body)
                if size >= archive_bytes:
                    yield archive()
                    held, size, made = [], 0, made + 1
        if held:
            yield archive()

    return pages.select(F.col("page_id").cast("bigint"), F.col("url").cast("string"), F.col("html").cast("string")).mapInArrow(common.lean(work), "path STRING, content BINARY")


def archived_pages(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of every page, as the archives tell.

    Pages become ARC archives, these become WARC files in the shared folder, and the result is what reading the
    files back says. Null html is an empty payload. Rows that repeat a page are one record that occurs several
    times; rows that repeat an id with another payload are records of their own. Of equal payloads a null id
    comes after all others. Extra columns are ignored. An empty table gives no rows.
    """
    spark = pages.sparkSession
    path = work_path(spark, "warc")
    arc_to_warc(pages_to_arc(pages), path, least_bytes)
    records = read_warc(spark, path).drop("payload")
    whole = records.filter("record_type <> 'revisit'").select(F.col("record_id").alias("refers_to_id"), F.col("sequence").alias("refers_to")).distinct()
    joined = records.join(whole, "refers_to_id", "left")
    return joined.select(F.col("sequence").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to")
