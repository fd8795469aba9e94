"""Web archives: legacy ARC files read, and converted to WARC files with revisits.

ARC.  A file starts with a version block whose second line names the fields of the header
lines: version 1 has URL, IP, date, type and length, version 2 also result code, checksum,
location, offset and file name.  Each record is such a line and as many bytes as it declares.

WARC.  The converter synthesises what ARC lacks: record identifiers (name-based UUIDs of
file and record number), ISO timestamps, record types, and SHA-1 digests of block and
payload in base32.  Of the records with one payload, that of the smallest page becomes a
``response``; the others become ``revisit`` records that point to it and hold the HTTP
headers only.

Files are streamed, one task per file, record by record.  What is shuffled are digests and
numbers, never payloads: digests are first combined to one row each, and the converting
task reads its archive again beside the verdicts of that archive.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import uuid
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, open_store, scratch_path, steps

#: Payloads from this size on are looked up for revisits.
REVISIT_BYTES = 0
#: Fields of the header lines by version.
ARC_FIELDS = {
    1: ("URL", "IP-address", "Archive-date", "Content-type", "Archive-length"),
    2: ("URL", "IP-address", "Archive-date", "Content-type", "Result-code", "Checksum", "Location", "Offset", "Filename", "Archive-length"),
}
ARC_DATE = "20240101000000"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

_FILE = "part int, path string, records bigint"


class Record(NamedTuple):
    fields: dict[str, str]
    block: bytes


def digest(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _packed(data: bytes) -> bytes:
    """A gzip member of its own, without a time stamp."""
    return gzip.compress(data, 1, mtime=0)


def _writer(folder: str, kind: str):
    path = f"{folder}/{uuid.uuid4().hex}.{kind}.gz"  # a rerun of a task never meets a half file
    store, at = open_store(path)
    store.create_dir(at.rpartition("/")[0], recursive=True)
    return path, store.open_output_stream(at, compression=None)


def _reader(path: str):
    store, at = open_store(path)
    return gzip.GzipFile(fileobj=io.BufferedReader(store.open_input_stream(at, compression=None), 1 << 18))


def _file_rows(rows: list[tuple[int, str, int]]) -> pa.RecordBatch:
    kinds = (pa.int32(), pa.string(), pa.int64())
    return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows), kinds)], names=["part", "path", "records"])


def escape_url(url: str) -> str:
    """White space and control characters would break a header line."""
    return "".join(c if c > " " and c != "\x7f" and not c.isspace() else "".join(f"%{b:02X}" for b in c.encode()) for c in url)


def arc_line(version: int, **values: str) -> bytes:
    """A header line of the version; fields that are not given are a dash."""
    return (" ".join(values.get(x.replace("-", "_").lower()) or "-" for x in ARC_FIELDS[version]) + "\n").encode()


def write_arc(pages: DataFrame, folder: str, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Pages as HTTP responses in legacy archives; odd files are of version 2.  Returns the
    files.  The page's key travels as an HTTP header; a null key has none, a null url is
    ``urn:none``, a null page is empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, sink, count = TaskContext.get().partitionId(), None, 0
        version = 1 + part % 2
        for batch in steps(batches, 2):
            if sink is None:
                path, sink = _writer(folder, "arc")
                text = f"{version} 0 converter\n{' '.join(ARC_FIELDS[version])}\n\n".encode()
                sink.write(_packed(arc_line(
                    version, url=f"filedesc://{part}.arc", ip_address="0.0.0.0", archive_date=ARC_DATE, content_type="text/plain",
                    result_code="200", archive_length=str(len(text))) + text + b"\n"))
            for page, where, page_html in zip(*(batch.column(i).to_pylist() for i in range(3))):
                payload = (page_html or "").encode()
                own = "" if page is None else f"X-Page-Id: {page}\r\n"
                block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n{own}Content-Length: {len(payload)}\r\n\r\n".encode() + payload
                line = arc_line(
                    version, url=escape_url(where or "urn:none"), ip_address="0.0.0.0", archive_date=ARC_DATE, content_type="text/html",
                    result_code="200", checksum=digest(payload), filename=f"{part}.arc", archive_length=str(len(block)))
                sink.write(_packed(line + block + b"\n"))
                count += 1
        if sink is not None:
            sink.close()
            yield _file_rows([(part, path, count)])

    return pages.select(F.col(key).cast("bigint").alias("p"), url, html).mapInArrow(run, _FILE)


def read_arc(source) -> Iterator[Record]:
    """Records of an open archive after its version block; fields are those of its version.

    A URL may hold blanks in old files, so the other fields are taken from the right.
    """
    line = source.readline()
    head = source.read(int(line.rsplit(b" ", 1)[1]))
    names = head.split(b"\n")[1].decode().split()
    if tuple(names) not in ARC_FIELDS.values():
        raise ValueError(f"unknown archive version: {head[:200]!r}")
    while line := source.readline():
        if line == b"\n":
            continue
        values = line.decode("utf-8", "replace").rstrip("\n").rsplit(" ", len(names) - 1)
        if len(values) != len(names):
            raise ValueError(f"header line with {len(values)} fields: {line[:200]!r}")
        fields = dict(zip(names, values))
        size = int(fields["Archive-length"])
        block = source.read(size)
        if len(block) != size:
            raise ValueError(f"record of {size} bytes breaks off after {len(block)}")
        yield Record(fields, block)


def http_parts(block: bytes) -> tuple[bytes, dict[str, str], bytes]:
    """Head with its blank line, header fields in lower case, and payload."""
    end = block.find(b"\r\n\r\n")
    if not block.startswith(b"HTTP/") or end < 0:
        return b"", {}, block
    head = block[: end + 4]
    fields = dict(x.decode("latin-1").split(": ", 1) for x in head[:-4].split(b"\r\n")[1:] if b": " in x)
    return head, {k.lower(): v for k, v in fields.items()}, block[end + 4 :]


def iso_date(date: str) -> str:
    """ARC dates have up to 14 digits; what lacks is the earliest it can be."""
    digits = (date if date.isdigit() else ARC_DATE)[:14]
    digits += "00000101000000"[len(digits) :]
    return f"{digits[:4]}-{digits[4:6]}-{digits[6:8]}T{digits[8:10]}:{digits[10:12]}:{digits[12:14]}Z"


def record_id(path: str, number: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{path}#{number}')}>"


def _by_file(files: DataFrame) -> DataFrame:
    return files.repartitionByRange(max(1, files.count()), "part")


def scan_arc(files: DataFrame) -> DataFrame:
    """A light row per record: ``part, path, no, page_id, payload_bytes, payload_digest``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = (pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string())
        names = ["part", "path", "no", "page_id", "payload_bytes", "payload_digest"]
        for batch in batches:
            for file in batch.to_pylist():
                rows = []
                with _reader(file["path"]) as source:
                    for no, record in enumerate(read_arc(source)):
                        _, http, payload = http_parts(record.block)
                        page = http.get("x-page-id")
                        rows.append((file["part"], file["path"], no, None if page is None else int(page), len(payload), digest(payload)))
                        if len(rows) == 4096:
                            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows), kinds)], names=names)
                            rows = []
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows), kinds)], names=names)

    return _by_file(files).mapInArrow(run, "part int, path string, no bigint, page_id bigint, payload_bytes bigint, payload_digest string")


def with_originals(records: DataFrame, least: int = REVISIT_BYTES) -> DataFrame:
    """Adds ``original``: the record that a revisit points to, null for responses.

    The original is that of the smallest page (no key comes last), of equal ones the first
    in file order.  Digests are combined before the join, so a payload that very many
    records share is one row on that side.
    """
    place = F.struct(F.col("page_id").isNull().alias("z"), "page_id", "path", "no")
    first = records.where(F.col("payload_bytes") >= least).groupBy("payload_digest").agg(F.min(place).alias("original"), F.count("no").alias("n"))
    first = materialize(first.where("n > 1").select("payload_digest", "original"), "originals")
    joined = records.join(first, "payload_digest", "left")
    points = (F.col("payload_bytes") >= least) & F.col("original").isNotNull() & ~F.col("original").eqNullSafe(place)
    return joined.withColumn("original", F.when(points, F.col("original")))


def write_warc(records: DataFrame, files: int, folder: str) -> DataFrame:
    """Convert archives beside the verdicts on their records; returns the WARC files."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done, path, sink, source, records, at, count = [], None, None, None, None, -1, 0

        def close():
            if sink is not None:
                sink.close()
                source.close()
                done.append((part, warc, count))

        for batch in batches:
            for row in batch.to_pylist():
                if row["path"] != path:
                    close()
                    path, part, at, count = row["path"], row["part"], -1, 0
                    warc, sink = _writer(folder, "warc")
                    source = _reader(path)
                    records = read_arc(source)
                    info = b"software: converter\r\nformat: WARC File Format 1.1\r\n"
                    sink.write(_packed(warc_record("warcinfo", record_id(path, -1), iso_date(ARC_DATE), "application/warc-fields", info)))
                while at < row["no"]:
                    record = next(records)
                    at += 1
                sink.write(_packed(convert(record, path, row)))
                count += 1
        close()
        if done:
            yield _file_rows(done)

    light = records.select("part", "path", "no", "payload_digest", "original")
    return light.repartitionByRange(max(1, files), "part").sortWithinPartitions("part", "path", "no").mapInArrow(run, _FILE)


def warc_record(kind: str, own_id: str, date: str, content: str, block: bytes, **fields: str) -> bytes:
    head = {"WARC-Type": kind, "WARC-Record-ID": own_id, "WARC-Date": date}
    head |= {k.replace("_", "-"): v for k, v in fields.items()}
    head |= {"WARC-Block-Digest": f"sha1:{digest(block)}", "Content-Type": content, "Content-Length": str(len(block))}
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head.items()).encode() + b"\r\n" + block + b"\r\n\r\n"


def convert(record: Record, path: str, row: dict) -> bytes:
    """One ARC record as a WARC record."""
    head, http, _ = http_parts(record.block)
    url, date = record.fields["URL"], iso_date(record.fields["Archive-date"])
    fields = {"WARC_Target_URI": url, "WARC_IP_Address": record.fields["IP-address"], "WARC_Payload_Digest": f"sha1:{row['payload_digest']}"}
    if "x-page-id" in http:
        fields["WARC_Page_ID"] = http["x-page-id"]
    own_id = record_id(path, row["no"])
    if not head:  # not a web response: kept as it is
        return warc_record("resource", own_id, date, record.fields["Content-type"], record.block, **fields)
    content = "application/http;msgtype=response"
    original = row["original"]
    if original is None:
        return warc_record("response", own_id, date, content, record.block, **fields)
    fields |= {"WARC_Profile": REVISIT_PROFILE, "WARC_Refers_To": record_id(original["path"], original["no"])}
    if original["page_id"] is not None:
        fields["WARC_Refers_To_Page_ID"] = str(original["page_id"])
    return warc_record("revisit", own_id, date, content, head, **fields)


def read_warc(source) -> Iterator[Record]:
    """Records of an open WARC file."""
    while line := source.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no WARC record: {line[:80]!r}")
        fields = {}
        while (line := source.readline()).strip():
            name, value = line.decode().rstrip("\r\n").split(": ", 1)
            fields[name] = value
        yield Record(fields, source.read(int(fields["Content-Length"])))


def scan_warc(files: DataFrame) -> DataFrame:
    """Pages back from WARC files: ``page_id, payload_bytes, payload_digest, record_type,
    refers_to, record_id, target_uri``.  Block and payload digests are checked; a revisit's
    size is that its HTTP headers declare."""

    def row_of(record: Record) -> tuple:
        f = record.fields
        _, http, payload = http_parts(record.block)
        declared = f["WARC-Payload-Digest"].removeprefix("sha1:")
        revisit = f["WARC-Type"] == "revisit"
        if f["WARC-Block-Digest"] != f"sha1:{digest(record.block)}" or not revisit and declared != digest(payload):
            raise ValueError(f"wrong digest: {f['WARC-Record-ID']}")
        whole = lambda x: None if x is None else int(x)
        size = int(http["content-length"]) if revisit else len(payload)
        return (whole(f.get("WARC-Page-ID")), size, declared, f["WARC-Type"], whole(f.get("WARC-Refers-To-Page-ID")), f["WARC-Record-ID"], f["WARC-Target-URI"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string())
        names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "record_id", "target_uri"]
        batch_of = lambda rows: pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows), kinds)], names=names)
        for batch in batches:
            for path in batch.column("path").to_pylist():
                rows = []
                with _reader(path) as source:
                    for record in read_warc(source):
                        if record.fields["WARC-Type"] == "warcinfo":
                            continue
                        rows.append(row_of(record))
                        if len(rows) == 4096:
                            yield batch_of(rows)
                            rows = []
                if rows:
                    yield batch_of(rows)

    return _by_file(files).mapInArrow(run, "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint, record_id string, target_uri string")


def convert_archives(arcs: DataFrame, folder: str, least: int = REVISIT_BYTES) -> DataFrame:
    """WARC files for a list of ARC files (``part, path, records``)."""
    records = materialize(scan_arc(arcs), "arc-records")
    return materialize(write_warc(with_originals(records, least), arcs.count(), folder), "warc-files")


def pages_through_archives(pages: DataFrame, least: int = REVISIT_BYTES) -> DataFrame:
    """Pages to ARC, ARC to WARC, and read back.  An empty table gives no file and no row;
    repeated rows are records of their own; other columns are not read."""
    folder = scratch_path(pages.sparkSession, "archives")
    arcs = materialize(write_arc(pages, f"{folder}/arc"), "arc-files")
    return scan_warc(convert_archives(arcs, f"{folder}/warc", least))
