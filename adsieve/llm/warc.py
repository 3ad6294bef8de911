"""WARC records in ZIP-packaged archives: writing, locating and range-reading.

*Write.* Every task packs its rows into archives of about ``ARCHIVE_BYTES``:
ZIP files whose members are stored uncompressed - ``archive/data.warc.gz``
(one gzip member per record) and ``indexes/index.cdxj`` (offset and length of
each record). Of equal payloads the row with the largest id is written as
response, the others as revisits without payload. An archive's name is new
with every attempt of a task, and only archives named in the stored manifest
count, so a lost executor leaves no half or doubled archive behind.

*Read.* Tasks parse the archives' central (or ZIP64) directories, take the
index member, and deal its entries into runs of about ``RUN_BYTES``; other
tasks read each run by range from the stored member and parse its records.
Nothing is extracted, and one archive is read by many tasks. The number of
tasks follows from the number of archives and from the bytes of the runs, not
from the size of the (tiny) entries.

Files are reached through pyarrow's file systems under the shared folder, with
the credentials of the executors' environment: ``file``, ``s3`` (also spelled
``s3a`` or ``s3n``), ``gs``, ``abfs(s)``, and ``hdfs`` where libhdfs is installed.

Defined results: a null html is an empty payload; empty payloads equal each
other. Rows without id are responses and name no one. Rows that repeat id and
payload are alike. A null url is left out of the record. Control characters in
a url are percent-encoded. Other columns are ignored.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import json
import re
import uuid
import zipfile
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adsieve.llm import zipread
from adsieve.llm.common import as_uri as _as_uri
from adsieve.llm.common import broadcast_if_small, partitions_for, shared_path, stored
from adsieve.llm.common import file_system as _open

ARCHIVE_BYTES = 16 << 20
RUN_BYTES = 1 << 20
LOCATE_ARCHIVES = 32  # directories parsed by one task
READ_BYTES = 32 << 20  # stored bytes read by one task
LEAST_REVISIT = 0  # bytes; smaller payloads are always responses
DATE = "1970-01-01T00:00:00Z"
DATA, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"
_RECORD = "archive string, offset long, record_type string, page_id long, url string, payload_bytes long, payload_digest string, refers_to long, payload binary"


def _uri(page_id: int) -> str:
    return f"<urn:page:{page_id}>"


def digest32(sha1: bytes) -> str:
    return base64.b32encode(sha1).decode()


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One WARC record, compressed as a gzip member of its own."""
    http = (_HTTP % len(payload)).encode()
    head = [
        "WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: {_uri(page_id) if page_id is not None else f'<urn:uuid:{uuid.uuid4()}>'}", f"WARC-Date: {DATE}"]
    if url is not None:
        head.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url))
    head.append(f"WARC-Payload-Digest: sha1:{digest}")
    if refers_to is not None:
        head += [f"WARC-Refers-To: {_uri(refers_to)}", f"WARC-Profile: {PROFILE}"]
        payload = b""
    block = http + payload
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    raw = "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"
    return gzip.compress(raw, 1, mtime=0)


def _fields(raw: bytes) -> dict[str, str]:
    out = {}
    for line in raw.split(b"\r\n")[1:]:
        name, _, value = line.partition(b":")
        out[name.decode().lower()] = value.strip().decode()
    return out


def _page(uri: str | None) -> int | None:
    m = re.fullmatch(r"<urn:page:(-?\d+)>", uri or "")
    return int(m[1]) if m else None


def parse(packed: bytes) -> dict:
    """Fields of one compressed record; a response's payload is hashed anew."""
    raw = zlib.decompress(packed, 31)
    head, _, rest = raw.partition(b"\r\n\r\n")
    if not head.startswith(b"WARC/"):
        raise ValueError("no WARC record")
    fields = _fields(head)
    block = rest[: int(fields["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    told = fields["warc-payload-digest"].removeprefix("sha1:")
    response = fields["warc-type"] == "response"
    if response and digest32(hashlib.sha1(payload).digest()) != told:
        raise ValueError(f"payload of {fields['warc-record-id']} differs from its digest")
    return {
        "record_type": fields["warc-type"], "page_id": _page(fields["warc-record-id"]), "url": fields.get("warc-target-uri"),
        "payload_bytes": len(payload) if response else int(_fields(http)["content-length"]), "payload_digest": told,
        "refers_to": _page(fields.get("warc-refers-to")), "payload": payload if response else None}


def _write_task(root: str, limit: int):
    def flush(data: io.BytesIO, index: list[str]) -> tuple[str, int]:
        name = f"{root}/{uuid.uuid4().hex}.zip"
        files, path = _open(name)
        files.create_dir(path.rsplit("/", 1)[0], recursive=True)
        with files.open_output_stream(path) as out, zipfile.ZipFile(out, "w", zipfile.ZIP_STORED) as z:
            z.writestr(DATA, data.getbuffer())
            z.writestr(INDEX, "".join(index))
        return name, len(index)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        data, index, done = io.BytesIO(), [], []
        for rb in batches:
            for page_id, url, payload, sha1, refers in zip(*(rb.column(c).to_pylist() for c in ("page_id", "url", "payload", "sha1", "refers_to"))):
                digest = digest32(bytes.fromhex(sha1))
                packed = record(page_id, url, payload, digest, refers)
                entry = {"url": url, "digest": f"sha1:{digest}", "offset": data.tell(), "length": len(packed), "filename": DATA}
                index.append(f"{_uri(page_id) if page_id is not None else '-'} {DATE} {json.dumps(entry)}\n")
                data.write(packed)
                if data.tell() >= limit:
                    done.append(flush(data, index))
                    data, index = io.BytesIO(), []
        if index:
            done.append(flush(data, index))
        yield pa.RecordBatch.from_pydict({"archive": pa.array([d[0] for d in done], pa.string()), "records": pa.array([d[1] for d in done], pa.int64())})
    return run


def write_archives(pages: DataFrame, least: int = LEAST_REVISIT, limit: int = ARCHIVE_BYTES) -> DataFrame:
    """Write ``pages (page_id, url, html)``; returns the stored manifest
    ``(archive, records)``."""
    spark = pages.sparkSession
    payload = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", payload.alias("payload"), F.sha1(payload).alias("sha1"))
    equal = stored(
        rows.where((F.octet_length("payload") >= least) & F.col("page_id").isNotNull()).groupBy("sha1")
        .agg(F.max("page_id").alias("kept"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"), "equal")
    marked = rows.join(broadcast_if_small(equal, equal.count(), 96), "sha1", "left")
    revisit = F.col("page_id").isNotNull() & (F.col("page_id") != F.col("kept"))
    if least:
        revisit = revisit & (F.octet_length("payload") >= least)
    root = _as_uri(shared_path(spark, "warc"))
    return stored(
        marked.select("page_id", "url", "payload", "sha1", F.when(revisit, F.col("kept")).alias("refers_to"))
        .mapInArrow(_write_task(root, limit), "archive string, records long"), "manifest")


def _reader(archive: str):
    files, path = _open(archive)
    handle = files.open_input_file(path)

    def read(offset: int, length: int) -> bytes:
        got = handle.read_at(length, offset)
        if len(got) != length:
            raise zipread.BadArchive(f"{archive} ends early")
        return got
    return read, handle


def _locate_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rb in batches:
        for archive in rb.column("archive").to_pylist():
            read, handle = _reader(archive)
            with handle:
                found = {m.name: m for m in zipread.members(read, handle.size())}
                at, index = zipread.stored_at(read, found[DATA]), found[INDEX]
                lines = read(zipread.stored_at(read, index), index.size).decode().splitlines()
            runs, lengths, size = [], [], 0
            for line in lines:
                entry = json.loads(line[line.index("{"):])
                if not lengths:
                    first = at + entry["offset"]
                lengths.append(entry["length"])
                size += entry["length"]
                if size >= RUN_BYTES:
                    runs.append((first, lengths))
                    lengths, size = [], 0
            if lengths:
                runs.append((first, lengths))
            yield pa.RecordBatch.from_pydict({"archive": pa.array([archive] * len(runs), pa.string()), "first": pa.array([r[0] for r in runs], pa.int64()),
                                              "lengths": pa.array([r[1] for r in runs], pa.list_(pa.int64()))})


def _read_task(payloads: bool):
    schema = pa.schema([("archive", pa.string()), ("offset", pa.int64()), ("record_type", pa.string()), ("page_id", pa.int64()), ("url", pa.string()),
                        ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in batches:
            for archive, first, lengths in zip(*(rb.column(c).to_pylist() for c in ("archive", "first", "lengths"))):
                read, handle = _reader(archive)
                with handle:
                    raw = read(first, sum(lengths))
                rows, at = [], 0
                for n in lengths:
                    got = parse(raw[at: at + n])
                    if not payloads:
                        got["payload"] = None
                    rows.append({"archive": archive, "offset": first + at, **got})
                    at += n
                yield pa.RecordBatch.from_pylist(rows, schema=schema)
    return run


def read_archives(manifest: DataFrame, payloads: bool = True) -> DataFrame:
    """Records of the archives named in ``manifest``: ``archive, offset,
    record_type, page_id, url, payload_bytes, payload_digest, refers_to,
    payload`` (null for revisits, or where not asked for)."""
    spark = manifest.sparkSession
    locate = partitions_for(spark, manifest.count(), LOCATE_ARCHIVES)
    runs = stored(manifest.select("archive").repartition(locate, "archive").mapInArrow(_locate_task, "archive string, first long, lengths array<long>"), "runs")
    size = F.aggregate("lengths", F.lit(0).cast("long"), lambda a, n: a + n)
    total = runs.agg(F.sum(size)).first()[0] or 0
    # counts given explicitly: entries are tiny, adaptive execution would merge them into one task
    return runs.repartition(partitions_for(spark, total, READ_BYTES), "archive", "first").mapInArrow(_read_task(payloads), _RECORD)
