"""WARC archives: writer with identical-payload revisits, and a splittable reader.

Writer: one WARC/1.1 record per page, each in a gzip member of its own.  Of
pages with equal payloads the one with the largest page_id is stored as a
response, the others as revisits that refer to it and hold no payload.
Payloads smaller than ``min_bytes`` are always stored.

Reader: the files are cut into byte ranges.  A task scans its range for the gzip magic,
accepts a candidate when its first bytes decode to a WARC header, and then
reads member after member; it owns the records that start inside its range and
reads the last one past its end.  So one large archive is read by many tasks.

Scale: payloads are hashed where they are scanned; the hash decides through
a partial aggregate and one join, which AQE can split on a payload that many pages share.
Payloads cross the network once.  Tasks write one file each under a name of
their own, and only files in the manifest, which a task's row enters when its file is
closed, are read: a lost or repeated task leaves no duplicate.  Files are opened through
pyarrow's file systems, so the folder may be in any store that those know.

Edge cases: null html is an empty payload; null page_ids are the smallest and
come back null; rows that repeat the largest page_id of their payload are all
responses; an empty table gives no rows; other columns than page_id, url and
html are ignored, a missing url is written as ``about:blank``.
"""

from __future__ import annotations

import base64
import hashlib
import zlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoplake.session import shared_dir

from .common import stored

SPLIT_BYTES = 16 << 20
GZIP_LEVEL = 3
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MAGIC = b"\x1f\x8b\x08"
_CHUNK = 1 << 18
RECORD = "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint, target_uri string"


def _digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _record_id(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def _page_id(record_id: str | None) -> int | None:
    number = (record_id or "")[len("<urn:page:"):-1]
    return int(number) if number else None


def record_bytes(page_id, url, payload: bytes, refers_to=None, revisit: bool = False, digest: str | None = None,
                 length: int | None = None, level: int = GZIP_LEVEL, date: str = DATE) -> bytes:
    """One record as a gzip member.  A revisit takes digest and length of the payload it does not hold."""
    digest = digest or _digest(payload)
    length = len(payload) if length is None else length
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {length}\r\n\r\n".encode()
    block = http if revisit else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {_record_id(page_id)}",
            f"WARC-Date: {date}", f"WARC-Target-URI: {' '.join((url or 'about:blank').split())}",
            f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http; msgtype=response"]
    if revisit:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {_record_id(refers_to)}"]
    head.append(f"Content-Length: {len(block)}")
    gz = zlib.compressobj(level, zlib.DEFLATED, 31)
    data = gz.compress("\r\n".join(head).encode() + b"\r\n\r\n") + gz.compress(block) + gz.compress(b"\r\n\r\n")
    return data + gz.flush()


def _open(path: str):
    from pyarrow import fs
    return fs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")


def _writer(folder: str, level: int):
    """Arrow batches of pages -> manifest rows (file, bytes, records); one file per task."""
    def run(batches):
        import uuid
        import pyarrow as pa
        store, base = _open(folder)
        store.create_dir(base, recursive=True)
        name = f"{uuid.uuid4().hex}.warc.gz"
        out, size, count = None, 0, 0
        for batch in batches:
            for page_id, url, html, best, hexd, n, small in zip(*[batch.column(c).to_pylist() for c in (
                    "page_id", "url", "html", "best", "sha", "n", "small")]):
                out = out or store.open_output_stream(f"{base}/{name}", compression=None)
                revisit = not small and page_id != best
                digest = base64.b32encode(bytes.fromhex(hexd)).decode()
                data = record_bytes(page_id, url, b"" if revisit else html, best, revisit, digest, n, level)
                out.write(data)
                size += len(data)
                count += 1
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([size], pa.int64()), pa.array([count], pa.int64())],
                                             names=["file", "bytes", "records"])
    return run


def write_archives(pages: DataFrame, folder: str, min_bytes: int = 0, level: int = GZIP_LEVEL) -> DataFrame:
    """Write the pages; returns the stored manifest (file, bytes, records), one row per archive."""
    html = F.coalesce(F.col("html").cast("binary"), F.lit(b""))
    url = F.col("url") if "url" in pages.columns else F.lit(None).cast("string")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), url.alias("url"), html.alias("html"))
    hashed = rows.withColumn("sha", F.sha1("html")).withColumn("n", F.length("html").cast("long"))
    # an id next to the hash: page_ids may be null, and then the group has no best
    best = hashed.groupBy(F.col("sha").alias("_sha")).agg(F.max("page_id").alias("best"))
    decided = (hashed.join(best, F.col("sha") == F.col("_sha"))
               .select("page_id", "url", "html", "best", "sha", "n", (F.col("n") < min_bytes).alias("small")))
    return stored(decided.mapInArrow(_writer(folder, level), "file string, bytes bigint, records bigint"), "warc-manifest")


class _Source:
    """Forward reads of an open file from any offset, a chunk at a time."""

    def __init__(self, file, size: int):
        self.file, self.size = file, size

    def read(self, at: int, n: int) -> bytes:
        if at >= self.size:
            return b""
        self.file.seek(at)
        return self.file.read(min(n, self.size - at))


def _starts_record(src: _Source, at: int) -> bool:
    """Whether the bytes at ``at`` decode to the begin of a WARC header."""
    try:
        head = zlib.decompressobj(31).decompress(src.read(at, 512), 64)
    except zlib.error:
        return False
    return head.startswith(b"WARC/1.") and b"\r\n" in head


def _first_record(src: _Source, start: int, end: int) -> int | None:
    """Offset of the first record that starts in [start, end)."""
    at = start
    while at < end:
        block = src.read(at, _CHUNK + len(MAGIC) - 1)
        hit = block.find(MAGIC)
        while hit >= 0 and at + hit < end:
            if _starts_record(src, at + hit):
                return at + hit
            hit = block.find(MAGIC, hit + 1)
        at += _CHUNK
    return None


def _member(src: _Source, at: int) -> tuple[bytes, int]:
    """(content, offset after it) of the gzip member at ``at``."""
    gz = zlib.decompressobj(31)
    parts = []
    while not gz.eof:
        data = src.read(at, _CHUNK)
        if not data:
            raise EOFError("archive ends inside a record")
        parts.append(gz.decompress(data))
        at += len(data) - len(gz.unused_data)
    return b"".join(parts), at


def _headers(block: bytes) -> tuple[dict, bytes]:
    head, _, rest = block.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "replace").split("\r\n")[1:]
    return {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}, rest


def parse_record(content: bytes) -> tuple:
    """(page_id, payload bytes, digest, type, refers_to, uri); checks the digest of a stored payload."""
    warc, rest = _headers(content)
    http, payload = _headers(rest[:int(warc["content-length"])])
    said = warc["warc-payload-digest"].removeprefix("sha1:")
    kind, refers = warc["warc-type"], None
    length = int(http["content-length"])
    if kind == "revisit":
        refers = _page_id(warc["warc-refers-to"])
    elif _digest(payload) != said or len(payload) != length:
        raise ValueError(f"payload of {warc['warc-record-id']} does not match its digest")
    return _page_id(warc["warc-record-id"]), length, said, kind, refers, warc["warc-target-uri"]


def records_in_range(file, size: int, start: int, end: int):
    """Content of the records that start in [start, end) of an open archive."""
    src = _Source(file, size)
    at = _first_record(src, start, end)
    while at is not None and at < min(end, size):
        if src.read(at, len(MAGIC)) == MAGIC and _starts_record(src, at):
            content, at = _member(src, at)
            yield content
        else:                                  # padding or other bytes between members
            at = _first_record(src, at + 1, end)


def _reader(folder: str):
    def run(batches):
        import pyarrow as pa
        store, base = _open(folder)
        schema = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                            ("record_type", pa.string()), ("refers_to", pa.int64()), ("target_uri", pa.string())])
        for batch in batches:
            for name, size, start, end in zip(*[batch.column(c).to_pylist() for c in ("file", "bytes", "start", "end")]):
                with store.open_input_file(f"{base}/{name}") as f:
                    rows = [parse_record(c) for c in records_in_range(f, size, start, end)]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(x, t.type) for x, t in zip(zip(*rows), schema)], schema=schema)
    return run


def read_archives(manifest: DataFrame, folder: str, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """One row per record of the archives in ``manifest`` (file, bytes): see ``RECORD``."""
    splits = manifest.select("file", "bytes", F.explode(F.sequence(
        F.lit(0).cast("long"), F.greatest(F.col("bytes") - 1, F.lit(0)), F.lit(split_bytes).cast("long"))).alias("start"))
    splits = splits.withColumn("end", F.least(F.col("start") + split_bytes, F.col("bytes")))
    tasks = splits.count()                     # a number from the manifest: one task per byte range
    return splits.repartition(max(1, tasks)).mapInArrow(_reader(folder), RECORD)


def round_trip(pages: DataFrame, folder: str | None = None, min_bytes: int = 0, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """Write the pages to archives (a new folder of the shared directory by default) and read them back."""
    folder = folder or shared_dir(pages.sparkSession, "llm-warc")
    return read_archives(write_archives(pages, folder, min_bytes), folder, split_bytes)


def read_folder(spark: SparkSession, folder: str, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """Records of every ``.warc.gz`` file of a folder, also archives that others wrote."""
    from pyarrow import fs
    store, base = _open(folder)
    found = [(f.base_name, f.size) for f in store.get_file_info(fs.FileSelector(base)) if f.base_name.endswith(".warc.gz")]
    return read_archives(spark.createDataFrame(found, "file string, bytes bigint"), folder, split_bytes)
