"""WARC archives: write, index, resolve revisits, read.

Archives are ``.warc.gz`` files of one gzip member a record in a folder all machines share (any file system pyarrow can
open from its address). Each task writes files of its own under a temporary name and renames them, so a task that runs
again replaces what it wrote. Revisit resolution moves headers only: the index is grouped by payload digest, each group's
original is found by a partial aggregation, and the decisions go back to the archive they came from, which one task
copies record by record with fresh headers. No step holds more than one record in memory, and no group by digest is
ever gathered.

Defined cases: a null payload is empty; a null url gives ``urn:absent``; control characters and spaces in a url are
percent-encoded in the header; a null id has no Page-Id header and sorts first; repeated rows are records of their own
(of equal ids the one later in the archives is the original); an empty table gives empty archives and an empty result.
"""

from __future__ import annotations

import base64
import hashlib
import io
import re
import uuid
import zlib
from collections.abc import Iterator
from typing import BinaryIO

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._shared import attach, fresh_path, written

#: Uncompressed bytes after which a task starts another archive; record headers longer than this are refused.
ROLL, HEADER_MOST = 64 << 20, 1 << 20
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
INDEX = "file string, offset long, page_id long, url string, record_type string, payload_digest string, payload_bytes long, refers_to long"
_NAME = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")


def record_id(page_id: int | None, digest: str, url: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(_NAME, f'{page_id} {digest} {url}')}>"


def header_url(url: str | None) -> str:
    return "urn:absent" if url is None else re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)


def record(page_id: int | None, url: str | None, payload: bytes | None, digest: str, size: int, refers: tuple[int | None, str] | None = None, date: str = DATE) -> bytes:
    """A record as it stands in an archive before compression; with ``refers`` (id, url of the original) a revisit."""
    uri = header_url(url)
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = http if refers else http + (payload or b"")
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if refers else 'response'}",
        f"WARC-Record-ID: {record_id(page_id, digest, uri)}",
        f"WARC-Date: {date}",
        f"WARC-Target-URI: {uri}",
        f"WARC-Payload-Digest: sha1:{base64.b32encode(bytes.fromhex(digest)).decode()}",
        f"WARC-Block-Digest: sha1:{base64.b32encode(hashlib.sha1(block).digest()).decode()}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if page_id is not None:
        lines.append(f"Page-Id: {page_id}")
    if refers:
        to, to_url = refers
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {record_id(to, digest, header_url(to_url))}", f"WARC-Refers-To-Target-URI: {header_url(to_url)}", f"WARC-Refers-To-Date: {date}"]
        lines += [f"Refers-To-Page-Id: {to}"] if to is not None else []
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(data: bytes) -> tuple[dict[str, str], bytes, bytes]:
    """WARC headers (names in lower case), HTTP header block and payload of one uncompressed record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    if not head.startswith(b"WARC/1.") or len(head) > HEADER_MOST:
        raise ValueError("not a WARC record")
    headers = {}
    for line in head.decode("utf-8").split("\r\n")[1:]:
        name, _, value = line.partition(":")
        headers[name.strip().lower()] = value.strip()
    block = rest[: int(headers["content-length"])]
    if len(block) != int(headers["content-length"]):
        raise ValueError("record cut short")
    if headers.get("content-type", "").startswith("application/http"):
        http, cut, payload = block.partition(b"\r\n\r\n")
        return headers, http + cut, payload
    return headers, b"", block


def members(stream: BinaryIO, chunk: int = 1 << 20) -> Iterator[tuple[int, bytes]]:
    """Offset and content of each gzip member, one at a time."""
    at, held = 0, b""
    while held or (held := stream.read(chunk)):
        unzip, parts, used = zlib.decompressobj(31), [], 0
        while not unzip.eof:
            if not held and not (held := stream.read(chunk)):
                raise ValueError("archive cut short")
            parts.append(unzip.decompress(held))
            used += len(held) - len(unzip.unused_data)
            held = unzip.unused_data
        yield at, b"".join(parts)
        at += used


def file_system(address: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(address if "://" in address or address.startswith("file:") else f"file://{address}")


class _Writer:
    """Archives of one task: rolled by size, renamed when complete."""

    def __init__(self, folder: str, name: str):
        self.fs, self.path = file_system(folder)
        self.fs.create_dir(self.path, recursive=True)
        self.folder, self.name, self.files, self.size, self.out = folder, name, 0, 0, None

    def add(self, data: bytes) -> tuple[str, int]:
        if self.out is None:
            self.file = f"{self.name}-{self.files:05d}.warc.gz"
            self.temporary = f"{self.path}/.{self.file}.{uuid.uuid4().hex}"
            self.out, self.at, self.size = self.fs.open_output_stream(self.temporary, compression=None), 0, 0
        zipped = zlib.compressobj(1, zlib.DEFLATED, 31)
        packed = zipped.compress(data) + zipped.flush()
        self.out.write(packed)
        at, self.at, self.size = self.at, self.at + len(packed), self.size + len(data)
        file = f"{self.folder}/{self.file}"
        if self.size >= ROLL:
            self.close()
        return file, at

    def close(self) -> None:
        if self.out is not None:
            self.out.close()
            self.fs.move(self.temporary, f"{self.path}/{self.file}")
            self.out, self.files = None, self.files + 1


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    kinds = {"string": pa.string(), "long": pa.int64()}
    fields = [pa.field(n, kinds[k]) for n, k in (x.split() for x in INDEX.split(", "))]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), fields, strict=True)], schema=pa.schema(fields))


def write_archives(pages: DataFrame, folder: str, page_id: str = "page_id", url: str = "url", payload: str = "html") -> DataFrame:
    """Write a response record for each row; the table of their headers, which has been written when this returns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, rows = _Writer(folder, f"pages-{TaskContext.get().partitionId():06d}"), []
        for batch in batches:
            ids, urls, texts = (batch.column(i) for i in range(3))
            for k in range(batch.num_rows):
                body = texts[k].as_py() or b""
                i, u, digest = ids[k].as_py(), urls[k].as_py(), hashlib.sha1(body).hexdigest()
                file, at = out.add(record(i, u, body, digest, len(body)))
                rows.append((file, at, i, u, "response", digest, len(body), None))
                if len(rows) >= 4096:
                    yield _rows(rows)
                    rows = []
        out.close()
        if rows:
            yield _rows(rows)

    own = pages.select(F.col(page_id).cast("long"), F.col(url).cast("string"), F.col(payload).cast("binary"))
    return written(own.mapInArrow(run, INDEX), "warc-index")


def read_archives(spark: SparkSession, files: DataFrame, verify: bool = True, content: bool = False) -> DataFrame:
    """The records of the archives named by ``files`` (a table with the column ``file``), an archive a task.

    With ``verify`` the payload of each response is digested again and a difference is an error. ``content`` adds the
    column ``payload`` binary (null for revisits)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file in batch.column(0).to_pylist():
                fs, path = file_system(file)
                rows, bodies, size = [], [], 0
                with fs.open_input_stream(path, compression=None) as stream:
                    for at, data in members(stream):
                        h, http, body = parse(data)
                        digest = base64.b32decode(h["warc-payload-digest"].removeprefix("sha1:")).hex()
                        full = h["warc-type"] != "revisit"
                        if full and verify and hashlib.sha1(body).hexdigest() != digest:
                            raise ValueError(f"payload differs from its digest: {file} at {at}")
                        length = len(body) if full else int(re.search(rb"(?i)\r\ncontent-length:\s*(\d+)", http)[1])
                        rows.append((file, at, *(int(h[k]) if k in h else None for k in ("page-id",)), None if h["warc-target-uri"] == "urn:absent" else h["warc-target-uri"], h["warc-type"], digest, length, int(h["refers-to-page-id"]) if "refers-to-page-id" in h else None))
                        bodies.append(body if full else None)
                        size += len(body) * content
                        if len(rows) >= 4096 or size > 8 << 20:
                            yield _with(rows, bodies, content)
                            rows, bodies, size = [], [], 0
                if rows:
                    yield _with(rows, bodies, content)

    names = files.select("file").distinct()
    names = names.repartition(max(1, names.count()), "file")  # a few names, but each is an archive to read
    return names.mapInArrow(run, INDEX + (", payload binary" if content else ""))


def _with(rows: list[tuple], bodies: list[bytes | None], content: bool) -> pa.RecordBatch:
    batch = _rows(rows)
    return pa.RecordBatch.from_arrays([*batch.columns, pa.array(bodies, pa.binary())], [*batch.schema.names, "payload"]) if content else batch


def resolve_revisits(index: DataFrame, folder: str, least: int = 1000) -> DataFrame:
    """Write deduplicated archives of the records in ``index`` (of response records) to ``folder``; the table of files.

    Of the records of ``least`` payload bytes or more with equal payload digest and length, that with the largest page_id
    (then the last by file and offset) stays a response; the others become revisits that refer to it.
    """
    key = [F.col("payload_digest"), F.col("payload_bytes")]
    last = F.struct("page_id", "file", "offset", "url")
    groups = index.filter(F.col("payload_bytes") >= least).groupBy(*key).agg(F.max(last).alias("__last"), F.count("*").alias("__n"))
    name = F.concat_ws(":", *key)
    groups = written(groups.filter("__n > 1").select(name.alias("__name"), "__last"), "warc-last")
    decided = attach(index.withColumn("__name", name), groups, "__name")  # a digest that very many payloads share is dealt out
    same = (F.col("file") == F.col("__last.file")) & (F.col("offset") == F.col("__last.offset"))
    revisit = F.col("__last").isNotNull() & ~same
    decided = decided.select("file", "offset", revisit.alias("revisit"), F.when(revisit, F.col("__last.page_id")).alias("to_id"), F.when(revisit, F.col("__last.url")).alias("to_url"))

    def copy(group: pa.Table) -> pa.Table:
        file = group.column("file")[0].as_py()
        fate = {r["offset"]: r for r in group.select(["offset", "revisit", "to_id", "to_url"]).to_pylist()}
        fs, path = file_system(file)
        out, files = _Writer(folder, "resolved-" + path.rsplit("/", 1)[1].split(".")[0]), set()
        with fs.open_input_stream(path, compression=None) as stream:
            for at, data in members(stream):
                h, _, body = parse(data)
                r, digest = fate[at], base64.b32decode(h["warc-payload-digest"].removeprefix("sha1:")).hex()
                refers = (r["to_id"], r["to_url"]) if r["revisit"] else None
                url = None if h["warc-target-uri"] == "urn:absent" else h["warc-target-uri"]
                files.add(out.add(record(int(h["page-id"]) if "page-id" in h else None, url, body, digest, len(body), refers))[0])
        out.close()
        return pa.table({"file": pa.array(sorted(files), pa.string())})

    archives = index.select("file").distinct().count()
    return written(decided.repartition(max(1, archives), "file").groupBy("file").applyInArrow(copy, "file string"), "warc-files")


def archive_round_trip(pages: DataFrame, least: int = 1000, **columns: str) -> DataFrame:
    """Write a row's page as a record, read the archives back, resolve revisits into new archives, and read those."""
    spark = pages.sparkSession
    raw = write_archives(pages, fresh_path(spark, "warc-raw"), **columns)
    index = written(read_archives(spark, raw), "warc-read")
    return read_archives(spark, resolve_revisits(index, fresh_path(spark, "warc-resolved"), least))
