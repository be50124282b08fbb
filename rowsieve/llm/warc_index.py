"""WARC archives with a two-level capture index.

Layout of a folder:

* ``archive/`` – WARC 1.1 files, each record a gzip member of its own, so that a record
  can be read by its offset and length.
* ``index/`` – capture lines sorted by reversed-host URL key, in blocks of ``BLOCK_LINES``
  lines, each a gzip member.
* ``directory/`` – one row a block: its first and last key, file, offset and length. It is
  sparse, sorted, and pruned by its own statistics; a lookup searches it, then the lines
  of the blocks it names, and reads the ranges of the records found.

Of records with equal payloads of at least ``least_bytes``, the one with the largest page
id is a response; the others revisit it and are stored without the payload, with its
length in their HTTP header. Payloads are grouped by their digest, with partial
aggregation, so copies that hold a third of all rows meet in no single task.

Tasks write through the file system that the folder's URI names. A file's name holds the
attempt that wrote it, and only the names in the stored index count, so a repeated or
speculative attempt does no harm.

Null html is an empty payload, null URLs have an empty key and no target header. Rows
with a null page id revisit like others and are never revisited while another row of the
group has an id. Rows that repeat the largest page id of a group are all responses. An
empty table gives empty archives.
"""

from __future__ import annotations

import base64
import bisect
import hashlib
import math
import uuid
import zlib
from collections.abc import Iterable, Iterator
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowsieve.llm.common import stored, text_bytes

BLOCK_LINES = 256
# Bytes of records that one task reads back: the most, and the least where cores are idle.
MOST_READ, LEAST_READ = 128 << 20, 1 << 20
# Captures carry no time of their own in the table.
DATE = "1970-01-01T00:00:00Z"
_GZIP, _LEVEL = 31, 6
_PLAIN = "".join(map(chr, range(33, 127)))

_CAPTURES = "key string, page_id long, record_type string, file string, offset long, length long"
_BLOCKS = "first_key string, last_key string, file string, offset long, length long, lines long"


def digest(payload: bytes) -> str:
    """Bare upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def url_key(url: str | None) -> str:
    """``com,example,www)/path?query`` of a URL; without a host, the URL itself. Characters
    other than printable ASCII are percent-encoded."""
    head, mark, rest = quote(url or "", safe=_PLAIN).partition("://")
    if not mark:
        return head
    end = next((i for i, c in enumerate(rest) if c in "/?#"), len(rest))
    host = ",".join(reversed(rest[:end].lower().split(".")))
    return f"{host}){rest[end:].partition('#')[0] or '/'}"


def _open(path: str) -> tuple[pa.fs.FileSystem, str]:
    uri = path if "://" in path or path.startswith("file:") else f"file://{path}"
    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = "file://" + uri[len("file:") :]
    return pa.fs.FileSystem.from_uri(uri)


def _page_urn(page_id: int) -> str:
    return uuid.UUID(bytes=hashlib.sha1(f"page {page_id}".encode()).digest()[:16]).urn


def record(page_id: int | None, url: str | None, payload: bytes, hashed: str, refers_to: int | None) -> bytes:
    """One WARC record, a revisit if it refers to another page."""
    kind = "response" if refers_to is None else "revisit"
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    block = http.encode() + (payload if refers_to is None else b"")
    urn = _page_urn(page_id) if page_id is not None else uuid.UUID(bytes=hashlib.sha1(repr(url).encode() + hashed.encode()).digest()[:16]).urn
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <{urn}>", f"WARC-Date: {DATE}"]
    if url is not None:
        lines.append("WARC-Target-URI: " + quote(url, safe=_PLAIN))
    if page_id is not None:
        lines.append(f"Page-ID: {page_id}")
    lines.append(f"WARC-Payload-Digest: sha1:{hashed}")
    if refers_to is not None:
        lines.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        lines += [f"WARC-Refers-To: <{_page_urn(refers_to)}>", f"Refers-To-Page-ID: {refers_to}"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(data: bytes) -> tuple[dict[str, str], int, bytes]:
    """Headers, the payload's full length and the payload that the record holds."""
    head, _, rest = data.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    if not version.startswith("WARC/"):
        raise ValueError("not a WARC record")
    headers = dict(line.split(": ", 1) for line in lines)
    http, _, payload = rest[: int(headers["Content-Length"])].partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in http.decode().split("\r\n")[1:])
    return headers, int(fields["Content-Length"]), payload


def _packed(data: bytes) -> bytes:
    squeeze = zlib.compressobj(_LEVEL, zlib.DEFLATED, _GZIP)
    return squeeze.compress(data) + squeeze.flush()


class _File:
    """A file that one task attempt writes, opened at the first piece."""

    def __init__(self, folder: str, suffix: str):
        task = TaskContext.get()
        self.folder = folder
        self.name = f"part-{task.partitionId():05d}-{task.taskAttemptId()}{suffix}"
        self.stream, self.at = None, 0

    def add(self, data: bytes) -> tuple[int, int]:
        if self.stream is None:
            fs, path = _open(self.folder)
            fs.create_dir(path, recursive=True)
            self.stream = fs.open_output_stream(f"{path}/{self.name}", compression=None)
        packed = _packed(data)
        place = (self.at, len(packed))
        self.stream.write(packed)
        self.at += len(packed)
        return place

    def close(self) -> None:
        if self.stream is not None:
            self.stream.close()


def write_archive(pages: DataFrame, folder: str, least_bytes: int = 0, block_lines: int = BLOCK_LINES) -> None:
    """Write ``page_id, url, html`` as archives with their index. Other columns are ignored."""
    pages = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string"))
    known = stored(pages.select("page_id", "html").mapInArrow(_digests, "page_id long, digest string, size long"), "digests")
    groups = known.where(F.col("size") >= least_bytes).groupBy("digest").agg(
        F.max("page_id").alias("top"), F.count("*").alias("held")
    )
    groups = stored(groups.where("held > 1 AND top IS NOT NULL").select("digest", "top"), "copies")
    rows = pages.mapInArrow(_with_digest, "page_id long, url string, html string, digest string")
    rows = rows.join(groups, "digest", "left")
    other = F.when(~F.col("page_id").eqNullSafe(F.col("top")), F.col("top")).alias("refers_to")
    rows = rows.select("page_id", "url", "html", "digest", other)
    captures = stored(rows.mapInArrow(_record_writer(f"{folder}/archive"), _CAPTURES), "captures")
    lines = captures.repartitionByRange("key", "page_id").sortWithinPartitions("key", "page_id", "file", "offset")
    blocks = lines.mapInArrow(_block_writer(f"{folder}/index", block_lines), _BLOCKS)
    stored(blocks, "directory", f"{folder}/directory")


def _digests(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = text_bytes(batch.column("html"))
        columns = [batch.column("page_id"), pa.array([digest(t) for t in texts]), pa.array([len(t) for t in texts], pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, names=["page_id", "digest", "size"])


def _with_digest(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        hashed = pa.array([digest(t) for t in text_bytes(batch.column("html"))], pa.string())
        yield pa.RecordBatch.from_arrays([*batch.columns, hashed], names=["page_id", "url", "html", "digest"])


def _record_writer(folder: str):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = _File(folder, ".warc.gz")
        for batch in batches:
            rows: list[tuple] = []
            ids, urls, hashes, refers = (batch.column(c).to_pylist() for c in ("page_id", "url", "digest", "refers_to"))
            payloads = text_bytes(batch.column("html"))
            for page_id, url, payload, hashed, other in zip(ids, urls, payloads, hashes, refers, strict=True):
                offset, length = out.add(record(page_id, url, payload, hashed, other))
                rows.append((url_key(url), page_id, "response" if other is None else "revisit", out.name, offset, length))
            if rows:
                yield _rows(rows, ["key", "page_id", "record_type", "file", "offset", "length"], "slssll")
        out.close()

    return run


def _rows(rows: list[tuple], names: list[str], kinds: str) -> pa.RecordBatch:
    types = {"s": pa.string(), "l": pa.int64()}
    columns = [pa.array(c, types[k]) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
    return pa.RecordBatch.from_arrays(columns, names=names)


def _line(*fields) -> str:
    return "\t".join("-" if f is None else str(f) for f in fields)


def _block_writer(folder: str, block_lines: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = _File(folder, ".cdx.gz")
        held: list[tuple[str, str]] = []

        def flush() -> tuple:
            offset, length = out.add("".join(f"{line}\n" for _, line in held).encode())
            return held[0][0], held[-1][0], out.name, offset, length, len(held)

        done: list[tuple] = []
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                held.append((row[0], _line(*row)))
                if len(held) == block_lines:
                    done.append(flush())
                    held = []
        if held:
            done.append(flush())
        out.close()
        if done:
            yield _rows(done, ["first_key", "last_key", "file", "offset", "length", "lines"], "ssslll")

    return run


class _Reader:
    """Ranges of gzip members of the files of a folder."""

    def __init__(self, folder: str):
        self.fs, self.path = _open(folder)
        self.name, self.stream = None, None

    def get(self, name: str, offset: int, length: int) -> bytes:
        if name != self.name:
            self.name, self.stream = name, self.fs.open_input_file(f"{self.path}/{name}")
        return zlib.decompress(self.stream.read_at(length, offset), _GZIP)


def read_directory(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(_BLOCKS).parquet(f"{folder}/directory")


def read_index(spark: SparkSession, folder: str, blocks: DataFrame | None = None) -> DataFrame:
    """The capture lines of all blocks, or of those given."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = _Reader(f"{folder}/index")
        for batch in batches:
            for name, offset, length in zip(*(batch.column(c).to_pylist() for c in ("file", "offset", "length")), strict=True):
                lines = reader.get(name, offset, length).decode().splitlines()
                rows = [_fields(line) for line in lines]
                yield _rows(rows, ["key", "page_id", "record_type", "file", "offset", "length"], "slssll")

    blocks = read_directory(spark, folder) if blocks is None else blocks
    return blocks.select("file", "offset", "length").mapInArrow(run, _CAPTURES)


def _fields(line: str) -> tuple:
    key, page_id, kind, name, offset, length = line.split("\t")
    return key, None if page_id == "-" else int(page_id), kind, name, int(offset), int(length)


def _readers(places: DataFrame) -> int:
    """Tasks that read the archives: by the bytes of the records, as Spark splits files,
    since the few bytes of a place say nothing of the record there."""
    total = places.agg(F.sum("length")).first()[0] or 0
    share = math.ceil(total / places.sparkSession.sparkContext.defaultParallelism)
    return max(1, math.ceil(total / min(MOST_READ, max(LEAST_READ, share))))


def read_archive(spark: SparkSession, folder: str, captures: DataFrame | None = None) -> DataFrame:
    """``page_id, url, record_type, payload_bytes, payload_digest, refers_to, payload`` of
    the captures, read from the archives; all captures if none are given.

    The digest of a response is taken anew from its payload and must equal the recorded
    one.
    """
    captures = read_index(spark, folder) if captures is None else captures
    places = stored(captures.select("file", "offset", "length"), "places")
    # In the order of the files, so that each task reads a few of them from front to back.
    places = places.repartitionByRange(_readers(places), "file", "offset").sortWithinPartitions("file", "offset")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = _Reader(f"{folder}/archive")
        for batch in batches:
            rows = []
            for name, offset, length in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                headers, size, payload = parse(reader.get(name, offset, length))
                hashed = headers["WARC-Payload-Digest"].removeprefix("sha1:")
                if headers["WARC-Type"] == "response" and digest(payload) != hashed:
                    raise ValueError(f"payload of {headers['WARC-Record-ID']} does not have its digest")
                ids = [headers.get(k) for k in ("Page-ID", "Refers-To-Page-ID")]
                ids = [None if x is None else int(x) for x in ids]
                kept = payload.decode() if headers["WARC-Type"] == "response" else None
                rows.append((ids[0], headers.get("WARC-Target-URI"), headers["WARC-Type"], size, hashed, ids[1], kept))
            if rows:
                names = ["page_id", "url", "record_type", "payload_bytes", "payload_digest", "refers_to", "payload"]
                yield _rows(rows, names, "lsslsls")

    schema = "page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long, payload string"
    return places.mapInArrow(run, schema)


def lookup(spark: SparkSession, folder: str, url: str) -> list[tuple]:
    """Captures of one URL: ``key, page_id, record_type, file, offset, length``.

    The directory gives the blocks whose keys may include it; each is searched by halves.
    """
    key = url_key(url)
    blocks = read_directory(spark, folder).where((F.col("first_key") <= key) & (F.col("last_key") >= key))
    reader, found = _Reader(f"{folder}/index"), []
    for block in blocks.orderBy("first_key", "file", "offset").toLocalIterator():
        lines = [_fields(x) for x in reader.get(block["file"], block["offset"], block["length"]).decode().splitlines()]
        keys = [x[0] for x in lines]
        found += lines[bisect.bisect_left(keys, key) : bisect.bisect_right(keys, key)]
    return found
