"""WARC archives as a chunked record table.

Writing: every Spark partition streams its rows as WARC/1.1 records into files
of its own in a shared folder, in slices, and returns a manifest row per
stretch of records.  Reading: each stretch is parsed as a stream into rows of
(record, chunk number, bytes), so a payload of any size passes through in
chunks of bounded size; every chunk row carries the digest of the payload so
far, the last one that of all of it.

A file counts only once its manifest row does: a task that failed or ran twice
leaves a file that no manifest names.  Archives are reached through
``pyarrow.fs`` from the folder's URI (local or mounted shared folders, HDFS,
object stores).
"""

from __future__ import annotations

import base64
import hashlib
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, new_dir, small

CHUNK = 1 << 16  # payload bytes of a chunk row
STRETCH = 8 << 20  # archive bytes of a manifest row, about
FILE = 256 << 20  # archive bytes after which a task starts another file
BROADCAST_ROWS = 200_000
_REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _filesystem(folder: str):
    return pafs.FileSystem.from_uri(folder if "://" in folder else f"file://{folder}"
                                    if folder.startswith("/") else folder)


def plan_records(pages: DataFrame, least_bytes: int = 1000, id_col: str = "page_id",
                 url_col: str = "url", payload_col: str = "html") -> DataFrame:
    """(id, url, payload, payload_bytes, digest, refers_to): which rows revisit which.

    Of rows with equal payloads of at least ``least_bytes`` the largest id is
    the response (``refers_to`` null), others refer to it.
    """
    payload = F.coalesce(F.col(payload_col), F.lit("")).cast("binary")
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"),
                        payload.alias("payload"))
    rows = rows.select("*", F.octet_length("payload").cast("long").alias("payload_bytes"),
                       F.sha1("payload").alias("digest"))
    same = (rows.filter(F.col("payload_bytes") >= least_bytes).groupBy("digest", "payload_bytes")
            .agg(F.max("id").alias("last"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n"))
    joined = rows.join(small(cut(same), BROADCAST_ROWS), ["digest", "payload_bytes"], "left")
    revisit = F.col("last").isNotNull() & ~F.col("id").eqNullSafe(F.col("last"))
    return joined.select("id", "url", "payload", "payload_bytes", "digest",
                         F.when(revisit, F.col("last")).alias("refers_to"))


def _head(fields: list[tuple[str, str | None]]) -> bytes:
    lines = [f"{k}: {v}".replace("\r", "%0D").replace("\n", "%0A") for k, v in fields if v is not None]
    return ("WARC/1.1\r\n" + "\r\n".join(lines) + "\r\n\r\n").encode("utf-8", "surrogatepass")


def write_archives(records: DataFrame, folder: str, date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """Write ``plan_records`` rows below ``folder``; a manifest of (file, start, size, records).

    Lazy: the files are written when the manifest is computed, so cut it
    before use.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = _filesystem(folder)
        fs.create_dir(root, recursive=True)
        partition = TaskContext.get().partitionId()
        out, name, size, start, n = None, "", 0, 0, 0
        done: list[tuple[str, int, int, int]] = []
        for batch in batches:
            columns = [batch.column(c) for c in ("id", "url", "payload", "payload_bytes", "digest", "refers_to")]
            for key, url, payload, length, digest, refers in zip(*columns):
                if out is None:
                    name = f"part-{partition:05d}-{uuid.uuid4().hex}.warc"
                    out, size, start, n = fs.open_output_stream(f"{root}/{name}"), 0, 0, 0
                key, refers = key.as_py(), refers.as_py()
                data = memoryview(payload.as_buffer())
                http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
                        f"Content-Length: {len(data)}\r\n\r\n").encode()
                body = b"" if refers is not None else data
                head = _head([
                    ("WARC-Type", "response" if refers is None else "revisit"),
                    ("WARC-Record-ID", f"<urn:page:{key}>" if key is not None else f"<{uuid.uuid4().urn}>"),
                    ("WARC-Date", date), ("WARC-Target-URI", url.as_py()),
                    ("WARC-Refers-To", None if refers is None else f"<urn:page:{refers}>"),
                    ("WARC-Profile", None if refers is None else _REVISIT),
                    ("WARC-Payload-Digest", "sha1:" + base64.b32encode(bytes.fromhex(digest.as_py())).decode()),
                    ("X-Page-Id", None if key is None else str(key)), ("X-Payload-Length", str(length.as_py())),
                    ("Content-Type", "application/http;msgtype=response"),
                    ("Content-Length", str(len(http) + len(body)))])
                out.write(head + http)
                for i in range(0, len(body), CHUNK):
                    out.write(body[i:i + CHUNK])
                out.write(b"\r\n\r\n")
                size, n = size + len(head) + len(http) + len(body) + 4, n + 1
                if size - start >= STRETCH:
                    done.append((name, start, size - start, n))
                    start, n = size, 0
                if size >= FILE:
                    out.close()
                    if n:
                        done.append((name, start, size - start, n))
                    out = None
        if out is not None:
            out.close()
            if n:
                done.append((name, start, size - start, n))
        columns = list(zip(*done)) or [(), (), (), ()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(columns[0], pa.string()), *[pa.array(c, pa.int64()) for c in columns[1:]]],
            names=["file", "start", "size", "records"])

    return records.mapInArrow(run, "file string, start long, size long, records long")


class _Stream:
    """Buffered forward reader of a stretch of a file."""

    def __init__(self, source, start: int, size: int):
        source.seek(start)
        self.source, self.left, self.buffer = source, size, b""

    def _fill(self) -> bool:
        take = min(CHUNK, self.left)
        got = self.source.read(take) if take else b""
        self.left -= len(got)
        self.buffer += got
        return bool(got)

    def head(self) -> list[str]:
        """Lines up to an empty one; none at the end of the stretch."""
        while (at := self.buffer.find(b"\r\n\r\n")) < 0:
            if not self._fill():
                if self.buffer:
                    raise ValueError("an archive ends inside a record's header")
                return []
        lines, self.buffer = self.buffer[:at], self.buffer[at + 4:]
        return lines.decode("utf-8", "surrogatepass").split("\r\n")

    def body(self, length: int) -> Iterator[bytes]:
        """``length`` bytes in chunks."""
        while length:
            if not self.buffer and not self._fill():
                raise ValueError("an archive ends inside a record's block")
            part, self.buffer = self.buffer[:min(length, CHUNK)], self.buffer[min(length, CHUNK):]
            length -= len(part)
            yield part

    def skip(self, size: int) -> int:
        return sum(map(len, self.body(size)))


def _fields(lines: list[str]) -> dict[str, str]:
    return dict(line.split(": ", 1) for line in lines[1:] if ": " in line)


CHUNK_ROWS = ("file string, place long, id string, url string, record_type string, refers_to string, "
              "declared_digest string, declared_bytes long, chunk_no long, data binary, "
              "bytes_so_far long, digest_so_far string, last boolean")


def read_chunks(manifest: DataFrame, folder: str) -> DataFrame:
    """The chunked record table: one row per chunk, at least one per record.

    ``place`` is the record's offset number in its stretch (with ``file`` and
    the stretch's start it names the record); ``digest_so_far`` is the SHA-1 of
    the payload up to and with this chunk.  A response whose bytes don't
    fit the declared digest or length fails the read.
    """
    names = [x.split()[0] for x in CHUNK_ROWS.split(", ")]
    types = [pa.string(), pa.int64(), *[pa.string()] * 5, pa.int64(), pa.int64(), pa.binary(), pa.int64(),
             pa.string(), pa.bool_()]

    def chunks(stream: _Stream, name: str, place: int) -> Iterator[tuple]:
        while lines := stream.head():
            head = _fields(lines)
            digest = base64.b32decode(head["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
            refers = head.get("WARC-Refers-To")
            fixed = (name, place, head.get("X-Page-Id"), head.get("WARC-Target-URI"), head["WARC-Type"],
                     refers and refers[len("<urn:page:"):-1], digest, int(head["X-Payload-Length"]))
            http = stream.head()
            length = int(head["Content-Length"]) - sum(len(x.encode()) + 2 for x in http) - 2
            sha, size, number = hashlib.sha1(), 0, 0
            for part in stream.body(length):
                sha.update(part)
                size += len(part)
                if size < length:
                    yield (*fixed, number, part, size, sha.hexdigest(), False)
                    number += 1
                else:
                    yield (*fixed, number, part, size, sha.hexdigest(), True)
            if not length:
                yield (*fixed, 0, b"", 0, sha.hexdigest(), True)
            if fixed[4] == "response" and (sha.hexdigest() != digest or size != fixed[7]):
                raise ValueError(f"record {fixed[2]} of {name} doesn't match its digest")
            stream.skip(4)
            place += 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = _filesystem(folder)

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

        for batch in batches:
            for row in batch.to_pylist():
                held, size = [], 0
                with fs.open_input_file(f"{root}/{row['file']}") as source:
                    # a record has at least 100 bytes: numbers from the start of its stretch are its own
                    for x in chunks(_Stream(source, row["start"], row["size"]), row["file"], row["start"]):
                        held.append(x)
                        size += len(x[9])
                        if size >= 4 << 20 or len(held) >= 2048:
                            yield batch_of(held)
                            held, size = [], 0
                if held:
                    yield batch_of(held)

    return manifest.mapInArrow(run, CHUNK_ROWS)


def archive(pages: DataFrame, folder: str | None = None, least_bytes: int = 1000,
            id_col: str = "page_id", url_col: str = "url", payload_col: str = "html") -> tuple[DataFrame, str]:
    """Write all rows of ``pages``; (manifest, folder).  The folder is kept.

    Null payloads count as empty; null urls have no target URI; null ids get a
    random record name and are responses unless an equal payload has an id;
    rows repeated with the largest id are all responses; other columns are
    ignored; an empty table gives an empty manifest.
    """
    spark = pages.sparkSession
    folder = folder or new_dir(spark, "warc")
    records = plan_records(pages, least_bytes, id_col, url_col, payload_col)
    return cut(write_archives(records, folder)), folder


def read_records(manifest: DataFrame, folder: str) -> DataFrame:
    """One row per record, put together from its chunk rows: id and refers_to as
    text, ``payload_bytes``, ``payload_digest``, ``record_type``."""
    tasks = max(1, min(manifest.count(), 4096))
    chunks = read_chunks(manifest.repartition(tasks, "file", "start"), folder)
    response = F.col("record_type") == "response"
    return (chunks.groupBy("file", "place", "id", "url", "record_type", "refers_to", "declared_digest",
                           "declared_bytes")
            .agg(F.sum(F.octet_length("data")).alias("n"), F.max_by("digest_so_far", "chunk_no").alias("d"))
            .select("id", "url", "record_type", "refers_to",
                    F.when(response, F.col("n")).otherwise(F.col("declared_bytes")).cast("long").alias("payload_bytes"),
                    F.when(response, F.col("d")).otherwise(F.col("declared_digest")).alias("payload_digest")))
