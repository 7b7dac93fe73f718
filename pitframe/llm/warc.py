"""WARC archives written and read as tables of chunks.

A payload travels as rows (record, chunk number, at most ``CHUNK`` bytes). Spark cuts it before Python sees it, and every task keeps one
chunk and the running digests of one record in memory, whatever the record's length: hash states are updated chunk by chunk,
members of the archive are compressed and expanded as streams, and a record's rows stand one after another in their task, so no
record is grouped or put together anywhere.

Writing takes three steps. Digests of all payloads, as a slim table. The verdict: of records with one payload the one with the largest
page_id is the response, the others revisit it; the digest groups are reduced in the tasks (a maximum), so a hot payload is one row per task.
Then the payloads meet their verdict in a join on (page_id, payload identity), where a hot payload is spread over its pages, and go
straight into archives in the shared folder: a gzip member per record, as the format has it.

Archives are named by task attempt and listed in a manifest that Spark commits; what a lost attempt left behind is in no
manifest and is never read.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import uuid
import zlib
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from urllib.parse import quote, unquote

import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pitframe.llm.common import whole
from pitframe.sources.tables import materialise, scratch

CHUNK = 1 << 18
ARCHIVE = 1 << 28  # compressed bytes after which a task begins another archive
LEAST = 1000  # payloads with fewer bytes are never revisited
LEVEL = 4
BATCHES = "spark.sql.execution.arrow.maxBytesPerBatch"

DIGESTS = "page_id bigint, payload_bytes bigint, sha1 string, identity string"
MANIFEST = "path string, records bigint, bytes bigint"
CHUNKS = ("path string, record bigint, record_id string, page_id bigint, url string, record_type string, refers_to_record string, payload_bytes bigint, declared_digest string, "
          "chunk int, data binary, bytes_so_far bigint, digest_so_far string, last boolean")


@contextmanager
def bounded_batches(spark: SparkSession, size: str = "32m") -> Iterator[None]:
    """Batches handed to Python follow the bytes of the chunks, not their number, for the jobs that run inside."""
    before = spark.conf.get(BATCHES, None)
    spark.conf.set(BATCHES, size)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(BATCHES)
        else:
            spark.conf.set(BATCHES, before)


def chunk_rows(rows: DataFrame, payload: str = "payload", chunk: int = CHUNK) -> DataFrame:
    """Each row of ``rows`` once per chunk of its binary ``payload`` (once for an empty one), in order: chunk, last, data instead of it."""
    last = F.greatest(F.lit(0), F.ceil(F.octet_length(payload) / chunk).cast("int") - 1)
    others = [c for c in rows.columns if c != payload]
    return (rows.select("*", last.alias("_last")).select(*others, payload, "_last", F.explode(F.sequence(F.lit(0), F.col("_last"))).alias("chunk"))
            .select(*others, "chunk", (F.col("chunk") == F.col("_last")).alias("last"), F.substring(F.col(payload), F.col("chunk") * chunk + 1, F.lit(chunk)).alias("data")))


def _digest_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    size, sha1, sha256 = 0, hashlib.sha1(), hashlib.sha256()
    for batch in batches:
        done: list[tuple] = []
        data = batch.column("data")
        for i, (page_id, last) in enumerate(zip(batch.column("page_id").to_pylist(), batch.column("last").to_pylist())):
            piece = data[i].as_buffer()
            size += piece.size
            sha1.update(piece)
            sha256.update(piece)
            if last:
                done.append((page_id, size, sha1.hexdigest(), sha256.hexdigest()))
                size, sha1, sha256 = 0, hashlib.sha1(), hashlib.sha256()
        columns = list(zip(*done)) or [[]] * 4
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.string(), pa.string()))],
                                         ["page_id", "payload_bytes", "sha1", "identity"])


def payload_digests(pages: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """page_id, payload_bytes, sha1 and identity (SHA-256: what decides that two payloads are equal) of every row."""
    return chunk_rows(pages.select("page_id", _payload().alias("payload")), chunk=chunk).mapInArrow(_digest_batches, DIGESTS)


def _payload() -> Column:
    return whole(F.col("html")).cast("binary")


def verdicts(digests: DataFrame, least: int = LEAST) -> DataFrame:
    """One row per (page_id, identity): payload_bytes, sha1, response_id (null for a response)."""
    rows = digests.groupBy("page_id", "identity").agg(F.min("payload_bytes").alias("payload_bytes"), F.min("sha1").alias("sha1"))
    groups = (digests.where(F.col("payload_bytes") >= least).groupBy("identity").agg(F.max("page_id").alias("largest"), F.count("*").alias("n"))
              .where("n > 1 AND largest IS NOT NULL").select("identity", "largest"))
    response = F.when(~F.col("page_id").eqNullSafe(F.col("largest")), F.col("largest"))
    return rows.join(groups, "identity", "left").select("page_id", "identity", "payload_bytes", "sha1", response.alias("response_id"))


def record_id(page_id: int | None, identity: str) -> str:
    return f"urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}/{identity}')}"


def _heads(page_id: int | None, url: str | None, n: int, sha1: str, identity: str, response_id: int | None) -> bytes:
    """The record's own header, and the header of the response that it archived."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {n}\r\n\r\n".encode()
    block = len(http) + (n if response_id is None else 0)
    fields = [("WARC-Type", "response" if response_id is None else "revisit"), ("WARC-Record-ID", f"<{record_id(page_id, identity)}>"), ("WARC-Date", "1970-01-01T00:00:00Z")]
    if url is not None:
        fields.append(("WARC-Target-URI", quote(url, safe="!#$&'()*+,/:;=?@[]~")))
    if response_id is not None:
        fields += [("WARC-Refers-To", f"<{record_id(response_id, identity)}>"), ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")]
    if page_id is not None:
        fields.append(("X-Page-ID", str(page_id)))
    fields += [("WARC-Payload-Digest", "sha1:" + base64.b32encode(bytes.fromhex(sha1)).decode()), ("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(block))]
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields).encode() + b"\r\n" + http


def file_system(path: str) -> tuple[pyarrow.fs.FileSystem, str]:
    """The store of a path or URI, and the path inside of it."""
    if "://" in path or path.startswith("file:"):
        return pyarrow.fs.FileSystem.from_uri(path if "://" in path else "file://" + path.removeprefix("file:"))
    return pyarrow.fs.LocalFileSystem(), path


def _archive_batches(folder: str, limit: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        store, inside = file_system(folder)
        names = (f"{context.partitionId():06d}-{context.taskAttemptId()}-{k}.warc.gz" for k in range(1 << 62))
        out, name, member, records, done = None, "", None, 0, []

        def close() -> None:
            nonlocal out
            if out is not None:
                done.append((f"{folder}/{name}", records, out.tell()))
                out.close()
                out = None

        for batch in batches:
            data = batch.column("data")
            for i, row in enumerate(batch.drop_columns(["data"]).to_pylist()):
                if member is None:
                    if out is None:
                        store.create_dir(inside, recursive=True)
                        name, records = next(names), 0
                        out = store.open_output_stream(f"{inside}/{name}", compression=None)
                    member = zlib.compressobj(LEVEL, wbits=31)
                    out.write(member.compress(_heads(row["page_id"], row["url"], row["payload_bytes"], row["sha1"], row["identity"], row["response_id"])))
                out.write(member.compress(data[i].as_buffer()))
                if row["last"]:
                    out.write(member.compress(b"\r\n\r\n") + member.flush())
                    member, records = None, records + 1
                    if out.tell() >= limit:
                        close()
        close()
        yield pa.RecordBatch.from_pylist([dict(zip(("path", "records", "bytes"), d)) for d in done], pa.schema([("path", pa.string()), ("records", pa.int64()), ("bytes", pa.int64())]))

    return run


def write_archives(pages: DataFrame, folder: str | None = None, chunk: int = CHUNK, archive: int = ARCHIVE, least: int = LEAST) -> DataFrame:
    """Write a record per row of ``pages`` (page_id, url, html) and return the manifest: path, records, bytes of every archive.

    A null html is an empty payload, a null url leaves the target out. Rows that repeat a page_id with the same payload are written
    each, under one record identifier and with one verdict; a null page_id is never the one that others refer to. Columns other
    than these three are not read.
    """
    spark = pages.sparkSession
    folder = folder or scratch(spark, "archives")
    pages = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html")
    with bounded_batches(spark):
        told = materialise(verdicts(materialise(payload_digests(pages, chunk), "payload-digests"), least), "verdicts")
        told = told.select(F.col("page_id").alias("p"), F.col("identity").alias("d"), "payload_bytes", "sha1", "response_id")
        carried = pages.select("page_id", "url", _payload().alias("payload")).withColumn("identity", F.sha2("payload", 256))
        joined = carried.join(told, carried["page_id"].eqNullSafe(told["p"]) & (carried["identity"] == told["d"])).drop("p", "d")
        stored = joined.withColumn("payload", F.when(F.col("response_id").isNull(), F.col("payload")).otherwise(F.lit(b"")))
        return materialise(chunk_rows(stored, chunk=chunk).mapInArrow(_archive_batches(folder, archive), MANIFEST), "manifest")


def _header_lines(stream: io.BufferedIOBase) -> list[str]:
    """Lines up to the blank one."""
    lines = []
    while (line := stream.readline().rstrip(b"\r\n")):
        lines.append(line.decode("utf-8", "replace"))
    return lines


def _fields(lines: list[str]) -> dict[str, str]:
    return {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}


def records(stream: io.BufferedIOBase, chunk: int = CHUNK) -> Iterator[tuple[dict, dict, Iterator[bytes]]]:
    """Header fields, fields of the archived HTTP header (empty where there is none) and the payload in chunks, of each record of a
    decompressed archive. What is not read of a payload is skipped before the next record."""
    while True:
        line = stream.readline()
        while line in (b"\r\n", b"\n"):
            line = stream.readline()
        if not line:
            return
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no record starts with {line[:40]!r}")
        head = _fields(_header_lines(stream))
        left = int(head["content-length"])
        http: dict[str, str] = {}
        if head.get("content-type", "").startswith("application/http") and left:
            block = io.BytesIO()
            while left and (line := stream.readline(left)):
                left -= len(line)
                if line in (b"\r\n", b"\n"):
                    break
                block.write(line)
            block.seek(0)
            block.readline()
            http = _fields(_header_lines(block))

        def payload() -> Iterator[bytes]:
            nonlocal left
            while left:
                piece = stream.read(min(chunk, left))
                if not piece:
                    raise ValueError("the archive ends inside of a record")
                left -= len(piece)
                yield piece

        pieces = payload()
        yield head, http, pieces
        for _ in pieces:
            pass


def _opened(path: str) -> io.BufferedIOBase:
    store, inside = file_system(path)
    raw = io.BufferedReader(store.open_input_stream(inside, compression=None), 1 << 20)
    return io.BufferedReader(gzip.GzipFile(fileobj=raw), 1 << 20) if raw.peek(2)[:2] == b"\x1f\x8b" else raw


def _identifier(field: str | None) -> str | None:
    return field.strip("<>") if field else None


def _base16(digest: str | None) -> str | None:
    """Bare lower-case hex of a digest field."""
    kind, _, value = (digest or "").partition(":")
    if kind != "sha1" or not value:
        return None
    return base64.b32decode(value).hex() if len(value) == 32 else value.lower()


def _chunk_batches(chunk: int, payloads: bool) -> Callable:
    types = [pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int32(), pa.binary(), pa.int64(), pa.string(), pa.bool_()]
    names = [c.split()[0] for c in CHUNKS.split(", ")]

    def rows_of(path: str) -> Iterator[tuple]:
        with _opened(path) as stream:
            for number, (head, http, pieces) in enumerate(records(stream, chunk)):
                revisit = head.get("warc-type") == "revisit"
                stored = int(head["content-length"])
                url, page = head.get("warc-target-uri"), head.get("x-page-id")
                length = http.get("content-length")
                fixed = (path, number, _identifier(head.get("warc-record-id")), None if page is None else int(page), None if url is None else unquote(url),
                         head.get("warc-type"), _identifier(head.get("warc-refers-to")), int(length) if length is not None else stored, _base16(head.get("warc-payload-digest")))
                size, sha1 = 0, hashlib.sha1()
                held, at = next(pieces, b""), 0
                while True:
                    following = next(pieces, None)
                    size += len(held)
                    sha1.update(held)
                    # a revisit holds no payload, so it has no digest of its own
                    yield *fixed, at, held if payloads else None, size, None if revisit else sha1.hexdigest(), following is None
                    if following is None:
                        break
                    held, at = following, at + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("path").to_pylist():
                held, size = [], 0
                for row in rows_of(path):
                    held.append(row)
                    size += 500 + len(row[10] or b"")
                    if size > 16_000_000:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), types)], names)
                        held, size = [], 0
                if held:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), types)], names)

    return run


def read_archives(manifest: DataFrame, chunk: int = CHUNK, payloads: bool = True) -> DataFrame:
    """The chunk table of the archives under ``path`` of ``manifest``, compressed or not: a row per record and chunk with the bytes
    and digest up to and including it. Every archive is a stream in one task. With ``payloads=False`` data is null."""
    files = manifest.select("path")
    tasks = max(1, min(files.count(), 10_000))
    return files.repartitionByRange(tasks, "path").mapInArrow(_chunk_batches(chunk, payloads), CHUNKS)


def archived(manifest: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """One row per record: page_id, payload_bytes, payload_digest, record_type, refers_to, n_chunks, intact.

    A response's length and digest come from its bytes; ``intact`` tells whether they are those of its header. A revisit has those of its
    header and the page of the record that it refers to; it is intact if that record is in the archives with the same digest.
    """
    ends = materialise(read_archives(manifest, chunk, payloads=False).where("last"), "records")
    responses = (ends.where("record_type = 'response'").groupBy(F.col("record_id").alias("refers_to_record"))
                 .agg(F.max("page_id").alias("of_page"), F.max("digest_so_far").alias("of_digest")))
    again, n_chunks = F.col("record_type") == "revisit", (F.col("chunk") + 1).cast("long").alias("n_chunks")

    def intact(digest: str) -> Column:
        return F.coalesce(F.col("declared_digest") == F.col(digest), F.lit(False)).alias("intact")

    others = ends.where(~again).select("page_id", F.col("bytes_so_far").alias("payload_bytes"), F.col("digest_so_far").alias("payload_digest"), "record_type",
                                       F.lit(None).cast("long").alias("refers_to"), n_chunks, intact("digest_so_far"))
    revisits = ends.where(again).join(responses, "refers_to_record", "left").select(
        "page_id", "payload_bytes", F.col("declared_digest").alias("payload_digest"), "record_type", F.col("of_page").alias("refers_to"), n_chunks, intact("of_digest"))
    return others.unionByName(revisits)


def round_trip(pages: DataFrame, chunk: int = CHUNK, archive: int = ARCHIVE, least: int = LEAST) -> DataFrame:
    """Write ``pages`` to archives, read them back, and return what :func:`archived` finds in them. An empty table gives an empty result."""
    return archived(write_archives(pages, None, chunk, archive, least), chunk)


def oracle(least: int = LEAST, chunk: int = CHUNK) -> str:
    return f"""WITH p AS (SELECT page_id, coalesce(html, '') AS payload, strlen(coalesce(html, ''))::BIGINT AS n FROM pages),
  g AS (SELECT *, max(page_id) OVER (PARTITION BY payload) AS largest FROM p),
  t AS (SELECT *, n >= {least} AND page_id <> largest AS again FROM g)
SELECT page_id, n AS payload_bytes, sha1(payload) AS payload_digest, CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN again THEN largest END AS refers_to,
  CASE WHEN again THEN 1 ELSE greatest(1, ceil(n / {chunk}.0))::BIGINT END AS n_chunks, true AS intact
FROM t"""
