"""Operator 6: WARC writing and reading over a chunked record table.

Records never exist as one value.  A payload is a run of rows (record, chunk
number, bytes of at most ``chunk`` bytes); digests are carried from chunk to
chunk, the writer streams chunks into gzip members, and the reader streams an
archive back into chunk rows, so memory is a few chunks whatever a record's
size.

Writing: digests of all payloads (rows of equal digest are combined before the
shuffle; the smallest page_id of a digest is its response, others revisit it);
then chunk rows meet the heads of their records in one shuffle and go, sorted
within partitions by record and chunk, to one archive file for each partition.
A task leaves out chunks of payloads that it has seen under a smaller page_id,
so copies of a payload hardly move.  A page that is repeated any number of
times is revisited in blocks of ``BLOCK`` records, each dealt by itself.  A
task writes under a name of its own attempt and reports it as a row, so a
repeated or speculative task leaves no half archive in the result.

Defined results: a null html is the empty payload; repeated pages (equal id and
html) are separate records: the first is the response, the rest revisit it;
rows of equal id and different html are separate records; a null page_id is a
record without id, and is a response only if no row with an id has its payload;
an empty table writes no archive and gives no row; a payload of any length is
read and written chunk by chunk.  Only the three named columns are read, so other
columns of the pages can't clash.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillhouse.llm.common import partitions, ship, store
from tillhouse.session import scratch_path

CHUNK = 256 * 1024
BLOCK = 10_000      # revisits of one repeated page that one row stands for
SEEN = 200_000      # payloads a task remembers, to leave out their copies


def _file_system(path: str):
    """(file system, path in it): any store that pyarrow knows, or a mounted folder."""
    from pyarrow import fs
    if "://" in path or path.startswith("file:"):
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), path


def base32_sha1(digest) -> str:
    return base64.b32encode(digest.digest()).decode()


# ---- chunk table --------------------------------------------------------------
def _digest(data, chunk: int) -> str:
    d = hashlib.sha1()
    for at in range(0, len(data), chunk):
        d.update(data[at:at + chunk])
    return base32_sha1(d)


def _payloads(column: pa.Array):
    return (memoryview(x.as_buffer() or b"") for x in column)


def payload_digests(pages: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """(page_id, uri, payload_bytes, digest) of every row, digests taken chunk by chunk."""
    def work(batches):
        for batch in batches:
            found = [(len(x), _digest(x, chunk)) for x in _payloads(batch.column(2))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([n for n, _ in found], pa.int64()),
                                              pa.array([d for _, d in found], pa.string())],
                                             names=["page_id", "uri", "payload_bytes", "digest"])

    return pages.select("page_id", "uri", F.col("payload")).mapInArrow(
        work, "page_id long, uri string, payload_bytes long, digest string")


def payload_chunks(pages: DataFrame, chunk: int = CHUNK, candidates: bool = False) -> DataFrame:
    """(page_id, digest, chunk_no, data): the chunk rows of every payload; of
    ``candidates``, without those that the same task has under a smaller or
    equal page_id (they can't be responses)."""
    def work(batches):
        seen: dict[str, tuple] = {}
        for batch in batches:
            pages_ = batch.column(0).to_pylist()
            places = [(p is None, p or 0) for p in pages_]
            ids, digests, nos, data, held = [], [], [], [], 0
            for i in sorted(range(batch.num_rows), key=places.__getitem__) if candidates else range(batch.num_rows):
                raw = memoryview(batch.column(1)[i].as_buffer() or b"")
                digest = _digest(raw, chunk)
                if candidates:
                    if digest in seen and seen[digest] <= places[i]:
                        continue
                    if len(seen) >= SEEN:
                        seen.clear()
                    seen[digest] = places[i]
                for n, at in enumerate(range(0, max(len(raw), 1), chunk)):
                    ids.append(pages_[i])
                    digests.append(digest)
                    nos.append(n)
                    data.append(bytes(raw[at:at + chunk]))
                    held += len(data[-1])
                    if held > 16 << 20:
                        yield _chunk_rows(ids, digests, nos, data)
                        ids, digests, nos, data, held = [], [], [], [], 0
            if ids:
                yield _chunk_rows(ids, digests, nos, data)

    return pages.select("page_id", "payload").mapInArrow(work, "page_id long, digest string, chunk_no int, data binary")


def _chunk_rows(ids, digests, nos, data):
    return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(digests), pa.array(nos, pa.int32()), pa.array(data, pa.binary())],
                                      names=["page_id", "digest", "chunk_no", "data"])


# ---- records ------------------------------------------------------------------
def plan_records(digests: DataFrame) -> DataFrame:
    """(page_id, digest, payload_bytes, uri, n, low): n equal rows, and the
    smallest page_id ``low`` of the digest."""
    own = digests.groupBy("page_id", "digest").agg(F.first("payload_bytes").alias("payload_bytes"),
                                                   F.min("uri").alias("uri"), F.count("*").alias("n"))
    low = own.groupBy("digest").agg(F.min("page_id").alias("low"))
    return own.join(low, "digest").select("page_id", "digest", "payload_bytes", "uri", "n", "low")


def _header(kind: str, page_id, digest: str, uri, length: int, refers) -> bytes:
    record = uuid.uuid5(uuid.NAMESPACE_URL, f"{kind}/{page_id}/{digest}/{refers}")
    rows = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:uuid:{record}>", "WARC-Date: 2024-01-01T00:00:00Z",
            f"WARC-Target-URI: {(uri or 'urn:none').split(chr(10))[0].strip()}", f"WARC-Payload-Digest: sha1:{digest}",
            f"X-Page-ID: {'' if page_id is None else page_id}"]
    if kind == "revisit":
        rows += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                 f"X-Refers-To-Page-ID: {'' if refers is None else refers}"]
    rows += ["Content-Type: application/http;msgtype=response", f"Content-Length: {length}"]
    return ("\r\n".join(rows) + "\r\n\r\n").encode()


def _http(size: int) -> bytes:
    return f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()


def write_archives(records: DataFrame, chunks: DataFrame, folder: str) -> DataFrame:
    """Write ``.warc.gz`` files into ``folder``; returns a stored (path,
    n_records) manifest.  One shuffle brings a record's head and its chunks
    together; chunks of records that only revisit find no head and end there."""
    head = records.withColumn("response", F.col("page_id").eqNullSafe(F.col("low")))
    common = [F.col(c) for c in ("page_id", "digest", "uri", "payload_bytes")]
    nothing = F.lit(None).cast("binary").alias("data")
    # kind 0: head of a response, 1: a chunk, 2: ``no`` revisits
    first = head.where("response").select(*common, F.lit(None).cast("long").alias("refers"), F.lit(0).alias("kind"),
                                          F.lit(0).alias("no"), nothing, F.lit(0).cast("long").alias("block"))
    body = chunks.select("page_id", "digest", F.lit(None).cast("string").alias("uri"), F.lit(None).cast("long").alias("payload_bytes"),
                         F.lit(None).cast("long").alias("refers"), F.lit(1).alias("kind"), F.col("chunk_no").alias("no"), "data",
                         F.lit(0).cast("long").alias("block"))
    times = F.col("n") - F.col("response").cast("long")
    more = head.withColumn("times", times).where("times > 0").select(
        *common, F.col("low").alias("refers"), "times", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("times") - 1) / BLOCK))).alias("block"))
    more = more.select(*common, "refers", F.lit(2).alias("kind"), F.least(F.lit(BLOCK), F.col("times") - F.col("block") * BLOCK).cast("int").alias("no"),
                       nothing, "block")
    rows = first.unionByName(body).unionByName(more)
    rows = rows.repartition(partitions(records.sparkSession), F.xxhash64("page_id", "digest", "block")).sortWithinPartitions(
        "page_id", "digest", "block", "kind", "no")

    def work(batches):
        from pyspark import TaskContext
        c = TaskContext.get()
        system, base = _file_system(folder)
        system.create_dir(base, recursive=True)
        path = f"{base.rstrip('/')}/part-{c.partitionId():05d}-{c.taskAttemptId()}.warc.gz"
        count, current, after, member, out = 0, None, 0, None, None
        for batch in batches:
            for i, (page, digest, uri, size, refers, kind, no) in enumerate(zip(*[batch.column(k).to_pylist() for k in range(7)])):
                if kind == 1:
                    # of a response, and not a repeated row's chunk
                    if (page, digest) == current and no == after:
                        member.write(batch.column(7)[i].as_buffer())
                        after += 1
                    continue
                member, current = _close(member), None
                if out is None:
                    out = system.open_output_stream(path, compression=None)
                http = _http(size)
                if kind == 0:
                    member = gzip.GzipFile(fileobj=out, mode="wb", compresslevel=1, mtime=0)
                    member.write(_header("response", page, digest, uri, len(http) + size, None) + http)
                    count, current, after = count + 1, (page, digest), 0
                    continue
                for _ in range(no):                        # revisits: headers only
                    with gzip.GzipFile(fileobj=out, mode="wb", compresslevel=1, mtime=0) as g:
                        g.write(_header("revisit", page, digest, uri, len(http), refers) + http + b"\r\n\r\n")
                count += no
        _close(member)
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_arrays([pa.array([f"{folder.rstrip('/')}/{path.rsplit('/', 1)[1]}"]), pa.array([count], pa.int64())],
                                             names=["path", "n_records"])

    return store(rows.mapInArrow(work, "path string, n_records long"), "manifest")


def _close(member):
    if member is not None:
        member.write(b"\r\n\r\n")
        member.close()


# ---- reading --------------------------------------------------------------------
def _parse(stream: io.BufferedReader, chunk: int) -> Iterator[tuple]:
    """(headers, chunk number, data, size so far, digest so far or None) of an
    uncompressed WARC stream; the last row of a record carries its digest."""
    while line := stream.readline():
        if not line.strip():
            continue
        headers = {}
        while (line := stream.readline()).strip():
            k, _, v = line.decode().partition(":")
            headers[k.strip().lower()] = v.strip()
        left = int(headers["content-length"])
        while (line := stream.readline()).strip():          # the HTTP head
            left -= len(line)
            k, _, v = line.partition(b":")
            if k.lower() == b"content-length":
                headers["http-content-length"] = v.strip().decode()
        left -= len(line)
        d, no, size = hashlib.sha1(), 0, 0
        while True:
            data = stream.read(min(chunk, left))
            if left and not data:
                raise EOFError("a record ends early")
            left -= len(data)
            size += len(data)
            d.update(data)
            yield headers, no, data, size, base32_sha1(d) if not left else None
            no += 1
            if not left:
                break


def read_archives(manifest: DataFrame, with_data: bool = True, chunk: int = CHUNK) -> DataFrame:
    """Chunk rows of all records of the archives: page_id, record_type,
    refers_to, uri, header_digest, chunk_no, data (null unless ``with_data``),
    payload_bytes and payload_digest (on a record's last row; of the bytes
    read for responses, as stated by revisits, whose HTTP head has the full size)."""
    schema = ("page_id long, record_type string, refers_to long, uri string, header_digest string, chunk_no int, "
              "data binary, payload_bytes long, payload_digest string, last boolean")

    def work(batches):
        names = [x.split()[0] for x in schema.split(", ")]
        kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int32(), pa.binary(), pa.int64(), pa.string(), pa.bool_()]
        number = lambda x: int(x) if x else None

        def flush(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

        for batch in batches:
            for path in batch.column(0).to_pylist():
                system, inner = _file_system(path)
                with system.open_input_stream(inner, compression=None) as raw, gzip.GzipFile(fileobj=raw) as g:
                    rows, held = [], 0
                    for h, no, data, size, digest in _parse(io.BufferedReader(g, 1 << 20), chunk):
                        revisit = h["warc-type"] == "revisit"
                        stated = h["warc-payload-digest"].partition(":")[2]
                        rows.append((number(h.get("x-page-id")), h["warc-type"], number(h.get("x-refers-to-page-id")), h["warc-target-uri"],
                                     stated, no, data if with_data else None, int(h["http-content-length"]) if revisit else size,
                                     stated if revisit else digest, digest is not None))
                        held += len(data) if with_data else 100
                        if held > 8 << 20:
                            yield flush(rows)
                            rows, held = [], 0
                    if rows:
                        yield flush(rows)

    n = max(1, partitions(manifest.sparkSession))
    return manifest.select("path").repartition(n, "path").mapInArrow(work, schema)


def archive_pages(pages: DataFrame, folder: str | None = None, chunk: int = CHUNK) -> DataFrame:
    """Write ``pages`` (page_id, uri, payload) as archives, read them back:
    (page_id, payload_bytes, payload_digest, record_type, refers_to)."""
    spark: SparkSession = ship(pages.sparkSession)
    folder = folder or scratch_path(spark, f"llm-{uuid.uuid4().hex}/warc")
    records = store(plan_records(payload_digests(pages, chunk)), "records")
    manifest = write_archives(records, payload_chunks(pages, chunk, candidates=True), folder)
    return read_archives(manifest, with_data=False, chunk=chunk).where("last").select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to",
        (F.col("payload_digest") == F.col("header_digest")).alias("intact"))
