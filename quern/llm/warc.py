"""WARC archives: write, normalise monolithic gzip, read back through a sidecar index.

Writers make one gzip stream for a whole file. The normaliser inflates each such stream once, in bounded memory, writes every record as a
gzip member of its own and leaves a sidecar index of offsets beside it; readers then fetch any record alone. Files get a temporary name
and are renamed when complete, so a task that runs again after an executor is lost leaves whole files only.
"""

from __future__ import annotations

import hashlib
import json
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.llm.common import cut, shared_dir, table

LEAST_PAYLOAD = 100  # bytes from which equal payloads become revisits
BROADCAST_ROWS = 200_000  # digests of repeated payloads sent whole to every task (about 20 MB); above, they are joined by shuffle
CHUNK = 1 << 18
#: Fixed values of the WARC 1.1 standard.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _open(uri: str):
    from pyarrow import fs

    if "://" not in uri and not uri.startswith("file:"):
        return fs.LocalFileSystem(), uri
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(uri)


def record_id(page_id: int | None) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page/{page_id}')}>"


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One WARC record: a response, or a revisit with the HTTP headers alone."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: {record_id(page_id)}", "WARC-Date: 1970-01-01T00:00:00Z"]
    if url:
        head.append("WARC-Target-URI: " + "".join(c if c > " " else f"%{ord(c):02X}" for c in url))
    head.append(f"WARC-Payload-Digest: sha256:{digest}")
    if page_id is not None:
        head.append(f"Page-ID: {page_id}")
    if refers_to is not None:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {record_id(refers_to)}", f"Refers-To-Page-ID: {refers_to}"]
    head += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def headers(head: bytes) -> dict[str, str]:
    return dict(line.split(": ", 1) for line in head.decode("utf-8", "replace").split("\r\n")[1:] if ": " in line)


class _Whole:
    """A file that appears under its name only when it is complete."""

    def __init__(self, uri: str):
        from pyspark import TaskContext

        self.fs, self.path = _open(uri)
        context = TaskContext.get()
        self.part = f"{self.path}.{context.taskAttemptId() if context else 0}.tmp"

    def __enter__(self):
        self.fs.create_dir(self.path.rpartition("/")[0], recursive=True)
        self.out = self.fs.open_output_stream(self.part, compression=None)
        return self.out

    def __exit__(self, kind, *_):
        self.out.close()
        if kind is None:
            self.fs.move(self.part, self.path)
        else:
            self.fs.delete_file(self.part)


def write_monolithic(records: DataFrame, folder: str) -> list[str]:
    """Write (page_id, url, payload, digest, refers_to) rows as one gzip stream a partition; returns the files' names."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        name, n = f"part-{TaskContext.get().partitionId():06d}.warc.gz", 0
        with _Whole(f"{folder}/whole/{name}") as out:
            deflate = zlib.compressobj(6, wbits=31)
            for batch in batches:
                for page_id, url, payload, digest, refers_to in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    out.write(deflate.compress(record(page_id, url, payload, digest, refers_to)))
                    n += 1
            out.write(deflate.flush())
        yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([n], pa.int64())], names=["file", "n"])

    made = records.select("page_id", "url", "payload", "digest", "refers_to").mapInArrow(run, "file string, n long")
    return sorted(r.file for r in made.collect() if r.n)  # one short row a partition


def records_of(stream) -> Iterator[bytes]:
    """The records of a gzip file, inflated once from start to end; memory holds one record and one chunk."""
    inflate, buffer = zlib.decompressobj(31), bytearray()
    while True:
        raw = stream.read(CHUNK)
        if not raw:
            break
        while raw:
            buffer += inflate.decompress(raw)
            raw = inflate.unused_data
            if inflate.eof:
                inflate = zlib.decompressobj(31)
        while (end := buffer.find(b"\r\n\r\n")) >= 0:
            size = end + 4 + int(headers(bytes(buffer[:end]))["Content-Length"]) + 4
            if len(buffer) < size:
                break
            yield bytes(buffer[:size])
            del buffer[:size]
    if buffer.strip():
        raise ValueError("the archive ends inside a record")


def normalise(spark, folder: str, files: list[str]) -> None:
    """Rewrite ``whole/`` files as one member a record under ``records/``, each with its sidecar index; one task a file."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name in batch.column(0).to_pylist():
                fs, path = _open(f"{folder}/whole/{name}")
                n = offset = 0
                with fs.open_input_stream(path, compression=None) as source, _Whole(f"{folder}/records/{name}") as out, _Whole(f"{folder}/records/{name}.idx") as index:
                    for whole in records_of(source):
                        deflate = zlib.compressobj(6, wbits=31)
                        member = deflate.compress(whole) + deflate.flush()
                        out.write(member)
                        head = headers(whole[: whole.find(b"\r\n\r\n")])
                        index.write(json.dumps({"offset": offset, "length": len(member), "id": head["WARC-Record-ID"], "type": head["WARC-Type"], "url": head.get("WARC-Target-URI")}).encode() + b"\n")
                        offset += len(member)
                        n += 1
                yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([n], pa.int64())], names=["file", "n"])

    _by_file(spark, files).mapInArrow(run, "file string, n long").collect()  # one short row a file


def _by_file(spark, files: list[str]) -> DataFrame:
    """The archives' names, one partition each."""
    return spark.createDataFrame([(f,) for f in files], "file string").repartitionByRange(max(1, len(files)), "file")


def read_indexed(spark, folder: str, files: list[str]) -> DataFrame:
    """Every record of the normalised archives, fetched member by member through the index."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name in batch.column(0).to_pylist():
                fs, path = _open(f"{folder}/records/{name}")
                rows = []
                with fs.open_input_stream(f"{path}.idx", compression=None) as index, fs.open_input_file(path) as source:
                    for entry in map(json.loads, index.read().splitlines()):
                        whole = zlib.decompress(source.read_at(entry["length"], entry["offset"]), 31)
                        at = whole.find(b"\r\n\r\n")
                        head, block = headers(whole[:at]), whole[at + 4 : -4]
                        http, _, payload = block.partition(b"\r\n\r\n")
                        digest, size = head["WARC-Payload-Digest"].removeprefix("sha256:"), int(headers(http)["Content-Length"])
                        if head["WARC-Type"] == "response" and (len(payload) != size or hashlib.sha256(payload).hexdigest() != digest):
                            raise ValueError(f"{head['WARC-Record-ID']} does not match its digest")
                        page, refers_to = head.get("Page-ID"), head.get("Refers-To-Page-ID")
                        rows.append((page and int(page), size, digest, head["WARC-Type"], refers_to and int(refers_to)))
                columns = zip(*rows, strict=True)
                kinds = pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"])

    return _by_file(spark, files).mapInArrow(run, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long")


def archive_pages(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> list[str]:
    """Write one record per row to monolithic archives under ``folder`` and normalise them; returns the archives' names.

    Rows with equal payloads of at least LEAST_PAYLOAD bytes: the smallest page_id is the response, the others revisit it. Rows that
    repeat that page_id are responses too. A null html is an empty payload; a null page_id is never the one revisited; a null or blank
    url is left out. An empty table writes no archive. Other columns are ignored. Digests meet in a map-side partial minimum, so a
    payload that a third of the rows share makes no large group.
    """
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.coalesce(F.col(html_col).cast("string"), F.lit("")).cast("binary").alias("payload"))
    rows = rows.withColumn("digest", F.sha2("payload", 256))
    large = rows.filter(F.octet_length("payload") >= LEAST_PAYLOAD).select("page_id", "digest")
    first = large.groupBy("digest").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1 AND first IS NOT NULL").select("digest", "first")
    first = cut(first)
    if first.count() <= BROADCAST_ROWS:
        first = F.broadcast(first)
    marked = rows.join(first, "digest", "left").withColumn("refers_to", F.when(F.coalesce(F.col("page_id"), F.lit(-1)) != F.col("first"), F.col("first")))
    marked = marked.withColumn("refers_to", F.when(F.octet_length("payload") >= LEAST_PAYLOAD, F.col("refers_to")))
    files = write_monolithic(marked, folder)
    normalise(pages.sparkSession, folder, files)
    return files


def op8_warc(spark, sf_dir: str) -> DataFrame:
    folder = f"{shared_dir(spark)}/warc-{uuid.uuid4().hex}"
    return read_indexed(spark, folder, archive_pages(table(spark, sf_dir, "pages"), folder))


ORACLE = """
    WITH p AS (SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS n, sha256(coalesce(html, '')) AS d FROM pages),
    f AS (SELECT d, min(page_id) AS first FROM p WHERE n >= 100 GROUP BY d)
    SELECT page_id, n AS payload_bytes, p.d AS payload_digest, CASE WHEN first IS NULL OR first = page_id THEN 'response' ELSE 'revisit' END AS record_type,
           CASE WHEN first <> page_id THEN first END AS refers_to
    FROM p LEFT JOIN f ON p.d = f.d AND n >= 100"""
