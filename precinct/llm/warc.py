"""WARC archives through a chunked record table.

A payload is a sequence of rows (record, chunk number, data), each carrying
the digests and the size of the payload up to and including it; the last row
of a record has those of the whole. Spark cuts the payload column into slices,
and everything after works on these rows: digests run along a record's rows, the
writer compresses a record chunk by chunk as its rows come, the reader gives
chunk rows again while it decompresses. No task allocates a record besides the
cell of the source table that holds it.

Of records with equal payloads (SHA-256 and size) the one with the smallest
page_id becomes a response, the others revisit it. Archives are gzip files with a
member for each record, below the folder that ``spark.checkpoint.dir`` names,
written through Arrow's file systems (local, HDFS, S3, GCS, Azure by the folder's
scheme, Hadoop's names of schemes included). A task's files count only if its rows
reach the manifest, so a second attempt of a task does no harm. Archives are
read in ranges of whole members of about ``RANGE_BYTES``, each a task's work, so
neither the number of files nor their size bounds how many tasks read.

Cases: a null payload is empty. A null page_id orders after all others. Exact
repeats of a response (same page_id and payload) revisit it. An empty table
gives an empty result; other columns than page_id, url and the payload are not
read, a null url becomes ``urn:page:``.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from precinct.llm.arrow import Batches, arrow_schema, map_arrow, rows_of
from precinct.llm.scans import ranked
from precinct.llm.tables import row_id, written
from precinct.session import scratch_path

CHUNK_BYTES = 64 << 10
#: Bytes of an archive that one task reads, about.
RANGE_BYTES = 64 << 20
CHUNKS = "record bigint, chunk int, data binary, bytes bigint, sha1 string, sha256 string, last boolean"
MANIFEST = "record bigint, file string, start bigint, stop bigint"
FOUND = (
    "page_id bigint, chunk int, data binary, bytes bigint, sha1 string, last boolean, "
    "record_type string, refers_to bigint, record_id string, url string"
)
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
# Fixed value: the profile of revisits by payload digest.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def base32(digest: bytes) -> str:
    return base64.b32encode(digest).decode()


def chunked(rows: DataFrame, size: int = CHUNK_BYTES) -> DataFrame:
    """Chunk rows of ``rows`` (record, payload string); a payload of no bytes
    has one empty chunk. Slices of a record follow one another in its task."""
    fields = arrow_schema(CHUNKS)
    data = F.coalesce(F.col("payload"), F.lit("")).cast("binary").alias("data")
    last = F.greatest(F.lit(0), F.ceil(F.octet_length("data") / size).cast("int") - 1)
    slices = (
        rows.select("record", data)
        .select("record", "data", last.alias("end"), F.explode(F.sequence(F.lit(0), last)).alias("chunk"))
        .select("record", "chunk", (F.col("chunk") == F.col("end")).alias("last"), F.substr("data", F.col("chunk") * size + 1, F.lit(size)).alias("data"))
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = Batches(fields)
        for record, chunk, last, piece in rows_of(batches, 16):
            if chunk == 0:
                short, long, seen = hashlib.sha1(), hashlib.sha256(), 0
            short.update(piece)
            long.update(piece)
            seen += len(piece)
            yield from out.add((record, chunk, piece, seen, base32(short.digest()), long.hexdigest(), last), len(piece))
        yield from out.flush()

    return map_arrow(slices, run, CHUNKS)


def arrow_uri(uri: str) -> str:
    """A folder's URI under the scheme that Arrow knows it by. Hadoop also
    writes file:/x for file:///x, and s3a, abfss, wasbs and the like for stores."""
    scheme, colon, rest = uri.partition(":")
    if not colon or "/" in scheme:
        return uri  # a plain path
    if scheme == "file":
        return "file:///" + rest.lstrip("/")
    known = {"s3a": "s3", "s3n": "s3", "gs": "gs", "abfs": "abfs", "abfss": "abfss", "wasb": "abfs", "wasbs": "abfss"}
    return f"{known.get(scheme, scheme)}:{rest}"


def _file_system(uri: str) -> tuple[fs.FileSystem, str]:
    try:
        return fs.FileSystem.from_uri(arrow_uri(uri))
    except (pa.ArrowInvalid, pa.ArrowNotImplementedError) as fault:
        raise ValueError(f"archives cannot be written below {uri}: name a folder of a store that Arrow reaches in spark.checkpoint.dir") from fault


def record_id(record: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'record:{record}')}>"


def _header(kind: str, record: int, page_id: int | None, url: str | None, sha1: str, size: int, first: tuple) -> bytes:
    """``first``: record and page_id of the response that a revisit names."""
    target = "".join(c if c > " " else f"%{ord(c):02X}" for c in url or f"urn:page:{page_id}")
    lines = [
        "WARC/1.1",
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: {record_id(record)}",
        f"WARC-Target-URI: {target}",
        "WARC-Date: 1970-01-01T00:00:00Z",
        f"WARC-Payload-Digest: sha1:{sha1}",
        f"WARC-Payload-Length: {size}",
        f"WARC-Page-ID: {'' if page_id is None else page_id}",
    ]
    if kind == "revisit":
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {record_id(first[0])}"]
        lines += [f"WARC-Refers-To-Page-ID: {'' if first[1] is None else first[1]}"]
    body = len(HTTP) + (size if kind == "response" else 0)
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {body}", "", ""]
    return "\r\n".join(lines).encode()


def write(
    pages: DataFrame, key: str = "page_id", payload: str = "html", least: int = 0, size: int = CHUNK_BYTES
) -> DataFrame:
    """Write an archive record for each row; the manifest (record, file, start
    and stop of its gzip member). Payloads below ``least`` bytes are always
    responses. ``pages`` must give its rows in the same order when read again."""
    spark = pages.sparkSession
    url = F.col("url").cast("string") if "url" in pages.columns else F.lit(None).cast("string")
    source = pages.select(
        row_id(pages).alias("record"),
        F.col(key).cast("bigint").alias("page_id"),
        url.alias("url"),
        F.col(payload).cast("string").alias("payload"),
    )
    chunks = chunked(source.select("record", "payload"), size)
    whole = written(chunks.where("last").select("record", "bytes", "sha1", "sha256"), "payloads")
    names = source.select("record", "page_id", "url")
    heads = written(whole.join(names, "record"), "records")
    order = F.struct(F.col("page_id").isNull().alias("none"), "page_id", "record")
    firsts = heads.where(F.col("bytes") >= least).groupBy("sha256", "bytes").agg(F.min(order).alias("first"))
    typed = heads.join(firsts, ["sha256", "bytes"], "left").select(
        "record",
        F.lit(-1).alias("chunk"),
        F.lit(None).cast("binary").alias("data"),
        F.struct("page_id", "url", "sha1", "bytes").alias("head"),
        F.coalesce(F.col("first.record"), F.col("record")).alias("first"),
        F.col("first.page_id").alias("first_page"),
    )
    # A record's head sorts before its chunks, so it reaches the writer first.
    body = chunks.select(
        "record",
        "chunk",
        "data",
        F.lit(None).cast("struct<page_id:bigint,url:string,sha1:string,bytes:bigint>").alias("head"),
        F.lit(None).cast("bigint").alias("first"),
        F.lit(None).cast("bigint").alias("first_page"),
    )
    ordered = typed.unionByName(body).repartition("record").sortWithinPartitions("record", "chunk")
    folder = scratch_path(spark, "warc")
    folder = folder if "://" in folder or folder.startswith(("/", "file:")) else f"/{folder}"
    fields = arrow_schema(MANIFEST)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, sink, current = Batches(fields), None, None
        system, root = _file_system(folder)

        def ended():
            sink.write(gz.compress(b"\r\n\r\n") + gz.flush())
            return out.add((current, name, start, sink.tell()))

        for record, chunk, data, head, first, first_page in rows_of(batches, 64):
            if sink is None:
                system.create_dir(root, recursive=True)
                name = f"{uuid.uuid4().hex}.warc.gz"
                sink = system.open_output_stream(f"{root}/{name}", compression=None)
            if chunk == -1:
                if current is not None:
                    yield from ended()
                current, start, gz = record, sink.tell(), zlib.compressobj(6, wbits=31)
                kind = "response" if first == record else "revisit"
                info = (head["page_id"], head["url"], head["sha1"], head["bytes"], (first, first_page))
                sink.write(gz.compress(_header(kind, record, *info) + HTTP))
            elif kind == "response":
                sink.write(gz.compress(data))
        if current is not None:
            yield from ended()
        if sink is not None:
            sink.close()
        yield from out.flush()

    manifest = map_arrow(ordered, run, MANIFEST)
    return written(manifest.withColumn("file", F.concat(F.lit(f"{folder}/"), "file")), "manifest")


class _Member:
    """One record as its decompressed bytes come: head, then payload chunks."""

    def __init__(self, size: int):
        self.size, self.buffer, self.head, self.left = size, bytearray(), None, 0
        self.chunk, self.seen, self.sha1 = 0, 0, hashlib.sha1()

    def rows(self, data: bytes) -> Iterator[tuple]:
        self.buffer += data
        if self.head is None:
            if (at := self.buffer.find(b"\r\n\r\n")) < 0:
                return
            lines = bytes(self.buffer[:at]).decode().split("\r\n")
            if lines[0] != "WARC/1.1":
                raise ValueError("no WARC record here")
            self.head = dict(x.split(": ", 1) if ": " in x else (x.rstrip(":"), "") for x in lines[1:])
            del self.buffer[: at + 4]
            self.left = int(self.head["Content-Length"])
            self.http = False
        if not self.http:
            if (at := self.buffer.find(b"\r\n\r\n")) < 0:
                return
            del self.buffer[: at + 4]
            self.left, self.http = self.left - at - 4, True
        while self.left and len(self.buffer) >= min(self.size, self.left):
            yield self.row(bytes(self.buffer[: min(self.size, self.left)]))

    def row(self, piece: bytes) -> tuple:
        del self.buffer[: len(piece)]
        self.left -= len(piece)
        self.seen += len(piece)
        self.sha1.update(piece)
        self.chunk += 1
        return self.cells(piece, self.seen, base32(self.sha1.digest()), self.left == 0)

    def cells(self, piece: bytes, size: int, sha1: str, last: bool) -> tuple:
        h = self.head
        number = lambda name: int(h[name]) if h.get(name) else None
        known = h["WARC-Payload-Digest"].removeprefix("sha1:")
        if last and (sha1 != known or size != int(h["WARC-Payload-Length"])):
            raise ValueError(f"{h['WARC-Record-ID']}: the payload does not fit its digest")
        return (
            number("WARC-Page-ID"), max(0, self.chunk - 1), piece, size, sha1, last, h["WARC-Type"],
            number("WARC-Refers-To-Page-ID"), h["WARC-Record-ID"], h["WARC-Target-URI"],
        )

    def ended(self) -> Iterator[tuple]:
        """Records without payload have one empty chunk."""
        if self.head is None or self.left or bytes(self.buffer) != b"\r\n\r\n":
            raise ValueError("a record is cut short")
        if not self.seen:
            h = self.head
            yield self.cells(b"", int(h["WARC-Payload-Length"]), h["WARC-Payload-Digest"].removeprefix("sha1:"), True)


def _ranges(files: DataFrame) -> DataFrame:
    """(file, start, stop) of runs of whole members of about ``RANGE_BYTES``;
    without a manifest's columns, of whole files."""
    if not {"start", "stop"} <= {*files.columns}:
        return files.select("file").distinct().select("file", F.lit(0).cast("bigint").alias("start"), F.lit(None).cast("bigint").alias("stop"))
    near = F.floor(F.col("start") / RANGE_BYTES)
    found = files.groupBy("file", near.alias("near")).agg(F.min("start").alias("start"), F.max("stop").alias("stop"))
    return found.select("file", "start", "stop")


def read(files: DataFrame, size: int = CHUNK_BYTES, payload: bool = True) -> DataFrame:
    """Chunk rows of the records in the archives that ``files`` names: a manifest,
    or any table with a column file. Without ``payload``, the last row of each
    record and no data. A revisit has one row, with the size and digest of the
    payload it names. The ranges, a row each, are counted while the plan is built."""
    fields = arrow_schema(FOUND)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = Batches(fields)
        for _, file, start, stop in rows_of(batches):
            system, path = _file_system(file)
            with system.open_input_file(path) as source:
                source.seek(start)
                gz, member, data = zlib.decompressobj(31), _Member(size), b""
                left = source.size() - start if stop is None else stop - start
                while True:
                    if not data and left:
                        data = source.read(min(size, left))
                        left -= len(data)
                    if not data:
                        break
                    rows = list(member.rows(gz.decompress(data, size)))
                    data = gz.unconsumed_tail
                    if gz.eof:
                        rows += member.ended()
                        data, gz, member = gz.unused_data, zlib.decompressobj(31), _Member(size)
                    for row in rows:
                        if payload or row[5]:
                            piece = row[2] if payload else b""
                            yield from out.add((*row[:2], piece, *row[3:]), 256 + len(piece))
        yield from out.flush()

    ranges = written(_ranges(files), "ranges")
    # A task a range, dealt by number: hashes would put some in one task.
    numbered = ranked(ranges, [], ["file", "start"], "ranges-in-order").select(F.col("rank").cast("int").alias("task"), "file", "start", "stop")
    return map_arrow(numbered.repartitionById(max(1, ranges.count()), F.col("task")), run, FOUND)
