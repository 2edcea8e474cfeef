"""WARC archives of web pages: a writer with revisit records and a sequential, verifying reader.

Writer: tasks write rolling .warc.gz files, one gzip member per record, into the folder that the cluster
shares; the manifest of a task's files is its only output, so files of lost or repeated attempts are never read.
Reader: every archive is one stream of bounded chunks through an incremental zlib; records are framed by
Content-Length and their block and payload digests are verified while they pass, so no record is held whole
unless its payload is asked for.

Defined results. Null html is an empty payload; a null url has no target header; a null page id is kept as
null. An empty table writes no archive and gives no row. A payload of any length is written whole and read in
chunks. Columns beyond page_id, url and html are dropped. Of equal payloads of at least min_revisit bytes the row with the largest page id is the response (all
rows with that id, if it is repeated) and the others revisit it. A damaged member yields one row with error
set and ends its archive.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, shared_dir, small_batches

CHUNK = 1 << 16
#: Fixed value: the profile of revisit records with equal payloads.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORDS = "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, payload binary, error string"


def with_revisits(pages: DataFrame, min_revisit: int = 1000) -> DataFrame:
    """pages(page_id, url, html) with payload, digest, record_type and refers_to.

    Only ids and digests are grouped; page texts meet the few revisits by page id.
    """
    payload = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    held = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), payload.alias("payload"), F.sha1(payload).alias("digest"))
    slim = held.where(F.octet_length("payload") >= min_revisit).select("page_id", "digest")
    heads = slim.groupBy("digest").agg(F.max("page_id").alias("head"), F.count(F.lit(1)).alias("n")).where("n > 1 and head is not null")
    again = slim.join(heads, "digest").where("not page_id <=> head").groupBy("page_id", "digest").agg(F.max("head").alias("refers_to"))
    again = again.select(F.col("page_id").alias("r_id"), F.col("digest").alias("r_digest"), "refers_to")
    joined = held.join(again, F.expr("page_id <=> r_id and digest = r_digest"), "left")
    kind = F.when(F.col("refers_to").isNull(), "response").otherwise("revisit")
    return joined.select("page_id", "url", "payload", "digest", kind.alias("record_type"), "refers_to")


def _record_id(page_id: int | None) -> str:
    return f"<urn:page:{'none' if page_id is None else page_id}>"


def _sha1(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_bytes(page_id, url, payload: bytes, digest: str, kind: str, refers_to, date: str) -> bytes:
    """One uncompressed record; a revisit's block holds the response's head only."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if kind == "revisit" else http + payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: {_record_id(page_id)}",
        f"WARC-Date: {date}",
        "Content-Type: application/http; msgtype=response",
        f"WARC-Payload-Digest: sha1:{base64.b32encode(bytes.fromhex(digest)).decode()}",
        f"WARC-Block-Digest: {_sha1(block)}",
        f"Content-Length: {len(block)}",
    ]
    if url is not None:
        head.insert(4, "WARC-Target-URI: " + quote(url, safe="!#$%&'()*+,/:;=?@[]~"))
    if kind == "revisit":
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {_record_id(refers_to)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def gzip_member(data: bytes, level: int = 6) -> bytes:
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def write_archives(records: DataFrame, folder: str | None = None, *, max_bytes: int = 64 << 20, date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """Write with_revisits() rows as archives below folder (a URI all executors reach); the manifest (path, records, bytes)."""
    spark = records.sparkSession
    small_batches(spark)
    folder = folder or f"{shared_dir(spark)}/warc-{uuid.uuid4().hex}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = pafs.FileSystem.from_uri(folder)
        fs.create_dir(root, recursive=True)
        out, path, count, size = None, "", 0, 0

        def closed():
            out.close()
            return pa.RecordBatch.from_pydict({"path": [path], "records": [count], "bytes": [size]})

        for batch in batches:
            for row in batch.to_pylist():
                if out is None:
                    path, count, size = f"{root}/{uuid.uuid4().hex}.warc.gz", 0, 0
                    out = fs.open_output_stream(path, compression=None)
                member = gzip_member(
                    record_bytes(row["page_id"], row["url"], row["payload"], row["digest"], row["record_type"], row["refers_to"], date)
                )
                out.write(member)
                count, size = count + 1, size + len(member)
                if size >= max_bytes:
                    yield closed()
                    out = None
        if out is not None:
            yield closed()

    return cut(records.mapInArrow(run, "path string, records long, bytes long").withColumn("folder", F.lit(folder)))


def members(chunks: Iterator[bytes]) -> Iterator[Iterator[bytes]]:
    """The members of a gzip stream, each as an iterator of its bytes, decompressed piece by piece."""
    chunks = iter(chunks)
    rest = next(chunks, b"")
    while rest:
        state = {"rest": rest}

        def pieces(state=state):
            unpack, data = zlib.decompressobj(31), state["rest"]
            while True:
                piece = unpack.decompress(data, CHUNK)
                if piece:
                    yield piece
                if unpack.eof:
                    state["rest"] = unpack.unused_data
                    return
                data = unpack.unconsumed_tail
                if not data and len(piece) < CHUNK:  # else output may still be pending
                    data = next(chunks, None)
                if data is None:
                    raise ValueError("the last member is cut short")

        body = pieces()
        yield body
        for _ in body:  # what the reader of the member left
            pass
        rest = state["rest"] or next(chunks, b"")


def read_record(pieces: Iterator[bytes], with_payload: bool = False) -> dict:
    """Parse and verify one record that arrives in pieces."""
    held = b""
    while (at := held.find(b"\r\n\r\n")) < 0:
        piece = next(pieces, None)
        if piece is None or len(held) > 1 << 20:
            raise ValueError("no end of the record's head")
        held += piece
    lines = held[:at].decode("utf-8", "replace").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    head = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
    left = length = int(head["content-length"])
    held = held[at + 4 :]
    block, payload, http, kept, size = hashlib.sha1(), hashlib.sha1(), b"", [], 0
    in_http, tail = True, b""
    while left > 0 or held:
        if not held:
            held = next(pieces, None)
            if held is None:
                raise ValueError(f"the block ends {left} bytes early")
        part, tail_part = held[:left], held[left:]
        left -= len(part)
        tail += tail_part
        block.update(part)
        if in_http:
            http += part
            if (at := http.find(b"\r\n\r\n")) >= 0:
                in_http, part, http = False, http[at + 4 :], http[: at + 4]
            else:
                part = b""
        if part:
            payload.update(part)
            size += len(part)
            if with_payload:
                kept.append(part)
        held = b""
    tail += b"".join(pieces)
    if tail != b"\r\n\r\n":
        raise ValueError(f"{length} bytes of block are not followed by two line ends")
    if "sha1:" + base64.b32encode(block.digest()).decode() != head.get("warc-block-digest"):
        raise ValueError("block digest differs")
    digest = base64.b32decode(head["warc-payload-digest"].removeprefix("sha1:")).hex()
    kind = head["warc-type"]
    if kind == "revisit":
        fields = dict(x.split(": ", 1) for x in http.decode().split("\r\n")[1:] if ": " in x)
        size = int(fields["Content-Length"])
    elif payload.hexdigest() != digest:
        raise ValueError("payload digest differs")
    number = lambda x: None if x in (None, "<urn:page:none>") else int(x.removeprefix("<urn:page:").removesuffix(">"))
    return {
        "page_id": number(head.get("warc-record-id")),
        "url": head.get("warc-target-uri"),
        "record_type": kind,
        "refers_to": number(head.get("warc-refers-to")),
        "payload_bytes": size,
        "payload_digest": digest,
        "payload": b"".join(kept) if with_payload else None,
        "error": None,
    }


def read_archives(manifest: DataFrame, with_payload: bool = False) -> DataFrame:
    """Rows of RECORDS from every archive of manifest(folder, path): one stream per archive, archives spread over tasks."""
    schema = pa.schema(
        [("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("payload", pa.binary()), ("error", pa.string())]
    )

    def archive(folder: str, path: str) -> Iterator[dict]:
        fs, _ = pafs.FileSystem.from_uri(folder)
        with fs.open_input_stream(path, compression=None) as stream:
            try:
                for pieces in members(iter(lambda: stream.read(CHUNK), b"")):
                    yield read_record(pieces, with_payload)
            except (ValueError, KeyError, zlib.error) as e:
                yield {**dict.fromkeys(schema.names), "error": f"{path}: {e}"}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for folder, path in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                rows, size = [], 0
                for row in archive(folder, path):
                    rows.append(row)
                    size += 200 + len(row["payload"] or b"")
                    if size > 4 << 20:
                        yield pa.RecordBatch.from_pylist(rows, schema=schema)
                        rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=schema)

    spread = max(1, min(manifest.count(), 100_000))
    return manifest.select("folder", "path").repartition(spread).mapInArrow(run, RECORDS)


def round_trip(spark: SparkSession, pages: DataFrame, min_revisit: int = 1000) -> DataFrame:
    """Write pages as archives and read the archives back. Raises on the first damaged record."""
    back = read_archives(write_archives(with_revisits(pages, min_revisit)))
    checked = F.when(F.col("error").isNotNull(), F.raise_error(F.col("error")).cast("long")).otherwise(F.col("payload_bytes"))
    return back.withColumn("payload_bytes", checked)
