"""WARC archives: writing pages as records, and reading them back in sequence.

Every record is a gzip member of its own. The reader takes the file in small pieces, decompresses them
with one zlib stream per member, frames header and block by their lengths and checks block and payload
digests as bytes pass; neither a file nor a record is ever held whole unless its payload is asked for.

Of pages with equal payloads the one with the largest page_id becomes a response, the others revisit
records that refer to it. Payloads shorter than `least_bytes` always become responses.

Results: a null html is an empty payload; a null url gives a record without target URI; a null page_id
counts as smaller than any other. Repeated rows give a record each: those that carry the largest
page_id of their payload are all responses, the others revisit that page_id. An empty table gives no
archive and no row. Columns other than page_id, url and html play no part.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator
from typing import NamedTuple
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.llm.shared_files import input_stream, new_file, output
from tributary.session import scratch_path, write_and_reload

FILE_BYTES = 256 << 20
PIECE = 1 << 16
LEVEL = 3
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def page_uri(page_id: int | None) -> str:
    return f"<urn:page:{'none' if page_id is None else page_id}>"


def page_of(uri: str | None) -> int | None:
    tail = (uri or "").removeprefix("<urn:page:").removesuffix(">")
    return None if tail in ("", "none") else int(tail)


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, length: int, refers_to: int | None) -> bytes:
    """One record as a gzip member; a revisit has the HTTP header only."""
    revisit = refers_to is not None
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {length}\r\n\r\n".encode()
    block = http if revisit else http + payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {page_uri(page_id)}",
        f"WARC-Date: {DATE}",
        "Content-Type: application/http; msgtype=response",
        f"WARC-Payload-Digest: sha1:{digest}",
        f"WARC-Block-Digest: sha1:{base32_sha1(block)}",
        f"Content-Length: {len(block)}",
    ]
    if url is not None:
        head.append(f"WARC-Target-URI: {quote(url, safe='%!#$&()*+,/:;=?@[]~' + chr(39))}")
    if revisit:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {page_uri(refers_to)}"]
    packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return b"".join(
        [packer.compress("\r\n".join(head).encode() + b"\r\n\r\n"), packer.compress(block), packer.compress(b"\r\n\r\n"), packer.flush()]
    )


class Record(NamedTuple):
    headers: dict[str, str]
    payload_bytes: int
    payload_digest: str
    payload: bytes | None


class Damaged(ValueError):
    """An archive that breaks the format or a digest."""


def read_archive(stream, with_payload: bool = False) -> Iterator[Record]:
    """Records of one archive, in file order."""
    reader = _Pieces(stream)
    while reader.member():
        headers = _fields(reader.until(b"\r\n\r\n"))
        left = int(headers["content-length"])
        block, payload, parts, size = hashlib.sha1(), hashlib.sha1(), [], 0
        http = reader.until(b"\r\n\r\n")
        block.update(http)
        left -= len(http)
        if left < 0:
            raise Damaged("the HTTP header is longer than the block")
        for part in reader.exactly(left):
            block.update(part)
            payload.update(part)
            size += len(part)
            if with_payload:
                parts.append(part)
        if b"".join(reader.exactly(4)) != b"\r\n\r\n" or not reader.at_member_end():
            raise Damaged("the record does not end where its length says")
        if headers["warc-block-digest"] != "sha1:" + base64.b32encode(block.digest()).decode():
            raise Damaged("the block digest differs")
        stated = headers["warc-payload-digest"].removeprefix("sha1:")
        stated_size = int(_fields(http)["content-length"])
        if headers["warc-type"] == "response":
            if stated != base64.b32encode(payload.digest()).decode() or stated_size != size:
                raise Damaged("the payload differs from its digest or length")
        yield Record(headers, stated_size, stated, b"".join(parts) if with_payload else None)


def _fields(data: bytes) -> dict[str, str]:
    lines = data.decode().split("\r\n")
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:] if x)}


class _Pieces:
    """Decompressed bytes of one gzip member after the other, a small piece at a time."""

    def __init__(self, stream):
        self._stream, self._raw, self._plain, self._zip = stream, b"", b"", None

    def member(self) -> bool:
        """Begin the next member; False at the end of the file."""
        self._raw = self._raw or self._stream.read(PIECE)
        self._zip, self._plain = zlib.decompressobj(31), b""
        return bool(self._raw)

    def _more(self) -> bool:
        """Add a piece of plain bytes; False at the end of the member."""
        while not self._zip.eof:
            self._raw = self._raw or self._stream.read(PIECE)
            if not self._raw:
                raise Damaged("the file ends inside a record")
            got = self._zip.decompress(self._raw, PIECE)
            self._raw = self._zip.unused_data if self._zip.eof else self._zip.unconsumed_tail
            if got:
                self._plain += got
                return True
        return False

    def until(self, end: bytes) -> bytes:
        """Everything up to and with the end mark."""
        while (at := self._plain.find(end)) < 0:
            if not self._more():
                raise Damaged("a header does not end")
        head, self._plain = self._plain[: at + len(end)], self._plain[at + len(end) :]
        return head

    def exactly(self, n: int) -> Iterator[bytes]:
        while n:
            if not self._plain and not self._more():
                raise Damaged("the record is shorter than its length says")
            part, self._plain = self._plain[:n], self._plain[n:]
            n -= len(part)
            yield part

    def at_member_end(self) -> bool:
        return not self._plain and not self._more()


def with_references(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """page_id, url, payload, digest (hex), length, refers_to; a payload is kept where it is written."""
    body = F.coalesce(F.encode(F.col("html").cast("string"), "UTF-8"), F.lit(b""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), body.alias("payload"))
    rows = rows.withColumns({"digest": F.sha1("payload"), "length": F.length("payload").cast("long")})
    # Only payloads that occur again; counted map-side, so a much copied page is one row per task.
    again = (
        rows.where(F.col("length") >= least_bytes).groupBy("digest")
        .agg(F.max("page_id").alias("first_id"), F.count("*").alias("n")).where("n > 1").select("digest", "first_id")
    )
    joined = rows.join(again, "digest", "left")
    refers_to = F.expr("CASE WHEN first_id IS NOT NULL AND (page_id IS NULL OR page_id < first_id) THEN first_id END")
    return joined.withColumn("refers_to", refers_to).select(
        "page_id", "url", F.when(F.col("refers_to").isNull(), F.col("payload")).alias("payload"), "digest", "length", "refers_to"
    )


def write_archives(records: DataFrame, folder: str, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write the rows of with_references as archives below the folder; returns path, records, bytes of each."""
    schema = pa.schema([("path", pa.string()), ("records", pa.int64()), ("bytes", pa.int64())])

    def write(batches):
        out, path, count, size = None, "", 0, 0
        done = []
        for batch in batches:
            for row in batch.to_pylist():
                if out is None:
                    path = new_file(folder, ".warc.gz")
                    out, count, size = output(path), 0, 0
                digest = base64.b32encode(bytes.fromhex(row["digest"])).decode()
                data = record(row["page_id"], row["url"], row["payload"] or b"", digest, row["length"], row["refers_to"])
                out.write(data)
                count, size = count + 1, size + len(data)
                if size >= file_bytes:
                    out.close()
                    done.append((path, count, size))
                    out = None
        if out is not None:
            out.close()
            done.append((path, count, size))
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*done, strict=True), schema, strict=True)], schema=schema)

    return write_and_reload(records.mapInArrow(write, "path string, records long, bytes long"), "archives")


def read_archives(files: DataFrame, with_payload: bool = False) -> DataFrame:
    """A row per record of the archives in the column `path`; a file is one task's work."""
    fields = [
        ("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
        ("record_type", pa.string()), ("refers_to", pa.int64()),
    ]
    schema = pa.schema(fields + [("payload", pa.binary())] * with_payload)

    def rows(path: str):
        with input_stream(path) as stream:
            for r in read_archive(stream, with_payload):
                h = r.headers
                yield (
                    page_of(h["warc-record-id"]), h.get("warc-target-uri"), r.payload_bytes, r.payload_digest,
                    h["warc-type"], page_of(h.get("warc-refers-to")), *([r.payload] if with_payload else []),
                )

    def read(batches):
        held, used = [], 0
        for batch in batches:
            for path in batch.column(0).to_pylist():
                for row in rows(path):
                    held.append(row)
                    used += 200 + (len(row[-1] or b"") if with_payload else 0)
                    if used > 8 << 20:
                        yield _batch(held, schema)
                        held, used = [], 0
        if held:
            yield _batch(held, schema)

    kinds = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"
    return files.select("path").mapInArrow(read, kinds + ", payload binary" * with_payload)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


def archive_round_trip(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to, url as read back from the archives."""
    spark = pages.sparkSession
    folder = scratch_path(spark, "warc")
    files = write_archives(with_references(pages, least_bytes), folder)
    spread = files.repartition(max(1, files.count()))
    return read_archives(spread).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url")
