"""WARC derivatives: metadata and plain-text conversion records linked to the responses they come from.

Responses are read from WARC files (one gzip member per record, or plain), and each gives two records: a
``metadata`` record with facts of the response, and a ``conversion`` record with its plain text. Both carry
``WARC-Refers-To`` the response's record id, its target URI and date, and every other header of the source
under ``Source-``; digests are SHA-1 in base 32 over the block, as the format's guidelines have it.

Files are cut by size, each is one row of one task, and a task's output files take their names when they are
whole, so a task that runs again writes the same files again. No record meets another.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import html
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vulnatlas.llm.text import slices, stored
from vulnatlas.llm.token_files import write_whole
from vulnatlas.session import hadoop_path, shared_path

VERSION = b"WARC/1.1"
FILE_BYTES = 16_000_000
LEVEL = 1
#: The date of responses whose source has none.
DATE = "1970-01-01T00:00:00Z"
NAMESPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # fixed value: the URL namespace

_DROPPED = re.compile(r"<!--.*?(?:-->|\Z)|<(script|style|template|noscript)\b[^>]*>.*?(?:</\1\s*>|\Z)", re.S | re.I)
_BREAK = re.compile(r"</?(?:p|div|br|li|ul|ol|h[1-6]|tr|table|article|section|nav|header|footer|title|body|head|html)\b[^>]*>", re.I)
_TAG = re.compile(r"</?[a-zA-Z!?][^>]*(?:>|\Z)")


def digest(block: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(block).digest()).decode()


def record_id(*parts: str) -> str:
    """The same parts always name the same record."""
    return f"<urn:uuid:{uuid.uuid5(NAMESPACE, chr(0).join(parts))}>"


def record(headers: list[tuple[str, str]], block: bytes) -> bytes:
    """One record as a gzip member of its own; line breaks inside a value become spaces."""
    lines = [VERSION] + [f"{name}: {re.sub(r'[\r\n]+', ' ', value)}".encode() for name, value in headers]
    lines.append(f"Content-Length: {len(block)}".encode())
    return gzip.compress(b"\r\n".join(lines) + b"\r\n\r\n" + block + b"\r\n\r\n", LEVEL, mtime=0)


GZIP = b"\x1f\x8b\x08"


def _contents(data: bytes, step: int = 1 << 16) -> Iterator[bytes | None]:
    """The bytes of a file piece by piece: of its gzip members if it has any, None where one of them is broken."""
    if data[:2] != GZIP[:2]:
        yield from (data[at:at + step] for at in range(0, len(data), step))
        return
    at = 0
    while at >= 0:
        begin, member = at, zlib.decompressobj(31)
        try:
            while not member.eof:
                if at >= len(data):
                    raise zlib.error("a gzip member that is cut short")
                some = data[at:at + step]
                yield member.decompress(some)
                at += len(some) - len(member.unused_data)
            at = data.find(GZIP, at)  # what does not begin a member, such as padding, is passed over
        except zlib.error:
            yield None
            at = data.find(GZIP, begin + 1)


def records(data: bytes, broken: list[str] | None = None) -> Iterator[tuple[list[tuple[str, str]], bytes]]:
    """Headers and block of each record of a file, gzip members or plain, of which one is held at a time.

    A broken member or record is an error; or, with a list ``broken``, noted there and passed over up to the next
    member or record that begins.
    """

    def fault(what: str) -> None:
        if broken is None:
            raise ValueError(what)
        broken.append(what)

    held, need = bytearray(), 0
    for piece in _contents(data):
        if piece is None:
            fault("a gzip member that is cut short or damaged")
            held, need = bytearray(), 0
            continue
        held += piece
        while len(held) >= need:
            begin = len(held) - len(held.lstrip(b"\r\n"))
            head = held.find(b"\r\n\r\n", begin)
            if head < 0:
                break
            version, *lines = bytes(held[begin:head]).split(b"\r\n")
            headers = [(n.strip(), v.strip()) for n, _, v in (line.decode("utf-8", "replace").partition(":") for line in lines)]
            length = next((v for n, v in headers if n.lower() == "content-length"), "")
            if not version.startswith(b"WARC/") or not length.isdigit():
                fault("not a record of a web archive")
                found = held.find(b"WARC/", begin + 1)
                del held[:found if found >= 0 else len(held)]
                continue
            need = head + 4 + int(length)
            if len(held) < need:
                break
            yield headers, bytes(held[head + 4:need])
            del held[:need]
            need = 0
    if held.strip(b"\r\n\0 "):
        fault("a record that is cut short")


def _unchunked(body: bytes) -> bytes:
    """The body of a chunked transfer; as far as it goes if it is cut short."""
    out, at = [], 0
    while (end := body.find(b"\r\n", at)) >= 0:
        size = re.match(rb"\s*([0-9a-fA-F]+)", body[at:end])
        if not size or not int(size[1], 16):
            break
        at = end + 2 + int(size[1], 16)
        out.append(body[end + 2:at])
        at += 2
    return b"".join(out)


def http_body(block: bytes) -> tuple[str, dict[str, str], bytes, bool]:
    """Status line, headers by lower-case name, decoded body of a response, and whether all its codings were known.

    Chunked transfers and gzip, deflate and zstd contents are decoded; a body that is not what its headers say, as
    archives often store it decoded, stays as it is.
    """
    head, _, body = block.partition(b"\r\n\r\n")
    status, *lines = head.split(b"\r\n")
    headers = {n.strip().lower(): v.strip() for n, _, v in (line.decode("latin-1").partition(":") for line in lines)}
    if "chunked" in headers.get("transfer-encoding", "").lower() and re.match(rb"\s*[0-9a-fA-F]+\s*(;[^\r\n]*)?\r\n", body):
        body = _unchunked(body)
    known = True
    for coding in reversed([c.strip().lower() for c in headers.get("content-encoding", "").split(",") if c.strip()]):
        try:
            if coding in ("gzip", "x-gzip"):
                body = zlib.decompressobj(47).decompress(body) if body[:2] == GZIP[:2] else body
            elif coding == "deflate":
                try:
                    body = zlib.decompressobj().decompress(body)
                except zlib.error:
                    body = zlib.decompressobj(-15).decompress(body)
            elif coding == "zstd":
                body = zstandard.ZstdDecompressor().decompressobj().decompress(body)
            elif coding != "identity":
                known = False
        except (zlib.error, zstandard.ZstdError):
            break  # stored decoded already
    return status.decode("latin-1"), headers, body, known


def plain_text(page: str) -> str:
    """The text of a page: scripts, styles, comments and tags gone, block ends as line breaks, entities resolved."""
    text = _BREAK.sub("\n", _DROPPED.sub(" ", page))
    text = html.unescape(_TAG.sub("", text))
    lines = (" ".join(line.split()) for line in text.split("\n"))
    return "\n".join(line for line in lines if line)


def response(page_id: str, url: str, page: str) -> bytes:
    """The response record of a landed page."""
    payload = page.encode("utf-8", "replace")
    head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = head + payload
    return record([
        ("WARC-Type", "response"), ("WARC-Record-ID", record_id("response", page_id, url, digest(payload))), ("WARC-Date", DATE),
        ("WARC-Target-URI", url), ("Content-Type", "application/http; msgtype=response"),
        ("WARC-Block-Digest", digest(block)), ("WARC-Payload-Digest", digest(payload)), ("X-Page-Id", page_id),
    ], block)


def derivatives(headers: list[tuple[str, str]], block: bytes) -> tuple[bytes, bytes]:
    """The metadata and the conversion record of one response.

    A response without a record id gets one from its URI, date and block; the text of one in a coding that is not
    known is empty.
    """
    known = {name.lower(): value for name, value in headers}
    source = known.get("warc-record-id") or record_id("source", known.get("warc-target-uri", ""), known.get("warc-date", ""), digest(block))
    status, http, body, decoded = http_body(block)
    payload = block.partition(b"\r\n\r\n")[2]
    charset = re.search(r"charset=[\"']?([\w-]+)", http.get("content-type", ""), re.I)
    try:
        page = body.decode(charset[1] if charset else "utf-8", "replace")
    except LookupError:  # a charset no one knows
        page = body.decode("utf-8", "replace")
    text = plain_text(page).encode("utf-8", "replace") if decoded else b""
    kept = [(f"Source-{name}", value) for name, value in headers if name.lower() not in ("warc-type", "warc-refers-to", "content-length")]
    links = [(n, known[n.lower()]) for n in ("WARC-Date", "WARC-Target-URI") if n.lower() in known]
    facts = "".join(f"{n}: {v}\r\n" for n, v in (
        ("status-line", status), ("payload-digest", digest(payload)), ("payload-length", str(len(payload))),
        ("text-digest", digest(text)), ("text-length", str(len(text))))).encode()
    conversion = record_id("conversion", source)
    return (
        record([("WARC-Type", "metadata"), ("WARC-Record-ID", record_id("metadata", source)), ("WARC-Refers-To", source), *links,
                ("WARC-Concurrent-To", conversion), ("Content-Type", "application/warc-fields"), ("WARC-Block-Digest", digest(facts)), *kept], facts),
        record([("WARC-Type", "conversion"), ("WARC-Record-ID", conversion), ("WARC-Refers-To", source), *links,
                ("Content-Type", "text/plain"), ("WARC-Block-Digest", digest(text)), *kept], text),
    )


class _Files:
    """Files of about ``FILE_BYTES`` of one task, each with a row of its name and records."""

    def __init__(self, folder: str):
        self.folder, self.part, self.turn, self.held, self.size, self.count = folder, TaskContext.get().partitionId(), 0, [], 0, 0

    def add(self, *members: bytes) -> Iterator[pa.RecordBatch]:
        self.held.extend(members)
        self.size += sum(map(len, members))
        self.count += len(members)
        if self.size >= FILE_BYTES:
            yield from self.close()

    def close(self) -> Iterator[pa.RecordBatch]:
        if self.held:
            name = f"part-{self.part:06d}-{self.turn:06d}.warc.gz"
            write_whole(self.folder, name, b"".join(self.held))
            yield pa.RecordBatch.from_pydict({"file": [name], "records": pa.array([self.count], pa.int64()), "broken": pa.array([0], pa.int64())})
            self.turn, self.held, self.size, self.count = self.turn + 1, [], 0, 0


def write_responses(pages: DataFrame, folder: str) -> DataFrame:
    """Write ``pages`` (page_id, url, html) as response records; ``file, records, broken`` of each file (none is broken).

    Null urls and pages count as empty, a null id as ``''``. Repeated rows are records of the same id. Other
    columns are ignored; no page gives no file.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files = _Files(folder)
        for part in slices(batches, "html"):
            for page_id, url, page in zip(*(part.column(c).to_pylist() for c in ("page_id", "url", "html")), strict=True):
                yield from files.add(response(page_id, url, page))
        yield from files.close()

    rows = pages.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("page_id", "url", "html")))
    return rows.mapInArrow(write, "file string, records long, broken long")


def build_derivatives(spark: SparkSession, source: str, folder: str) -> DataFrame:
    """Write the derivatives of all response records below ``source``; ``file, records, broken`` of each file.

    Records of other types are passed over. A member or record that is damaged or cut short is passed over too and
    counted: ``broken`` of a row without a file is how many a source file has. Names of headers are in any case.
    Records that repeat an id give derivatives that repeat theirs; no source gives no file.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files = _Files(folder)
        for batch in batches:
            for data in batch.column("content"):
                broken: list[str] = []
                for headers, block in records(data.as_buffer().to_pybytes(), broken):
                    if any(name.lower() == "warc-type" and value.lower() == "response" for name, value in headers):
                        yield from files.add(*derivatives(headers, block))
                if broken:
                    yield pa.RecordBatch.from_pydict({
                        "file": pa.nulls(1, pa.string()), "records": pa.array([0], pa.int64()), "broken": pa.array([len(broken)], pa.int64())})
        yield from files.close()

    return archive(spark, source).mapInArrow(write, "file string, records long, broken long")


def archive(spark: SparkSession, folder: str) -> DataFrame:
    """The files of a folder: ``content``."""
    return spark.read.format("binaryFile").option("pathGlobFilter", "*.warc*").load(folder).select("content")


def read_records(spark: SparkSession, folder: str, digests: bool = False) -> DataFrame:
    """Every record below a folder: type, id, the id it refers to, source headers, its digest, and its text.

    With ``digests`` the ``block`` is left out; ``intact`` says whether the block has the digest of its header.
    Headers are found by name in any case, null where a record lacks one; what is damaged is passed over.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data in batch.column("content"):
                rows = []
                for headers, block in records(data.as_buffer().to_pybytes(), []):
                    known = {name.lower(): value for name, value in reversed(headers)}
                    text = block.decode("utf-8", "replace")
                    rows.append({
                        "page_id": known.get("source-x-page-id"), "type": known.get("warc-type"), "record_id": known.get("warc-record-id"),
                        "refers_to": known.get("warc-refers-to"), "url": known.get("warc-target-uri"),
                        "source_digest": known.get("source-warc-payload-digest"), "block_digest": known.get("warc-block-digest"),
                        "n_chars": len(text), "intact": known.get("warc-block-digest") == digest(block),
                    } | ({} if digests else {"block": text}))
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=schema)

    fields = [(n, pa.string()) for n in ("page_id", "type", "record_id", "refers_to", "url", "source_digest", "block_digest")]
    fields += [("n_chars", pa.int64()), ("intact", pa.bool_())] + ([] if digests else [("block", pa.string())])
    schema = pa.schema(fields)
    names = {pa.string(): "string", pa.int64(): "long", pa.bool_(): "boolean"}
    return archive(spark, folder).mapInArrow(read, ", ".join(f"{n} {names[t]}" for n, t in fields))


def new_folder(spark: SparkSession, name: str) -> str:
    target, fs = hadoop_path(spark, shared_path(spark, name))
    fs.mkdirs(target)
    return fs.makeQualified(target).toString()


def round_trip(pages: DataFrame) -> DataFrame:
    """The derivative records of ``pages`` as read back from their files, two for each page."""
    spark = pages.sparkSession
    responses, derived = new_folder(spark, "responses"), new_folder(spark, "derivatives")
    stored(write_responses(pages, responses), "response-files")
    stored(build_derivatives(spark, responses, derived), "derivative-files")
    return read_records(spark, derived, digests=True).withColumn("page_id", F.col("page_id").try_cast("long"))
