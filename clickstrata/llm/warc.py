"""WARC archives: written through Spark's file writers, read back record by record."""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickstrata.llm.common import scratch_path

#: Records of one archive at most, so that an archive fits a reading task.
RECORDS_PER_FILE = 2000
#: Compressed bytes handed to the decompressor at a time.
FEED = 64 << 10

VERSION = b"WARC/1.1"
_CRLF = b"\r\n"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: An empty gzip member.  Spark's text writer puts it after every record's member as the line
#: separator; gzip readers see no bytes there.
_BETWEEN = zlib.compressobj(9, zlib.DEFLATED, 31)
_BETWEEN = (_BETWEEN.compress(b"") + _BETWEEN.flush()).decode("latin-1")


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_urn(page_id: int | None) -> str:
    return f"urn:page:{'' if page_id is None else page_id}"


def _header_value(text: str | None) -> str:
    """Header values hold no line ends; they are percent-encoded."""
    return (text or "").replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A")


def _plain_value(text: str) -> str:
    return text.replace("%0A", "\n").replace("%0D", "\r").replace("%25", "%")


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, length: int, digest: str) -> bytes:
    """One record: the HTTP head with the payload, or of a revisit the head alone."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {length}\r\n\r\n".encode()
    block = head if refers_to is not None else head + payload
    lines = [
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: <{record_urn(page_id)}>", "WARC-Date: 1970-01-01T00:00:00Z",
        f"WARC-Target-URI: {_header_value(url)}", "Content-Type: application/http; msgtype=response", f"WARC-Payload-Digest: sha1:{digest}", f"WARC-Block-Digest: sha1:{base32_sha1(block)}",
    ]
    if refers_to is not None:
        lines += [f"WARC-Refers-To: <{record_urn(refers_to)}>", f"WARC-Profile: {_PROFILE}"]
    lines.append(f"Content-Length: {len(block)}")
    return VERSION + _CRLF + "\r\n".join(lines).encode() + _CRLF * 2 + block + _CRLF * 2


def member(data: bytes, level: int = 6) -> bytes:
    z = zlib.compressobj(level, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


def members(chunks: Iterable[bytes]) -> Iterator[tuple[bytes, str | None]]:
    """The content of each gzip member in turn, with what is wrong with it; empty members are left out.

    Bytes are fed in pieces, so only one record is held.  After bytes that are no gzip
    there is no next member to be found, and the stream ends with an error.
    """
    z, parts = zlib.decompressobj(31), []
    fresh = True
    for chunk in chunks:
        while chunk:
            try:
                parts.append(z.decompress(chunk))
            except zlib.error as e:
                yield b"".join(parts), f"gzip: {e}"
                return
            fresh = False
            if not z.eof:
                break
            if data := b"".join(parts):
                yield data, None
            chunk, parts, z, fresh = z.unused_data, [], zlib.decompressobj(31), True
    if not fresh:
        yield b"".join(parts), "gzip: member is cut short"


@dataclass
class Record:
    """What a record says, and ``error`` if it doesn't hold."""

    kind: str | None = None
    page_id: int | None = None
    url: str | None = None
    payload: bytes | None = None
    payload_bytes: int | None = None
    digest: str | None = None
    refers_to: int | None = None
    error: str | None = None


def _urn_page(urn: str | None) -> int | None:
    number = (urn or "").strip("<>").rpartition(":")[2]
    return int(number) if number.lstrip("-").isdigit() else None


def _headers(lines: list[bytes]) -> dict[str, str]:
    pairs = (x.decode("utf-8", "replace").partition(":") for x in lines)
    return {k.strip().lower(): v.strip() for k, _, v in pairs}


def parse(data: bytes) -> Record:
    """The record in one member, framed by its content length, its digests verified."""
    out = Record()
    head, _, rest = data.partition(_CRLF * 2)
    version, *lines = head.split(_CRLF)
    h = _headers(lines)
    out.kind, out.page_id, out.url = h.get("warc-type"), _urn_page(h.get("warc-record-id")), _plain_value(h.get("warc-target-uri", ""))
    out.digest, out.refers_to = h.get("warc-payload-digest", "").removeprefix("sha1:") or None, _urn_page(h.get("warc-refers-to"))
    length = h.get("content-length", "")
    if version != VERSION:
        out.error = "no WARC version line"
    elif not length.isdigit() or rest[int(length) :] != _CRLF * 2:
        out.error = "content length does not frame the block"
    elif h.get("warc-block-digest") != f"sha1:{base32_sha1(rest[: int(length)])}":
        out.error = "block digest differs"
    if out.error:
        return out
    http, _, payload = rest[: int(length)].partition(_CRLF * 2)
    stated = _headers(http.split(_CRLF)[1:]).get("content-length", "")
    out.payload_bytes = int(stated) if stated.isdigit() else None
    if out.kind != "revisit":
        out.payload = payload
        if out.payload_bytes != len(payload) or out.digest != base32_sha1(payload):
            out.error = "payload differs from its length or digest"
    return out


def with_revisits(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", least: int = 0) -> DataFrame:
    """``pages`` with payload__, digest__ (hex) and refers_to__.

    Of equal payloads of at least ``least`` bytes the one with the largest identifier is kept in full.
    Owners are found on digests before any payload moves; groups of copies are split by
    adaptive execution, their owners' side being unique.
    """
    rows = pages.withColumn("payload__", F.coalesce(F.col(html_col), F.lit("")).cast("binary"))
    rows = rows.withColumns({"digest__": F.sha1("payload__"), "length__": F.octet_length("payload__")})
    owners = rows.filter(F.col("length__") >= least).groupBy("digest__", "length__").agg(F.max(id_col).alias("owner__"), F.count("*").alias("copies__")).filter("copies__ > 1")
    owners = owners.select(F.col("digest__").alias("of__"), F.col("length__").alias("bytes__"), "owner__")
    joined = rows.join(owners, (rows["digest__"] == owners["of__"]) & (rows["length__"] == owners["bytes__"]), "left")
    return joined.withColumn("refers_to__", F.when(~F.col(id_col).eqNullSafe(F.col("owner__")), F.col("owner__"))).drop("of__", "bytes__", "owner__")


def write_archives(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", least: int = 0) -> None:
    """Archives of ``pages`` below ``path``: one gzip member per record.

    Spark's text writer commits the files, so they may lie in any store it
    reaches and a repeated task leaves no half archive.  Null texts are empty payloads; rows of
    null identifiers are records without a number; repeated rows are repeated records.
    """
    def per_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for page, url, payload, refers, digest in zip(*(c.to_pylist() for c in batch.columns)):
                out.append(member(record(page, url, payload, refers, len(payload), base64.b32encode(bytes.fromhex(digest)).decode())))
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["value"])

    rows = with_revisits(pages, id_col, html_col, least)
    rows = rows.select(F.col(id_col).cast("bigint"), F.col(url_col).cast("string"), "payload__", "refers_to__", "digest__")
    made = rows.mapInArrow(per_batch, "value binary").select(F.col("value").cast("string"))
    made.write.option("lineSep", _BETWEEN).option("encoding", "ISO-8859-1").option("compression", "none").option("maxRecordsPerFile", RECORDS_PER_FILE).text(path)


RECORD = "archive string, place int, page_id bigint, url string, record_type string, payload binary, payload_bytes bigint, payload_digest string, refers_to bigint, error string"


def read_archives(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """One row per record of the archives below ``path``.

    ``error`` says what is wrong with a record, null if nothing is; after damage to the
    compression the rest of that archive is one row with an error.
    """
    def per_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for archive, content in zip(batch.column(0), batch.column(1)):
                view = memoryview(content.as_buffer())
                rows = []
                for place, (data, wrong) in enumerate(members(view[i : i + FEED] for i in range(0, len(view), FEED))):
                    r = Record(error=wrong) if wrong else parse(data)
                    rows.append((archive.as_py(), place, r.page_id, r.url, r.kind, r.payload if with_payload else None, r.payload_bytes, r.digest, r.refers_to, r.error))
                    if len(rows) == 256:
                        yield pa.RecordBatch.from_pylist([dict(zip(names, x)) for x in rows], schema)
                        rows = []
                yield pa.RecordBatch.from_pylist([dict(zip(names, x)) for x in rows], schema)

    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    schema = to_arrow_schema(StructType.fromDDL(RECORD))
    names = schema.names
    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInArrow(per_batch, RECORD)


def archived(pages: DataFrame, **columns) -> DataFrame:
    """``pages`` written to a fresh folder that all executors share, and its records."""
    path = scratch_path(pages.sparkSession, "warc")
    write_archives(pages, path, **columns)
    return read_archives(pages.sparkSession, path, with_payload=False)
