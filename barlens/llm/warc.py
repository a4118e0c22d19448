"""WARC archives: writing with segments, chunked framing and revisits, and reassembly on reading.

Records go into text files of raw bytes with a bounded number of records, each of at most one
segment, compressed as a whole. Reading parses every file by the records' lengths. Complete records
are decoded where they are read. Segments are grouped by the identifier of their origin, put in
order of their number, checked against the total length, and only then decoded.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barlens.llm.common import batch_of, chunks

SHORTEST_SHARED = 1000
SEGMENT_BYTES = 32 << 10
CHUNK_BYTES = 8 << 10
RECORDS_PER_FILE = 1000

_VERSION = b"WARC/1.1"
_BREAK = b"\r\n"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
_UNSAFE = {code: f"%{code:02X}" for code in [*range(33), 127]}


def page_name(page: int | None) -> str:
    return f"<urn:page:{'' if page is None else page}>"


def record_id(page: int | None, row: int) -> str:
    """The page's name with a number that tells rows of one page apart."""
    return f"{page_name(page)[:-1]}:{row}>"


def page_of(identifier: str | None) -> int | None:
    """The page number in a page's name or a record's identifier."""
    page = identifier.strip("<>").split(":")[2] if identifier else ""
    return int(page) if page else None


def framed(payload: bytes, size: int = CHUNK_BYTES) -> bytes:
    """The payload in chunked transfer framing."""
    parts = [
        b"%x\r\n%b\r\n" % (len(part), part)
        for part in (payload[i : i + size] for i in range(0, len(payload), size))
    ]
    return b"".join(parts) + b"0\r\n\r\n"


def unframed(body: bytes) -> bytes:
    """The payload of a body in chunked transfer framing."""
    parts, at = [], 0
    while True:
        end = body.index(_BREAK, at)
        size = int(body[at:end].split(b";")[0], 16)
        at = end + 2
        if size == 0:
            return b"".join(parts)
        if body[at + size : at + size + 2] != _BREAK:
            raise ValueError("a chunk does not end where its length says")
        parts.append(body[at : at + size])
        at += size + 2


def record(headers: dict[str, object], block: bytes) -> bytes:
    """One record, without the empty lines that end it."""
    lines = [f"{name}: {value}" for name, value in headers.items() if value is not None]
    head = "\r\n".join([*lines, f"Content-Length: {len(block)}"]).encode()
    return _VERSION + _BREAK + head + _BREAK * 2 + block


def _safe(url: str | None) -> str | None:
    """A URL that fits a header line."""
    return url.translate(_UNSAFE) if url else None


def page_records(
    page: int | None, row: int, url: str | None, payload: bytes, refers: dict | None, date: str,
    segment_bytes: int = SEGMENT_BYTES,
) -> Iterator[bytes]:
    """The records of one page: a response with its continuations, or a revisit.

    ``refers`` names page and url that a revisit refers to.
    """
    identifier = record_id(page, row)
    common = {
        "WARC-Record-ID": identifier,
        "WARC-Date": date,
        "WARC-Target-URI": _safe(url),
        "WARC-Payload-Digest": "sha1:" + hashlib.sha1(payload).hexdigest(),
        "Content-Type": "application/http;msgtype=response",
    }
    if refers is not None:
        block = _HTTP + b"Content-Length: %d\r\n\r\n" % len(payload)
        revisit = {
            "WARC-Profile": _PROFILE,
            "WARC-Refers-To": page_name(refers["page"]),
            "WARC-Refers-To-Target-URI": _safe(refers["url"]),
        }
        yield record({"WARC-Type": "revisit", **common, **revisit}, block)
        return
    block = _HTTP + b"Transfer-Encoding: chunked\r\n\r\n" + framed(payload)
    number = 1 if len(block) > segment_bytes else None
    yield record(
        {"WARC-Type": "response", **common, "WARC-Segment-Number": number}, block[:segment_bytes]
    )
    for number, start in enumerate(range(segment_bytes, len(block), segment_bytes), 2):
        last = start + segment_bytes >= len(block)
        yield record(
            {
                "WARC-Type": "continuation",
                "WARC-Record-ID": f"{identifier[:-1]}:{number}>",
                "WARC-Date": date,
                "WARC-Segment-Number": number,
                "WARC-Segment-Origin-ID": identifier,
                "WARC-Segment-Total-Length": len(block) if last else None,
            },
            block[start : start + segment_bytes],
        )


_RECORD = pa.schema([("record", pa.binary())])


def write_archive(
    pages: DataFrame, folder: str, id_column: str = "page_id", url_column: str = "url",
    html_column: str = "html", shortest: int = SHORTEST_SHARED, date: str = "2024-01-01T00:00:00Z",
    segment_bytes: int = SEGMENT_BYTES,
) -> None:
    """Write a record per row of ``pages`` into new files of ``folder``.

    The payload is the HTML in UTF-8; null is empty. Of rows with equal payloads of ``shortest``
    bytes or more those with the largest id become responses, the others revisits; several rows of
    one page with one payload are all responses. Null ids come first. Other columns are ignored.
    """
    payload = F.coalesce(F.col(html_column).cast("string"), F.lit("")).cast("binary")
    rows = pages.select(
        F.col(id_column).cast("long").alias("page"),
        F.monotonically_increasing_id().alias("row"),
        F.col(url_column).cast("string").alias("url"),
        payload.alias("payload"),
    ).withColumn("digest", F.sha1("payload"))
    long_enough = F.octet_length("payload") >= shortest
    shared = (
        rows.where(long_enough).groupBy("digest")
        .agg(F.max(F.struct("page", "url")).alias("kept"), F.count("*").alias("n"))
        .where("n > 1").select("digest", "kept")
    )
    other = F.col("kept").isNotNull() & ~F.col("kept.page").eqNullSafe(F.col("page"))
    refers = F.when(long_enough & other, F.col("kept"))
    decided = rows.join(shared, "digest", "left").select(
        "page", "row", "url", "payload", refers.alias("refers")
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "payload"):
            records = []
            for page, row, url, payload, refers in zip(
                *(batch.column(c).to_pylist() for c in ("page", "row", "url", "payload", "refers"))
            ):
                records += page_records(page, row, url, payload, refers, date, segment_bytes)
            yield batch_of(_RECORD, {"record": records})

    # The text writer takes bytes as they are and ends every record with the two empty lines.
    (
        decided.mapInArrow(work, "record binary")
        .select(F.col("record").cast("string").alias("value"))
        .write.mode("append").option("lineSep", "\r\n\r\n").option("compression", "gzip")
        .option("maxRecordsPerFile", RECORDS_PER_FILE).text(folder)
    )


def inflated(content: bytes) -> bytes:
    """A file's bytes, also of several compressed members."""
    if content[:2] != b"\x1f\x8b":
        return content
    parts = []
    while content:
        member = zlib.decompressobj(31)
        parts.append(member.decompress(content))
        content = member.unused_data
    return b"".join(parts)


def parse_records(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers (names in lower case) and block of each record of a file."""
    at = 0
    while at < len(data):
        if not data.startswith(b"WARC/", at):
            raise ValueError(f"no record begins at byte {at}")
        end = data.index(_BREAK * 2, at)
        lines = data[at:end].decode("utf-8").split("\r\n")[1:]
        headers = {
            name.strip().lower(): value.strip()
            for name, _, value in (line.partition(":") for line in lines)
        }
        start = end + 4
        stop = start + int(headers["content-length"])
        if stop > len(data):
            raise ValueError(f"the record at byte {at} is cut off")
        yield headers, data[start:stop]
        at = stop
        while data.startswith(_BREAK, at):
            at += 2


def http_payload(block: bytes) -> tuple[bytes, int]:
    """Payload of an HTTP response, and the payload's length as stated if there is no body."""
    head, _, body = block.partition(_BREAK * 2)
    headers = {
        name.strip().lower(): value.strip()
        for name, _, value in (line.partition(b":") for line in head.split(_BREAK)[1:])
    }
    if headers.get(b"transfer-encoding", b"").lower() == b"chunked":
        body = unframed(body)
    return body, int(headers.get(b"content-length", len(body)))


_READ = pa.schema(
    [
        ("origin", pa.string()), ("number", pa.int64()), ("total", pa.int64()),
        ("kind", pa.string()), ("refers", pa.string()), ("url", pa.string()),
        ("digest", pa.string()), ("block", pa.binary()),
    ]
)
_READ_DDL = (
    "origin string, number long, total long, kind string, refers string, url string,"
    " digest string, block binary"
)


def read_records(spark: SparkSession, folder: str) -> DataFrame:
    """Every record of the archives in ``folder``; segments carry their number and origin."""
    files = spark.read.format("binaryFile").load(folder).select("content")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                out = {name: [] for name in _READ.names}
                for headers, block in parse_records(inflated(batch.column("content")[i].as_py())):
                    number = headers.get("warc-segment-number")
                    total = headers.get("warc-segment-total-length")
                    out["origin"].append(
                        headers.get("warc-segment-origin-id") or headers["warc-record-id"]
                    )
                    out["number"].append(int(number) if number else None)
                    out["total"].append(int(total) if total else None)
                    out["kind"].append(headers["warc-type"])
                    out["refers"].append(headers.get("warc-refers-to"))
                    out["url"].append(headers.get("warc-target-uri"))
                    out["digest"].append(headers.get("warc-payload-digest"))
                    out["block"].append(block)
                yield batch_of(_READ, out)

    return files.mapInArrow(work, _READ_DDL)


_PAGES = pa.schema(
    [
        ("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()),
        ("payload", pa.binary()),
    ]
)


def _decoded(records: DataFrame, keep_payload: bool) -> DataFrame:
    """Whole responses and revisits as pages. Raises where a payload is not what its digest says."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "block"):
            out = {name: [] for name in _PAGES.names}
            for origin, kind, refers, url, digest, block in zip(
                *(batch.column(c).to_pylist()
                  for c in ("origin", "kind", "refers", "url", "digest", "block"))
            ):
                payload, stated = http_payload(block)
                digest = (digest or "").removeprefix("sha1:")
                if kind == "response":
                    found = hashlib.sha1(payload).hexdigest()
                    if digest not in ("", found):
                        raise ValueError(f"{origin}: the payload's digest is {found}, not {digest}")
                    digest, stated = found, len(payload)
                out["page_id"].append(page_of(origin))
                out["url"].append(url)
                out["payload_bytes"].append(stated)
                out["payload_digest"].append(digest)
                out["record_type"].append(kind)
                out["refers_to"].append(page_of(refers))
                out["payload"].append(payload if keep_payload and kind == "response" else None)
            yield batch_of(_PAGES, out)

    return records.mapInArrow(
        work,
        "page_id long, url string, payload_bytes long, payload_digest string,"
        " record_type string, refers_to long, payload binary",
    )


def _reassembled(segments: DataFrame) -> DataFrame:
    """Whole records from their segments. Raises on a missing segment or a wrong total length."""
    first = F.col("kind") != "continuation"
    whole = segments.groupBy("origin").agg(
        F.array_sort(F.collect_list(F.struct("number", "block"))).alias("parts"),
        F.max("total").alias("total"),
        *[F.max(F.when(first, F.col(c))).alias(c) for c in ("kind", "refers", "url", "digest")],
    )
    numbers = F.transform("parts", lambda p: p["number"])
    block = F.concat_ws(
        "", F.transform("parts", lambda p: F.hex(p["block"]))
    )
    length = F.aggregate(
        "parts", F.lit(0).cast("long"), lambda n, p: n + F.octet_length(p["block"])
    )
    complete = (numbers == F.sequence(F.lit(1).cast("long"), F.size("parts").cast("long"))) & (
        length == F.col("total")
    )
    fault = F.raise_error(F.concat(F.lit("segments missing or wrong length: "), F.col("origin")))
    return whole.select(
        "origin", "kind", "refers", "url", "digest",
        F.when(F.coalesce(complete, F.lit(False)), F.unhex(block)).otherwise(fault).alias("block"),
    )


def read_archive(spark: SparkSession, folder: str, keep_payload: bool = True) -> DataFrame:
    """One row per response or revisit: page_id, url, payload_bytes, payload_digest, record_type,
    refers_to and, with ``keep_payload``, payload (null for revisits).

    A record that is cut off, a segment that is missing, a total length or a digest that does not
    fit fails the read. A folder without records gives no rows.
    """
    records = read_records(spark, folder)
    columns = ("origin", "kind", "refers", "url", "digest", "block")
    single = records.where("number is null").select(*columns)
    whole = _reassembled(records.where("number is not null"))
    decoded = _decoded(single.unionByName(whole), keep_payload)
    return decoded if keep_payload else decoded.drop("payload")
