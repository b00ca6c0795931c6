"""Operator 9, WARC: archives with one gzip member for each record, and a sequential reader.

Writing: payloads are digested in the JVM; of records with equal payloads of at least ``MIN_REVISIT`` bytes the one with the
smallest id is a response and the others are revisits of it. The groups are found on ids and digests alone (pre-aggregated,
so that a payload with very many copies is no hot key) and only then joined to the pages. Records become gzip members, and
members become segments of bounded size in a table with a binary column, which any store that Spark writes can hold;
``export_archives`` turns segments into ``.warc.gz`` files.

Reading: a segment is fed piece by piece to an incremental zlib decompressor; each member's end starts the next record;
header lines and Content-Length frame the block, and the digests of block and payload are verified. A broken member raises.

Defined results: a null html is an empty payload; a null url has no target header; line breaks in a url are escaped; page
rows with equal id and equal payload are judged alike, each as its own record; a null page_id gives a record without a page
id, which is a response; of equal payloads under equal smallest ids (a tie) every record is a
response; a very long page is a segment of its own and costs its task memory in proportion to its length; columns other than page_id, url and html are
ignored; an empty table gives an empty archive.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from noticeloom.llm._common import materialise, table, tidy

MIN_REVISIT = 100
#: Segments are closed when they hold this many compressed bytes; a single larger record is a segment of its own.
SEGMENT_BYTES = 4 << 20
LEVEL = 6
PIECE = 64 << 10
_DATE = b"2000-01-01T00:00:00Z"
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"
_PROFILE = b"http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"


def record_id(page_id: int | None) -> bytes:
    return b"<urn:page:%d>" % page_id if page_id is not None else b"<urn:page:none>"


def write_record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One WARC/1.0 record as one gzip member. A revisit's block is the HTTP header alone."""
    http = _HTTP % len(payload)
    block = http if refers_to is not None else http + payload
    lines = [
        b"WARC/1.0",
        b"WARC-Type: " + (b"response" if refers_to is None else b"revisit"),
        b"WARC-Record-ID: " + record_id(page_id),
        b"WARC-Date: " + _DATE,
        b"WARC-Payload-Digest: sha256:" + digest.encode(),
        b"WARC-Block-Digest: sha256:" + hashlib.sha256(block).hexdigest().encode(),
        b"Content-Type: application/http; msgtype=response",
        b"Content-Length: %d" % len(block),
    ]
    if url is not None:
        lines.append(b"WARC-Target-URI: " + url.replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A").encode())
    if refers_to is not None:
        lines += [b"WARC-Refers-To: " + record_id(refers_to), b"WARC-Profile: " + _PROFILE]
    z = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return z.compress(b"\r\n".join(lines) + b"\r\n\r\n" + block + b"\r\n\r\n") + z.flush()


def members(chunks: Iterable[bytes]) -> Iterator[bytes]:
    """The contents of the gzip members of a stream that comes in pieces; bytes after the last member, or a member that
    does not end, are an error."""
    z, held = zlib.decompressobj(31), []
    begun = False
    for data in chunks:
        while data:
            begun = True
            held.append(z.decompress(data))
            data = z.unused_data
            if z.eof:
                yield b"".join(held)
                z, held, begun = zlib.decompressobj(31), [], False
    if begun:
        raise ValueError("the stream ends inside a gzip member")


def parse_record(data: bytes) -> dict:
    """Headers, block and payload of one record, with its framing and digests verified."""
    head, sep, rest = data.partition(b"\r\n\r\n")
    version, *lines = head.split(b"\r\n")
    if not sep or not version.startswith(b"WARC/"):
        raise ValueError("no WARC header")
    headers = {k.strip().lower(): v.strip() for k, _, v in (x.partition(b":") for x in lines)}
    n = int(headers[b"content-length"])
    block = rest[:n]
    if len(block) != n or rest[n:] != b"\r\n\r\n":
        raise ValueError("Content-Length does not frame the block")
    if hashlib.sha256(block).hexdigest().encode() != headers[b"warc-block-digest"].removeprefix(b"sha256:"):
        raise ValueError("the block's digest differs")
    http, _, payload = block.partition(b"\r\n\r\n")
    fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(b":") for x in http.split(b"\r\n")[1:])}
    kind, digest = headers[b"warc-type"].decode(), headers[b"warc-payload-digest"].removeprefix(b"sha256:").decode()
    length = int(fields[b"content-length"])
    if kind == "response" and (len(payload) != length or hashlib.sha256(payload).hexdigest() != digest):
        raise ValueError("the payload's length or digest differs")
    url = headers.get(b"warc-target-uri")
    number = lambda x: None if x in (None, b"<urn:page:none>") else int(x.removeprefix(b"<urn:page:").rstrip(b">"))
    return {
        "page_id": number(headers[b"warc-record-id"]), "url": None if url is None else url.decode().replace("%0A", "\n").replace("%0D", "\r").replace("%25", "%"),
        "record_type": kind, "payload_bytes": length, "payload_digest": digest, "refers_to": number(headers.get(b"warc-refers-to")), "payload": payload if kind == "response" else None,
    }


def read_stream(chunks: Iterable[bytes]) -> Iterator[dict]:
    return (parse_record(m) for m in members(chunks))


def with_references(pages: DataFrame, min_revisit: int = MIN_REVISIT) -> DataFrame:
    """page_id, url, html, digest, refers_to."""
    html = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    thin = pages.select("page_id", F.sha2(html, 256).alias("digest"), F.octet_length(html).alias("n")).where((F.col("n") >= min_revisit) & F.col("page_id").isNotNull())
    # aggregated in the map tasks first, so a digest shared by a third of all pages is a few rows here
    groups = thin.groupBy("digest").agg(F.min("page_id").alias("refers_to"), F.max("page_id").alias("last")).where("refers_to < last").drop("last")
    again = thin.join(groups, "digest").where("page_id > refers_to").select("page_id", "digest", "refers_to").distinct()
    rows = pages.select("page_id", "url", html.alias("html"), F.sha2(html, 256).alias("digest"))
    return rows.join(again, ["page_id", "digest"], "left")


def write_archives(pages: DataFrame, segment_bytes: int = SEGMENT_BYTES) -> DataFrame:
    """Segments ``(content binary, n_records long)`` of the archive of ``pages``, written to the shared folder."""

    def run(batches):
        held, size, n = [], 0, 0
        pack = lambda: pa.RecordBatch.from_pydict({"content": pa.array([b"".join(held)], pa.binary()), "n_records": pa.array([n], pa.int64())})
        for b in batches:
            for page_id, url, html, digest, refers in zip(*(b.column(i) for i in range(5)), strict=True):
                member = write_record(page_id.as_py(), url.as_py(), html.as_py(), digest.as_py(), refers.as_py())
                held.append(member)
                size, n = size + len(member), n + 1
                if size >= segment_bytes:
                    yield pack()
                    held, size, n = [], 0, 0
        if n:
            yield pack()

    rows = with_references(pages).select("page_id", "url", "html", "digest", "refers_to")
    return materialise(rows.mapInArrow(run, "content binary, n_records long"), "warc")


READ = "page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long, payload binary"


def read_archives(segments: DataFrame, payloads: bool = True) -> DataFrame:
    """Every record of the segments; segments are independent streams, so they are read in parallel and each in sequence."""
    names = [x.split()[0] for x in READ.split(", ")]
    kinds = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    schema = pa.schema([(n, kinds[x.split()[1]]) for n, x in zip(names, READ.split(", "), strict=True)])

    def run(batches):
        for b in batches:
            for cell in b.column(0):
                view = memoryview(cell.as_buffer())
                rows: list[dict] = []
                size = 0
                for r in read_stream(view[i : i + PIECE].tobytes() for i in range(0, len(view), PIECE)):
                    size += len(r["payload"] or b"")
                    rows.append(r if payloads else r | {"payload": None})
                    if len(rows) >= 1000 or payloads and size > 8 << 20:
                        yield pa.RecordBatch.from_pylist(rows, schema)
                        rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema)

    return segments.select("content").mapInArrow(run, READ)


def export_archives(segments: DataFrame, folder: str) -> int:
    """Write each segment as ``part-N.warc.gz`` into ``folder`` (a path of the driver's file system), one at a time; how many."""
    n = 0
    for n, row in enumerate(segments.select("content").toLocalIterator(), 1):  # noqa: B007
        with open(f"{folder}/part-{n:05d}.warc.gz", "wb") as f:
            f.write(row.content)
    return n


def import_archives(spark, path: str) -> DataFrame:
    """Segments from ``.warc.gz`` files, by any path that Spark reads."""
    return spark.read.format("binaryFile").load(path).select("content")


@tidy
def op9_warc(spark, sf_dir: str) -> DataFrame:
    segments = write_archives(table(spark, sf_dir, "pages"))
    return read_archives(segments, payloads=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


QUERIES = {"op9_warc": op9_warc}
ORACLES = {
    "op9_warc": f"""WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
d AS (SELECT page_id, strlen(h)::BIGINT AS payload_bytes, sha256(h) AS payload_digest FROM p),
m AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM d),
r AS (SELECT *, payload_bytes >= {MIN_REVISIT} AND page_id > first_id AS again FROM m)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN again THEN first_id END AS refers_to FROM r"""
}
