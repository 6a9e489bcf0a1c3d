"""WARC archives: writing pages as records, and reading them back with segment reassembly.

A record whose block is longer than ``segment`` bytes is written as a first record and ``continuation`` records. The
reader takes lengths from ``Content-Length``, groups continuation records by their origin's id, orders them by segment
number, checks the total length and decodes chunked transfer framing. Only segmented records are shuffled; whole ones
are decoded where they are read. Spark's writer makes the files (each record ends in the separator CR LF CR LF), so the
folder may be in any store and lost tasks are run again.
"""

from __future__ import annotations

import gzip
import hashlib
import re
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SEPARATOR = "\r\n\r\n"
SEGMENT, CHUNK, RECORDS_PER_FILE, SALTS = 48 << 10, 8 << 10, 400, 16
LEAST_REVISIT = 100


def with_revisits(pages: DataFrame, least: int = LEAST_REVISIT) -> DataFrame:
    """``page_id, url, html, digest, refers_to, first_url``: of equal payloads of ``least`` bytes or more, all but the one with the
    least page_id refer to it; ``first_url`` is that one's url. Null html is empty; rows with a null page_id are never referred
    to nor refer. Other columns are ignored."""
    p = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html")).withColumn("digest", F.sha2("html", 256))
    firsts = p.where(F.octet_length("html") >= least).groupBy("digest").agg(F.min(F.when(F.col("page_id").isNotNull(), F.struct("page_id", "url"))).alias("first"), F.count("page_id").alias("n")).where("n > 1").select("digest", F.col("first.page_id").alias("first"), F.col("first.url").alias("first_url"))
    # A payload with a large share of all pages is spread over SALTS joins; the side that is repeated has one narrow row a digest.
    salted = firsts.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return p.withColumn("salt", F.pmod(F.xxhash64("page_id"), F.lit(SALTS)).cast("int")).join(salted, ["digest", "salt"], "left").select("page_id", "url", "html", "digest", F.when(F.col("first") != F.col("page_id"), F.col("first")).alias("refers_to"), "first_url")


def chunked(payload: bytes, chunk: int = CHUNK) -> bytes:
    parts = []
    for i in range(0, len(payload), chunk):
        piece = payload[i : i + chunk]
        parts += [b"%x\r\n" % len(piece), piece, b"\r\n"]
    return b"".join([*parts, b"0\r\n\r\n"])


def dechunk(body: bytes) -> bytes:
    out, at = [], 0
    while True:
        end = body.index(b"\r\n", at)
        n = int(body[at:end].split(b";")[0], 16)
        if not n:
            return b"".join(out)
        if len(body) < end + 2 + n:
            raise ValueError("a chunk ends early")
        out.append(body[end + 2 : end + 2 + n])
        at = end + 2 + n + 2


def record_id(page_id: int | None, url: str | None, digest: str) -> str:
    """A record's id, from its page's id, url and payload: only rows that repeat all three share one."""
    told = xxhash.xxh3_64_hexdigest(f"{'-' if url is None else '=' + url}\n{digest}".encode("utf-8", "surrogatepass"))
    return f"<urn:page:{'null' if page_id is None else page_id}:{told}>"


def _record(headers: list[tuple[str, object]], block: bytes) -> bytes:
    head = "".join(f"{k}: {v}\r\n" for k, v in [*headers, ("Content-Length", len(block))])
    return b"WARC/1.1\r\n" + head.encode() + b"\r\n" + block


def page_records(page_id: int | None, url: str | None, html: str, digest: str, refers_to: int | None, first_url: str | None = None, segment: int = SEGMENT) -> Iterator[bytes]:
    """The records of a page, each without its closing separator."""
    payload = html.encode("utf-8", "surrogatepass")
    rid = record_id(page_id, url, digest)
    common = [("WARC-Record-ID", rid), ("WARC-Date", "2024-01-01T00:00:00Z"), ("WARC-Payload-Digest", f"sha256:{digest}"), ("X-Payload-Length", len(payload)), ("Content-Type", "application/http;msgtype=response")]
    if url is not None:
        uri = quote(url, safe="%/:=&?~#+!$,;'@()*[]", errors="surrogatepass")
        common.insert(1, ("WARC-Target-URI", uri))
        if uri != url:  # what is no URI as it stands is kept beside it
            common.insert(2, ("X-Page-Url", quote(url, safe="", errors="surrogatepass")))
    if refers_to is not None:
        yield _record([("WARC-Type", "revisit"), ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"), ("WARC-Refers-To", record_id(refers_to, first_url, digest)), *common], b"HTTP/1.1 200 OK\r\n\r\n")
        return
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n" + chunked(payload)
    if len(block) <= segment:
        yield _record([("WARC-Type", "response"), *common], block)
        return
    pieces = [block[i : i + segment] for i in range(0, len(block), segment)]
    yield _record([("WARC-Type", "response"), *common, ("WARC-Segment-Number", 1)], pieces[0])
    for k, piece in enumerate(pieces[1:], 2):
        last = [("WARC-Segment-Total-Length", len(block))] if k == len(pieces) else []
        yield _record([("WARC-Type", "continuation"), ("WARC-Record-ID", f"{rid[:-1]}:segment:{k}>"), ("WARC-Segment-Origin-ID", rid), ("WARC-Segment-Number", k), *last], piece)


def write_warc(pages: DataFrame, path: str, segment: int = SEGMENT) -> None:
    """Write a record for each row of ``with_revisits(...)`` to files under ``path``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out, held = [], 0
            for row in zip(*(b.column(i) for i in range(6)), strict=True):
                for r in page_records(*(x.as_py() for x in row), segment=segment):
                    out.append(r)
                    held += len(r)
                if held > 8 << 20:
                    yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["record"])
                    out, held = [], 0
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["record"])

    records = pages.select("page_id", "url", "html", "digest", "refers_to", "first_url").mapInArrow(run, "record binary")
    records.select(F.col("record").cast("string")).write.option("lineSep", SEPARATOR).option("maxRecordsPerFile", RECORDS_PER_FILE).option("compression", "gzip").text(path)


def unzipped(data) -> bytes:
    """A file's bytes; RECORDS_PER_FILE and SEGMENT bound them."""
    return gzip.decompress(data) if bytes(memoryview(data)[:2]) == b"\x1f\x8b" else bytes(data)


def parse_records(data: memoryview) -> Iterator[tuple[dict[str, str], memoryview]]:
    """Headers (lower-case names) and block of each record; lengths come from Content-Length alone."""
    at = 0
    while at < len(data):
        end, span = -1, 16 << 10
        while end < 0:  # a header is as long as its url
            end = bytes(data[at : at + span]).find(b"\r\n\r\n")
            if at + span >= len(data):
                break
            span *= 4
        if end < 0 or bytes(data[at : at + 5]) != b"WARC/":
            raise ValueError(f"no record at byte {at}")
        head = bytes(data[at : at + end]).decode("utf-8").split("\r\n")
        headers = {k.lower(): v for k, v in (line.split(": ", 1) for line in head[1:])}
        at += end + 4
        n = int(headers["content-length"])
        if len(data) < at + n:
            raise ValueError("a record ends early")
        yield headers, data[at : at + n]
        at += n + 4


def http_payload(block: bytes) -> bytes:
    head, _, body = block.partition(b"\r\n\r\n")
    return dechunk(body) if re.search(rb"(?mi)^transfer-encoding:\s*chunked\s*$", head.replace(b"\r\n", b"\n")) else body


def _page_of(rid: str) -> int | None:
    m = re.fullmatch(r"<urn:page:(-?\d+)(?::[0-9a-f]+)?>", rid)
    return int(m[1]) if m else None


META = "record_id string, page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string"


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """One row per record: ``META``'s columns, ``payload`` (null for revisits) and ``problem`` (null if it is sound).

    ``payload_bytes`` and ``payload_digest`` of a response are measured on the decoded payload; those of a revisit are
    as its record states them. A missing segment or a total length or digest that doesn't agree is named in ``problem``.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content")

    def meta(h: dict[str, str]) -> list:
        return [h["warc-record-id"], _page_of(h["warc-record-id"]), unquote(h["x-page-url"], errors="surrogatepass") if "x-page-url" in h else h.get("warc-target-uri"), h["warc-type"], _page_of(h["warc-refers-to"]) if "warc-refers-to" in h else None, int(h.get("x-payload-length", -1)), h.get("warc-payload-digest", ":").split(":")[1]]

    def checked(m: list, payload: bytes | None, problem: str | None = None) -> tuple:
        if payload is not None:
            digest = hashlib.sha256(payload).hexdigest()
            problem = problem or (None if digest == m[6] else "digest")
            m = [*m[:5], len(payload), digest]
        return (*m, payload, problem)

    types = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string()]
    names = [x.split()[0] for x in META.split(", ")]

    def batch(rows: list, more: list[tuple[str, pa.DataType]]) -> pa.RecordBatch:
        cols = list(zip(*rows, strict=True)) if rows else [[]] * (len(types) + len(more))
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, [*types, *(t for _, t in more)], strict=True)], names=[*names, *(n for n, _ in more)])

    def flushed(rows_of, more):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                for data in b.column(0):
                    rows, held = [], 0
                    for h, block in parse_records(memoryview(unzipped(data.as_buffer()))):
                        if (row := rows_of(h, block)) is not None:
                            rows.append(row)
                            held += len(block)
                        if held > 8 << 20:
                            yield batch(rows, more)
                            rows, held = [], 0
                    yield batch(rows, more)

        return run

    def whole(h, block):
        if "warc-segment-number" in h:
            return None
        return checked(meta(h), None if h["warc-type"] == "revisit" else http_payload(bytes(block)))

    def segments(h, block):
        if "warc-segment-number" not in h:
            return None
        n = int(h["warc-segment-number"])
        return (*(meta(h) if n == 1 else [None] * 7), h.get("warc-segment-origin-id", h["warc-record-id"]), n, int(h.get("warc-segment-total-length", -1)), bytes(block))

    done = files.mapInArrow(flushed(whole, [("payload", pa.binary()), ("problem", pa.string())]), META + ", payload binary, problem string")
    parts = files.mapInArrow(flushed(segments, [("origin", pa.string()), ("n", pa.int64()), ("total", pa.int64()), ("block", pa.binary())]), META + ", origin string, n long, total long, block binary")
    # The segments of one record: its own length bounds the group.
    joined = parts.groupBy("origin").agg(F.max(F.when(F.col("n") == 1, F.struct(*names))).alias("m"), F.max("total").alias("total"), F.max("n").alias("last"), F.sort_array(F.collect_list(F.struct("n", "block"))).alias("parts"))

    def assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for origin, m, total, last, ps in zip(*(b.column(i) for i in range(5)), strict=True):
                m, ps = m.as_py(), ps.as_py()
                m = [origin.as_py(), _page_of(origin.as_py()), None, "response", None, None, None] if m is None else [m[k] for k in names]
                # Rows repeated in all columns have one id, and as many equal records.
                copies = max(1, sum(p["n"] == 1 for p in ps))
                block = b"".join(p["block"] for p in ps[::copies])
                if [p["n"] for p in ps] != [n for n in range(1, last.as_py() + 1) for _ in range(copies)] or len(block) != total.as_py():
                    row = (*m, None, "segments")
                else:
                    row = checked(m, http_payload(block))
                for _ in range(copies):
                    yield batch([row], [("payload", pa.binary()), ("problem", pa.string())])

    return done.unionByName(joined.select("origin", "m", "total", "last", "parts").mapInArrow(assemble, META + ", payload binary, problem string"))


def archive(pages: DataFrame) -> DataFrame:
    """Write ``pages`` as WARC files in the shared folder and read them back; see ``read_warc``. Repeated rows
    whose page_id is the least of their payload are all responses."""
    from .common import scratch_path

    path = scratch_path(pages.sparkSession, "warc")
    write_warc(with_revisits(pages), path)
    return read_warc(pages.sparkSession, path)
