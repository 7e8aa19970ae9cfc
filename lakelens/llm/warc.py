"""Web archives: WARC records written and read by Spark, with segment reassembly.

Writing: each page becomes a ``response`` record (an HTTP message in chunked framing) or,
where an equal payload is kept elsewhere, a ``revisit`` record.  Blocks longer than a segment
are split into a first record and ``continuation`` records.  Archives of bounded size are
packed in tasks and written by Spark's text writer (one archive a file, gzip), so task retries
and the file system are Spark's.

Reading: archives come through the binary file source, records are cut by Content-Length,
continuations are grouped by origin identifier, ordered by segment number, checked for gaps
and against the total length, and the chunked framing is decoded.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakelens.llm.common import prepare
from lakelens.session import work_path

#: bytes of an archive before compression, of a record block before it is segmented, of an HTTP chunk
ARCHIVE_BYTES, SEGMENT_BYTES, CHUNK_BYTES = 8 << 20, 32 << 10, 8 << 10
#: equal payloads shorter than this are stored again rather than revisited
MIN_REVISIT_BYTES = 100
_END = b"\r\n\r\n"
_ID = "urn:lakelens:record:"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def chunked(payload: bytes, size: int = CHUNK_BYTES) -> bytes:
    """``payload`` in HTTP chunked transfer framing."""
    parts = []
    for at in range(0, len(payload), size):
        part = payload[at:at + size]
        parts += [b"%x\r\n" % len(part), part, b"\r\n"]
    return b"".join([*parts, b"0\r\n\r\n"])


def unchunked(body: bytes) -> bytes:
    """Payload of a chunked body; raises ValueError where the framing is broken."""
    parts, at = [], 0
    while True:
        end = body.find(b"\r\n", at)
        if end < 0:
            raise ValueError("chunk size missing")
        size = int(body[at:end].split(b";")[0], 16)
        if not size:
            return b"".join(parts)
        at = end + 2
        if len(body) < at + size + 2 or body[at + size:at + size + 2] != b"\r\n":
            raise ValueError("chunk cut short")
        parts.append(body[at:at + size])
        at += size + 2


def http_payload(block: bytes) -> bytes:
    """Body of an HTTP message, its chunked framing decoded."""
    head, _, body = block.partition(_END)
    if re.search(rb"(?im)^transfer-encoding:[^\r\n]*chunked", head):
        return unchunked(body)
    return body


def _line(value: str) -> str:
    """A header value: control characters, which would end the line, are percent-encoded."""
    return re.sub(r"[\x00-\x1f\x7f]", lambda m: f"%{ord(m[0]):02X}", value)


def record(headers: dict[str, str | int | None], block: bytes) -> bytes:
    """One WARC record without the two line ends after its block; None headers are left out."""
    lines = ["WARC/1.1", *(f"{k}: {_line(str(v))}" for k, v in headers.items() if v is not None),
             f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(lines).encode() + block


def page_records(name: str, page_id: int | None, url: str | None, payload: bytes, digest: str,
                 refers_to: int | None, segment_bytes: int = SEGMENT_BYTES,
                 chunk_bytes: int = CHUNK_BYTES) -> Iterator[bytes]:
    """Records of one page: a revisit, or a response followed by its continuations."""
    common = {"WARC-Record-ID": f"<{_ID}{name}>", "X-Page-Id": page_id, "WARC-Target-URI": url,
              "WARC-Payload-Digest": f"sha256:{digest}", "Content-Type": "application/http;msgtype=response"}
    head = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
    if refers_to is not None:
        block = f"{head}Content-Length: {len(payload)}\r\n\r\n".encode()
        yield record({"WARC-Type": "revisit", **common, "WARC-Profile": _PROFILE, "X-Refers-To-Page-Id": refers_to}, block)
        return
    block = f"{head}Transfer-Encoding: chunked\r\n\r\n".encode() + chunked(payload, chunk_bytes)
    if len(block) <= segment_bytes:
        yield record({"WARC-Type": "response", **common}, block)
        return
    count = -(-len(block) // segment_bytes)
    for i in range(count):
        part = block[i * segment_bytes:(i + 1) * segment_bytes]
        total = len(block) if i == count - 1 else None
        if not i:
            yield record({"WARC-Type": "response", **common, "WARC-Segment-Number": 1}, part)
        else:
            yield record({"WARC-Type": "continuation", "WARC-Record-ID": f"<{_ID}{name}-{i + 1}>",
                          "WARC-Segment-Origin-ID": f"<{_ID}{name}>", "WARC-Segment-Number": i + 1,
                          "WARC-Segment-Total-Length": total}, part)


def _packer(archive_bytes: int, segment_bytes: int, chunk_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        held: list[bytes] = []
        size = n = 0

        def archive() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([_END.join(held)], pa.binary())], names=["archive"])
        for batch in batches:
            for page, url, html, digest, refers in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                payload = (html or "").encode("utf-8", "surrogatepass")
                for rec in page_records(f"{task}-{n}", page, url, payload, digest, refers, segment_bytes, chunk_bytes):
                    if held and size + len(rec) > archive_bytes:
                        yield archive()
                        held, size = [], 0
                    held.append(rec)
                    size += len(rec) + 4
                n += 1
        if held:
            yield archive()
    return run


def write_archives(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url",
                   payload_col: str = "html", archive_bytes: int = ARCHIVE_BYTES,
                   segment_bytes: int = SEGMENT_BYTES, chunk_bytes: int = CHUNK_BYTES,
                   min_revisit_bytes: int = MIN_REVISIT_BYTES) -> None:
    """Write one response or revisit (with its continuations) for every row of ``pages``.

    Of rows with equal payloads of at least ``min_revisit_bytes`` those with the smallest id
    are responses, the others revisit it; a null id is never the smallest, and rows that share
    the smallest id (repeated rows) are all responses.  Null payloads are empty, null urls
    and ids leave their header out.  An empty table writes no archive.

    The payloads cross one shuffle at most: the join with the smallest ids of payloads that
    occur more than once, one row for each, whose skew AQE splits.
    """
    prepare(pages.sparkSession)
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(payload_col).alias("payload"))
    rows = rows.withColumn("digest", F.sha2(F.coalesce("payload", F.lit("")).cast("binary"), 256))
    kept = (rows.filter(F.octet_length("payload") >= min_revisit_bytes).groupBy("digest")
            .agg(F.min("id").alias("low"), F.count(F.lit(1)).alias("n")).filter("n > 1 and low is not null"))
    joined = rows.join(kept.select("digest", "low").hint("shuffle_hash"), "digest", "left")
    refers = F.when(~F.col("id").eqNullSafe(F.col("low")), F.col("low"))
    packed = (joined.select("id", "url", "payload", "digest", refers.alias("refers"))
              .mapInArrow(_packer(archive_bytes, segment_bytes, chunk_bytes), "archive binary"))
    (packed.select(F.col("archive").cast("string").alias("value")).write
     .option("lineSep", "\r\n\r\n").option("maxRecordsPerFile", 1).option("compression", "gzip").text(path))


def _plain(data: bytes) -> Iterator[bytes]:
    """Decompressed pieces of one or more gzip members; data that is not gzip as it is."""
    if data[:2] != b"\x1f\x8b":
        yield data
        return
    while data:
        member = zlib.decompressobj(31)
        for at in range(0, len(data), 1 << 20):
            yield member.decompress(data[at:at + (1 << 20)])
            if member.eof:
                data = member.unused_data + data[at + (1 << 20):]
                break
        else:
            return


def parse_archive(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers with lower-case names, block) of every record, cut by Content-Length."""
    plain = b"".join(_plain(data))
    at = 0
    while True:
        while plain[at:at + 2] == b"\r\n":
            at += 2
        end = plain.find(_END, at)
        if end < 0:
            return
        first, *lines = plain[at:end].decode("utf-8", "replace").split("\r\n")
        if not first.startswith("WARC/"):
            raise ValueError("no WARC record where one must begin")
        headers = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}
        size = int(headers["content-length"])
        block = plain[end + 4:end + 4 + size]
        if len(block) != size:
            raise ValueError("record cut short")
        yield headers, block
        at = end + 4 + size


RECORD_TYPE = ("record_id string, warc_type string, page_id long, url string, payload_digest string, "
               "refers_to long, origin string, segment int, total long, block binary")
_FIELDS = ("warc-record-id", "warc-type", "x-page-id", "warc-target-uri", "warc-payload-digest",
           "x-refers-to-page-id", "warc-segment-origin-id", "warc-segment-number", "warc-segment-total-length")
_SCHEMA = pa.schema([("record_id", pa.string()), ("warc_type", pa.string()), ("page_id", pa.int64()),
                     ("url", pa.string()), ("payload_digest", pa.string()), ("refers_to", pa.int64()),
                     ("origin", pa.string()), ("segment", pa.int32()), ("total", pa.int64()), ("block", pa.binary())])


def _parser(segmented: bool, batch_bytes: int = 4 << 20):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content"):
                rows, size = [], 0
                for headers, block in parse_archive(content.as_py()):
                    if ("warc-segment-number" in headers) != segmented:
                        continue
                    v = [headers.get(f) for f in _FIELDS]
                    rows.append((v[0], v[1], v[2] and int(v[2]), v[3], v[4], v[5] and int(v[5]),
                                 v[6] or v[0], v[7] and int(v[7]), v[8] and int(v[8]), block))
                    size += len(block)
                    if size >= batch_bytes:
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _SCHEMA.types, strict=True)], schema=_SCHEMA)
                        rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _SCHEMA.types, strict=True)], schema=_SCHEMA)
    return run


def read_records(spark: SparkSession, path: str, segmented: bool) -> DataFrame:
    """Records of all archives under ``path``: those in segments, or those in one piece."""
    prepare(spark)
    files = spark.read.format("binaryFile").load(path).select("content")
    return files.mapInArrow(_parser(segmented), RECORD_TYPE)


def reassemble(records: DataFrame) -> DataFrame:
    """Segmented records joined to whole ones: the first segment's fields and the whole ``block``.

    Records are grouped by origin identifier and ordered by segment number.  ``error`` is null,
    or says what is wrong: segments that are missing or repeated, no total length, or a total
    length that the blocks do not add up to; ``block`` is null then.
    """
    segments = F.array_sort(F.collect_list(F.struct("segment", "block")))
    grouped = records.groupBy("origin").agg(
        segments.alias("parts"), F.max("total").alias("total"),
        *[F.max(F.when(F.col("segment") == 1, F.col(c))).alias(c)
          for c in ("record_id", "warc_type", "page_id", "url", "payload_digest", "refers_to")])

    def run(parts: pa.Array, totals: pa.Array) -> pa.Array:
        blocks, errors = [], []
        for segs, total in zip(parts.to_pylist(), totals.to_pylist(), strict=True):
            numbers, size = [s["segment"] for s in segs], sum(len(s["block"]) for s in segs)
            if numbers != list(range(1, len(segs) + 1)):
                error = "segments missing or repeated"
            elif total is None:
                error = "no total length"
            elif size != total:
                error = "total length differs"
            else:
                error = None
            errors.append(error)
            blocks.append(b"".join(s["block"] for s in segs) if error is None else None)
        return pa.StructArray.from_arrays([pa.array(blocks, pa.binary()), pa.array(errors, pa.string())], names=["block", "error"])
    whole = F.arrow_udf(run, "struct<block: binary, error: string>")("parts", "total")
    out = grouped.withColumn("whole", whole)
    return out.select("record_id", "warc_type", "page_id", "url", "payload_digest", "refers_to", "whole.block", "whole.error")


def payload_column(block: str | Column) -> Column:
    """Arrow function: decoded HTTP payload of each block, null where its framing is broken."""
    def run(blocks: pa.Array) -> pa.Array:
        out = []
        for b in blocks:
            try:
                out.append(None if b.as_py() is None else http_payload(b.as_py()))
            except ValueError:
                out.append(None)
        return pa.array(out, pa.binary())
    return F.arrow_udf(run, "binary")(block)


def summary_column(block: str | Column) -> Column:
    """Arrow function: length and hex SHA-256 of the decoded HTTP payload of each block."""
    def run(blocks: pa.Array) -> pa.Array:
        sizes, digests = [], []
        for b in blocks:
            try:
                payload = http_payload(b.as_py()) if b.is_valid else None
            except ValueError:
                payload = None
            sizes.append(None if payload is None else len(payload))
            digests.append(None if payload is None else hashlib.sha256(payload).hexdigest())
        return pa.StructArray.from_arrays([pa.array(sizes, pa.int64()), pa.array(digests, pa.string())], names=["bytes", "sha256"])
    return F.arrow_udf(run, "struct<bytes: bigint, sha256: string>")(block)


def read_entities(spark: SparkSession, path: str) -> DataFrame:
    """Every response and revisit under ``path``, whole: record fields, ``block`` and ``error``.

    Payloads are ``payload_column("block")``; a revisit's block is its HTTP head, which states
    the length of the payload it stands for.
    """
    names = ["record_id", "warc_type", "page_id", "url", "payload_digest", "refers_to", "block"]
    single = read_records(spark, path, False).select(*names, F.lit(None).cast("string").alias("error"))
    return single.unionByName(reassemble(read_records(spark, path, True)))


def round_trip(pages: DataFrame, **kwargs) -> DataFrame:
    """Write ``pages`` as archives, read them back: page_id, payload_bytes, payload_digest, record_type, refers_to.

    ``payload_bytes`` and ``payload_digest`` of responses are taken from the decoded payload;
    those of revisits from the record's head and payload digest.  ``verified`` is whether the
    payload read has the digest that its record states (true for revisits).
    """
    spark = pages.sparkSession
    path = work_path(spark, "warc")
    write_archives(pages, path, **kwargs)
    read = read_entities(spark, path)
    stated = F.regexp_replace("payload_digest", "^sha256:", "")
    revisit = F.col("warc_type") == "revisit"
    head = F.regexp_extract(F.when(revisit, F.col("block").cast("string")), r"Content-Length: (\d+)", 1)
    rows = read.select("page_id", "warc_type", "refers_to", stated.alias("stated"), head.alias("length"),
                       summary_column("block").alias("s"))
    revisit = F.col("warc_type") == "revisit"
    return rows.select("page_id", F.when(revisit, F.col("length").cast("long")).otherwise(F.col("s.bytes")).alias("payload_bytes"),
                       F.when(revisit, F.col("stated")).otherwise(F.col("s.sha256")).alias("payload_digest"),
                       F.col("warc_type").alias("record_type"), "refers_to",
                       (revisit | F.col("s.sha256").eqNullSafe(F.col("stated"))).alias("verified"))
