"""WARC archives: writing with revisit records and segmented records, reading with reassembly.

Writing: of pages with equal payloads the one with the largest id becomes a ``response``, the others
``revisit`` records that refer to it. A response block (HTTP head and the payload in chunked transfer
framing) of more than ``segment_bytes`` becomes a first segment and ``continuation`` records.
Archives are gzip files written by Spark's own text writer, so any file system of the cluster will do.
No block is longer than ``segment_bytes``, so a file of ``archive_bytes // segment_bytes`` records is bounded in
bytes (headers aside), whatever the pages hold; the segments of a page may lie in several files.

Reading: archives are parsed once, record by record as streams, and the records stored. Whole records are
decoded where they lie; only segments are shuffled: continuations are grouped by the origin's record id, ordered by
segment number, checked against the stated total length, joined, and then freed of the chunked framing.

Defined cases: a null payload is empty; a null page id is written without id and read back as null;
rows equal in id and payload are all responses; url may be null; a record whose segments are missing
or whose length is wrong comes back with ``complete`` false and no payload; no pages give no archive.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortgraph.llm import common

SEGMENT_BYTES = 32 << 10
CHUNK_BYTES = 4 << 10
ARCHIVE_BYTES = 64 << 20
DATE = "2026-01-01T00:00:00Z"
_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
_RECORD = ("kind string, record_id string, page_id string, url string, refers_to string, digest string, "
           "segment int, origin string, total long, block binary")


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def chunked(payload: bytes, size: int = CHUNK_BYTES) -> bytes:
    parts = [payload[i : i + size] for i in range(0, len(payload), size)]
    return b"".join([b"%x\r\n%s\r\n" % (len(p), p) for p in parts]) + b"0\r\n\r\n"


def unchunked(body: bytes) -> bytes | None:
    """The payload of a chunked body, None if the framing is broken."""
    out, at = [], 0
    while True:
        line = body.find(b"\r\n", at)
        if line < 0:
            return None
        try:
            size = int(body[at:line].split(b";")[0], 16)
        except ValueError:
            return None
        if size == 0:
            return b"".join(out)
        at = line + 2 + size
        if body[at : at + 2] != b"\r\n":
            return None
        out.append(body[line + 2 : at])
        at += 2


def block_payload(block: bytes) -> bytes | None:
    """The payload of an HTTP response block."""
    head, gap, body = block.partition(b"\r\n\r\n")
    if not gap:
        return None
    return unchunked(body) if b"transfer-encoding: chunked" in head.lower() else body


def _record(fields: list[tuple[str, object]], block: bytes) -> bytes:
    """A record without the two line ends that close it."""
    lines = "".join(f"{k}: {v}\r\n" for k, v in [*fields, ("Content-Length", len(block))] if v is not None)
    return b"WARC/1.1\r\n" + lines.encode() + b"\r\n" + block


def _line(text: str | None) -> str | None:
    """Header text without line ends."""
    return None if text is None else " ".join(text.split())


def record_id(page_id: object, digest: str) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}:{digest}>"


def page_records(page_id: object, url: str | None, payload: bytes, keeper: object, revisit: bool, segment_bytes: int) -> Iterator[bytes]:
    """The records of one page."""
    digest = payload_digest(payload)
    own = record_id(page_id, digest)
    fields = [("WARC-Record-ID", own), ("WARC-Date", DATE), ("WARC-Target-URI", _line(url)),
              ("WARC-Payload-Digest", f"sha1:{digest}"), ("Page-ID", page_id), ("Content-Type", "application/http; msgtype=response")]
    if revisit:
        refers = [("WARC-Refers-To", record_id(keeper, digest)), ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")]
        yield _record([("WARC-Type", "revisit"), *fields, *refers], _HEAD + b"\r\n")
        return
    block = _HEAD + b"Transfer-Encoding: chunked\r\n\r\n" + chunked(payload)
    parts = [block[i : i + segment_bytes] for i in range(0, len(block), segment_bytes)]
    if len(parts) == 1:
        yield _record([("WARC-Type", "response"), *fields], block)
        return
    yield _record([("WARC-Type", "response"), *fields, ("WARC-Segment-Number", 1)], parts[0])
    for k, part in enumerate(parts[1:], 2):
        last = [("WARC-Segment-Total-Length", len(block))] if k == len(parts) else []
        yield _record([("WARC-Type", "continuation"), ("WARC-Record-ID", f"{own[:-1]}:{k}>"), ("WARC-Date", DATE),
                       ("WARC-Segment-Origin-ID", own), ("WARC-Segment-Number", k), *last], part)


def write(pages: DataFrame, path: str, *, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", least_bytes: int = 0,
          segment_bytes: int = SEGMENT_BYTES, archive_bytes: int = ARCHIVE_BYTES) -> None:
    """Write the archives. Payloads of fewer than ``least_bytes`` are never revisits."""
    source = pages.select(F.col(f"`{id_col}`").alias("page_id"), F.col(f"`{url_col}`").cast("string").alias("url"),
                          F.coalesce(F.col(f"`{payload_col}`").cast("binary"), F.lit(b"")).alias("payload"))
    keyed = source.withColumn("sha", F.unhex(F.sha1("payload")))
    # only the id and the digest are read here; equal payloads meet as one row a task
    # stored, so that the join deals out both sides itself and can split a payload that many pages share
    keepers = common.stored(keyed.groupBy("sha").agg(F.max("page_id").alias("keeper")), "warc-keepers")
    flagged = keyed.join(keepers, "sha").select(
        "page_id", "url", "payload", "keeper",
        (~F.col("page_id").eqNullSafe(F.col("keeper")) & (F.octet_length("payload") >= least_bytes)).alias("revisit"))

    def make():
        def step(part: pa.RecordBatch) -> pa.RecordBatch:
            rows = zip(*(part.column(c).to_pylist() for c in ("page_id", "url", "payload", "keeper", "revisit")), strict=True)
            return pa.RecordBatch.from_arrays([pa.array([x for r in rows for x in page_records(*r, segment_bytes)], pa.binary())], names=["record"])

        return step

    records = common.map_arrow(flagged, make, "record binary", "payload")
    writer = records.select(F.col("record").cast("string").alias("value")).write
    writer.option("lineSep", "\r\n\r\n").option("compression", "gzip").option("maxRecordsPerFile", max(1, archive_bytes // segment_bytes)).text(path)


def parse(stream: io.BufferedIOBase) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header fields in lower case, block) of each record."""
    while line := stream.readline():
        if not line.startswith(b"WARC/"):
            continue
        fields = {}
        while (line := stream.readline().rstrip(b"\r\n")):
            name, _, value = line.partition(b":")
            fields[name.strip().lower().decode()] = value.strip().decode("utf-8", "replace")
        yield fields, stream.read(int(fields.get("content-length", 0)))


def records(spark: SparkSession, path: str) -> DataFrame:
    """The records of all archives below ``path``."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("content")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("kind", pa.string()), ("record_id", pa.string()), ("page_id", pa.string()), ("url", pa.string()), ("refers_to", pa.string()),
                            ("digest", pa.string()), ("segment", pa.int32()), ("origin", pa.string()), ("total", pa.int64()), ("block", pa.binary())])
        for batch in batches:
            for content in batch.column("content"):
                rows, size = [], 0
                for f, block in parse(io.BufferedReader(gzip.GzipFile(fileobj=io.BytesIO(content.as_py())))):
                    number = f.get("warc-segment-number")
                    digest = f.get("warc-payload-digest")
                    rows.append((f["warc-type"], f.get("warc-record-id"), f.get("page-id"), f.get("warc-target-uri"), f.get("warc-refers-to"),
                                 digest and digest.rpartition(":")[2], number and int(number), f.get("warc-segment-origin-id"),
                                 int(f["warc-segment-total-length"]) if "warc-segment-total-length" in f else None, block))
                    size += len(block)
                    if size >= common.SLICE_BYTES:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)
                        rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

    return files.mapInArrow(run, _RECORD)


def reassembled(segments: DataFrame) -> DataFrame:
    """First segments with their continuations joined; block is null where the total length does not fit."""
    first = segments.filter("kind <> 'continuation'")
    rest = segments.filter("kind = 'continuation'").groupBy("origin", "segment").agg(F.first("block").alias("block"), F.max("total").alias("total"))
    rest = rest.groupBy(F.col("origin").alias("record_id")).agg(
        F.sort_array(F.collect_list(F.struct("segment", "block"))).alias("parts"), F.max("total").alias("length"))
    joined = first.drop("total").join(rest, "record_id", "left")
    block = F.aggregate("parts", F.col("block"), lambda a, x: F.concat(a, x["block"]))
    in_order = F.transform("parts", lambda x: x["segment"]) == F.sequence(F.lit(2), F.size("parts") + 1)
    return joined.withColumn("block", F.when(in_order & (F.octet_length(block) == F.col("length")), block)).drop("parts", "length")


def read(spark: SparkSession, path: str) -> DataFrame:
    """For each page record: kind, record_id, page_id (text), url, refers_to (record id), digest, payload (null for revisits), complete."""
    found = common.stored(records(spark, path), "warc-records")
    whole = found.filter("segment IS NULL AND kind IN ('response', 'revisit')").drop("total")
    parts = reassembled(found.filter("segment IS NOT NULL")).select(whole.columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in common.cut(batch, "block"):
                payloads = [None if k == "revisit" or b is None else block_payload(b) for k, b in zip(part.column("kind").to_pylist(), part.column("block").to_pylist(), strict=True)]
                digests = part.column("digest").to_pylist()
                right = [k == "revisit" or (p is not None and payload_digest(p) == d) for k, p, d in zip(part.column("kind").to_pylist(), payloads, digests, strict=True)]
                names = ["kind", "record_id", "page_id", "url", "refers_to", "digest"]
                yield pa.RecordBatch.from_arrays([*(part.column(n) for n in names), pa.array(payloads, pa.binary()), pa.array(right, pa.bool_())], names=[*names, "payload", "complete"])

    return whole.unionByName(parts).mapInArrow(
        run, "kind string, record_id string, page_id string, url string, refers_to string, digest string, payload binary, complete boolean")


def round_trip(pages: DataFrame, path: str, *, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", least_bytes: int = 0,
               segment_bytes: int = SEGMENT_BYTES, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write the archives to ``path`` and describe each page as read back: page_id, payload_bytes, payload_digest, record_type, refers_to."""
    write(pages, path, id_col=id_col, url_col=url_col, payload_col=payload_col, least_bytes=least_bytes, segment_bytes=segment_bytes, archive_bytes=archive_bytes)
    kind = pages.schema[id_col].dataType
    back = read(pages.sparkSession, path).select(
        "kind", "record_id", F.col("page_id").cast(kind).alias("page_id"), "refers_to", "digest", F.octet_length("payload").cast("long").alias("payload_bytes"))
    back = common.stored(back, "warc-index")
    responses = back.filter("kind = 'response'")
    targets = common.stored(responses.groupBy(F.col("record_id").alias("refers_to")).agg(F.first("page_id").alias("target"), F.first("payload_bytes").alias("target_bytes")), "warc-targets")
    own = responses.select("page_id", "payload_bytes", F.col("digest").alias("payload_digest"), F.lit("response").alias("record_type"), F.lit(None).cast(kind).alias("refers_to"))
    again = back.filter("kind = 'revisit'").join(targets, "refers_to", "left").select(
        "page_id", F.col("target_bytes").alias("payload_bytes"), F.col("digest").alias("payload_digest"), F.lit("revisit").alias("record_type"), F.col("target").alias("refers_to"))
    return own.unionByName(again)


def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(common.table(spark, sf_dir, "pages"), common.folder(spark, "warc"))
