"""WARC archives: writing with segmentation and chunked framing, reading by segment reassembly.

Records are text lines of Spark's own writer whose separator is the two line
ends that close a WARC record, so archives go to any store Spark writes to.
Blocks above ``segment_bytes`` are cut into continuation records.  Reading takes
whole files (bounded by ``file_records`` records of ``segment_bytes``), groups
continuation records by their origin, orders them by segment number, verifies
numbers and total length, and decodes the chunked transfer framing.

Defined results: a null payload is empty, a null URL becomes ``about:blank``; a
null id is kept as null, and records of a group whose ids are all null are all
responses; repeated rows are written as often as they come; an empty table gives
an archive without records.  Other columns are not read, so their names cannot
clash.
"""

from __future__ import annotations

import hashlib
import re
import sys
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from classbench.llm.common import materialize, read_table
from classbench.session import new_scratch_path, ship_by_value

END = b"\r\n"
CHUNK_BYTES = 8192
#: Payloads from this size on are stored once for all equal ones.
LEAST_SHARED = 1000
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_HEAD = (b"HTTP/1.1 200 OK", b"Content-Type: text/html; charset=utf-8", b"Transfer-Encoding: chunked")


def _cut(data: bytes, size: int) -> Iterator[bytes]:
    """Parts of at most ``size`` bytes that end between UTF-8 characters."""
    at = 0
    while at < len(data):
        end = min(len(data), at + size)
        while end < len(data) and data[end] & 0xC0 == 0x80:
            end -= 1
        yield data[at:end]
        at = end


def http_block(payload: bytes) -> bytes:
    """HTTP response with the payload in chunked transfer framing."""
    parts = [b"%x" % len(c) + END + c + END for c in _cut(payload, CHUNK_BYTES)]
    return END.join(HTTP_HEAD) + 2 * END + b"".join(parts) + b"0" + 2 * END


def unchunk(body: bytes) -> bytes:
    """Payload of a chunked body."""
    out, at = [], 0
    while True:
        line = body.index(END, at)
        size = int(body[at:line].split(b";")[0], 16)
        if not size:
            return b"".join(out)
        out.append(body[line + 2:line + 2 + size])
        at = line + 4 + size


def warc_record(fields: list[tuple[str, object]], block: bytes) -> str:
    """A record without the two line ends that close it."""
    head = ["WARC/1.1", *(f"{k}: {v}" for k, v in fields if v is not None), f"Content-Length: {len(block)}"]
    return "\r\n".join(head) + "\r\n\r\n" + block.decode()


def page_records(record: str, page, url: str | None, payload: bytes, digest: str, refers_to, refers_url,
                 segment_bytes: int) -> Iterator[str]:
    """Records of one page: a revisit, a response, or a response and its continuations."""
    uri = lambda u: quote(u, safe="/:?#[]@!$&'()*+,;=%~") if u else "about:blank"
    common = [("WARC-Date", "2024-01-01T00:00:00Z"), ("WARC-Target-URI", uri(url)), ("WARC-Payload-Digest", f"sha1:{digest}"),
              ("X-Page-ID", page)]
    ident = lambda k=0: f"<urn:warc:{record}{f':{k}' if k else ''}>"
    http = ("Content-Type", "application/http; msgtype=response")
    if refers_to is not None:
        yield warc_record([("WARC-Type", "revisit"), ("WARC-Record-ID", ident()), *common, http, ("WARC-Profile", PROFILE),
                           ("WARC-Refers-To-Target-URI", uri(refers_url)), ("X-Refers-To-Page", refers_to)],
                          END.join(HTTP_HEAD[:2]) + 2 * END)
        return
    block = http_block(payload)
    parts = list(_cut(block, segment_bytes))
    yield warc_record([("WARC-Type", "response"), ("WARC-Record-ID", ident()), *common, http,
                       ("WARC-Segment-Number", 1 if len(parts) > 1 else None)], parts[0])
    for k, part in enumerate(parts[1:], 2):
        yield warc_record([("WARC-Type", "continuation"), ("WARC-Record-ID", ident(k)), common[0], common[1],
                           ("WARC-Segment-Origin-ID", ident()), ("WARC-Segment-Number", k),
                           ("WARC-Segment-Total-Length", len(block) if k == len(parts) else None)], part)


def write_warc(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
               segment_bytes: int = 16_384, file_records: int = 4_000) -> None:
    """Write a record per row; of equal payloads of at least 1000 bytes only that of the largest id is stored."""
    ship_by_value(sys.modules[__name__])
    payload = F.coalesce(F.col(payload_col), F.lit(""))
    rows = pages.select(F.col(id_col).alias("page"), F.col(url_col).alias("url"), payload.alias("payload"),
                        F.sha1(payload.cast("binary")).alias("digest"), F.octet_length(payload).alias("size"))
    shared = rows.where(F.col("size") >= LEAST_SHARED).groupBy("digest").agg(
        F.max("page").alias("holder"), F.max_by("url", "page").alias("holder_url"), F.count("*").alias("n")).where("n > 1")
    # shared rows are looked up by digest; the payloads themselves stay where they are if that table is small
    linked = rows.join(shared.drop("n"), "digest", "left")
    refers = F.when(F.col("page").isNull() | (F.col("page") != F.col("holder")), F.col("holder"))
    plan = linked.select("page", "url", F.when(refers.isNull(), F.col("payload")).alias("payload"), "digest",
                         refers.alias("refers"), "holder_url")

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, made = TaskContext.get().partitionId(), 0
        for batch in batches:
            for first in range(0, batch.num_rows, 200):
                lines: list[str] = []
                for page, url, payload, digest, to, to_url in zip(*(c.to_pylist() for c in batch.slice(first, 200).columns)):
                    made += 1
                    lines += page_records(f"{task}-{made}", page, url, (payload or "").encode(), digest, to, to_url, segment_bytes)
                yield pa.RecordBatch.from_arrays([pa.array(lines, pa.string())], ["value"])

    (plan.mapInArrow(records, "value string").write.option("lineSep", "\r\n\r\n").option("compression", "gzip")
     .option("maxRecordsPerFile", file_records).text(path))


def parse_records(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Fields and block of every record of a gzip file, read as a stream."""
    unzip, data, buffer = zlib.decompressobj(47), content, b""
    while data or buffer:
        while True:  # until the buffer holds a whole record
            head = buffer.find(b"\r\n\r\n")
            if head >= 0:
                size = int(re.search(rb"(?i)\r\ncontent-length: *(\d+)", buffer[:head])[1])
                if len(buffer) >= head + 8 + size:
                    break
            if not data:
                if buffer.strip():
                    raise ValueError("the archive ends within a record")
                return
            more = unzip.decompress(data, 1 << 20)
            data = unzip.unconsumed_tail
            if unzip.eof:
                data = unzip.unused_data
                unzip = zlib.decompressobj(47)
            elif not data:
                more += unzip.flush()
            buffer += more
        lines = buffer[:head].decode().split("\r\n")[1:]
        yield dict(x.split(": ", 1) for x in lines), buffer[head + 4:head + 4 + size]
        buffer = buffer[head + 8 + size:]


def assemble(parts: list[tuple[int, int | None, bytes]]) -> bytes:
    """Block of a record from its (segment number, total length, block) parts."""
    parts = sorted(parts)
    block = b"".join(p[2] for p in parts)
    if [p[0] for p in parts] != list(range(1, len(parts) + 1)):
        raise ValueError(f"segments {[p[0] for p in parts]} are not complete")
    if len(parts) > 1 and parts[-1][1] != len(block):
        raise ValueError(f"{len(block)} bytes of {parts[-1][1]}")
    return block


RECORD = "record string, page long, type string, digest string, refers long, segment int, total long, block binary"


def archive_records(spark: SparkSession, path: str, segmented: bool) -> DataFrame:
    """Records of all files under ``path``: those in segments, or the others."""
    ship_by_value(sys.modules[__name__])
    names = ("record", "page", "type", "digest", "refers", "segment", "total", "block")
    kinds = (pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int32(), pa.int64(), pa.binary())

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = lambda f, k: int(f[k]) if k in f else None
        batch_of = lambda rows: pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)
        for batch in batches:
            for content in batch.column(0):
                rows = []
                for f, block in parse_records(content.as_py()):
                    segment = number(f, "WARC-Segment-Number")
                    if (segment is not None) == segmented:
                        rows.append((f.get("WARC-Segment-Origin-ID", f["WARC-Record-ID"]), number(f, "X-Page-ID"), f["WARC-Type"],
                                     f.get("WARC-Payload-Digest", "sha1:")[5:], number(f, "X-Refers-To-Page"), segment,
                                     number(f, "WARC-Segment-Total-Length"), block))
                    if len(rows) >= 256:
                        yield batch_of(rows)
                        rows = []
                if rows:
                    yield batch_of(rows)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("content")
    return files.mapInArrow(parse, RECORD)


def read_warc(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """(page_id, payload, payload_bytes, payload_digest, record_type, refers_to) of every record.

    The digest is computed from the payload and checked against the record; a
    revisit takes size, digest and payload of the response it refers to.
    """
    ship_by_value(sys.modules[__name__])
    head = F.when(F.col("type") != "continuation", F.struct("page", "type", "digest", "refers"))
    part = F.struct(F.coalesce("segment", F.lit(1)).alias("segment"), "total", "block")
    whole = archive_records(spark, path, False).select(head.alias("head"), F.array(part).alias("parts"))
    cut = archive_records(spark, path, True).groupBy("record").agg(
        F.max(head).alias("head"), F.collect_list(part).alias("parts")).select("head", "parts")  # one page's segments
    names = ("page_id", "payload", "payload_bytes", "payload_digest", "record_type", "refers_to")
    kinds = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64())

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for h, parts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                block = assemble([(p["segment"], p["total"], p["block"]) for p in parts])
                payload = size = None
                digest = h["digest"]
                if h["type"] == "response":
                    http, _, body = block.partition(2 * END)
                    payload = unchunk(body) if b"chunked" in http.lower() else body
                    digest, size = hashlib.sha1(payload).hexdigest(), len(payload)
                    if digest != h["digest"]:
                        raise ValueError(f"page {h['page']}: digest {digest}, recorded {h['digest']}")
                    payload = payload.decode() if with_payload else None
                rows.append((h["page"], payload, size, digest, h["type"], h["refers"]))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    out = "page_id long, payload string, payload_bytes long, payload_digest string, record_type string, refers_to long"
    records = materialize(whole.union(cut).mapInArrow(decode, out), "records")
    held = records.where("record_type = 'response' and payload_bytes >= 1000").dropDuplicates(["page_id", "payload_digest"]).select(
        F.col("page_id").alias("refers_to"), "payload", "payload_bytes", "payload_digest")
    stored = records.where("record_type = 'response'")
    again = records.where("record_type <> 'response'").select("page_id", "record_type", "refers_to", "payload_digest").join(
        held, ["refers_to", "payload_digest"])  # a page id may hold several payloads
    return stored.unionByName(again.select(*names))


def op9_warc(spark, sf_dir) -> DataFrame:
    """Write every page to an archive in the shared folder, then read the archive back."""
    path = new_scratch_path(spark, "warc")
    write_warc(read_table(spark, sf_dir, "pages"), path)
    return read_warc(spark, path, with_payload=False).drop("payload")
