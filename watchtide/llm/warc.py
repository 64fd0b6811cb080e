"""WARC archives: writing records in segments, and reassembling them.

The writer makes one record per page: an HTTP response with the payload in chunked
transfer framing, or a revisit of the record that holds an equal payload. A block longer
than ``segment_bytes`` becomes a response record with segment 1 and continuation records
for the others. Archives are written by Spark's text writer, whose line separator is the
two line ends that close a record, so tasks commit whole files and lost ones are redone.

The reader parses archives record by record, groups continuations by their origin's
identifier, orders them by segment number, verifies that no segment is missing and that
the parts add up to the stated total length, and decodes the chunked framing.

Defined cases: NULL html is an empty payload; a NULL url gives no target header; NULL
page ids come last when the smallest is sought; of rows with equal id and payload one is
the response; an empty table writes no record and gives no rows; other columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from watchtide.llm.common import cut, scratch

END = "\r\n\r\n"
MIN_SHARED = 100         # bytes of payload from which equal payloads are stored once
SEGMENT_BYTES = 8192
CHUNK_BYTES = 2048       # of the transfer framing
RECORDS_PER_FILE = 2000  # so that an archive holds RECORDS_PER_FILE * SEGMENT_BYTES and headers at most
_DATE = "2024-01-01T00:00:00Z"
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def chunked(payload: bytes, size: int = CHUNK_BYTES) -> bytes:
    parts = [b"%x\r\n%b\r\n" % (len(c), c) for c in (payload[i:i + size] for i in range(0, len(payload), size))]
    return b"".join(parts) + b"0\r\n\r\n"


def dechunked(body: bytes) -> bytes:
    """The payload of a body in chunked framing; ValueError if the framing is broken."""
    out, at = [], 0
    while True:
        end = body.index(b"\r\n", at)
        size = int(body[at:end].split(b";")[0], 16)
        if size == 0:
            return b"".join(out)
        at = end + 2 + size
        if body[at:at + 2] != b"\r\n":
            raise ValueError("chunk without end")
        out.append(body[end + 2:at])
        at += 2


def _header(text: str | None) -> str | None:
    """A header value on one line: control characters are percent-encoded."""
    return None if text is None else re.sub(r"[\x00-\x1f\x7f]", lambda m: f"%{ord(m[0]):02X}", text)


def _record(kind: str, fields: dict[str, object], block: bytes) -> bytes:
    head = {"WARC-Type": kind, **fields, "WARC-Date": _DATE, "Content-Length": len(block)}
    lines = "".join(f"{k}: {v}\r\n" for k, v in head.items() if v is not None)
    return f"WARC/1.1\r\n{lines}\r\n".encode() + block


def page_records(rid: str, url: str | None, payload: bytes, digest: str, refers: str | None, segment_bytes: int) -> list[bytes]:
    """The records of one page, each without the line ends that close it."""
    common = {"WARC-Record-ID": f"<{rid}>", "WARC-Target-URI": _header(url), "WARC-Payload-Digest": f"sha256:{digest}",
              "Content-Type": "application/http;msgtype=response"}
    if refers is not None:
        return [_record("revisit", {**common, "WARC-Refers-To": f"<{refers}>", "WARC-Profile": _PROFILE}, b"")]
    block = _HTTP + chunked(payload)
    parts = [block[i:i + segment_bytes] for i in range(0, len(block), segment_bytes)]
    if len(parts) == 1:
        return [_record("response", common, block)]
    out = [_record("response", {**common, "WARC-Segment-Number": 1}, parts[0])]
    for n, part in enumerate(parts[1:], 2):
        total = len(block) if n == len(parts) else None
        out.append(_record("continuation", {"WARC-Record-ID": f"<{rid}:{n}>", "WARC-Segment-Origin-ID": f"<{rid}>", "WARC-Segment-Number": n,
                                            "WARC-Segment-Total-Length": total}, part))
    return out


def write_warc(pages: DataFrame, path: str, segment_bytes: int = SEGMENT_BYTES) -> None:
    """Write the archives of ``pages`` (page_id, url, html) below ``path``."""
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", F.encode(F.coalesce("html", F.lit("")), "UTF-8").alias("payload"),
                        F.monotonically_increasing_id().alias("_row"))
    rows = (rows.withColumn("digest", F.sha2("payload", 256))
            .withColumn("rid", F.concat(F.lit("urn:page:"), F.coalesce(F.col("page_id").cast("string"), F.lit("null")), F.lit(":"), F.col("_row"))))
    # The smallest id of each payload stored more than once; a row per payload, made of sums per task.
    shared = (rows.where(F.octet_length("payload") >= MIN_SHARED).groupBy(F.col("digest").alias("_digest"))
              .agg(F.min(F.struct(F.col("page_id").isNull().alias("n"), "page_id", "_row", "rid")).alias("_first"), F.count(F.lit(1)).alias("_n"))
              .where("_n > 1").select("_digest", F.col("_first.rid").alias("_first")))
    # One payload may be a third of all: as a table of its own it can meet a split side.
    shared = cut(shared, "warc-shared")
    rows = (rows.join(shared, F.col("digest") == F.col("_digest"), "left")
            .withColumn("refers", F.when(F.col("_first") != F.col("rid"), F.col("_first")))
            .select("rid", "url", F.when(F.col("refers").isNull(), F.col("payload")).alias("payload"), "digest", "refers"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: list[bytes] = []
            for rid, url, payload, digest, refers in zip(*(c.to_pylist() for c in b.columns), strict=True):
                out += page_records(rid, url, payload or b"", digest, refers, segment_bytes)
                if sum(map(len, out[-64:])) > 1 << 20 or len(out) > 1000:
                    yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["record"])
                    out = []
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["record"])

    (rows.mapInArrow(run, "record binary").select(F.col("record").cast("string").alias("value"))
     .write.option("lineSep", END).option("maxRecordsPerFile", RECORDS_PER_FILE)
     .option("compression", "gzip").option("zlib.compress.level", "BEST_SPEED").text(path))


def unpacked(content: bytes) -> bytes:
    """The bytes of a gzip file of any number of members; ValueError if the last isn't whole."""
    out = []
    while content.strip(b"\0"):
        member = zlib.decompressobj(31)
        out.append(member.decompress(content))
        if not member.eof:
            raise ValueError("an archive ends within a member")
        content = member.unused_data
    return b"".join(out)


def parse(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields (names in lower case) and block of every record of an archive's bytes."""
    at = 0
    while (at := data.find(b"WARC/", at)) >= 0:
        end = data.index(END.encode(), at)
        lines = (x.partition(":") for x in data[at:end].decode(errors="replace").split("\r\n")[1:])
        fields = {k.strip().lower(): v.strip() for k, _, v in lines}
        start = end + 4
        at = start + int(fields["content-length"])
        yield fields, data[start:at]
        at += 4


_RECORDS = ("record_id string, kind string, url string, digest string, refers_to string, "
            "origin string, segment int, total long, block binary")


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """Every record of the archives below ``path``, segments apart."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([(n, t) for n, t in zip(
            ("record_id", "kind", "url", "digest", "refers_to", "origin", "segment", "total", "block"),
            (pa.string(),) * 6 + (pa.int32(), pa.int64(), pa.binary()), strict=True)])
        for b in batches:
            for name, content in zip(*(c.to_pylist() for c in b.columns), strict=True):
                data = unpacked(content) if name.endswith(".gz") else content
                rows, size = [], 0
                for f, block in parse(data):
                    bare = lambda k, f=f: f[k].strip("<>") if k in f else None
                    rows.append((bare("warc-record-id"), f["warc-type"], f.get("warc-target-uri"), f.get("warc-payload-digest", "").removeprefix("sha256:"),
                                 bare("warc-refers-to"), bare("warc-segment-origin-id"), int(f.get("warc-segment-number", 0)),
                                 int(f["warc-segment-total-length"]) if "warc-segment-total-length" in f else None, block))
                    size += len(block)
                    if size > 1 << 22:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)
                        rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("path", "content")
    return files.mapInArrow(run, _RECORDS)


def reassemble(records: DataFrame) -> DataFrame:
    """One row per whole record: record_id, kind, url, digest, refers_to, block, complete.

    Only segments move. ``complete`` is false, and the block NULL, if a segment is missing
    or repeated, or if the parts don't add up to the total length.
    """
    cols = ["record_id", "kind", "url", "digest", "refers_to"]
    single = records.where("segment = 0").select(*cols, "block", F.lit(True).alias("complete"))
    head = F.when(F.col("segment") == 1, F.struct("kind", "url", "digest", "refers_to"))
    parts = (records.where("segment > 0").groupBy(F.coalesce("origin", "record_id").alias("record_id"))
             .agg(F.sort_array(F.collect_list(F.struct("segment", "block"))).alias("parts"), F.max("total").alias("total"),
                  F.max(head).alias("head"), F.max("segment").alias("last")))
    length = F.aggregate("parts", F.lit(0).cast("long"), lambda a, p: a + F.octet_length(p["block"]))
    whole = ((F.size("parts") == F.col("last")) & (F.element_at("parts", 1)["segment"] == 1) & (length == F.col("total"))
             & (F.size(F.array_distinct(F.col("parts.segment"))) == F.col("last")))
    whole = F.coalesce(whole, F.lit(False))
    joined = parts.select("record_id", *[F.col(f"head.{c}").alias(c) for c in cols[1:]],
                          F.when(whole, F.col("parts")).alias("parts"), whole.alias("complete"))
    return single.unionByName(joined.select(*cols, F.expr("cast(array_join(transform(parts, p -> cast(p.block as string)), '') as binary)").alias("block"), "complete"))


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """record_id, kind, url, digest, refers_to, payload, complete of every page's record.

    ``payload`` is NULL for revisits and for records that aren't complete or whose framing is broken.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            payloads: list[bytes | None] = []
            whole = []
            for kind, block, complete in zip(*(b.column(c).to_pylist() for c in ("kind", "block", "complete")), strict=True):
                payload = None
                if kind == "response" and block is not None:
                    head, _, body = block.partition(END.encode())
                    try:
                        payload = dechunked(body) if b"transfer-encoding: chunked" in head.lower() else body
                    except ValueError:
                        complete = False
                payloads.append(payload)
                whole.append(complete)
            yield pa.RecordBatch.from_arrays(
                [*(b.column(c) for c in ("record_id", "kind", "url", "digest", "refers_to")), pa.array(payloads, pa.binary()), pa.array(whole, pa.bool_())],
                ["record_id", "kind", "url", "digest", "refers_to", "payload", "complete"])

    return reassemble(read_records(spark, path)).mapInArrow(
        run, "record_id string, kind string, url string, digest string, refers_to string, payload binary, complete boolean")


def _page_of(rid: str) -> Column:
    return F.try_element_at(F.split(rid, ":"), F.lit(3)).try_cast("long")


def op1_warc(pages: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to, from archives written and read back."""
    spark = pages.sparkSession
    path = scratch(spark, "warc")
    write_warc(pages, path)
    found = cut(read_warc(spark, path).select(
        "record_id", "kind", "refers_to", F.octet_length("payload").cast("long").alias("bytes"), F.sha2("payload", 256).alias("sha")), "warc-read")
    full = found.where("kind = 'response'").select(F.col("record_id").alias("_r"), F.col("bytes").alias("_bytes"), F.col("sha").alias("_sha"))
    # A revisit's payload is its response's. One response may have very many: adaptive execution splits them.
    visits = found.where("kind = 'revisit'").join(full, F.col("refers_to") == F.col("_r"), "left")
    out = found.where("kind = 'response'").select("record_id", "bytes", "sha", "kind", "refers_to").unionByName(
        visits.select("record_id", F.col("_bytes").alias("bytes"), F.col("_sha").alias("sha"), "kind", "refers_to"))
    return out.select(_page_of("record_id").alias("page_id"), F.col("bytes").alias("payload_bytes"), F.col("sha").alias("payload_digest"),
                      F.col("kind").alias("record_type"), _page_of("refers_to").alias("refers_to"))
