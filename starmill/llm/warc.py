"""Web archives: pages to WARC records in files, and back.

A payload is sent as an HTTP response in chunks. A record block longer than a segment is
cut: the first segment is the response record, the others are continuation records that
name it and carry a segment number, the last one also the total length. Reading groups
continuation records by that name, orders them by number, verifies the total length, and
takes the chunks apart. A payload that occurs again is not stored again: its record, a
revisit, names the first one.

Archives are written as texts of whole records, so everything in them is UTF-8, and
segments and chunks end between code points.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starmill.llm.batches import map_arrow, sent, slices
from starmill.sources.stage import new_stage_path, stage

SEGMENT_BYTES = 32 << 10
CHUNK_BYTES = 8 << 10
ARCHIVE_BYTES = 8 << 20

# Fixed values of the format.
_VERSION = b"WARC/1.1\r\n"
_END = b"\r\n\r\n"
_DATE = "2020-01-01T00:00:00Z"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_HTTP = "application/http; msgtype=response"


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def cut(data: bytes, size: int) -> list[bytes]:
    """UTF-8 in pieces of at most ``size`` bytes (but at least a code point) of whole code points."""
    pieces, start = [], 0
    while start < len(data):
        end = min(len(data), start + max(size, 4))
        while end < len(data) and data[end] & 0xC0 == 0x80:
            end -= 1
        pieces.append(data[start:end])
        start = end
    return pieces


def chunked(payload: bytes, size: int = CHUNK_BYTES) -> bytes:
    framed = [b"%x\r\n%b\r\n" % (len(c), c) for c in cut(payload, size)]
    return b"".join(framed) + b"0\r\n\r\n"


def dechunked(body: bytes) -> bytes:
    """The payload of chunked framing; chunk extensions and trailers are skipped."""
    out, at = [], 0
    while True:
        line = body.find(b"\r\n", at)
        if line < 0:
            raise ValueError("chunked body ends within a chunk size")
        size = int(body[at:line].split(b";")[0], 16)
        at = line + 2
        if size == 0:
            return b"".join(out)
        if body[at + size:at + size + 2] != b"\r\n":
            raise ValueError("chunk is not as long as its size")
        out.append(body[at:at + size])
        at += size + 2


def _record(fields: list[tuple[str, object]], block: bytes) -> bytes:
    head = "".join(f"{k}: {v}\r\n" for k, v in [*fields, ("Content-Length", len(block))])
    return _VERSION + head.encode() + b"\r\n" + block


def _url(value: str | None) -> str:
    # A field is one line.
    return "".join(c for c in value or "about:blank" if c not in "\r\n")


def page_records(record_id: str, page_id: int | None, url: str | None, payload: bytes, digest: str,
                 refers_to: int | None, segment_bytes: int) -> Iterator[bytes]:
    common = [("WARC-Date", _DATE), ("WARC-Target-URI", _url(url)), ("WARC-Payload-Digest", f"sha1:{digest}"),
              ("Page-ID", "" if page_id is None else page_id), ("Content-Type", _HTTP)]
    status = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
    if refers_to is not None:
        block = status + b"Content-Length: %d\r\n\r\n" % len(payload)
        yield _record([("WARC-Type", "revisit"), ("WARC-Record-ID", f"<urn:uuid:{record_id}>"), *common,
                       ("WARC-Profile", _PROFILE), ("Refers-To-Page-ID", refers_to)], block)
        return
    block = status + b"Transfer-Encoding: chunked\r\n\r\n" + chunked(payload)
    first, *rest = cut(block, segment_bytes)
    number = [("WARC-Segment-Number", 1)] if rest else []
    yield _record([("WARC-Type", "response"), ("WARC-Record-ID", f"<urn:uuid:{record_id}>"), *common, *number], first)
    for k, piece in enumerate(rest, 2):
        own = uuid.uuid5(uuid.UUID(record_id), str(k))
        total = [("WARC-Segment-Total-Length", len(block))] if k == len(rest) + 1 else []
        yield _record([("WARC-Type", "continuation"), ("WARC-Record-ID", f"<urn:uuid:{own}>"), ("WARC-Date", _DATE),
                       ("WARC-Target-URI", _url(url)), ("WARC-Segment-Origin-ID", f"<urn:uuid:{record_id}>"),
                       ("WARC-Segment-Number", k), *total], piece)


def _sha1() -> Column:
    return F.sha1(F.coalesce("html", F.lit("")).cast("binary"))


def revisits(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """(page_id, sha1, refers_to) of pages whose payload a smaller page_id has too; payloads
    of fewer than ``least_bytes`` are left out."""
    size = F.octet_length(F.coalesce("html", F.lit("")))
    found = pages.filter(F.col("page_id").isNotNull() & (size >= least_bytes)).select("page_id", _sha1().alias("sha1"))
    found, _ = stage(found, "digests")
    firsts = found.groupBy("sha1").agg(F.min("page_id").alias("refers_to"), F.max("page_id").alias("last"))
    firsts = firsts.filter(F.col("refers_to") < F.col("last")).drop("last")
    return found.join(firsts, "sha1").filter(F.col("page_id") > F.col("refers_to")).select(
        "page_id", "sha1", "refers_to").distinct()


def _archive(batches: Iterator[pa.RecordBatch], segment_bytes: int, archive_bytes: int) -> Iterator[pa.RecordBatch]:
    """Archives as texts without the end of their last record, which the writer adds."""
    held, size, place = [], 0, 0
    from pyspark import TaskContext

    part = TaskContext.get().partitionId()

    def packed() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([_END.join(held).decode()], pa.string())], names=["value"])

    for batch in slices(batches, "html"):
        for page in batch.to_pylist():
            payload = (page["html"] or "").encode()
            digest = payload_digest(payload)
            # The place keeps repeated rows apart.
            name = str(uuid.uuid5(uuid.NAMESPACE_URL, f"{part}/{place}/{page['page_id']}/{digest}"))
            place += 1
            for record in page_records(name, page["page_id"], page["url"], payload, digest, page["refers_to"],
                                       segment_bytes):
                if held and size + len(record) > archive_bytes:
                    yield packed()
                    held, size = [], 0
                held.append(record)
                size += len(record) + len(_END)
    if held:
        yield packed()


def write_archives(pages: DataFrame, path: str, segment_bytes: int = SEGMENT_BYTES,
                   archive_bytes: int = ARCHIVE_BYTES, least_bytes: int = 0) -> None:
    """Write a record per page below ``path``, in gzip files of at most ``archive_bytes``
    (unpacked) or one record."""
    pages = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                         F.col("html").cast("string").alias("html"))
    again, n = stage(revisits(pages, least_bytes), "revisits")
    again = sent(again.select(F.col("page_id").alias("_id"), F.col("sha1").alias("_sha1"), "refers_to"), n)
    same = (F.col("page_id") == F.col("_id")) & (_sha1() == F.col("_sha1"))
    joined = pages.join(again, same, "left").drop("_id", "_sha1")
    packed = map_arrow(joined, lambda b: _archive(b, segment_bytes, archive_bytes), "value string")
    packed.write.options(lineSep="\r\n\r\n", compression="gzip", maxRecordsPerFile=1).text(path)


def parse(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(fields, block) of every record; names of fields are in lower case."""
    at = 0
    while at < len(data):
        if data[at:at + 5] != b"WARC/":
            raise ValueError(f"no record at byte {at}")
        end = data.index(_END, at)
        lines = data[at:end].decode().split("\r\n")[1:]
        fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
        start = end + 4
        length = int(fields["content-length"])
        if data[start + length:start + length + 4] != _END:
            raise ValueError(f"record at byte {at} is not as long as it says")
        yield fields, data[start:start + length]
        at = start + length + 4


_SEGMENT = ("record_id string, origin_id string, number int, total_length long, type string, page_id long, "
            "digest string, refers_to long, block binary, problem string")


def _unpack(data: bytes) -> bytes:
    if data[:2] != b"\x1f\x8b":
        return data
    parts = []
    while data:  # one gzip member, or one per record
        member = zlib.decompressobj(31)
        parts.append(member.decompress(data) + member.flush())
        data = member.unused_data
    return b"".join(parts)


def _number(value: str | None) -> int | None:
    return int(value) if value else None


def _read(batches: Iterator[pa.RecordBatch], keep_broken: bool) -> Iterator[pa.RecordBatch]:
    kinds = [pa.string(), pa.string(), pa.int32(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(),
             pa.binary(), pa.string()]
    names = ["record_id", "origin_id", "number", "total_length", "type", "page_id", "digest", "refers_to", "block",
             "problem"]
    for batch in batches:
        for path, content in zip(batch.column("path"), batch.column("content")):
            rows = []
            try:
                for f, block in parse(_unpack(content.as_py())):
                    if f["warc-type"] not in ("response", "revisit", "continuation"):
                        continue
                    number = _number(f.get("warc-segment-number"))
                    rows.append((f["warc-record-id"], f.get("warc-segment-origin-id"), number,
                                 _number(f.get("warc-segment-total-length")), f["warc-type"], _number(f.get("page-id")),
                                 f.get("warc-payload-digest", "").removeprefix("sha1:"),
                                 _number(f.get("refers-to-page-id")), block, None))
            except (ValueError, KeyError, zlib.error) as fault:
                if not keep_broken:
                    raise
                rows.append((None,) * 9 + (f"{path}: {fault}",))
            columns = list(zip(*rows)) or [()] * len(kinds)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)


def read_segments(spark: SparkSession, path: str, keep_broken: bool = False) -> DataFrame:
    """Response, revisit and continuation records of all archives below ``path``; an archive
    is read as a whole, so it has to fit in a task.

    An archive that breaks off or holds something else fails, or with ``keep_broken`` gives the
    records before that place and a row that has only ``problem``, the path and what is wrong.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("path", "content")
    return map_arrow(files, lambda b: _read(b, keep_broken), _SEGMENT)


def reassemble(segments: DataFrame, keep_broken: bool = False) -> DataFrame:
    """Whole records: those of one segment as they are, others with their blocks joined.

    Segments are grouped by the record they belong to and ordered by number; a missing or
    repeated number or a length other than the total fails, or with ``keep_broken`` gives a row
    without block that says so in ``problem``. Only segmented records are shuffled, a
    record at a time, and each byte is copied once.
    """
    single = F.col("origin_id").isNull() & F.col("number").isNull()
    origin = F.coalesce("origin_id", "record_id")
    grouped = segments.filter(~single).groupBy(origin.alias("record_id")).agg(
        F.sort_array(F.collect_list("number")).alias("numbers"),
        F.expr("listagg(block) WITHIN GROUP (ORDER BY number)").alias("block"),
        F.max("total_length").alias("total"),
        *[F.max(F.when(F.col("number") == 1, F.col(c))).alias(c) for c in ("type", "page_id", "digest", "refers_to")])
    sound = (F.col("numbers") == F.sequence(F.lit(1), F.size("numbers"))) & (F.octet_length("block") == F.col("total"))
    broken = F.when(~F.coalesce(sound, F.lit(False)), F.concat(F.lit("segments missing of "), F.col("record_id")))
    joined = grouped.withColumn("problem", broken)
    missing = F.lit(None) if keep_broken else F.raise_error(F.col("problem"))
    joined = joined.withColumn("block", F.when(F.col("problem").isNull(), F.col("block")).otherwise(missing.cast("binary")))
    columns = ["record_id", "type", "page_id", "digest", "refers_to", "block", "problem"]
    return segments.filter(single).select(*columns).unionByName(joined.select(*columns))


def http_payload(block: bytes) -> tuple[dict[str, str], bytes]:
    head, _, body = block.partition(_END)
    fields = {k.strip().lower(): v.strip() for k, _, v in
              (x.partition(":") for x in head.decode("latin-1").split("\r\n")[1:])}
    return fields, dechunked(body) if fields.get("transfer-encoding") == "chunked" else body


def _open(batches: Iterator[pa.RecordBatch], with_html: bool, keep_broken: bool) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "block"):
        rows = []
        for r in batch.to_pylist():
            payload, problem = None, r["problem"]
            try:
                if problem is None:
                    fields, payload = http_payload(r["block"])
                    if r["type"] == "revisit":
                        rows.append((r["page_id"], int(fields["content-length"]), r["digest"], "revisit", r["refers_to"],
                                     None, None))
                        continue
                    if payload_digest(payload) != r["digest"]:
                        raise ValueError(f"payload of {r['record_id']} does not have its digest")
                    html = payload.decode() if with_html else None
                    rows.append((r["page_id"], len(payload), r["digest"], "response", None, html, None))
                    continue
            except (ValueError, KeyError) as fault:
                if not keep_broken:
                    raise
                problem = f"{r['record_id']}: {fault}"
            rows.append((r["page_id"], None, r["digest"], r["type"], r["refers_to"], None, problem))
        columns = list(zip(*rows)) or [()] * 7
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds)],
            names=["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "html", "problem"])


def read_archives(spark: SparkSession, path: str, with_html: bool = True, keep_broken: bool = False) -> DataFrame:
    """Per response or revisit: page_id, payload_bytes, payload_digest, record_type,
    refers_to and html, the payload (null in a revisit, and unless ``with_html``).

    What is broken fails the read, or with ``keep_broken`` is a row with as much as is known, and
    what is wrong in a further column ``problem``: an archive from the broken place on, a
    record that lacks segments, a payload without its digest. All other records are read.
    """
    records = reassemble(read_segments(spark, path, keep_broken), keep_broken)
    rows = map_arrow(records, lambda b: _open(b, with_html, keep_broken),
                     "page_id long, payload_bytes long, payload_digest string, record_type string, "
                     "refers_to long, html string, problem string")
    return rows if keep_broken else rows.drop("problem")


def archive_roundtrip(pages: DataFrame) -> DataFrame:
    """Write all pages to archives on the shared folder and read them back.

    Null html is the empty payload. A page whose payload a smaller page_id has too is a
    revisit of the smallest such page. A null page_id is never a revisit nor revisited,
    and rows that repeat the smallest page_id are all responses. A very long page is cut into
    segments and put together again within one task. An empty table gives an empty result.
    """
    spark = pages.sparkSession
    path = new_stage_path(spark, "warc")
    write_archives(pages, path)
    return read_archives(spark, path, with_html=False).drop("html")
