"""WARC archives as chunked record tables.

Writing cuts every payload into segments. The first is a response record, the others are
continuation records of the standard (segment number, origin, total length), so no
row, in memory or in a file, is larger than a segment plus its header. Reading gives
a table (record_id, chunk_no, raw, ...) from which payloads are consumed in order, with a running
digest: no step builds a whole record again.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from riskmill.llm.common import let, materialize, new_folder, plain, read_blobs, write_blobs

SEGMENT = 1 << 16
CHUNK = 1 << 16
#: So that a file, read as one row, stays below 550 MB.
SEGMENTS_PER_FILE = 8192
#: Payloads of fewer bytes are never revisits.
LEAST_SHARED = 100
CRLF = "\r\n"


def with_digests(pages: DataFrame) -> DataFrame:
    """(page_id, url, payload, size, digest) of ``pages`` (page_id, url, html)."""
    payload = F.coalesce("html", F.lit("")).cast("binary")
    rows = plain(pages, "page_id", "url", "html").select("page_id", "url", payload.alias("payload"))
    return rows.withColumn("size", F.length("payload").cast("long")).withColumn("digest", F.sha2("payload", 256))


def revisits(pages: DataFrame) -> DataFrame:
    """(page_id, digest, refers_to) of pages whose payload a page with a smaller id has.

    Only ids and digests are shuffled. Equal payloads are merged before the shuffle,
    and the join back is one whose large partitions Spark splits.
    """
    marks = materialize(with_digests(pages).filter(F.col("size") >= LEAST_SHARED).select("page_id", "size", "digest"), "marks")
    first = marks.groupBy("digest", "size").agg(F.min("page_id").alias("refers_to"), F.max("page_id").alias("last"))
    first = first.filter("last > refers_to").drop("last")
    shared = marks.join(first, ["digest", "size"]).filter("page_id > refers_to")
    return shared.select("page_id", "digest", "refers_to").distinct()


def _header(name: str, value: Column) -> Column:
    return F.when(value.isNotNull(), F.concat(F.lit(f"{name}: "), value.cast("string"), F.lit(CRLF))).otherwise("")


def _clean(name: str) -> Column:
    """A header value without control characters, which are percent-encoded as spaces."""
    return F.regexp_replace(name, r"[\x00-\x1F\x7F]", "%20")


def write_archive(pages: DataFrame, folder: str, segment: int = SEGMENT) -> None:
    """One record per row of ``pages`` (page_id, url, html) as WARC files in ``folder``.

    Of equal payloads of at least ``LEAST_SHARED`` bytes the smallest page_id is a
    response and the others are revisits without a block; rows that share that id are all
    responses. A null html is an empty payload, a null url has no target line, a null
    page_id is written without the id line and never a revisit. Files are gzipped as a whole.
    """
    # The extra columns of both sides are named apart, so that no page column can clash.
    rows = with_digests(pages).join(revisits(pages), ["page_id", "digest"], "left")
    rows = rows.withColumn("record_id", F.concat(F.lit("<urn:page:"), F.coalesce(F.col("page_id").cast("string"), F.lit("none")),
                                                 F.lit(":"), F.monotonically_increasing_id(), F.lit(">")))
    body = F.when(F.col("refers_to").isNull(), F.col("payload")).otherwise(F.lit(b""))
    rows = rows.withColumn("payload", body).withColumn("length", F.length("payload"))
    last = F.greatest(F.ceil(F.col("length") / segment) - 1, F.lit(0)).cast("int")
    cut = rows.withColumn("number", F.explode(F.sequence(F.lit(0), last)))
    piece = F.substring(F.col("payload"), F.col("number") * segment + 1, F.lit(segment))
    first, only = F.col("number") == 0, F.col("length") <= segment
    kind = F.when(F.col("refers_to").isNotNull(), "revisit").when(first, "response").otherwise("continuation")
    identity = F.when(first, F.col("record_id")).otherwise(
        F.concat(F.expr("substring(record_id, 1, length(record_id) - 1)"), F.lit("/"), F.col("number") + 1, F.lit(">")))
    head = F.concat(
        F.lit(f"WARC/1.1{CRLF}"),
        _header("WARC-Type", kind),
        _header("WARC-Record-ID", identity),
        _header("WARC-Date", F.lit("1970-01-01T00:00:00Z")),
        _header("WARC-Target-URI", _clean("url")),
        _header("WARC-Payload-Digest", F.when(first, F.concat(F.lit("sha256:"), F.col("digest")))),
        _header("WARC-Profile", F.when(F.col("refers_to").isNotNull(),
                                       F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))),
        _header("X-Page-Id", F.col("page_id")),
        _header("X-Refers-To-Page-Id", F.col("refers_to")),
        _header("X-Payload-Length", F.when(first, F.col("size"))),
        _header("WARC-Segment-Number", F.when(~only, F.col("number") + 1)),
        _header("WARC-Segment-Origin-ID", F.when(~first, F.col("record_id"))),
        _header("WARC-Segment-Total-Length", F.when(~only & (F.col("number") == last), F.col("length"))),
        _header("Content-Length", let(piece, F.length)),
        F.lit(CRLF),
    )
    block = F.concat(head.cast("binary"), piece, F.lit(CRLF.encode()))
    write_blobs(cut.select(block.alias("block")), "block", CRLF.encode(), folder, SEGMENTS_PER_FILE, "gzip")


FIELD = re.compile(rb"([^:\r\n]+):[ \t]*([^\r\n]*)\r\n")
CHUNKS = pa.schema(
    [("record_id", pa.string()), ("chunk_no", pa.int64()), ("parts", pa.int32()), ("raw", pa.binary()), ("page_id", pa.int64()),
     ("record_type", pa.string()), ("digest", pa.string()), ("size", pa.int64()), ("refers_to", pa.int64())]
)
CHUNKS_DDL = ("record_id string, chunk_no bigint, parts int, raw binary, page_id bigint, record_type string, digest string, "
              "size bigint, refers_to bigint")


def inflated(content: memoryview, step: int = 1 << 15) -> Iterator[bytes]:
    """The bytes of a file in pieces, unpacked if it is gzipped (several members follow each other)."""
    if bytes(content[:2]) != b"\x1f\x8b":
        yield from (bytes(content[at : at + step]) for at in range(0, len(content), step))
        return
    unpacker = zlib.decompressobj(31)
    for at in range(0, len(content), step):
        data = bytes(content[at : at + step])
        while data:
            yield unpacker.decompress(data)
            data = unpacker.unused_data
            if data:
                unpacker = zlib.decompressobj(31)


def parse_records(pieces: Iterable[bytes]) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header fields in lower case, block) of every record, holding one record and a piece at a time."""
    source, held = iter(pieces), bytearray()

    def more() -> bool:
        piece = next(source, None)
        held.extend(piece or b"")
        return piece is not None

    while True:
        seen = 0
        while (end := held.find(b"\r\n\r\n", seen)) < 0:
            seen = max(0, len(held) - 3)
            if not more():
                if held:
                    raise ValueError("a record header does not end")
                return
        raw = bytes(held[: end + 2])
        if not raw.startswith(b"WARC/"):
            raise ValueError("not a WARC record")
        fields = {m[1].decode("latin-1").lower(): m[2].decode("utf-8") for m in FIELD.finditer(raw)}
        start = end + 4
        stop = start + int(fields["content-length"])
        while len(held) < stop + 4 and more():
            pass
        if held[stop : stop + 4] != b"\r\n\r\n":
            raise ValueError("a record block has another length than its header says")
        yield fields, bytes(held[start:stop])
        del held[: stop + 4]


def _chunk_rows(fields: dict[str, str], block: bytes, chunk: int, segment: int) -> Iterator[dict]:
    number = int(fields.get("warc-segment-number", 1))
    whole = "warc-segment-number" not in fields
    page, refers, size = fields.get("x-page-id"), fields.get("x-refers-to-page-id"), fields.get("x-payload-length")
    per_segment = -(-segment // chunk)
    for i in range(max(1, -(-len(block) // chunk))):
        opens = number == 1 and i == 0
        yield {
            "record_id": fields.get("warc-segment-origin-id", fields["warc-record-id"]),
            "chunk_no": (number - 1) * per_segment + i,
            "parts": 1 if whole and len(block) <= chunk else 0,
            "raw": block[i * chunk : (i + 1) * chunk],
            "page_id": int(page) if page else None,
            "record_type": fields["warc-type"] if opens else None,
            "digest": fields.get("warc-payload-digest", "").removeprefix("sha256:") if opens else None,
            "size": int(size) if opens and size else None,
            "refers_to": int(refers) if refers else None,
        }


def read_chunks(spark: SparkSession, folder: str, chunk: int = CHUNK, segment: int = SEGMENT) -> DataFrame:
    """Chunk table of the archives in ``folder``; ``parts`` is 1 for records of one chunk.

    A file is bounded by ``SEGMENTS_PER_FILE`` segments of the writer; chunks leave in
    small batches.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                rows, held = [], 0
                for fields, block in parse_records(inflated(memoryview(content.as_buffer()))):
                    for row in _chunk_rows(fields, block, chunk, segment):
                        rows.append(row)
                        held += len(row["raw"]) + 200
                        if held > 4_000_000:
                            yield pa.RecordBatch.from_pylist(rows, CHUNKS)
                            rows, held = [], 0
                yield pa.RecordBatch.from_pylist(rows, CHUNKS)

    return read_blobs(spark, folder).select("content").mapInArrow(run, CHUNKS_DDL)


RECORDS_DDL = "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint"


def _digest_run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per record from chunks in order; only one digest state is held."""
    schema = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                        ("record_type", pa.string()), ("refers_to", pa.int64())])
    current, head, state, size, seen = None, None, None, 0, -1

    def closed() -> dict:
        if head["record_type"] is None:
            raise ValueError(f"record {current} has no first segment")
        if head["record_type"] == "revisit":
            length, digest = head["size"], head["digest"]
        else:
            length, digest = size, state.hexdigest()
            if digest != head["digest"] or length != head["size"]:
                raise ValueError(f"record {current} differs from its digest")
        return {"page_id": head["page_id"], "payload_bytes": length, "payload_digest": digest,
                "record_type": head["record_type"], "refers_to": head["refers_to"]}

    for batch in batches:
        out = []
        for row in batch.to_pylist():
            if row["record_id"] != current:
                if current is not None:
                    out.append(closed())
                current, head, state, size, seen = row["record_id"], row, hashlib.sha256(), 0, -1
            if row["chunk_no"] != seen + 1:
                raise ValueError(f"record {current} lacks a chunk")
            seen = row["chunk_no"]
            state.update(row["raw"])
            size += len(row["raw"])
        yield pa.RecordBatch.from_pylist(out, schema)
    if current is not None:
        yield pa.RecordBatch.from_pylist([closed()], schema)


def _close_small(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Check the records of one chunk where they are and let go of their bytes."""
    for batch in batches:
        rows = batch.to_pylist()
        for row in rows:
            if row["parts"] != 1:
                continue
            if row["record_type"] == "response" and (
                hashlib.sha256(row["raw"]).hexdigest() != row["digest"] or len(row["raw"]) != row["size"]
            ):
                raise ValueError(f"record {row['record_id']} differs from its digest")
            row["raw"] = None
        yield pa.RecordBatch.from_pylist(rows, CHUNKS)


def read_records(spark: SparkSession, folder: str, chunk: int = CHUNK, segment: int = SEGMENT) -> DataFrame:
    """One row per record of the archives, payload length and digest from the payload itself.

    A revisit has no block; its length and digest are those of its header. Records of one
    chunk are digested where they were read. Only chunks of larger records are kept,
    dealt out by record and sorted, and their digests run over the chunks in order. A
    missing chunk or a digest that differs is an error.
    """
    chunks = materialize(read_chunks(spark, folder, chunk, segment).mapInArrow(_close_small, CHUNKS_DDL), "chunks")
    single = chunks.filter("parts = 1").select(
        "page_id", F.col("size").alias("payload_bytes"), F.col("digest").alias("payload_digest"), "record_type", "refers_to")
    many = chunks.filter("parts = 0").repartition("record_id").sortWithinPartitions("record_id", "chunk_no")
    return single.union(many.mapInArrow(_digest_run, RECORDS_DDL))


def round_trip(pages: DataFrame, segment: int = SEGMENT, chunk: int = CHUNK) -> DataFrame:
    """Archive ``pages`` (page_id, url, html) and read the archives back, see ``read_records``."""
    spark = pages.sparkSession
    folder = new_folder(spark, "warc")
    write_archive(pages, folder, segment)
    return read_records(spark, folder, chunk, segment)
