"""WARC archives as seekable Zstandard bundles.

Method: records are grouped into independent zstd frames of a bundle file; the file ends
in a seek table, and the index maps each record to (bundle, frame, offset in the frame).
One record is read by one seek and one frame. Records are archived where the scan has
them: only rows whose payload occurs more than once need the join that names their
response. The index is a Parquet table; bundles that it does not list do not exist.

Among records of equal payload the one with the largest id is the response, the others
are revisits of it (profile identical-payload-digest) that keep the HTTP head, whose
Content-Length is the payload's. Rows that repeat the largest id are responses as well. A
null payload is the empty one, a null id is archived under a urn without number and
never a revisit's target unless all ids of its payload are null (then all are
responses); line ends in a URL are percent-encoded. Empty tables give no bundle.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from tillsight.llm.arrowio import partitions_for, split
from tillsight.llm.seekable import SeekableReader, SeekableWriter
from tillsight.llm.storage import make_folder, unique
from tillsight.session import cut_lineage, shared_folder

FRAME_BYTES = 256 << 10  # a frame is closed after this many bytes of records
FRAMES_PER_TASK = 256  # read back by one task
BUNDLE_BYTES = 256 << 20  # a bundle is closed after this many compressed bytes

DATE = "1970-01-01T00:00:00Z"  # the pages have no time
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

INDEX = pa.schema([("page_id", pa.int64()), ("file", pa.string()), ("frame", pa.int32()), ("offset", pa.int64())])


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def urn(page: int | None) -> str:
    return f"<urn:page:{'' if page is None else page}>"


def record(page: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool) -> bytes:
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head if revisit else head + payload
    fields = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {urn(page)}",
        f"WARC-Date: {DATE}",
        f"WARC-Payload-Digest: sha1:{digest(payload)}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if url is not None:
        fields.insert(3, "WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    if revisit:
        fields += [f"WARC-Refers-To: {urn(refers_to)}", f"WARC-Profile: {PROFILE}"]
    return "\r\n".join(fields).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def fields_of(head: bytes) -> dict[str, str]:
    lines = head.decode().split("\r\n")[1:]
    return {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}


def parse(frame: bytes, offset: int) -> dict:
    """The record at an offset of a frame; a response's payload is held against its digest."""
    end = frame.index(b"\r\n\r\n", offset)
    warc = fields_of(frame[offset:end])
    start, length = end + 4, int(warc["content-length"])
    block = frame[start : start + length]
    if frame[start + length : start + length + 4] != b"\r\n\r\n" or len(block) != length:
        raise ValueError("a record does not end where its length says")
    http, _, payload = block.partition(b"\r\n\r\n")
    size, sha = int(fields_of(http)["content-length"]), warc["warc-payload-digest"].removeprefix("sha1:")
    kind = warc["warc-type"]
    if kind == "response" and (digest(payload) != sha or len(payload) != size):
        raise ValueError(f"payload of {warc['warc-record-id']} is damaged")
    number = lambda x: int(x) if (x := x.removeprefix("<urn:page:").removesuffix(">")) else None
    return {
        "page_id": number(warc["warc-record-id"]),
        "url": warc.get("warc-target-uri"),
        "payload_bytes": size,
        "payload_digest": sha,
        "record_type": kind,
        "refers_to": number(warc["warc-refers-to"]) if "warc-refers-to" in warc else None,
        "payload": payload if kind == "response" else None,
    }


RECORD = pa.schema([
    ("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
    ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary()),
])
RECORD_DDL = (
    "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"
)


def with_targets(pages: DataFrame) -> DataFrame:
    """(page, url, payload, revisit, refers_to): the largest id of each payload is its response.

    Groups are made of fixed-size hashes, pre-aggregated in each task. Only payloads
    that occur more than once are joined back, from a written table, so that Spark
    knows the size of that side and can split a payload that a third of all rows share.
    """
    rows = pages.select(
        F.col("page_id").cast("long").alias("page"), F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary").alias("payload"),
    ).withColumn("hash", F.unhex(F.sha2("payload", 256)))
    groups = rows.groupBy("hash").agg(F.max("page").alias("largest"), F.count("*").alias("n"))
    groups = cut_lineage(groups.filter("n > 1 AND largest IS NOT NULL").select("hash", "largest"))
    revisit = F.col("largest").isNotNull() & ~F.col("page").eqNullSafe(F.col("largest"))
    joined = rows.join(groups, "hash", "left").withColumn("revisit", revisit)
    return joined.select("page", "url", "payload", "revisit", F.when(F.col("revisit"), F.col("largest")).alias("refers_to"))


def write_archive(pages: DataFrame) -> DataFrame:
    """Writes a record for each page; returns the index (page_id, file, frame, offset)."""
    folder = shared_folder(pages.sparkSession, unique("", "warc", "").lstrip("/"))
    make_folder(folder)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, bundle, waiting, size, places = TaskContext.get().partitionId(), None, [], 0, []
        for batch in batches:
            for piece in split(batch, 64):
                for row in piece.to_pylist():
                    places.append((row["page"], size))
                    waiting.append(record(row["page"], row["url"], row["payload"], row["refers_to"], row["revisit"]))
                    size += len(waiting[-1])
                    if size >= FRAME_BYTES:
                        bundle = bundle or SeekableWriter(unique(folder, f"bundle-{part:06d}", ".warc.zst"))
                        yield index(bundle, waiting, places)
                        waiting, places, size = [], [], 0
                        if bundle.size >= BUNDLE_BYTES:
                            bundle.close()
                            bundle = None
        if waiting:
            bundle = bundle or SeekableWriter(unique(folder, f"bundle-{part:06d}", ".warc.zst"))
            yield index(bundle, waiting, places)
        if bundle:
            bundle.close()

    return cut_lineage(with_targets(pages).mapInArrow(run, "page_id long, file string, frame int, offset long"))


def index(bundle: SeekableWriter, records: list[bytes], places: list[tuple]) -> pa.RecordBatch:
    frame, n = bundle.add(b"".join(records)), len(places)
    pages, offsets = zip(*places)
    return pa.RecordBatch.from_arrays(
        [pa.array(pages, pa.int64()), pa.array([bundle.uri] * n), pa.array([frame] * n, pa.int32()), pa.array(offsets, pa.int64())],
        schema=INDEX,
    )


def read_archive(index: DataFrame, payloads: bool = True) -> DataFrame:
    """The records of the index rows; each frame is fetched and decompressed once."""
    ddl = RECORD_DDL if payloads else RECORD_DDL.removesuffix(", payload binary")
    schema = RECORD if payloads else pa.schema(list(RECORD)[:-1])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = None
        for batch in batches:
            for row in batch.to_pylist():
                if reader is None or reader.uri != row["file"]:
                    if reader:
                        reader.close()
                    reader = SeekableReader(row["file"])
                frame = reader.frame(row["frame"])
                found = [parse(frame, at) for at in row["offsets"]]
                yield pa.RecordBatch.from_pylist([{k: x[k] for k in schema.names} for x in found], schema=schema)
        if reader:
            reader.close()

    # A frame holds a bounded number of bytes, and so a bounded list of offsets.
    tasks = partitions_for(index, index.select("file", "frame").distinct().count(), FRAMES_PER_TASK)
    frames = index.repartition(tasks, "file", "frame").groupBy("file", "frame")
    frames = frames.agg(F.sort_array(F.collect_list("offset")).alias("offsets"))
    return frames.sortWithinPartitions("file", "frame").mapInArrow(run, ddl)


def lookup(index: DataFrame, wanted: list[int]) -> DataFrame:
    """Only the wanted records: their frames are fetched, the rest of the bundles is not."""
    return read_archive(index.filter(F.col("page_id").isin(wanted)))


def op1_warc(spark: SparkSession, folder: str) -> DataFrame:
    index = write_archive(spark.read.parquet(f"{folder}/pages.parquet"))
    return read_archive(index, payloads=False).drop("url")


# SHA-1 as hexadecimal digits, ten of which are eight digits of base 32.
OP1_SQL = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
g AS (SELECT payload, max(page_id) AS largest FROM p GROUP BY payload),
b AS (SELECT page_id, octet_length(payload)::BIGINT AS payload_bytes, sha1(payload) AS hex, largest
      FROM p JOIN g USING (payload))
SELECT page_id, payload_bytes,
       translate(array_to_string([to_base(('0x' || substr(hex, i * 10 + 1, 10))::BIGINT, 32, 8) for i in range(4)], ''),
                 '0123456789ABCDEFGHIJKLMNOPQRSTUV', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567') AS payload_digest,
       CASE WHEN page_id = largest THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> largest THEN largest END AS refers_to
FROM b
"""
