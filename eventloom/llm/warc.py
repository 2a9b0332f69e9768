"""WARC archives in seekable Zstandard bundles.

Records are grouped into frames of about `FRAME_BYTES`; each frame is compressed on its
own, and a seek table in a skippable last frame has the sizes of all. A manifest maps
each record to its bundle, frame, offset and length inside the frame, so one record is
read by decompressing one frame.

Of records with equal payloads of at least `least_bytes`, the one with the largest id is a
response and holds the payload; the others are revisits that name it. Copies are
counted by digest before anything is joined; the join is salted, so a payload that a
third of all pages share is spread over many tasks.

Bundles are written under names of their own attempt, and only the manifest rows of
committed tasks refer to them: a task that is lost or run twice leaves a file that
nothing refers to.

Defined cases: a NULL html is an empty payload; a NULL id is smaller than any other, and
has no record id; rows that share the largest id of a payload are all responses; a NULL
url gives a record without target; an empty table gives an empty manifest.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventloom.llm.blocks import shared_path, stored

FRAME_BYTES = 256 << 10
TASK_BYTES = 16 << 20  # bytes of records that a reading task takes
SALTS = 32

# Fixed values of the seekable format and of WARC 1.1.
SKIPPABLE_MAGIC = 0x184D2A5E
SEEKABLE_MAGIC = 0x8F92EAB1
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

MANIFEST = (
    "path string, page_id bigint, record_type string, frame bigint, offset bigint, length bigint"
)
RECORD = (
    "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, "
    "refers_to bigint, url string, payload binary"
)


def plan_records(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """The pages with `digest`, `record_type` and `refers_to`."""
    html = F.coalesce(F.col("html").cast("binary"), F.lit(b""))
    rows = pages.select(
        F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"), html.alias("payload")
    ).withColumn("digest", F.sha1("payload"))
    twins = (
        rows.where(F.length("payload") >= least_bytes)
        .groupBy("digest")
        .agg(F.max("page_id").alias("largest"), F.count("*").alias("copies"))
        .where("copies > 1")
        .select("digest", "largest", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    )
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("page_id", "url"), F.lit(SALTS)).cast("int"))
    copy = F.coalesce("page_id", F.lit(-(1 << 63))) < F.col("largest")
    return salted.join(twins, ["digest", "salt"], "left").select(
        "page_id",
        "url",
        "payload",
        "digest",
        F.when(copy, "revisit").otherwise("response").alias("record_type"),
        F.when(copy, F.col("largest")).alias("refers_to"),
    )


def record_id(page_id: int | None) -> str:
    return "<urn:page:none>" if page_id is None else f"<urn:page:{page_id}>"


def _page_of(record: str) -> int | None:
    name = record.removeprefix("<urn:page:").removesuffix(">")
    return None if name == "none" else int(name)


def build_record(row: dict) -> bytes:
    """One WARC record; a revisit has the HTTP head only."""
    payload = row["payload"]
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    body = head.encode() + (payload if row["record_type"] == "response" else b"")
    fields = [
        ("WARC-Type", row["record_type"]),
        ("WARC-Record-ID", record_id(row["page_id"])),
        ("WARC-Date", "1970-01-01T00:00:00Z"),
        ("WARC-Payload-Digest", "sha1:" + base64.b32encode(bytes.fromhex(row["digest"])).decode()),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(body))),
    ]
    if row["url"] is not None:
        fields.append(("WARC-Target-URI", quote(row["url"], safe="!#$&'()*+,/:;=?@[]~%")))
    if row["record_type"] == "revisit":
        fields.append(("WARC-Profile", REVISIT_PROFILE))
        fields.append(("WARC-Refers-To", record_id(row["refers_to"])))
    lines = "".join(f"{name}: {value}\r\n" for name, value in fields)
    return b"WARC/1.1\r\n" + lines.encode() + b"\r\n" + body + b"\r\n\r\n"


def parse_records(data: bytes) -> Iterator[dict]:
    """The records of a frame, each checked against its digest."""
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        lines = data[at:end].decode().split("\r\n")
        fields = dict(line.split(": ", 1) for line in lines[1:])
        body = data[end + 4 : end + 4 + int(fields["Content-Length"])]
        at = end + 4 + len(body) + 4
        head, _, payload = body.partition(b"\r\n\r\n")
        digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
        kind = fields["WARC-Type"]
        size = int(head.decode().rsplit("Content-Length: ", 1)[1])
        if kind == "response":
            found = base64.b32encode(hashlib.sha1(payload).digest()).decode()
            if found != digest or len(payload) != size:
                raise ValueError(f"{fields['WARC-Record-ID']}: payload does not fit its digest")
        refers = fields.get("WARC-Refers-To")
        yield {
            "page_id": _page_of(fields["WARC-Record-ID"]),
            "payload_bytes": size,
            "payload_digest": digest,
            "record_type": kind,
            "refers_to": None if refers is None else _page_of(refers),
            "url": fields.get("WARC-Target-URI"),
            "payload": payload if kind == "response" else None,
        }


def seek_table(frames: list[tuple[int, int]]) -> bytes:
    """Skippable frame with (compressed, plain) sizes of all frames."""
    entries = b"".join(struct.pack("<II", *sizes) for sizes in frames)
    footer = struct.pack("<IBI", len(frames), 0, SEEKABLE_MAGIC)
    return struct.pack("<II", SKIPPABLE_MAGIC, len(entries) + len(footer)) + entries + footer


def frame_bounds(file: pa.NativeFile) -> list[tuple[int, int, int]]:
    """(offset, compressed size, plain size) of each frame, from the footer."""
    end = file.size()
    count, _, magic = struct.unpack("<IBI", file.read_at(9, end - 9))
    if magic != SEEKABLE_MAGIC:
        raise ValueError("not a seekable bundle")
    sizes = struct.iter_unpack("<II", file.read_at(8 * count, end - 9 - 8 * count))
    out, at = [], 0
    for packed, plain in sizes:
        out.append((at, packed, plain))
        at += packed
    return out


def read_frame(file: pa.NativeFile, bounds: tuple[int, int, int]) -> bytes:
    at, packed, plain = bounds
    return zstandard.ZstdDecompressor().decompress(file.read_at(packed, at), max_output_size=plain)


def _open(path: str):
    from pyarrow.fs import FileSystem

    return FileSystem.from_uri(path)


def write_archives(records: DataFrame, folder: str) -> DataFrame:
    """Writes bundles below `folder`; gives the stored manifest."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path = f"{folder}/{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.warc.zst"
        files, place = _open(path)
        out, frames = None, []
        rows: list[tuple] = []
        parts: list[bytes] = []
        size = 0

        def close_frame() -> None:
            nonlocal size
            plain = b"".join(parts)
            packed = zstandard.ZstdCompressor(level=3).compress(plain)
            out.write(packed)
            frames.append((len(packed), len(plain)))
            parts.clear()
            size = 0

        for batch in batches:
            for n in range(batch.num_rows):
                if out is None:
                    files.create_dir(place.rsplit("/", 1)[0], recursive=True)
                    out = files.open_output_stream(place, compression=None)  # frames are compressed here
                row = batch.slice(n, 1).to_pylist()[0]
                record = build_record(row)
                rows.append((path, row["page_id"], row["record_type"], len(frames), size, len(record)))
                parts.append(record)
                size += len(record)
                if size >= FRAME_BYTES:
                    close_frame()
            yield _manifest(rows)
            rows = []
        if out is not None:
            if parts:
                close_frame()
            out.write(seek_table(frames))
            out.close()

    return stored(records.mapInArrow(write, MANIFEST), "manifest")


def _manifest(rows: list[tuple]) -> pa.RecordBatch:
    names = [column.split()[0] for column in MANIFEST.split(", ")]
    types = [pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64()]
    columns = zip(*rows, strict=True) if rows else [[] for _ in names]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names
    )


def read_archives(manifest: DataFrame, payloads: bool = True, task_bytes: int = TASK_BYTES) -> DataFrame:
    """All records that the manifest names, each from its frame and offset.

    Frames are dealt in their order to as many tasks as their bytes ask for, so tasks read
    neighbouring frames and a bundle may be read by several.
    """
    names = [column.split()[0] for column in RECORD.split(", ")]
    types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.binary()]

    def records(data: bytes, entries: list[dict]) -> Iterator[dict]:
        for entry in entries:
            yield next(parse_records(data[entry["offset"] : entry["offset"] + entry["length"]]))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, file, bounds = None, None, []
        for batch in batches:
            for row in batch.to_pylist():
                if row["path"] != current:
                    if file is not None:
                        file.close()
                    files, place = _open(row["path"])
                    current, file = row["path"], files.open_input_file(place)
                    bounds = frame_bounds(file)
                found = list(records(read_frame(file, bounds[row["frame"]]), row["entries"]))
                columns = [[r[name] if payloads or name != "payload" else None for r in found] for name in names]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names
                )
        if file is not None:
            file.close()

    total = manifest.agg(F.sum("length")).first()[0] or 0
    tasks = max(1, -(-total // task_bytes))
    entry = F.struct("offset", "length")
    frames = manifest.groupBy("path", "frame").agg(F.sort_array(F.collect_list(entry)).alias("entries"))
    dealt = frames.repartitionByRange(tasks, "path", "frame").sortWithinPartitions("path", "frame")
    return dealt.mapInArrow(read, RECORD)


def read_record(entry: dict) -> dict:
    """One record, by its manifest row: reads the footer and one frame."""
    files, place = _open(entry["path"])
    with files.open_input_file(place) as file:
        frame = read_frame(file, frame_bounds(file)[entry["frame"]])
    return next(parse_records(frame[entry["offset"] : entry["offset"] + entry["length"]]))


def archive_report(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """Writes the pages to bundles, reads the bundles: one row per page."""
    manifest = write_archives(plan_records(pages), shared_path(spark, "warc"))
    records = read_archives(manifest, payloads=False)
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


# Five hex digits make four letters of base 32.
SQL = """
with hashed as (
    select page_id, strlen(coalesce(html, '')) as payload_bytes, sha1(coalesce(html, '')) as hex from pages
), coded as (
    select *, list_aggregate(list_transform(range(8), lambda g: list_aggregate(list_transform(range(4), lambda k:
        substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + cast(
            (('0x' || substr(hex, cast(g * 5 + 1 as bigint), 5))::bigint >> cast(15 - 5 * k as bigint)) & 31
        as bigint), 1)), 'string_agg', '')), 'string_agg', '') as payload_digest
    from hashed
), grouped as (
    select *, max(page_id) over (partition by hex) as largest from coded
)
select page_id, payload_bytes, payload_digest,
    case when page_id < largest then 'revisit' else 'response' end as record_type,
    case when page_id < largest then largest end as refers_to
from grouped
"""
