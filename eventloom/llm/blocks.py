"""Packed blocks of documents, and questions that blocks put to hash buckets.

Documents are packed into blocks of some megabytes, stored once in the shared
folder. A block asks about many keys at a time: it sends one packed row to each
bucket it has keys for. A key is sent once per block, so a key that fills a third
of all documents still costs its bucket one entry per block. Buckets answer with
packed rows too, and the answers meet their block again in a join on its number.

All Python state is rebuilt from the stored blocks, so a lost executor costs the
tasks it ran and nothing else.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.ipc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventloom.llm.text import NO_ID, as_bytes, give_back, ids_of
from eventloom.session import shared_folder

BLOCK_BYTES = 1 << 20
DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
BLOCK_SCHEMA = "block bigint, n_bytes bigint, ids binary, sizes binary, texts binary, rest binary"
SENT_SCHEMA = "bucket int, block bigint, payload binary"


def shared_path(spark: SparkSession, kind: str) -> str:
    return f"{shared_folder(spark)}/{kind}-{uuid.uuid4().hex}"


@contextmanager
def _shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Shuffle files go when a query ends: what it wrote is never computed again."""
    before = spark.conf.get(DROP_SHUFFLES, None)
    spark.conf.set(DROP_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(DROP_SHUFFLES)
        else:
            spark.conf.set(DROP_SHUFFLES, before)


def stored(df: DataFrame, kind: str, compression: str = "snappy") -> DataFrame:
    """The rows written to the shared folder and read again: lineage ends here."""
    spark = df.sparkSession
    path = shared_path(spark, kind)
    with _shuffles_dropped(spark):
        df.write.parquet(path, compression=compression)
    table = spark.read.schema(df.schema).parquet(path)
    table.stored_at = path
    return table


def forget(*tables: DataFrame) -> None:
    """Delete stored tables; whatever was made of them must be stored itself."""
    for table in tables:
        spark = table.sparkSession
        target = spark._jvm.org.apache.hadoop.fs.Path(table.stored_at)
        target.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(target, True)


def squeeze(raw: bytes) -> bytes:
    return zstandard.ZstdCompressor(level=3).compress(raw)


def unsqueeze(packed: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(packed)


def _pack(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[pa.RecordBatch]:
    part, number = TaskContext.get().partitionId(), 0
    ids: list[int] = []
    texts: list[bytes] = []
    sizes: list[int] = []
    rest: list[pa.RecordBatch] = []

    def block() -> pa.RecordBatch:
        nonlocal number
        give_back()
        row = {
            "block": pa.array([(part << 32) | number]),
            "n_bytes": pa.array([sum(map(len, texts))]),
            "ids": pa.array([np.array(ids, dtype=np.int64).tobytes()]),
            "sizes": pa.array([np.array(sizes, dtype=np.int64).tobytes()]),
            "texts": pa.array([squeeze(b"".join(texts))]),
            "rest": pa.array([_rest_bytes(rest)], pa.binary()),
        }
        number += len(ids)
        for filled in (ids, texts, sizes, rest):
            filled.clear()
        return pa.RecordBatch.from_arrays(list(row.values()), names=list(row))

    total = 0
    for batch in batches:
        begin = 0
        column = batch.column("text")
        docs = zip(ids_of(batch.column("id")), as_bytes(column), column.is_valid().to_pylist(), strict=True)
        for n, (doc, text, given) in enumerate(docs):
            if total and total + len(text) > limit:
                rest.append(batch.slice(begin, n - begin))
                yield block()
                total, begin = 0, n
            ids.append(doc)
            texts.append(text)
            sizes.append(len(text) if given else -1)
            total += len(text)
        rest.append(batch.slice(begin))
    if ids:
        yield block()


def _rest_bytes(batches: list[pa.RecordBatch]) -> bytes | None:
    """The columns beside id and text, as an Arrow stream; None if there are none."""
    table = pa.Table.from_batches(batches)
    if "rest" not in table.column_names:
        return None
    sink = pa.BufferOutputStream()
    table = table.select(["rest"])
    with pa.ipc.new_stream(sink, table.schema) as writer:
        writer.write_table(table)
    return squeeze(sink.getvalue().to_pybytes())


def packed_blocks(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep_columns: bool = False,
    scale: int = 1,
) -> DataFrame:
    """The documents as stored blocks; every row is in one, with NULL ids and texts.

    With `keep_columns` all columns travel along, under `rest`. A block has about
    `scale` times BLOCK_BYTES. It is numbered by its first row, so rows have numbers too:
    that of their block and their place in it.
    """
    limit = scale * BLOCK_BYTES
    rest = [F.struct(*[F.col(c) for c in docs.columns if c != text_col]).alias("rest")]
    rows = docs.select(
        F.col(id_col).cast("bigint").alias("id"),
        F.col(text_col).alias("text"),
        *(rest if keep_columns else []),
    )
    return stored(rows.mapInArrow(lambda batches: _pack(batches, limit), BLOCK_SCHEMA), "blocks")


def chosen_rows(rows: DataFrame) -> DataFrame:
    """Row numbers (block, row) gathered by block, for a join with the blocks."""
    return rows.groupBy("block").agg(F.collect_list("row").alias("chosen"))


def _by_bucket(answers: list[dict] | None) -> dict[int, bytes]:
    return {answer["bucket"]: answer["payload"] for answer in answers or []}


class Block:
    """One block opened: ids, and the bounds of each text in the joined bytes."""

    def __init__(self, row: dict):
        self.number = row["block"]
        self.ids = np.frombuffer(row["ids"], dtype=np.int64)
        sizes = np.frombuffer(row["sizes"], dtype=np.int64)
        self.given = sizes >= 0  # the others are NULL
        sizes = np.maximum(sizes, 0)
        self.raw = unsqueeze(row["texts"])
        self._rest = row["rest"]
        self.stops = np.cumsum(sizes)
        self.starts = self.stops - sizes
        self.answers = _by_bucket(row.get("answers"))
        self.more = _by_bucket(row.get("more"))  # answers of a second round
        self.chosen = np.sort(np.array(row.get("chosen") or [], dtype=np.int64)) - self.number  # places

    def texts(self) -> list[bytes]:
        return [self.raw[a:b] for a, b in zip(self.starts, self.stops, strict=True)]

    def chosen_texts(self) -> list[bytes]:
        return [self.raw[a:b] for a, b in zip(self.starts[self.chosen], self.stops[self.chosen], strict=True)]

    def rest(self) -> pa.Array:
        """The other columns, as structs."""
        table = pa.ipc.open_stream(unsqueeze(self._rest)).read_all()
        return table.column("rest").combine_chunks()

    def id_column(self) -> pa.Array:
        return pa.array(self.ids, mask=self.ids == NO_ID)


def each_block(batches: Iterator[pa.RecordBatch]) -> Iterator[Block]:
    for batch in batches:
        for n in range(batch.num_rows):
            yield Block(batch.slice(n, 1).to_pylist()[0])
            give_back()


def bucket_count(blocks: DataFrame, bytes_each: int) -> int:
    """Buckets of about `bytes_each` text bytes, so that they grow in number only."""
    total = blocks.agg(F.sum("n_bytes")).first()[0] or 0
    return max(8, -(-total // bytes_each))


def split_by_bucket(keys: np.ndarray, buckets: int) -> Iterator[tuple[int, slice]]:
    """Slices of sorted keys by bucket: a bucket is a range of keys."""
    of = (keys >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)
    cuts = (np.flatnonzero(of[1:] != of[:-1]) + 1).tolist()
    bounds = [0, *cuts, len(keys)] if len(keys) else []
    for lo, hi in zip(bounds, bounds[1:]):
        yield int(of[lo]), slice(lo, hi)


Emit = Callable[[Block], Iterator[tuple[int, bytes]]]
Resolve = Callable[[list[bytes]], list[bytes]]


def ask(blocks: DataFrame, emit: Emit, resolve: Resolve) -> DataFrame:
    """Answers of the buckets, collected by block.

    `emit` gives (bucket, payload) of a block, `resolve` turns the payloads of one
    bucket into as many answers. Blocks that ask nothing have no row.
    """

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in each_block(batches):
            rows = list(emit(block))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([b for b, _ in rows], pa.int32()),
                    pa.array([block.number] * len(rows), pa.int64()),
                    pa.array([p for _, p in rows], pa.binary()),
                ],
                names=["bucket", "block", "payload"],
            )

    def answer(group: pa.Table) -> pa.Table:
        solved = resolve(group.column("payload").to_pylist())
        give_back()
        return group.set_column(2, "payload", pa.array(solved, pa.binary()))

    sent = blocks.mapInArrow(send, SENT_SCHEMA)
    solved = sent.groupBy("bucket").applyInArrow(answer, SENT_SCHEMA)
    return solved.groupBy("block").agg(
        F.collect_list(F.struct("bucket", "payload")).alias("answers")
    )
