"""Suffix-array dedup over bytes by sampled positions and hashed ranks.

Strings of `LENGTH` bytes that start more than once are found without holding the
suffix array itself. Positions get ranks of ever longer prefixes: 8, 16 and 32 bytes
by pairing ranks at offsets 8 and 16, then the whole length by pairing 32-byte ranks
at further offsets. Ranks are 64-bit names, so a pair can be named where it stands;
Spark brings equal pairs together, sorts them, and those that are unique or past the
threshold drop out of the next round.

Sorting every position would move many times the input. Of the 32-byte ranks in a
window of `LENGTH` only the smallest one is a position of the first round: equal
strings choose the same one. Starts in a row with the same position form a run.

* Round 1 sorts (rank of the position, rank of the whole run). A run that also
  occurs in a smaller document goes whole; a position whose rank occurs with one
  kind of run only is settled. Of a rank with many kinds of runs a block sends the two
  at the ends, which show that the rank is open; the runs between them stay open unasked.
* Round 2 sorts (rank of `LENGTH` bytes, rank of the position) for each start of the
  runs left open. These lie at the edges of repeated passages.

Both parts of a pair must agree, 128 bits in all. So a string of 32 bytes that very many
documents hold in differing surroundings costs its bucket of round 1 two pairs a block,
and its starts go to as many buckets of round 2 as they have different `LENGTH` bytes.

Defined cases: a NULL text is empty; a NULL id counts as larger than any other; rows
that repeat an id never remove bytes from each other, but repeats inside each count;
texts shorter than `LENGTH` are kept whole; long texts are read in pieces.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from eventloom.llm.blocks import (
    Block,
    ask,
    bucket_count,
    each_block,
    packed_blocks,
    split_by_bucket,
    squeeze,
    stored,
    unsqueeze,
)
from eventloom.llm.text import gram_names, minimisers, mix, pair

LENGTH = 100
_GRAM = 32
_SPAN = LENGTH - _GRAM + 1
BUCKET_TEXT = 12 << 20
U = np.uint64

RESULT = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"


def _kinds(first: np.ndarray, second: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(sorting order, where a new pair begins in it, number of the pair of each row)."""
    order = np.lexsort((second, first))
    a, b = first[order], second[order]
    new = np.ones(len(order), dtype=bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    kind = np.empty(len(order), dtype=np.int64)
    kind[order] = np.cumsum(new) - 1
    return order, np.flatnonzero(new), kind


def _first_in_text(kind: np.ndarray, text: np.ndarray) -> np.ndarray:
    """Flags of the rows (in order of position) that show a kind for the first time in their text."""
    order = np.lexsort((text, kind))
    new = np.ones(len(order), dtype=bool)
    k, t = kind[order], text[order]
    new[1:] = (k[1:] != k[:-1]) | (t[1:] != t[:-1])
    out = np.empty(len(order), dtype=bool)
    out[order] = new
    return out


class Runs:
    """Starts of a block by their position of the first round, and their ranks."""

    def __init__(self, block: Block):
        data = np.frombuffer(block.raw, dtype=np.uint8)
        self.grams = gram_names(np.concatenate([data, np.zeros(_GRAM - 1, dtype=np.uint8)]))
        places = minimisers(self.grams, _SPAN)
        valid = np.zeros(len(data) + 1, dtype=np.int8)
        room = block.stops - block.starts >= LENGTH
        np.add.at(valid, block.starts[room], 1)
        np.add.at(valid, block.stops[room] - LENGTH + 1, -1)
        starts = np.flatnonzero(np.cumsum(valid[:-1], dtype=np.int8))
        new = np.ones(len(starts), dtype=bool)
        new[1:] = (np.diff(starts) != 1) | (places[starts[1:]] != places[starts[:-1]])
        heads = np.flatnonzero(new)
        self.lo = starts[heads]
        self.size = np.diff(np.append(heads, len(starts)))
        self.text = np.searchsorted(block.starts, self.lo, side="right") - 1
        place = places[self.lo]
        self.rank = mix(self.grams[place])  # smallest ranks crowd together; buckets want them spread
        last = self.lo + self.size - 1 + LENGTH - _GRAM
        whole = (self.size << 8 | (place - self.lo)).astype(U)
        for offset in range(0, _SPAN + LENGTH, _GRAM):
            whole = pair(whole, self.grams[np.minimum(self.lo + offset, last)])
        self.whole = whole
        self.order, self.heads, self.kind = _kinds(self.rank, whole)
        owner = block.ids[self.text]
        self.least = (
            np.minimum.reduceat(owner[self.order], self.heads) if len(self.heads) else owner[:0]
        )
        self.owner = owner
        ranks = self.rank[self.order[self.heads]]
        ends = np.ones(len(ranks) + 1, dtype=bool)
        ends[1:-1] = ranks[1:] != ranks[:-1]
        self.asked = np.flatnonzero(ends[1:] | ends[:-1])  # the first and the last kind of each rank

    def keys(self) -> tuple[np.ndarray, np.ndarray]:
        chosen = self.order[self.heads[self.asked]]
        return self.rank[chosen], self.whole[chosen]


class Starts:
    """Every start of the runs that round 1 has left open."""

    def __init__(self, runs: Runs, beaten: np.ndarray, open_: np.ndarray):
        gone = beaten[runs.kind] | (runs.owner > runs.least[runs.kind])
        repeated = ~_first_in_text(runs.kind, runs.text)
        self.gone_runs = gone | repeated
        left = np.flatnonzero(~self.gone_runs & open_[runs.kind])
        size = runs.size[left]
        begin = np.cumsum(size) - size
        self.at = np.arange(size.sum()) + np.repeat(runs.lo[left] - begin, size)
        self.rank = np.repeat(runs.rank[left], size)
        self.owner = np.repeat(runs.owner[left], size)
        self.text = np.repeat(runs.text[left], size)
        grams = runs.grams
        halves = pair(grams[self.at], grams[self.at + _GRAM])
        rest = pair(grams[self.at + 2 * _GRAM], grams[self.at + LENGTH - _GRAM])
        self.name = pair(halves, rest)
        self.order, self.heads, self.kind = _kinds(self.name, self.rank)  # a name spreads what shares a rank
        self.least = (
            np.minimum.reduceat(self.owner[self.order], self.heads)
            if len(self.heads)
            else self.owner[:0]
        )

    def keys(self) -> tuple[np.ndarray, np.ndarray]:
        chosen = self.order[self.heads]
        return self.name[chosen], self.rank[chosen]


def _send(first, second, least, buckets: int) -> Iterator[tuple[int, bytes]]:
    for bucket, part in split_by_bucket(first, buckets):
        yield bucket, squeeze(
            first[part].tobytes() + second[part].tobytes() + least[part].tobytes()
        )


def _sort_pairs(payloads: list[bytes]) -> list[bytes]:
    """Two bits for each pair: a smaller document has it; its first rank has other pairs too."""
    columns = [np.frombuffer(unsqueeze(p), dtype=U).reshape(3, -1) for p in payloads]
    first, second, least = np.concatenate(columns, axis=1)
    least = least.view(np.int64)
    order, heads, kind = _kinds(first, second)
    smallest = np.minimum.reduceat(least[order], heads)
    beaten = smallest[kind] < least
    kinds_first = first[order[heads]]
    same = np.zeros(len(heads) + 1, dtype=bool)
    same[1:-1] = kinds_first[1:] == kinds_first[:-1]
    shared = (same[1:] | same[:-1])[kind]
    bounds = np.cumsum([0] + [column.shape[1] for column in columns])
    return [
        squeeze(np.packbits(beaten[a:b]).tobytes() + np.packbits(shared[a:b]).tobytes())
        for a, b in zip(bounds[:-1], bounds[1:], strict=True)
    ]


def _answered(answers: dict[int, bytes], first: np.ndarray, buckets: int) -> np.ndarray:
    """The two flags of each pair, as two rows."""
    out = np.zeros((2, len(first)), dtype=bool)
    for bucket, part in split_by_bucket(first, buckets):
        bits = np.frombuffer(unsqueeze(answers[bucket]), dtype=np.uint8).reshape(2, -1)
        out[:, part] = np.unpackbits(bits, axis=1, count=part.stop - part.start)
    return out


def _open_starts(block: Block, buckets: int) -> tuple[Runs, Starts]:
    runs = Runs(block)
    flags = np.zeros((2, len(runs.heads)), dtype=bool)
    flags[1] = True  # kinds not asked about are open
    flags[:, runs.asked] = _answered(block.answers, runs.keys()[0], buckets)
    return runs, Starts(runs, *flags)


def _gone(block: Block, buckets: int) -> np.ndarray:
    """Flags of the bytes to remove."""
    runs, starts = _open_starts(block, buckets)
    beaten = _answered(block.more, starts.keys()[0], buckets)[0]
    hit = beaten[starts.kind] | (starts.owner > starts.least[starts.kind])
    by_place = np.argsort(starts.at, kind="stable")
    first = np.empty(len(hit), dtype=bool)
    first[by_place] = _first_in_text(starts.kind[by_place], starts.text[by_place])
    single = starts.at[hit | ~first]
    change = np.zeros(len(block.raw) + 1, dtype=np.int32)
    whole = starts.gone_runs
    np.add.at(change, runs.lo[whole], 1)
    np.add.at(change, (runs.lo + runs.size - 1 + LENGTH)[whole], -1)
    np.add.at(change, single, 1)
    np.add.at(change, single + LENGTH, -1)
    return np.cumsum(change[:-1], dtype=np.int32) > 0


def _whole_letters(data: np.ndarray, gone: np.ndarray) -> np.ndarray:
    """Flags that also take the other bytes of a letter that has lost one."""
    heads = np.flatnonzero((data & 0xC0) != 0x80)
    if not len(heads):
        return gone
    lost = np.logical_or.reduceat(gone, heads)
    return np.repeat(lost, np.diff(np.append(heads, len(data))))


def _solved(docs: DataFrame, id_col: str, text_col: str, keep_columns: bool) -> tuple[DataFrame, int]:
    """Blocks with the answers of both rounds, and the number of buckets."""
    blocks = packed_blocks(docs, id_col, text_col, keep_columns)
    buckets = bucket_count(blocks, BUCKET_TEXT)

    def first_round(block: Block) -> Iterator[tuple[int, bytes]]:
        runs = Runs(block)
        yield from _send(*runs.keys(), runs.least[runs.asked], buckets)

    def second_round(block: Block) -> Iterator[tuple[int, bytes]]:
        _, starts = _open_starts(block, buckets)
        yield from _send(*starts.keys(), starts.least, buckets)

    # the answers are small; stored apart from the texts, each is made once
    once = blocks.join(stored(ask(blocks, first_round, _sort_pairs), "ranks"), "block", "left")
    more = ask(once, second_round, _sort_pairs).withColumnRenamed("answers", "more")
    return once.join(more, "block", "left"), buckets


def suffix_report(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: counts of bytes and removed runs, digest of the bytes kept."""
    solved, buckets = _solved(docs, id_col, text_col, keep_columns=False)

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in each_block(batches):
            yield _result(block, _gone(block, buckets))

    return solved.mapInArrow(finish, RESULT)


def without_repeats(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents with repeated bytes taken out of their texts, other columns unchanged.

    A letter of several bytes that loses one of them goes whole.
    """
    solved, buckets = _solved(docs, id_col, text_col, keep_columns=True)
    others = [f for f in docs.schema.fields if f.name != text_col]

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in each_block(batches):
            data, gone = np.frombuffer(block.raw, dtype=np.uint8), _gone(block, buckets)
            kept = []
            for a, b in zip(block.starts, block.stops, strict=True):
                own = data[a:b]
                kept.append(own[~_whole_letters(own, gone[a:b])].tobytes())
            texts = pa.array(kept, pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays([block.rest(), texts], names=["rest", "text"])

    schema = StructType([StructField("rest", StructType(others)), StructField("text", StringType())])
    rows = solved.mapInArrow(finish, schema)
    return rows.select(*[F.col("text" if c == text_col else f"rest.`{c}`").alias(c) for c in docs.columns])


def _result(block: Block, gone: np.ndarray) -> pa.RecordBatch:
    data = np.frombuffer(block.raw, dtype=np.uint8)
    removed, spans, digests = [], [], []
    for a, b in zip(block.starts, block.stops, strict=True):
        own, flags = data[a:b], gone[a:b]
        count = int(flags.sum())
        removed.append(count)
        spans.append(int((flags[1:] & ~flags[:-1]).sum() + flags[0]) if count else 0)
        digests.append(hashlib.sha256(own[~flags] if count else own).hexdigest())
    return pa.RecordBatch.from_arrays(
        [
            block.id_column(),
            pa.array(block.stops - block.starts, pa.int64()),
            pa.array(removed, pa.int64()),
            pa.array(spans, pa.int64()),
            pa.array(digests),
        ],
        names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
    )
