"""Substring dedup over words by super-k-mers.

A window is `window` consecutive words of one document. Consecutive windows whose
smallest `MARK`-word name (the minimiser) is the same one form a super-k-mer. Its
words travel once, as one packed string, to the bucket of the minimiser; equal
windows have equal minimisers, so they meet in one bucket. There the windows are
named, sorted and compared by the smallest document they start in.

A block sends each distinct super-k-mer once, with its smallest document, and gets
back one bit for each window: whether a smaller document outside has it too. Windows
are matched by two independent 64-bit names, their own and a salted one.

Defined cases: a NULL text has no words; a NULL id counts as larger than any other;
documents with equal ids (or both NULL) never remove words from each other; documents
shorter than a window keep all words.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from eventloom.llm.blocks import (
    Block,
    ask,
    bucket_count,
    each_block,
    packed_blocks,
    split_by_bucket,
    squeeze,
    unsqueeze,
)
from eventloom.llm.text import SPACED_WORD, Words, minimisers, mix, pair, window_names

WINDOW = 13
MARK = 3
BUCKET_TEXT = 4 << 20  # a bucket gets about three times as much, as windows overlap
U = np.uint64

RESULT = "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string, kept string"


class SuperKmers:
    """Runs of windows of a block that share a minimiser, in the order of their buckets."""

    def __init__(self, words: Words, window: int):
        self.words = words
        self.window = window
        names = words.names()
        self.full = window_names(names, window)
        mark = min(MARK, window)
        marks = window_names(names, mark)
        places = minimisers(marks, window - mark + 1)
        of = words.text_of_word()
        count = max(len(words) - window + 1, 0)
        valid = of[:count] == of[window - 1 :] if count else np.zeros(0, dtype=bool)
        starts = np.flatnonzero(valid)
        new = np.ones(len(starts), dtype=bool)
        new[1:] = (np.diff(starts) != 1) | (places[starts[1:]] != places[starts[:-1]])
        heads = np.flatnonzero(new)
        self.first = starts[heads]
        self.size = np.diff(np.append(heads, len(starts)))
        self.text = of[self.first]
        self.mark = mix(marks[places[self.first]])  # smallest names crowd together; buckets want them spread
        # a run is shorter than a window: its first and last window name all its words
        last = self.full[self.first + self.size - 1]
        self.name = pair(pair(self.full[self.first], last), self.size.astype(U))

    def distinct(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(one run of each kind sorted by minimiser, kind of each run, smallest id of each kind)."""
        order = np.lexsort((self.name, self.mark))
        mark, name = self.mark[order], self.name[order]
        new = np.ones(len(order), dtype=bool)
        new[1:] = (mark[1:] != mark[:-1]) | (name[1:] != name[:-1])
        heads = np.flatnonzero(new)
        kind = np.empty(len(order), dtype=np.int64)
        kind[order] = np.cumsum(new) - 1
        least = np.minimum.reduceat(ids[self.text[order]], heads) if len(heads) else ids[:0]
        return order[heads], kind, least

    def packed(self, chosen: np.ndarray) -> list[bytes]:
        text, starts, ends = self.words.spaced()
        first = self.first[chosen]
        last = first + self.size[chosen] + self.window - 2
        return [text[a:b] for a, b in zip(starts[first], ends[last], strict=True)]


def _emit(block: Block, buckets: int, window: int) -> Iterator[tuple[int, bytes]]:
    runs = SuperKmers(Words(block.texts(), SPACED_WORD), window)
    chosen, _, least = runs.distinct(block.ids)
    packed = runs.packed(chosen)
    for bucket, part in split_by_bucket(runs.mark[chosen], buckets):
        own = packed[part]
        head = len(own).to_bytes(8, "little") + least[part].tobytes()
        yield bucket, squeeze(head + b"\n".join(own))


def _resolve(payloads: list[bytes], window: int) -> list[bytes]:
    counts, ids, texts = [], [], []
    for payload in payloads:
        raw = unsqueeze(payload)
        count = int.from_bytes(raw[:8], "little")
        counts.append(count)
        ids.append(np.frombuffer(raw[8 : 8 + 8 * count], dtype=np.int64))
        texts += raw[8 + 8 * count :].split(b"\n")
    words = Words(texts, SPACED_WORD)
    del texts
    sizes = words.counts - window + 1
    stops = np.cumsum(sizes)
    at = np.arange(stops[-1]) + np.repeat(words.first - (stops - sizes), sizes)
    own = np.repeat(np.concatenate(ids), sizes)
    name = window_names(words.names(), window)[at]
    check = window_names(words.names(salt=1), window)[at]
    order = np.lexsort((check, name))
    name, check = name[order], check[order]
    new = np.ones(len(order), dtype=bool)
    new[1:] = (name[1:] != name[:-1]) | (check[1:] != check[:-1])
    least = np.minimum.reduceat(own[order], np.flatnonzero(new))
    beaten = np.empty(len(order), dtype=bool)
    beaten[order] = least[np.cumsum(new) - 1] < own[order]
    bounds = np.append(0, stops)[np.append(0, np.cumsum(counts))]
    return [
        squeeze(np.packbits(beaten[a:b]).tobytes())
        for a, b in zip(bounds[:-1], bounds[1:], strict=True)
    ]


def _removed(block: Block, words: Words, buckets: int, window: int) -> np.ndarray:
    """Flags of the words to remove."""
    runs = SuperKmers(words, window)
    chosen, kind, least = runs.distinct(block.ids)
    sizes = runs.size[chosen]
    stops = np.cumsum(sizes)
    beaten = np.zeros(int(stops[-1]) if len(stops) else 0, dtype=bool)
    for bucket, part in split_by_bucket(runs.mark[chosen], buckets):
        lo, hi = stops[part.start] - sizes[part.start], stops[part.stop - 1]
        bits = np.frombuffer(unsqueeze(block.answers[bucket]), dtype=np.uint8)
        beaten[lo:hi] = np.unpackbits(bits, count=hi - lo)
    # back from kinds to runs, and from runs to their windows
    offset = np.repeat((stops - sizes)[kind], runs.size)
    within = np.arange(len(offset)) - np.repeat(np.cumsum(runs.size) - runs.size, runs.size)
    later = np.repeat(block.ids[runs.text] > least[kind], runs.size)
    starts = np.repeat(runs.first, runs.size) + within
    hit = starts[beaten[offset + within] | later]
    change = np.zeros(len(words) + 1, dtype=np.int64)
    np.add.at(change, hit, 1)
    np.add.at(change, hit + window, -1)
    return np.cumsum(change[:-1]) > 0


def dedup_substrings(
    docs: DataFrame, *, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per document: counts, the kept words joined by one space, and their digest."""
    blocks = packed_blocks(docs, id_col, text_col)
    buckets = bucket_count(blocks, BUCKET_TEXT)
    answers = ask(
        blocks, lambda block: _emit(block, buckets, window), lambda parts: _resolve(parts, window)
    )

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in each_block(batches):
            words = Words(block.texts(), SPACED_WORD)
            gone = _removed(block, words, buckets, window)
            text, starts, ends = words.spaced()
            kept = []
            for a, b in zip(words.first, words.stop, strict=True):
                if gone[a:b].any():
                    left = np.flatnonzero(~gone[a:b]) + a
                    own = [text[x:y] for x, y in zip(starts[left], ends[left], strict=True)]
                    kept.append(b" ".join(own))
                else:
                    kept.append(text[starts[a] : ends[b - 1]] if b > a else b"")
            total = np.append(0, np.cumsum(gone))
            yield pa.RecordBatch.from_arrays(
                [
                    block.id_column(),
                    pa.array(words.counts, pa.int64()),
                    pa.array(total[words.stop] - total[words.first], pa.int64()),
                    pa.array([hashlib.sha256(text).hexdigest() for text in kept]),
                    pa.array(kept, pa.binary()).cast(pa.string()),
                ],
                names=["doc_id", "n_words", "n_removed", "kept_sha256", "kept"],
            )

    return blocks.join(answers, "block", "left").mapInArrow(finish, RESULT)


def substring_report(docs: DataFrame, **options) -> DataFrame:
    return dedup_substrings(docs, **options).drop("kept")
