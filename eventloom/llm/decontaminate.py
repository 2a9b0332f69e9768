"""Benchmark decontamination with a generalised suffix automaton of test items.

A window is `window` consecutive words of an item; an item of fewer words, but not
none, is one window. Document words run through the automaton of all items, which
keeps the longest suffix that is part of some item. Where that suffix reaches the
window's length, the last words are a hit.

Long stretches cannot match: a match of two words or more only passes through pairs
of words that are neighbours in some item, which are the automaton's paths of two
steps. These are looked up for all words at once; the automaton then walks the
stretches that are left. Lookups may let a stretch through without cause, never
hold one back.

Defined cases: a NULL text has no words; NULL item texts have no window; items
without an id cause hits but are not listed; repeated item ids are listed once;
repeated documents are judged one by one. No shuffle; rows keep their order.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from eventloom.llm.text import PLAIN_WORD, Words, as_bytes, pair, slices

WINDOW = 10
#: One automaton holds items of so many bytes; more items make more automata.
SHARD_BYTES = 16 << 20
_BITS = 22

_RESULT = [
    StructField("n_words", LongType()),
    StructField("hit_words", ArrayType(LongType())),
    StructField("items", ArrayType(StringType())),
]


class Automaton:
    """Generalised suffix automaton over word sequences, with the items of each window."""

    def __init__(self, items: Sequence[tuple[str | None, Sequence[bytes]]], window: int):
        self.window = window
        self.next: list[dict[bytes, int]] = [{}]
        self.link = [-1]
        self.length = [0]
        for _, words in items:
            last = 0
            for word in words:
                last = self._extend(last, word)
        self.listed: dict[int, set] = {}
        self.short: dict[int, set] = {}
        for item, words in items:
            for _, state, length in self.walk(words):
                if length >= window:
                    self.listed.setdefault(self._window_state(state), set()).add(item)
            if 0 < len(words) < window:
                self.short.setdefault(state, set()).add((len(words), item))
        # the nearest state on the way to the root that ends a short item
        self.ending = [0] * len(self.next)
        for state in sorted(range(1, len(self.next)), key=self.length.__getitem__):
            above = self.link[state]
            self.ending[state] = state if state in self.short else self.ending[above]

    def _extend(self, last: int, word: bytes) -> int:
        known = self.next[last].get(word)
        if known is not None:
            if self.length[known] == self.length[last] + 1:
                return known
            return self._clone(last, word, known)
        state = self._add({}, self.length[last] + 1, 0)
        while last >= 0 and word not in self.next[last]:
            self.next[last][word] = state
            last = self.link[last]
        if last >= 0:
            known = self.next[last][word]
            short = self.length[known] == self.length[last] + 1
            self.link[state] = known if short else self._clone(last, word, known)
        return state

    def _add(self, moves: dict[bytes, int], length: int, link: int) -> int:
        self.next.append(moves)
        self.length.append(length)
        self.link.append(link)
        return len(self.next) - 1

    def _clone(self, last: int, word: bytes, known: int) -> int:
        copy = self._add(dict(self.next[known]), self.length[last] + 1, self.link[known])
        self.link[known] = copy
        while last >= 0 and self.next[last].get(word) == known:
            self.next[last][word] = copy
            last = self.link[last]
        return copy

    def walk(self, words: Sequence[bytes]) -> Iterator[tuple[int, int, int]]:
        """(place, state, longest matching length) after each word."""
        state = length = 0
        for place, word in enumerate(words):
            while state and word not in self.next[state]:
                state = self.link[state]
                length = self.length[state]
            if word in self.next[state]:
                state = self.next[state][word]
                length += 1
            yield place, state, length

    def _window_state(self, state: int) -> int:
        while self.length[self.link[state]] >= self.window:
            state = self.link[state]
        return state

    def hits(self, words: Sequence[bytes]) -> Iterator[tuple[int, int, set]]:
        """(first word, place after the last, items) of each window found."""
        for place, state, length in self.walk(words):
            if length >= self.window:
                yield place + 1 - self.window, place + 1, self.listed[self._window_state(state)]
            end = self.ending[state]
            while end:
                for size, item in self.short[end]:
                    if size <= length:
                        yield place + 1 - size, place + 1, {item}
                end = self.ending[self.link[end]]


class Shard:
    """The automaton and the lookups that find where it has to run."""

    def __init__(self, items: Sequence[tuple[str | None, bytes]], window: int):
        words = Words([text.lower() for _, text in items], PLAIN_WORD)
        split = [words.bytes_of(a, b) for a, b in zip(words.first, words.stop, strict=True)]
        named = [(item, own) for (item, _), own in zip(items, split, strict=True)]
        self.automaton = Automaton(named, window)
        self.least = min([window, *[len(own) for own in split if own]])
        names = words.names()
        of = words.text_of_word()
        self.words = self._table(names)
        self.pairs = self._table(pair(names[:-1], names[1:])[of[1:] == of[:-1]])

    @staticmethod
    def _table(names: np.ndarray) -> np.ndarray:
        table = np.zeros(1 << _BITS, dtype=bool)
        table[names >> np.uint64(64 - _BITS)] = True
        return table

    def stretches(self, words: Words, names: np.ndarray) -> list[tuple[int, int]]:
        """Words (from, to) in which a window may lie; never across two texts."""
        if not len(words):
            return []
        shift = np.uint64(64 - _BITS)
        known = self.words[names >> shift]
        joined = known[1:] & known[:-1] & self.pairs[pair(names[:-1], names[1:]) >> shift]
        inner = words.first[(words.first > 0) & (words.first < len(words))]
        joined[inner - 1] = False
        cuts = np.flatnonzero(~joined) + 1
        starts = np.append(0, cuts)
        stops = np.append(cuts, len(words))
        found = (stops - starts >= self.least) & known[starts]
        return list(zip(starts[found].tolist(), stops[found].tolist(), strict=True))


def _scan(shard, texts: list[bytes]) -> tuple[Words, np.ndarray, dict[int, set]]:
    words = Words([text.lower() for text in texts], PLAIN_WORD)
    hit = np.zeros(len(words), dtype=bool)
    found: dict[int, set] = {}
    for lo, hi in shard.stretches(words, words.names()):
        for first, stop, items in shard.automaton.hits(words.bytes_of(lo, hi)):
            hit[lo + first : lo + stop] = True
            text = int(np.searchsorted(words.first, lo, side="right")) - 1
            found.setdefault(text, set()).update(items - {None})
    return words, hit, found


def _shards(items: DataFrame, id_col: str, text_col: str, window: int, shard_bytes: int) -> list:
    spark = items.sparkSession
    rows = items.select(F.col(id_col).cast("string"), F.col(text_col).cast("binary").alias("text"))
    rows = rows.where("text is not null").dropDuplicates()
    size = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    count = max(1, -(-size // shard_bytes))
    shards = []
    for n in range(count):
        own = rows.where(F.pmod(F.xxhash64("text"), F.lit(count)) == n).collect()
        shard = Shard([(row[0], bytes(row[1])) for row in own], window)
        # bytes, since a broadcast object's class would have to be installed on executors
        shards.append(spark.sparkContext.broadcast(cloudpickle.dumps(shard)))
    return shards


def find_leaks(
    docs: DataFrame,
    items: DataFrame,
    *,
    window: int = WINDOW,
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    shard_bytes: int = SHARD_BYTES,
) -> DataFrame:
    """All columns of `docs` under `doc`, with n_words, hit_words and items.

    `hit_words` has [from, to, from, to, ...] of the stretches of hit words, `items`
    the sorted ids found. Items beyond `shard_bytes` are spread over several
    automata, which all documents pass one after the other.
    """
    columns = docs.columns
    # beside the text, so that workers get it once
    beside = [F.col(name) for name in columns if name != text_col] or [F.lit(0).alias("_none")]
    for n, shard in enumerate(_shards(items, item_id_col, item_text_col, window, shard_bytes)):
        if n == 0:
            docs = docs.select(F.struct(*beside).alias("doc"), F.col(text_col).alias("text"))
            docs = docs.withColumn("n_words", F.lit(None).cast("bigint"))
            docs = docs.withColumn("hit_words", F.lit(None).cast("array<bigint>"))
            docs = docs.withColumn("items", F.lit(None).cast("array<string>"))

        def scan(batches, packed=shard):
            shard = pickle.loads(packed.value)
            for batch in batches:
                for part in slices(batch, "text"):
                    words, hit, found = _scan(shard, as_bytes(part.column("text")))
                    earlier = part.column("hit_words").to_pylist()
                    listed = part.column("items").to_pylist()
                    stretches, items = [], []
                    for text, (a, b) in enumerate(zip(words.first, words.stop, strict=True)):
                        own = hit[a:b]
                        for lo, hi in zip(*[iter(earlier[text] or [])] * 2, strict=True):
                            own[lo:hi] = True
                        stretches.append(_edges(own))
                        items.append(sorted({*(listed[text] or []), *found.get(text, ())}))
                    yield pa.RecordBatch.from_arrays(
                        [
                            part.column("doc"),
                            part.column("text"),
                            pa.array(words.counts, pa.int64()),
                            pa.array(stretches, pa.list_(pa.int64())),
                            pa.array(items, pa.list_(pa.string())),
                        ],
                        names=["doc", "text", "n_words", "hit_words", "items"],
                    )

        docs = docs.mapInArrow(scan, StructType([*docs.schema.fields[:2], *_RESULT]))
    whole = [F.col("text" if name == text_col else f"doc.`{name}`").alias(name) for name in columns]
    return docs.withColumn("doc", F.struct(*whole)).drop("text")


def _edges(flags: np.ndarray) -> list[int]:
    if not flags.any():
        return []
    return np.flatnonzero(np.diff(np.concatenate([[0], flags.view(np.int8), [0]]))).tolist()


def leak_report(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """One row per document: counts of words, hit words and items, digest of the item ids."""
    found = find_leaks(docs.select(id_col, "text"), items, **options)
    evens = "aggregate(hit_words, 0L, (s, x) -> x - s)"  # (to - (from - ...)) telescopes
    return found.select(
        F.col(f"doc.{id_col}").alias("doc_id"),
        "n_words",
        F.expr(evens).alias("n_hit"),
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.size("hit_words") > 0).alias("contaminated"),
    )


def remove_leaks(
    docs: DataFrame, items: DataFrame, *, max_coverage: float = 0.5, **options
) -> DataFrame:
    """Documents without their hit words; those with more than `max_coverage` hit go whole."""
    found = find_leaks(docs, items, **options).withColumn(
        "n_hit", F.expr("aggregate(hit_words, 0L, (s, x) -> x - s)")
    )
    kept = found.where(F.col("n_hit") <= max_coverage * F.col("n_words"))
    columns = kept.schema["doc"].dataType.names
    beside = [F.col(f"doc.`{name}`").alias(name) for name in columns if name != "text"] or [F.lit(0).alias("_none")]
    rows = kept.select(F.struct(*beside).alias("doc"), F.col("doc.text").alias("text"), "hit_words")

    def cut(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                texts = as_bytes(part.column("text"))
                words = Words([text.lower() for text in texts], PLAIN_WORD)
                given = part.column("text").is_valid().to_pylist()
                left = [
                    _without(texts[n], words, n, spans) if given[n] else None
                    for n, spans in enumerate(part.column("hit_words").to_pylist())
                ]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc"), pa.array(left, pa.binary()).cast(pa.string())],
                    names=["doc", "text"],
                )

    clean = rows.mapInArrow(cut, StructType(rows.schema.fields[:2]))
    return clean.select(*[F.col("text" if c == "text" else f"doc.`{c}`").alias(c) for c in columns])


def _without(text: bytes, words: Words, n: int, spans: list[int]) -> bytes:
    """Text `n` without the stretches of its words; what parts words stays."""
    starts = words.starts[words.first[n] : words.stop[n]] - words.text_starts[n]
    ends = words.ends[words.first[n] : words.stop[n]] - words.text_starts[n]
    left, at = [], 0
    for lo, hi in zip(spans[::2], spans[1::2], strict=True):
        left.append(text[at : starts[lo]])
        at = ends[hi - 1]
    return b"".join([*left, text[at:]])
