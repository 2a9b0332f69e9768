"""Order-preserving packing of token streams by dynamic programming.

Documents of a partition are packed in the order they are read; ids are never
reordered. A window ends at a document's end for free, at a sentence's end for a
small penalty, and inside a sentence for a larger one; its padding counts too. With
f(j) the least cost of all windows up to cut j,

    f(j) = penalty(j) + min over cuts i, at most `capacity` ids back, of
           f(i) + capacity - (position(j) - position(i)),

and a monotone queue over f(i) + position(i) gives the minimum in constant time.
Windows are settled shelf by shelf: the last, unfinished window goes on to the next
shelf, so memory is bounded by a shelf or one document. What is left at the end of a
partition is cut at powers of two, which need no padding, if that costs less.

A tokenizer that drops white space and never joins ids across it encodes words one by
one, and they are remembered; `cuts_at_spaces` tells. Any other encodes whole texts.

Defined cases: a NULL or empty text has the end id only; NULL and repeated ids are
packed row by row; an empty table gives no piece.
"""

from __future__ import annotations

import codecs
import json
import os
import re
import sys
import types
import zlib
from array import array
from collections import deque
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.llm.text import as_bytes, give_back, slices

CAPACITY = 4096
END_ID = 2
SENTENCE_CUT = 4
INNER_CUT = 48
SHELF = 1 << 19
SLICE = 2 << 20  # text bytes encoded at a time
REMEMBERED = 48 << 20  # bytes of words in a generation of a worker's memory
REMEMBERED_LATE = 16 << 20  # the same where earlier stages have filled the executor
ENTRY = 150  # bytes an entry takes beside word and ids

RESULT = (
    "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
    "sequence_id bigint, offset bigint"
)


def default_tokenizer() -> str:
    import public_tokenizers

    return str(public_tokenizers.path("word_bpe_49k.json"))


# Marks at the end of a word, behind a letter, are a piece of their own for the tokenizer.
_MARKS = b".,!?;:#$%&*"
_LETTERS = re.compile(rb"(?:[a-z]|\xc3[\x9f-\xb6\xb8-\xbf])+")
_LAST_LETTER = re.compile(rb"(?:[a-z]|\xc3[\x9f-\xb6\xb8-\xbf])\Z")


# Capitals beyond ASCII have their small letters 32 places on.
_CAPITALS = re.compile(rb"(?:[a-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+")
_SMALL = bytes(n + 32 if 0x80 <= n < 0x9F and n != 0x97 else n for n in range(256))


def _byte_letters() -> str:
    """The letters that byte-level vocabularies write bytes with, by byte: visible ones are themselves."""
    visible = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = dict(zip(sorted(set(range(256)) - visible), range(256, 512), strict=False))
    return "".join(chr(others.get(n, n)) for n in range(256))


# How a tokenizer must cut texts for words to be encoded one by one.
_CUTS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_NORMAL = ["NFC", "Replace", "Lowercase"]


def cuts_at_spaces(definition: str) -> bool:
    """Whether the word-wise shortcuts hold for a tokenizer: they are made for one kind."""
    parts = json.loads(definition)
    normal = [step.get("type") for step in (parts.get("normalizer") or {}).get("normalizers", [])]
    steps = (parts.get("pre_tokenizer") or {}).get("pretokenizers", [])
    model = parts["model"]
    return (
        model.get("type") == "BPE"
        and not any(model.get(key) for key in ("dropout", "continuing_subword_prefix", "byte_fallback", "ignore_merges"))
        and normal == _NORMAL
        and [step.get("type") for step in steps] == ["Split", "ByteLevel"]
        and steps[0]["pattern"] == {"Regex": _CUTS}
        and steps[0]["behavior"] == "Removed"
        and steps[0]["invert"]
        and not steps[1]["add_prefix_space"]
        and all(token["content"].startswith("<|") for token in parts.get("added_tokens", []))
    )


class Words(dict):
    """Ids of words as bytes, learnt when first asked for.

    Two generations bound the memory: once the young one is full it becomes the old one,
    and a word asked for again moves over. Frequent words are never learnt twice.
    """

    def __init__(self, learn: Callable[[bytes], bytes], limit: int = REMEMBERED):
        self.learn = learn
        self.limit = limit
        self.size = 0
        self.old: dict[bytes, bytes] = {}

    def __missing__(self, word: bytes) -> bytes:
        ids = self.old.get(word)
        if ids is None:
            ids = self.learn(word)
        self.size += len(word) + len(ids) + ENTRY
        if self.size > self.limit:
            self.old = dict(self)
            self.clear()
            self.size = 0
        self[word] = ids
        return ids


class Encoder:
    """Encodes texts word by word, remembering the ids of each word as bytes."""

    def __init__(self, definition: str, by_word: bool | None = None, remembered: int = REMEMBERED):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # tasks are the unit of parallel work
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(definition)
        self.model = self.tokenizer.model
        self.letters = _byte_letters()
        self.by_word = cuts_at_spaces(definition) if by_word is None else by_word
        self.words = Words(self._learn, remembered)
        vocabulary = self.tokenizer.get_vocab()
        self.ends_sentence = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        for token, number in vocabulary.items():
            if token.removesuffix("</w>").endswith((".", "!", "?")):
                self.ends_sentence[number] = True

    def _learn(self, word: bytes) -> bytes:
        stem = word.rstrip(_MARKS)
        if len(stem) < len(word) and _LAST_LETTER.search(stem):
            return self.words[stem] + self.words[word[len(stem) :]]
        if _LETTERS.fullmatch(word):
            # lower-case letters in composed form: nothing to normalise nor to cut
            tokens = self.model.tokenize(codecs.charmap_decode(word, "strict", self.letters)[0])
            return array("I", [token.id for token in tokens]).tobytes()
        if _CAPITALS.fullmatch(word):
            return self.words[word.translate(_SMALL)]
        made = self.tokenizer.encode(word.decode(), add_special_tokens=False)
        return array("I", made.ids).tobytes()

    def forget(self) -> None:
        """Give up all words, and the method in `words` that holds this encoder."""
        self.words.clear()
        self.words.old.clear()
        del self.words.learn

    def encode(self, texts: list[bytes]) -> Iterator[np.ndarray]:
        """Ids of each text, the end id included."""
        end = array("I", [END_ID]).tobytes()
        if not self.by_word:
            for made in self.tokenizer.encode_batch([text.decode() for text in texts], add_special_tokens=False):
                yield np.array([*made.ids, END_ID], dtype=np.uint32)
            return
        for text in texts:
            # capital letters only tell special tokens from others
            words = (text if b"<|" in text else text.lower()).split()
            ids = b"".join(map(self.words.__getitem__, words))
            yield np.frombuffer(ids + end, dtype=np.uint32)


def worker_encoder(definition: str, by_word: bool, remembered: int) -> Encoder:
    """The encoder of this worker process, which outlives a task and so do the words it knows.

    Functions travel by value, so what a process shares is kept at a module of its own.
    """
    name = f"_encoder_{zlib.crc32(definition.encode()):08x}_{remembered}"
    if name not in sys.modules:
        held = types.ModuleType(name)
        held.encoder = Encoder(definition, by_word, remembered)
        give_back()  # what reading the definition took
        sys.modules[name] = held
    return sys.modules[name].encoder


@dataclass
class Shelf:
    """Ids waiting to be cut: parts of documents in order."""

    parts: list[tuple[int | None, int, np.ndarray, int]] = field(default_factory=list)
    total: int = 0

    def put(self, doc: int | None, start: int, ids: np.ndarray, tokens: int) -> None:
        self.parts.append((doc, start, ids, tokens))
        self.total += len(ids)


def cut_costs(shelf: Shelf, ends_sentence: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Possible cuts in ascending order, the first at 0, and their penalties."""
    ids = np.concatenate([part[2] for part in shelf.parts])
    stops = np.cumsum([len(part[2]) for part in shelf.parts])
    cost = np.full(shelf.total + 1, -1, dtype=np.int64)
    cost[np.flatnonzero(ends_sentence[ids]) + 1] = SENTENCE_CUT
    cost[stops] = 0
    cost[0] = 0
    cuts = np.flatnonzero(cost >= 0)
    step = max(1, capacity // 8)
    gaps = np.diff(cuts)
    wide = np.flatnonzero(gaps > step)
    for lo, gap in zip(cuts[wide], gaps[wide], strict=True):
        cost[lo + step : lo + gap : step] = INNER_CUT
    cuts = np.flatnonzero(cost >= 0)
    return cuts, cost[cuts]


def best_cuts(cuts: np.ndarray, costs: np.ndarray, capacity: int, last: bool) -> list[int]:
    """Ends of the windows; the rest after the last one stays open unless `last`."""
    places, penalties = cuts.tolist(), costs.tolist()
    best = [0] * len(places)
    back = [0] * len(places)
    queue = deque([(0, 0, 0)])  # (best + place, place, number), values ascending
    for n in range(1, len(places)):
        place = places[n]
        while queue[0][1] < place - capacity:
            queue.popleft()
        value, _, back[n] = queue[0]
        best[n] = value + capacity - place + penalties[n]
        value = best[n] + place
        while queue and queue[-1][0] >= value:
            queue.pop()
        queue.append((value, place, n))
    end = len(places) - 1
    if not last:
        open_from = np.searchsorted(cuts, places[-1] - capacity, side="right")
        end = min(range(int(open_from), len(places)), key=lambda n: (best[n], -n))
    out = []
    while end:
        out.append(places[end])
        end = back[end]
    return out[::-1]


def _powers(length: int) -> list[int]:
    return [1 << bit for bit in range(length.bit_length() - 1, -1, -1) if length >> bit & 1]


def _windows(shelf: Shelf, ends_sentence: np.ndarray, capacity: int, last: bool) -> list[int]:
    ends = best_cuts(*cut_costs(shelf, ends_sentence, capacity), capacity, last)
    if last and ends:
        begin = ends[-2] if len(ends) > 1 else 0
        sizes = _powers(ends[-1] - begin)
        if INNER_CUT * (len(sizes) - 1) < capacity - (ends[-1] - begin):
            ends[-1:] = (begin + np.cumsum(sizes)).tolist()
    return ends


def _settle(shelf: Shelf, ends: list[int], first_sequence: int) -> tuple[list[tuple], Shelf]:
    """Pieces of the windows that end at `ends`, and what is left."""
    rows = []
    window = begin = at = 0
    rest = Shelf()
    for doc, start, ids, tokens in shelf.parts:
        used = 0
        while used < len(ids) and window < len(ends):
            size = min(len(ids) - used, ends[window] - at)
            piece = ids[used : used + size]
            crc = zlib.crc32(piece.astype("<u4").tobytes())
            rows.append((doc, start + used, size, crc, tokens, first_sequence + window, at - begin))
            used += size
            at += size
            if at == ends[window]:
                window, begin = window + 1, at
        if used < len(ids):
            rest.put(doc, start + used, ids[used:], tokens)
    return rows, rest


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    names = [column.split()[0] for column in RESULT.split(", ")]
    columns = zip(*rows, strict=True) if rows else [[] for _ in names]
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=names)


def pack(
    docs: DataFrame,
    *,
    capacity: int = CAPACITY,
    tokenizer: str | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    remembered: int = REMEMBERED,
    outlives: bool = True,
) -> DataFrame:
    """One row per piece: where its ids lie in the document and in the sequence.

    `remembered` bounds a worker's memory of words; a smaller one costs time, not results.
    Unless it `outlives` a task, each task learns its words anew and gives them back.
    """
    with open(tokenizer or default_tokenizer(), encoding="utf-8") as definition:
        text = definition.read()
    by_word = cuts_at_spaces(text)  # here, as it reads the whole definition
    shared = docs.sparkSession.sparkContext.broadcast(text)

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if outlives:
            encoder = worker_encoder(shared.value, by_word, remembered)
        else:
            encoder = Encoder(shared.value, by_word, remembered)
        sequence = TaskContext.get().partitionId() << 40
        shelf = Shelf()

        def flush(last: bool) -> pa.RecordBatch:
            nonlocal sequence, shelf
            ends = _windows(shelf, encoder.ends_sentence, capacity, last)
            rows, shelf = _settle(shelf, ends, sequence)
            sequence += len(ends)
            return _batch(rows)

        for batch in batches:
            for part in slices(batch, "text", SLICE):
                ids = part.column("id").to_pylist()
                made = encoder.encode(as_bytes(part.column("text")))
                for doc, tokens in zip(ids, made, strict=True):
                    shelf.put(doc, 0, tokens, len(tokens))
                    if shelf.total >= SHELF:
                        yield flush(last=False)
        if shelf.total:
            yield flush(last=True)
        if not outlives:
            encoder.forget()
            encoder = None
            give_back()

    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(pieces, RESULT)
