"""Texts as byte arrays: slicing batches, finding words, naming strings.

A name is a 64-bit number that stands for a string. Names of longer strings are
made from pairs of names at an offset, so one pass of array operations names
every position of a block.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 19
NO_ID = np.iinfo(np.int64).max  # stands for a NULL id: after every other

U = np.uint64
_K1, _K2, _K3 = U(0x9E3779B97F4A7C15), U(0xC2B2AE3D27D4EB4F), U(0x165667B19E3779F9)
_TILE = 1 << 15  # positions handled at a time, so that arrays stay in the cache

SPACE_BYTES = b" \t\n\x0b\x0c\r"


def byte_class(inside: Iterable[int]) -> np.ndarray:
    table = np.zeros(256, dtype=bool)
    table[list(inside)] = True
    return table


SPACED_WORD = ~byte_class(SPACE_BYTES)
"""Bytes of words parted by ASCII white space."""

PLAIN_WORD = byte_class([*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)])
"""Bytes of words of digits, small letters and anything beyond ASCII."""


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every bit of the input over the result; changes `x`."""
    x ^= x >> U(30)
    x *= U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


def pair(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Name of two names in this order."""
    return mix(first * _K1 + (second ^ (second >> U(29))) * _K2)


def give_back() -> None:
    """Return what the last batch has left to the system: workers outlive their tasks."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Row slices holding up to `limit` text bytes, or one longer text."""
    give_back()
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
    start = total = 0
    for row, size in enumerate(sizes):
        if total and total + size > limit:
            yield batch.slice(start, row - start)
            start, total = row, 0
        total += size
    if start < batch.num_rows:
        yield batch.slice(start)
    give_back()  # a worker may be idle after its last batch


def as_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 of each text; NULL counts as empty."""
    return [b"" if text is None else text for text in column.cast(pa.binary()).to_pylist()]


class Words:
    """Words of some texts: bounds in the joined bytes, and where each text's words begin."""

    def __init__(self, texts: list[bytes], is_word: np.ndarray):
        joined = b"\n".join([*texts, b""])
        self.data = np.frombuffer(joined, dtype=np.uint8)
        lengths = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
        self.text_ends = np.cumsum(lengths + 1) - 1
        self.text_starts = self.text_ends - lengths
        inside = is_word[self.data]
        edges = np.flatnonzero(inside[1:] != inside[:-1]) + 1
        if len(inside) and inside[0]:
            edges = np.concatenate([[0], edges])
        self.starts, self.ends = edges[::2], edges[1::2]  # the last byte is never inside
        self.inside = inside
        self.first = np.searchsorted(self.starts, self.text_starts)
        self.stop = np.append(self.first, len(self.starts))[1:]
        self.counts = self.stop - self.first

    def __len__(self) -> int:
        return len(self.starts)

    def bytes_of(self, lo: int, hi: int) -> list[bytes]:
        data = self.data
        return [data[a:b].tobytes() for a, b in zip(self.starts[lo:hi], self.ends[lo:hi], strict=True)]

    def spaced(self) -> tuple[bytes, np.ndarray, np.ndarray]:
        """All words parted by one space each, with the bounds of each word."""
        lengths = self.ends - self.starts
        ends = np.cumsum(lengths + 1) - 1
        out = np.full(int(ends[-1]) + 1 if len(self) else 0, 0x20, dtype=np.uint8)
        letters = self.data[self.inside]
        out[np.arange(len(letters)) + np.repeat(np.arange(len(self)), lengths)] = letters
        return out.tobytes(), ends - lengths, ends

    def text_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first)), self.counts)

    def names(self, salt: int = 0) -> np.ndarray:
        """A name for each word: the sum of well-spread (byte, place) numbers."""
        out = np.empty(len(self), dtype=U)
        step = 1 << 14  # words handled at a time, so that arrays stay small
        for lo in range(0, len(self), step):
            starts, ends = self.starts[lo : lo + step], self.ends[lo : lo + step]
            lengths = ends - starts
            span = slice(starts[0], ends[-1])
            letters = self.data[span][self.inside[span]]
            begins = np.cumsum(lengths) - lengths
            places = np.arange(len(letters), dtype=np.int64) - np.repeat(begins, lengths)
            letters = places.astype(U) << U(8) | letters
            letters *= _K3
            letters += U(salt)
            mix(letters)
            out[lo : lo + step] = np.add.reduceat(letters, begins) + lengths.astype(U) * _K1
        return mix(out)


def window_names(names: np.ndarray, size: int) -> np.ndarray:
    """Names of `size` consecutive names, by doubling: one for each start that fits."""
    known = 1
    while known < size:
        step = min(known, size - known)
        names = pair(names[:-step], names[step:]) if len(names) > step else names[:0]
        known += step
    return names


def gram_names(data: np.ndarray) -> np.ndarray:
    """Names of the 32 bytes from each position on; `data` needs 31 bytes of padding.

    Eight bytes are read as a number; pairs at offsets 8 and 16 double that twice.
    """
    count = len(data) - 31
    out = np.empty(max(count, 0), dtype=U)
    for lo in range(0, count, _TILE):
        hi = min(lo + _TILE, count)
        size = hi - lo + 24
        part = np.ascontiguousarray(data[lo : hi + 31])
        eight = np.empty(size, dtype=U)
        for shift in range(8):
            view = part[shift : shift + (size - shift + 7) // 8 * 8]
            whole = len(view) // 8
            eight[shift : shift + whole * 8 : 8] = view[: whole * 8].view(np.uint64)
        eight = mix(eight * _K3 + U(1))
        sixteen = pair(eight[:-8], eight[8:])
        out[lo:hi] = pair(sixteen[:-16], sixteen[16:])
    return out


def window_minimum(values: np.ndarray, size: int) -> np.ndarray:
    """Minimum of each `size` consecutive values."""
    known = 1
    while known < size:
        step = min(known, size - known)
        values = np.minimum(values[:-step], values[step:]) if len(values) > step else values[:0]
        known += step
    return values


_PLACE_BITS = 16


def minimisers(names: np.ndarray, size: int) -> np.ndarray:
    """Place of the smallest name in each window of `size`; the last one of equals.

    The upper bits of a name decide, the place fills the lower bits.
    """
    count = len(names) - size + 1
    out = np.empty(max(count, 0), dtype=np.int32 if count < 1 << 31 else np.int64)
    low = U((1 << _PLACE_BITS) - 1)
    step = (1 << _PLACE_BITS) - size
    for lo in range(0, count, step):
        hi = min(lo + step, count)
        places = np.arange(hi - lo + size - 1, dtype=U)
        packed = (names[lo : hi + size - 1] & ~low) | (low - places)
        out[lo:hi] = (low - (window_minimum(packed, size) & low)).astype(out.dtype) + lo
    return out


def ids_of(column: pa.Array) -> np.ndarray:
    return pc.fill_null(column.cast(pa.int64()), NO_ID).to_numpy(zero_copy_only=False)
