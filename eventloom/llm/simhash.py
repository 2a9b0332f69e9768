"""SimHash near-dedup with BK-trees.

A fingerprint has the bits set in over half the XXH64 hashes of a text's word
shingles. Fingerprints with `radius` or fewer differing bits are linked.

Two fingerprints within the radius, cut into radius + KEEP pieces, agree on at least
KEEP pieces. So each fingerprint goes to one shard per choice of KEEP pieces, and
every link lies in some shard. Shards have keys of a fixed width, 25 or 26 bits for a radius
of three: beyond that many distinct fingerprints they grow in size too, and a shard of
fingerprints that share many bits is searched in one task whatever its size.
A shard is searched with a BK-tree: children are keyed by their distance to the parent,
and a search follows only edges within the radius. Trees are built where their shard
is, since a broadcast of all fingerprints has no bound.

Copies that differ in a few bits agree on most pieces and crowd one shard. There,
members are first joined with those one bit away by lookups, and only members outside
the largest group search the tree, which still holds all.

Only distinct fingerprints are searched, so copies cost nothing. Shards return a
spanning set of links; components are joined over written tables.

Defined cases: a NULL or empty text has fingerprint zero and is linked like any other;
a text of fewer words than a shingle is one shingle; NULL ids are in their component
but never name it (a component of NULL ids only has a NULL name); repeated rows each
give a row.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from eventloom.llm.blocks import stored
from eventloom.llm.components import components
from eventloom.llm.text import as_bytes, slices

SHINGLE = 3
RADIUS = 3
KEEP = 2
SEED = 42
CROWDED = 32  # shards of more members are first joined bit by bit
MASK = (1 << 64) - 1
U = np.uint64


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """64-bit SimHash; zero without words."""
    words = text.lower().split()  # bytes: A-Z and ASCII white space only
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(word) + 1 for word in words]) - 1
    starts = np.append(0, ends[:-1] + 1)
    size = min(shingle, len(words))
    bounds = zip(starts[: len(words) - size + 1].tolist(), ends[size - 1 :].tolist(), strict=True)
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], SEED) for a, b in bounds], dtype=U)
    counts = np.zeros(64, dtype=np.int64)
    for lo in range(0, len(hashes), 1 << 14):
        bits = np.unpackbits(hashes[lo : lo + (1 << 14)].view(np.uint8), bitorder="little").reshape(-1, 64)
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view(U)[0])


def with_fingerprints(docs: DataFrame, shingle: int = SHINGLE, text_col: str = "text") -> DataFrame:
    """All columns of `docs` under `doc`, with the fingerprint `fp` as a signed number."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                made = [fingerprint(text, shingle) for text in as_bytes(part.column("text"))]
                signed = pa.array(np.array(made, dtype=U).view(np.int64))
                yield pa.RecordBatch.from_arrays([part.column("doc"), signed], names=["doc", "fp"])

    rows = docs.select(F.struct("*").alias("doc"), F.col(text_col).alias("text"))
    return rows.mapInArrow(scan, StructType([rows.schema["doc"], StructField("fp", LongType())]))


class BKTree:
    """Burkhard-Keller tree over 64-bit fingerprints with Hamming distance."""

    def __init__(self, root: int):
        self.prints = [root]
        self.children: list[dict[int, int]] = [{}]

    def near(self, value: int, radius: int) -> Iterator[int]:
        """Places of the members within the radius."""
        waiting = [0]
        while waiting:
            node = waiting.pop()
            apart = (self.prints[node] ^ value).bit_count()
            if apart <= radius:
                yield node
            for edge, child in self.children[node].items():
                if apart - radius <= edge <= apart + radius:
                    waiting.append(child)

    def add(self, value: int) -> None:
        node = 0
        while True:
            apart = (self.prints[node] ^ value).bit_count()
            child = self.children[node].get(apart)
            if child is None:
                self.children[node][apart] = len(self.prints)
                self.prints.append(value)
                self.children.append({})
                return
            node = child


def shard_links(prints: list[int], radius: int) -> list[tuple[int, int]]:
    """Links that join whatever is within the radius, at most one less than members."""
    values = [value & MASK for value in prints]  # unsigned: bits of a negative number differ
    root = list(range(len(prints)))
    links = []

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    def unite(x: int, y: int) -> None:
        a, b = find(x), find(y)
        if a != b:
            root[max(a, b)] = min(a, b)
            links.append((prints[x], prints[y]))

    if len(values) > CROWDED and radius:
        place = {value: n for n, value in enumerate(values)}
        for n, value in enumerate(values):
            for bit in range(64):
                m = place.get(value ^ 1 << bit)
                if m is not None and m < n:
                    unite(m, n)
    # whoever is in the largest group is found by the others, if they are near it
    groups = Counter(map(find, range(len(values))))
    largest, size = groups.most_common(1)[0]
    settled = largest if size > 1 else None
    searching = [n for n in range(len(values)) if find(n) != settled]
    if searching:
        tree = BKTree(values[0])
        for value in values[1:]:
            tree.add(value)
        for n in searching:
            for m in tree.near(values[n], radius):
                unite(m, n)
    return links


def _piece_bounds(radius: int, keep: int) -> list[tuple[int, int]]:
    pieces = radius + keep
    return [(64 * n // pieces, 64 * (n + 1) // pieces) for n in range(pieces)]


def _shard_keys(prints: np.ndarray, radius: int, keep: int) -> Iterator[tuple[int, np.ndarray]]:
    """(number of the choice, the chosen bits) for every choice of pieces."""
    for number, chosen in enumerate(combinations(_piece_bounds(radius, keep), keep)):
        mask = sum((1 << hi) - (1 << lo) for lo, hi in chosen)
        yield number, prints & U(mask)


def fingerprint_links(prints: DataFrame, radius: int = RADIUS, keep: int = KEEP) -> DataFrame:
    """Links (a, b) that join all distinct `fp` within the radius."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column(0).to_numpy(zero_copy_only=False)
            for number, key in _shard_keys(values.view(U), radius, keep):
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(values), number, dtype=np.int32)),
                        pa.array(key.view(np.int64)),
                        pa.array(values),
                    ],
                    names=["choice", "key", "fp"],
                )

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for prints in batch.column("prints").to_pylist():
                found += shard_links(prints, radius)
            yield pa.RecordBatch.from_arrays(
                [pa.array([a for a, _ in found], pa.int64()), pa.array([b for _, b in found], pa.int64())],
                names=["a", "b"],
            )

    dealt = prints.mapInArrow(deal, "choice int, key bigint, fp bigint")
    shards = dealt.groupBy("choice", "key").agg(F.sort_array(F.collect_list("fp")).alias("prints"))
    return shards.where(F.size("prints") > 1).select("prints").mapInArrow(search, "a bigint, b bigint")


def _labels(prints: DataFrame, radius: int, keep: int) -> DataFrame:
    """(fp, label) of distinct fingerprints; equal labels are one component."""
    return _labelled(prints, fingerprint_links(prints, radius, keep), "fp")


def _labelled(nodes: DataFrame, links: DataFrame, name: str) -> DataFrame:
    joined = nodes.join(components(links).withColumnRenamed("node", "member"), F.col(name) == F.col("member"), "left")
    return joined.select(name, F.coalesce("label", name).alias("label"))


def node_links(nodes: DataFrame, radius: int = RADIUS, keep: int = KEEP) -> DataFrame:
    """Links (a, b) that join all nodes (node, fp) whose fingerprints are within the radius."""
    first = nodes.groupBy("fp").agg(F.min("node").alias("first"))
    same = nodes.join(first, "fp").where("node != first").select(F.col("first").alias("a"), F.col("node").alias("b"))
    near = fingerprint_links(first.select("fp"), radius, keep)
    left = first.select(F.col("fp").alias("a"), F.col("first").alias("x"))
    right = first.select(F.col("fp").alias("b"), F.col("first").alias("y"))
    return same.union(near.join(left, "a").join(right, "b").select(F.col("x").alias("a"), F.col("y").alias("b")))


def near_groups(
    docs: DataFrame,
    *,
    shingle: int = SHINGLE,
    radius: int = RADIUS,
    keep: int = KEEP,
    id_col: str = "doc_id",
) -> DataFrame:
    """One row per document: doc_id, `fp` and component_id, the smallest id reachable."""
    rows = with_fingerprints(docs.select(id_col, "text"), shingle)
    rows = rows.select(F.col(f"doc.{id_col}").alias("doc_id"), "fp")
    rows = stored(rows, "fingerprints")
    prints = stored(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "prints")
    labelled = prints.join(_labels(prints.select("fp"), radius, keep), "fp")
    smallest = labelled.groupBy("label").agg(F.min("least").alias("component_id"))
    named = labelled.join(smallest, "label").select("fp", "component_id")
    return rows.join(named, "fp").select("doc_id", "fp", "component_id")


def near_report(docs: DataFrame, **options) -> DataFrame:
    text = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return near_groups(docs, **options).select("doc_id", text.alias("fingerprint"), "component_id")
