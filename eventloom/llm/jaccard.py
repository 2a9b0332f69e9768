"""Near-dedup by SimHash, checked and completed by the exact Jaccard similarity of shingles.

Documents are linked if the shared part of their word shingle sets is at least
`similarity` of the union. Every document has a SimHash fingerprint; those near each other
(`simhash.node_links`, BK-trees) and shingles that two documents meet by give candidates;
each is checked on the whole sets, so no link is missed and none is guessed.

Which shingles documents meet by: put the shingles of a document in one order that holds
for all documents, rare ones first. Two linked documents share a shingle among the first
n - ceil(s * n) + 1 of each. Their order comes from exact counts over the whole corpus,
asked of hash buckets block by block. A shingle of one document only meets nobody, so a
document with so many of these that they fill its first ones meets nobody by shingles; most
documents of a corpus do not. The places of the first common shingle also bound
what two documents can share, which drops those that have a frequent passage in common
and differ in the rest. All sizes and shingles of the rest stay in, whatever their number.

Large groups of near copies would give a pair for each two of them. So besides the
fingerprints each shingle first links its documents to the smallest of them; in some
rounds more, documents of different components so far are tested against one drawn per
shingle, a pair for each row at most. Only then are all pairs formed that are not yet in one
component, within classes of size, where a class has a member that could share enough, and
where the sets' parities (`_differ_little`) do not show that they differ too much.
Components of these links are those of all links.

Defined cases: upper and lower case of A to Z are alike; a NULL text is empty; texts
without words are copies of each other; a text of fewer words than a shingle is one
shingle; NULL ids come after every other; repeated rows are copies.
Shingles are 64-bit names; sets are told apart by 128 bits.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from fractions import Fraction
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from eventloom.llm.blocks import (
    Block,
    ask,
    bucket_count,
    chosen_rows,
    each_block,
    forget,
    packed_blocks,
    split_by_bucket,
    squeeze,
    stored,
    unsqueeze,
)
from eventloom.llm.components import components
from eventloom.llm.simhash import fingerprint, node_links
from eventloom.llm.text import SPACED_WORD, Words, slices, window_names

BUCKET_TEXT = 12 << 20
CLASSES = 8  # classes of counts per doubling
WORDS = 16  # numbers that hold the parities of a set
ROUNDS = 2  # of drawn pairs, before all that are left
U = np.uint64


def shingle_sets(texts: list[bytes], shingle: int) -> Iterator[np.ndarray]:
    """Sorted distinct shingle names of each text."""
    words = Words([text.lower() for text in texts], SPACED_WORD)  # bytes: A-Z only
    names = words.names()
    full = window_names(names, shingle)
    for a, b in zip(words.first.tolist(), words.stop.tolist(), strict=True):
        if b - a >= shingle:
            yield np.unique(full[a : b - shingle + 1])
        else:
            yield window_names(names[a:b], max(b - a, 1))


def _digests(blocks: DataFrame, shingle: int) -> DataFrame:
    """(block, row, id, one, two, size, fp): each row with digest and size of its set, and its fingerprint."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in each_block(batches):
            texts = block.texts()
            sets = list(shingle_sets(texts, shingle))
            raw = [own.tobytes() for own in sets]
            prints = np.array([fingerprint(text, shingle) for text in texts], dtype=U)
            one, two = (
                pa.array(np.array([xxhash.xxh64_intdigest(r, seed) for r in raw], dtype=U).view(np.int64))
                for seed in (1, 2)
            )
            rows = block.number + np.arange(len(sets))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(sets), block.number)),
                    pa.array(rows),
                    block.id_column(),
                    one,
                    two,
                    pa.array(list(map(len, sets)), pa.int32()),
                    pa.array(prints.view(np.int64)),
                ],
                names=["block", "row", "id", "one", "two", "size", "fp"],
            )

    return blocks.mapInArrow(scan, "block bigint, row bigint, id bigint, one bigint, two bigint, size int, fp bigint")


class Sets:
    """The shingle sets of a block's chosen rows, and their distinct names with counts."""

    def __init__(self, block: Block, shingle: int):
        self.sets = list(shingle_sets(block.chosen_texts(), shingle))
        joined = np.concatenate([np.empty(0, dtype=U), *self.sets])
        self.names, place, counts = np.unique(joined, return_inverse=True, return_counts=True)
        self.counts = np.minimum(counts, 255).astype(np.uint8)
        stops = np.cumsum(list(map(len, self.sets)))
        self.places = np.split(place, stops[:-1]) if len(self.sets) else []


def _count_classes(payloads: list[bytes]) -> list[bytes]:
    """A byte per name: 0 if one document has it, else a class that grows with the count."""
    raw = [unsqueeze(payload) for payload in payloads]
    sizes = [len(part) // 9 for part in raw]
    names = np.concatenate([np.frombuffer(part, dtype=U, count=n) for part, n in zip(raw, sizes, strict=True)])
    counts = np.concatenate([np.frombuffer(part, dtype=np.uint8, offset=8 * n) for part, n in zip(raw, sizes, strict=True)])
    del raw
    order = np.argsort(names)
    names = names[order]
    new = np.append(True, names[1:] != names[:-1])
    del names
    totals = np.add.reduceat(counts[order], np.flatnonzero(new), dtype=np.int64)
    classes = np.minimum(255, CLASSES * np.log2(totals)).astype(np.uint8)
    out = np.empty(len(order), dtype=np.uint8)
    out[order] = np.repeat(classes, np.diff(np.append(np.flatnonzero(new), len(new))))
    bounds = np.cumsum([0, *sizes])
    return [squeeze(out[a:b].tobytes()) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]


def _ask_counts(blocks: DataFrame, shingle: int, buckets: int) -> DataFrame:
    def emit(block: Block) -> Iterator[tuple[int, bytes]]:
        sets = Sets(block, shingle)
        for bucket, part in split_by_bucket(sets.names, buckets):
            yield bucket, squeeze(sets.names[part].tobytes() + sets.counts[part].tobytes())

    return ask(blocks, emit, _count_classes)


OPEN = "node bigint, block bigint, size int, names array<bigint>, places array<int>, bits array<bigint>"


def _parities(own: np.ndarray) -> np.ndarray:
    """For each of so many parts of the names, whether a set has an odd number of them, as bits."""
    odd = np.bincount((own & U(64 * WORDS - 1)).astype(np.int64), minlength=64 * WORDS) & 1
    return np.packbits(odd.astype(bool), bitorder="little").view(np.int64)


def _open_rows(answered: DataFrame, shingle: int, least: Fraction, buckets: int) -> DataFrame:
    """The chosen rows that may have a link: shingles to meet by and their places."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in each_block(batches):
            sets = Sets(block, shingle)
            classes = np.zeros(len(sets.names), dtype=np.uint8)
            for bucket, part in split_by_bucket(sets.names, buckets):
                classes[part] = np.frombuffer(unsqueeze(block.answers[bucket]), dtype=np.uint8)
            nodes, sizes, names, places, bits = [], [], [], [], []
            for place, own, at in zip(block.chosen.tolist(), sets.sets, sets.places, strict=True):
                first = len(own) + 1 + -len(own) * least.numerator // least.denominator
                kind = classes[at]
                alone = int((kind == 0).sum())
                if alone >= first:
                    continue
                order = np.argsort(kind, kind="stable")[alone:first]
                nodes.append(block.number + place)
                sizes.append(len(own))
                names.append(own[order].view(np.int64))
                places.append(np.arange(alone + 1, first + 1))
                bits.append(_parities(own))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(nodes, pa.int64()),
                    pa.array([block.number] * len(nodes), pa.int64()),
                    pa.array(sizes, pa.int32()),
                    pa.array(names, pa.list_(pa.int64())),
                    pa.array(places, pa.list_(pa.int32())),
                    pa.array(bits, pa.list_(pa.int64())),
                ],
                names=["node", "block", "size", "names", "places", "bits"],
            )

    return answered.mapInArrow(scan, OPEN)


def _may_link(least: Fraction) -> Column:
    """Whether x and y, if this is their first common shingle, can share enough."""
    most = F.least(F.col("x.size") - F.col("x.place"), F.col("y.size") - F.col("y.place")).cast("bigint") + 1
    both = F.col("x.size").cast("bigint") + F.col("y.size")
    return most * (least.numerator + least.denominator) >= both * least.numerator


def _differ_little(least: Fraction) -> Column:
    """Whether x and y can be similar by their parities.

    A name that only one of two sets has changes the parity of its part, so parities differ in no
    more parts than the sets differ in names; and similar sets differ in few.
    """
    differing = reduce(
        Column.__add__, [F.bit_count(F.col("x_bits")[n].bitwiseXOR(F.col("y_bits")[n])) for n in range(WORDS)]
    ).cast("bigint")
    both = F.col("x.size").cast("bigint") + F.col("y.size")
    return differing * (least.numerator + least.denominator) <= both * (least.denominator - least.numerator)


def _lean(blocks: DataFrame) -> DataFrame:
    """The blocks without ids and other columns."""
    return blocks.withColumns({"ids": F.lit(b""), "rest": F.lit(None).cast("binary")})


def _checked(pairs: DataFrame, blocks: DataFrame, shingle: int, least: Fraction) -> DataFrame:
    """The pairs (a, b, a_block, b_block) whose sets are similar, as a stored table (a, b)."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in each_block(batches):
            raw = [own.tobytes() for own in shingle_sets(block.chosen_texts(), shingle)]
            nodes = block.number + block.chosen
            yield pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(raw, pa.binary())], names=["node", "names"])

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hit = []
            for x, y in zip(batch.column("x"), batch.column("y"), strict=True):
                one, two = np.frombuffer(x.as_buffer(), dtype=U), np.frombuffer(y.as_buffer(), dtype=U)
                common = len(np.intersect1d(one, two, assume_unique=True))
                hit.append(common * least.denominator >= (len(one) + len(two) - common) * least.numerator)
            yield batch.select(["a", "b"]).filter(pa.array(hit, pa.bool_()))

    one = F.struct(F.col("a_block").alias("block"), F.col("a").alias("row"))
    two = F.struct(F.col("b_block").alias("block"), F.col("b").alias("row"))
    asked = pairs.select(F.explode(F.array(one, two)).alias("asked")).select("asked.*").distinct()
    chosen = _lean(blocks).join(chosen_rows(asked), "block")
    sets = stored(chosen.mapInArrow(pack, "node bigint, names binary"), "sets")
    left = sets.select(F.col("node").alias("a"), F.col("names").alias("x"))
    right = sets.select(F.col("node").alias("b"), F.col("names").alias("y"))
    rows = pairs.select("a", "b").join(left, "a").join(right, "b")
    found = stored(rows.mapInArrow(check, "a bigint, b bigint"), "links")
    forget(sets)
    return found


def _labelled(nodes: DataFrame, links: DataFrame) -> DataFrame:
    labels = components(links).withColumnRenamed("node", "member")
    return nodes.join(labels, F.col("node") == F.col("member"), "left").drop("member").withColumn(
        "label", F.coalesce("label", "node")
    )


def _could_link(rows: DataFrame, least: Fraction) -> DataFrame:
    """Rows (name, label, x) by class of size, without those that nobody of their class can match.

    Linked sizes differ by `least` at most, so they are in one class or in neighbouring ones;
    a row stands in its own class and in the one below, as `own` tells.
    """
    step = 1e-9 - math.log(least)  # a little wide, so that rounding parts no pair at the bound
    size_class = F.floor(F.log(F.col("x.size").cast("double")) / step).cast("int")
    held = rows.withColumn("own", size_class).select(
        "*", F.explode(F.array("own", F.col("own") - 1)).alias("class")
    )
    bounds = held.groupBy("name", "class").agg(
        F.min("label").alias("lo"), F.max("label").alias("hi"),
        F.min("x.size").alias("least_size"), F.max(F.col("x.size") - F.col("x.place")).alias("most_left"),
    )
    left = F.least("most_left", F.col("x.size") - F.col("x.place")).cast("bigint") + 1
    both = F.col("x.size").cast("bigint") + F.col("least_size")
    enough = left * (least.numerator + least.denominator) >= both * least.numerator
    return held.join(bounds.where("lo != hi"), ["name", "class"]).where(enough).select("name", "class", "own", "label", "x")


def links(
    open_: DataFrame, blocks: DataFrame, shingle: int, least: Fraction, prints: DataFrame | None = None
) -> DataFrame:
    """Links (a, b) whose components are those of all similar pairs.

    `prints` has (node, block, fp) of all documents, open or not; made of the blocks if not given.
    """
    where = open_.select("node", "block")
    if prints is None:
        prints = stored(_digests(blocks, shingle).select(F.col("row").alias("node"), "block", "fp"), "prints")
    met = F.explode(F.arrays_zip("names", "places")).alias("met")
    rows = open_.select("node", "block", "size", met).select(
        F.col("met.names").alias("name"), F.struct("node", "size", F.col("met.places").alias("place"), "block").alias("x")
    )
    first = rows.groupBy("name").agg(F.min("x").alias("y"))
    near = rows.join(first, "name").where(F.col("x.node") != F.col("y.node")).where(_may_link(least))
    by_shingle = near.select(F.col("y.node").alias("a"), F.col("x.node").alias("b"))
    by_print = node_links(prints.select("node", "fp")).where("a != b")
    by_print = by_print.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))

    def with_blocks(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
        for side in ("a", "b"):
            named = nodes.select(F.col("node").alias(side), F.col("block").alias(f"{side}_block"))
            pairs = pairs.join(named, side)
        return pairs

    everywhere = prints.select("node", "block").distinct()
    tested = [stored(with_blocks(by_shingle.union(by_print).distinct(), everywhere), "pairs")]
    found = [_checked(tested[0], blocks, shingle, least)]

    def apart() -> DataFrame:
        """Rows of names that still lie in several components."""
        labelled = stored(_labelled(where, _all(found)), "labelled")
        labels = labelled.select(F.col("node").alias("n"), "label")
        left = rows.join(labels, F.col("x.node") == F.col("n")).drop("n")
        left = stored(_could_link(left, least), "apart")
        forget(labelled)
        return left

    def check(pairs: DataFrame) -> None:
        """Test pairs (x, y) that were not tested before."""
        pairs = pairs.where(_may_link(least)).select(
            F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b")
        )
        pairs = pairs.distinct().join(_all(tested).select("a", "b"), ["a", "b"], "left_anti")
        tested.append(stored(with_blocks(pairs, where), "pairs"))
        found.append(_checked(tested[-1], blocks, shingle, least))

    # each row with one other of its name, drawn anew for every name and round
    for number in range(ROUNDS):
        left = apart()
        if left.isEmpty():
            return _all(found)
        drawn = F.struct(F.xxhash64("x.node", "name", F.lit(number)).alias("by"), F.col("x").alias("y"), F.col("label").alias("to"))
        centres = left.groupBy("name", "class").agg(F.min(drawn).alias("centre")).select("name", "class", "centre.y", "centre.to")
        check(left.join(centres, ["name", "class"]).where("label != to"))
        forget(left)

    # all pairs of different components that are left
    left = apart()
    held = left.join(open_.select(F.col("node").alias("n"), "bits"), F.col("x.node") == F.col("n")).drop("n")
    one = held.select("name", "class", "label", "x", F.col("bits").alias("x_bits"))
    two = held.where("class = own").select(
        F.col("name").alias("name2"), F.col("class").alias("class2"), F.col("label").alias("label2"),
        F.col("x").alias("y"), F.col("bits").alias("y_bits"),
    )
    meet = (F.col("name") == F.col("name2")) & (F.col("class") == F.col("class2")) & (F.col("label") != F.col("label2"))
    check(one.join(two, meet & _may_link(least) & _differ_little(least)))
    forget(left, *tested)
    return _all(found)


def _all(tables: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.union, tables)


def keep_one(docs: DataFrame, *, shingle: int, similarity: float, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents with the smallest id of each component, columns unchanged.

    Among rows that repeat the smallest id one is kept; a component of NULL ids keeps one too.
    """
    least = Fraction(str(similarity))
    blocks = packed_blocks(docs, id_col, text_col, keep_columns=True)
    buckets = bucket_count(blocks, BUCKET_TEXT)
    rows = stored(_digests(blocks, shingle), "digests")
    # rows with equal sets are one node, named by the row with the smallest id; texts may still differ
    order = F.struct(F.col("id").isNull().alias("unnamed"), "id", "row", "block")
    same = ["one", "two", "size"]
    firsts = stored(rows.groupBy(*same, "fp").agg(F.min(order).alias("first")), "firsts")
    nodes = stored(firsts.groupBy(*same).agg(F.min("first").alias("first")), "nodes")
    named = nodes.select(*same, F.col("first.row").alias("node"), "first.block")
    prints = stored(firsts.select(*same, "fp").join(named, same).select("node", "block", "fp"), "prints")
    forget(rows, firsts)
    chosen = nodes.where("size > 0").select("first.block", "first.row")
    texts = _lean(blocks).join(chosen_rows(chosen), "block")
    counts = stored(_ask_counts(texts, shingle, buckets), "counts")
    open_ = stored(_open_rows(texts.join(counts, "block"), shingle, least, buckets), "open")
    forget(counts)
    found = links(open_, blocks, shingle, least, prints)
    labels = _labelled(nodes.select(F.col("first.row").alias("node"), "first"), found)
    kept = stored(labels.groupBy("label").agg(F.min("first").alias("first")).select("first.block", "first.row"), "kept")
    forget(nodes, prints, open_)
    return _rows_of(blocks.join(chosen_rows(kept), "block"), docs, text_col)


def _rows_of(chosen: DataFrame, docs: DataFrame, text_col: str) -> DataFrame:
    """The chosen rows with the columns of `docs`."""
    others = [f for f in docs.schema.fields if f.name != text_col]

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in each_block(batches):
            texts = [t if given else None for t, given in zip(block.chosen_texts(), block.given[block.chosen], strict=True)]
            rest = block.rest().take(pa.array(block.chosen))
            part = pa.RecordBatch.from_arrays([rest, pa.array(texts, pa.binary()).cast(pa.string())], names=["rest", "text"])
            yield from slices(part, "text")

    rows = chosen.mapInArrow(unpack, StructType([StructField("rest", StructType(others)), StructField("text", StringType())]))
    return rows.select(*[F.col("text" if c == text_col else f"rest.`{c}`").alias(c) for c in docs.columns])
