"""Language-model scores with stupid backoff over n-gram count tables.

The model is the corpus itself. Counts of all 1- to `order`-grams are partitioned by the
hash of the n-gram. A block of documents counts its own n-grams first and sends each
distinct one once, so a frequent n-gram costs one row per block; buckets sum the counts
and send them back to the blocks, which join them to the n-grams of each document and
add up the scores. The size of what is counted follows the corpus. The longest n-grams are
counted in a second round, which leaves out those that have a part seen too rarely: they
cannot be seen often enough themselves.

An n-gram seen less than `least_count` times counts as unseen, as it may only be the
place that is scored. The score of a word is the relative frequency after the longest
seen context, times `backoff` for each step to a shorter one; words that are rare alone
have the score of one occurrence.

Words are parted by ASCII white space; A-Z are lower-cased. Per document: the number of
words, how many were scored by each order, the sum of log scores in millionths (rounded
per word, so that the sum does not depend on order) and the mean log score.

Defined cases: a NULL or text without words has score 0 and a NULL mean; the first words
of a text have shorter contexts; NULL and repeated ids are scored row by row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

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
from eventloom.llm.text import SPACED_WORD, Words, mix, window_names

ORDER = 3
BACKOFF = 0.4
LEAST_COUNT = 2
BUCKET_TEXT = 12 << 20
BLOCK_SCALE = 4  # larger blocks send a frequent n-gram less often
U = np.uint64

RESULT = (
    "doc_id bigint, n_words bigint, by_order array<bigint>, score_micro bigint, mean_log_score double"
)


class Grams:
    """N-grams of a block by name: distinct ones of some sizes, and the one ending at each word."""

    def __init__(self, words: Words, names: np.ndarray, sizes: range, where: np.ndarray | None = None):
        within = np.arange(len(names)) - np.repeat(words.first, words.counts)
        keys, self.places = [], []
        for n in sizes:
            ends = np.flatnonzero(within >= n - 1 if where is None else (within >= n - 1) & where)
            grams = window_names(names, n)[ends - n + 1] if len(ends) else names[:0]
            # n-grams of different sizes must not meet
            keys.append(mix(grams + U(n)))
            self.places.append(ends)
        self.sizes = sizes
        self.keys, kinds, self.counts = np.unique(
            np.concatenate(keys), return_inverse=True, return_counts=True
        )
        self.kinds = np.split(kinds, np.cumsum([len(ends) for ends in self.places])[:-1])

    def send(self, buckets: int) -> Iterator[tuple[int, bytes]]:
        counts = self.counts.astype(np.uint32)
        for bucket, part in split_by_bucket(self.keys, buckets):
            # keys are sorted, so their steps are small numbers
            steps = np.diff(self.keys[part], prepend=U(0))
            yield bucket, squeeze(_packed(steps) + _packed(counts[part]))

    def fill(self, seen: np.ndarray, answers: dict[int, bytes], buckets: int) -> None:
        """Write the corpus count of the n-gram ending at each word to row n of `seen`."""
        totals = np.zeros(len(self.keys), dtype=np.int64)
        for bucket, part in split_by_bucket(self.keys, buckets):
            totals[part] = _unpacked(unsqueeze(answers[bucket]), np.int64)
        for n, ends, kinds in zip(self.sizes, self.places, self.kinds, strict=True):
            seen[n, ends] = totals[kinds]


class Counted:
    """A block's words and what is known of the counts of their n-grams."""

    def __init__(self, block: Block, order: int, least: int, buckets: int):
        self.words = Words([text.lower() for text in block.texts()], SPACED_WORD)
        self.names = self.words.names()
        self.order, self.least, self.buckets = order, least, buckets
        self.seen = np.zeros((order + 1, len(self.words)), dtype=np.int64)
        self.short = Grams(self.words, self.names, range(1, max(order, 2)))

    def long(self, block: Block) -> Grams:
        """The longest n-grams that may be seen: both their parts have to be."""
        self.short.fill(self.seen, block.answers, self.buckets)
        part = self.seen[self.order - 1] >= self.least
        before = np.append(False, part[:-1])
        return Grams(self.words, self.names, range(self.order, self.order + 1), part & before)


def _packed(numbers: np.ndarray) -> bytes:
    """Numbers byte by byte, all first bytes together, then all second ones: that packs well."""
    return numbers.view(np.uint8).reshape(-1, numbers.itemsize).T.tobytes()


def _unpacked(raw: bytes, kind: type) -> np.ndarray:
    planes = np.frombuffer(raw, dtype=np.uint8).reshape(np.dtype(kind).itemsize, -1)
    return np.ascontiguousarray(planes.T).reshape(-1).view(kind)


def _sum_counts(payloads: list[bytes]) -> list[bytes]:
    keys, counts = [], []
    for payload in payloads:
        raw = unsqueeze(payload)
        size = len(raw) // 12
        keys.append(np.cumsum(_unpacked(raw[: 8 * size], U)))
        counts.append(_unpacked(raw[8 * size :], np.uint32))
    found, kinds = np.unique(np.concatenate(keys), return_inverse=True)
    totals = np.bincount(kinds, np.concatenate(counts), len(found)).astype(np.int64)[kinds]
    bounds = np.cumsum([0] + [len(k) for k in keys])
    return [squeeze(_packed(totals[a:b])) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]


def _scores(counted: Counted, corpus_words: int, backoff: float) -> tuple[np.ndarray, np.ndarray]:
    """(score in millionths, order used) of each word."""
    words, seen, order, least = counted.words, counted.seen, counted.order, counted.least
    seen[0] = corpus_words
    used = np.zeros(len(words), dtype=np.int64)
    ratio = np.full(len(words), 1.0 / max(corpus_words, 1))
    begins = np.repeat(words.first, words.counts)
    deepest = np.minimum(np.arange(len(words)) - begins + 1, order)
    for n in range(order, 0, -1):
        context = seen[0] if n == 1 else np.append(0, seen[n - 1, :-1])
        hit = (used == 0) & (seen[n] >= least) & (deepest >= n)
        ratio[hit] = seen[n, hit] / context[hit]
        used[hit] = n
    steps = np.maximum(deepest - np.maximum(used, 1), 0)
    logs = np.log(ratio) + steps * np.log(backoff)
    return np.round(logs * 1e6).astype(np.int64), used


def lm_scores(
    docs: DataFrame,
    *,
    order: int = ORDER,
    backoff: float = BACKOFF,
    least_count: int = LEAST_COUNT,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per document with its score under the n-gram counts of all documents."""
    if order < 2:
        raise ValueError("stupid backoff needs an order of 2 or more")
    blocks = packed_blocks(docs, id_col, text_col, scale=BLOCK_SCALE)
    buckets = bucket_count(blocks, BUCKET_TEXT)

    def opened(block: Block) -> Counted:
        return Counted(block, order, least_count, buckets)

    def count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in each_block(batches):
            words = sum(len(text.split()) for text in block.texts())
            yield pa.RecordBatch.from_arrays([pa.array([words], pa.int64())], names=["words"])

    corpus_words = blocks.mapInArrow(count_words, "words bigint").agg(F.sum("words")).first()[0] or 0
    short = ask(blocks, lambda block: opened(block).short.send(buckets), _sum_counts)
    once = blocks.join(stored(short, "counts"), "block", "left")
    more = ask(once, lambda block: opened(block).long(block).send(buckets), _sum_counts)
    answered = once.join(more.withColumnRenamed("answers", "more"), "block", "left")

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in each_block(batches):
            counted = opened(block)
            counted.long(block).fill(counted.seen, block.more, buckets)
            micro, used = _scores(counted, corpus_words, backoff)
            sums = np.append(0, np.cumsum(micro))
            words = counted.words
            score = sums[words.stop] - sums[words.first]
            by_order = [
                np.bincount(used[a:b], minlength=order + 1).tolist()
                for a, b in zip(words.first, words.stop, strict=True)
            ]
            mean = score / np.maximum(words.counts, 1) / 1e6
            yield pa.RecordBatch.from_arrays(
                [
                    block.id_column(),
                    pa.array(words.counts, pa.int64()),
                    pa.array(by_order, pa.list_(pa.int64())),
                    pa.array(score, pa.int64()),
                    pa.array(mean, mask=words.counts == 0),
                ],
                names=["doc_id", "n_words", "by_order", "score_micro", "mean_log_score"],
            )

    return answered.mapInArrow(finish, RESULT)


def lm_report(docs: DataFrame) -> DataFrame:
    scores = lm_scores(docs)
    orders = [F.col("by_order")[n].alias(f"n_order_{n}") for n in range(ORDER + 1)]
    return scores.select("doc_id", "n_words", *orders, "score_micro")


SQL = r"""
with words as (
    select doc_id, unnest(w) as word, generate_subscripts(w, 1) as i
    from (
        select doc_id, list_filter(string_split_regex(translate(text,
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x09-\x0D ]+'),
            lambda x: x <> '') as w
        from documents
    )
), grams as (
    select doc_id, i, word as w1,
        lag(word) over d || ' ' || word as w2,
        lag(word, 2) over d || ' ' || lag(word) over d || ' ' || word as w3,
        lag(word) over d as c2,
        lag(word, 2) over d || ' ' || lag(word) over d as c3
    from words window d as (partition by doc_id order by i)
), n1 as (select w1 as g, count(*) as n from grams group by 1),
n2 as (select w2 as g, count(*) as n from grams where w2 is not null group by 1),
n3 as (select w3 as g, count(*) as n from grams where w3 is not null group by 1),
counted as (
    select doc_id, least(i, 3) as deepest, n1.n as k1, n2.n as k2, n3.n as k3,
        b1.n as m1, b2.n as m2, (select count(*) from words) as total
    from grams
    left join n1 on n1.g = w1 left join n2 on n2.g = w2 left join n3 on n3.g = w3
    left join n1 b1 on b1.g = c2 left join n2 b2 on b2.g = c3
), used as (
    select *, case when k3 >= 2 then 3 when k2 >= 2 then 2 when k1 >= 2 then 1 else 0 end as used
    from counted
), scored as (
    select *, cast(round((ln(case used when 3 then k3 / m2 when 2 then k2 / m1
            when 1 then k1 / total else 1 / total end)
        + greatest(deepest - greatest(used, 1), 0) * ln(0.4)) * 1000000) as bigint) as micro
    from used
)
select d.doc_id, count(used) as n_words,
    count(*) filter (where used = 0) as n_order_0,
    count(*) filter (where used = 1) as n_order_1,
    count(*) filter (where used = 2) as n_order_2,
    count(*) filter (where used = 3) as n_order_3,
    cast(coalesce(sum(micro), 0) as bigint) as score_micro
from documents d left join scored s on s.doc_id = d.doc_id group by d.doc_id
"""
