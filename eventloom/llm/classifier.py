r"""Quality classifier: logistic regression over hashed word n-grams, trained by FTRL.

A word is a stretch without ASCII white space. Features of a text are its words and pairs
of words, letters A-Z lower-cased, and the same of word shapes: a shape writes small
letters and anything beyond ASCII as `a`, capitals as `A`, digits as `0`, keeps marks, and
writes a run of one sign once. Shapes say what single words are too rare for. Each feature
is hashed to one of DIM slots, a pair of one word twice to one slot whatever the word; its
value is its share of the text's features, times SCALE. A last weight is the bias.

Training is follow-the-regularised-leader (proximal, per coordinate, L1 and L2) over a
sample of about SAMPLE labelled documents at most, whatever the size of the corpus:
documents are drawn by a hash of their id, one row per id. Each epoch streams them through
one task in the order of another hash, and stores its state, two numbers per slot, in the
shared folder; so memory is bounded by the state. The model is broadcast, DIM + 1 numbers;
scoring is a sparse dot product in one pass over the texts and moves no text.

Only text and labels of documents whose `held_out` is false are learnt from; `held_out`
means that crc32 of the id as text is divisible by 5. Scores depend on the text alone.

Defined cases: a NULL or empty text has the bias only; a NULL id is held out and gets a
score; NULL labels and ids without a text teach nothing; an id with several labels teaches
the smallest, one with several texts the smallest; repeated rows each give a row; without any label every score is 0.5.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from eventloom.llm.blocks import stored
from eventloom.llm.text import SPACED_WORD, Words, as_bytes, mix, pair, slices

DIM = 1 << 18
SAMPLE = 20_000
EPOCHS = 3
SCALE = 16.0
ALPHA, BETA, L1, L2 = 2.0, 1.0, 0.2, 0.1
THRESHOLD = 0.3
FOLDS = 5
U = np.uint64
_SHIFT = U(64 - 18)  # a slot is the upper bits of a name
_SAME = U(0xA5A5A5A5A5A5A5A5)  # the name of every pair of one word twice

_SHAPE = np.arange(256, dtype=np.uint8)
_SHAPE[[*range(0x61, 0x7B), *range(0x80, 0x100)]] = ord("a")
_SHAPE[0x41:0x5B] = ord("A")
_SHAPE[0x30:0x3A] = ord("0")
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32


def _shape_names(words: Words) -> np.ndarray:
    """A name for the shape of each word."""
    out = np.empty(len(words), dtype=U)
    step = 1 << 14
    for lo in range(0, len(words), step):
        starts, ends = words.starts[lo : lo + step], words.ends[lo : lo + step]
        span = slice(starts[0], ends[-1])
        letters = _SHAPE[words.data[span][words.inside[span]]]
        begins = np.cumsum(ends - starts) - (ends - starts)
        new = np.ones(len(letters), dtype=bool)
        new[1:] = letters[1:] != letters[:-1]
        new[begins] = True
        sizes = np.add.reduceat(new.astype(np.int64), begins)
        letters = letters[new].astype(U)
        begins = np.cumsum(sizes) - sizes
        places = np.arange(len(letters)) - np.repeat(begins, sizes)
        out[lo : lo + step] = np.add.reduceat(mix(letters + (places.astype(U) << U(8)) + U(1 << 40)), begins)
    return mix(out)


def feature_slots(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Slots of all features, texts in order, and how many each text has."""
    words = Words(texts, SPACED_WORD)
    if not len(words):
        return np.empty(0, dtype=np.int32), np.zeros(len(texts), dtype=np.int64)
    shapes = _shape_names(words)
    words.data = _LOWER[words.data]
    plain = words.names()
    inner = np.ones(len(words), dtype=bool)  # the last word of a text begins no pair
    inner[words.stop[words.counts > 0] - 1] = False
    slots = np.empty((len(words), 4), dtype=np.int32)
    for column, names in ((0, plain), (2, shapes)):
        second = np.append(names[1:], U(0))
        pairs = pair(names, second) + U(column)
        if column == 0:
            pairs[names == second] = _SAME
        slots[:, column] = names >> _SHIFT
        slots[:, column + 1] = pairs >> _SHIFT
    real = np.ones((len(words), 4), dtype=bool)
    real[:, 1] = real[:, 3] = inner
    return slots[real], np.maximum(4 * words.counts - 2, 0)


class Ftrl:
    """State of the learner: per slot the shifted gradient sum `z` and the squared one `n`."""

    def __init__(self, state: bytes | None = None):
        if state is None:
            self.z, self.n = np.zeros((2, DIM + 1))
        else:
            self.z, self.n = np.frombuffer(state).reshape(2, DIM + 1).copy()

    def weights(self, at: np.ndarray | slice = slice(None)) -> np.ndarray:
        z = self.z[at]
        rate = (BETA + np.sqrt(self.n[at])) / ALPHA + L2
        return np.where(np.abs(z) <= L1, 0.0, (np.sign(z) * L1 - z) / rate)

    def learn(self, slots: np.ndarray, label: int) -> None:
        """One update by a text's slots, repeats included."""
        at, counts = np.unique(slots, return_counts=True)
        values = np.append(counts * (SCALE / max(len(slots), 1)), 1.0)
        at = np.append(at, DIM)
        weights = self.weights(at)
        gradient = (sigmoid(weights @ values) - label) * values
        before = self.n[at]
        after = before + gradient * gradient
        self.z[at] += gradient - (np.sqrt(after) - np.sqrt(before)) / ALPHA * weights
        self.n[at] = after

    def state(self) -> bytes:
        return np.concatenate([self.z, self.n]).tobytes()


def sigmoid(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -500, 500)))


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept from learning."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == 0, F.lit(True))


def training_sample(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str) -> DataFrame:
    """(id, text, label) of about SAMPLE labelled documents at most, stored; none held out."""
    known = labels.where(F.col(label_col).isNotNull() & ~held_out(F.col(id_col)))
    known = known.groupBy(F.col(id_col).alias("id")).agg(F.min(label_col).cast("int").alias("label"))
    one_in = max(1, -(-known.count() // SAMPLE))
    drawn = known.where(F.pmod(F.xxhash64("id"), F.lit(one_in)) == 0)
    texts = docs.where(~held_out(F.col(id_col))).select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    # SAMPLE ids and labels at most, so this side may be broadcast whatever the corpus
    found = texts.where("text is not null").join(F.broadcast(drawn), "id")
    return stored(found.groupBy("id", "label").agg(F.min("text").alias("text")), "sample")


def train(
    docs: DataFrame,
    labels: DataFrame,
    *,
    label_col: str = "quality",
    id_col: str = "doc_id",
    text_col: str = "text",
    epochs: int = EPOCHS,
) -> np.ndarray:
    """Weights of the slots, the last one being the bias."""
    sample = training_sample(docs, labels, id_col, text_col, label_col)
    state: bytes | None = None
    for epoch in range(epochs):
        shared = docs.sparkSession.sparkContext.broadcast(state)

        def learn(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            model = Ftrl(shared.value)
            for batch in batches:
                for part in slices(batch, "text"):
                    slots, counts = feature_slots(as_bytes(part.column("text")))
                    texts = np.split(slots, np.cumsum(counts)[:-1])
                    for own, label in zip(texts, part.column("label").to_pylist(), strict=True):
                        model.learn(own, label)
            yield pa.RecordBatch.from_arrays([pa.array([model.state()])], names=["state"])

        order = F.xxhash64("id", F.lit(epoch))
        rows = sample.repartition(1).sortWithinPartitions(order, "id").select("text", "label")
        trained = stored(rows.mapInArrow(learn, "state binary"), "state")
        row = trained.first()  # none without any sample
        state = bytes(row["state"]) if row else None
    return Ftrl(state).weights()


def score(docs: DataFrame, weights: np.ndarray, *, text_col: str = "text", name: str = "score") -> DataFrame:
    """The rows of `docs` with the probability of label 1 as a last column `name`."""
    shared = docs.sparkSession.sparkContext.broadcast(weights.tobytes())

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = np.frombuffer(shared.value)
        for batch in batches:
            for part in slices(batch, "text"):
                slots, counts = feature_slots(as_bytes(part.column("text")))
                sums = np.zeros(len(counts))
                some = counts > 0
                if some.any():
                    begins = (np.cumsum(counts) - counts)[some]
                    sums[some] = np.add.reduceat(own[slots], begins) * SCALE / counts[some]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc"), pa.array(sigmoid(sums + own[DIM]))], names=["doc", "score"]
                )

    rows = docs.select(F.struct("*").alias("doc"), F.col(text_col).alias("text"))
    scored = rows.mapInArrow(scan, StructType([rows.schema["doc"], StructField("score", DoubleType())]))
    return scored.select(*[F.col(f"doc.`{c}`").alias(c) for c in docs.columns if c != name], F.col("score").alias(name))


def classifier_report(
    docs: DataFrame, labels: DataFrame, *, threshold: float = THRESHOLD, id_col: str = "doc_id", **options
) -> DataFrame:
    """Every document: whether it was held out, its score and the label it is predicted to have."""
    texts = docs.select(F.col(id_col).alias("doc_id"), "text")
    scored = score(texts, train(texts, labels, **options))
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        F.when(F.col("score") >= threshold, 1).otherwise(0).alias("predicted"),
    )
