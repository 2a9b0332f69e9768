"""Quality classifier: held-out accuracy, plain features, learning and odd rows."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import brute
from eventloom.llm import classifier

SF = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def report(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{name}.parquet") for name in ("documents", "labels"))
    return classifier.classifier_report(docs, labels).cache(), docs, labels


def test_held_out_accuracy(report):
    scored, docs, labels = report
    rows = scored.join(labels, "doc_id").where("held_out").select("doc_id", "score", "predicted", "quality").collect()
    assert len(rows) > 500
    assert sum(r.predicted == r.quality for r in rows) >= 0.98 * len(rows)
    good = sorted(r.score for r in rows if r.quality == 1)
    bad = sorted(r.score for r in rows if r.quality == 0)
    above = sum(g > b for g in good for b in bad)
    assert above >= 0.995 * len(good) * len(bad)
    assert sum(g < classifier.THRESHOLD for g in good) <= 0.005 * len(good)


def test_one_row_per_document(report):
    scored, docs, _ = report
    assert scored.columns == ["doc_id", "held_out", "score", "predicted"]
    rows = scored.collect()
    assert sorted(r.doc_id for r in rows) == sorted(r.doc_id for r in docs.select("doc_id").collect())
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)


def test_scores_do_not_know_labels_of_held_out_rows_nor_other_columns(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    wanted = brute.rows_of(classifier.classifier_report(docs, labels))
    flipped = labels.withColumn("quality", F.when(classifier.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    other = docs.withColumns({"lang": F.lit("xx"), "source": F.lit("s"), "n_chars": F.lit(0)})
    assert brute.rows_of(classifier.classifier_report(other, flipped)) == wanted


def shape(word):
    out = ""
    for letter in word:
        for byte in letter.encode():
            sign = "a" if byte >= 0x80 or 0x61 <= byte <= 0x7A else "A" if 0x41 <= byte <= 0x5A else "0" if 0x30 <= byte <= 0x39 else chr(byte)
            out += sign if not out.endswith(sign) else ""
    return out


def features(text):
    words = brute.SPACED.findall(text)
    lower, shapes = [brute.lower(w) for w in words], [shape(w) for w in words]
    pairs = [("same",) if a == b else (a, b) for a, b in zip(lower, lower[1:])]
    return [*[("w", w) for w in lower], *[("p", p) for p in pairs], *[("s", s) for s in shapes], *[("q", *p) for p in zip(shapes, shapes[1:])]]


def test_slots_stand_for_features():
    texts = ["One two, TWO two 12\n12 é É!!", "", "x", "   ", "aa,,bb A1 ($%) one two,", "Same same same"]
    slots, counts = classifier.feature_slots([t.encode() for t in texts])
    slot_of = {}
    for text, own in zip(texts, np.split(slots, np.cumsum(counts)[:-1]), strict=True):
        named = features(text)
        assert len(named) == len(own)
        by_count = Counter(own.tolist())
        for name, times in Counter(named).items():
            slot_of.setdefault(name, set()).update(s for s, n in by_count.items() if n == times)
    assert all(slot_of.values()) and slots.max() < classifier.DIM
    alone = [classifier.feature_slots([t.encode()])[0].tolist() for t in texts]
    assert sum(alone, []) == slots.tolist()


def test_updates_follow_the_regularised_leader():
    """Each coordinate minimises gradient sums, the proximal terms and both penalties."""
    model = classifier.Ftrl()
    gradients, rates, weights = [], [0.0], []
    for label in (1, 0, 0, 1, 0):
        w, bias = model.weights()[5], model.weights()[-1]
        error = 1 / (1 + math.exp(-(w * classifier.SCALE + bias))) - label
        model.learn(np.array([5, 5, 5], dtype=np.int32), label)
        gradients.append(error * classifier.SCALE)
        rates.append(math.sqrt(sum(g * g for g in gradients)) / classifier.ALPHA)
        weights.append(w)
    z = sum(g - (b - a) * w for g, a, b, w in zip(gradients, rates, rates[1:], weights, strict=False))
    assert math.isclose(model.z[5], z)
    left = math.copysign(max(abs(z) - classifier.L1, 0), z)
    assert math.isclose(model.weights()[5], -left / (classifier.BETA / classifier.ALPHA + rates[-1] + classifier.L2))
    assert np.array_equal(classifier.Ftrl(model.state()).weights(), model.weights()) and not model.weights()[4]


def test_odd_rows(spark):
    docs = brute.odd_documents()
    rng = random.Random(2)
    labels = [(doc, rng.choice([0, 1, None])) for doc, _ in docs for _ in range(rng.randint(0, 2))]
    labels = spark.createDataFrame([*labels, (None, 1), (999, 0)], "doc_id bigint, quality int")
    table = brute.as_table(spark, docs).withColumns({name: F.lit(1) for name in ("score", "state", "held_out", "predicted")})
    rows = classifier.classifier_report(table, labels).collect()
    assert sorted((r.doc_id for r in rows), key=repr) == sorted((d for d, _ in docs), key=repr)
    assert all(r.held_out for r in rows if r.doc_id is None)
    empty = {r.score for r in rows if r.doc_id in (1, 2, 3)}
    assert len(empty) == 1
    unlabelled = classifier.classifier_report(table, labels.where("false")).collect()
    assert {r.score for r in unlabelled} == {0.5}
    assert classifier.classifier_report(table.where("false"), labels).count() == 0


def test_sample_is_bounded(spark, monkeypatch):
    monkeypatch.setattr(classifier, "SAMPLE", 50)
    docs = spark.createDataFrame([(n, f"text {n}") for n in range(1000)] + [(1, "text 1")] * 50, "doc_id bigint, text string")
    labels = spark.createDataFrame([(n, n % 2) for n in range(1000)], "doc_id bigint, quality int")
    sample = classifier.training_sample(docs, labels, "doc_id", "text", "quality")
    ids = [r.id for r in sample.collect()]
    assert 20 < len(ids) < 90 and len(set(ids)) == len(ids)
    assert not any(zlib.crc32(str(i).encode()) % 5 == 0 for i in ids)
