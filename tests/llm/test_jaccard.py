"""Near-dedup of the pipeline against the similarity of every two documents."""

import random
from fractions import Fraction

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from eventloom.llm import jaccard, simhash, stages


def near_copies(seed):
    """Groups of copies with changed words, at similarities around the bound."""
    rng = random.Random(seed)
    docs = []
    for _ in range(12):
        words = [f"w{rng.getrandbits(20)}" for _ in range(rng.randint(30, 200))]
        for _ in range(8):
            own = list(words)
            for n in rng.sample(range(len(own)), rng.randint(0, len(own) // 30)):
                own[n] = f"x{rng.getrandbits(20)}"
            docs.append(" ".join(own).title())
    rng.shuffle(docs)
    return list(enumerate(docs))


def stage(spark, docs):
    table = brute.as_table(spark, docs, clashing=True)
    return sorted((r.doc_id for r in stages.near_dedup(spark, table, "").collect()), key=repr)


@pytest.mark.parametrize("seed", [1, 2])
def test_similarity_around_the_bound(spark, seed):
    docs = near_copies(seed)
    assert stage(spark, docs) == brute.kept_of_similar(docs)


def test_exactly_the_bound(spark):
    words = [f"w{n}" for n in range(100)]
    docs = [
        (1, " ".join(words[:94])), (2, " ".join(words[18:94])),  # 72 of 90 shingles
        (3, " ".join(words[:40][::-1])), (4, " ".join(words[:40][::-1][:32])),  # 28 of 36
    ]
    assert stage(spark, docs) == [1, 3, 4]


def test_odd_documents(spark):
    docs = brute.odd_documents()
    assert stage(spark, docs) == brute.kept_of_similar(docs)


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_given_tables(spark, sf):
    df = spark.read.parquet(f"/root/testdata/{sf}/documents.parquet")
    docs = [tuple(r) for r in df.select("doc_id", "text").collect()]
    got = stages.near_dedup(spark, df, "")
    assert got.columns == df.columns
    assert sorted((r.doc_id for r in got.collect()), key=repr) == brute.kept_of_similar(docs)


def test_no_documents(spark):
    table = brute.as_table(spark, brute.odd_documents()).where("false")
    assert stages.near_dedup(spark, table, "").count() == 0
    blank = brute.as_table(spark, [(None, None), (None, ""), (3, " "), (3, None)])
    assert [r.doc_id for r in stages.near_dedup(spark, blank, "").collect()] == [3]


def test_repeated_rows_and_nulls_come_back_as_they_were(spark):
    docs = [(1, None), (2, "some words of a text that is short"), (2, "some words of a text that is short"), (None, "x y")]
    kept = stages.near_dedup(spark, brute.as_table(spark, docs), "")
    assert brute.rows_of(kept, "doc_id", "text", "lang") == brute.ordered(
        [(1, None, "en"), (2, docs[1][1], "en"), (None, "x y", "en")]
    )


def opened(spark, docs):
    """Rows that may have a link, and the blocks they are in."""
    table = spark.createDataFrame(docs, "doc_id bigint, text string")
    blocks = jaccard.packed_blocks(table)
    rows = jaccard._digests(blocks, 5).select("block", "row")
    texts = blocks.join(jaccard.chosen_rows(rows), "block")
    counts = jaccard._ask_counts(texts, 5, 8)
    return jaccard.stored(jaccard._open_rows(texts.join(counts, "block"), 5, Fraction(4, 5), 8), "open"), blocks


def test_large_group_gives_few_pairs(spark):
    words = [f"w{n}" for n in range(200)]
    docs = [(n, " ".join([*words[:n], "other", *words[n + 1 :]])) for n in range(200)]
    found = jaccard.links(*opened(spark, docs), 5, Fraction(4, 5))
    assert found.count() < 6 * len(docs) and found.where(F.col("a") == F.col("b")).isEmpty()


def test_parities_never_part_similar_sets(spark):
    rng = np.random.default_rng(5)
    sets = []
    for size in (1, 5, 40, 146, 900):
        base = rng.integers(0, 1 << 62, size, dtype=np.uint64)
        for _ in range(12):
            own = base.copy()
            own[rng.choice(size, rng.integers(0, size // 6 + 1), replace=False)] = rng.integers(0, 1 << 62)
            sets.append(np.unique(own))
    rows = [(n, len(own), 1, jaccard._parities(own).tolist()) for n, own in enumerate(sets)]
    df = spark.createDataFrame(rows, "node int, size int, place int, bits array<bigint>")
    side = lambda name: df.select(F.struct("node", "size", "place").alias(name), F.col("bits").alias(f"{name}_bits"))
    least = Fraction(4, 5)
    passed = {tuple(r) for r in side("x").join(side("y"), jaccard._differ_little(least)).select("x.node", "y.node").collect()}
    similar = {
        (a, b) for a, one in enumerate(sets) for b, two in enumerate(sets)
        if len(np.intersect1d(one, two)) >= least * len(np.union1d(one, two))
    }
    assert similar <= passed and len(passed) < 2 * len(similar)


def test_documents_of_own_shingles_drop_out(spark):
    passage = " ".join(f"p{n}" for n in range(60))
    docs = [(n, passage + " " + " ".join(f"own{n}x{k}" for k in range(60))) for n in range(50)]
    docs += [(100, "a b c d e f g h"), (101, "a b c d e f g h i")]
    open_, _ = opened(spark, docs)
    assert open_.count() == 2


def test_common_passage_forms_no_pairs(spark):
    passage = " ".join(f"p{n}" for n in range(100))
    docs = [(n, passage + " " + " ".join(f"own{n}x{k}" for k in range(18))) for n in range(60)]
    open_, blocks = opened(spark, docs)
    assert open_.count() == 60
    rows = open_.select(
        F.explode("names").alias("name"), "node", F.struct("node", "size", F.col("places")[0].alias("place")).alias("x")
    ).withColumn("label", F.col("node"))
    assert jaccard._could_link(rows.drop("node"), Fraction(4, 5)).isEmpty()
    assert jaccard.links(open_, blocks, 5, Fraction(4, 5)).isEmpty()


def test_fingerprints_of_all_documents_are_searched(spark, monkeypatch):
    often = "one two three four five " * 100
    docs = [(n, often + " ".join(f"own{n}x{k}" for k in range(20))) for n in range(2)]  # near prints, sets differ
    docs += [(n, " ".join(f"other{n}x{k}" for k in range(30))) for n in range(2, 6)]  # shingles nobody else has
    docs += [(6, None), (7, ""), (8, "a b a b a b a b a b a b"), (9, "a b a b a b a b a"), (None, "just so")]
    searched, candidates, tested = [], [], []

    def watched(nodes, *args):
        searched.extend(r.fp & simhash.MASK for r in nodes.select("fp").collect())
        found = node_links(nodes, *args)
        candidates.extend(frozenset(r) for r in found.select("a", "b").collect())
        return found

    def noted(pairs, *args):
        tested.extend(frozenset(r) for r in pairs.select("a", "b").collect())
        return checked(pairs, *args)

    node_links, checked = jaccard.node_links, jaccard._checked
    monkeypatch.setattr(jaccard, "node_links", watched)
    monkeypatch.setattr(jaccard, "_checked", noted)
    assert stage(spark, docs) == brute.kept_of_similar(docs)
    assert set(searched) == {brute.simhash(text, 5) for _, text in docs}
    assert any(len(pair) == 2 for pair in candidates)
    assert {pair for pair in candidates if len(pair) == 2} <= set(tested)
