"""Decontamination, near-dedup, suffix and substring dedup against plain versions."""

import random

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from eventloom.llm import blocks, components, decontaminate, simhash, suffixes, superkmers, text

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def odd(spark):
    docs = brute.odd_documents()
    return docs, brute.as_table(spark, docs).cache()


@pytest.fixture(scope="module")
def given(spark):
    df = spark.read.parquet(f"{SF}/documents.parquet")
    return [tuple(r) for r in df.select("doc_id", "text").collect()], df


def empty(df):
    return df.where("false")


# --- names and windows --------------------------------------------------------


def test_names_tell_words_apart():
    words = text.Words([b"a b ab", b"", b"ba a"], text.SPACED_WORD)
    names = words.names()
    assert words.counts.tolist() == [3, 0, 2]
    assert len(set(names.tolist())) == 4 and names[0] == names[4]


def test_gram_names_agree_with_equal_bytes():
    data = np.frombuffer(b"xyz" + bytes(range(60)) + b"q" + bytes(range(60)), dtype=np.uint8)
    names = text.gram_names(data)
    assert len(names) == len(data) - 31
    assert (names[3:32] == names[64:93]).all() and names[2] != names[63]


@pytest.mark.parametrize("size", [1, 2, 7, 69])
def test_minimisers_by_hand(size):
    names = np.random.default_rng(5).integers(0, 1 << 60, 200_000, dtype=np.uint64)
    names[1000:1200] = 7 << 40  # ties: the last one counts
    got = text.minimisers(names, size)
    for p in [*range(0, 3000, 7), 65_500, 65_536 - size, 131_070, len(got) - 1]:
        window = names[p : p + size] >> np.uint64(16)
        assert got[p] == p + int(np.flatnonzero(window == window.min())[-1])


# --- decontamination ----------------------------------------------------------


def items_for(docs):
    texts = [t for _, t in docs if t and len(t.split()) > 30]
    words = [t.split() for t in texts]
    items = [(str(n), " ".join(w[5:25])) for n, w in enumerate(words[:6])]
    items += [("s", " ".join(words[2][3:6])), ("one", words[3][1]), ("e", ""), ("n", None), (None, " ".join(words[4][:14]))]
    return [*items, items[0], ("again", items[0][1])]


@pytest.mark.parametrize("shard_bytes", [1 << 24, 300])
def test_leaks(spark, odd, shard_bytes):
    docs, df = odd
    items = items_for(docs)
    table = spark.createDataFrame(items, "item_id string, text string").withColumn("words", F.lit(1))
    got = brute.rows_of(decontaminate.leak_report(df, table, shard_bytes=shard_bytes))
    assert got == brute.ordered(brute.leaks(docs, items))
    assert any(row[5] for row in got) and not all(row[5] for row in got)


def test_leaks_of_given_tables(spark, given):
    docs, df = given
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    items = [tuple(r) for r in bench.select("item_id", "text").collect()]
    assert brute.rows_of(decontaminate.leak_report(df, bench)) == brute.ordered(brute.leaks(docs, items))


def test_leaks_without_rows(spark, odd):
    docs, df = odd
    none = spark.createDataFrame([], "item_id string, text string")
    assert brute.rows_of(decontaminate.leak_report(df, none)) == brute.ordered(brute.leaks(docs, []))
    assert decontaminate.leak_report(empty(df), none).count() == 0


def test_remove_leaks_cuts_words_and_drops_covered(spark):
    passage = "one two three four five six seven eight nine ten eleven"
    docs = [(1, f"Start here, it goes on and on and on. {passage.title()}! And the end of it follows."), (2, passage), (3, "clean"), (4, None)]
    items = spark.createDataFrame([("a", passage)], "item_id string, text string")
    got = decontaminate.remove_leaks(brute.as_table(spark, docs), items)
    assert got.columns == brute.as_table(spark, docs).columns
    assert brute.rows_of(got, "doc_id", "text") == brute.ordered(
        [(1, "Start here, it goes on and on and on. ! And the end of it follows."), (3, "clean"), (4, None)]
    )


def test_decontamination_sends_a_text_to_workers_once(spark):
    docs = spark.createDataFrame([(1, "a b c", "en")], "doc_id bigint, text string, lang string")
    items = spark.createDataFrame([("i", "x y z")], "item_id string, text string")
    found = decontaminate.find_leaks(docs, items)
    assert found.schema["doc"].dataType.names == docs.columns
    node = found._jdf.queryExecution().optimizedPlan()
    while node.nodeName() != "MapInArrow":
        node = node.children().head()
    assert [field.name() for field in node.schema().fields()[0].dataType().fields()] == ["doc_id", "lang"]


def test_automaton_finds_every_substring():
    rng = random.Random(3)
    items = [(n, [rng.choice([b"a", b"b", b"c"]) for _ in range(rng.randint(1, 40))]) for n in range(20)]
    machine = decontaminate.Automaton(items, 4)
    text_words = [rng.choice([b"a", b"b", b"c", b"d"]) for _ in range(400)]
    for place, _, length in machine.walk(text_words):
        def held(size):
            tail = text_words[place + 1 - size : place + 1]
            return any(tail == own[i : i + size] for _, own in items for i in range(len(own) - size + 1))

        assert held(length) and not (length <= place and held(length + 1))


# --- near-dedup ---------------------------------------------------------------


def test_near_groups(odd):
    docs, df = odd
    got = brute.rows_of(simhash.near_report(df))
    assert got == brute.ordered(brute.near_components(docs))


@pytest.mark.parametrize(("radius", "keep"), [(0, 1), (3, 1), (6, 2)])
def test_links_within_any_radius(spark, radius, keep):
    rng = random.Random(radius)
    prints = [0, *[rng.getrandbits(64) for _ in range(60)]]
    for _ in range(240):
        value = rng.choice(prints)
        for bit in rng.sample(range(64), rng.randint(1, 5)):
            value ^= 1 << bit
        prints.append(value)
    signed = sorted({p - (1 << 64) if p >> 63 else p for p in prints})
    df = spark.createDataFrame([(p,) for p in signed], "fp bigint")
    links = {tuple(r) for r in simhash.fingerprint_links(df, radius, keep).collect()}
    mine, theirs = groups_of(signed, links), groups_of(
        signed, [(a, b) for a in signed for b in signed if ((a ^ b) & (1 << 64) - 1).bit_count() <= radius]
    )
    assert mine == theirs


def groups_of(nodes, links):
    group = {n: n for n in nodes}
    for a, b in links:
        old, new = max(group[a], group[b]), min(group[a], group[b])
        if old != new:
            group = {n: new if g == old else g for n, g in group.items()}
    return group


def test_components_of_chain_and_star(spark):
    edges = [(n, n + 1) for n in range(100, 160)] + [(5, n) for n in range(6, 30)] + [(200, 200), (7, 6), (6, 7)]
    got = {r.node: r.label for r in components.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {**{n: 100 for n in range(100, 161)}, **{n: 5 for n in range(5, 30)}}
    none = components.components(spark.createDataFrame([], "a bigint, b bigint"))
    assert none.count() == 0


def test_no_documents_no_groups(odd):
    assert simhash.near_report(empty(odd[1])).count() == 0


def test_node_links_join_equal_fingerprints(spark):
    nodes = spark.createDataFrame([(1, 8), (2, 8), (3, 9), (4, -1)], "node bigint, fp bigint")
    links = {tuple(r) for r in simhash.node_links(nodes).collect()}
    assert groups_of([1, 2, 3, 4], links) == {1: 1, 2: 1, 3: 1, 4: 4}


# --- suffix dedup -------------------------------------------------------------


def test_suffixes(odd, monkeypatch):
    docs, df = odd
    monkeypatch.setattr(blocks, "BLOCK_BYTES", 2000)  # many blocks, so that repeats lie in several
    assert brute.rows_of(suffixes.suffix_report(df)) == brute.ordered(brute.byte_report(docs))


@pytest.mark.parametrize("seed", [2, 3])
def test_suffixes_of_one_block(spark, seed):
    docs = brute.odd_documents(seed)
    df = brute.as_table(spark, docs)
    assert brute.rows_of(suffixes.suffix_report(df)) == brute.ordered(brute.byte_report(docs))


def test_suffixes_of_given_table(given):
    docs, df = given
    assert brute.rows_of(suffixes.suffix_report(df)) == brute.ordered(brute.byte_report(docs))


def test_without_repeats(odd):
    docs, df = odd
    got = suffixes.without_repeats(df)
    assert got.columns == df.columns
    assert brute.rows_of(got, "doc_id", "text") == brute.ordered(brute.without_repeats(docs))
    assert got.where("fp = 'fp' and lang = 'en'").count() == len(docs)
    assert suffixes.suffix_report(empty(df)).count() == 0


def hot_line(count):
    """A block of texts with one line of 60 bytes in differing surroundings, and its documents."""
    rng = random.Random(7)
    line = "".join(rng.choice("abcdefgh") for _ in range(60))
    some = lambda: "".join(rng.choice("stuvwxyz") for _ in range(90))
    docs = [(n, some() + line + some()) for n in range(count)]
    texts = [t.encode() for _, t in docs]
    row = {"block": 0, "ids": np.arange(count), "sizes": np.array(list(map(len, texts)), dtype=np.int64)}
    row |= {"texts": blocks.squeeze(b"".join(texts)), "rest": None}
    return blocks.Block(row), docs


def test_hot_line_is_spread_over_buckets():
    runs = suffixes.Runs(hot_line(1000)[0])
    _, times = np.unique(runs.keys()[0], return_counts=True)
    assert times.max() <= 2
    _, kinds = np.unique(runs.rank[runs.order[runs.heads]], return_counts=True)
    assert kinds.max() > 100  # of which only two are asked about
    starts = suffixes.Starts(runs, np.zeros(len(runs.heads), dtype=bool), np.ones(len(runs.heads), dtype=bool))
    sizes = [part.stop - part.start for _, part in blocks.split_by_bucket(starts.keys()[0], 64)]
    assert max(sizes) < 2 * np.mean(sizes)


def test_hot_line_with_repeats_around_it(spark, monkeypatch):
    monkeypatch.setattr(blocks, "BLOCK_BYTES", 4000)
    docs = hot_line(150)[1]
    rng = random.Random(8)
    for n in range(150, 300):
        one, two = rng.choice(docs)[1], rng.choice(docs)[1]
        docs.append((n, one[: rng.randint(60, 240)] + two[rng.randint(0, 120) :]))
    rng.shuffle(docs)
    got = brute.rows_of(suffixes.suffix_report(brute.as_table(spark, docs)))
    assert got == brute.ordered(brute.byte_report(docs))


# --- substring dedup ----------------------------------------------------------


@pytest.mark.parametrize("window", [13, 2, 1])
def test_substrings(odd, window, monkeypatch):
    docs, df = odd
    monkeypatch.setattr(blocks, "BLOCK_BYTES", 3000)
    got = superkmers.substring_report(df, window=window)
    assert brute.rows_of(got) == brute.ordered(brute.word_dedup(docs, window))
    assert superkmers.substring_report(empty(df)).count() == 0


def test_substrings_of_given_table(given):
    docs, df = given
    assert brute.rows_of(superkmers.substring_report(df)) == brute.ordered(brute.word_dedup(docs))
