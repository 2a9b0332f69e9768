"""Merkle manifest against trees built in plain Python."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

import brute
from eventloom.llm import manifest, ranks


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_leaf(values):
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def climb(nodes, arity):
    """The root of some nodes, and per node the (before, after) of each level."""
    paths = [[] for _ in nodes]
    place = list(range(len(nodes)))
    while len(nodes) > 1:
        for n, at in enumerate(place):
            lo = at - at % arity
            paths[n].append(("".join(nodes[lo:at]), "".join(nodes[at + 1 : lo + arity])))
        nodes = [h(*nodes[i : i + arity]) for i in range(0, len(nodes), arity)]
        place = [at // arity for at in place]
    return nodes[0], paths


def plain_report(rows, arity=3):
    groups = {}
    for row in rows:
        groups.setdefault(row[1], []).append((row[0] is not None, row[0] or 0, plain_leaf(row), row))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for name in names:
        groups[name].sort(key=lambda r: r[:3])
        trees[name] = climb([r[2] for r in groups[name]], arity)
    root, tops = climb([trees[name][0] for name in names], arity) if names else (None, [])
    out = []
    for name, top in zip(names, tops, strict=True):
        subroot, paths = trees[name]
        for (_, _, leaf, row), own in zip(groups[name], paths, strict=True):
            path = own + top
            doc, *_, text = row
            if doc is not None and zlib.crc32(str(doc).encode()) % 2 == 0 and text is not None:
                text = text.replace("\n", "")
            node = plain_leaf([*row[:4], text])
            for before, after in path:
                node = h(before, node, after)
            out.append((doc, leaf, subroot, root, h(*[b + a for b, a in path]), node, node == root))
    return sorted(out, key=repr)


def odd_rows(count, seed=1):
    rng = random.Random(seed)
    rows = [
        (n, rng.choice(["a", "a", "a", "é", "z", "Z", None, "", f"own{n}"]), rng.choice(["en", None]),
         rng.choice([None, n]), rng.choice(["x\ny", "", None, "é\n" * 3, "plain", "long " * 2000]))
        for n in range(count)
    ]
    rows += [rows[0], rows[0], (None, "a", None, None, None), (None, "a", None, None, "t\n"), (None, None, None, None, None)]
    rng.shuffle(rows)
    return rows


def table(spark, rows):
    df = spark.createDataFrame(rows, "doc_id bigint, source string, lang string, n_chars bigint, text string")
    names = ("tree", "idx", "n", "hash", "path", "at", "part", "before", "after", "shown", "_group")
    return df.repartition(4).withColumns({name: F.lit("x") for name in names})


def results(df):
    names = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    return sorted((tuple(r) for r in df.select(*names).collect()), key=repr)


@pytest.mark.parametrize("count", [1, 60, 400])
def test_against_plain_trees(spark, count):
    rows = odd_rows(count, count)
    assert results(manifest.manifest_report(table(spark, rows))) == plain_report(rows)


def test_one_row_and_none(spark):
    rows = [(5, "s", "en", 1, "one\ntext")]
    got = results(manifest.manifest_report(table(spark, rows)))
    assert got == plain_report(rows) and got[0][2] == got[0][3] == got[0][1]
    none = manifest.manifest_report(table(spark, rows).where("false"))
    assert none.columns[:2] == ["doc_id", "leaf"] and none.count() == 0


@pytest.mark.parametrize("arity", [2, 5])
def test_any_number_of_siblings(spark, arity):
    rows = odd_rows(50)
    made = manifest.manifest(table(spark, rows), arity=arity)
    made = made.select("doc_id", "leaf", "subroot", "root", manifest.proof(F.col("path")), manifest.folded(F.col("leaf"), F.col("path")))
    wanted = [(*row[:5], row[3]) for row in plain_report(rows, arity)]
    assert sorted(map(tuple, made.collect()), key=repr) == sorted(wanted, key=repr)


def test_any_change_is_seen(spark):
    rows = odd_rows(30)
    roots = set()
    for changed in (rows, rows[1:], [*rows, (99, "a", "en", 1, "new")], [(*rows[0][:4], "other"), *rows[1:]]):
        found = manifest.manifest(table(spark, changed)).select("root").distinct().collect()
        assert len(found) == 1
        roots.add(found[0].root)
    assert len(roots) == 4


def test_given_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [tuple(r) for r in df.select(*manifest.FIELDS).collect()]
    assert results(manifest.manifest_report(df)) == plain_report(rows)


def test_places_of_a_hot_group_come_from_many_ranges(spark):
    rows = [("hot" if n % 3 else f"g{n}", n // 2) for n in range(3000)]
    df = spark.createDataFrame(rows, "name string, key bigint").repartition(8)
    ordered = ranks.in_order(df, ["name", "key"])
    placed = ranks.with_places(ordered, "name").collect()
    hot = sorted((r.idx, r.key) for r in placed if r.name == "hot")
    assert [i for i, _ in hot] == list(range(2000)) and [k for _, k in hot] == sorted(k for _, k in hot)
    assert {r.n for r in placed if r.name == "hot"} == {2000} and {r.n for r in placed if r.name != "hot"} == {1}
    assert brute.rows_of(df.where("false")) == []
