"""Operators against brute force on small data."""

import random
from collections import defaultdict
from datetime import date, timedelta
from statistics import median

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from eventloom.operators.blocks import tsv_blocks
from eventloom.operators.median import exact_median
from eventloom.operators.ranking import sliced_row_number
from eventloom.operators.rolling import rolling_distinct

START = date(2024, 1, 1)


@pytest.mark.parametrize("seed", [1, 2])
def test_rolling_distinct_equals_range_count(spark, seed):
    rng = random.Random(seed)
    rows = {
        (rng.choice("ab"), rng.choice(["u1", "u2", "u3", "u4", None]), START + timedelta(days=rng.randrange(80))):
        (rng.random() < 0.7)
        for _ in range(300)
    }
    df = spark.createDataFrame(
        [(g, u, d, True, flag) for (g, u, d), flag in rows.items()],
        "g string, u string, day date, always boolean, flag boolean",
    )
    got = rolling_distinct(
        df, group=["g"], entity="u", day="day", flags={"all": "always", "some": "flag"},
        windows={"wau": 7, "mau": 30}, return_gap=7,
    ).collect()
    assert len(got) == len({(g, d) for g, _, d in rows})
    for row in got:
        def seen(days, only):
            return len({
                u for (g, u, d), flag in rows.items()
                if g == row.g and u and 0 <= (row.day - d).days < days and (flag or not only)
            })

        assert (row.dau_all, row.wau_all, row.mau_all) == (seen(1, False), seen(7, False), seen(30, False))
        assert (row.dau_some, row.wau_some, row.mau_some) == (seen(1, True), seen(7, True), seen(30, True))
        here = [u for (g, u, d) in rows if g == row.g and d == row.day and u]
        gaps = []
        for u in here:
            before = [d for (g, v, d) in rows if g == row.g and v == u and d < row.day]
            gaps.append((row.day - max(before)).days if before else None)
        assert row.new_count == gaps.count(None)
        assert row.returning_count == sum(gap is not None and gap >= 7 for gap in gaps)
        assert row.kept_count == gaps.count(1)


def test_sliced_row_number_equals_window(spark):
    rng = random.Random(3)
    rows = [("hot" if n % 3 else f"g{n % 7}", rng.choice([1, 1, 1, 2, 9]), f"{rng.choice('abc')}{n}") for n in range(900)]
    df = spark.createDataFrame(rows, "g string, score int, name string")
    got = sliced_row_number(
        df, group=["g"], slices={"_s": (F.col("score"), True), "_i": (F.substring("name", 1, 1), False)},
        order=[F.asc("name")], name="rank",
    )
    plain = df.withColumn(
        "rank", F.row_number().over(Window.partitionBy("g").orderBy(F.desc("score"), "name")).cast("bigint")
    )
    assert got.count() == 900 and got.exceptAll(plain.select(*got.columns)).count() == 0


def test_exact_median_with_copies_and_hot_group(spark):
    rng = random.Random(4)
    groups = {
        "hot": [0] * 500 + [rng.randrange(100_000) for _ in range(501)],
        "even": [1, 2, 7200, 9000],
        "one": [5],
        "twin": [3, 3],
        "negative": [-5000, -3, 8],
    }
    rows = [(name, value) for name, values in groups.items() for value in values] + [("none", None)]
    df = spark.createDataFrame(rows, "g string, v bigint")
    got = {row.g: (row["median"], row.value_count) for row in exact_median(df, group=["g"], value="v", width=3600).collect()}
    assert got == {name: (float(median(values)), len(values)) for name, values in groups.items()}


@pytest.mark.parametrize("size", [7, 40, 20_000])
def test_pages_joined_are_the_sorted_text(spark, size):
    rows = [("hot", n % 50, f"text {n}") for n in range(700)] + [("hot", 1, "same")] * 300 + [("cold", 2, "x"), ("cold", None, "y")]
    df = spark.createDataFrame(rows, "k string, day int, text string")
    pages = tsv_blocks(df, keys=["k"], columns=["day", "text"], sort=["day"], page_rows=size).collect()
    for key in ("hot", "cold"):
        own = sorted((p for p in pages if p.k == key), key=lambda p: p.block_no)
        mine = sorted(((d is None, d, t) for k, d, t in rows if k == key))
        lines = [f"{d}\t{t}" for _, d, t in mine]
        assert "\n".join(p.tsv for p in own) == "\n".join(["day\ttext", *lines])
        assert [p.block_no for p in own] == list(range(1, own[0].block_count + 1))
        assert all(p.row_count == size for p in own[:-1]) and sum(p.row_count for p in own) == len(lines)


def test_blocks_cells(spark):
    df = spark.createDataFrame([("k", None, "a\tb"), ("k", "z", "c")], "k string, name string, text string")
    plain = tsv_blocks(df, keys=["k"], columns=["name", "text"], sort=["name"]).first().tsv
    assert plain == "name\ttext\nz\tc\nNone\ta\tb"
    escaped = tsv_blocks(df, keys=["k"], columns=["name", "text"], sort=["name"], escape=True).first().tsv
    assert escaped == "name\ttext\nz\tc\nNone\ta b"
    with pytest.raises(ValueError):
        tsv_blocks(df, keys=["k"], columns=["name", "gone"], sort=["name"])
