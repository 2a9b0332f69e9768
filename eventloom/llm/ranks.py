"""Places of rows in a sorted order, per group, for groups of any size.

Rows are dealt to ranges of (group, order), so a group that holds a third of all rows
lies in many tasks. A table of (group, range) counts, as long as there are ranges and
groups, says where each range begins.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eventloom.llm.blocks import stored


def in_order(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """The rows stored with `at`, a number that ascends with `order` (NULLs first), and `part`, their range.

    Equal rows get numbers in any order; they may lie in several ranges.
    """
    salted = rows.withColumn("at", F.monotonically_increasing_id())  # parts rows that are equal in all else
    dealt = salted.repartitionByRange(*order, "at").sortWithinPartitions(*order, "at")
    numbered = dealt.withColumns({"at": F.monotonically_increasing_id(), "part": F.spark_partition_id()})
    return stored(numbered, "ordered")


def with_places(ordered: DataFrame, group: str, about: DataFrame | None = None) -> DataFrame:
    """Adds `idx`, from 0 per group, and `n`, the rows of the group; `at` and `part` go.

    `about` has a row per group, whose other columns are added too.
    """
    runs = ordered.groupBy(group, "part").agg(F.min("at").alias("first"), F.count("*").alias("own"))
    whole = Window.partitionBy(group)
    before = whole.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    runs = runs.select(
        F.col(group).alias("_run_group"),
        F.col("part").alias("_run_part"),
        (F.sum("own").over(before) - F.col("own") - F.col("first")).alias("_run_shift"),
        F.sum("own").over(whole).alias("n"),
    )
    if about is not None:  # joined with the runs, not with all rows of a large group
        named = about.withColumnRenamed(group, "_named")
        runs = runs.join(named, F.col("_run_group").eqNullSafe(F.col("_named"))).drop("_named")
    joined = ordered.join(runs, (F.col("part") == F.col("_run_part")) & F.col(group).eqNullSafe(F.col("_run_group")))
    return joined.withColumn("idx", F.col("at") + F.col("_run_shift")).drop("at", "part", "_run_group", "_run_part", "_run_shift")
