"""Exact medians of groups of any size.

Equal values are counted first, so copies never travel. The counts are cut into
value ranges; a running sum over the ranges finds the one or two that hold the
middle, and only the values of those are looked at one by one.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def exact_median(
    rows: DataFrame, *, group: Sequence[str], value: str, width: int, name: str = "median"
) -> DataFrame:
    """Median (mean of the two middle values) and count of an integer column.

    `width` is the size of a value range; NULL values and groups are left out.
    At most `width` distinct values of one range meet in a task.
    """
    known = reduce(and_, [F.col(name).isNotNull() for name in (*group, value)])
    counted = (
        rows.where(known)
        .groupBy(*group, F.col(value).alias("_v"))
        .agg(F.count("*").alias("_n"))
        .withColumn("_range", F.floor(F.col("_v") / width))
    )
    per_range = counted.groupBy(*group, "_range").agg(F.sum("_n").alias("_in_range"))
    by_range = Window.partitionBy(*group)
    below = by_range.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    total = F.sum("_in_range").over(by_range)
    placed = per_range.select(
        *group,
        "_range",
        "_in_range",
        F.coalesce(F.sum("_in_range").over(below), F.lit(0)).alias("_below"),
        total.alias("_total"),
    ).withColumns(
        {
            "_low": F.floor((F.col("_total") + 1) / 2),
            "_high": F.floor((F.col("_total") + 2) / 2),
        }
    )
    middle = placed.where(
        (F.col("_below") < F.col("_high"))
        & (F.col("_below") + F.col("_in_range") >= F.col("_low"))
    )
    in_range = (
        Window.partitionBy(*group, "_range")
        .orderBy("_v")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    # a merge join leaves the rows partitioned as the window needs them
    ranked = counted.join(middle.hint("merge"), [*group, "_range"]).withColumn(
        "_upto", F.col("_below") + F.sum("_n").over(in_range)
    )
    first = F.col("_upto") - F.col("_n")
    low = F.when((first < F.col("_low")) & (F.col("_low") <= F.col("_upto")), F.col("_v"))
    high = F.when((first < F.col("_high")) & (F.col("_high") <= F.col("_upto")), F.col("_v"))
    return ranked.groupBy(*group).agg(
        ((F.max(low).cast("double") + F.max(high).cast("double")) / 2).alias(name),
        F.max("_total").alias("value_count"),
    )
