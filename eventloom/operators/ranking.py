"""Row numbers inside groups of any size.

A plain window puts a whole group into one task. Here each group is cut into
slices along its own sort order. Slices are counted (with partial aggregation),
a small window sums the counts of the slices before, and the row number inside
a slice is added. The result is exactly the plain row number.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def sliced_row_number(
    rows: DataFrame,
    *,
    group: Sequence[str],
    slices: Mapping[str, tuple[Column, bool]],
    order: Sequence[Column],
    name: str,
) -> DataFrame:
    """Add the row number within `group`, ordered by the slices, then by `order`.

    `slices` maps a helper name to (value, descending). Group and slice values
    must be non-NULL (other rows are left out), and the slices a prefix of the wanted sort order, e.g. the score, then the
    first letters of a name whose full text comes in `order`.
    """
    keys = [*group, *slices]
    marked = rows.withColumns({key: value for key, (value, _) in slices.items()})
    # stated on both sides of the join below, so that they share one exchange
    marked = marked.where(reduce(and_, [F.col(key).isNotNull() for key in keys]))
    directions = [F.desc(key) if down else F.asc(key) for key, (_, down) in slices.items()]
    before = (
        Window.partitionBy(*group).orderBy(*directions).rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = (
        marked.groupBy(*keys)
        .agg(F.count("*").alias("_rows"))
        .withColumn("_before", F.coalesce(F.sum("_rows").over(before), F.lit(0)))
        .drop("_rows")
    )
    # numbered first: the merge join then finds the rows partitioned and sorted
    inside = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return (
        marked.withColumn("_inside", inside)
        .join(offsets.hint("merge"), keys)
        .withColumn(name, (F.col("_before") + F.col("_inside")).cast("bigint"))
        .drop("_before", "_inside", *slices)
    )
