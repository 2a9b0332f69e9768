"""Text of a group's rows in pages, of bounded size whatever the group's size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _cell(column: Column, escape: bool) -> Column:
    text = F.coalesce(column.cast("string"), F.lit("None"))
    return F.translate(text, "\t\r\n", "   ") if escape else text


def tsv_blocks(
    rows: DataFrame,
    *,
    keys: Sequence[str],
    columns: Sequence[str],
    sort: Sequence[str],
    page_rows: int = 20_000,
    escape: bool = False,
) -> DataFrame:
    """Tab-separated text per group: a header line and one line per row, sorted.

    The text comes in pages of `page_rows` rows by position, whatever the group's size.
    Pages joined by line breaks in the order of `block_no` are the text of the whole
    group; the header is on the first. Equal rows are counted before they travel, and
    a group is numbered slice by slice along its order, so neither a busy group nor a
    mass of copies meets in one task.
    """
    missing = [name for name in columns if name not in rows.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")
    content = list(dict.fromkeys([*keys, *columns]))
    order = {}
    for n, name in enumerate([*sort, *[name for name in columns if name not in sort]]):
        order |= {f"_null{n}": F.col(name).isNull(), f"_value{n}": F.col(name)}
    distinct = (
        rows.dropna(subset=list(keys))
        .groupBy(*content)
        .agg(F.count("*").alias("_copies"))
        .withColumn("_slice", F.pmod(F.hash(*sort), F.lit(1 << 30)))
    )
    # a slice is one combination of the sorting columns; the hash only names it in the join
    head = [F.col(name) for name in sort]
    ranked = [c for name in sort for c in (F.col(name).isNull(), F.col(name))]
    before = Window.partitionBy(*keys).orderBy(*ranked).rowsBetween(Window.unboundedPreceding, -1)
    slices = (
        distinct.groupBy(*keys, "_slice", *head)
        .agg(F.sum("_copies").alias("_size"))
        .withColumn("_before", F.coalesce(F.sum("_size").over(before), F.lit(0)))
        .withColumn("_total", F.sum("_size").over(Window.partitionBy(*keys)))
    )
    left, right = distinct.alias("l"), slices.alias("r")
    same = [F.col(f"l.{key}") == F.col(f"r.{key}") for key in [*keys, "_slice"]]
    same += [F.col(f"l.{name}").eqNullSafe(F.col(f"r.{name}")) for name in sort]
    placed = left.join(right, same).select("l.*", "_before", "_total").withColumns(order)
    inside = (
        Window.partitionBy(*keys, *sort)
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    first = F.col("_before") + F.coalesce(F.sum("_copies").over(inside), F.lit(0))
    page_of = F.expr(f"sequence(_first div {page_rows}, (_first + _copies - 1) div {page_rows})")
    paged = (
        placed.withColumn("_first", first)
        .withColumn("_page", F.explode(page_of))
        .withColumn(
            "_n",
            F.least(F.col("_first") + F.col("_copies"), (F.col("_page") + 1) * page_rows)
            - F.greatest(F.col("_first"), F.col("_page") * page_rows),
        )
    )
    line = F.concat_ws("\t", *[_cell(F.col(name), escape) for name in columns])
    entry = F.struct("_first", line.alias("line"), F.col("_n").cast("int").alias("n"))
    collected = paged.groupBy(*keys, "_page", "_total").agg(
        F.array_sort(F.collect_list(entry)).alias("_entries"), F.sum("_n").alias("row_count")
    )
    lines = F.flatten(F.transform("_entries", lambda e: F.array_repeat(e["line"], e["n"])))
    header = F.when(F.col("_page") == 0, F.array(F.lit("\t".join(columns)))).otherwise(F.array())
    return collected.select(
        *keys,
        (F.col("_page") + 1).cast("int").alias("block_no"),
        F.ceil(F.col("_total") / page_rows).cast("int").alias("block_count"),
        "row_count",
        F.array_join(F.concat(header, lines), "\n").alias("tsv"),
    )
