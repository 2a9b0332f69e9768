"""Day / week / month periods from one scan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def periods(day: Column) -> Column:
    """Array of the three periods a day belongs to: level, start, end."""
    week = F.trunc(day, "week").cast("date")
    month = F.trunc(day, "month").cast("date")

    def period(level: str, start: Column, end: Column) -> Column:
        return F.struct(F.lit(level).alias("level"), start.alias("start"), end.alias("end"))

    return F.array(
        period("day", day, day),
        period("week", week, F.date_add(week, 6)),
        period("month", month, F.last_day(day)),
    )


def explode_periods(df: DataFrame, day: str = "base_date") -> DataFrame:
    """Three rows per row, with columns level, start, end."""
    return df.withColumn("_period", F.explode(periods(F.col(day)))).select("*", "_period.*").drop(
        "_period"
    )
