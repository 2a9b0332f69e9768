"""Time two plan choices against their plain forms, on stored tables.

usage: python tools/compare_shapes.py [sf_dir]
"""

from __future__ import annotations

import sys
import time
import uuid
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.functions import columns as c
from eventloom.operators.rolling import rolling_distinct
from eventloom.plans import events, feed
from eventloom.session import local_session, shared_folder
from eventloom.sources import supplied

GROUP = ["organization", "repo_name"]


def sightings(fact: DataFrame) -> DataFrame:
    return (
        fact.dropna(subset=[*GROUP, "user_login"])
        .groupBy(*GROUP, "user_login", "base_date")
        .agg(F.bool_or(c.class_flags()["any"]).alias("is_any"))
    )


def by_range_join(rows: DataFrame) -> DataFrame:
    days = rows.select(*GROUP, F.col("base_date").alias("day")).distinct()
    joined = days.join(rows, GROUP).where(
        F.col("base_date").between(F.date_sub("day", 29), F.col("day")) & F.col("is_any")
    )
    return joined.groupBy(*GROUP, "day").agg(F.count_distinct("user_login").alias("mau_any"))


def by_steps(rows: DataFrame) -> DataFrame:
    return rolling_distinct(
        rows, group=GROUP, entity="user_login", day="base_date",
        flags={"any": "is_any"}, windows={"mau": 30},
    )


def timed(name: str, df: DataFrame) -> None:
    best = None
    for _ in range(3):
        started = time.perf_counter()
        df.write.format("noop").mode("overwrite").save()
        took = time.perf_counter() - started
        best = took if best is None else min(best, took)
    print(f"{name}: {best:.2f} s", flush=True)


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = local_session("8", "shapes")
    spark.sparkContext.setLogLevel("ERROR")
    root = f"{shared_folder(spark)}/shapes-{uuid.uuid4().hex}"
    supplied.order_fact(spark, sf_dir).write.parquet(f"{root}/fact")
    supplied.filtered_events(spark, sf_dir).write.parquet(f"{root}/events")
    rows = sightings(spark.read.parquet(f"{root}/fact"))
    stored = spark.read.parquet(f"{root}/events")
    timed("30-day active users, range join", by_range_join(rows))
    timed("30-day active users, steps and running sum", by_steps(rows))
    timed("feed, one pass over the events", feed.dw_activity_feed(stored))
    timed("feed, twelve passes", feed.feed_from_tables(events.typed_tables(stored)))


if __name__ == "__main__":
    main()
