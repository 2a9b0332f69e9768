"""Range loads that are taken up again, and the types that files really hold."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from eventloom import schemas
from eventloom.plans import build, quality

NAMES = ["stg_gh_events", "dw_activity_daily"]


def events(spark):
    rows = [
        (str(n), "PushEvent", '{"login":"u"}', '{"name":"apache/x"}', '{"login":"apache"}', "{}", True,
         None, None, None, None, date(2024, 1, 1 + n % 4), "apache")
        for n in range(20)
    ]
    return spark.createDataFrame(rows, schemas.FILTERED_EVENT)


def test_a_broken_run_is_taken_up_where_it_broke(spark, tables, monkeypatch):
    tables.rebuild(build.EVENTS, events(spark), ["dt_kst"])
    loaded, load_days = [], build.load_days

    def load(tables_, table, days):
        if len(loaded) == limit:
            raise RuntimeError("cut short")
        loaded.append((table.name, days[0].day, len(days)))
        load_days(tables_, table, days)

    monkeypatch.setattr(build, "load_days", load)
    limit = 3
    with pytest.raises(RuntimeError):
        build.load_range(tables, "2024-01-01", "2024-01-04", NAMES, slice_days=2)
    assert loaded == [(NAMES[0], 1, 2), (NAMES[0], 3, 2), (NAMES[1], 1, 2)]
    limit = 99
    loaded.clear()
    build.load_range(tables, "2024-01-01", "2024-01-04", NAMES, slice_days=2)
    assert loaded == [(NAMES[1], 3, 2)]  # the rest only
    fact = tables.read("dw_activity_daily", schemas.ACTIVITY_DAILY)
    assert fact.agg(F.sum("event_count")).first()[0] == 20
    loaded.clear()
    build.load_range(tables, "2024-01-01", "2024-01-04", NAMES, slice_days=2)
    assert len(loaded) == 4  # a finished run is forgotten: the range is loaded anew


def test_files_of_another_type_are_named(spark, tables):
    good = events(spark).withColumn("ts_utc", F.lit("2024-01-01").cast("timestamp")).withColumn("ts_kst", F.lit("2024-01-01").cast("timestamp_ntz"))
    tables.rebuild("e", good, ["dt_kst", "organization"])
    assert quality.time_column_drift(tables, "e").isEmpty()
    folder = tables.data_path("e")
    bad = good.where("dt_kst = '2024-01-02'").withColumn("ts_kst", F.col("ts_kst").cast("string")).drop("dt_utc")
    bad.coalesce(1).write.partitionBy("dt_kst", "organization").mode("append").parquet(folder)
    part = "dt_kst=2024-01-02/organization=apache"
    got = sorted(map(tuple, quality.time_column_drift(tables, "e").collect()))
    assert got == [(part, "dt_utc", "missing", 1), (part, "ts_kst", "string", 1)]
    columns = quality.stored_columns(tables, "e").where("column_name = 'id'").select("stored_type").distinct().collect()
    assert [r.stored_type for r in columns] == ["string"]
