import gzip
import json
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from eventloom import schemas
from eventloom.functions import columns as c
from eventloom.plans import build, events, facts
from eventloom.sources import archive
from eventloom.streaming import ingest


def line(n, org="apache", at="2024-01-15T03:04:05Z", kind="WatchEvent", **more):
    event = {
        "id": str(n),
        "type": kind,
        "actor": {"id": n, "login": f"user{n}"},
        "repo": {"id": 1, "name": "apache/superset"},
        "payload": {"action": "started"},
        "public": True,
        "created_at": at,
    }
    if org is not None:
        event["org"] = {"login": org}
    return json.dumps(event | more, ensure_ascii=False)


def write_hour(folder, day, hour, lines):
    target = folder / day
    target.mkdir(parents=True, exist_ok=True)
    with gzip.open(target / f"{day}-{hour}.json.gz", "wt", encoding="utf-8") as file:
        file.write("\n".join(lines) + "\n")


def test_only_rows_of_target_organizations_survive(spark, tmp_path):
    write_hour(
        tmp_path,
        "2024-01-15",
        3,
        ["", "{broken", '{"id":"9","org":{"login":"apache"},"payl', line(1, None), line(2, "other"),
         line(3), line(4, org="Apache"), line(5, org={}) , "[1, 2]"],
    )
    raw = archive.read_days(spark, str(tmp_path), "2024-01-15")
    assert [row.id for row in archive.filter_events(raw).collect()] == ["3"]


def test_missing_hours_are_skipped_and_a_missing_day_is_an_error(spark, tmp_path):
    for hour in (0, 5, 23):
        write_hour(tmp_path, "2024-01-15", hour, [line(hour)])
    day = archive.filter_events(archive.read_days(spark, str(tmp_path), "2024-01-15"))
    assert sorted(row.id for row in day.collect()) == ["0", "23", "5"]
    write_hour(tmp_path, "2024-01-17", 1, [line(99)])
    days = archive.filter_events(archive.read_days(spark, str(tmp_path), "2024-01-15", "2024-01-17"))
    assert days.count() == 4
    with pytest.raises(FileNotFoundError):
        archive.read_days(spark, str(tmp_path), "2024-01-16")


def test_filtered_schema_and_values(spark):
    rows = spark.createDataFrame([(line(7, "Pseudo-Lab", actor="None"),)], "value string")
    out = archive.filter_events(archive.parse_lines(rows))
    assert out.schema == schemas.FILTERED_EVENT
    row = out.first()
    assert row.organization == "pseudo__lab" and row.actor is None
    assert json.loads(row.org) == {"login": "Pseudo-Lab"} and row.public is True


def test_local_date_changes_at_15_utc(spark):
    rows = [(line(n, at=at),) for n, at in enumerate(["2024-01-15T14:59:59Z", "2024-01-15T15:00:00Z", "x"])]
    out = archive.filter_events(archive.parse_lines(spark.createDataFrame(rows, "value string")))
    by_id = {row.id: row for row in out.collect()}
    assert by_id["0"].dt_kst == date(2024, 1, 15) and by_id["1"].dt_kst == date(2024, 1, 16)
    assert by_id["1"].ts_kst == datetime(2024, 1, 16) and by_id["1"].dt_utc == date(2024, 1, 15)
    assert [by_id["2"][name] for name in ("ts_utc", "dt_utc", "ts_kst", "dt_kst")] == [None] * 4


def test_time_columns_do_not_depend_on_the_session_zone(spark):
    rows = [(line(n, at=at),) for n, at in enumerate(["2024-01-15T14:59:59Z", "2024-01-15T15:00:00+09:00"])]
    lines = spark.createDataFrame(rows, "value string")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Seoul")
        got = archive.filter_events(archive.parse_lines(lines)).selectExpr(
            "id", "unix_seconds(ts_utc) AS s", "dt_utc", "ts_kst", "dt_kst"
        ).orderBy("id").collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert tuple(got[0]) == ("0", 1705330799, date(2024, 1, 15), datetime(2024, 1, 15, 23, 59, 59), date(2024, 1, 15))
    assert tuple(got[1]) == ("1", None, None, None, None)


def test_time_columns_without_source_column(spark):
    row = archive.with_time_columns(spark.range(1)).first()
    assert (row.ts_utc, row.dt_utc, row.ts_kst, row.dt_kst) == (None,) * 4


def test_snake_case(spark):
    names = ["CausalInferenceLab", "Pseudo-Lab", "apache", "HTTPServer", "", None]
    df = spark.createDataFrame([(n, name) for n, name in enumerate(names)], "n int, name string")
    got = [row[0] for row in df.orderBy("n").select(c.snake_case(F.col("name"))).collect()]
    assert got == ["causal_inference_lab", "pseudo__lab", "apache", "http_server", "unknown", "unknown"]


def test_small_helpers(spark):
    df = spark.createDataFrame([("2024-01-17", "Pseudo-Lab x")], "day string, org string")
    row = df.select(
        c.partition_path(F.to_date("day"), F.col("org")),
        c.utc_date_as_local(F.col("day")),
        c.monday_of(F.to_date("day")),
    ).first()
    assert tuple(row) == (
        "dt_kst=2024-01-17/organization=pseudo_lab_x", "2024-01-17", date(2024, 1, 15)
    )
    frame = spark.createDataFrame([("None", 1, "x")], "a string, __index_level_0__ int, b string")
    cleaned = archive.clean_none_text(archive.without_index_columns(frame))
    assert cleaned.columns == ["a", "b"] and cleaned.first().a is None
    assert archive.all_to_text(spark.range(1)).dtypes == [("id", "string")]


def test_long_organization_list_as_table(spark):
    rows = spark.createDataFrame([(line(1),), (line(2, "other"),)], "value string")
    wanted = spark.createDataFrame([("other",)], "name string")
    out = archive.keep_organizations(archive.parse_lines(rows), wanted)
    assert [row.id for row in out.collect()] == ["2"]
    assert archive.keep_organizations(spark.range(2), ["x"]).count() == 2


def test_stream_equals_batch_and_restart_adds_nothing(spark, tmp_path, tables):
    folder = tmp_path / "raw"
    for hour in range(6):
        write_hour(folder, "2024-01-15", hour * 4, [line(hour * 10 + n, at=f"2024-01-15T{hour * 4:02d}:00:00Z") for n in range(5)] + ["", "{"])
    batch = archive.filter_events(archive.read_days(spark, str(folder), "2024-01-15"))
    for _ in range(2):
        stream = ingest.archive_stream(spark, str(folder), files_per_batch=2)
        ingest.stream_ingest(stream, tables, tables.path("_mark")).awaitTermination()
        stored = ingest.read_batches(tables, "gh_archive_by_batch")
        assert stored.select(*batch.columns).exceptAll(batch).count() == 0
        assert stored.count() == batch.count() == 30


def test_stream_daily_counts_follow_late_files(spark, tmp_path, tables):
    folder = tmp_path / "raw"

    def run():
        stream = ingest.archive_stream(spark, str(folder), files_per_batch=1)
        ingest.stream_daily_counts(stream, tables, tables.path("_mark")).awaitTermination()
        fact = tables.read("dw_activity_daily", schemas.ACTIVITY_DAILY)
        return {str(row.base_date): row.n for row in fact.groupBy("base_date").agg(F.sum("event_count").alias("n")).collect()}

    write_hour(folder, "2024-01-15", 1, [line(n) for n in range(4)])
    write_hour(folder, "2024-01-15", 20, [line(n + 10, at="2024-01-15T20:00:00Z") for n in range(3)])
    assert run() == {"2024-01-15": 4, "2024-01-16": 3}
    write_hour(folder, "2024-01-16", 0, [line(n + 20, at="2024-01-16T00:30:00Z") for n in range(2)])
    assert run() == {"2024-01-15": 4, "2024-01-16": 5}


def test_stream_counts_are_replayable_and_read_own_rows_only(spark, tmp_path, tables, monkeypatch):
    folder = tmp_path / "raw"
    monkeypatch.setattr(ingest, "read_batches", lambda *_: pytest.fail("whole days are read"))

    def run():
        stream = ingest.archive_stream(spark, str(folder), files_per_batch=1)
        ingest.stream_daily_counts(stream, tables, tables.path("_mark")).awaitTermination()
        return counts()

    def counts():
        return sorted(map(tuple, tables.read("dw_activity_daily").select(*schemas.ACTIVITY_DAILY.names).collect()))

    for hour in range(3):
        write_hour(folder, "2024-01-15", hour, [line(10 * hour + n, at=f"2024-01-15T0{hour}:00:00Z") for n in range(hour + 1)])
    once = run()
    assert sum(row[-1] for row in once) == 6
    last = max((tmp_path / "lake" / "_mark" / "commits").glob("[0-9]*"), key=lambda p: int(p.name))
    for path in (last, last.with_name(f".{last.name}.crc")):
        path.unlink(missing_ok=True)  # as if the run had ended before the batch was committed
    assert run() == once
    ingest.fold_partials(tables, "dw_activity_partials", ["2024-01-15"], most=1)
    assert len(tables.parts("dw_activity_partials", 2)) == 1
    write_hour(folder, "2024-01-15", 5, [line(99, at="2024-01-15T05:00:00Z")])
    assert sum(row[-1] for row in run()) == 7


def test_days_loaded_one_by_one_equal_a_full_build(spark, tables, tmp_path):
    lines = [
        line(n, at=f"2024-01-{10 + n % 5}T0{n % 9}:00:00Z", kind=["WatchEvent", "PushEvent", "ForkEvent"][n % 3],
             payload={"commits": [{"sha": f"s{n}", "message": "m"}], "forkee": {"full_name": "a/b"}})
        for n in range(60)
    ]
    source = archive.filter_events(archive.parse_lines(spark.createDataFrame([(text,) for text in lines], "value string")))
    build.append_events(tables, source)
    days = tables.days(build.EVENTS, "dt_kst")
    assert len(days) == 5
    # the first load builds everything, later ones replace single days
    build.load_range(tables, days[0])
    for day in [*days, days[2]]:
        build.load_range(tables, day, day, ["stg_gh_events", "dw_activity_daily"])
    build.load_range(tables, days[1], days[3], ["dl_watch_events", "dl_push_events", "dw_activity_feed"])
    stg = events.stg_gh_events(source)
    full = facts.dw_activity_daily(stg)
    stored = tables.read("dw_activity_daily", schemas.ACTIVITY_DAILY)
    assert stored.exceptAll(full.select(*stored.columns)).count() == 0
    assert stored.count() == full.count()
    assert tables.read("dw_activity_feed").count() == 60
    build.rebuild_whole(tables)
    assert tables.read("dim_user").count() == 60
    assert tables.read("dm_org_overview").where("aggregation_level = 'day'").count() == 5
    build.create_views(tables)
    assert spark.table("dm_unique_users_by_org_repo").count() == 60


def test_a_day_without_rows_disappears(spark, tables):
    def rows(*values):
        return spark.createDataFrame(
            [(date(2024, 1, day), name) for day, name in values], "base_date date, name string"
        )

    def stored():
        return sorted((row.base_date.day, row.name) for row in tables.read("t").collect())

    tables.replace_days("t", rows((1, "a"), (2, "b"), (3, "c")), ["2024-01-01", "2024-01-02", "2024-01-03"])
    tables.replace_days("t", rows((3, "d"), (9, "out of range")), ["2024-01-02", "2024-01-03"])
    assert stored() == [(1, "a"), (3, "d")]
    tables.replace_days("t", rows((3, "d")), ["2024-01-03"])
    assert stored() == [(1, "a"), (3, "d")]


def test_store_modes_and_schema_growth(spark, tables):
    one = spark.createDataFrame([(1,)], "a int")
    assert tables.store("t", one) == "overwrite" and tables.store("t", one) == "append"
    tables.append("t", spark.createDataFrame([(2, "x")], "a int, b string"))
    merged = tables.read("t", schemas.StructType().add("a", "integer").add("b", "string"))
    assert sorted((row.a, row.b or "") for row in merged.collect()) == [(1, ""), (1, ""), (2, "x")]
    tables.rebuild("t", tables.read("t").select("a").distinct())
    assert tables.read("t").count() == 2
    with pytest.raises(ValueError):
        tables.store("t", one, "other")
    with pytest.raises(ValueError):
        tables.append("t", one, ["missing"])
    with pytest.raises(FileNotFoundError):
        tables.read("nothing")


def test_declared_tables(spark, tables):
    tables.rebuild("dw_activity_daily", days_of(spark, (1, "a"), (2, "b")), ["base_date"])
    build.declare_tables(tables)
    build.declare_tables(tables)
    assert spark.table("dl_push_events").schema["base_date"].dataType.typeName() == "date"

    def stored():
        return sorted((r.base_date.day, r.repo_name) for r in spark.table("dw_activity_daily").collect())

    assert stored() == [(1, "a"), (2, "b")]
    tables.replace_days("dw_activity_daily", days_of(spark, (2, "c")), ["2024-01-01", "2024-01-02"])
    assert stored() == [(2, "c")]
    tables.append("dw_activity_daily", days_of(spark, (5, "d")), ["base_date"])
    assert stored() == [(2, "c"), (5, "d")]
    tables.rebuild("dw_activity_daily", days_of(spark, (7, "e")), ["base_date"])
    assert stored() == [(7, "e")]
    build.drop_tables(tables)
    assert not spark.catalog.tableExists("dl_push_events")


def days_of(spark, *values):
    rows = [(date(2024, 1, day), "o", name, "PushEvent", "u", 1) for day, name in values]
    return spark.createDataFrame(rows, schemas.ACTIVITY_DAILY)


def test_a_rebuild_cut_short_changes_nothing(spark, tables):
    tables.rebuild("t", spark.createDataFrame([(1,)], "a int"))
    broken = spark.range(3).select(F.when(F.col("id") == 2, F.raise_error(F.lit("lost"))).cast("int").alias("a"))
    with pytest.raises(Exception, match="lost"):
        tables.rebuild("t", broken)
    assert [row.a for row in tables.read("t").collect()] == [1]
    for n in range(4):
        tables.rebuild("t", spark.createDataFrame([(n,)], "a int"))
    assert [row.a for row in tables.read("t").collect()] == [3] and len(tables._versions("t")) == 2


def test_given_days_are_the_only_ones_listed(spark, tables):
    tables.rebuild("dw_activity_daily", days_of(spark, (1, "a"), (2, "b"), (3, "c")), ["base_date"])
    one = tables.read("dw_activity_daily", schemas.ACTIVITY_DAILY, ["2024-01-02", "2024-01-09"])
    assert {file.split("/")[-2] for file in one.inputFiles()} == {"base_date=2024-01-02"}
    assert [(row.base_date, row.repo_name) for row in one.collect()] == [(date(2024, 1, 2), "b")]
    assert tables.read("dw_activity_daily", schemas.ACTIVITY_DAILY, ["2024-02-02"]).count() == 0


def test_a_vanished_file_raises(spark, tables):
    tables.rebuild("t", spark.range(100).repartition(4))
    rows = tables.read("t")
    for file in rows.inputFiles():
        tables._delete(file)
    with pytest.raises(Exception, match="FILE_NOT_EXIST|does not exist|FileNotFound"):
        rows.count()


def test_compacted_days(spark, tables):
    def batch(number, *days):
        rows = [(f"{number}", "PushEvent", date(2024, 1, d), "o", number) for d in days]
        return spark.createDataFrame(rows, "id string, type string, dt_kst date, organization string, batch bigint")

    for number, days in enumerate([(1, 2), (1,), (1, 2)]):
        tables.overwrite_parts("e", batch(number, *days), ingest.BATCH_PARTITIONS)
    before = sorted(r.id for r in ingest.read_batches(tables, "e").collect())
    for _ in range(2):
        ingest.compact_days(tables, "e", ["2024-01-01", "2024-01-02"])
        assert sorted(r.id for r in ingest.read_batches(tables, "e").collect()) == before
        assert len(tables.parts("e", 3)) == 2
    tables.overwrite_parts("e", batch(3, 1), ingest.BATCH_PARTITIONS)
    assert ingest.read_batches(tables, "e", ["2024-01-01"]).count() == 4
    # an old batch that is still there beside the merged one does not count twice
    tables.overwrite_parts("e", batch(0, 1), ingest.BATCH_PARTITIONS)
    assert ingest.read_batches(tables, "e", ["2024-01-01"]).count() == 4


def test_run_days():
    from eventloom.sources.tables import day_range, run_day

    assert run_day(None, date(2024, 3, 1)) == date(2024, 2, 29)
    assert len(day_range("2024-02-27", "2024-03-02")) == 5
    with pytest.raises(ValueError):
        day_range("2024-03-02", "2024-03-01")


def test_a_repeated_batch_changes_nothing(spark, tables):
    rows = spark.createDataFrame([(date(2024, 1, 1), 0, "a"), (date(2024, 1, 2), 0, "b")], "d date, batch int, v string")
    more = spark.createDataFrame([(date(2024, 1, 2), 1, "c")], "d date, batch int, v string")
    for part in (rows, more, more, rows):
        tables.overwrite_parts("t", part, ["d", "batch"])
    assert sorted(row.v for row in tables.read("t").collect()) == ["a", "b", "c"]


def test_replace_days_keeps_null_and_escaped_partitions(spark, tables):
    def rows(*organizations):
        return spark.createDataFrame(
            [(o, n) for n, o in enumerate(organizations)], "organization string, n int"
        ).withColumn("base_date", F.lit("2024-01-15").cast("date"))

    more = ["organization"]
    tables.replace_days("t", rows("gone", None, "a:b", "plain"), ["2024-01-15"], more_partitions=more)
    tables.replace_days("t", rows(None, "a:b", "c/d=e", "plain"), ["2024-01-15"], more_partitions=more)
    got = {(r.organization, r.n) for r in tables.read("t").collect()}
    assert got == {(None, 0), ("a:b", 1), ("c/d=e", 2), ("plain", 3)}


def test_looking_up_a_user_reads_few_row_groups(spark, tables):
    from eventloom.sources import relations

    # every second name, in an order that statistics alone cannot use
    rows = spark.range(40_000).selectExpr("concat('u', sha2(string(id * 2), 256)) as username", "date'2024-01-15' as dt_kst", "id as related_id")
    for part in range(4):
        relations.write_user_relations(tables, rows.where(f"related_id % 4 = {part}").coalesce(1), options={"parquet.block.size": str(64 << 10)})
    import hashlib

    def scanned(number):
        name = "u" + hashlib.sha256(str(number).encode()).hexdigest()
        found = tables.read("gh_user_relations").where(F.col("username") == name)
        count = len(found.collect())
        plan = found._jdf.queryExecution().executedPlan()
        scans = plan.collectLeaves()
        return count, sum(scans.apply(n).metrics().apply("numOutputRows").value() for n in range(scans.size()))

    count, read = scanned(2000)
    assert count == 1 and 1 <= read < 8_000  # one row group or two of one file
    assert scanned(2001) == (0, 0)  # between others, so only the Bloom filters know
