"""Registered queries over the supplied tables, and their SQL counterparts."""

from __future__ import annotations

import sys
import uuid
from collections.abc import Callable
from datetime import date
from functools import reduce
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

sys.path.insert(0, str(Path(__file__).resolve().parent))

from eventloom import schemas
from eventloom.functions import columns as c
from eventloom.functions.filters import filter_bar
from eventloom.plans import build, daily, dashboards, digest, dims, events, facts, feed, marts, quality
from eventloom.session import shared_folder
from eventloom.sources import archive, hours, relations, supplied
from eventloom.sources.merging import SchemaConflict
from eventloom.sources.tables import Tables, read_report_json, write_report_json
from eventloom.streaming import ingest
from oracle.sql import ANSWER, AS_OF, HOUR_BLANK, HOUR_CUT, HOUR_MISSING, WEEK_START, all_sql

Query = Callable[[SparkSession, str], DataFrame]

SMOKE_DIR = "/root/testdata/sf0.001"


# --- inputs --------------------------------------------------------------------


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return supplied.filtered_events(spark, sf_dir)


def _stg(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events.stg_gh_events(_events(spark, sf_dir))


def _fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return facts.dw_activity_daily(_stg(spark, sf_dir))


def _typed(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return events.typed_events(_events(spark, sf_dir), build.EVENT_SHAPES[name])


def _user_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboards.user_daily_activity(supplied.order_fact(spark, sf_dir))


def _week(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest.weekly_extract(feed.dw_activity_feed(_events(spark, sf_dir)), WEEK_START)


def _ingested(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive.filter_events(archive.parse_lines(supplied.archive_lines(spark, sf_dir)))


def _unzoned(df: DataFrame) -> DataFrame:
    """Timestamps without a zone, so that every engine shows the same text."""
    zoned = [f.name for f in df.schema.fields if f.dataType.typeName() == "timestamp"]
    return df.withColumns({name: F.col(name).cast("timestamp_ntz") for name in zoned})


def _tables(spark: SparkSession) -> Tables:
    """A fresh set of tables in the shared folder."""
    own = uuid.uuid4().hex
    return Tables(spark, f"{shared_folder(spark)}/tables-{own}", catalog_prefix=f"t_{own}_")


def _line_files(spark: SparkSession, sf_dir: str, tables: Tables) -> str:
    """Archive lines written as gzipped files, one folder per UTC day."""
    folder = tables.path("raw_data")
    lines = supplied.archive_lines(spark, sf_dir).select("utc_day", "value")
    lines.repartition("utc_day").write.partitionBy("utc_day").option("compression", "gzip").text(folder)
    return folder


# --- queries with more than one step ---------------------------------------------


def _scalar_helpers(spark: SparkSession, sf_dir: str) -> DataFrame:
    repo = F.get_json_object("repo", "$.name")
    texts = archive.all_to_text(_events(spark, sf_dir).select("id", "public"))
    return (
        _events(spark, sf_dir)
        .select(
            "id",
            c.snake_case(F.col("type")).alias("type_snake"),
            repo.isNotNull().alias("has_repo"),
            c.owner_of(repo).alias("owner"),
            c.short_repo(repo).alias("repo_short"),
            c.utc_date_as_local(F.col("dt_utc").cast("string")).alias("local_day"),
            c.partition_path(F.col("dt_kst"), archive.organization_login(F.col("org"))).alias("path"),
            c.monday_of(F.col("dt_kst")).alias("monday"),
            F.get_json_object("payload", "$").isNotNull().alias("payload_ok"),
            c.lenient_json(F.col("actor")).isNotNull().alias("actor_ok"),
        )
        .join(texts.withColumnRenamed("public", "public_text"), "id")
    )


def _ingest_day_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = _tables(spark)
    lines = archive.read_lines(spark, _line_files(spark, sf_dir, tables))
    build.append_events(tables, archive.filter_events(lines))
    return archive.partition_summary(tables.read(build.EVENTS, schemas.FILTERED_EVENT))


def _hour_files(spark: SparkSession, sf_dir: str, tables: Tables) -> str:
    """Archive lines in one gzipped file per UTC hour; each day has a missing, a cut and a blank one."""
    folder, root = tables.path("by_hour"), tables.path("raw_data")
    lines = supplied.archive_lines(spark, sf_dir)
    lines.repartition("utc_day", "hour").write.partitionBy("utc_day", "hour").option("compression", "gzip").text(folder)
    for part in lines.select("utc_day", "hour").distinct().collect():
        path = f"{root}/{part.utc_day}/{part.utc_day}-{part.hour}.json.gz"
        source = f"{folder}/utc_day={part.utc_day}/hour={part.hour}"
        if part.hour != HOUR_MISSING:
            tables.move_only_file(source, path)
        if part.hour == HOUR_CUT:
            tables.cut_file(path, 0.6)
        elif part.hour == HOUR_BLANK:
            tables.cut_file(path, 0)
    return root


def _load_hours(spark: SparkSession, sf_dir: str) -> tuple[Tables, DataFrame]:
    tables = _tables(spark)
    root = _hour_files(spark, sf_dir, tables)
    days = supplied.archive_lines(spark, sf_dir).agg(F.min("utc_day"), F.max("utc_day")).first()
    return tables, hours.load_hours(tables, root, *days)


def _ingest_hour_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _load_hours(spark, sf_dir)[1]


def _ingest_other_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables, _ = _load_hours(spark, sf_dir)
    return archive.partition_summary(tables.read(build.EVENTS, schemas.FILTERED_EVENT))


def _append_schema_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three appends: narrow columns, wider ones with a new one, and a type that is refused."""
    tables = _tables(spark)
    rows = spark.read.parquet(f"{sf_dir}/events.parquet")
    part = F.col("event_id") % 3
    tables.append("merged", rows.where(part == 0).selectExpr("cast(event_id as int) as id", "event_type"))
    tables.append("merged", rows.where(part == 1).selectExpr("event_id as id", "event_type", "user_id"))
    try:
        tables.append("merged", rows.where(part == 2).selectExpr("cast(event_id as string) as id", "event_type"))
        refused = False
    except SchemaConflict:
        refused = True
    tables.append("merged", rows.where(part == 2).selectExpr("cast(event_id as int) as id", "user_id"))
    return tables.read("merged").withColumn("refused", F.lit(refused))


def _loaded(spark: SparkSession, sf_dir: str, rows: DataFrame) -> tuple[Tables, date, date]:
    """Tables built from `rows`, then loaded again over all days from the full events."""
    tables = _tables(spark)
    names = ["stg_gh_events", "dw_activity_daily"]
    tables.rebuild(build.EVENTS, rows, archive.EVENT_PARTITIONS)
    build.load_range(tables, "2024-01-01", "2024-01-01", names)
    tables.rebuild(build.EVENTS, _events(spark, sf_dir), archive.EVENT_PARTITIONS)
    days = [date.fromisoformat(day) for day in tables.days(build.EVENTS, "dt_kst")]
    build.load_range(tables, days[0], days[-1], names)
    return tables, days[0], days[-1]


def _backfill_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = _events(spark, sf_dir).where(F.col("type") != "PushEvent")
    tables, _, _ = _loaded(spark, sf_dir, part)
    return tables.read("dw_activity_daily", schemas.ACTIVITY_DAILY)


BREAK_AFTER = 6  # loads of a range before it breaks off


def _backfill_resumed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A range load that breaks off after some days of its second table, and is called again."""
    tables = _tables(spark)
    tables.rebuild(build.EVENTS, _events(spark, sf_dir), archive.EVENT_PARTITIONS)
    names = ["stg_gh_events", "dw_activity_daily"]
    days = tables.days(build.EVENTS, "dt_kst")
    loads, load_days = [], build.load_days

    class Broken(Exception):
        pass

    def broken(tables_, table, part):
        if len(loads) == BREAK_AFTER:
            raise Broken
        loads.append(table.name)
        load_days(tables_, table, part)

    build.load_days = broken
    try:
        build.load_range(tables, days[0], days[-1], names, slice_days=8)
    except Broken:
        pass
    finally:
        build.load_days = load_days
    build.load_range(tables, days[0], days[-1], names, slice_days=8)
    return tables.read("dw_activity_daily", schemas.ACTIVITY_DAILY)


# Days whose files hold the time columns as text, and without one of them.
TEXT_DAY, SHORT_DAY = date(2024, 1, 9), date(2024, 1, 12)


def _dq_time_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of an event table written by somebody else's job: times as text, a column left out."""
    tables = _tables(spark)
    every = _events(spark, sf_dir).withColumn("ts_utc", F.col("ts_utc").cast("timestamp"))
    odd = F.col("dt_kst").isin(TEXT_DAY, SHORT_DAY)
    tables.rebuild("events_in", every.where(~odd), ["dt_kst"])
    folder = tables.data_path("events_in")
    text = every.where(F.col("dt_kst") == F.lit(TEXT_DAY)).withColumns(
        {"ts_utc": F.col("ts_utc").cast("string"), "ts_kst": F.col("ts_kst").cast("timestamp_ntz")}
    )
    text.coalesce(1).write.partitionBy("dt_kst").mode("append").parquet(folder)
    short = every.where(F.col("dt_kst") == F.lit(SHORT_DAY)).drop("dt_utc")
    short.coalesce(1).write.partitionBy("dt_kst").mode("append").parquet(folder)
    return quality.time_column_drift(tables, "events_in")


def _replace_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables, _, _ = _loaded(spark, sf_dir, _events(spark, sf_dir))
    kept = _events(spark, sf_dir).where(F.col("dt_kst") != F.lit("2024-01-10").cast("date"))
    tables.rebuild(build.EVENTS, kept, archive.EVENT_PARTITIONS)
    build.load_range(tables, "2024-01-09", "2024-01-11", ["stg_gh_events", "dw_activity_daily"])
    return tables.read("dw_activity_daily", schemas.ACTIVITY_DAILY)


def _replaced(spark: SparkSession, sf_dir: str) -> Tables:
    """Declared tables, of which one day is replaced afterwards by half of its events."""
    tables = _tables(spark)
    names = ["stg_gh_events", "dw_activity_daily"]
    every = _events(spark, sf_dir)
    tables.rebuild(build.EVENTS, every, archive.EVENT_PARTITIONS)
    build.declare_tables(tables, [build.EVENTS, *names])
    days = tables.days(build.EVENTS, "dt_kst")
    build.load_range(tables, days[0], days[-1], names)
    kept = every.where("dt_kst != date'2024-01-10' or cast(id as bigint) % 2 = 0")
    tables.rebuild(build.EVENTS, kept, archive.EVENT_PARTITIONS)
    build.load_range(tables, "2024-01-10", "2024-01-10", names)
    return tables


def _declared_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = _replaced(spark, sf_dir)
    return spark.table(tables.catalog_name("dw_activity_daily")).select(*schemas.ACTIVITY_DAILY.names)


def _fact_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = _replaced(spark, sf_dir)
    build.create_views(tables)
    return spark.table(tables.catalog_name("dm_activity_daily_org_repo"))


# Stored tables, and what is summed up of each beside its number of rows.
_END_TO_END = {
    **{name: "count(DISTINCT event_id)" for name in ["stg_gh_events", *build.EVENT_SHAPES]},
    "dw_activity_daily": "sum(event_count)",
    "dw_watch_daily": "sum(watch_started_count)",
    "dw_activity_feed": "sum(length(activity_text))",
    "dm_watch_summary": "sum(unique_watchers)",
    "dim_event_type": "count(event_type)",
    "dim_organization": "count(organization)",
    "dim_repository": "count(repo_name)",
    "dim_user": "count(first_seen_repo)",
    "dm_active_users_daily": "sum(mau_any)",
    "dm_org_overview": "sum(total_events_count)",
    "dm_user_activity": "sum(total_events_count)",
    "dm_repo_contributors": "sum(contribution_score)",
    "dm_user_retention": "sum(retained_users_any)",
    "dm_user_cohort_summary": "sum(cohort_size)",
}


def _pipeline_end_to_end(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines to files to events to all daily tables, dimensions and marts."""
    tables = _tables(spark)
    lines = archive.read_lines(spark, _line_files(spark, sf_dir, tables))
    build.append_events(tables, archive.filter_events(lines).where("dt_kst is not null"))
    days = tables.days(build.EVENTS, "dt_kst")
    build.load_range(tables, days[0], days[-1])
    build.rebuild_whole(tables)
    counts = [
        tables.read(name)
        .select(
            F.lit(name).alias("table_name"),
            F.count("*").alias("row_count"),
            F.expr(total).cast("bigint").alias("total"),
        )
        for name, total in _END_TO_END.items()
    ]
    return reduce(DataFrame.unionByName, counts)


# Days loaded one after the other: a late one, one that had half of its rows, the newest.
LATE_DAY, HALF_DAY, NEWEST_DAY = date(2024, 1, 20), date(2024, 3, 5), date(2024, 5, 29)


def _loaded_by_day(spark: SparkSession, sf_dir: str, mart: str) -> Tables:
    """A mart over the fact without three days, which are then loaded in turn."""
    tables = _tables(spark)
    fact = supplied.order_fact(spark, sf_dir)
    day = F.col("base_date")
    early = ~day.isin(LATE_DAY, NEWEST_DAY) & ((day != HALF_DAY) | (F.crc32(F.col("user_login").cast("binary")) % 2 == 0))
    tables.rebuild(daily.FACT, fact.where(F.coalesce(early, F.lit(False))), ["base_date"])
    daily.refresh_marts(tables, [date(2024, 1, 1)], [mart])
    for loaded in (NEWEST_DAY, LATE_DAY, HALF_DAY):
        tables.replace_days(daily.FACT, fact.where(day == loaded), [loaded])
        daily.refresh_marts(tables, [loaded], [mart])
    return tables


def _by_day(mart: str, schema: StructType) -> Query:
    return lambda spark, sf_dir: _loaded_by_day(spark, sf_dir, mart).read(mart, schema)


def _report_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = digest.parse_reports(_answers(spark, sf_dir), schemas.ACTOR_WEEK_REPORT)
    path = f"{shared_folder(spark)}/reports-{uuid.uuid4().hex}"
    write_report_json(parsed.where(~F.col("is_rejected")).select("report.*"), path)
    stored = read_report_json(spark, path, schemas.ACTOR_WEEK_REPORT)
    return stored.groupBy("actor_login", "summary").agg(F.count("*").alias("reports"))


def _single_repo(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = digest.single_group(
        _week(spark, sf_dir), organization="Pseudo-Lab", repo_name="Pseudo-Lab/study"
    )
    return digest.digest_blocks(rows, digest.REPO_KEYS)


def _answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/events.parquet")
    return rows.selectExpr("event_id", f"{ANSWER.replace('varchar(40)', 'string')} as answer")


def _parse_report_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = digest.parse_reports(_answers(spark, sf_dir), schemas.ACTOR_WEEK_REPORT)
    return parsed.select(
        "event_id",
        "is_rejected",
        "report.week_start",
        "report.actor_login",
        F.array_join("report.organization_set", ",").alias("organizations"),
        "report.summary",
    )


def _report_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = _tables(spark)
    parsed = digest.parse_reports(_answers(spark, sf_dir), schemas.ACTOR_WEEK_REPORT)
    even = F.col("event_id") % 2 == 0
    digest.store_reports(tables, parsed.where(even))
    name = digest.store_reports(tables, parsed.where(~even))
    stored = tables.read(name, schemas.ACTOR_WEEK_REPORT)
    return stored.groupBy("actor_login", "summary").agg(F.count("*").alias("reports"))


def _weekly_actor_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    repo = F.transform(
        "top_repos", lambda t: F.concat(t["repo_name"], F.lit("="), F.array_join(t["events"], "+"))
    )
    return digest.weekly_actor_digest(_week(spark, sf_dir)).select(
        "week_start",
        "actor_login",
        F.array_join("organization_set", ",").alias("organization_set"),
        "event_count",
        F.array_join(repo, ";").alias("top_repos"),
    )


def _weekly_repo_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    person = F.transform(
        "contributors_top",
        lambda t: F.concat(t["actor_login"], F.lit("="), t["notable_activity"]),
    )
    rows = digest.weekly_repo_digest(_week(spark, sf_dir))
    return rows.withColumn("contributors_top", F.array_join(person, ";"))


def _single_actor(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = digest.single_group(_week(spark, sf_dir), actor_login="u5")
    return digest.digest_blocks(rows, digest.ACTOR_KEYS)


def _relations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return relations.user_relations(supplied.relation_pages(spark, sf_dir))


def _relations_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = _tables(spark)
    relations.write_user_relations(tables, _relations(spark, sf_dir))
    stored = tables.read("gh_user_relations", schemas.USER_RELATIONS)
    return stored.groupBy("dt_kst", "relation_type").agg(F.count("*").alias("row_count"))


LOOKED_UP = "camel_user_37"


def _relations_of_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = _tables(spark)
    relations.write_user_relations(tables, _relations(spark, sf_dir))
    return _unzoned(relations.relations_of(tables, LOOKED_UP))


def _cohort_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(marts.dm_user_cohort_summary(supplied.order_fact(spark, sf_dir)))


def _rounded(rows: DataFrame) -> DataFrame:
    doubles = [f.name for f in rows.schema.fields if f.dataType.typeName() == "double"]
    return rows.withColumns({name: F.round(name, 9) for name in doubles})


def _stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = _tables(spark)
    lines = ingest.archive_stream(spark, _line_files(spark, sf_dir, tables), files_per_batch=20)
    query = ingest.stream_ingest(lines, tables, tables.path("_checkpoint"))
    query.awaitTermination()
    ingest.compact_days(tables, "gh_archive_by_batch", ["2024-01-05", "2024-01-06"])
    stored = ingest.read_batches(tables, "gh_archive_by_batch")
    return _unzoned(stored.select(*schemas.FILTERED_EVENT.names))


def _stream_daily_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = _tables(spark)
    lines = ingest.archive_stream(spark, _line_files(spark, sf_dir, tables), files_per_batch=20)
    query = ingest.stream_daily_counts(lines, tables, tables.path("_checkpoint"))
    query.awaitTermination()
    return tables.read("dw_activity_daily", schemas.ACTIVITY_DAILY)


# --- registration ------------------------------------------------------------------


def _on_fact(build_rows: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: build_rows(_fact(spark, sf_dir))


def _on_orders(build_rows: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: build_rows(supplied.order_fact(spark, sf_dir))


def _on_events(build_rows: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: build_rows(_events(spark, sf_dir))


def _on_user_days(build_rows: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: build_rows(_user_days(spark, sf_dir))


def _on_week(build_rows: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: build_rows(_week(spark, sf_dir))


def _on_typed(build_rows: Callable[..., DataFrame], *names: str) -> Query:
    return lambda spark, sf_dir: build_rows(*[_typed(spark, sf_dir, name) for name in names])


def _responses(issues: DataFrame, comments: DataFrame) -> DataFrame:
    return dashboards.median_first_response(dashboards.issue_first_response(issues, comments))


def _llm_modules() -> list:
    """The pipeline's query modules; none where the subpackage is not installed."""
    try:
        from eventloom.llm import queries as llm_queries

        import corpus_pipeline
    except ModuleNotFoundError as missing:
        if missing.name not in ("eventloom.llm", "corpus_pipeline"):
            raise
        return []
    return [llm_queries, corpus_pipeline]


def analytics_queries() -> dict[str, Query]:
    return {
        # ingest and helpers
        "gh_archive_filtered": lambda s, d: _unzoned(_ingested(s, d)),
        "partition_summary": lambda s, d: archive.partition_summary(_ingested(s, d)),
        "ingest_day_files": _ingest_day_files,
        "ingest_hour_status": _ingest_hour_status,
        "ingest_other_hours": _ingest_other_hours,
        "append_schema_merge": _append_schema_merge,
        "scalar_helpers": _scalar_helpers,
        "filter_bar": _on_fact(
            lambda fact: filter_bar(
                fact,
                start="2024-01-05",
                end="2024-01-25",
                organization="Pseudo-Lab",
                event_types=["PushEvent", "WatchEvent", "IssuesEvent"],
            )
        ),
        # staging, typed tables, facts
        "stg_gh_events": _stg,
        **{name: _on_typed(lambda rows: rows, name) for name in build.EVENT_SHAPES},
        "dw_activity_daily": _fact,
        "dw_activity_feed": _on_events(feed.dw_activity_feed),
        "dw_activity_feed_from_tables": _on_events(
            lambda rows: feed.feed_from_tables(events.typed_tables(rows))
        ),
        "dw_watch_daily": _on_typed(facts.dw_watch_daily, "dl_watch_events"),
        "dm_watch_summary": _on_typed(
            lambda rows: facts.dm_watch_summary(facts.dw_watch_daily(rows)), "dl_watch_events"
        ),
        # dimensions
        "dim_event_type": _on_fact(dims.dim_event_type),
        "dim_organization": _on_fact(dims.dim_organization),
        "dim_repository": _on_fact(dims.dim_repository),
        "dim_user": lambda s, d: dims.dim_user(_fact(s, d), _typed(s, d, "dl_create_events")),
        # marts
        "dm_activity_daily_org_repo": _on_fact(facts.dm_activity_daily_org_repo),
        "dm_unique_users_by_org_repo": _on_fact(facts.dm_unique_users_by_org_repo),
        "dm_active_users_daily": _on_orders(marts.dm_active_users_daily),
        "dm_org_overview": _on_orders(marts.dm_org_overview),
        "dm_user_activity": _on_orders(marts.dm_user_activity),
        "dm_repo_contributors": _on_orders(marts.dm_repo_contributors),
        "dm_user_retention": _on_orders(marts.dm_user_retention),
        "dm_user_cohort_summary": _cohort_summary,
        # the same marts, brought up to date day by day
        "daily_active_users": _by_day("dm_active_users_daily", schemas.ACTIVE_USERS_DAILY),
        "daily_org_overview": _by_day("dm_org_overview", schemas.ORG_OVERVIEW),
        "daily_user_activity": _by_day("dm_user_activity", schemas.USER_ACTIVITY),
        "daily_repo_contributors": _by_day("dm_repo_contributors", schemas.REPO_CONTRIBUTORS),
        "daily_retention": _by_day("dm_user_retention", schemas.USER_RETENTION),
        "daily_cohort_summary": lambda s, d: _rounded(
            _by_day("dm_user_cohort_summary", schemas.COHORT_SUMMARY)(s, d)
        ),
        # dashboards
        "event_type_trend": _on_fact(
            lambda fact: dashboards.event_type_trend(
                facts.dm_activity_daily_org_repo(fact),
                start="2024-01-03",
                end="2024-01-27",
                organization="apache",
            )
        ),
        "top_repos_by_contributors": _on_orders(dashboards.top_repos_by_contributors),
        "contributors_by_repo": _on_orders(
            lambda fact: dashboards.contributors_by_repo(fact, top_n=3, end="2024-04-01")
        ),
        "user_daily_activity_raw": _on_events(dashboards.user_daily_activity_raw),
        "user_daily_activity": _user_days,
        "kpi_dau_wau_mau": _on_orders(lambda fact: dashboards.kpi_active(fact, AS_OF)),
        "kpi_new_contributors": _on_orders(
            lambda fact: dashboards.kpi_new_contributors(fact, "2024-01-20")
        ),
        "kpi_d1_retention": _on_orders(lambda fact: dashboards.kpi_d1_retention(fact, AS_OF)),
        "dau_trend": _on_orders(
            lambda fact: dashboards.dau_trend(fact, start="2024-02-01", end="2024-04-30")
        ),
        "event_user_trend": _on_user_days(dashboards.event_user_trend),
        "event_user_trend_filtered": _on_user_days(
            lambda days: dashboards.event_user_trend(
                days, organization="apache", start="2024-02-01", end="2024-03-01"
            )
        ),
        "top_contributors": _on_user_days(dashboards.top_contributors),
        "engagement_funnel": _on_user_days(dashboards.engagement_funnel),
        "engagement_funnel_total": _on_user_days(
            lambda days: dashboards.engagement_funnel_total(
                dashboards.engagement_funnel(days), organization="apache"
            )
        ),
        "repo_performance": _on_orders(lambda fact: dashboards.repo_performance(fact, AS_OF)),
        "repo_performance_top": _on_orders(
            lambda fact: dashboards.repo_performance(fact, AS_OF, organization="apache", top_n=3)
        ),
        "pr_issue_quality": _on_orders(dashboards.pr_issue_quality),
        "pr_issue_quality_top": _on_orders(
            lambda fact: dashboards.pr_issue_quality(fact, top_n=2, organization="Pseudo-Lab")
        ),
        "pr_lead_time": _on_typed(dashboards.pr_lead_time, "dl_pull_request_events"),
        "issue_first_response": _on_typed(
            dashboards.issue_first_response, "dl_issues_events", "dl_issue_comment_events"
        ),
        "median_first_response": _on_typed(
            _responses, "dl_issues_events", "dl_issue_comment_events"
        ),
        "review_depth": _on_typed(
            dashboards.review_depth,
            "dl_pull_request_review_events",
            "dl_pull_request_review_comment_events",
        ),
        "user_metrics": _on_orders(dashboards.user_metrics),
        # digests
        "weekly_extract": _week,
        "weekly_actor_groups": _on_week(lambda week: digest.groups(week, digest.ACTOR_KEYS)),
        "weekly_repo_groups": _on_week(lambda week: digest.groups(week, digest.REPO_KEYS)),
        "weekly_tsv_block": _on_week(lambda week: digest.digest_blocks(week, digest.ACTOR_KEYS)),
        "weekly_repo_tsv_block": _on_week(lambda week: digest.digest_blocks(week, digest.REPO_KEYS)),
        "weekly_tsv_pages_small": _on_week(
            lambda week: digest.digest_blocks(week, digest.ACTOR_KEYS, page_rows=7)
        ),
        "weekly_actor_prompt": _on_week(
            lambda week: digest.digest_prompts(
                digest.digest_blocks(week, digest.ACTOR_KEYS), digest.ACTOR_PROMPT
            )
        ),
        "weekly_repo_prompt": _on_week(
            lambda week: digest.digest_prompts(
                digest.digest_blocks(week, digest.REPO_KEYS), digest.REPO_PROMPT
            )
        ),
        "weekly_single_actor": _single_actor,
        "weekly_single_repo": _single_repo,
        "weekly_actor_digest": _weekly_actor_digest,
        "weekly_repo_digest": _weekly_repo_digest,
        "parse_report_json": _parse_report_json,
        "report_store": _report_store,
        "report_files": _report_files,
        # relations
        "follower_targets": _on_fact(
            lambda fact: relations.follower_targets(facts.dm_unique_users_by_org_repo(fact))
        ),
        "user_relations": lambda s, d: _unzoned(_relations(s, d)),
        "user_relations_write": _relations_write,
        "user_relations_lookup": _relations_of_user,
        # quality
        "dq_not_null": _on_events(quality.not_null),
        "dq_required_columns": _on_events(
            lambda rows: quality.not_null(rows.drop("public", "dt_utc"))
        ),
        # pushes ingested a second time
        "dq_unique": _on_events(
            lambda rows: quality.not_unique(rows.unionByName(rows.where(F.col("type") == "PushEvent")))
        ),
        "dq_time_columns": _dq_time_columns,
        "dq_freshness": _on_events(lambda rows: quality.freshness(rows, "2024-02-04")),
        # storage and streaming
        "declared_tables": _declared_tables,
        "fact_view": _fact_view,
        "pipeline_end_to_end": _pipeline_end_to_end,
        "replace_day": _replace_day,
        "backfill_range": _backfill_range,
        "backfill_resumed": _backfill_resumed,
        "stream_ingest": _stream_ingest,
        "stream_daily_counts": _stream_daily_counts,
    }


def queries() -> dict[str, Query]:
    every = analytics_queries()
    for module in _llm_modules():
        every |= module.queries()
    return every


def oracle_sql() -> dict[str, str]:
    every = all_sql()
    for module in _llm_modules():
        every |= module.oracle_sql()
    return every


def entry(spark: SparkSession) -> DataFrame:
    """Active users per day and repo over the smallest data set."""
    return queries()["dm_active_users_daily"](spark, SMOKE_DIR)
