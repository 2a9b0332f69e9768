from datetime import date, timedelta

from pyspark.sql import functions as F

from eventloom import schemas
from eventloom.plans import dashboards, dims, facts, marts, quality
from eventloom.sources import supplied

DAY = date(2024, 1, 10)
SF_DIR = "/root/testdata/sf0.001"


def fact(spark, *rows):
    """Rows of (day offset, user, event type[, count])."""
    full = [
        (DAY + timedelta(days=row[0]), "Pseudo-Lab", "study", row[2], row[1], row[3] if len(row) > 3 else 1)
        for row in rows
    ]
    return spark.createDataFrame(full, schemas.ACTIVITY_DAILY)


def test_active_users_edges(spark):
    rows = fact(
        spark,
        (0, "u", "PushEvent"), (6, "u", "PushEvent"), (13, "u", "PushEvent"), (21, "u", "PushEvent"),
        (40, None, "PushEvent"), (80, "v", "MemberEvent"),
    )
    got = {row.base_date: row for row in marts.dm_active_users_daily(rows).collect()}
    assert {(d - DAY).days: r.returning_users_count for d, r in got.items()} == {0: 0, 6: 0, 13: 1, 21: 1, 40: 0, 80: 0}
    nobody = got[DAY + timedelta(days=40)]
    assert (nobody.dau_any, nobody.new_users_count, nobody.mau_any) == (0, 0, 1)
    alone = got[DAY + timedelta(days=80)]
    assert (alone.dau_any, alone.mau_any, alone.stickiness_ratio, alone.new_users_count) == (0, 0, 0.0, 1)


def test_active_users_scope(spark):
    other = fact(spark, (0, "u", "PushEvent")).withColumn("organization", F.lit("else"))
    assert marts.dm_active_users_daily(other).count() == 0
    assert marts.dm_active_users_daily(other.withColumn("repo_name", F.lit("superset"))).count() == 1
    gone = fact(spark, (0, "u", "PushEvent")).withColumn("repo_name", F.lit(None).cast("string"))
    assert marts.dm_active_users_daily(gone).count() == 0


def test_retention(spark):
    rows = fact(
        spark,
        (0, "u", "PushEvent"), (0, "u", "IssuesEvent"), (1, "u", "WatchEvent"), (7, "u", "GollumEvent"),
        (90, "u", "PushEvent"), (0, "w", "GollumEvent"),
    )
    got = {(row.cohort_activity_type, row.days_since_cohort): row for row in marts.dm_user_retention(rows).collect()}
    assert len(got) == 12
    heavy = {n: got["Heavy", n].retention_rate_any for n in (1, 7, 14, 30, 60, 90)}
    assert heavy == {1: 1.0, 7: 1.0, 14: 0.0, 30: 0.0, 60: 0.0, 90: 1.0}
    assert got["Heavy", 1].retained_users_light == 1 and got["Heavy", 7].retained_users_heavy == 0
    assert got["Unknown", 1].cohort_size == 1
    summary = marts.dm_user_cohort_summary(rows).first()
    assert (summary.cohort_size, summary.heavy_users_count, summary.light_users_count) == (2, 1, 0)
    assert (summary.day1_retention, summary.day14_retention) == (0.5, 0.0)
    assert (summary.avg_active_days_per_user, summary.avg_lifetime_days) == (2.5, 45.0)


def test_rank_ties_by_name(spark):
    rows = fact(spark, (0, "b", "PushEvent"), (0, "a", "PushEvent"), (0, "c", "PullRequestEvent"), (0, "ab", "IssuesEvent"))
    got = marts.dm_repo_contributors(rows).where("aggregation_level = 'day'").orderBy("rank_in_repo")
    assert [row.user_login for row in got.collect()] == ["c", "a", "ab", "b"]


def test_week_sums_equal_day_sums(spark):
    source = supplied.order_fact(spark, SF_DIR)
    rows = marts.dm_user_activity(source).groupBy("aggregation_level").agg(
        F.sum("total_events_count").alias("n"), F.sum("commits_count").alias("c")
    )
    assert len({(row.n, row.c) for row in rows.collect()}) == 1


def test_schemas(spark):
    orders = supplied.order_fact(spark, SF_DIR)
    pairs = {
        "active": (marts.dm_active_users_daily(orders), schemas.ACTIVE_USERS_DAILY),
        "org": (marts.dm_org_overview(orders), schemas.ORG_OVERVIEW),
        "user": (marts.dm_user_activity(orders), schemas.USER_ACTIVITY),
        "repo": (marts.dm_repo_contributors(orders), schemas.REPO_CONTRIBUTORS),
        "retention": (marts.dm_user_retention(orders), schemas.USER_RETENTION),
        "unique": (dims.dim_event_type(orders), schemas.DIM_EVENT_TYPE),
        "organization": (dims.dim_organization(orders), schemas.DIM_ORGANIZATION),
        "repository": (dims.dim_repository(orders), schemas.DIM_REPOSITORY),
    }
    for name, (df, schema) in pairs.items():
        assert [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in schema], name


def test_marts_shuffle_a_user_repo_once(spark):
    plan = marts.dm_user_activity(supplied.order_fact(spark, SF_DIR).repartition(3))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("REPARTITION_BY_COL") == 1


def test_rows_are_multiplied_in_many_partitions(spark):
    """However few bytes a shuffle has, its partitions are not merged before rows become periods."""
    rows = fact(spark, *[(0, f"u{n}", "PushEvent") for n in range(3000)])
    first = rows.selectExpr("organization", "user_login", "base_date AS first_day")
    for mart in (
        marts.dm_user_activity(rows),
        marts.dm_repo_contributors(rows),
        marts.dm_org_overview(rows),
        marts.dm_org_overview(rows, first),
    ):
        plan = mart._jdf.queryExecution().executedPlan().toString()
        assert f", {marts.SPREAD}), REPARTITION_BY_NUM" in plan
    spread = marts.dm_user_activity(rows).select(F.spark_partition_id()).distinct()
    assert spread.count() == marts.SPREAD


def test_org_repo_view_keeps_one_row_per_user(spark):
    rows = facts.dm_activity_daily_org_repo(fact(spark, (0, "a", "PushEvent"), (0, "b", "PushEvent")))
    assert rows.count() == 2


def test_dim_user_context(spark):
    def row(day, org, repo, count):
        return (DAY + timedelta(days=day), org, repo, "PushEvent", "u", count)

    rows = spark.createDataFrame(
        [row(0, None, "z", 5), row(0, "b", None, 5), row(0, "b", "a", 5), row(0, "a", "q", 4), row(3, None, None, 1)],
        schemas.ACTIVITY_DAILY,
    )
    creates = spark.createDataFrame([("u", True, DAY)], "user_login string, is_repo_creation boolean, base_date date")
    got = dims.dim_user(rows, creates).first()
    assert (got.first_seen_organization, got.first_seen_repo) == ("b", "a")
    assert (got.last_seen_organization, got.last_seen_repo, got.is_builder) == (None, None, True)


def test_kpis_without_rows(spark):
    empty = spark.createDataFrame([], schemas.ACTIVITY_DAILY)
    assert tuple(dashboards.kpi_active(empty, DAY).first()) == (0, 0, 0)
    assert dashboards.kpi_d1_retention(empty, DAY).first()[0] == 0.0
    assert dashboards.kpi_new_contributors(empty, DAY).first()[0] == 0


def test_user_metrics_per_organization(spark):
    rows = fact(spark, (0, "u", "PushEvent"), (1, "u", "PushEvent"), (1, "v", "PushEvent"), (3, "u", "PushEvent"))
    got = {(r.activity_date - DAY).days: r for r in dashboards.user_metrics(rows, ("organization",)).collect()}
    assert {n: r.retention_d1_pct for n, r in got.items()} == {0: 0.0, 1: 100.0, 3: 0.0}
    assert got[3].weekly_active_users == 2 and got[1].new_contributors == 1


def test_quality(spark):
    source = supplied.filtered_events(spark, SF_DIR)
    assert quality.missing_columns(source) == [] and quality.missing_columns(source.drop("org", "id")) == ["id"]
    stored = source.withColumn("ts_utc", F.col("ts_utc").cast("timestamp"))
    assert quality.time_columns_valid(stored)
    assert not quality.time_columns_valid(source) and not quality.time_columns_valid(stored.drop("dt_kst"))
    status = {n: quality.freshness(fact(spark, (0, "u", "x")), DAY + timedelta(days=n), "base_date").first().status for n in (2, 3, 7, 8)}
    assert status == {2: "pass", 3: "warn", 7: "warn", 8: "error"}
    assert quality.freshness(fact(spark, (0, "u", "x")).limit(0), DAY, "base_date").first().status == "error"
