"""Declared schemas. Nothing is inferred at read time."""

from __future__ import annotations

from pyspark.sql.types import ArrayType, StringType, StructField, StructType

_TYPE_NAMES = {"bigint": "long", "int": "integer"}


def flat(columns: str) -> StructType:
    """Flat schema from 'name type, name type, ...' (needs no session)."""
    schema = StructType()
    for column in columns.split(","):
        name, kind = column.split()
        schema.add(name, _TYPE_NAMES.get(kind, kind))
    return schema


def _texts(*names: str) -> list[StructField]:
    return [StructField(name, StringType()) for name in names]


def _lists(*names: str) -> list[StructField]:
    return [StructField(name, ArrayType(StringType())) for name in names]


def _records(name: str, *fields: StructField) -> StructField:
    return StructField(name, ArrayType(StructType(list(fields))))


# One line of an hourly archive file. Nested objects are kept as JSON text: a
# STRING field makes the JSON reader hand over the object's own text.
RAW_EVENT = flat(
    "id string, type string, actor string, repo string, org string, payload string, "
    "public string, created_at string"
)

FILTERED_EVENT = flat(
    "id string, type string, actor string, repo string, org string, payload string, "
    "public boolean, created_at timestamp, ts_utc timestamp, dt_utc date, "
    "ts_kst timestamp_ntz, dt_kst date, organization string"
)

STG_EVENTS = flat(
    "event_id string, event_type string, repo_name string, organization string, "
    "actor_login string, ts_kst timestamp_ntz, base_date date"
)

ACTIVITY_DAILY = flat(
    "base_date date, organization string, repo_name string, event_type string, "
    "user_login string, event_count bigint"
)

WATCH_DAILY = flat(
    "base_date date, organization string, repo_name string, user_login string, "
    "watch_started_count bigint"
)

ACTIVITY_FEED = flat(
    "activity_id string, source_event_type string, organization string, repo_name string, "
    "actor_login string, activity_text string, ts_kst timestamp_ntz, base_date date"
)

WATCH_SUMMARY = flat(
    "base_date date, organization string, repo string, unique_watchers bigint"
)

DIM_EVENT_TYPE = flat("event_type string")
DIM_ORGANIZATION = flat("organization string, first_seen_date date")
DIM_REPOSITORY = flat("organization string, repo_name string, first_seen_date date")
DIM_USER = flat(
    "user_login string, first_seen_date date, last_seen_date date, "
    "first_seen_organization string, first_seen_repo string, "
    "last_seen_organization string, last_seen_repo string, "
    "has_create_event boolean, has_member_event boolean, has_pull_request_event boolean, "
    "has_pr_review_comment_event boolean, has_push_event boolean, has_issues_event boolean, "
    "has_watch_event boolean, is_builder boolean, builder_first_date date"
)

ACTIVE_USERS_DAILY = flat(
    "base_date date, organization string, repo_name string, "
    "dau_any bigint, dau_light bigint, dau_medium bigint, dau_heavy bigint, "
    "wau_any bigint, wau_light bigint, wau_medium bigint, wau_heavy bigint, "
    "mau_any bigint, mau_light bigint, mau_medium bigint, mau_heavy bigint, "
    "stickiness_ratio double, new_users_count bigint, returning_users_count bigint"
)

ORG_OVERVIEW = flat(
    "activity_date date, aggregation_level string, organization string, "
    "total_repos_count bigint, active_repos_count bigint, total_contributors_count bigint, "
    "new_contributors_count bigint, active_contributors_count bigint, "
    "total_commits_count bigint, total_pr_count bigint, total_issues_count bigint, "
    "total_reviews_count bigint, total_stars_count bigint, total_forks_count bigint, "
    "total_events_count bigint"
)

USER_ACTIVITY = flat(
    "activity_date date, aggregation_level string, user_login string, organization string, "
    "repo_name string, total_events_count bigint, commits_count bigint, pr_count bigint, "
    "pr_review_count bigint, pr_review_comment_count bigint, issue_count bigint, "
    "issue_comment_count bigint, watch_count bigint, fork_count bigint, create_count bigint, "
    "delete_count bigint, wiki_count bigint, member_count bigint, active_days_count bigint, "
    "first_activity_date date, last_activity_date date"
)

REPO_CONTRIBUTORS = flat(
    "period_start_date date, period_end_date date, aggregation_level string, "
    "organization string, repo_name string, user_login string, total_events_count bigint, "
    "commits_count bigint, pr_count bigint, pr_review_count bigint, "
    "pr_review_comment_count bigint, issue_count bigint, issue_comment_count bigint, "
    "watch_count bigint, fork_count bigint, contribution_score bigint, rank_in_repo bigint, "
    "active_days_count bigint, first_activity_date date, last_activity_date date"
)

USER_RETENTION = flat(
    "cohort_date date, organization string, repo_name string, days_since_cohort int, "
    "retention_check_date date, cohort_size bigint, cohort_activity_type string, "
    "retained_users_any bigint, retained_users_light bigint, retained_users_medium bigint, "
    "retained_users_heavy bigint, retention_rate_any double, retention_rate_light double, "
    "retention_rate_medium double, retention_rate_heavy double"
)

COHORT_SUMMARY = flat(
    "cohort_month string, organization string, repo_name string, cohort_size bigint, "
    "light_users_count bigint, medium_users_count bigint, heavy_users_count bigint, "
    "day1_retention double, day7_retention double, day14_retention double, "
    "day30_retention double, day60_retention double, day90_retention double, "
    "avg_events_per_user double, avg_active_days_per_user double, avg_lifetime_days double"
)

# A landed page of the relations listing: one user, one kind, one JSON array.
RELATION_PAGE = flat(
    "username string, relation_type string, page string, collected_at string"
)

USER_RELATIONS = flat(
    "username string, relation_type string, related_login string, related_id bigint, "
    "related_type string, related_html_url string, raw string, collected_at timestamp, "
    "ts_utc timestamp, dt_utc date, ts_kst timestamp_ntz, dt_kst date"
)

ACTOR_WEEK_REPORT = StructType(
    [
        *_texts("week_start", "actor_login"),
        *_lists("organization_set"),
        _records("top_repos", *_texts("repo_name"), *_lists("events")),
        *_texts("summary"),
        *_lists("highlights", "suggestions"),
    ]
)

REPO_WEEK_REPORT = StructType(
    [
        *_texts("week_start", "organization", "repo_name"),
        _records("contributors_top", *_texts("actor_login", "notable_activity")),
        *_texts("summary"),
        *_lists("highlights_dev", "highlights_manage", "community_signals", "risks_or_followups"),
    ]
)
