"""Dimensions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import short_repo


def dim_event_type(fact: DataFrame) -> DataFrame:
    return fact.where(F.col("event_type").isNotNull()).select("event_type").distinct()


def dim_organization(fact: DataFrame) -> DataFrame:
    return (
        fact.where(F.col("organization").isNotNull())
        .groupBy("organization")
        .agg(F.min("base_date").alias("first_seen_date"))
    )


def dim_repository(fact: DataFrame) -> DataFrame:
    return (
        fact.dropna(subset=["organization", "repo_name"])
        .groupBy("organization", short_repo(F.col("repo_name")).alias("repo_name"))
        .agg(F.min("base_date").alias("first_seen_date"))
    )


# Experience flags and the event type behind each.
_EXPERIENCE = {
    "has_create_event": "CreateEvent",
    "has_member_event": "MemberEvent",
    "has_pull_request_event": "PullRequestEvent",
    "has_pr_review_comment_event": "PullRequestReviewCommentEvent",
    "has_push_event": "PushEvent",
    "has_issues_event": "IssuesEvent",
    "has_watch_event": "WatchEvent",
}


def _context(day_rank: Column) -> Column:
    """Sort key of a user's row: day first, then most events, then names, NULLs last."""
    return F.struct(
        day_rank.alias("day_rank"),
        (-F.col("event_count")).alias("events"),
        F.col("organization").isNull().alias("no_org"),
        F.col("organization").alias("organization"),
        F.col("repo_name").isNull().alias("no_repo"),
        F.col("repo_name").alias("repo_name"),
    )


def dim_user(fact: DataFrame, create_events: DataFrame) -> DataFrame:
    """First and last activity with its context, event experience, builder date.

    The first and last context are minima of a sort key, so one aggregation
    with partial results replaces two self-joins and two windows, and a busy
    user is no harder than any other.
    """
    day = F.unix_date(F.col("base_date"))
    users = (
        fact.where(F.col("user_login").isNotNull())
        .groupBy("user_login")
        .agg(
            F.min("base_date").alias("first_seen_date"),
            F.max("base_date").alias("last_seen_date"),
            F.min(_context(day)).alias("_first"),
            F.min(_context(-day)).alias("_last"),
            *[
                F.coalesce(F.bool_or(F.col("event_type") == kind), F.lit(False)).alias(flag)
                for flag, kind in _EXPERIENCE.items()
            ],
        )
    )
    builders = (
        create_events.where(F.col("is_repo_creation") & F.col("user_login").isNotNull())
        .groupBy("user_login")
        .agg(F.min("base_date").alias("builder_first_date"), F.lit(True).alias("_builder"))
    )
    return users.join(builders.hint("merge"), "user_login", "left").select(
        "user_login",
        "first_seen_date",
        "last_seen_date",
        F.col("_first.organization").alias("first_seen_organization"),
        F.col("_first.repo_name").alias("first_seen_repo"),
        F.col("_last.organization").alias("last_seen_organization"),
        F.col("_last.repo_name").alias("last_seen_repo"),
        *_EXPERIENCE,
        F.coalesce("_builder", F.lit(False)).alias("is_builder"),
        "builder_first_date",
    )
