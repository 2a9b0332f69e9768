"""Daily facts."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import short_repo
from .events import on_days


def dw_activity_daily(stg: DataFrame, days: Iterable[date] | None = None) -> DataFrame:
    """Events per day, organization, repo (short name), type and user.

    Partial counts are formed before the shuffle, so a key with a third of all
    events arrives as one row per input task.
    """
    return (
        on_days(stg, days, "base_date")
        .groupBy(
            "base_date",
            "organization",
            short_repo(F.col("repo_name")).alias("repo_name"),
            "event_type",
            F.col("actor_login").alias("user_login"),
        )
        .agg(F.count("*").alias("event_count"))
    )


def dw_watch_daily(watch_events: DataFrame, days: Iterable[date] | None = None) -> DataFrame:
    return (
        on_days(watch_events, days, "base_date")
        .groupBy(
            "base_date",
            "organization",
            short_repo(F.col("repo_name")).alias("repo_name"),
            "user_login",
        )
        .agg(F.count("*").alias("watch_started_count"))
    )


def dm_watch_summary(watch_daily: DataFrame, days: Iterable[date] | None = None) -> DataFrame:
    return (
        on_days(watch_daily, days, "base_date")
        .groupBy("base_date", "organization", F.col("repo_name").alias("repo"))
        .agg(F.count_distinct("user_login").alias("unique_watchers"))
    )


def dm_activity_daily_org_repo(fact: DataFrame) -> DataFrame:
    """The fact without its user column. Rows are not merged: one per user stays."""
    return fact.select(
        "base_date", "organization", F.col("repo_name").alias("repo"), "event_type", "event_count"
    )


def dm_unique_users_by_org_repo(fact: DataFrame) -> DataFrame:
    return fact.select(
        "organization", F.col("repo_name").alias("repo"), "user_login"
    ).distinct()
