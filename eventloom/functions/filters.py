"""Filters that apply only where a value is given."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def filter_bar(
    df: DataFrame,
    *,
    start: date | str | None = None,
    end: date | str | None = None,
    organization: str | None = None,
    repo: str | None = None,
    user: str | None = None,
    event_types: Iterable[str] | None = None,
    day_column: str = "base_date",
    repo_column: str = "repo_name",
    organization_column: str = "organization",
    user_column: str = "user_login",
) -> DataFrame:
    """The dashboard filter bar: date range, organization, repo, user, event types."""
    if start is not None:
        df = df.where(F.col(day_column) >= F.lit(str(start)).cast("date"))
    if end is not None:
        df = df.where(F.col(day_column) <= F.lit(str(end)).cast("date"))
    if organization is not None:
        df = df.where(F.col(organization_column) == organization)
    if repo is not None:
        df = df.where(F.col(repo_column) == repo)
    if user is not None:
        df = df.where(F.col(user_column) == user)
    if event_types is not None:
        df = df.where(F.col("event_type").isin(*event_types))
    return df
