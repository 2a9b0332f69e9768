"""Marts over the daily activity fact.

The fact holds one row per (day, organization, repo, type, user). A (user,
organization, repo) key therefore has at most days x types rows, and can be
brought together in one shuffle that every step of a mart reuses. Groups
without that bound (an organization, a repo) are only ever aggregated with
partial results or cut into slices.

Rolling up to periods makes three wide rows of one. That is done in a given number of
partitions: merged by their shuffled bytes they would hold a hundred times as much. Where
the rows are stored their number is known, and partitions grow with it (`parts_for`).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import columns as c
from ..functions import fixed
from ..operators.grains import explode_periods
from ..operators.ranking import sliced_row_number
from ..operators.rolling import rolling_distinct

USER_REPO = ["organization", "repo_name", "user_login"]
SPREAD = 192  # least partitions in which rows of unknown number are multiplied
ROWS_IN_PART = 50_000  # rows of a partition where their number is known

# Count columns and the event types they add up.
_COUNTS = {
    "commits_count": ("PushEvent",),
    "pr_count": ("PullRequestEvent",),
    "pr_review_count": ("PullRequestReviewEvent",),
    "pr_review_comment_count": ("PullRequestReviewCommentEvent",),
    "issue_count": ("IssuesEvent",),
    "issue_comment_count": ("IssueCommentEvent",),
    "watch_count": ("WatchEvent",),
    "fork_count": ("ForkEvent",),
    "create_count": ("CreateEvent",),
    "delete_count": ("DeleteEvent",),
    "wiki_count": ("GollumEvent",),
    "member_count": ("MemberEvent",),
}
_CONTRIBUTOR_COUNTS = list(_COUNTS)[:8]
_ORG_COUNTS = {
    "total_commits_count": ("PushEvent",),
    "total_pr_count": ("PullRequestEvent",),
    "total_issues_count": ("IssuesEvent",),
    "total_reviews_count": ("PullRequestReviewEvent", "PullRequestReviewCommentEvent"),
    "total_stars_count": ("WatchEvent",),
    "total_forks_count": ("ForkEvent",),
}


def parts_for(rows: DataFrame) -> int:
    """Partitions for stored rows, which are counted from their files' footers: no task gets more with more rows."""
    return max(rows.sparkSession.sparkContext.defaultParallelism, -(-rows.count() // ROWS_IN_PART))


def _spread(df: DataFrame, keys: Sequence[str], parts: int | None = None) -> DataFrame:
    """Rows of a key together, in partitions that adaptive execution does not merge."""
    if parts is None:
        parts = max(SPREAD, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return df.repartition(parts, *[F.col(key) for key in keys])


def _user_days(fact: DataFrame, sums: dict[str, Column], parts: int | None = None) -> DataFrame:
    """One row per user, repo and day, all of a user's repo days in one partition."""
    dealt = fact.repartition(*[F.col(key) for key in USER_REPO]) if parts is None else _spread(fact, USER_REPO, parts)
    return (
        dealt.groupBy(*USER_REPO, "base_date")
        .agg(*[column.alias(name) for name, column in sums.items()])
    )


def _kind() -> Column:
    """Class of a user day: the heaviest it has."""
    return (
        F.when(F.col("is_heavy"), "Heavy")
        .when(F.col("is_medium"), "Medium")
        .when(F.col("is_light"), "Light")
        .otherwise("Unknown")
    )


def user_repo_days(fact: DataFrame, parts: int | None = None) -> DataFrame:
    """One row per user, repo and day with sums, score and class flags: what the user marts add up.

    Given `parts`, in so many partitions, else in as many as the shuffled bytes ask for.
    """
    sums = {"total_events_count": F.sum("event_count")}
    sums |= {name: c.typed_sum(types) for name, types in _COUNTS.items()}
    sums |= {"contribution_score": F.sum(c.contribution())}
    sums |= {f"is_{name}": F.bool_or(flag) for name, flag in c.class_flags().items()}
    return _user_days(fact, sums, parts)


def _period_activity(days: DataFrame, sums: Sequence[str], parts: int | None = None) -> DataFrame:
    """Roll user days up to day, week and month, dealt finely before they are multiplied.

    The keys stand in another order than in the shuffle before: one that looks the same is left out.
    """
    return (
        explode_periods(_spread(days, USER_REPO[::-1], parts))
        .groupBy(*USER_REPO, "level", "start", "end")
        .agg(
            *[F.sum(name).alias(name) for name in sums],
            F.count("*").alias("active_days_count"),
            F.min("base_date").alias("first_activity_date"),
            F.max("base_date").alias("last_activity_date"),
        )
        .where(F.col("total_events_count") > 0)
    )


def dm_user_activity(fact: DataFrame) -> DataFrame:
    return user_activity_of(user_repo_days(fact))


def user_activity_of(days: DataFrame, parts: int | None = None) -> DataFrame:
    """The same from user days."""
    sums = ["total_events_count", *_COUNTS]
    days = days.where(F.col("user_login").isNotNull()).select(*USER_REPO, "base_date", *sums)
    return _period_activity(days, sums, parts).select(
        F.col("start").alias("activity_date"),
        F.col("level").alias("aggregation_level"),
        "user_login",
        "organization",
        "repo_name",
        *sums,
        "active_days_count",
        "first_activity_date",
        "last_activity_date",
    )


def dm_repo_contributors(fact: DataFrame) -> DataFrame:
    """Contributors per repo and period with score and rank.

    Ties in score and events are ranked by user name. A repo's contributors are
    ranked slice by slice, since one repo may hold a large part of all rows.
    """
    return repo_contributors_of(user_repo_days(fact))


def repo_contributors_of(days: DataFrame, parts: int | None = None) -> DataFrame:
    """The same from user days."""
    sums = ["total_events_count", *_CONTRIBUTOR_COUNTS, "contribution_score"]
    days = days.dropna(subset=USER_REPO).select(*USER_REPO, "base_date", *sums)
    ranked = sliced_row_number(
        _period_activity(days, sums, parts),
        group=["start", "end", "level", "organization", "repo_name"],
        slices={
            "_score": (F.col("contribution_score"), True),
            "_events": (F.col("total_events_count"), True),
            "_initials": (F.substring("user_login", 1, 2), False),
        },
        order=[F.asc("user_login")],
        name="rank_in_repo",
    )
    return ranked.select(
        F.col("start").alias("period_start_date"),
        F.col("end").alias("period_end_date"),
        F.col("level").alias("aggregation_level"),
        *USER_REPO,
        "total_events_count",
        *_CONTRIBUTOR_COUNTS,
        "contribution_score",
        "rank_in_repo",
        "active_days_count",
        "first_activity_date",
        "last_activity_date",
    )


def dm_org_overview(fact: DataFrame, first_seen: DataFrame | None = None) -> DataFrame:
    """Repos, contributors, newcomers and activity per organization and period.

    `first_seen` (organization, user_login, first_day) tells newcomers where the fact is
    only a part of the days; without it the first day in the fact counts.

    Each fact row stands once for its repo (with the sums) and once for its
    user. These are merged per day, the first day of every user is marked, the
    days are exploded to periods and merged again; what is left to count per
    organization is one row per repo or user and period.
    """
    sums = {name: c.typed_sum(types) for name, types in _ORG_COUNTS.items()}
    sums["total_events_count"] = F.sum("event_count")

    def member(kind: str, name: str, count: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), F.col(name).alias("name"), count.alias("n"))

    members = F.array(
        member("repo", "repo_name", F.col("event_count")),
        member("user", "user_login", F.lit(0).cast("bigint")),
    )
    key = ["organization", "kind", "name"]
    merged = (
        fact.where(F.col("organization").isNotNull())
        .withColumn("_m", F.explode(members))
        .select("organization", "base_date", "event_type", "_m.*")
        .withColumnRenamed("n", "event_count")
        .groupBy(*key, "base_date")
        .agg(*[column.alias(name) for name, column in sums.items()])
    )
    days = _spread(merged, ["organization", "name"])
    if first_seen is None:
        is_new = F.col("base_date") == F.min("base_date").over(Window.partitionBy(*key))
    else:
        known = first_seen.select(
            F.col("organization").alias("_org"), F.col("user_login").alias("_user"), "first_day"
        )
        here = (F.col("organization") == F.col("_org")) & (F.col("name") == F.col("_user"))
        days = days.join(known, here & (F.col("kind") == "user"), "left").drop("_org", "_user")
        is_new = F.coalesce(F.col("base_date") == F.col("first_day"), F.lit(False))
    periods = (
        explode_periods(days.withColumn("_new", is_new))
        .groupBy(*key, "level", "start")
        .agg(F.max("_new").alias("_new"), *[F.sum(name).alias(name) for name in sums])
    )
    named_user = (F.col("kind") == "user") & F.col("name").isNotNull()
    named_repo = (F.col("kind") == "repo") & F.col("name").isNotNull()
    per_org = periods.groupBy("organization", "level", "start").agg(
        F.count_if(named_repo).alias("repos"),
        F.count_if(named_user).alias("users"),
        F.count_if(named_user & F.col("_new")).alias("new_contributors_count"),
        *[F.sum(name).alias(name) for name in sums],
    )
    return per_org.where(F.col("total_events_count") > 0).select(
        F.col("start").alias("activity_date"),
        F.col("level").alias("aggregation_level"),
        "organization",
        F.col("repos").alias("total_repos_count"),
        F.col("repos").alias("active_repos_count"),
        F.col("users").alias("total_contributors_count"),
        "new_contributors_count",
        F.col("users").alias("active_contributors_count"),
        *sums,
    )


def in_active_scope(
    rows: DataFrame,
    organizations: Sequence[str] = fixed.ACTIVE_ORGANIZATIONS,
    repositories: Sequence[str] = fixed.ACTIVE_REPOSITORIES,
) -> DataFrame:
    in_scope = F.col("organization").isin(*organizations) | F.col("repo_name").isin(*repositories)
    return rows.where(in_scope).dropna(subset=["organization", "repo_name"])


def dm_active_users_daily(
    fact: DataFrame,
    organizations: Sequence[str] = fixed.ACTIVE_ORGANIZATIONS,
    repositories: Sequence[str] = fixed.ACTIVE_REPOSITORIES,
    windows: dict[str, int] | None = None,
    return_gap: int = fixed.RETURN_GAP_DAYS,
) -> DataFrame:
    """Daily, weekly and monthly active users per repo, by activity class."""
    flags = c.class_flags()
    scoped = in_active_scope(fact, organizations, repositories)
    days = _user_days(scoped, {f"is_{name}": F.bool_or(flag) for name, flag in flags.items()})
    return active_users_of(days, windows, return_gap)


def active_users_of(
    sightings: DataFrame, windows: dict[str, int] | None = None, return_gap: int = fixed.RETURN_GAP_DAYS
) -> DataFrame:
    """The same from user days in scope."""
    flags = c.class_flags()
    counts = rolling_distinct(
        sightings,
        group=["organization", "repo_name"],
        entity="user_login",
        day="base_date",
        flags={name: f"is_{name}" for name in flags},
        windows=windows or fixed.ACTIVE_WINDOWS,
        return_gap=return_gap,
    )
    prefixes = ["dau", *(windows or fixed.ACTIVE_WINDOWS)]
    return counts.select(
        "base_date",
        "organization",
        "repo_name",
        *[f"{prefix}_{name}" for prefix in prefixes for name in flags],
        c.ratio(F.col("dau_any"), F.col(f"{prefixes[-1]}_any")).alias("stickiness_ratio"),
        F.col("new_count").alias("new_users_count"),
        F.col("returning_count").alias("returning_users_count"),
    )


def dm_user_retention(
    fact: DataFrame, offsets: Sequence[int] = fixed.RETENTION_OFFSETS
) -> DataFrame:
    """Users of a first-day cohort seen again exactly n days later.

    Every user day is compared with its own cohort day, so no cross product of
    users and offsets is formed and nothing is joined; offsets are spread out
    only on the finished cohorts. Cohort days whose offset lies beyond the data
    count as not retained.
    """
    return user_retention_of(user_repo_days(fact), offsets)


def user_retention_of(days: DataFrame, offsets: Sequence[int] = fixed.RETENTION_OFFSETS) -> DataFrame:
    """The same from user days, which must hold the first day of each user."""
    flags = c.class_flags()
    days = days.dropna(subset=USER_REPO).select(*USER_REPO, "base_date", *[f"is_{name}" for name in flags])
    kind = _kind()
    since_first = Window.partitionBy(*USER_REPO).orderBy("base_date")
    upto = since_first.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    aged = days.withColumns(
        {
            "cohort_date": F.first("base_date").over(upto),
            "cohort_activity_type": F.first(kind).over(upto),
        }
    ).withColumn("_age", F.datediff("base_date", "cohort_date"))
    aged = aged.where(F.col("_age").isin(0, *offsets))

    def retained(offset: int) -> Column:
        on_day = F.col("_age") == offset
        return F.struct(
            F.lit(offset).alias("days_since_cohort"),
            F.count_if(on_day).alias("retained_users_any"),
            *[
                F.count_if(on_day & F.col(f"is_{name}")).alias(f"retained_users_{name}")
                for name in ("light", "medium", "heavy")
            ],
        )

    cohorts = aged.groupBy("cohort_date", "organization", "repo_name", "cohort_activity_type").agg(
        F.count_if(F.col("_age") == 0).alias("cohort_size"),
        F.array(*[retained(offset) for offset in offsets]).alias("_offsets"),
    )
    rows = cohorts.withColumn("_o", F.explode("_offsets")).select("*", "_o.*")
    names = ("any", "light", "medium", "heavy")
    return rows.select(
        "cohort_date",
        "organization",
        "repo_name",
        "days_since_cohort",
        F.date_add("cohort_date", F.col("days_since_cohort")).alias("retention_check_date"),
        "cohort_size",
        "cohort_activity_type",
        *[f"retained_users_{name}" for name in names],
        *[
            c.ratio(F.col(f"retained_users_{name}"), F.col("cohort_size")).alias(
                f"retention_rate_{name}"
            )
            for name in names
        ],
    )


def dm_user_cohort_summary(fact: DataFrame) -> DataFrame:
    """Monthly cohorts: sizes, size-weighted retention, activity per user.

    A size-weighted mean of retained / size is the share of people of the month who
    came back, so one row per user has all that is asked for: the fact is read once.
    """
    days = _user_days(
        fact.dropna(subset=USER_REPO),
        {f"is_{name}": F.bool_or(flag) for name, flag in c.class_flags().items()}
        | {"events": F.sum("event_count")},
    )
    kind = _kind()
    first = F.min("base_date").over(Window.partitionBy(*USER_REPO))
    people = (
        days.withColumn("_age", F.datediff("base_date", first))
        .groupBy(*USER_REPO)
        .agg(
            F.min("base_date").alias("first_day"),
            F.min_by(kind, "base_date").alias("kind"),
            F.count("*").alias("active_days"),
            F.sum("events").alias("events"),
            F.max("_age").alias("lifetime_days"),
            *[F.bool_or(F.col("_age") == n).alias(f"back_{n}") for n in fixed.RETENTION_OFFSETS],
        )
        .withColumn("cohort_month", F.date_format("first_day", "yyyy-MM"))
    )
    return cohort_summary_of(people)


def cohort_summary_of(people: DataFrame) -> DataFrame:
    """Cohort rows from one row per user: kind, sums, lifetime and the days it came back."""
    return people.groupBy("cohort_month", "organization", "repo_name").agg(
        F.count("*").alias("cohort_size"),
        *[
            F.count_if(F.col("kind") == name).alias(f"{name.lower()}_users_count")
            for name in ("Light", "Medium", "Heavy")
        ],
        *[
            F.avg(F.col(f"back_{n}").cast("double")).alias(f"day{n}_retention")
            for n in fixed.RETENTION_OFFSETS
        ],
        F.avg("events").alias("avg_events_per_user"),
        F.avg("active_days").alias("avg_active_days_per_user"),
        F.avg("lifetime_days").alias("avg_lifetime_days"),
    )
