"""Dashboard queries over the daily fact, the event table and the typed tables.

Where a query counts people, the fact is first reduced to one row per person
(and group) with partial aggregation, and conditions become flags of that row.
So no query carries several distinct counts over the whole fact.
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import columns as c
from ..functions.filters import filter_bar
from ..operators.median import exact_median
from ..operators.rolling import rolling_distinct

# Event counts of a user's day and the types they add up.
_DAY_COUNTS = {
    "push_count": ("PushEvent",),
    "pr_count": ("PullRequestEvent",),
    "issue_count": ("IssuesEvent",),
    "review_count": ("PullRequestReviewEvent",),
    "comment_count": ("IssueCommentEvent", "PullRequestReviewCommentEvent"),
    "star_count": ("WatchEvent",),
    "fork_count": ("ForkEvent",),
}


def _day(value: date | str) -> date:
    return value if isinstance(value, date) else date.fromisoformat(value)


def _lit_day(value: date) -> Column:
    return F.lit(value).cast("date")


# --- over the fact -----------------------------------------------------------


def event_type_trend(org_repo: DataFrame, **filters) -> DataFrame:
    """Events per day and type; takes the filter bar's arguments."""
    rows = filter_bar(org_repo, repo_column="repo", **filters)
    return rows.groupBy(F.col("base_date").alias("activity_date"), "event_type").agg(
        F.sum("event_count").alias("events")
    )


def top_repos_by_contributors(fact: DataFrame, top_n: int = 10, **filters) -> DataFrame:
    return (
        filter_bar(fact, **filters)
        .groupBy(F.col("organization").alias("org_login"), "repo_name")
        .agg(
            F.count_distinct("user_login").alias("contributors"),
            c.typed_sum(["PullRequestEvent"]).alias("prs"),
            c.typed_sum(["PushEvent"]).alias("pushes"),
            c.typed_sum(["IssuesEvent"]).alias("issues"),
        )
        .orderBy(F.desc("contributors"), "org_login", "repo_name")
        .limit(top_n)
    )


def contributors_by_repo(fact: DataFrame, top_n: int = 20, **filters) -> DataFrame:
    return (
        filter_bar(fact, **filters)
        .groupBy("repo_name")
        .agg(F.count_distinct("user_login").alias("contributors"))
        .orderBy(F.desc("contributors"), "repo_name")
        .limit(top_n)
    )


def user_daily_activity_raw(events: DataFrame) -> DataFrame:
    """Counts straight off the event table, with its own organization and full repo name."""
    return events.groupBy(
        F.col("dt_kst").alias("event_date"),
        F.get_json_object("actor", "$.login").alias("user_login"),
        F.col("type").alias("event_type"),
        "organization",
        F.get_json_object("repo", "$.name").alias("repo_name"),
    ).agg(F.count("*").alias("activity_count"))


def user_daily_activity(fact: DataFrame) -> DataFrame:
    """Day x user x organization with counts per kind and an engagement score."""
    return (
        fact.where(F.col("user_login").isNotNull())
        .groupBy(
            F.col("base_date").alias("activity_date"),
            "user_login",
            F.col("organization").alias("org_login"),
        )
        .agg(
            *[c.typed_sum(types).alias(name) for name, types in _DAY_COUNTS.items()],
            F.sum(c.contribution()).alias("engagement_score"),
        )
    )


def kpi_active(fact: DataFrame, as_of: date | str, organization: str | None = None) -> DataFrame:
    """DAU, WAU and MAU on a day: a user is in a window if the last day seen is."""
    day = _day(as_of)
    last = (
        filter_bar(fact, start=day - timedelta(days=29), end=day, organization=organization)
        .where(F.col("user_login").isNotNull())
        .groupBy("user_login")
        .agg(F.max("base_date").alias("last_day"))
    )
    return last.agg(
        F.count_if(F.col("last_day") == _lit_day(day)).alias("dau"),
        F.count_if(F.col("last_day") >= _lit_day(day - timedelta(days=6))).alias("wau"),
        F.count("*").alias("mau"),
    )


def kpi_new_contributors(
    fact: DataFrame, as_of: date | str, organization: str | None = None
) -> DataFrame:
    """Users whose first day is the given one."""
    day = _day(as_of)
    return (
        filter_bar(fact, end=day, organization=organization)
        .where(F.col("user_login").isNotNull())
        .groupBy("user_login")
        .agg(F.min("base_date").alias("first_day"))
        .agg(F.count_if(F.col("first_day") == _lit_day(day)).alias("new_contributors"))
    )


def kpi_d1_retention(
    fact: DataFrame, as_of: date | str, organization: str | None = None
) -> DataFrame:
    """Percent of the day before's users seen on the given day."""
    day = _day(as_of)
    before = F.col("base_date") < _lit_day(day)
    users = (
        filter_bar(fact, start=day - timedelta(days=1), end=day, organization=organization)
        .where(F.col("user_login").isNotNull())
        .groupBy("user_login")
        .agg(F.bool_or(before).alias("was_here"), F.bool_or(~before).alias("is_here"))
    )
    return users.agg(
        F.count_if(F.col("was_here")).alias("_base"),
        F.count_if(F.col("was_here") & F.col("is_here")).alias("_kept"),
    ).select(c.percent(F.col("_kept"), F.col("_base")).alias("d1_retention_pct"))


def dau_trend(fact: DataFrame, **filters) -> DataFrame:
    return (
        filter_bar(fact, **filters)
        .groupBy(F.col("base_date").alias("activity_date"))
        .agg(F.count_distinct("user_login").alias("dau"))
    )


def user_metrics(fact: DataFrame, by: tuple[str, ...] = (), **filters) -> DataFrame:
    """Per day: DAU, WAU, MAU, new contributors, next-day retention in percent."""
    group = list(by)
    sightings = (
        filter_bar(fact, **filters).dropna(subset=[*group, "user_login"])
        .groupBy(*group, "user_login", "base_date")
        .agg(F.lit(True).alias("is_any"))
    )
    counts = rolling_distinct(
        sightings,
        group=group,
        entity="user_login",
        day="base_date",
        flags={"any": "is_any"},
        windows={"wau": 7, "mau": 30},
    )
    # one row per day: bounded by the calendar
    days = Window.partitionBy(*(group or [F.lit(0)])).orderBy("base_date")
    day_before = F.lag(F.struct("base_date", "dau_any")).over(days)
    base = F.when(
        F.datediff("base_date", F.col("_before.base_date")) == 1, F.col("_before.dau_any")
    ).otherwise(0)
    return counts.withColumn("_before", day_before).select(
        *group,
        F.col("base_date").alias("activity_date"),
        F.col("dau_any").alias("daily_active_users"),
        F.col("wau_any").alias("weekly_active_users"),
        F.col("mau_any").alias("monthly_active_users"),
        F.col("new_count").alias("new_contributors"),
        c.percent(F.col("kept_count"), base).alias("retention_d1_pct"),
    )


# --- over user days ----------------------------------------------------------


def _bar(rows: DataFrame, **filters) -> DataFrame:
    """The filter bar over user days and what is made of them."""
    return filter_bar(rows, day_column="activity_date", organization_column="org_login", **filters)


def event_user_trend(user_days: DataFrame, **filters) -> DataFrame:
    """Users with at least one push / pull request / ... per day and organization."""
    kinds = ("push", "pr", "review", "comment", "issue")
    return _bar(user_days, **filters).groupBy("activity_date", "org_login").agg(
        *[F.count_if(F.col(f"{kind}_count") > 0).alias(f"{kind}_users") for kind in kinds]
    )


def top_contributors(
    user_days: DataFrame,
    top_n: int = 50,
    start: date | str | None = None,
    end: date | str | None = None,
    organization: str | None = None,
) -> DataFrame:
    rows = _bar(user_days, start=start, end=end, organization=organization)
    names = {
        "push_count": "pushes",
        "pr_count": "prs",
        "issue_count": "issues",
        "review_count": "reviews",
        "comment_count": "comments",
        "star_count": "stars",
        "fork_count": "forks",
        "engagement_score": "total_engagement_score",
    }
    return (
        rows.groupBy("user_login")
        .agg(*[F.sum(column).alias(name) for column, name in names.items()])
        .orderBy(F.desc("total_engagement_score"), "user_login")
        .limit(top_n)
    )


_FUNNEL = (
    "total_active_users",
    "users_with_push",
    "users_push_to_pr",
    "users_pr_to_review",
    "users_full_funnel",
)


def _conversions() -> list[Column]:
    steps = {
        "conv_active_to_push": (_FUNNEL[1], _FUNNEL[0]),
        "conv_push_to_pr": (_FUNNEL[2], _FUNNEL[1]),
        "conv_pr_to_review": (_FUNNEL[3], _FUNNEL[2]),
        "conv_review_to_comment": (_FUNNEL[4], _FUNNEL[3]),
        "conv_overall_funnel": (_FUNNEL[4], _FUNNEL[0]),
    }
    return [c.percent(F.col(part), F.col(whole)).alias(name) for name, (part, whole) in steps.items()]


def engagement_funnel(user_days: DataFrame, **filters) -> DataFrame:
    """Active, push, push & PR, & review, & comment users per day and organization."""
    push = F.col("push_count") > 0
    to_pr = push & (F.col("pr_count") > 0)
    to_review = to_pr & (F.col("review_count") > 0)
    full = to_review & (F.col("comment_count") > 0)
    steps = (F.lit(True), push, to_pr, to_review, full)
    counts = _bar(user_days, **filters).groupBy("activity_date", "org_login").agg(
        *[F.count_if(step).alias(name) for name, step in zip(_FUNNEL, steps)]
    )
    return counts.select("*", *_conversions())


def engagement_funnel_total(
    funnel: DataFrame,
    start: date | str | None = None,
    end: date | str | None = None,
    organization: str | None = None,
) -> DataFrame:
    """The funnel summed over days, conversions formed again from the sums."""
    rows = _bar(funnel, start=start, end=end, organization=organization)
    return rows.agg(*[F.sum(name).alias(name) for name in _FUNNEL]).select("*", *_conversions())


def repo_performance(
    fact: DataFrame,
    as_of: date | str,
    span: int = 30,
    organization: str | None = None,
    repo: str | None = None,
    top_n: int | None = None,
) -> DataFrame:
    """Contributors and engagement, last `span` days against the `span` before.

    With `top_n` the repos whose contributors grew most, those without growth last.
    """
    day = _day(as_of)
    recent_from, previous_from = (
        _lit_day(day - timedelta(days=span * n)) for n in (1, 2)
    )
    recent = F.col("base_date") > recent_from
    previous = (F.col("base_date") > previous_from) & ~recent

    def points(rows: Column) -> Column:
        return F.sum(F.when(rows, c.contribution()).otherwise(0))

    people = (
        filter_bar(fact, end=day, organization=organization, repo=repo)
        .dropna(subset=["organization", "repo_name", "user_login"])
        .groupBy("organization", "repo_name", "user_login")
        .agg(
            F.bool_or(recent).alias("is_recent"),
            F.bool_or(previous).alias("is_previous"),
            points(recent).alias("recent_points"),
            points(previous).alias("previous_points"),
            F.sum(c.contribution()).alias("points"),
            c.typed_sum(["PullRequestEvent"]).alias("prs"),
            c.typed_sum(["PushEvent"]).alias("pushes"),
            c.typed_sum(["IssuesEvent"]).alias("issues"),
            c.typed_sum(["WatchEvent"]).alias("stars"),
        )
    )
    repos = people.groupBy(F.col("organization").alias("org_login"), "repo_name").agg(
        F.count("*").alias("contributor_count"),
        F.count_if("is_recent").alias("recent_contributors"),
        F.count_if("is_previous").alias("previous_contributors"),
        F.sum("recent_points").alias("recent_engagement"),
        F.sum("previous_points").alias("previous_engagement"),
        F.sum("prs").alias("total_prs"),
        F.sum("pushes").alias("total_pushes"),
        F.sum("issues").alias("total_issues"),
        F.sum("stars").alias("total_stars"),
        F.sum("points").alias("_points"),
    )

    def growth(now: str, then: str) -> Column:
        change = (F.col(now) - F.col(then)).cast("double") * F.lit(100.0) / F.col(then).cast("double")
        return F.when(F.col(then) > 0, F.round(change, 2))

    rows = repos.select(
        "org_login",
        "repo_name",
        "contributor_count",
        "recent_contributors",
        "previous_contributors",
        growth("recent_contributors", "previous_contributors").alias("contributor_growth_pct"),
        "recent_engagement",
        "previous_engagement",
        growth("recent_engagement", "previous_engagement").alias("engagement_growth_pct"),
        "total_prs",
        "total_pushes",
        "total_issues",
        "total_stars",
        c.ratio(F.col("_points"), F.col("contributor_count")).alias(
            "avg_engagement_per_contributor"
        ),
        (F.col("recent_contributors") > 0).alias("recently_active"),
    )
    return _top(rows, F.desc_nulls_last("contributor_growth_pct"), top_n)


def _top(rows: DataFrame, order: Column, top_n: int | None) -> DataFrame:
    if top_n is None:
        return rows
    return rows.orderBy(order, "org_login", "repo_name").limit(top_n)


def pr_issue_quality(fact: DataFrame, top_n: int | None = None, **filters) -> DataFrame:
    """Review and comment density per repo; with `top_n` those with most pull requests.

    Each fact row stands once for its day (with the counts) and once for its
    user, so both distinct counts come out of one grouping.
    """

    def member(kind: str, name: Column, weight: int) -> Column:
        return F.struct(
            F.lit(kind).alias("kind"), name.alias("name"), (F.col("event_count") * weight).alias("n")
        )

    members = F.array(
        member("day", F.col("base_date").cast("string"), 1), member("user", F.col("user_login"), 0)
    )
    review = F.col("event_type") == "PullRequestReviewEvent"
    sums = {
        "total_prs": ("PullRequestEvent",),
        "total_issues": ("IssuesEvent",),
        "total_reviews": ("PullRequestReviewEvent",),
        "total_comments": ("IssueCommentEvent", "PullRequestReviewCommentEvent"),
    }
    rows = (
        filter_bar(fact, **filters)
        .dropna(subset=["organization", "repo_name"])
        .select("organization", "repo_name", "event_type", F.explode(members).alias("_m"))
        .select("organization", "repo_name", "event_type", "_m.*")
    )
    merged = rows.groupBy("organization", "repo_name", "kind", "name").agg(
        F.bool_or(review).alias("reviewed"),
        *[c.typed_sum(types, "n").alias(name) for name, types in sums.items()],
        F.sum("n").alias("events"),
    )
    person = (F.col("kind") == "user") & F.col("name").isNotNull()
    repos = merged.groupBy(F.col("organization").alias("org_login"), "repo_name").agg(
        *[F.sum(name).alias(name) for name in sums],
        F.sum("events").alias("_events"),
        F.count_if(F.col("kind") == "day").alias("_days"),
        F.count_if(person).alias("_people"),
        F.count_if(person & F.coalesce("reviewed", F.lit(False))).alias("_reviewers"),
    )
    ratios = repos.select(
        "org_login",
        "repo_name",
        *sums,
        c.ratio(F.col("total_reviews"), F.col("total_prs")).alias("avg_reviews_per_pr"),
        c.ratio(F.col("total_comments"), F.col("total_issues")).alias("avg_comments_per_issue"),
        c.ratio(F.col("_reviewers"), F.col("_people")).alias("reviewer_to_contributor_ratio"),
        c.ratio(F.col("_events"), F.col("_days")).alias("avg_activity_per_day"),
    )
    return _top(ratios, F.desc("total_prs"), top_n)


# --- over the typed tables ---------------------------------------------------


def _seconds(late: Column, early: Column) -> Column:
    whole = [F.unix_micros(ts.cast("timestamp")) for ts in (late, early)]
    return F.floor((whole[0] - whole[1]) / F.lit(1_000_000)).cast("bigint")


def pr_lead_time(pull_requests: DataFrame) -> DataFrame:
    """Median seconds from opening to merging, per repo.

    Opening and merge meet in one grouping by pull request, not in a self-join.
    """
    merged = (F.col("pr_action") == "closed") & F.col("is_merged")
    prs = (
        pull_requests.dropna(subset=["repo_name", "pr_number"])
        .groupBy("repo_name", "pr_number")
        .agg(
            F.min(F.when(F.col("pr_action") == "opened", F.col("ts_kst"))).alias("opened_at"),
            F.min(F.when(merged, F.col("ts_kst"))).alias("merged_at"),
        )
        .where(F.col("merged_at") >= F.col("opened_at"))
        .select("repo_name", _seconds(F.col("merged_at"), F.col("opened_at")).alias("lead"))
    )
    return exact_median(
        prs, group=["repo_name"], value="lead", width=3600, name="median_lead_seconds"
    ).withColumnRenamed("value_count", "merged_prs")


def issue_first_response(issues: DataFrame, comments: DataFrame) -> DataFrame:
    """Per opened issue: first comment by someone other than its author.

    The comment names the issue's author, so both tables are reduced to one row
    per issue (with partial results) before they meet. A first comment dated
    before the opening gives no response time.
    """
    opened = (
        issues.where(F.col("issue_action") == "opened")
        .dropna(subset=["repo_name", "issue_number"])
        .groupBy("repo_name", "issue_number")
        .agg(F.min("ts_kst").alias("opened_at"))
    )
    by_other = F.col("commenter_login") != F.col("issue_author_login")
    replied = (
        comments.where(by_other)
        .groupBy("repo_name", "issue_number")
        .agg(F.min("ts_kst").alias("first_response_at"))
    )
    span = _seconds(F.col("first_response_at"), F.col("opened_at"))
    return opened.join(replied.hint("merge"), ["repo_name", "issue_number"], "left").withColumn(
        "response_seconds", F.when(F.col("first_response_at") >= F.col("opened_at"), span)
    )


def median_first_response(responses: DataFrame) -> DataFrame:
    return exact_median(
        responses,
        group=["repo_name"],
        value="response_seconds",
        width=3600,
        name="median_response_seconds",
    ).withColumnRenamed("value_count", "answered_issues")


def review_depth(reviews: DataFrame, review_comments: DataFrame) -> DataFrame:
    """Reviews and review comments per reviewed pull request, per repo."""

    def side(rows: DataFrame, name: str, other: str) -> DataFrame:
        return (
            rows.dropna(subset=["repo_name", "pr_number"])
            .groupBy("repo_name", "pr_number")
            .agg(F.count("*").alias(name), F.lit(0).cast("bigint").alias(other))
        )

    per_pr = (
        side(reviews, "reviews", "comments")
        .unionByName(side(review_comments, "comments", "reviews"))
        .groupBy("repo_name", "pr_number")
        .agg(F.sum("reviews").alias("reviews"), F.sum("comments").alias("comments"))
    )
    return (
        per_pr.groupBy("repo_name")
        .agg(
            F.count("*").alias("reviewed_prs"),
            F.sum("reviews").alias("review_count"),
            F.sum("comments").alias("review_comment_count"),
        )
        .withColumns(
            {
                "reviews_per_pr": c.ratio(F.col("review_count"), F.col("reviewed_prs")),
                "comments_per_pr": c.ratio(F.col("review_comment_count"), F.col("reviewed_prs")),
            }
        )
    )
