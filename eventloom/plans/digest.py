"""Weekly digests per person and per repo."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions import fixed
from ..functions.columns import phrase
from ..operators.blocks import tsv_blocks
from ..sources.tables import Tables, report_table_name

ACTOR_KEYS = ["week_start", "week_end", "actor_login"]
REPO_KEYS = ["week_start", "week_end", "organization", "repo_name"]

DEVELOPMENT_TYPES = (
    "PushEvent",
    "PullRequestEvent",
    "PullRequestReviewEvent",
    "PullRequestReviewCommentEvent",
    "IssuesEvent",
    "IssueCommentEvent",
)
MANAGEMENT_TYPES = ("CreateEvent", "DeleteEvent", "MemberEvent")
COMMUNITY_TYPES = ("WatchEvent", "ForkEvent")

ACTOR_PROMPT = """\
Summarise one person's week ({week_start} to {week_end}) from the tab-separated activity rows below.
Answer with one JSON object only, with the fields week_start, actor_login, organization_set (list),
top_repos (list of repo_name and events), summary (2 to 4 sentences), highlights (1 to 3 items) and
suggestions (0 to 2 items). Write in Korean.

{tsv}"""

REPO_PROMPT = """\
Summarise one repository's week ({week_start} to {week_end}) from the tab-separated activity rows below.
Answer with one JSON object only, with the fields week_start, organization, repo_name,
contributors_top (at most 3, each actor_login and notable_activity), summary (2 to 4 sentences),
highlights_dev, highlights_manage, community_signals and risks_or_followups (lists).
Keep development apart from management events. Write in Korean.

{tsv}"""


def week_of(day: date | str | None = None) -> tuple[date, date]:
    """Monday and Sunday of the week of the given day, default today."""
    given = date.today() if day is None else date.fromisoformat(str(day))
    monday = given - timedelta(days=given.weekday())
    return monday, monday + timedelta(days=6)


def weekly_extract(
    feed: DataFrame,
    week: date | str | None = None,
    excluded: str = fixed.DIGEST_EXCLUDED_ORGANIZATION,
) -> DataFrame:
    """One week of the feed without the excluded organization (nor a NULL one)."""
    monday, sunday = week_of(week)
    return feed.where(
        F.col("base_date").between(F.lit(monday), F.lit(sunday))
        & (F.col("organization") != excluded)
    ).select(
        F.lit(monday).alias("week_start"),
        "base_date",
        "organization",
        "repo_name",
        "actor_login",
        "source_event_type",
        "activity_text",
        F.lit(sunday).alias("week_end"),
    )


def groups(extract: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The groups to report on, with their row counts."""
    return extract.dropna(subset=list(keys)).groupBy(*keys).agg(F.count("*").alias("row_count"))


def digest_blocks(
    extract: DataFrame, keys: Sequence[str], page_rows: int = 20_000, escape: bool = False
) -> DataFrame:
    """Activity rows of each group as tab-separated text, in pages of so many rows."""
    return tsv_blocks(
        extract,
        keys=keys,
        columns=fixed.DIGEST_COLUMNS,
        sort=("base_date", "organization", "repo_name", "actor_login"),
        page_rows=page_rows,
        escape=escape,
    )


def digest_prompts(blocks: DataFrame, template: str) -> DataFrame:
    """Fill a prompt with week and text of each block; nothing is sent anywhere."""
    prompt = phrase(
        template,
        week_start="cast(week_start AS string)",
        week_end="cast(week_end AS string)",
        tsv="tsv",
    )
    return blocks.withColumn("prompt", F.expr(prompt)).drop("tsv")


def single_group(extract: DataFrame, **key: str) -> DataFrame:
    """The rows of one actor or repo; an error if there are none."""
    rows = extract
    for name, value in key.items():
        rows = rows.where(F.col(name) == value)
    if rows.isEmpty():
        raise ValueError(f"no rows for {key}")
    return rows


def weekly_actor_digest(extract: DataFrame, top_n: int | None = None) -> DataFrame:
    """Organizations and repos of each person, most active first, with event types.

    With `top_n` only so many repos are listed.
    """
    key = ["week_start", "actor_login"]
    counted = (
        extract.where(F.col("actor_login").isNotNull())
        .groupBy(*key, "organization", "repo_name", "source_event_type")
        .agg(F.count("*").alias("n"))
    )
    per_repo = counted.groupBy(*key, "repo_name").agg(
        F.sum("n").alias("n"), F.sort_array(F.collect_set("source_event_type")).alias("events")
    )
    # events without a repo rank last and are left out after ranking, not before:
    # so both branches read the one shuffle of `counted`
    no_repo = F.col("repo_name").isNull()
    order = Window.partitionBy(*key).orderBy(no_repo, F.desc("n"), "repo_name")
    listed = ~no_repo if top_n is None else (F.col("rank") <= top_n) & ~no_repo
    top = (
        per_repo.withColumn("rank", F.row_number().over(order))
        .where(listed)
        .groupBy(*key)
        .agg(F.array_sort(F.collect_list(F.struct("rank", "repo_name", "events"))).alias("_top"))
        .select(
            *key,
            F.transform(
                "_top",
                lambda t: F.struct(t["repo_name"].alias("repo_name"), t["events"].alias("events")),
            ).alias("top_repos"),
        )
    )
    orgs = counted.groupBy(*key).agg(
        F.sort_array(F.collect_set("organization")).alias("organization_set"),
        F.sum("n").alias("event_count"),
    )
    return orgs.join(top.hint("merge"), key, "left")


def weekly_repo_digest(extract: DataFrame, top_n: int = 3) -> DataFrame:
    """Top contributors of each repo and its development, management, community events."""
    key = ["week_start", "organization", "repo_name"]
    kinds = {
        "dev_events": DEVELOPMENT_TYPES,
        "manage_events": MANAGEMENT_TYPES,
        "community_events": COMMUNITY_TYPES,
    }
    per_type = (
        extract.dropna(subset=["organization", "repo_name"])
        .groupBy(*key, "actor_login", "source_event_type")
        .agg(F.count("*").alias("n"))
    )
    # both branches read all columns of `per_type`, so they share its exchange
    per_actor = per_type.groupBy(*key, "actor_login").agg(
        F.sum("n").alias("n"),
        F.min(F.struct((-F.col("n")).alias("m"), F.col("source_event_type").alias("t"))).alias("best"),
    )
    by_kind = per_type.groupBy(*key).agg(
        *[
            F.sum(F.when(F.col("source_event_type").isin(*types), F.col("n")).otherwise(0)).alias(name)
            for name, types in kinds.items()
        ]
    )
    # nobody ranks last and is left out after ranking, so both branches share a shuffle
    nobody = F.col("actor_login").isNull()
    order = Window.partitionBy(*key).orderBy(nobody, F.desc("n"), "actor_login")
    top = (
        per_actor.withColumn("rank", F.row_number().over(order))
        .where((F.col("rank") <= top_n) & ~nobody)
        .groupBy(*key)
        .agg(
            F.array_sort(
                F.collect_list(
                    F.struct("rank", "actor_login", F.col("best.t").alias("notable_activity"))
                )
            ).alias("_top")
        )
        .select(
            *key,
            F.transform(
                "_top",
                lambda t: F.struct(
                    t["actor_login"].alias("actor_login"),
                    t["notable_activity"].alias("notable_activity"),
                ),
            ).alias("contributors_top"),
        )
    )
    return by_kind.join(top.hint("merge"), key, "left")


# --- reports that come back as text ------------------------------------------


def report_text(text: Column) -> Column:
    """The JSON part of an answer, NULL if there is none.

    First the fenced part that is a bare object; else everything from the first
    opening to the last closing brace.
    """
    parts = F.transform(
        F.split(text, "```"), lambda part: F.regexp_replace(part, r"^\s+|\s+$", "")
    )
    objects = F.filter(parts, lambda part: part.startswith("{") & part.endswith("}"))
    fenced = F.when(text.contains("```"), F.get(objects, F.lit(0)))
    loose = F.regexp_extract(text, r"(?s)\{.*\}", 0)
    return F.coalesce(fenced, F.nullif(loose, F.lit("")))


def parse_reports(answers: DataFrame, schema: StructType, column: str = "answer") -> DataFrame:
    """Add `report` (NULL where no valid JSON object was found) and `is_rejected`."""
    found = F.col("_json")
    valid = F.try_parse_json(found).isNotNull()
    return (
        answers.withColumn("_json", report_text(F.col(column)))
        .withColumn("report", F.when(valid, F.from_json(found, schema)))
        .withColumn("is_rejected", F.col("report").isNull())
        .drop("_json")
    )


def store_reports(tables: Tables, parsed: DataFrame, mode: str = "auto", name: str | None = None) -> str:
    """Write the accepted reports; rejected ones are skipped."""
    reports = parsed.where(F.col("report").isNotNull()).select("report.*")
    target = name or report_table_name(reports)
    tables.store(target if target.startswith("dl_") else f"dl_{target}", reports, mode)
    return target
