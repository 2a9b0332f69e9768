"""Building stored tables: one day, a range of days, or from scratch."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

from .. import schemas
from ..sources.archive import EVENT_PARTITIONS
from ..sources.tables import Tables, day_range, run_day
from . import dims, events, facts, marts
from .event_fields import EVENT_SHAPES, EventShape
from .feed import feed_from_tables

EVENTS = "gh_archive_filtered"
# periods are replaced one by one, so the level is a partition too
PERIOD_KEYS = ("activity_date", "aggregation_level")
CONTRIBUTOR_KEYS = ("period_start_date", "aggregation_level")
Days = Sequence[date] | None


@dataclass(frozen=True)
class DailyTable:
    """A table partitioned by base_date whose days are replaced on every run."""

    name: str
    build: Callable[[Tables, Days], DataFrame]


@dataclass(frozen=True)
class WholeTable:
    """A table recomputed in full, since its rows depend on all days."""

    name: str
    build: Callable[[Tables], DataFrame]
    partition_by: tuple[str, ...] = ()


def _events(tables: Tables, days: Days = None) -> DataFrame:
    return tables.read(EVENTS, schemas.FILTERED_EVENT, days, "dt_kst")


def _fact(tables: Tables) -> DataFrame:
    return tables.read("dw_activity_daily", schemas.ACTIVITY_DAILY)


def _read_typed(tables: Tables, name: str, days: Days = None) -> DataFrame:
    return tables.read(name, events.typed_schema(EVENT_SHAPES[name]), days)


def _typed(shape: EventShape) -> Callable[[Tables, Days], DataFrame]:
    return lambda tables, days: events.typed_events(_events(tables, days), shape, days)


DAILY: list[DailyTable] = [
    DailyTable("stg_gh_events", lambda t, d: events.stg_gh_events(_events(t, d), d)),
    *[DailyTable(name, _typed(shape)) for name, shape in EVENT_SHAPES.items()],
    DailyTable(
        "dw_activity_daily",
        lambda t, d: facts.dw_activity_daily(t.read("stg_gh_events", schemas.STG_EVENTS, d), d),
    ),
    DailyTable("dw_watch_daily", lambda t, d: facts.dw_watch_daily(_read_typed(t, "dl_watch_events", d), d)),
    DailyTable(
        "dw_activity_feed",
        lambda t, d: feed_from_tables({name: _read_typed(t, name, d) for name in EVENT_SHAPES}, d),
    ),
    DailyTable(
        "dm_watch_summary",
        lambda t, d: facts.dm_watch_summary(t.read("dw_watch_daily", schemas.WATCH_DAILY, d), d),
    ),
]

WHOLE: list[WholeTable] = [
    WholeTable("dim_event_type", lambda t: dims.dim_event_type(_fact(t))),
    WholeTable("dim_organization", lambda t: dims.dim_organization(_fact(t))),
    WholeTable("dim_repository", lambda t: dims.dim_repository(_fact(t))),
    WholeTable("dim_user", lambda t: dims.dim_user(_fact(t), _read_typed(t, "dl_create_events"))),
    WholeTable(
        "dm_active_users_daily", lambda t: marts.dm_active_users_daily(_fact(t)), ("base_date",)
    ),
    WholeTable("dm_org_overview", lambda t: marts.dm_org_overview(_fact(t)), PERIOD_KEYS),
    WholeTable("dm_user_activity", lambda t: marts.dm_user_activity(_fact(t)), PERIOD_KEYS),
    WholeTable(
        "dm_repo_contributors", lambda t: marts.dm_repo_contributors(_fact(t)), CONTRIBUTOR_KEYS
    ),
    WholeTable("dm_user_retention", lambda t: marts.dm_user_retention(_fact(t)), ("cohort_date",)),
    WholeTable(
        "dm_user_cohort_summary",
        lambda t: marts.dm_user_cohort_summary(_fact(t)),
        ("cohort_month",),
    ),
]

VIEWS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "dm_activity_daily_org_repo": facts.dm_activity_daily_org_repo,
    "dm_unique_users_by_org_repo": facts.dm_unique_users_by_org_repo,
}

# Name, schema and partition columns of every stored table.
DECLARED: list[tuple[str, StructType, tuple[str, ...]]] = [
    (EVENTS, schemas.FILTERED_EVENT, EVENT_PARTITIONS),
    ("stg_gh_events", schemas.STG_EVENTS, ("base_date",)),
    *[(name, events.typed_schema(shape), ("base_date",)) for name, shape in EVENT_SHAPES.items()],
    ("dw_activity_daily", schemas.ACTIVITY_DAILY, ("base_date",)),
    ("dw_watch_daily", schemas.WATCH_DAILY, ("base_date",)),
    ("dw_activity_feed", schemas.ACTIVITY_FEED, ("base_date",)),
    ("dm_watch_summary", schemas.WATCH_SUMMARY, ("base_date",)),
    ("dim_event_type", schemas.DIM_EVENT_TYPE, ()),
    ("dim_organization", schemas.DIM_ORGANIZATION, ()),
    ("dim_repository", schemas.DIM_REPOSITORY, ()),
    ("dim_user", schemas.DIM_USER, ()),
    ("dm_active_users_daily", schemas.ACTIVE_USERS_DAILY, ("base_date",)),
    ("dm_org_overview", schemas.ORG_OVERVIEW, PERIOD_KEYS),
    ("dm_user_activity", schemas.USER_ACTIVITY, PERIOD_KEYS),
    ("dm_repo_contributors", schemas.REPO_CONTRIBUTORS, CONTRIBUTOR_KEYS),
    ("dm_user_retention", schemas.USER_RETENTION, ("cohort_date",)),
    ("dm_user_cohort_summary", schemas.COHORT_SUMMARY, ("cohort_month",)),
    ("gh_user_relations", schemas.USER_RELATIONS, ("dt_kst",)),
    ("dl_actor_week", schemas.ACTOR_WEEK_REPORT, ()),
    ("dl_repo_week", schemas.REPO_WEEK_REPORT, ()),
]


def append_events(tables: Tables, filtered: DataFrame) -> None:
    """Append ingested events, with rows of one type lying together.

    A typed table then skips the row groups and pages of the other types by
    their statistics, instead of reading every payload.
    """
    tables.append(EVENTS, filtered, EVENT_PARTITIONS, sort_by=["type"])


def load_days(tables: Tables, table: DailyTable, days: Days) -> None:
    """Replace the given days of one table.

    On the first build, or with `days` None, all days of the source are built.
    """
    if days is None or not tables.exists(table.name):
        tables.rebuild(table.name, table.build(tables, None), ["base_date"])
    else:
        tables.replace_days(table.name, table.build(tables, days), days)


def load_range(
    tables: Tables,
    start: date | str | None = None,
    end: date | str | None = None,
    names: Sequence[str] | None = None,
    slice_days: int | None = None,
) -> None:
    """Load a range of days (default: yesterday) into the daily tables, in order.

    All days of a table are one job, not one job per day; `slice_days` cuts a long range
    into jobs of so many days. Each finished (table, days) is recorded. A run that was cut
    short is taken up by the same call: it loads what is not recorded, and the record goes
    once all is loaded, so that the range can be loaded again.
    """
    first = run_day(start)
    days = day_range(first, run_day(end) if end is not None else first)
    known = {table.name: table for table in DAILY}
    unknown = set(names or ()) - set(known)
    if unknown:
        raise ValueError(f"unknown tables: {sorted(unknown)}")
    wanted = [name for name in known if names is None or name in names]
    run = f"{days[0]}_{days[-1]}_{slice_days or len(days)}_{zlib.crc32(','.join(wanted).encode()):08x}"
    done = tables.done(run)
    for name in wanted:
        size = slice_days or len(days)
        for part in (days[n : n + size] for n in range(0, len(days), size)):
            step = f"{name}.{part[0]}"
            if step in done:
                continue
            load_days(tables, known[name], part)
            tables.mark_done(run, step)
    tables.end_run(run)


def rebuild_whole(tables: Tables, names: Sequence[str] | None = None) -> None:
    """Recompute the dimensions and marts, in order."""
    for table in WHOLE:
        if names is None or table.name in names:
            tables.rebuild(table.name, table.build(tables), table.partition_by)


def create_views(tables: Tables) -> None:
    for name, build in VIEWS.items():
        tables.view(name, build(_fact(tables)))


def declare_tables(tables: Tables, names: Sequence[str] | None = None) -> None:
    """Register the stored tables in the catalog with their declared schemas."""
    for name, schema, keys in DECLARED:
        if names is None or name in names:
            tables.declare(name, schema, keys)


def drop_tables(tables: Tables) -> None:
    for name, _, _ in DECLARED:
        tables.drop(name)
