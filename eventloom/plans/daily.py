"""Marts brought up to date after some days were loaded, without reading all history.

Every step reads the days it was given, states kept beside the marts, and the days that
depend on them; it writes the partitions that can have changed and no others. A step says
which ones that are: loading days again, late days and days with fewer rows than before
give the table a full rebuild would give.

States, all ordinary tables:

* `user_repo_days`: the fact per user, repo and day, one partition per day. Weeks and months
  are added up from the days they hold, so a day that is loaded again never counts twice.
* `org_first_seen`, `repo_first_seen`: first day of every user per organization and per repo,
  partitioned by that day.
* `active_state`: per user and repo the days of the longest window as bits, one number per
  class, and the last day; one partition for each of the last days. A day's state comes from
  the one before by a shift.
* `user_repo_months`: per user, repo and month the active days as bits, and the events.

Steps run one after the other in the order of `DAILY_MARTS`; one that is cut short is
repaired by repeating it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import schemas
from ..functions import columns as c
from ..functions import fixed
from ..sources.tables import Tables, run_day
from . import marts
from .marts import USER_REPO

FACT = "dw_activity_daily"
USER_DAYS = "user_repo_days"
ACTIVE_STATE = "active_state"
MONTHS = "user_repo_months"
KEPT_STATES = 40  # days of which the state is kept, for late days
CLASSES = ("any", "light", "medium", "heavy")

Days = Sequence[date]


# --- days and periods ---------------------------------------------------------------


def _last_of_month(day: date) -> date:
    return (day.replace(day=28) + timedelta(days=4)).replace(day=1) - timedelta(days=1)


def periods_of(days: Iterable[date]) -> set[tuple[date, str]]:
    """(start, level) of the day, week and month of each day."""
    out = set()
    for day in days:
        out |= {(day, "day"), (day - timedelta(days=day.weekday()), "week"), (day.replace(day=1), "month")}
    return out


def days_of(periods: Iterable[tuple[date, str]]) -> list[date]:
    """All days of some periods."""
    out: set[date] = set()
    for start, level in periods:
        end = {"day": start, "week": start + timedelta(days=6), "month": _last_of_month(start)}[level]
        out |= {start + timedelta(days=n) for n in range((end - start).days + 1)}
    return sorted(out)


def _dates(days: Iterable[date | str]) -> list[date]:
    return sorted({run_day(day) for day in days})


def _user_days(tables: Tables, days: Iterable[date] | None = None) -> DataFrame:
    """Stored user days of the given days; the state holds every day the fact has."""
    schema = tables.schema(USER_DAYS)
    if schema is None:
        raise LookupError(f"{USER_DAYS} is not built yet: run load_user_days first")
    return tables.read(USER_DAYS, schema, days)


def load_user_days(tables: Tables, days: Iterable[date | str]) -> None:
    """Take some days over from the fact; all of them on the first run."""
    wanted = _dates(days)
    if not tables.exists(USER_DAYS):
        fact = tables.read(FACT, schemas.ACTIVITY_DAILY)
        tables.rebuild(USER_DAYS, marts.user_repo_days(fact, marts.parts_for(fact)), ["base_date"])
    else:
        fact = tables.read(FACT, schemas.ACTIVITY_DAILY, wanted)
        tables.replace_days(USER_DAYS, marts.user_repo_days(fact, marts.parts_for(fact)), wanted)


def _rebuilt(tables: Tables, name: str) -> None:
    """A mart whose state is new: what days have done to it before is not known."""
    from . import build

    build.rebuild_whole(tables, [name])


# --- who was seen first when --------------------------------------------------------


def _same(one: Sequence[str], prefix: str) -> Column:
    out = F.lit(True)
    for name in one:
        out = out & (F.col(name) == F.col(f"{prefix}{name}"))
    return out


def _prefixed(df: DataFrame, names: Sequence[str], prefix: str) -> DataFrame:
    return df.select(*[F.col(n).alias(f"{prefix}{n}") if n in names else F.col(n) for n in df.columns])


def load_first_seen(tables: Tables, name: str, keys: Sequence[str], days: Iterable[date | str]) -> set[date]:
    """Merge some days into a table of first days; gives every first day that has gained or lost somebody.

    Somebody seen earlier than known moves to the earlier day. Somebody whose first day was
    loaded again without them is looked up in the days after it, only those people.
    """
    wanted = _dates(days)
    if not tables.exists(name):
        every = _user_days(tables).dropna(subset=keys)
        tables.rebuild(name, every.groupBy(*keys).agg(F.min("base_date").alias("first_day")), ["first_day"])
        return {date.fromisoformat(day) for day in tables.days(name, "first_day")}
    known = tables.read(name)
    seen = _user_days(tables, wanted).dropna(subset=keys).groupBy(*keys).agg(F.min("base_date").alias("day"))
    before = _prefixed(known, keys, "_").withColumnRenamed("first_day", "old")
    earlier = seen.join(before, _same(keys, "_"), "left").where("old is null or day < old")
    earlier = earlier.select(*keys, "old", F.col("day").alias("new"))
    # whose first day is one of these days, but who is not in it any more
    gone = known.where(F.col("first_day").isin(wanted))
    here = _prefixed(_user_days(tables, wanted).select(*keys, "base_date").distinct(), keys, "_")
    gone = gone.join(here, _same(keys, "_") & (F.col("first_day") == F.col("base_date")), "left_anti")
    gone = gone.select(*keys, F.col("first_day").alias("old"))
    later = _prefixed(_user_days(tables).where(F.col("base_date") > min(wanted)).select(*keys, "base_date"), keys, "_")
    found = gone.join(later, _same(keys, "_"), "left").groupBy(*keys, "old").agg(F.min("base_date").alias("new"))
    # a move to an earlier one of the given days is in both
    moved = earlier.unionByName(found).groupBy(*keys).agg(F.max("old").alias("old"), F.min("new").alias("new"))
    moved = tables.kept(f"{name}_moved", moved)
    touched = {row[0] for side in ("old", "new") for row in moved.select(side).distinct().collect()} - {None}
    if touched:
        stay = tables.read(name, days=touched, day_column="first_day")
        stay = stay.join(_prefixed(moved.select(*keys), keys, "_"), _same(keys, "_"), "left_anti")
        come = moved.where("new is not null").select(*keys, F.col("new").alias("first_day"))
        rows = tables.kept(f"{name}_next", stay.unionByName(come))
        tables.replace_parts(name, rows, ["first_day"], [(day,) for day in touched])
    return touched


# --- day, week and month marts ------------------------------------------------------


def _refresh_periods(
    tables: Tables, name: str, make: Callable[[DataFrame, int], DataFrame], keys: Sequence[str], days: Iterable[date | str]
) -> None:
    """Add up the periods of some days from the user days, or all periods of a mart that is new."""
    touched = periods_of(_dates(days))
    known = tables.exists(name)
    rows = _user_days(tables, days_of(touched) if known else None)
    made = make(rows, marts.parts_for(rows))
    if known:
        tables.replace_parts(name, made, keys, touched)
    else:
        tables.rebuild(name, made, keys)


def refresh_user_activity(tables: Tables, days: Iterable[date | str]) -> None:
    _refresh_periods(tables, "dm_user_activity", marts.user_activity_of, ("activity_date", "aggregation_level"), days)


def refresh_repo_contributors(tables: Tables, days: Iterable[date | str]) -> None:
    """Ranks are within a period, so touched periods are ranked again and others stay."""
    keys = ("period_start_date", "aggregation_level")
    _refresh_periods(tables, "dm_repo_contributors", marts.repo_contributors_of, keys, days)


def refresh_org_overview(tables: Tables, days: Iterable[date | str]) -> None:
    """Newcomers come from the table of first days; periods that lose or gain one are written too."""
    keys = ["organization", "user_login"]
    if not tables.exists("org_first_seen"):
        load_first_seen(tables, "org_first_seen", keys, days)
        return _rebuilt(tables, "dm_org_overview")
    moved = load_first_seen(tables, "org_first_seen", keys, days)
    touched = periods_of({*_dates(days), *moved})
    span = days_of(touched)
    first = tables.read("org_first_seen", days=span, day_column="first_day")
    rows = marts.dm_org_overview(tables.read(FACT, schemas.ACTIVITY_DAILY, span), first)
    tables.replace_parts("dm_org_overview", rows, ("activity_date", "aggregation_level"), touched)


# --- active users -------------------------------------------------------------------


def _one_shifted(places: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), places)


def _advanced(state: DataFrame | None, since: date | None, rows: DataFrame, day: date, mask: int) -> DataFrame:
    """State at the end of a day from the one at the end of `since` and the user days after it: one grouping."""
    names = [f"bits_{name}" for name in CLASSES]
    age = F.datediff(F.lit(day), F.col("base_date"))
    inside = age < mask.bit_length()
    flags = [F.when(F.col(f"is_{name}") & inside, _one_shifted(age)).otherwise(0).alias(f"bits_{name}") for name in CLASSES]
    both = rows.select(*USER_REPO, *flags, F.col("base_date").alias("seen"))
    if state is not None:
        gap = (day - since).days
        # beyond 63 places a shift would begin anew
        shifted = [F.shiftleft(n, gap).bitwiseAND(F.lit(mask)) if gap < 63 else F.lit(0).cast("bigint") for n in names]
        old = [column.alias(n) for column, n in zip(shifted, names, strict=True)]
        both = both.unionByName(state.select(*USER_REPO, *old, F.col("last_day").alias("seen")))
    return both.groupBy(*USER_REPO).agg(
        *[F.bit_or(n).alias(n) for n in names],
        F.max("seen").alias("last_day"),
        F.max(F.when(F.col("seen") < F.lit(day), F.col("seen"))).alias("prev_day"),
    )


def _active_rows(state: DataFrame, day: date, windows: dict[str, int], return_gap: int) -> DataFrame:
    """The mart's rows of one day: bits are counted, nothing older is read."""
    here, named = F.col("last_day") == F.lit(day), F.col("user_login").isNotNull()
    counts = {}
    for prefix, length in {"dau": 1, **windows}.items():
        for name in CLASSES:
            hit = F.col(f"bits_{name}").bitwiseAND(F.lit((1 << length) - 1)) != 0
            counts[f"{prefix}_{name}"] = F.count_if(hit & named)
    away = F.datediff(F.lit(day), F.col("prev_day"))
    counts["new_users_count"] = F.count_if(here & named & F.col("prev_day").isNull())
    counts["returning_users_count"] = F.count_if(here & named & (away >= return_gap))
    rows = state.groupBy("organization", "repo_name").agg(
        F.bool_or(here).alias("_present"), *[column.alias(name) for name, column in counts.items()]
    )
    rows = rows.where("_present").withColumn("base_date", F.lit(day))
    widest = list(windows)[-1]
    rows = rows.withColumn("stickiness_ratio", c.ratio(F.col("dau_any"), F.col(f"{widest}_any")))
    return rows.select(*schemas.ACTIVE_USERS_DAILY.names)


def refresh_active_users(
    tables: Tables,
    days: Iterable[date | str],
    windows: dict[str, int] | None = None,
    return_gap: int = fixed.RETURN_GAP_DAYS,
) -> None:
    """Carry the state on by the given days, and count.

    The newest day alone is counted from its bits. If days lie before the newest one, all
    days from the first of them on are counted in one job, from the days of one window
    before it and what the state knows of older ones.
    """
    windows = windows or fixed.ACTIVE_WINDOWS
    longest = max(windows.values())
    if longest > 62:
        raise ValueError("a window of more than 62 days does not fit into a number")
    mask = (1 << longest) - 1
    wanted, filled = _dates(days), _dates(tables.days(USER_DAYS))
    first_run = not tables.exists(ACTIVE_STATE)
    held = [] if first_run else _dates(tables.days(ACTIVE_STATE, "state_day"))
    first, last = wanted[0], max([*wanted, *held, *(filled if first_run else [])])
    since = max([day for day in held if day < first], default=None)
    after = [day for day in filled if day <= last and (since is None or day > since)]
    before = tables.read(ACTIVE_STATE, days=[since], day_column="state_day") if since else None
    if after:
        rows = marts.in_active_scope(_user_days(tables, after))
        state = _advanced(before, since, rows, after[-1], mask).withColumn("state_day", F.lit(after[-1]))
        tables.overwrite_parts(ACTIVE_STATE, state, ["state_day"])
    stale = [day for day in held if day >= first and day not in after[-1:]]
    tables.drop_parts(ACTIVE_STATE, [f"state_day={day}" for day in [*stale, *held[:-KEPT_STATES]]])
    if first_run:
        return _rebuilt(tables, "dm_active_users_daily")
    span = [first + timedelta(days=n) for n in range((last - first).days + 1)]
    if first == last and after[-1:] == [first]:
        now = tables.read(ACTIVE_STATE, days=[first], day_column="state_day")
        counted = _active_rows(now, first, windows, return_gap)
    else:
        start = first - timedelta(days=longest - 1)
        if since is not None:
            start = min(start, since + timedelta(days=1))
        read = [day for day in filled if day <= last and (since is None or day >= start)]
        rows = marts.in_active_scope(_user_days(tables, read))
        rows = rows.select(*USER_REPO, "base_date", *[f"is_{name}" for name in CLASSES])
        if before is not None:  # when somebody was seen last before the days that are read
            older = before.where(F.col("last_day") < F.lit(start)).withColumnRenamed("last_day", "base_date")
            flags = [F.lit(False).alias(f"is_{name}") for name in CLASSES]
            rows = rows.unionByName(older.select(*USER_REPO, "base_date", *flags))
        counted = marts.active_users_of(rows, windows, return_gap).where(F.col("base_date") >= F.lit(first))
    tables.replace_days("dm_active_users_daily", counted, span)


# --- cohorts ------------------------------------------------------------------------


def refresh_retention(
    tables: Tables, days: Iterable[date | str], offsets: Sequence[int] = fixed.RETENTION_OFFSETS
) -> None:
    """A day touches its own cohort, those it is an offset away from, and those that lose or gain people."""
    wanted = _dates(days)
    if not tables.exists("repo_first_seen"):
        load_first_seen(tables, "repo_first_seen", USER_REPO, wanted)
        return _rebuilt(tables, "dm_user_retention")
    moved = load_first_seen(tables, "repo_first_seen", USER_REPO, wanted)
    cohorts = {day - timedelta(days=n) for day in wanted for n in (0, *offsets)} | moved
    needed = sorted({cohort + timedelta(days=n) for cohort in cohorts for n in (0, *offsets)})
    people = tables.read("repo_first_seen", days=cohorts, day_column="first_day")
    rows = _user_days(tables, needed).join(_prefixed(people, USER_REPO, "_"), _same(USER_REPO, "_"))
    rows = rows.where(F.datediff("base_date", "first_day").isin(0, *offsets)).drop("first_day", *[f"_{k}" for k in USER_REPO])
    result = marts.user_retention_of(rows, offsets)
    tables.replace_parts("dm_user_retention", result, ["cohort_date"], [(day,) for day in cohorts])


def _months_of(days: DataFrame) -> DataFrame:
    """Per user, repo and month: active days as bits, events, and the class of the first day."""
    number = F.dayofmonth("base_date") - 1
    rows = days.dropna(subset=USER_REPO).withColumn("month", F.trunc("base_date", "month").cast("date"))
    return rows.groupBy(*USER_REPO, "month").agg(
        F.bit_or(_one_shifted(number)).alias("day_bits"),
        F.sum("total_events_count").alias("events"),
        F.min_by(marts._kind(), "base_date").alias("kind"),
    )


def load_months(tables: Tables, days: Iterable[date | str]) -> set[str]:
    """Roll the touched months up again; gives the first months, before or after, of people whose row has changed."""
    touched = sorted({day.replace(day=1) for day in _dates(days)})
    if not tables.exists(MONTHS):
        tables.rebuild(MONTHS, _months_of(_user_days(tables)), ["month"])
        return {month[:7] for month in tables.days(MONTHS, "month")}
    new = _months_of(_user_days(tables, days_of((month, "month") for month in touched)))
    new = tables.kept(f"{MONTHS}_next", new)
    old = tables.read(MONTHS, days=touched, day_column="month").select(*new.columns)
    # a row that is in one of the two only belongs to somebody who has changed
    rows = old.withColumn("_side", F.lit(1)).unionByName(new.withColumn("_side", F.lit(2)))
    single = rows.groupBy(*new.columns).agg(F.count("*").alias("_sides")).where("_sides = 1")
    changed = tables.kept(f"{MONTHS}_changed", single.select(*USER_REPO).distinct())
    changed = _prefixed(changed, USER_REPO, "_")

    def cohorts() -> set[str]:
        return _cohorts(tables.read(MONTHS).join(changed, _same(USER_REPO, "_"), "left_semi"))

    before = cohorts()
    tables.replace_parts(MONTHS, new, ["month"], [(month,) for month in touched])
    return before | cohorts()


def _cohorts(months: DataFrame) -> set[str]:
    """First months of some people, given all their months."""
    first = months.groupBy(*USER_REPO).agg(F.min("month").alias("month"))
    return {row[0] for row in first.select(F.date_format("month", "yyyy-MM")).distinct().collect()}


def _people(months: DataFrame, offsets: Sequence[int]) -> DataFrame:
    """One row per user and repo from all its months.

    The first day stands beside every month, so each month tells by itself which of the
    days looked for it has; rows are of fixed size and nothing is collected per person.
    """
    lowest = F.expr("date_add(month, bit_count((day_bits & -day_bits) - 1))")
    highest = F.expr("date_add(month, length(bin(day_bits)) - 1)")
    first_day = F.min(lowest).over(Window.partitionBy(*USER_REPO))

    def back(offset: int) -> Column:
        day = F.date_add("first_day", offset)
        bit = _one_shifted(F.dayofmonth(day) - 1)
        here = (F.col("month") == F.trunc(day, "month").cast("date")) & (F.col("day_bits").bitwiseAND(bit) != 0)
        return F.bool_or(here).alias(f"back_{offset}")

    people = (
        months.withColumn("first_day", first_day)
        .groupBy(*USER_REPO)
        .agg(
            F.min("first_day").alias("first_day"),
            F.max(highest).alias("last_day"),
            F.min_by("kind", "month").alias("kind"),
            F.sum(F.bit_count("day_bits")).alias("active_days"),
            F.sum("events").alias("events"),
            *[back(offset) for offset in offsets],
        )
    )
    return people.select(
        "*",
        F.date_format("first_day", "yyyy-MM").alias("cohort_month"),
        F.datediff("last_day", "first_day").alias("lifetime_days"),
    )


def refresh_cohort_summary(tables: Tables, days: Iterable[date | str]) -> None:
    """Months of the first day, before or after, of everybody whose days have changed."""
    if not tables.exists(MONTHS):
        load_months(tables, days)
        return _rebuilt(tables, "dm_user_cohort_summary")
    touched = load_months(tables, days)
    summary = marts.cohort_summary_of(_people(tables.read(MONTHS), fixed.RETENTION_OFFSETS))
    tables.replace_parts("dm_user_cohort_summary", summary, ["cohort_month"], [(month,) for month in touched])


# --- all of them --------------------------------------------------------------------

DAILY_MARTS: dict[str, Callable[[Tables, Iterable[date | str]], None]] = {
    "dm_active_users_daily": refresh_active_users,
    "dm_org_overview": refresh_org_overview,
    "dm_user_activity": refresh_user_activity,
    "dm_repo_contributors": refresh_repo_contributors,
    "dm_user_retention": refresh_retention,
    "dm_user_cohort_summary": refresh_cohort_summary,
}


# The state of each mart that has one: a step that finds none builds it and the mart, whole.
_STATES = {
    "dm_active_users_daily": ACTIVE_STATE,
    "dm_org_overview": "org_first_seen",
    "dm_user_retention": "repo_first_seen",
    "dm_user_cohort_summary": MONTHS,
}


def refresh_marts(tables: Tables, days: Iterable[date | str], names: Sequence[str] | None = None) -> None:
    """Bring the marts up to date after these days of the fact were loaded.

    A mart that does not exist yet is built from the whole fact, once, and so are its states.
    """
    days = _dates(days)
    load_user_days(tables, days)
    for name, refresh in DAILY_MARTS.items():
        if names is None or name in names:
            state = _STATES.get(name)
            if state is not None and not tables.exists(name) and tables.exists(state):
                _rebuilt(tables, name)
            refresh(tables, days)
