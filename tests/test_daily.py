"""Marts brought up to date day by day against the same marts built anew."""

import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from eventloom import schemas
from eventloom.functions import fixed
from eventloom.plans import build, daily, marts

TYPES = ["PushEvent", "PullRequestEvent", "WatchEvent", "IssuesEvent", "GollumEvent", "ForkEvent"]
START = date(2024, 1, 25)


def facts(seed, days, rows):
    """Fact rows of some days: few people, so that they come back; NULLs in any key."""
    rng = random.Random(seed)
    made = {}
    for _ in range(rows):
        day = START + timedelta(days=rng.choice(days))
        key = (
            day, rng.choice(["Pseudo-Lab", "apache", None]), rng.choice(["superset", "core", None]),
            rng.choice(TYPES), rng.choice(["ann", "bob", "cyd", "dan", "eve", None]),
        )
        made[key] = rng.randint(1, 4)
    return [(*key, count) for key, count in made.items()]


def frame(spark, rows):
    return spark.createDataFrame(rows, schemas.ACTIVITY_DAILY)


def rows_of(df, schema):
    return sorted(map(repr, map(tuple, df.select(*schema.names).collect())))


MARTS = {
    "dm_active_users_daily": (marts.dm_active_users_daily, schemas.ACTIVE_USERS_DAILY),
    "dm_org_overview": (marts.dm_org_overview, schemas.ORG_OVERVIEW),
    "dm_user_activity": (marts.dm_user_activity, schemas.USER_ACTIVITY),
    "dm_repo_contributors": (marts.dm_repo_contributors, schemas.REPO_CONTRIBUTORS),
    "dm_user_retention": (marts.dm_user_retention, schemas.USER_RETENTION),
    "dm_user_cohort_summary": (marts.dm_user_cohort_summary, schemas.COHORT_SUMMARY),
}


def load(spark, tables, state, day, rows, name):
    """Replace a day of the fact by `rows` and bring the mart up to date."""
    state[day] = rows
    tables.replace_days(daily.FACT, frame(spark, rows), [day])
    daily.refresh_marts(tables, [day], [name])


def same_as_rebuilt(spark, tables, state, name):
    make, schema = MARTS[name]
    whole = make(frame(spark, [row for rows in state.values() for row in rows]))
    assert rows_of(tables.read(name, schema), schema) == rows_of(whole, schema)


def started(spark, tables, name, days, seed=1, rows=160):
    made = facts(seed, days, rows)
    tables.rebuild(daily.FACT, frame(spark, made), ["base_date"])
    daily.refresh_marts(tables, [START], [name])
    state = {}
    for row in made:
        state.setdefault(row[0], []).append(row)
    return state


@pytest.mark.parametrize("name", list(MARTS))
def test_new_late_changed_and_emptied_days(spark, tables, name):
    state = started(spark, tables, name, [3, 4, 8, 11, 40])
    same_as_rebuilt(spark, tables, state, name)
    steps = [
        (0, 25, 3),  # earlier than anybody was known
        (3, 12, 5),  # loaded again with fewer people: some first days move on
        (40, 0, 6),  # loaded again without a row
        (75, 20, 7),  # the newest, after a gap longer than the longest window
    ]
    for number, count, seed in steps:
        day = START + timedelta(days=number)
        load(spark, tables, state, day, facts(seed, [number], count) if count else [], name)
        same_as_rebuilt(spark, tables, state, name)


@pytest.mark.parametrize("name", ["dm_active_users_daily", "dm_user_cohort_summary"])
def test_loading_a_day_twice_changes_nothing(spark, tables, name):
    state = started(spark, tables, name, [0, 1, 7, 8])
    day = START + timedelta(days=8)
    load(spark, tables, state, day, state[day], name)
    load(spark, tables, state, day, state[day], name)
    same_as_rebuilt(spark, tables, state, name)


def written(tables, name):
    """Partition folder -> its files, by which a rewritten one is told."""
    folder = tables.data_path(name).removeprefix("file:")
    import pathlib

    out = {}
    for path in pathlib.Path(folder).rglob("*.parquet"):
        out.setdefault(str(path.parent.relative_to(folder)), set()).add(path.name)
    return out


def changed(before, after):
    return {part for part in before.keys() | after.keys() if before.get(part) != after.get(part)}


def test_only_dependent_partitions_are_written(spark, tables):
    names = list(MARTS)
    eve = START + timedelta(days=58)
    made = [*facts(1, list(range(58)), 900), (eve, "apache", "superset", "PushEvent", "zoe", 1)]
    tables.rebuild(daily.FACT, frame(spark, made), ["base_date"])
    daily.refresh_marts(tables, [START])
    before = {name: written(tables, name) for name in names}
    day = START + timedelta(days=59)  # 2024-03-24, a Sunday
    rows = [*facts(2, [59], 30), *[(day, "apache", "superset", "PushEvent", name, 1) for name in ("zoe", "new")]]
    tables.replace_days(daily.FACT, frame(spark, rows), [day])
    daily.refresh_marts(tables, [day])
    after = {name: written(tables, name) for name in names}
    diff = {name: changed(before[name], after[name]) for name in names}
    assert diff["dm_active_users_daily"] == {f"base_date={day}"}
    periods = {f"={day}/aggregation_level=day", "=2024-03-18/aggregation_level=week", "=2024-03-01/aggregation_level=month"}
    assert diff["dm_user_activity"] == {f"activity_date{p}" for p in periods}
    assert diff["dm_repo_contributors"] == {f"period_start_date{p}" for p in periods}
    assert diff["dm_org_overview"] == {f"activity_date{p}" for p in periods}
    cohorts = {day - timedelta(days=n) for n in (0, *fixed.RETENTION_OFFSETS)}
    assert {f"cohort_date={day}", f"cohort_date={eve}"} <= diff["dm_user_retention"] <= {f"cohort_date={c}" for c in cohorts}
    assert diff["dm_user_cohort_summary"] <= {"cohort_month=2024-01", "cohort_month=2024-02", "cohort_month=2024-03"}


def test_a_step_reads_only_days_it_depends_on(spark, tables):
    made = facts(1, list(range(60)), 600)
    tables.rebuild(daily.FACT, frame(spark, made), ["base_date"])
    daily.refresh_marts(tables, [START], ["dm_user_activity"])
    span = daily.days_of(daily.periods_of([START + timedelta(days=59)]))
    files = daily._user_days(tables, span).inputFiles()
    assert 0 < len({f.split("base_date=")[1][:10] for f in files}) <= 31


def test_first_days_move_both_ways(spark, tables):
    keys = ["organization", "user_login"]
    rows = [(START + timedelta(days=n), "o", "r", "PushEvent", user, 1) for n, user in [(5, "a"), (9, "a"), (5, "b")]]
    tables.rebuild(daily.FACT, frame(spark, rows), ["base_date"])
    daily.load_user_days(tables, [START])
    daily.load_first_seen(tables, "seen", keys, [START])

    def step(number, users):
        day = START + timedelta(days=number)
        tables.replace_days(daily.FACT, frame(spark, [(day, "o", "r", "PushEvent", u, 1) for u in users]), [day])
        daily.load_user_days(tables, [day])
        touched = daily.load_first_seen(tables, "seen", keys, [day])
        firsts = {r.user_login: (r.first_day - START).days for r in tables.read("seen").collect()}
        return firsts, sorted((t - START).days for t in touched)

    assert step(2, ["b", "c"]) == ({"a": 5, "b": 2, "c": 2}, [2, 5])
    assert step(5, []) == ({"a": 9, "b": 2, "c": 2}, [5, 9])
    assert step(2, []) == ({"a": 9}, [2])
    assert step(9, ["a"]) == ({"a": 9}, [])


def test_windows_that_bits_cannot_hold_are_refused(spark, tables):
    with pytest.raises(ValueError, match="62 days"):
        daily.refresh_active_users(tables, [START], {"quarter": 90})


def test_a_missing_state_builds_the_whole_mart(spark, tables):
    made = facts(3, [0, 1, 2], 80)
    tables.rebuild(daily.FACT, frame(spark, made), ["base_date"])
    build.rebuild_whole(tables, ["dm_org_overview"])
    more = facts(4, [-3], 30)
    tables.replace_days(daily.FACT, frame(spark, more), [START - timedelta(days=3)])
    daily.refresh_marts(tables, [START - timedelta(days=3)], ["dm_org_overview"])
    same_as_rebuilt(spark, tables, {0: made, 1: more}, "dm_org_overview")
    assert tables.read("org_first_seen").where(F.col("first_day") == F.lit(START - timedelta(days=3))).count() > 0


@pytest.mark.parametrize("name", list(MARTS))
def test_a_new_mart_is_built_once(spark, tables, name, monkeypatch):
    built, rebuild = [], tables.rebuild
    monkeypatch.setattr(tables, "rebuild", lambda table, *rest: (built.append(table), rebuild(table, *rest)))
    state = started(spark, tables, name, [3, 4, 8])
    assert built.count(name) == 1
    same_as_rebuilt(spark, tables, state, name)
    state_table = daily._STATES.get(name)
    if state_table:  # a mart lost beside its state is built, and the state brought up to date
        assert tables.exists(state_table)
        tables._delete(f"{tables.root}/_versions/{name}")
        load(spark, tables, state, START, facts(9, [0], 12), name)
        same_as_rebuilt(spark, tables, state, name)


def test_cohorts_keep_no_row_per_person_for_comparison(spark, tables, monkeypatch):
    name = "dm_user_cohort_summary"
    state = started(spark, tables, name, [3, 4, 8, 40])
    kept, keep = [], tables.kept
    monkeypatch.setattr(tables, "kept", lambda table, df: (kept.append(table), keep(table, df))[1])
    load(spark, tables, state, START, facts(4, [0], 20), name)  # people's first month moves back
    assert sorted(kept) == [f"{daily.MONTHS}_changed", f"{daily.MONTHS}_next"]
    assert tables.read(f"_{daily.MONTHS}_changed").count() <= len({row[1:3] + row[4:5] for row in state[START]})
    same_as_rebuilt(spark, tables, state, name)


@pytest.mark.parametrize("name", ["dm_user_activity", "dm_repo_contributors"])
def test_partitions_grow_with_the_rows_of_the_days(spark, tables, name, monkeypatch):
    """User days and periods are dealt by their number, in the first build and in a day's step."""
    dealt, spread = [], marts._spread
    monkeypatch.setattr(marts, "ROWS_IN_PART", 4)
    monkeypatch.setattr(marts, "_spread", lambda df, keys, parts=None: (dealt.append((df.count(), parts)), spread(df, keys, parts))[1])
    state = started(spark, tables, name, [3, 4, 8])
    load(spark, tables, state, START, facts(9, [0], 60), name)
    fewest = spark.sparkContext.defaultParallelism
    assert len(dealt) == 4 and max(rows for rows, _ in dealt) > 4 * fewest
    for rows, parts in dealt:
        assert parts is not None and parts >= max(fewest, -(-rows // 4))
    same_as_rebuilt(spark, tables, state, name)
