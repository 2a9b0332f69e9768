"""Exact rolling distinct counts without a range join.

An entity seen on day d counts for the windows ending on d, d+1, ..., d+n-1,
or until it is seen again, whichever comes first. So each sighting adds +1 on d
and takes it back on min(d+n, next sighting). The intervals of one entity never
overlap, hence the running sum of these steps is the distinct count. Work grows
with the number of sightings, not with sightings times window length, and the
only ordered scan left runs over one row per date.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _next_sighting(flag: str, entity: Sequence[str], day: str) -> Column:
    keys = ", ".join(f"`{name}`" for name in entity)
    return F.expr(
        f"lead(CASE WHEN `{flag}` THEN `{day}` END) IGNORE NULLS "
        f"OVER (PARTITION BY {keys} ORDER BY `{day}`)"
    )


def rolling_distinct(
    sightings: DataFrame,
    *,
    group: Sequence[str],
    entity: str,
    day: str,
    flags: Mapping[str, str],
    windows: Mapping[str, int],
    return_gap: int | None = None,
) -> DataFrame:
    """Distinct entities per (group, day) and trailing window.

    `sightings` has one row per (group, entity, day); `flags` maps a suffix to a
    boolean column. Output, for every day present in the group: `dau_<suffix>`
    and `<window>_<suffix>` counts, plus `new_count`, `kept_count` (also seen the
    day before) and `returning_count` (seen again after `return_gap` days or
    more), these over all sightings whatever their flags. Rows with a NULL entity keep their day in the output, count nowhere.

    All rows of one (group, entity) are needed together, one per day: bounded by
    the calendar even for the busiest key.
    """
    keys = [*group, entity]
    seen = F.col(entity).isNotNull()
    by_entity = Window.partitionBy(*keys).orderBy(day)
    previous = F.lag(day).over(by_entity)
    rows = sightings.select(
        *keys,
        day,
        *[(F.col(column) & seen).alias(f"_in_{suffix}") for suffix, column in flags.items()],
    )
    rows = rows.withColumns(
        {f"_next_{suffix}": _next_sighting(f"_in_{suffix}", keys, day) for suffix in flags}
        | {"_previous": previous}
    )

    names = [f"{window}_{suffix}" for window in windows for suffix in flags]
    seen_sql, gap = f"`{entity}` IS NOT NULL", f"datediff(`{day}`, _previous)"
    first_day = {f"dau_{suffix}": f"cast(_in_{suffix} AS int)" for suffix in flags}
    first_day["new_count"] = f"int({seen_sql} AND _previous IS NULL)"
    first_day["kept_count"] = f"coalesce(int({seen_sql} AND {gap} = 1), 0)"
    if return_gap is not None:
        first_day["returning_count"] = f"coalesce(int({seen_sql} AND {gap} >= {return_gap}), 0)"

    def step(at: str, values: Mapping[str, str]) -> str:
        fields = [f"'at', {at}"]
        fields += [f"'{name}', {values.get(name, '0')}" for name in ("_spine", *first_day, *names)]
        return f"named_struct({', '.join(fields)})"

    opening = {"_spine": "1"} | first_day
    steps = []
    for suffix in flags:
        for window, length in windows.items():
            name = f"{window}_{suffix}"
            opening[name] = f"cast(_in_{suffix} AS int)"
            end = f"least(date_add(`{day}`, {length}), _next_{suffix})"
            steps.append(f"CASE WHEN _in_{suffix} THEN {step(end, {name: '-1'})} END")
    steps.insert(0, step(f"`{day}`", opening))
    exploded = (
        rows.selectExpr(*[f"`{name}`" for name in group], f"explode(array({', '.join(steps)})) AS _s")
        .where("_s IS NOT NULL")
        .select(*group, "_s.*")
    )

    per_day = exploded.groupBy(*group, "at").agg(
        F.max("_spine").alias("_spine"),
        *[F.sum(name).alias(name) for name in [*first_day, *names]],
    )
    order = Window.partitionBy(*group) if group else Window.partitionBy(F.lit(0))
    running = order.orderBy("at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        per_day.withColumns({name: F.sum(name).over(running) for name in names})
        .where(F.col("_spine") == 1)
        .select(
            *group,
            F.col("at").alias(day),
            *[F.col(name).cast("bigint").alias(name) for name in [*first_day, *names]],
        )
    )
