"""Hourly files loaded hour by hour in one job: a broken hour is left out and reported.

All hours are read together and staged with the name of their file. Only if that job
stops at a file it cannot read are the files probed one by one, and the load goes on
with the others; so a day without fault is read once. Nothing of a broken hour is kept,
not even the lines before the break. The event table is appended to from the stage, and
an hour counts as loaded once that is done; loading the days again takes only the hours
that are not, such as one that has been fetched anew.
"""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from datetime import date

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from . import archive
from .tables import Tables, day_range

HOURS = "ingest_hours"
PROBES = 8  # files probed at a time
STATUS = schemas.flat("utc_day date, hour int, status string, event_count bigint")

LOADED, BLANK, MISSING, BROKEN = "loaded", "blank", "missing", "broken"


class NothingLoaded(RuntimeError):
    """No hour gave any event."""


_JOB_ERRORS = (PySparkException, Py4JJavaError)


def unreadable(error: Exception) -> bool:
    """Whether a job stopped at a file that it could not read."""
    if isinstance(error, PySparkException):
        return (error.getCondition() or "").startswith("FAILED_READ_FILE")
    cause = error.java_exception
    while cause is not None:
        if "[FAILED_READ_FILE" in (cause.getMessage() or ""):
            return True
        cause = cause.getCause()
    return False


def _is_broken(spark: SparkSession, paths: Sequence[str]) -> bool:
    """Whether any of the files cannot be read to its end."""
    try:
        spark.read.text(list(paths)).agg(F.count("*")).collect()
    except _JOB_ERRORS as error:
        if unreadable(error):
            return True
        raise
    return False


def broken_files(spark: SparkSession, paths: Sequence[str]) -> set[str]:
    """The files that cannot be read to their end: days are probed first, then the hours of failing ones."""
    by_day: dict[str, list[str]] = {}
    for path in paths:
        by_day.setdefault(path.rpartition("/")[0], []).append(path)
    with ThreadPoolExecutor(PROBES) as pool:
        def failing(groups: list[list[str]]) -> list[list[str]]:
            found = pool.map(lambda group: _is_broken(spark, group), groups)
            return [group for group, bad in zip(groups, found, strict=True) if bad]

        hours = [[path] for day in failing(list(by_day.values())) for path in day]
        return {path for [path] in failing(hours)}


def _staged(tables: Tables, paths: Sequence[str], organizations) -> str:
    """Stage the events of some files with the name of their file; all files or none."""
    lines = archive.read_lines(tables.spark, paths).select("*", F.col("_metadata.file_name").alias("source_file"))
    events = archive.filter_events(lines, organizations, keep=["source_file"])
    tables.rebuild("_stage", events)
    return "_stage"


def load_hours(
    tables: Tables,
    root: str,
    start: date | str,
    end: date | str | None = None,
    name: str = "gh_archive_filtered",
    organizations=archive.fixed.TARGET_ORGANIZATIONS,
) -> DataFrame:
    """Load the hours of some days that are not loaded yet; gives (utc_day, hour, status, event_count).

    An hour is loaded, blank (no event of the organizations), missing or broken. Raises
    `NothingLoaded` if no hour has been loaded at all.
    """
    spark = tables.spark
    days = day_range(start, end if end is not None else start)
    before = tables.read(HOURS, STATUS, days, "utc_day")
    done = {(row.utc_day, row.hour): row for row in before.where(F.col("status") == LOADED).collect()}
    wanted = {
        path: (day, hour)
        for day in days
        for hour, path in enumerate(archive.hour_paths(root, day))
        if (day, hour) not in done
    }
    there = archive.existing_paths(spark, list(wanted))
    broken: set[str] = set()
    if there:
        try:
            _staged(tables, there, organizations)
        except _JOB_ERRORS as error:
            if not unreadable(error):
                raise
            broken = broken_files(spark, there)
            there = [path for path in there if path not in broken]
            if there:
                _staged(tables, there, organizations)
    counts: dict[str, int] = {}
    if there:
        staged = tables.read("_stage")
        counts = {row.source_file: row["count"] for row in staged.groupBy("source_file").count().collect()}
        if counts:
            tables.append(name, staged.drop("source_file"), archive.EVENT_PARTITIONS, sort_by=["type"])
    rows = [(row.utc_day, row.hour, row.status, row.event_count) for row in done.values()]
    for path, (day, hour) in wanted.items():
        count = counts.get(path.rpartition("/")[2], 0)
        found = LOADED if count else BLANK if path in there else BROKEN if path in broken else MISSING
        rows.append((day, hour, found, count))
    if not any(row[2] == LOADED for row in rows):
        raise NothingLoaded(f"no hour from {days[0]} to {days[-1]} under {root} gave any event")
    status = spark.createDataFrame(rows, STATUS)
    tables.replace_days(HOURS, status, days, "utc_day")
    return status
