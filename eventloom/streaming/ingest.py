"""Archive files as a stream, with the transformations of the batch path."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StructField, StructType

from .. import schemas
from ..functions import fixed
from ..plans.events import stg_gh_events
from ..plans.facts import dw_activity_daily
from ..sources.archive import EVENT_PARTITIONS, filter_events
from ..sources.tables import Tables

_STORED = StructType([*schemas.FILTERED_EVENT.fields, StructField("batch", LongType())])
BATCH_PARTITIONS = (*EVENT_PARTITIONS, "batch")
_PARTIAL = StructType([*schemas.ACTIVITY_DAILY.fields, StructField("batch", LongType())])
PARTIAL_PARTITIONS = ("base_date", "batch")
MOST_PARTIALS = 32  # batches of a day whose counts lie apart


def archive_stream(
    spark: SparkSession,
    folder: str,
    files_per_batch: int | None = None,
    archive_to: str | None = None,
    delete_read: bool = False,
) -> DataFrame:
    """New hourly files below a folder; each is taken once.

    Files that are done can be moved to another folder or deleted, so that later starts
    do not list them again.
    """
    reader = spark.readStream.schema(schemas.RAW_EVENT).option("recursiveFileLookup", True)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    if archive_to is not None:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive_to)
    elif delete_read:
        reader = reader.option("cleanSource", "delete")
    return reader.json(folder)


def _store_batch(
    tables: Tables, name: str, batch: DataFrame, number: int, organizations: Sequence[str] | None
) -> set[tuple]:
    """Write one batch, balanced and sorted by type; gives the partitions it wrote.

    Its rows lie in partitions of its own number below their day, so a batch that is tried
    again overwrites what it wrote.
    """
    rows = filter_events(batch, organizations).withColumn("batch", F.lit(number).cast("bigint"))
    return tables.overwrite_parts(name, rows, BATCH_PARTITIONS, sort_by=["type"])


def _live(parts: Sequence[str]) -> tuple[list[str], list[str]]:
    """Batch folders that count, and those a compacted one has taken the place of.

    Folder batch=-n holds all batches below n of its day and organization.
    """
    by_group: dict[str, list[int]] = {}
    for part in parts:
        group, _, number = part.rpartition("/batch=")
        by_group.setdefault(group, []).append(int(number))
    live, done = [], []
    for group, numbers in by_group.items():
        top = -min([0, *numbers])
        for number in numbers:
            counts = number == -top if number < 0 else number >= top
            (live if counts else done).append(f"{group}/batch={number}")
    return live, done


def read_batches(tables: Tables, name: str, days: Sequence[str] | None = None) -> DataFrame:
    """The event table a stream writes; given days, only their folders are listed."""
    if not tables.exists(name):
        return tables.read(name, _STORED)
    wanted = tables.days(name, "dt_kst") if days is None else days
    parts = [p for day in wanted for p in tables.parts(name, 3, f"dt_kst={day}")]
    live, _ = _live(parts)
    return tables.read_parts(name, live, _STORED) if live else tables.spark.createDataFrame([], _STORED)


def compact_days(tables: Tables, name: str, days: Sequence[str]) -> None:
    """Merge the batches of closed days into one folder per day and organization.

    The merged folder says by its number which batches it holds. Readers go by that, so
    a run cut short shows no row twice, and repeating it finishes the work.
    """
    parts = [p for day in days for p in tables.parts(name, 3, f"dt_kst={day}")]
    live, _ = _live(parts)
    if not live:
        return
    numbers = [int(part.rpartition("=")[2]) for part in live]
    top = max(number + 1 if number >= 0 else -number for number in numbers)
    merged = tables.read_parts(name, live, _STORED).withColumn("batch", F.lit(-top).cast("bigint"))
    tables.overwrite_parts(name, merged, BATCH_PARTITIONS, sort_by=["type"])
    tables.drop_parts(name, _live([p for day in days for p in tables.parts(name, 3, f"dt_kst={day}")])[1])


def stream_ingest(
    lines: DataFrame,
    tables: Tables,
    checkpoint: str,
    name: str = "gh_archive_by_batch",
    organizations: Sequence[str] | None = fixed.TARGET_ORGANIZATIONS,
) -> StreamingQuery:
    """Store filtered events batch by batch, then stop when all files are read.

    The checkpoint records which files are done, so a restart neither repeats nor skips
    one. Read the table with `read_batches`.
    """
    return (
        lines.writeStream.foreachBatch(
            lambda batch, number: _store_batch(tables, name, batch, number, organizations)
        )
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def _add_counts(tables: Tables, own: DataFrame, number: int, partials: str) -> list[str]:
    """Write the counts of a batch's own rows; gives their days.

    They lie under the batch's number, so a batch that is tried again replaces its own.
    """
    counts = dw_activity_daily(stg_gh_events(own)).where(F.col("base_date").isNotNull())
    counts = counts.withColumn("batch", F.lit(number).cast("bigint"))
    written = tables.overwrite_parts(partials, counts, PARTIAL_PARTITIONS)
    return sorted({day for day, _ in written})


def _summed(tables: Tables, partials: str, days: Sequence[str]) -> DataFrame:
    """The fact of some days: the sum of what all batches counted."""
    parts, _ = _live([p for day in days for p in tables.parts(partials, 2, f"base_date={day}")])
    keys = [name for name in schemas.ACTIVITY_DAILY.names if name != "event_count"]
    rows = tables.read_parts(partials, parts, _PARTIAL).groupBy(*keys).agg(F.sum("event_count").alias("event_count"))
    return rows.select(*schemas.ACTIVITY_DAILY.names)


def fold_partials(tables: Tables, partials: str, days: Sequence[str], most: int = MOST_PARTIALS) -> None:
    """Sum the counts of days with many batches into one folder, which says which batches it holds."""
    for day in days:
        parts = tables.parts(partials, 2, f"base_date={day}")
        live, done = _live(parts)
        if len(live) > most:
            numbers = [int(part.rpartition("=")[2]) for part in live]
            top = max(number + 1 if number >= 0 else -number for number in numbers)
            folded = _summed(tables, partials, [day]).withColumn("batch", F.lit(-top).cast("bigint"))
            tables.overwrite_parts(partials, folded, PARTIAL_PARTITIONS)
            _, done = _live(tables.parts(partials, 2, f"base_date={day}"))
        tables.drop_parts(partials, done)


def stream_daily_counts(
    lines: DataFrame,
    tables: Tables,
    checkpoint: str,
    events: str = "gh_archive_by_batch",
    daily: str = "dw_activity_daily",
    organizations: Sequence[str] | None = fixed.TARGET_ORGANIZATIONS,
    partials: str = "dw_activity_partials",
) -> StreamingQuery:
    """Keep the daily fact current: each batch counts its own rows, days are sums of such counts.

    Late rows need no watermark, as counts are added up per day whenever they come. A batch
    that is replayed replaces its counts, and sums stay as they were.
    """

    def load(batch: DataFrame, number: int) -> None:
        written = _store_batch(tables, events, batch, number, organizations)
        own = sorted(tables.part_of(BATCH_PARTITIONS, part) for part in written if part[0] is not None)
        if not own:
            return
        days = _add_counts(tables, tables.read_parts(events, own, _STORED), number, partials)
        if days:
            tables.replace_days(daily, _summed(tables, partials, days), days)
            fold_partials(tables, partials, days)

    return (
        lines.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
