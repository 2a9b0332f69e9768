"""Hourly archive files to the filtered event table."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions import columns as c
from ..functions import fixed
from .tables import day_range

EVENT_PARTITIONS = ("dt_kst", "organization")


def hour_paths(root: str, day: date | str) -> list[str]:
    """The 24 file paths of one UTC day."""
    return [f"{root.rstrip('/')}/{day}/{day}-{hour}.json.gz" for hour in range(24)]


def existing_paths(spark: SparkSession, paths: Sequence[str]) -> list[str]:
    """Paths that are there; a missing hour is skipped, not an error.

    Each folder is listed once, not once per file.
    """
    jvm, conf = spark._jvm, spark._jsparkSession.sessionState().newHadoopConf()
    there: dict[str, set[str]] = {}
    for folder in {path.rpartition("/")[0] for path in paths}:
        target = jvm.org.apache.hadoop.fs.Path(folder)
        fs = target.getFileSystem(conf)
        listed = fs.listStatus(target) if fs.exists(target) else []
        there[folder] = {status.getPath().getName() for status in listed}
    return [path for path in paths if path.rpartition("/")[2] in there[path.rpartition("/")[0]]]


def read_lines(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Scan JSON lines (gz or plain) with the declared schema.

    A blank or broken line comes out as a row of NULLs and falls to the
    organization filter of `filter_events`. One gz file is one task; the write
    rebalances afterwards.
    """
    return spark.read.schema(schemas.RAW_EVENT).json(paths if isinstance(paths, str) else list(paths))


def parse_lines(lines: DataFrame, column: str = "value") -> DataFrame:
    """The same rows from a text column instead of files.

    The one-element explode keeps later filters from parsing the line again.
    """
    parsed = F.from_json(F.col(column), schemas.RAW_EVENT)
    return lines.select(F.explode(F.array(parsed)).alias("event")).select("event.*")


def read_days(
    spark: SparkSession, root: str, start: date | str, end: date | str | None = None
) -> DataFrame:
    """All hourly files of the given UTC days, in one scan."""
    days = day_range(start, end if end is not None else start)
    paths = existing_paths(spark, [path for day in days for path in hour_paths(root, day)])
    if not paths:
        raise FileNotFoundError(f"no hourly file from {days[0]} to {days[-1]} under {root}")
    return read_lines(spark, paths)


def organization_login(org: Column) -> Column:
    return F.get_json_object(org, "$.login")


def with_time_columns(df: DataFrame, created_at: str = "created_at") -> DataFrame:
    """Add ts_utc, dt_utc, ts_kst, dt_kst; all NULL without the source column."""
    if created_at not in df.columns:
        nothing = F.lit(None)
        return df.withColumns(
            {
                "ts_utc": nothing.cast("timestamp"),
                "dt_utc": nothing.cast("date"),
                "ts_kst": nothing.cast("timestamp_ntz"),
                "dt_kst": nothing.cast("date"),
            }
        )
    source = F.col(created_at)
    if df.schema[created_at].dataType.typeName() == "string":
        source = c.parse_utc(source)
    return (
        df.withColumn(created_at, source)
        .withColumns({"ts_utc": F.col(created_at), "ts_kst": c.shifted_local(F.col(created_at))})
        .withColumns(
            {"dt_utc": F.to_date(c.utc_clock(F.col("ts_utc"))), "dt_kst": F.to_date("ts_kst")}
        )
    )


def without_index_columns(df: DataFrame) -> DataFrame:
    return df.drop(*[name for name in df.columns if name.startswith("__index_level")])


def clean_none_text(df: DataFrame) -> DataFrame:
    """The text 'None' becomes NULL in every string column."""
    names = [f.name for f in df.schema.fields if f.dataType.typeName() == "string"]
    return df.withColumns({name: c.none_text_to_null(F.col(name)) for name in names})


def all_to_text(df: DataFrame) -> DataFrame:
    return df.select([F.col(name).cast("string").alias(name) for name in df.columns])


def keep_organizations(
    df: DataFrame,
    organizations: Sequence[str] | DataFrame | None = fixed.TARGET_ORGANIZATIONS,
    org_column: str = "org",
) -> DataFrame:
    """Rows whose org.login is exactly one of the given names.

    A long list may come as a one-column DataFrame: it is semi-joined and the
    engine decides from its size whether to broadcast it. Without an org column
    the input passes unchanged.
    """
    if org_column not in df.columns or organizations is None:
        return df
    login = organization_login(F.col(org_column))
    if isinstance(organizations, DataFrame):
        wanted = organizations.select(F.col(organizations.columns[0]).alias("_wanted")).distinct()
        return df.join(wanted, login == F.col("_wanted"), "left_semi")
    return df.where(login.isin(*organizations))


def filter_events(
    raw: DataFrame,
    organizations: Sequence[str] | DataFrame | None = fixed.TARGET_ORGANIZATIONS,
    unique_ids: bool = False,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Raw lines to the filtered event table: one narrow pass, no shuffle.

    `unique_ids` drops repeated ids; by default re-ingested rows stay, as the
    uniqueness check reports them. `keep` names columns that go along unchanged.
    """
    has_org = F.col("org").isNotNull() & ~F.col("org").isin("", "{}", "[]", "0", "false")
    kept = keep_organizations(raw.where(has_org), organizations)
    dated = with_time_columns(clean_none_text(kept))
    shaped = dated.withColumns(
        {
            "public": F.col("public").try_cast("boolean"),
            "organization": c.snake_case(organization_login(F.col("org"))),
        }
    ).select(*schemas.FILTERED_EVENT.names, *keep)
    return shaped.dropDuplicates(["id"]) if unique_ids else shaped


def partition_summary(events: DataFrame) -> DataFrame:
    """Rows per (dt_kst, organization)."""
    return (
        events.groupBy("dt_kst", "organization")
        .agg(F.count("*").alias("row_count"))
        .orderBy("dt_kst", "organization")
    )
