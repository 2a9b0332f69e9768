"""Data-quality checks on the event table."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from datetime import date
from urllib.parse import unquote

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import fixed
from ..sources.tables import Tables

# The four time columns and the types they must have.
TIME_COLUMNS = {
    "dt_kst": ("date",),
    "dt_utc": ("date",),
    "ts_kst": ("timestamp_ntz", "timestamp"),
    "ts_utc": ("timestamp",),
}


def missing_columns(df: DataFrame, required: Sequence[str] = fixed.REQUIRED_EVENT_COLUMNS) -> list[str]:
    return [name for name in required if name not in df.columns]


def time_columns_valid(df: DataFrame) -> bool:
    """All four time columns are there with a proper date or timestamp type."""
    types = {f.name: f.dataType.typeName() for f in df.schema.fields}
    return all(types.get(name) in allowed for name, allowed in TIME_COLUMNS.items())


def stored_columns(tables: Tables, name: str) -> DataFrame:
    """(part, file, column_name, stored_type) of every Parquet file of a table, from its footer.

    Footers are read in tasks, dealt by file; no row is read. `part` is the partition folder.
    """
    spark, root = tables.spark, tables.data_path(name)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").load(root)
    base = root.rpartition(":")[2].lstrip("/")

    def footers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow.fs import FileSystem

        for batch in batches:
            rows = []
            for path in batch.column("path").to_pylist():
                system, place = FileSystem.from_uri(path)
                with system.open_input_file(place) as file:
                    schema = pq.read_schema(file)
                part = unquote(path.rpartition("/")[0].partition(base)[2].strip("/"))
                rows += [(part, path.rpartition("/")[2], field.name, str(field.type)) for field in schema]
            columns = zip(*rows, strict=True) if rows else [[]] * 4
            names = ["part", "file", "column_name", "stored_type"]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in columns], names=names)

    paths = files.select("path").repartition(max(1, spark.sparkContext.defaultParallelism))
    return paths.mapInArrow(footers, "part string, file string, column_name string, stored_type string")


# How the Parquet files of a table may hold each of the time columns.
STORED_TIME_TYPES = {
    "dt_utc": ("date32[day]",),
    "ts_kst": ("timestamp[us]", "timestamp[ns]"),
    "ts_utc": ("timestamp[us, tz=UTC]", "timestamp[ns, tz=UTC]", "timestamp[ns]"),
}


def time_column_drift(tables: Tables, name: str, types: dict[str, tuple[str, ...]] | None = None) -> DataFrame:
    """Files whose time columns are missing or of another type: (part, column_name, stored_type, files).

    `dt_kst` is a partition folder and in no file.
    """
    wanted = types or STORED_TIME_TYPES
    held = stored_columns(tables, name)
    allowed = [F.struct(F.lit(column).alias("column_name"), F.lit(kind).alias("stored_type")) for column, kinds in wanted.items() for kind in kinds]
    # one row per file and wanted column, with the type it has there
    expected = F.array(*[F.lit(column) for column in wanted])
    there = held.groupBy("part", "file").agg(F.map_from_entries(F.collect_list(F.struct("column_name", "stored_type"))).alias("types"))
    rows = there.select("part", "file", "types", F.explode(expected).alias("column_name"))
    rows = rows.withColumn("stored_type", F.coalesce(F.try_element_at("types", F.col("column_name")), F.lit("missing")))
    drifted = rows.where(~F.struct("column_name", "stored_type").isin(*allowed))
    return drifted.groupBy("part", "column_name", "stored_type").agg(F.count("*").alias("files"))


def not_null(df: DataFrame, required: Sequence[str] = fixed.REQUIRED_EVENT_COLUMNS) -> DataFrame:
    """NULLs per required column, all counted in one pass.

    A column the table lacks is listed with every row as NULL.
    """
    present = set(df.columns)
    nulls = [
        F.count_if(F.col(name).isNull() if name in present else F.lit(True)).alias(name)
        for name in required
    ]
    counts = df.agg(F.count("*").alias("row_count"), *nulls)
    wide = [
        F.struct(
            F.lit(name).alias("column_name"),
            F.lit(name in present).alias("is_present"),
            F.col(name).alias("null_count"),
        )
        for name in required
    ]
    return counts.select("row_count", F.inline(F.array(*wide)))


def not_unique(df: DataFrame, key: str = "id") -> DataFrame:
    """Values of the key that occur more than once."""
    return (
        df.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.count("*").alias("copies"))
        .where(F.col("copies") > 1)
    )


def freshness(
    df: DataFrame,
    as_of: date | str,
    column: str = "dt_kst",
    warn_after: int = fixed.FRESH_WARN_DAYS,
    error_after: int = fixed.FRESH_ERROR_DAYS,
) -> DataFrame:
    """Newest day, its age, and pass / warn / error. An empty table is an error."""
    age = F.datediff(F.lit(str(as_of)).cast("date"), F.col("newest_day"))
    return (
        df.agg(F.max(column).alias("newest_day"))
        .withColumn("age_days", age)
        .withColumn(
            "status",
            F.when(F.col("age_days").isNull() | (F.col("age_days") > error_after), "error")
            .when(F.col("age_days") > warn_after, "warn")
            .otherwise("pass"),
        )
    )
