"""Parquet tables on a shared folder: append, replace days, rebuild, read.

All data moves in Spark jobs. The driver touches folder names only, and loops
at most over the days of one run.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Sequence
from datetime import date, timedelta

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .merging import fitted, merged_schema, plain


def run_day(given: date | str | None = None, today: date | None = None) -> date:
    """The day to load: the given one, else yesterday."""
    if given is not None:
        return given if isinstance(given, date) else date.fromisoformat(given)
    return (today or date.today()) - timedelta(days=1)


def day_range(start: date | str, end: date | str) -> list[date]:
    first, last = run_day(start), run_day(end)
    if last < first:
        raise ValueError(f"end {last} lies before start {first}")
    return [first + timedelta(days=n) for n in range((last - first).days + 1)]


class Tables:
    """Named tables below one root folder.

    A table's files lie in a folder per version, `<root>/<name>/<version>`. A version
    counts once its marker `<root>/_versions/<name>/<version>` exists; the last one is
    the table. So a rebuild shows all at once or not at all, and one that is cut short
    leaves the table as it was.

    A version's schema is kept beside it, `<root>/_schemas/<name>/<version>`. Every write is
    checked against it first: columns may be added and types widened, which the kept schema
    then shows; other rows are refused before a file is written. Reads without a given
    schema use it, so old files show new columns as NULL.

    Declared tables are kept in step: every write registers the partitions it
    has written and drops those it has emptied.
    """

    def __init__(self, spark: SparkSession, root: str, catalog_prefix: str = ""):
        self.spark = spark
        self.root = root.rstrip("/")
        self.catalog_prefix = catalog_prefix
        self._jvm = spark._jvm
        self._conf = spark._jsparkSession.sessionState().newHadoopConf()

    # --- folders ---

    def path(self, name: str) -> str:
        """A folder beside the tables, for raw files and checkpoints."""
        return f"{self.root}/{name}"

    def _handle(self, path: str):
        target = self._jvm.org.apache.hadoop.fs.Path(path)
        return target.getFileSystem(self._conf), target

    def _children(self, path: str) -> list[str]:
        fs, target = self._handle(path)
        if not fs.exists(target):
            return []
        names = [status.getPath().getName() for status in fs.listStatus(target)]
        return sorted(name for name in names if not name.startswith(("_", ".")))

    def _delete(self, path: str) -> None:
        fs, target = self._handle(path)
        fs.delete(target, True)

    # --- progress of long runs ---

    def done(self, run: str) -> set[str]:
        """Steps of a run that are finished."""
        return set(self._children(f"{self.root}/_progress/{run}"))

    def mark_done(self, run: str, step: str) -> None:
        fs, marker = self._handle(f"{self.root}/_progress/{run}/{step}")
        fs.create(marker, True).close()

    def end_run(self, run: str) -> None:
        """Forget a run whose steps are all finished, so that it may be made again."""
        self._delete(f"{self.root}/_progress/{run}")

    def move_only_file(self, folder: str, path: str) -> None:
        """Rename the one data file of a folder."""
        (name,) = self._children(folder)
        fs, source = self._handle(f"{folder}/{name}")
        _, target = self._handle(path)
        fs.mkdirs(target.getParent())
        if not fs.rename(source, target):
            raise OSError(f"cannot move {source} to {path}")

    def cut_file(self, path: str, share: float) -> None:
        """Keep the first part of a small file, as a broken transfer would."""
        fs, target = self._handle(path)
        stream = fs.open(target)
        try:
            content = bytes(self._jvm.org.apache.commons.io.IOUtils.toByteArray(stream))
        finally:
            stream.close()
        stream = fs.create(target, True)
        try:
            stream.write(bytearray(content[: int(len(content) * share)]))
        finally:
            stream.close()

    def _versions(self, name: str) -> list[str]:
        return self._children(f"{self.root}/_versions/{name}")

    def _new_version(self, name: str) -> str:
        last = self._versions(name)[-1:]
        number = int(last[0].split("-")[0]) + 1 if last else 1
        return f"{number:06d}-{uuid.uuid4().hex[:12]}"

    def _publish(self, name: str, version: str) -> None:
        fs, marker = self._handle(f"{self.root}/_versions/{name}/{version}")
        fs.create(marker, False).close()

    # --- schemas ---

    def schema(self, name: str) -> StructType | None:
        """The kept schema of the current version."""
        versions = self._versions(name)
        folder = f"{self.root}/_schemas/{name}/{versions[-1]}" if versions else None
        numbers = self._children(folder) if folder else []
        if not numbers:
            return None
        fs, target = self._handle(f"{folder}/{numbers[-1]}")
        stream = fs.open(target)
        try:
            text = self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return StructType.fromJson(json.loads(text))

    def _keep_schema(self, name: str, version: str, schema: StructType) -> None:
        """Each change is a new file, so a reader sees the old one or the new one whole."""
        folder = f"{self.root}/_schemas/{name}/{version}"
        number = len(self._children(folder)) + 1
        fs, hidden = self._handle(f"{folder}/.{number:06d}-{uuid.uuid4().hex[:12]}")
        stream = fs.create(hidden, False)
        try:
            stream.write(bytearray(schema.json(), "utf-8"))
        finally:
            stream.close()
        _, target = self._handle(f"{folder}/{number:06d}")
        if not fs.rename(hidden, target):
            raise OSError(f"another write has changed the schema of {name}")

    def _admitted(self, name: str, df: DataFrame) -> DataFrame:
        """The rows as the existing table takes them; keeps the schema they widen."""
        known = self.schema(name)
        if known is None:
            return df
        merged = merged_schema(known, df.schema)
        if merged != known:
            self._keep_schema(name, self._versions(name)[-1], merged)
            self._moved(name, merged)
        return fitted(df, merged)

    def data_path(self, name: str) -> str:
        """The folder of the current version."""
        versions = self._versions(name)
        if not versions:
            raise FileNotFoundError(f"{self.root}/{name}")
        return f"{self.root}/{name}/{versions[-1]}"

    def exists(self, name: str) -> bool:
        return bool(self._versions(name))

    def days(self, name: str, day_column: str = "base_date") -> list[str]:
        prefix = f"{day_column}="
        found = self._children(self.data_path(name)) if self.exists(name) else []
        return [child[len(prefix):] for child in found if child.startswith(prefix)]

    # --- reading ---

    def read(
        self,
        name: str,
        schema: StructType | None = None,
        days: Iterable[date | str] | None = None,
        day_column: str = "base_date",
    ) -> DataFrame:
        """Read a table; with a schema, columns an old file lacks come out NULL.

        Given days, only their folders are listed and read.
        """
        if not self.exists(name):
            if schema is None:
                raise FileNotFoundError(f"{self.root}/{name}")
            return self.spark.createDataFrame([], schema)
        schema = schema or self.schema(name)
        reader = self.spark.read if schema is None else self.spark.read.schema(schema)
        folder = self.data_path(name)
        if days is None:
            return reader.parquet(folder)
        wanted = {str(run_day(day)) for day in days}
        there = [day for day in self.days(name, day_column) if day in wanted]
        if not there:
            return reader.parquet(folder).where("false") if schema is None else self.spark.createDataFrame([], schema)
        return self.read_parts(name, [f"{day_column}={day}" for day in there], schema)

    def read_parts(self, name: str, parts: Sequence[str], schema: StructType | None = None) -> DataFrame:
        """Read some partition folders, named below the table."""
        schema = schema or self.schema(name)
        reader = self.spark.read if schema is None else self.spark.read.schema(schema)
        folder = self.data_path(name)
        return reader.option("basePath", folder).parquet(*[f"{folder}/{part}" for part in parts])

    def parts(self, name: str, levels: int, under: str = "") -> list[str]:
        """Partition folders below the table (or below one of its folders)."""
        found = [under] if under else [""]
        for _ in range(levels - (under.count("/") + 1 if under else 0)):
            found = [
                f"{part}/{child}".lstrip("/")
                for part in found
                for child in self._children(f"{self.data_path(name)}/{part}")
                if "=" in child
            ]
        return found

    def view(self, name: str, df: DataFrame) -> None:
        df.createOrReplaceTempView(self.catalog_name(name))

    # --- writing ---

    @staticmethod
    def _balanced(df: DataFrame, keys: Sequence[str]) -> DataFrame:
        """Even files per partition value: large ones are split, small ones merged."""
        return df.hint("rebalance", *[F.col(key) for key in keys]) if keys else df.hint("rebalance")

    def _check_partitions(self, df: DataFrame, keys: Sequence[str]) -> None:
        missing = [key for key in keys if key not in df.columns]
        if missing:
            raise ValueError(f"partition columns not in the data: {missing}")

    def _write(
        self,
        df: DataFrame,
        folder: str,
        keys: Sequence[str],
        sort_by: Sequence[str] = (),
        mode: str = "error",
        options: dict[str, str] | None = None,
    ) -> set[tuple]:
        """Write the rows; gives the partition values written, observed on the way."""
        self._check_partitions(df, keys)
        seen = Observation()
        if keys:
            values = F.to_json(F.array(*[F.col(key).cast("string") for key in keys]))
            df = df.observe(seen, F.collect_set(values).alias("parts"))
        rows = self._balanced(df, keys)
        if sort_by:
            rows = rows.sortWithinPartitions(*keys, *sort_by)
        writer = rows.write.partitionBy(*keys).options(**(options or {}))
        if mode == "replace":
            writer = writer.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        else:
            writer = writer.mode(mode)
        writer.parquet(folder)
        # rows known to be none while planning are not observed
        if not keys or seen._jo.getRow().length() == 0:
            return set()
        return {tuple(json.loads(part)) for part in seen.get["parts"]}

    def append(
        self,
        name: str,
        df: DataFrame,
        partition_by: Sequence[str] = (),
        sort_by: Sequence[str] = (),
        options: dict[str, str] | None = None,
    ) -> None:
        """Create on first write, append afterwards; columns may be added or widened.

        Rows of a type the table cannot hold raise `SchemaConflict` and change nothing.
        """
        self._into_version(name, df, partition_by, sort_by, "append", options)

    def overwrite_parts(
        self, name: str, df: DataFrame, partition_by: Sequence[str], sort_by: Sequence[str] = ()
    ) -> set[tuple]:
        """Replace the partitions that `df` has rows for, leave the others; gives those."""
        return self._into_version(name, df, partition_by, sort_by, "replace")

    def _into_version(self, name, df, keys, sort_by, mode, options=None) -> set[tuple]:
        if self.exists(name):
            df = self._admitted(name, df)
            written = self._write(df, self.data_path(name), keys, sort_by, mode, options)
        else:
            version = self._new_version(name)
            written = self._write(df, f"{self.root}/{name}/{version}", keys, sort_by, mode, options)
            self._keep_schema(name, version, plain(df.schema))
            self._publish(name, version)
        self._register(name, keys, written)
        return written

    def kept(self, name: str, df: DataFrame) -> DataFrame:
        """Write an interim result and read it again; what is read then cannot change under it."""
        self.rebuild(f"_{name}", df)
        return self.read(f"_{name}")

    def rebuild(self, name: str, df: DataFrame, partition_by: Sequence[str] = ()) -> None:
        """Replace the whole table, even if it is computed from itself.

        The version before is kept for readers that still use it; older ones go.
        """
        version = self._new_version(name)
        self._write(df, f"{self.root}/{name}/{version}", partition_by)
        self._keep_schema(name, version, plain(df.schema))
        self._publish(name, version)
        for old in self._versions(name)[:-2]:
            for place in ("_versions", "_schemas", ""):
                self._delete("/".join(part for part in (self.root, place, name, old) if part))
        self._moved(name)

    def replace_days(
        self,
        name: str,
        df: DataFrame,
        days: Iterable[date | str],
        day_column: str = "base_date",
        more_partitions: Sequence[str] = (),
    ) -> None:
        """Replace exactly the given days by the rows of `df`.

        One job overwrites the partitions that have rows. Then the partitions of these
        days that got none are dropped, which the overwrite leaves behind.
        Running it again gives the same table, so a run cut short is repaired by
        repeating it.
        """
        wanted = sorted({str(run_day(day)) for day in days})
        keys = (day_column, *more_partitions)
        self._check_partitions(df, keys)
        rows = df.where(F.col(day_column).isin([date.fromisoformat(day) for day in wanted]))
        written = self.overwrite_parts(name, rows, keys)
        kept = {self.part_of(keys, part) for part in written}
        there = set(self.days(name, day_column))
        emptied = [
            part
            for day in wanted
            if day in there
            for part in self.parts(name, len(keys), f"{day_column}={day}")
            if part not in kept
        ]
        self.drop_parts(name, emptied)

    def replace_parts(
        self, name: str, df: DataFrame, keys: Sequence[str], wanted: Iterable[Sequence]
    ) -> None:
        """Replace exactly the partitions with the given values by the rows of `df`.

        Rows of other partitions are left out; wanted partitions without rows are dropped.
        """
        values = sorted({tuple(map(str, part)) for part in wanted})
        named = F.to_json(F.array(*[F.col(key).cast("string") for key in keys]))
        rows = df.where(named.isin([json.dumps(part, separators=(",", ":"), ensure_ascii=False) for part in values]))
        written = self.overwrite_parts(name, rows, keys)
        emptied = [self.part_of(keys, part) for part in values if part not in written]
        self.drop_parts(name, emptied)

    def part_of(self, keys: Sequence[str], values: Sequence[str | None]) -> str:
        """Partition folder, named below the table, of some partition values."""
        return "/".join(map(self._folder, keys, values))

    def _folder(self, key: str, value: str | None) -> str:
        """Name of a partition's folder as Spark writes it, with NULL and escaped letters."""
        names = self.spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
        return names.getPartitionPathString(key, value)

    def drop_parts(self, name: str, parts: Sequence[str]) -> None:
        """Delete partition folders, named below the table."""
        folder = self.data_path(name)
        declared = self._declared(name)
        for part in parts:
            if declared:
                spec = self._spec(part.split("/"))
                self.spark.sql(f"ALTER TABLE {self.catalog_name(name)} DROP IF EXISTS PARTITION ({spec})")
            self._delete(f"{folder}/{part}")

    def store(
        self, name: str, df: DataFrame, mode: str = "auto", partition_by: Sequence[str] = ()
    ) -> str:
        """Write with mode auto (append where the table exists), append or overwrite."""
        if mode not in ("auto", "append", "overwrite"):
            raise ValueError(f"unknown mode {mode!r}")
        resolved = mode if mode != "auto" else ("append" if self.exists(name) else "overwrite")
        if resolved == "append":
            self.append(name, df, partition_by)
        else:
            self.rebuild(name, df, partition_by)
        return resolved

    # --- catalog ---

    def catalog_name(self, name: str) -> str:
        return f"{self.catalog_prefix}{name}"

    @staticmethod
    def _spec(pairs: Iterable[str]) -> str:
        parts = []
        for pair in pairs:
            key, _, value = pair.partition("=")
            parts.append(f"`{key}` = '{value}'")
        return ", ".join(parts)

    def _declared(self, name: str) -> bool:
        table = self.catalog_name(name)
        return self.spark.catalog.tableExists(table) and self.spark.catalog.getTable(table).tableType == "EXTERNAL"

    def declare(self, name: str, schema: StructType, partition_by: Sequence[str] = ()) -> None:
        """CREATE TABLE IF NOT EXISTS over the table's folder, with the partitions it has."""
        if self._declared(name):
            return
        if not self.exists(name):
            version = self._new_version(name)
            fs, folder = self._handle(f"{self.root}/{name}/{version}")
            fs.mkdirs(folder)
            self._keep_schema(name, version, plain(schema))
            self._publish(name, version)
        body = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        parts = f"PARTITIONED BY ({', '.join(partition_by)})" if partition_by else ""
        table = self.catalog_name(name)
        self.spark.sql(
            f"CREATE TABLE {table} ({body}) USING parquet {parts} LOCATION '{self.data_path(name)}'"
        )
        if partition_by:
            self.spark.sql(f"ALTER TABLE {table} RECOVER PARTITIONS")

    def _register(self, name: str, keys: Sequence[str], written: set[tuple]) -> None:
        """Make the partitions just written known to a declared table."""
        if not self._declared(name):
            return
        table = self.catalog_name(name)
        specs = [
            f"PARTITION ({self._spec(f'{k}={v}' for k, v in zip(keys, part, strict=True))})"
            for part in sorted(written, key=repr)
            if None not in part
        ]
        if specs:
            self.spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {' '.join(specs)}")
        if len(specs) < len(written):  # NULL values have a folder name of their own
            self.spark.sql(f"ALTER TABLE {table} RECOVER PARTITIONS")
        self.spark.catalog.refreshTable(table)

    def _moved(self, name: str, schema: StructType | None = None) -> None:
        """Declare a rebuilt table again, at its new place or with a wider schema."""
        if self._declared(name):
            table = self.catalog_name(name)
            schema = schema or self.spark.table(table).schema
            keys = [c.name for c in self.spark.catalog.listColumns(table) if c.isPartition]
            self.drop(name)
            self.declare(name, schema, keys)

    def drop(self, name: str) -> None:
        """DROP TABLE IF EXISTS; the files stay where they are."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.catalog_name(name)}")


def report_table_name(df: DataFrame) -> str:
    """Table a set of report rows belongs to, told from its columns."""
    names = set(df.columns)
    if {"actor_login", "organization_set"} <= names:
        return "dl_actor_week"
    if {"organization", "repo_name"} <= names:
        return "dl_repo_week"
    return "dl_results"


def write_report_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def read_report_json(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """JSON lines, or files holding one array of objects."""
    return spark.read.schema(schema).option("multiLine", False).json(path)


def read_report_array(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    return spark.read.schema(schema).option("multiLine", True).json(path)
