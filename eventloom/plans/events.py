"""Staging table and the twelve typed event tables."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .. import schemas
from ..functions import columns as c
from ..functions import payload
from .event_fields import EVENT_SHAPES, PUSH, EventShape


def on_days(events: DataFrame, days: Iterable[date] | None, column: str = "dt_kst") -> DataFrame:
    """Rows of the given days (partition pruning); all rows for None."""
    return events if days is None else events.where(F.col(column).isin(list(days)))


def _named(events: DataFrame, login: str, *keep: str) -> DataFrame:
    """The columns every event table shares, plus the ones to keep."""
    names = events.select(
        F.col("id").cast("string").alias("event_id"),
        F.get_json_object("repo", "$.name").alias("repo_name"),
        F.get_json_object("org", "$.login").alias("_org_login"),
        F.col("organization").alias("_org_partition"),
        F.get_json_object("actor", "$.login").alias(login),
        F.col("ts_kst"),
        F.col("dt_kst").cast("date").alias("base_date"),
        *[F.col(name) for name in keep],
    )
    organization = F.coalesce("_org_login", c.owner_of(F.col("repo_name")), "_org_partition")
    return names.withColumn("organization", organization)


def stg_gh_events(events: DataFrame, days: Iterable[date] | None = None) -> DataFrame:
    """All event types, names resolved, payload not read."""
    return _named(on_days(events, days), "actor_login", "type").select(
        "event_id",
        F.col("type").alias("event_type"),
        "repo_name",
        "organization",
        "actor_login",
        "ts_kst",
        "base_date",
    )


def _push_extras(columns: dict[str, Column]) -> dict[str, Column]:
    ref = F.col("ref_full")
    return columns | {
        "ref_name": F.regexp_replace(ref, "^(refs/heads/|refs/tags/)", ""),
        "is_branch_ref": F.coalesce(ref.startswith("refs/heads/"), F.lit(False)),
        "is_tag_ref": F.coalesce(ref.startswith("refs/tags/"), F.lit(False)),
    }


def output_columns(shape: EventShape) -> list[str]:
    names = ["event_id", "repo_name", "organization", "user_login"]
    for name, _, _ in shape.fields:
        names.append(name)
        if name == "ref_full":
            names += ["ref_name", "is_branch_ref", "is_tag_ref"]
        names += [copy for copy, source in shape.copies if source == name]
    names += [name for name, _, _ in shape.item_fields]
    names += [name for name, _, _ in shape.flags]
    return [*names, "ts_kst", "base_date"]


def typed_schema(shape: EventShape) -> StructType:
    """The declared schema of a typed table."""
    kinds = {name: kind for name, _, kind in (*shape.fields, *shape.item_fields)}
    kinds |= {name: "boolean" for name, _, _ in shape.flags}
    kinds |= {"is_branch_ref": "boolean", "is_tag_ref": "boolean"} if shape is PUSH else {}
    kinds |= {"ts_kst": "timestamp_ntz", "base_date": "date"}
    names = output_columns(shape)
    return schemas.flat(", ".join(f"{name} {kinds.get(name, 'string')}" for name in names))


def typed_events(
    events: DataFrame, shape: EventShape, days: Iterable[date] | None = None
) -> DataFrame:
    """One typed table. Each payload is parsed once, by its own type's table.

    An event whose item array is missing or empty gives no row.
    """
    own = on_days(events, days).where(F.col("type") == shape.event_type)
    if not shape.fields and not shape.items:
        return _named(own, "user_login").select(*output_columns(shape))
    arrays = (shape.items,) if shape.items else ()
    rows = _named(own, "user_login", "payload")
    rows = payload.with_parsed(rows, "payload", "_p", shape.fields, arrays)
    rows = payload.with_fields(rows, "_p", shape.fields)
    if shape.items:
        rows = rows.withColumn("_item", F.explode(F.col("_p").getField(shape.items)))
        rows = payload.with_parsed(rows.drop("_p", "payload"), "_item", "_i", shape.item_fields)
        rows = payload.with_fields(rows, "_i", shape.item_fields)
    derived = {name: c.is_value(F.col(source), value) for name, source, value in shape.flags}
    derived |= {name: F.col(source) for name, source in shape.copies}
    if shape is PUSH:
        derived = _push_extras(derived)
    return rows.withColumns(derived).select(*output_columns(shape)) if derived else rows.select(
        *output_columns(shape)
    )


def typed_tables(events: DataFrame, days: Iterable[date] | None = None) -> dict[str, DataFrame]:
    return {name: typed_events(events, shape, days) for name, shape in EVENT_SHAPES.items()}
