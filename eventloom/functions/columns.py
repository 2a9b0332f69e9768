"""Column builders shared by all models. Everything stays inside codegen."""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import fixed


# --- names -----------------------------------------------------------------

def snake_case(name: Column) -> Column:
    """CamelCase and dashes to snake_case; NULL and '' become 'unknown'."""
    spaced = F.regexp_replace(name, "(.)([A-Z][a-z]+)", "$1_$2")
    spaced = F.regexp_replace(spaced, "([a-z0-9])([A-Z])", "$1_$2")
    return F.when(F.length(name) > 0, F.translate(F.lower(spaced), "-", "_")).otherwise("unknown")


def owner_of(repo_name: Column) -> Column:
    """'owner' of 'owner/repo', NULL without a slash."""
    return F.when(F.instr(repo_name, "/") > 0, F.split_part(repo_name, F.lit("/"), F.lit(1)))


def short_repo(repo_name: Column) -> Column:
    """'repo' of 'owner/repo'; a name without a slash stays as it is."""
    return F.when(
        F.instr(repo_name, "/") > 0, F.split_part(repo_name, F.lit("/"), F.lit(2))
    ).otherwise(repo_name)


def partition_path(day: Column, organization: Column) -> Column:
    cleaned = F.translate(F.lower(organization), "- ", "__")
    return F.concat(F.lit("dt_kst="), day.cast("string"), F.lit("/organization="), cleaned)


# --- time ------------------------------------------------------------------

def parse_utc(text: Column) -> Column:
    """'2024-01-15T03:04:05Z' to a timestamp, anything else to NULL."""
    return F.when(
        text.endswith("Z"), F.try_to_timestamp(text, F.lit("yyyy-MM-dd'T'HH:mm:ssX"))
    )


def utc_clock(ts: Column) -> Column:
    """What a UTC clock shows, without a zone, whatever the session's zone."""
    return F.convert_timezone(None, F.lit("UTC"), ts.cast("timestamp_ntz"))


def shifted_local(ts: Column) -> Column:
    """The UTC clock moved by the local offset."""
    return utc_clock(ts) + F.expr(f"INTERVAL {fixed.KST_OFFSET_HOURS} HOURS")


def utc_date_as_local(day_text: Column) -> Column:
    """Local calendar date on which the given UTC date starts, as text."""
    midnight = F.to_timestamp(day_text, "yyyy-MM-dd")
    return F.date_format(F.from_utc_timestamp(midnight, "Asia/Seoul"), "yyyy-MM-dd")


def monday_of(day: Column) -> Column:
    return F.trunc(day, "week").cast("date")


# --- values ----------------------------------------------------------------

def none_text_to_null(column: Column) -> Column:
    return F.nullif(column, F.lit("None"))


def lenient_json(text: Column) -> Column:
    """JSON text to VARIANT; NULL for '', 'None' and anything unparsable."""
    return F.try_parse_json(F.when(~text.isin("", "None"), text))


def is_value(column: Column, value: str) -> Column:
    """Equality with NULL counted as false."""
    return F.coalesce(column == F.lit(value), F.lit(False))


def ratio(part: Column, whole: Column) -> Column:
    """part / whole as double, 0.0 when the whole is not positive."""
    return F.when(whole > 0, part.cast("double") / whole.cast("double")).otherwise(F.lit(0.0))


def percent(part: Column, whole: Column) -> Column:
    """100 * part / whole to two decimals, 0.0 when the whole is not positive."""
    scaled = F.lit(100.0) * part.cast("double") / whole.cast("double")
    return F.when(whole > 0, F.round(scaled, 2)).otherwise(F.lit(0.0))


def phrase(template: str, **parts: str) -> str:
    """SQL text that fills a '{name}' template with expressions.

    The result is NULL if any filled part is NULL.
    """
    pieces = []
    for literal, name in re.findall(r"([^{}]*)(?:\{(\w+)\})?", template):
        if literal:
            escaped = literal.replace("\\", "\\\\").replace("'", "\\'")
            pieces.append(f"'{escaped}'")
        if name:
            pieces.append(parts[name])
    return f"concat({', '.join(pieces)})"


def or_blank(name: str, length: int | None = None) -> str:
    filled = f"coalesce({name}, '')"
    return filled if length is None else f"substring({filled}, 1, {length})"


# --- activity classes and weights -------------------------------------------

def is_type(types: Iterable[str], column: str = "event_type") -> Column:
    return F.coalesce(F.col(column).isin(*types), F.lit(False))


def class_flags() -> dict[str, Column]:
    """any / light / medium / heavy for one fact row."""
    light, medium, heavy = (
        is_type(types) for types in (fixed.LIGHT_TYPES, fixed.MEDIUM_TYPES, fixed.HEAVY_TYPES)
    )
    return {"any": light | medium | heavy, "light": light, "medium": medium, "heavy": heavy}


def contribution(count: str = "event_count", event_type: str = "event_type") -> Column:
    weight = F.lit(1)
    by_weight: dict[int, list[str]] = {}
    for name, points in fixed.CONTRIBUTION_WEIGHTS.items():
        by_weight.setdefault(points, []).append(name)
    for points, names in by_weight.items():
        weight = F.when(F.col(event_type).isin(*names), F.lit(points)).otherwise(weight)
    return F.col(count) * weight


def typed_sum(types: Sequence[str], count: str = "event_count") -> Column:
    """Sum of counts over rows of the given event types."""
    return F.sum(F.when(is_type(types), F.col(count)).otherwise(F.lit(0)))
