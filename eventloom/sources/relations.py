"""Follower relations from landed listing pages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schemas
from ..functions import columns as c
from ..functions import fixed
from .archive import with_time_columns
from .tables import Tables


def follower_targets(
    unique_users: DataFrame, excluded: str = fixed.DIGEST_EXCLUDED_ORGANIZATION
) -> DataFrame:
    """Users to collect relations for: trimmed, not blank, each once."""
    return (
        unique_users.where(F.col("organization") != excluded)
        .select(F.trim("user_login").alias("user_login"))
        .where(F.col("user_login") != "")
        .distinct()
    )


def user_relations(pages: DataFrame) -> DataFrame:
    """One row per related account; a page that is no JSON array gives none."""
    username = F.trim("username")
    listed = F.when(F.ltrim("page").startswith("["), F.from_json("page", "array<string>"))
    rows = (
        pages.where(F.length(username) > 0)
        .select(
            username.alias("username"),
            "relation_type",
            "collected_at",
            F.explode(listed).alias("raw"),
        )
        .withColumn(
            "_r", F.from_json("raw", "login string, id string, type string, html_url string")
        )
        .select(
            c.snake_case(F.col("username")).alias("username"),
            "relation_type",
            F.col("_r.login").alias("related_login"),
            F.col("_r.id").try_cast("bigint").alias("related_id"),
            F.col("_r.type").alias("related_type"),
            F.col("_r.html_url").alias("related_html_url"),
            "raw",
            "collected_at",
        )
    )
    return with_time_columns(rows, "collected_at").select(*schemas.USER_RELATIONS.names)


# Users are far too many to be folders: files are sorted by them, in row groups small enough
# to skip, and a Bloom filter per row group tells that a user is not in it.
LOOKUP_OPTIONS = {
    "parquet.bloom.filter.enabled#username": "true",
    "parquet.block.size": str(16 << 20),
}


def write_user_relations(
    tables: Tables, relations: DataFrame, name: str = "gh_user_relations", options: dict[str, str] | None = None
) -> None:
    """Append by day, so that the relations of one user can be looked up."""
    tables.append(name, relations, ["dt_kst"], sort_by=["username"], options=LOOKUP_OPTIONS | (options or {}))


def relations_of(tables: Tables, username: str, name: str = "gh_user_relations") -> DataFrame:
    """All relations of one user: row groups without them are skipped by statistics and filters."""
    stored = tables.read(name, schemas.USER_RELATIONS)
    return stored.where(F.col("username") == username)
