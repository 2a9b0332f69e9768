"""Reading one event payload: parse the JSON text once, then take typed fields."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    DataType,
    StringType,
    StructField,
    StructType,
    VariantType,
)

Field = tuple[str, str, str]  # output name, path below the root, type


def struct_for(texts: Iterable[str], others: Iterable[str] = (), arrays: Iterable[str] = ()) -> StructType:
    """The smallest struct that holds the given dotted paths.

    A text leaf is a VARIANT, which knows whether the payload has a text, a number or
    something nested there. Other leaves are STRING, so numbers written as text and
    the other way round both survive; types are applied by `with_fields`. An array path
    holds its elements as JSON text.
    """
    tree: dict = {}
    kinds = {path: StringType() for path in others} | {path: VariantType() for path in texts}
    for path in kinds:
        node = tree
        for part in path.split("."):
            node = node.setdefault(part, {})
    for path in arrays:
        tree.setdefault(path, None)

    def build(node: dict | None, path: str) -> DataType:
        if node is None:
            return ArrayType(StringType())
        if not node:
            return kinds[path]
        return StructType(
            [StructField(n, build(child, f"{path}.{n}" if path else n)) for n, child in node.items()]
        )

    return build(tree, "")


def _text_paths(fields: Sequence[Field]) -> set[str]:
    return {path for _, path, kind in fields if kind == "string"}


def with_parsed(
    rows: DataFrame, text: str, name: str, fields: Sequence[Field], arrays: Sequence[str] = ()
) -> DataFrame:
    """Add the parsed payload as a struct column.

    The struct goes through a one-element explode. A filter on a parsed field
    then stays above it; pushed below, it would parse every payload a second
    time.
    """
    paths = [path for _, path, _ in fields]
    parsed = F.from_json(F.col(text), struct_for(_text_paths(fields), paths, arrays))
    return rows.select("*", F.explode(F.array(parsed)).alias(name))


def _leaf(parsed: str, path: str) -> str:
    return ".".join([parsed, *[f"`{part}`" for part in path.split(".")]])


def with_fields(rows: DataFrame, name: str, fields: Sequence[Field]) -> DataFrame:
    """Add the typed fields of a parsed payload; a bad cast gives NULL.

    A text field is NULL where its path holds an object or array.
    """
    texts = _text_paths(fields)
    taken = []
    for field, path, kind in fields:
        leaf = _leaf(name, path)
        as_text = f"cast({leaf} AS string)" if path in texts else leaf
        if kind == "string":
            nested = f"schema_of_variant({leaf}) RLIKE '^(OBJECT|ARRAY)'"
            taken.append(f"CASE WHEN {nested} THEN NULL ELSE {as_text} END AS `{field}`")
        else:
            taken.append(f"try_cast({as_text} AS {kind}) AS `{field}`")
    return rows.selectExpr("*", *taken)
