"""Merkle manifest of a dataset: a tree per group of rows, and a tree over the groups.

A row's leaf is the SHA-256 of its fields, each written with its length. Leaves of a group
stand in the order of a key; `ARITY` neighbours make a parent, until one node is left, the
group's subroot. Subroots, ordered by group, make the root in the same way. Changing,
adding or dropping any row changes the root; a row is checked against the root with its
siblings alone.

Levels are built by sibling-shift self-joins: a node has place `idx` in its level, and its
siblings have the places of the other slots of its run (for two, `idx` XOR 1). Each level
is joined with itself on these places, once per other slot; then rows of slot zero, which
know all of their run, emit the parents. Every level is stored, a third of the one before.
Joins are on (tree, place), which is one row each, so no group is hot. Paths go down again
from the root by joins of a level with the level above.

H means the lower-case hex digest over its inputs in a row, digests as hex text.

Defined cases: a NULL field is `-`, others are their UTF-8 byte count, `:` and the value; a
NULL group is a group of its own, before all others; NULL keys come first, rows of equal
keys follow by leaf; repeated rows are leaves of their own; a group of one row has its
leaf as subroot, one group has its subroot as root; an empty table has no row and no
root. Columns that are not listed do not count.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventloom.llm.blocks import forget, stored
from eventloom.llm.ranks import in_order, with_places

ARITY = 3
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
PATH = "array<struct<before:string,after:string>>"


def leaf(fields: Sequence[Column]) -> Column:
    """H of the fields, each with its length."""
    parts = []
    for field in fields:
        text = field.cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return F.sha2(F.concat(*parts), 256)


def folded(start: Column, path: Column) -> Column:
    """The root that a leaf and its siblings give."""
    return F.aggregate(path, start, lambda node, run: F.sha2(F.concat(run["before"], node, run["after"]), 256))


def proof(path: Column) -> Column:
    """H of all siblings of a path, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda run: F.concat(run["before"], run["after"])), ""), 256)


def _sibling_place(shift: int, arity: int) -> Column:
    idx = F.col("idx")
    if arity == 2:
        return idx.bitwiseXOR(F.lit(1).cast("bigint"))
    return idx - idx % arity + (idx % arity + shift) % arity


def _with_siblings(level: DataFrame, arity: int) -> DataFrame:
    """Adds the hashes of a node's run before and after it."""
    nodes = level
    before, after = [], []
    for shift in range(1, arity):
        # the node `shift` slots on, counted around: beyond the last slot it lies before
        place, hash_ = f"_place{shift}", f"_hash{shift}"
        shifted = level.select(F.col("tree").alias("_tree"), F.col("idx").alias(place), F.col("hash").alias(hash_))
        # a place beyond the level's end has no row, nor has a lone root any sibling
        on = (F.col("tree") == F.col("_tree")) & (_sibling_place(shift, arity) == F.col(place))
        nodes = nodes.join(shifted, on, "left").drop("_tree", place)
        later = F.col("idx") % arity + shift < arity
        found = F.coalesce(F.col(hash_), F.lit(""))
        after.append(F.when(later, found).otherwise(""))
        before.append(F.when(later, "").otherwise(found))
    hashes = [f"_hash{shift}" for shift in range(1, arity)]
    return nodes.withColumns({"before": F.concat(*before), "after": F.concat(*after)}).drop(*hashes)


def _levels(leaves: DataFrame, arity: int) -> list[DataFrame]:
    """Stored levels (tree, idx, n, hash, before, after, ...) from the leaves up; roots have n = 1."""
    widest = leaves.agg(F.max("n")).first()[0] or 0
    levels = []
    while widest:
        levels.append(stored(_with_siblings(leaves, arity), "level"))
        slot_zero = levels[-1].where((F.col("n") > 1) & (F.col("idx") % arity == 0))
        leaves = slot_zero.select(
            "tree",
            F.expr(f"idx div {arity}").alias("idx"),
            F.expr(f"(n + {arity - 1}) div {arity}").alias("n"),
            F.sha2(F.concat("hash", "after"), 256).alias("hash"),
        )
        widest = -(-widest // arity) if widest > 1 else 0
    return levels


def _roots(levels: Sequence[DataFrame]) -> DataFrame:
    """(tree, root) of all trees, whatever their height."""
    parts = [level.where("n = 1").select("tree", F.col("hash").alias("root")) for level in levels]
    out = parts[0]
    for part in parts[1:]:
        out = out.union(part)
    return out


def _down(levels: Sequence[DataFrame], tops: DataFrame, arity: int) -> DataFrame:
    """The leaves' level with `top` and `path`: `tops` (tree, path) continues each tree's own path."""
    above = None
    for number, level in reversed(list(enumerate(levels))):
        run = F.struct("before", "after")
        own = level.where("n = 1").join(tops.withColumnRenamed("tree", "_tree"), F.col("tree") == F.col("_tree"))
        own = own.withColumn("top", F.col("hash")).drop("_tree")
        if above is not None:
            up = above.select(F.col("tree").alias("_tree"), F.col("idx").alias("_up"), "top", F.col("path").alias("_path"))
            inner = level.where("n > 1").withColumn("_parent", F.expr(f"idx div {arity}"))
            inner = inner.join(up, (F.col("tree") == F.col("_tree")) & (F.col("_parent") == F.col("_up")))
            inner = inner.withColumn("path", F.concat(F.array(run), "_path")).drop("_tree", "_up", "_parent", "_path")
            own = own.unionByName(inner.select(*own.columns))
        if number:
            keep = own.select("tree", "idx", "top", "path")
            made = stored(keep, "paths")
            if above is not None:
                forget(above)
            above = made
        else:
            return own
    raise ValueError("no level")


def manifest(
    docs: DataFrame,
    *,
    fields: Sequence[str] = FIELDS,
    group_col: str = "source",
    order_col: str = "doc_id",
    arity: int = ARITY,
    extra: dict[str, Column] | None = None,
) -> DataFrame:
    """One row per row of `docs`: key, leaf, subroot, root, path (its siblings), and what `extra` adds."""
    extra = extra or {}
    rows = docs.select(
        F.col(group_col).alias("_group"),
        F.col(order_col).alias("_key"),
        leaf([F.col(name) for name in fields]).alias("hash"),
        *[column.alias(f"_extra_{name}") for name, column in extra.items()],
    )
    ordered = in_order(rows, ["_group", "_key", "hash"])
    groups = ordered.select("_group").distinct().withColumn("tree", F.lit(0).cast("bigint"))
    groups = stored(with_places(in_order(groups, ["_group"]), "tree"), "groups")  # idx names the group's tree
    named = groups.select("_group", F.col("idx").alias("tree"))
    leaves = stored(with_places(ordered, "_group", named).drop("_group"), "leaves")
    forget(ordered)
    if leaves.isEmpty():
        out = leaves.withColumns({"top": F.col("hash"), "path": F.array().cast(PATH), "root": F.col("hash")})
    else:
        levels = _levels(leaves, arity)
        top_leaves = _roots(levels).select(
            F.lit(0).cast("bigint").alias("tree"), F.col("tree").alias("idx"), F.col("root").alias("hash")
        )
        count = groups.count()
        top_levels = _levels(top_leaves.withColumn("n", F.lit(count).cast("bigint")), arity)
        roots = _roots(top_levels).select("tree", F.array().cast(PATH).alias("path"))
        tops = _down(top_levels, roots, arity).select(F.col("idx").alias("tree"), "path")
        out = _down(levels, stored(tops, "paths"), arity)
        out = out.withColumn("root", F.lit(_roots(top_levels).first()["root"]))
    return out.select(
        F.col("_key").alias(order_col),
        F.col("hash").alias("leaf"),
        F.col("top").alias("subroot"),
        "root",
        "path",
        *[F.col(f"_extra_{name}").alias(name) for name in extra],
    )


def manifest_report(docs: DataFrame) -> DataFrame:
    """Leaves and proofs, and what becomes of them where texts lose their line breaks.

    Documents whose id has an even crc32 are tampered with.
    """
    number = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    lost = F.when(number % 2 == 0, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    changed = {name: F.col(name) for name in FIELDS} | {"text": lost}
    shown = {"shown": leaf(list(changed.values()))}
    rows = manifest(docs.select(*FIELDS), extra=shown).withColumn("folded_root", folded(F.col("shown"), F.col("path")))
    return rows.select(
        "doc_id",
        "leaf",
        "subroot",
        "root",
        proof(F.col("path")).alias("proof_sha256"),
        "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )


# Nodes of all trees, level by level; a path then climbs from each leaf, first in its own tree.
SQL = """
with recursive crc_table as (
    select list(c order by i) as t from (
        select i, list_reduce(range(8), lambda c, k:
            case when c % 2 = 1 then xor(c >> 1, 3988292384) else c >> 1 end, i) as c
        from (select unnest(range(256)) as i)
    )
), rows as (
    select doc_id, source, lang, n_chars, text, row_number() over () as id from documents
), numbered as (
    select *, xor(list_reduce(list_transform(string_split(cast(doc_id as varchar), ''), lambda d: cast(ord(d) as bigint)),
            lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), 4294967295), 4294967295) as crc
    from rows, crc_table
), shown as (
    select *, case when crc % 2 = 0 then replace(text, chr(10), '') else text end as text2,
        coalesce(strlen(cast(doc_id as varchar)) || ':' || doc_id, '-')
        || coalesce(strlen(source) || ':' || source, '-')
        || coalesce(strlen(lang) || ':' || lang, '-')
        || coalesce(strlen(cast(n_chars as varchar)) || ':' || n_chars, '-') as head
    from numbered
), leaves as (
    select id, doc_id, source, sha256(head || coalesce(strlen(text) || ':' || text, '-')) as h,
        sha256(head || coalesce(strlen(text2) || ':' || text2, '-')) as h2
    from shown
), placed as (
    select *, dense_rank() over (order by source nulls first) as tree,
        row_number() over (partition by source order by doc_id nulls first, h) - 1 as idx,
        count(*) over (partition by source) as n
    from leaves
), nodes(lvl, tree, idx, n, h) as (
    select 0, tree, idx, n, h from placed
    union all
    select lvl + 1, tree, idx // 3, (n + 2) // 3, sha256(string_agg(h, '' order by idx))
    from nodes where n > 1 group by lvl, tree, idx // 3, n
), subroots as (
    select tree, h from nodes where n = 1
), tops(lvl, idx, n, h) as (
    select 0, tree - 1, (select count(*) from subroots), h from subroots
    union all
    select lvl + 1, idx // 3, (n + 2) // 3, sha256(string_agg(h, '' order by idx))
    from tops where n > 1 group by lvl, idx // 3, n
), inside(id, tree, lvl, idx, n, h, sibs) as (
    select id, tree, 0, idx, n, h2, '' from placed
    union all
    select p.id, p.tree, p.lvl + 1, p.idx // 3, (p.n + 2) // 3,
        sha256(string_agg(case when s.idx = p.idx then p.h else s.h end, '' order by s.idx)),
        p.sibs || coalesce(string_agg(s.h, '' order by s.idx) filter (where s.idx <> p.idx), '')
    from inside p join nodes s on s.lvl = p.lvl and s.tree = p.tree and s.idx // 3 = p.idx // 3
    where p.n > 1 group by p.id, p.tree, p.lvl, p.idx, p.n, p.sibs
), above(id, lvl, idx, n, h, sibs) as (
    select id, 0, tree - 1, (select count(*) from subroots), h, sibs from inside where n = 1
    union all
    select p.id, p.lvl + 1, p.idx // 3, (p.n + 2) // 3,
        sha256(string_agg(case when s.idx = p.idx then p.h else s.h end, '' order by s.idx)),
        p.sibs || coalesce(string_agg(s.h, '' order by s.idx) filter (where s.idx <> p.idx), '')
    from above p join tops s on s.lvl = p.lvl and s.idx // 3 = p.idx // 3
    where p.n > 1 group by p.id, p.lvl, p.idx, p.n, p.sibs
)
select l.doc_id, l.h as leaf, r.h as subroot, t.h as root, sha256(a.sibs) as proof_sha256,
    a.h as folded_root, a.h = t.h as verified
from placed l join subroots r on r.tree = l.tree join tops t on t.n = 1
    join above a on a.id = l.id and a.n = 1
"""
