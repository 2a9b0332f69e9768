"""Quality rules as a ledger of failure bits.

Every rule is evaluated once per document. The ledger keeps its measurements and one
integer with a bit per failed rule. Policies are versioned masks over these bits, so
a new policy, or what a policy would keep without one of its rules, is a matter of
bit operations on the ledger; texts are not read again.

Defined cases: a NULL text has no words and counts as empty; ids may be NULL or
repeated; an empty table gives an empty ledger.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from eventloom.llm.text import SPACE_BYTES, as_bytes, slices

SYMBOLS = b"#*$%&|<>"
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_lines", "n_repeat_words")

# Failure conditions over the measurements; the place in this list is the bit.
RULES = {
    "few_words": "n_words < 50",
    "repeated_words": "100 * n_repeat_words > 50 * n_words",
    "many_symbols": "4 * n_symbols > word_chars",
    "long_words": "word_chars > 40 * n_words",
    "repeated_lines": "10 * n_dup_lines > 8 * n_lines",
}
BIT = {rule: 1 << n for n, rule in enumerate(RULES)}


@dataclass(frozen=True)
class Policy:
    version: str
    rules: tuple[str, ...]

    @property
    def mask(self) -> int:
        return sum(BIT[rule] for rule in self.rules)


BASE = Policy("base", ("few_words", "repeated_words"))
STRICT = Policy("2", tuple(RULES))


def measure(text: bytes) -> tuple[int, ...]:
    """The measurements of one text, in the order of MEASURES."""
    words = text.split()  # ASCII white space only, as bytes
    spaces = sum(map(text.count, [bytes([c]) for c in SPACE_BYTES]))
    lines = [line for line in text.split(b"\n") if line.strip()]
    repeats = 0
    windows = list(zip(words, words[1:], words[2:], strict=False))
    counts = Counter(windows)
    if len(counts) < len(windows):
        covered = 0  # words before this place are counted
        for start, window in enumerate(windows):
            if counts[window] > 1:
                repeats += start + 3 - max(start, covered)
                covered = start + 3
    return (
        len(words),
        len(text.decode()) - spaces,
        sum(map(text.count, [bytes([c]) for c in SYMBOLS])),
        len(lines) - len(set(lines)),
        len(lines),
        repeats,
    )


def _measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text"):
            rows = [measure(text) for text in as_bytes(part.column("text"))]
            columns = [pa.array([row[n] for row in rows], pa.int64()) for n in range(len(MEASURES))]
            yield pa.RecordBatch.from_arrays(
                [part.column("doc"), *columns], names=["doc", *MEASURES]
            )


def quality_ledger(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """All columns of `docs` under `doc`, with measurements and `failed` bits."""
    rows = docs.select(F.struct("*").alias("doc"), F.col(text_col).alias("text"))
    fields = [StructField(name, LongType()) for name in MEASURES]
    measured = rows.mapInArrow(_measured, StructType([rows.schema["doc"], *fields]))
    bits = " | ".join(f"if({rule}, {BIT[name]}L, 0L)" for name, rule in RULES.items())
    return measured.withColumn("failed", F.expr(bits))


def passes(policy: Policy) -> Column:
    return F.col("failed").bitwiseAND(F.lit(policy.mask)) == 0


def ablation(ledger: DataFrame, policy: Policy) -> DataFrame:
    """Per rule of the policy: documents failing it, and those only it rejects."""
    wanted = F.col("failed").bitwiseAND(F.lit(policy.mask)).alias("bits")
    counts = ledger.select(wanted).groupBy("bits").count()
    parts = F.array(*[F.struct(F.lit(rule).alias("rule"), F.lit(BIT[rule]).alias("bit")) for rule in policy.rules])
    rows = counts.select("bits", "count", F.explode(parts).alias("part"))
    hit = F.col("bits").bitwiseAND(F.col("part.bit")) != 0
    return rows.groupBy(F.col("part.rule").alias("rule")).agg(
        F.sum(F.when(hit, F.col("count")).otherwise(0)).alias("failing"),
        F.sum(F.when(F.col("bits") == F.col("part.bit"), F.col("count")).otherwise(0)).alias("only_this"),
    )


def quality_report(docs: DataFrame, policy: Policy = STRICT, id_col: str = "doc_id") -> DataFrame:
    ledger = quality_ledger(docs.select(id_col, "text"))
    return ledger.select(
        F.col(f"doc.{id_col}").alias("doc_id"),
        *[name for name in MEASURES if name != "n_lines"],
        (~passes(BASE)).alias("base_failed"),
        (passes(BASE) & passes(policy)).alias("kept"),
    )


def keep_good(docs: DataFrame, policy: Policy = STRICT) -> DataFrame:
    """The documents that base rules and policy accept, columns unchanged."""
    return quality_ledger(docs).where(passes(BASE) & passes(policy)).select("doc.*")


SQL = r"""
with texts as (
    select doc_id, coalesce(text, '') as text from documents
), split as (
    select *, list_filter(string_split_regex(text, '[\x09-\x0D ]+'), lambda w: w <> '') as words,
        list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, '[^\x09-\x0D ]')) as lines
    from texts
), windows as (
    select doc_id, i, count(*) over (partition by doc_id, w) as copies
    from (
        select doc_id, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] as w
        from (select doc_id, words, unnest(range(1, len(words) - 1)) as i from split)
    )
), repeats as (
    select doc_id, count(distinct i + k) as n
    from windows, (values (0), (1), (2)) as three(k) where copies > 1 group by doc_id
), measured as (
    select s.doc_id, cast(len(words) as bigint) as n_words,
        cast(length(regexp_replace(text, '[\x09-\x0D ]', '', 'g')) as bigint) as word_chars,
        cast(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) as bigint) as n_symbols,
        cast(len(lines) - len(list_distinct(lines)) as bigint) as n_dup_lines,
        len(lines) as n_lines,
        coalesce(r.n, 0) as n_repeat_words
    from split s left join repeats r on r.doc_id = s.doc_id
), judged as (
    select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed from measured
)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    not (base_failed or 4 * n_symbols > word_chars or word_chars > 40 * n_words
        or 10 * n_dup_lines > 8 * n_lines) as kept
from judged
"""
