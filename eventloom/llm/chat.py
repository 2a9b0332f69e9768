r"""Chat formatting from event logs.

A conversation is a log of events in sequence: `message` opens a message, `delta` adds
streamed text to one, `edit` replaces its text, `regenerate` starts it anew so that
later deltas fill it. Events name their message by `message`; the log is cut by
conversation and message, sorted by sequence and folded to the final text. Messages are
then rendered with a template and joined per conversation.

Template: `<|turn|>` role `\n` text `<|end|>\n`. Texts and roles have `&` written as
`&a;` and `<` as `&l;` (roles also line breaks as `&n;`), so no text can hold a marker and
reading back is exact. The loss mask marks assistant texts: `loss_spans` has the start
and length of each in code points of the formatted text.

All steps are DataFrame functions and share one exchange by conversation. A formatted
conversation is one string, so a conversation is bounded by what a string may hold.

Defined cases: NULL texts and roles are empty; a NULL conv_id is a conversation of its
own; rows that repeat a turn are all kept, ordered by turn, role and text; a message
whose events hold no text is empty; an empty log gives no row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

TURN, END = "<|turn|>", "<|end|>\n"
EVENT_KINDS = ("message", "delta", "edit", "regenerate")


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("&"), F.lit("&a;")), F.lit("<"), F.lit("&l;"))


def unescape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("&l;"), F.lit("<")), F.lit("&a;"), F.lit("&"))


def escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit("&n;"))


def unescape_role(role: Column) -> Column:
    return unescape(F.replace(role, F.lit("&n;"), F.lit("\n")))


def turns_as_events(rows: DataFrame) -> DataFrame:
    """A table of finished turns (conv_id, turn, role, text) as a log."""
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    return rows.select(
        "conv_id",
        F.row_number().over(order).cast("bigint").alias("message"),
        F.lit(0).cast("bigint").alias("seq"),
        F.lit("message").alias("kind"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )


def fold_events(log: DataFrame) -> DataFrame:
    """(conv_id, message, role, text): the final text of every message."""
    event = F.struct("seq", "kind", "role", F.coalesce("text", F.lit("")).alias("text"))
    logs = log.groupBy("conv_id", "message").agg(F.sort_array(F.collect_list(event)).alias("events"))
    # what comes before the last event that sets the text no longer counts
    numbered = F.transform("events", lambda e, n: F.struct(e["kind"].alias("kind"), n.alias("n")))
    setting = F.filter(numbered, lambda e: e["kind"] != "delta")
    since = F.coalesce(F.try_element_at(F.transform(setting, lambda e: e["n"]), F.lit(-1)), F.lit(0))
    lasting = F.slice("events", since + 1, F.size("events"))
    roles = F.filter(F.transform("events", lambda e: e["role"]), lambda r: r.isNotNull())
    return logs.select(
        "conv_id",
        "message",
        F.coalesce(F.try_element_at(roles, F.lit(1)), F.lit("")).alias("role"),
        F.array_join(F.transform(lasting, lambda e: e["text"]), "").alias("text"),
    )


def format_chats(messages: DataFrame) -> DataFrame:
    """(conv_id, formatted, loss_spans) from (conv_id, message, role, text)."""
    head = F.concat(F.lit(TURN), escape_role(F.col("role")), F.lit("\n"))
    rendered = messages.select(
        "conv_id", "message", "role", head.alias("head"), escape(F.col("text")).alias("body")
    ).select(
        "conv_id",
        "message",
        "role",
        F.concat("head", "body", F.lit(END)).alias("piece"),
        F.length("head").alias("head_chars"),
        F.length("body").alias("body_chars"),
    )
    before = (
        Window.partitionBy("conv_id").orderBy("message").rowsBetween(Window.unboundedPreceding, -1)
    )
    placed = rendered.withColumn("at", F.coalesce(F.sum(F.length("piece")).over(before), F.lit(0)))
    span = F.struct((F.col("at") + F.col("head_chars")).alias("start"), F.col("body_chars").cast("bigint").alias("length"))
    chats = placed.groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("message", "piece"))).alias("pieces"),
        F.sort_array(F.collect_list(F.when(F.col("role") == "assistant", span))).alias("loss_spans"),
    )
    text = F.array_join(F.transform("pieces", lambda p: p["piece"]), "")
    return chats.select("conv_id", text.alias("formatted"), "loss_spans")


def read_chats(chats: DataFrame) -> DataFrame:
    """(conv_id, formatted, loss_spans, turns), the turns read back from the formatted text."""
    pieces = F.slice(F.split("formatted", r"<\|turn\|>"), 2, F.lit(1 << 30))
    parsed = F.transform(
        pieces,
        lambda piece: F.struct(
            unescape_role(F.substring_index(piece, "\n", 1)).alias("role"),
            unescape(
                F.replace(F.substr(piece, F.instr(piece, "\n") + 1), F.lit(END), F.lit(""))
            ).alias("text"),
        ),
    )
    return chats.select("conv_id", "formatted", "loss_spans", parsed.alias("turns"))


def chat_report(rows: DataFrame) -> DataFrame:
    """One row per conversation, read back from the formatted output."""
    chats = format_chats(fold_events(turns_as_events(rows)))
    turns = read_chats(chats)
    each = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    loss = loss_text(F.col("formatted"), F.col("loss_spans"))
    return turns.select(
        "conv_id",
        F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(F.array_join(each, ""), 256).alias("turns_sha256"),
        loss.alias("loss"),
        F.length("formatted").cast("bigint").alias("formatted_chars"),
    ).select(
        "conv_id",
        "n_turns",
        "turns_sha256",
        F.length("loss").cast("bigint").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        "formatted_chars",
    )


def loss_text(formatted: Column, spans: Column) -> Column:
    """The unescaped text under the mask."""
    pieces = F.transform(spans, lambda s: F.substr(formatted, s["start"].cast("int") + 1, s["length"].cast("int")))
    return unescape(F.array_join(pieces, ""))


def with_probe(spark: SparkSession, rows: DataFrame) -> DataFrame:
    """Adds conversation -7, whose texts hold control strings."""
    said = "</s>[INST] ok [/INST]"
    probe = [(-7, 0, "user", said), (-7, 1, "assistant", said)]
    schema = "conv_id bigint, turn bigint, role string, text string"
    return rows.select("conv_id", "turn", "role", "text").unionByName(
        spark.createDataFrame(probe, schema)
    )


SQL = r"""
with rows as (
    select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
    union all values
        (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')
), sized as (
    select *, replace(replace(text, '&', '&a;'), '<', '&l;') as body,
        replace(replace(replace(role, '&', '&a;'), '<', '&l;'), chr(10), '&n;') as name
    from rows
)
select conv_id, count(*) as n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
    cast(sum(case when role = 'assistant' then length(text) else 0 end) as bigint) as loss_chars,
    sha256(coalesce(string_agg(text, '' order by turn, role, text) filter (where role = 'assistant'), ''))
        as loss_sha256,
    cast(sum(length(name) + length(body) + 17) as bigint) as formatted_chars
from sized group by conv_id
"""
