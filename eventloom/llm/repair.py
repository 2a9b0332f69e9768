r"""Conversation repair: the cheapest edits that give a conversation a valid structure.

Valid role initials are `(s?(ua)+)?`: nothing, or user and assistant in turn, a system
message first at most. Edits are Keep (0), Rerole to user or assistant (1), Delete (2) and
Insert of an empty user or assistant message (5). Blank and duplicate rows must go; a
truncated row that stays adds 5. Of the cheapest scripts the ASCII-least is taken.

What may follow depends on one of four states: nothing yet, after the system message,
after a user, after an assistant. So an edit script is a walk, and the least cost to the
end is a vector over states. These vectors are computed backwards and stored only at
checkpoints, about the square root of the rows apart. Walking forward, the vectors of one
stretch are computed again from its checkpoint, and at each row the ASCII-least edit is
taken that lies on a cheapest walk.

Rows of a conversation are cut into blocks, so that one conversation may hold any share of
all rows. What a block does to the vector of its end is a 4 x 4 matrix (sums and minima),
made in parallel. One pass per conversation over these matrices, not over rows, gives
every block its vector; blocks then walk in parallel from each state they can be entered
in, and a second pass over their ends picks the walk that is taken. Only the digest of a repaired
conversation has to read its messages in order; rows are streamed for it, never gathered.

`FAULTS`: a row is blank if nothing but white space is in it; duplicate if role and text
occurred earlier; truncated if its last letter is not one of `.!?`; the first that holds
counts. Rows stand by turn, NULLs first, then by role, the text's first 64 letters and a
hash of it.

Defined cases: a NULL role or text is one space; a NULL conv_id is a conversation of its
own; equal rows are duplicates of the first; other roles than system, user and assistant
can only be reroled or deleted; a conversation without rows has an empty script; a script
is one string, so a conversation has as many edits as a string holds at most.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventloom.llm.blocks import stored
from eventloom.llm.ranks import in_order
from eventloom.llm.text import give_back

FAULTS = ("blank", "duplicate", "truncated")
RETYPE, DELETE, INSERT, CUT_OFF = 1, 2, 5, 5  # costs; CUT_OFF for a truncated row that stays
BLOCK_ROWS = 4096
NEVER = 1 << 40

EMPTY, SYSTEM, USER, ASSISTANT = range(4)
# what the message after each state must be, and the state it leads to
NEXT_ROLE = ("user", "user", "assistant", "user")
NEXT_STATE = (USER, USER, ASSISTANT, USER)
ENDS = (EMPTY, ASSISTANT)
KINDS = "sua"  # initials that may be kept; any other is `-`

SPACES = " \t\n\x0b\x0c\r"


# --- the edits of one block -----------------------------------------------------------


def _step(code: str) -> list[tuple[str, int, list[int | None]]]:
    """Edits of a row, ASCII-least first: letter, cost and the state each state leads to.

    A row's code is its kind, in upper case if truncated, `x` if it must go.
    """
    edits: list[tuple[str, int, list[int | None]]] = [("D", DELETE, [0, 1, 2, 3])]
    if code == "x":
        return edits
    kind, extra = code.lower(), CUT_OFF if code in "SUAO" else 0
    keep: list[int | None] = [None] * 4
    if kind == "s":
        keep[EMPTY] = SYSTEM
    else:
        for state in range(4):
            if kind == NEXT_ROLE[state][0]:
                keep[state] = NEXT_STATE[state]
    return [*edits, ("K", extra, keep), ("R", RETYPE + extra, list(NEXT_STATE))]


STEPS = {code: _step(code) for code in "suaoSUAOx"}


def with_inserts(vector: list[int]) -> list[int]:
    """Least costs if messages may be inserted first."""
    _, _, user, assistant = vector
    user, assistant = min(user, assistant + INSERT), min(assistant, user + INSERT)
    return [min(vector[EMPTY], user + INSERT), min(vector[SYSTEM], user + INSERT), user, assistant]


LAST = with_inserts([0 if state in ENDS else NEVER for state in range(4)])
"""Least costs behind the last row."""


def before_row(code: str, vector: list[int]) -> list[int]:
    """Least costs before a row, from those behind it."""
    out = [NEVER] * 4
    for _, cost, to in STEPS[code]:
        for state in range(4):
            if to[state] is not None:
                out[state] = min(out[state], cost + vector[to[state]])
    return with_inserts(out)


def _unit_matrices() -> dict[str, np.ndarray]:
    """Per code: least cost from the state before the row (and inserts) to the state behind it."""
    out = {}
    for code in STEPS:
        columns = [before_row(code, [0 if state == end else NEVER for state in range(4)]) for end in range(4)]
        out[code] = np.array(columns, dtype=np.int64).T
    return out


UNITS = _unit_matrices()


def block_matrix(codes: str) -> np.ndarray:
    """Least costs from each state before the block to each one behind it, by pairing neighbours."""
    parts = np.stack([UNITS[code] for code in codes])
    while len(parts) > 1:
        odd = parts[-1:] if len(parts) % 2 else parts[:0]
        left, right = parts[0 : len(parts) - len(odd) : 2], parts[1::2]
        joined = np.minimum((left[:, :, :, None] + right[:, None, :, :]).min(axis=2), NEVER)
        parts = np.concatenate([joined, odd])
    return parts[0]


def walk(codes: str, tail: list[int], state: int, last: bool) -> tuple[str, int]:
    """The ASCII-least cheapest script from `state`, and the state it ends in.

    `tail` has the least costs behind the block; behind the `last` one messages are inserted
    until the conversation may end.
    """
    step = max(1, isqrt(len(codes)))
    marks = range(0, len(codes), step)
    checkpoints = {len(codes): tail}
    vector = tail
    for at in range(len(codes) - 1, -1, -1):
        vector = before_row(codes[at], vector)
        if at % step == 0:
            checkpoints[at] = vector
    script = []
    for lo in marks:
        hi = min(lo + step, len(codes))
        vectors = [checkpoints[hi]]  # of this stretch, backwards
        for at in range(hi - 1, lo - 1, -1):
            vectors.append(before_row(codes[at], vectors[-1]))
        vectors.reverse()
        for at in range(lo, hi):
            state = _edit(codes[at], vectors[at - lo], vectors[at - lo + 1], state, script)
    while last and state not in ENDS:
        script.append("I")
        state = NEXT_STATE[state]
    return "".join(script), state


def _edit(code: str, here: list[int], behind: list[int], state: int, script: list[str]) -> int:
    """Add the edits up to and with a row; gives the state behind it."""
    while True:
        cost = here[state]
        deleted, *staying = STEPS[code]
        if deleted[1] + behind[state] == cost:
            script.append("D")
            return state
        if INSERT + here[NEXT_STATE[state]] == cost:
            script.append("I")
            state = NEXT_STATE[state]
            continue
        for letter, price, to in staying:
            if to[state] is not None and price + behind[to[state]] == cost:
                script.append(letter)
                return to[state]
        raise AssertionError("no edit is on a cheapest walk")


# --- rows, faults and blocks ----------------------------------------------------------


def _last_letter(text: Column) -> Column:
    return F.right(F.rtrim(text, F.lit(SPACES)), F.lit(1))


def _rows(turns: DataFrame) -> DataFrame:
    """Rows in order, stored, with `initial`, whether they are blank and whether truncated."""
    rows = turns.select(
        F.col("conv_id"),
        F.col("turn"),
        F.coalesce("role", F.lit(" ")).alias("role"),
        F.coalesce("text", F.lit(" ")).alias("text"),
    )
    rows = rows.withColumns({"head": F.left("text", F.lit(64)), "rest": F.xxhash64("text")})  # short sorting keys
    ordered = in_order(rows, ["conv_id", "turn", "role", "head", "rest"])
    last = _last_letter(F.col("text"))
    return ordered.drop("head", "rest").withColumns(
        {
            "initial": F.left("role", F.lit(1)),
            "is_blank": last == "",
            "is_cut": ~last.isin(".", "!", "?"),
        }
    )


def _duplicates(rows: DataFrame) -> DataFrame:
    """`at` of the rows whose role and text occurred earlier in their conversation."""
    said = F.sha2(F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text"), 256)
    named = rows.where("not is_blank").select("conv_id", said.alias("said"), "at")
    firsts = named.groupBy("conv_id", "said").agg(F.min("at").alias("first"), F.count("*").alias("times"))
    firsts = firsts.where("times > 1").select(F.col("conv_id").alias("conv"), F.col("said").alias("what"), "first")
    again = named.join(firsts, F.col("conv_id").eqNullSafe(F.col("conv")) & (F.col("said") == F.col("what")))
    return again.where("at > first").select(F.col("at").alias("again"))


def _coded(rows: DataFrame) -> DataFrame:
    """(conv_id, at, turn, initial, fault, code) of every row, stored."""
    narrow = rows.select("conv_id", "at", "turn", "initial", "is_blank", "is_cut")
    marked = narrow.join(_duplicates(rows), F.col("at") == F.col("again"), "left")
    fault = (
        F.when(F.col("is_blank"), "blank")
        .when(F.col("again").isNotNull(), "duplicate")
        .when(F.col("is_cut"), "truncated")
    )
    kind = F.when(F.col("initial").isin(*KINDS), F.col("initial")).otherwise("o")
    code = (
        F.when(F.col("fault").isin("blank", "duplicate"), "x")
        .when(F.col("fault") == "truncated", F.upper(kind))
        .otherwise(kind)
    )
    coded = marked.withColumn("fault", fault).withColumn("code", code)
    return stored(coded.select("conv_id", "at", "turn", "initial", "fault", "code"), "coded")


def _blocks(coded: DataFrame, block_rows: int) -> DataFrame:
    """(conv_id, head, codes, kinds): runs of rows of one conversation, `head` the first row's number."""
    row = F.struct("at", "code", F.when(F.col("initial").isin(*KINDS), F.col("initial")).otherwise("o").alias("kind"))
    cut = F.expr(f"at div {block_rows}").alias("cut")
    blocks = coded.groupBy("conv_id", cut).agg(F.sort_array(F.collect_list(row)).alias("rows"))
    return blocks.select(
        "conv_id",
        F.col("rows")[0]["at"].alias("head"),
        F.array_join("rows.code", "").alias("codes"),
        F.array_join("rows.kind", "").alias("kinds"),
    )


def _illegal(kinds: str) -> int:
    legal = kinds.count("su") + kinds.count("ua") + kinds.count("au")
    return max(len(kinds) - 1, 0) - legal


MEASURED = "conv_id bigint, head bigint, codes string, ends string, illegal bigint, matrix array<bigint>"
TAILED = "conv_id bigint, head bigint, tail array<bigint>, is_first boolean, is_last boolean, cost bigint, illegal bigint"
WALKED = "conv_id bigint, head bigint, is_first boolean, scripts array<string>, stops array<int>"
PICKED = "head bigint, place bigint, state int"


def _batch(columns: dict[str, list], schema: str) -> pa.RecordBatch:
    kinds = {
        "bigint": pa.int64(), "int": pa.int32(), "string": pa.string(), "boolean": pa.bool_(),
        "array<bigint>": pa.list_(pa.int64()), "array<string>": pa.list_(pa.string()), "array<int>": pa.list_(pa.int32()),
    }
    types = [kinds[field.split()[1]] for field in schema.split(", ")]
    names = [field.split()[0] for field in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(columns[n], t) for n, t in zip(names, types, strict=True)], names=names)


def _each(function, batches: Iterator[pa.RecordBatch], schema: str) -> Iterator[pa.RecordBatch]:
    """Rows that `function` gives for the rows of each batch."""
    names = [field.split()[0] for field in schema.split(", ")]
    for batch in batches:
        rows = [made for row in batch.to_pylist() for made in function(row)]
        yield _batch({name: [row[name] for row in rows] for name in names}, schema)
        give_back()


def _measure(row: dict) -> Iterator[dict]:
    kinds = row["kinds"]
    matrix = block_matrix(row["codes"]).ravel().tolist()
    yield row | {"ends": kinds[0] + kinds[-1], "illegal": _illegal(kinds), "matrix": matrix}


def _give_tails(row: dict) -> Iterator[dict]:
    """Vectors behind the blocks of a conversation, from the last block to the first."""
    vector, blocks = LAST, row["blocks"]
    out = []
    for block in reversed(blocks):
        out.append({"conv_id": row["conv_id"], "head": block["head"], "tail": vector})
        matrix = np.array(block["matrix"], dtype=np.int64).reshape(4, 4)
        vector = np.minimum((matrix + np.array(vector)).min(axis=1), NEVER).tolist()
    seams = sum(_illegal(one["ends"][1] + two["ends"][0]) for one, two in zip(blocks, blocks[1:]))
    illegal = seams + sum(block["illegal"] for block in blocks)
    for n, made in enumerate(out):
        yield made | {"is_first": n == len(out) - 1, "is_last": n == 0, "cost": vector[EMPTY], "illegal": illegal}


def _walk_all(row: dict) -> Iterator[dict]:
    states = [EMPTY] if row["is_first"] else range(4)
    walks = [walk(row["codes"], row["tail"], state, row["is_last"]) for state in states]
    yield row | {"scripts": [script for script, _ in walks], "stops": [stop for _, stop in walks]}


def _pick(row: dict) -> Iterator[dict]:
    """The state in which each block of a conversation is entered."""
    state = EMPTY
    for n, block in enumerate(row["blocks"]):
        place = 0 if n == 0 else state
        yield {"head": block["head"], "place": place, "state": state}
        state = block["stops"][place]


def _scripts(coded: DataFrame, block_rows: int) -> tuple[DataFrame, DataFrame]:
    """(conv_id, head, state, script) of every block, and (conv_id, cost, illegal)."""
    measured = _blocks(coded, block_rows).mapInArrow(lambda b: _each(_measure, b, MEASURED), MEASURED)
    measured = stored(measured, "measured")
    ends = measured.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("head", "ends", "illegal", "matrix"))).alias("blocks"))
    tails = stored(ends.mapInArrow(lambda b: _each(_give_tails, b, TAILED), TAILED), "tails")
    codes = measured.select(F.col("head").alias("own"), "codes")
    joined = tails.join(codes, F.col("head") == F.col("own"))
    walked = stored(joined.mapInArrow(lambda b: _each(_walk_all, b, WALKED), WALKED), "walked")
    stops = walked.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("head", "stops"))).alias("blocks"))
    picked = stops.mapInArrow(lambda b: _each(_pick, b, PICKED), PICKED).withColumnRenamed("head", "own")
    chosen = walked.join(picked, F.col("head") == F.col("own"))
    scripts = chosen.select("conv_id", "head", "state", F.element_at("scripts", (F.col("place") + 1).cast("int")).alias("script"))
    return stored(scripts, "scripts"), tails.where("is_first").select("conv_id", "cost", "illegal")


# --- repaired messages ----------------------------------------------------------------

MESSAGE = "conv_id bigint, at bigint, nth int, edit string, role string, text string"


class _Reader:
    """Follows a script along the rows it was made for."""

    def __init__(self, script: str, state: int):
        self.script, self.at, self.state = script, 0, state

    def inserted(self) -> Iterator[str]:
        while self.at < len(self.script) and self.script[self.at] == "I":
            self.at += 1
            role = NEXT_ROLE[self.state]
            self.state = NEXT_STATE[self.state]
            yield role

    def row(self, role: str) -> tuple[str, str | None]:
        """The edit of the next row, and its role if it stays."""
        edit = self.script[self.at]
        self.at += 1
        if edit == "D":
            return edit, None
        if edit == "R":
            role = NEXT_ROLE[self.state]
        self.state = SYSTEM if role[:1] == "s" else NEXT_STATE[self.state]
        return edit, role


def _ordered_stream(rows: DataFrame, scripts: DataFrame) -> DataFrame:
    """Scripts and the rows behind each, conversations whole and in order."""
    null = F.lit(None)
    texts = rows.select("conv_id", "at", F.lit(1).alias("nth"), "role", "text", null.cast("int").alias("state"))
    plans = scripts.select(
        "conv_id", F.col("head").alias("at"), F.lit(0).alias("nth"),
        null.cast("string").alias("role"), F.col("script").alias("text"), "state",
    )
    return plans.union(texts).repartition("conv_id").sortWithinPartitions("conv_id", "at", "nth")


def _messages(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int | None, int, str, str | None, str]]:
    """(conv_id, at, edit, role, text) in order; deleted rows without a role."""
    reader, conv, at = _Reader("", EMPTY), None, 0
    for batch in batches:
        columns = [batch.column(name).to_pylist() for name in ("conv_id", "at", "nth", "role", "text", "state")]
        for own, place, nth, role, text, state in zip(*columns, strict=True):
            if nth == 0:
                for role in reader.inserted():  # behind the last row of the conversation before
                    yield conv, at, "I", role, ""
                reader, conv, at = _Reader(text, state), own, place
                continue
            for added in reader.inserted():
                yield own, place, "I", added, ""
            edit, kept = reader.row(role)
            conv, at = own, place
            yield own, place, edit, kept, text
        give_back()
    for role in reader.inserted():
        yield conv, at, "I", role, ""


DIGEST = "conv_id bigint, repaired_sha256 string"


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The digest of each repaired conversation, read message by message."""
    convs: list[int | None] = []
    out: list[str] = []
    digest, current, first = None, None, True
    for conv, _, _, role, text in _messages(batches):
        if digest is None or conv != current:
            if digest is not None:
                convs.append(current)
                out.append(digest.hexdigest())
            digest, current, first = hashlib.sha256(), conv, True
            if len(out) == 4096:
                yield _batch({"conv_id": convs, "repaired_sha256": out}, DIGEST)
                convs, out = [], []
        if role is not None:
            digest.update(f"{'' if first else chr(10)}{role}:{text}".encode())
            first = False
    if digest is not None:
        convs.append(current)
        out.append(digest.hexdigest())
    yield _batch({"conv_id": convs, "repaired_sha256": out}, DIGEST)


def repair(turns: DataFrame, *, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """The repaired messages (conv_id, place, edit, role, text); deleted rows are gone.

    `place` ascends within a conversation; `edit` is K, R or I.
    """
    rows = _rows(_four(turns))
    scripts, _ = _scripts(_coded(rows), block_rows)
    schema = "conv_id bigint, place bigint, edit string, role string, text string"

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        columns: dict[str, list] = {name: [] for name in ("conv_id", "place", "edit", "role", "text")}
        place, size = 0, 0
        for conv, _, edit, role, text in _messages(batches):
            place += 1
            if role is None:
                continue
            for name, value in zip(columns, (conv, place, edit, role, text), strict=True):
                columns[name].append(value)
            size += len(text) + 64
            if size > 1 << 22:
                yield _batch(columns, schema)
                columns, size = {name: [] for name in columns}, 0
        yield _batch(columns, schema)

    return _ordered_stream(rows, scripts).mapInArrow(emit, schema)


def _four(turns: DataFrame) -> DataFrame:
    return turns.select(F.col("conv_id").cast("bigint"), "turn", "role", "text")


def repair_summary(turns: DataFrame, conv_ids: DataFrame, *, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """One row per id of `conv_ids`: gaps, faults, illegal pairs, cost, script and digest.

    All parts are rows of one table by conversation and are merged in one aggregation, so
    a NULL id needs no join.
    """
    rows = _rows(_four(turns))
    coded = _coded(rows)
    scripts, totals = _scripts(coded, block_rows)
    digests = _ordered_stream(rows, scripts).mapInArrow(_digests, DIGEST)
    by_turn = coded.groupBy("conv_id", "turn").agg(*[F.count_if(F.col("fault") == name).alias(name) for name in FAULTS])
    faults = by_turn.groupBy("conv_id").agg(
        (F.max("turn") - F.min("turn") + 1 - F.count("turn")).alias("gaps"), *[F.sum(name).alias(name) for name in FAULTS]
    )
    pieces = scripts.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("head", "script"))).alias("parts"))
    audits = pieces.select("conv_id", F.array_join("parts.script", "").alias("audit"))
    every = conv_ids.select(F.col("conv_id").cast("bigint")).distinct()
    merged = every
    for part in (faults, totals, audits, digests):
        merged = merged.unionByName(part, allowMissingColumns=True)
    numbers = ("gaps", *FAULTS, "illegal", "cost")
    return merged.groupBy("conv_id").agg(
        *[F.coalesce(F.max(name), F.lit(0)).cast("bigint").alias(name) for name in numbers],
        F.coalesce(F.max("audit"), F.lit("")).alias("audit"),
        F.coalesce(F.max("repaired_sha256"), F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"),
    )


def damaged(turns: DataFrame) -> DataFrame:
    """Rows damaged by a checksum of their place: dropped, emptied, without full stops, repeated, given to the user."""
    place = F.concat(
        F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")),
        F.lit(":"),
        F.coalesce(F.col("turn").cast("string"), F.lit(" ")),
    )
    kind = (F.crc32(place.cast("binary")) % 20).alias("kind")
    rows = turns.select(
        "conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"), kind
    ).where("kind != 0")
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("kind") == 4, "user").otherwise(F.col("role"))
    times = F.array_repeat(F.lit(0), F.when(F.col("kind") == 3, 2).otherwise(1))
    copies = rows.withColumn("copy", F.explode(times))
    return copies.select("conv_id", "turn", role.alias("role"), text.alias("text"))


def repair_report(turns: DataFrame) -> DataFrame:
    """Every conversation of the table: what damage did to it, and its cheapest repair."""
    return repair_summary(damaged(turns), turns)
