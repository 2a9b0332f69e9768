"""Conversation repair against a plain search over all scripts."""

import hashlib
import random
import re
import zlib
from functools import cache

import pytest
from pyspark.sql import functions as F

from eventloom.llm import repair

STAYS = re.compile(r"[^\x20\x09-\x0D]")
CONVERSATIONS = "/root/testdata/sf0.001/conversations.parquet"


def plain_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = (" " if v is None else v for v in (role, text))
        place = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(place.encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out += [(conv, turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return out


def faults_of(rows):
    seen, out = set(), []
    for _, _, role, text in rows:
        letters = STAYS.findall(text)
        if not letters:
            out.append("blank")
        elif (role, text) in seen:
            out.append("duplicate")
        else:
            out.append("truncated" if letters[-1] not in ".!?" else None)
        seen.add((role, text))
    return out


def plain_repair(rows):
    """(cost, script, messages): the least over all scripts, by cost and then as text."""
    faults = faults_of(rows)
    after = {"": ("u", "s"), "s": ("u",), "u": ("a",), "a": ("u",)}
    name = {"u": "user", "a": "assistant"}

    @cache
    def best(i, state, inserted):
        options = []
        if i == len(rows) and state in ("", "a"):
            options.append((0, "", ()))
        if inserted < 3:
            for initial in after[state]:
                if initial != "s":
                    cost, script, kept = best(i, initial, inserted + 1)
                    options.append((cost + 5, "I" + script, (f"{name[initial]}:", *kept)))
        if i < len(rows):
            _, _, role, text = rows[i]
            cost, script, kept = best(i + 1, state, 0)
            options.append((cost + 2, "D" + script, kept))
            if faults[i] not in ("blank", "duplicate"):
                extra = 5 if faults[i] else 0
                if role[:1] in after[state]:
                    cost, script, kept = best(i + 1, role[:1], 0)
                    options.append((cost + extra, "K" + script, (f"{role}:{text}", *kept)))
                for initial in after[state]:
                    if initial != "s":
                        cost, script, kept = best(i + 1, initial, 0)
                        options.append((cost + extra + 1, "R" + script, (f"{name[initial]}:{text}", *kept)))
        return min(options, default=(10**9, "", ()))

    return best(0, "", 0)


def plain_report(rows, damage=True):
    ids = {row[0] for row in rows}
    rows = plain_damage(rows) if damage else [(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows]
    out = []
    for conv in ids:
        own = [row for row in rows if row[0] == conv]
        own.sort(key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3][:64]))
        turns = [t for _, t, _, _ in own if t is not None]
        faults = faults_of(own)
        initials = [r[:1] for _, _, r, _ in own]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        cost, script, kept = plain_repair(tuple(own))
        out.append(
            (conv, max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
             *[faults.count(name) for name in repair.FAULTS], illegal, cost, script,
             hashlib.sha256("\n".join(kept).encode()).hexdigest())
        )
    return sorted(out, key=repr)


def odd_turns(seed=1, count=60):
    """NULLs in any column, ties, repeats, blanks, cut ends, other roles."""
    rng = random.Random(seed)
    rows = []
    for conv in [None, *range(count)]:
        said = []
        for turn in range(rng.choice([0, 1, 2, 3, 5, 9])):
            role = rng.choice(["user", "assistant"]) if rng.random() < 0.3 else ["user", "assistant"][turn % 2]
            role = rng.choice([role] * 8 + ["system", "tool", "", None])
            text = rng.choice(["One.", "Two!", "Three? \n", "cut", "Ü. a", "", " \t", None, f"x{rng.random()}.", f"y{rng.random()}"])
            said.append((conv, rng.choice([turn] * 8 + [None, 0, turn + 3]), role, text))
        rows += said + said[:1] * (rng.random() < 0.2)
    rng.shuffle(rows)
    return rows


def table(spark, rows):
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").repartition(3)
    return df.withColumns({name: F.lit("x") for name in ("at", "head", "part", "script", "state", "kind", "rest")})


def results(df):
    columns = ["conv_id", "gaps", *repair.FAULTS, "illegal", "cost", "audit", "repaired_sha256"]
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


@pytest.mark.parametrize("block_rows", [1, 3, 4096])
def test_cheapest_scripts(spark, block_rows):
    rows = odd_turns(block_rows)
    turns = table(spark, rows)
    assert results(repair.repair_summary(turns, turns, block_rows=block_rows)) == plain_report(rows, damage=False)


def test_report_on_given_table(spark):
    df = spark.read.parquet(CONVERSATIONS)
    rows = [tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()]
    assert results(repair.repair_report(df)) == plain_report(rows)


def test_report_on_odd_rows(spark):
    rows = odd_turns(9)
    assert results(repair.repair_report(table(spark, rows))) == plain_report(rows)


def test_conversations_without_rows(spark):
    rows = next([(n, 0, "user", "Hi.")] for n in range(100) if zlib.crc32(f"{n}:0".encode()) % 20 == 0)
    zeros = (rows[0][0], 0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest())
    assert results(repair.repair_report(table(spark, rows))) == [zeros]
    assert results(repair.repair_report(table(spark, rows).where("false"))) == []


def test_repaired_messages_are_valid(spark):
    rows = odd_turns(4)
    messages = repair.repair(table(spark, rows), block_rows=2).collect()
    wanted = {row[0]: row for row in plain_report(rows, damage=False)}
    by_conv = {}
    for row in sorted(messages, key=lambda r: r.place):
        by_conv.setdefault(row.conv_id, []).append(row)
    for conv, own in by_conv.items():
        assert re.fullmatch("(s?(ua)+)?", "".join(r.role[:1] for r in own))
        assert "".join(r.edit for r in own) == wanted[conv][7].replace("D", "")
        text = "\n".join(f"{r.role}:{r.text}" for r in own)
        assert hashlib.sha256(text.encode()).hexdigest() == wanted[conv][8]
    assert {c for c, w in wanted.items() if set(w[7]) - {"D"}} == set(by_conv)


def test_one_long_conversation(spark):
    rng = random.Random(3)
    rows = [(7, n, rng.choice(["user", "assistant", "tool"]), f"{n}" + rng.choice([".", ""])) for n in range(3000)]
    got = results(repair.repair_summary(table(spark, rows), table(spark, rows), block_rows=100))
    whole = results(repair.repair_summary(table(spark, rows), table(spark, rows)))
    assert got == whole and len(got[0][7]) >= 3000


def test_checkpoints_are_square_root_apart():
    calls = []
    codes = "".join(random.Random(1).choices("suaoSUAOx", k=1000))
    tail = repair.LAST
    script, state = repair.walk(codes, tail, repair.EMPTY, True)
    assert state in repair.ENDS
    matrix = repair.block_matrix(codes)
    cost = min(int(matrix[repair.EMPTY][s]) + tail[s] for s in range(4))
    price = {"D": 2, "I": 5, "K": 0, "R": 1}
    kept = [c for c, e in zip(codes, script.replace("I", ""), strict=True) if e != "D"]
    assert cost == sum(price[e] for e in script) + 5 * sum(c in "SUAO" for c in kept)
