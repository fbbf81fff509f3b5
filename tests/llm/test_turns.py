"""Conversation repair against an exhaustive search and a plain version of the whole operator."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from plumbline.llm import queries, turns
from plumbline.llm.common import table

SF = "/root/testdata/sf0.01"
ROWS = "conv_id long, turn long, role string, text string"


def options(last, row):
    """``last, cost, letter, line`` of all that may be done to a row."""
    role, text, forced, truncated = row
    yield last, 2, "D", None
    if not forced:
        extra, initial = 5 if truncated else 0, role[:1]
        if (initial == "s" and last == "") or (initial == "u" and last != "u") or (initial == "a" and last == "u"):
            yield initial, extra, "K", f"{role}:{text}"
        new = "assistant" if last == "u" else "user"
        yield new[0], 1 + extra, "R", f"{new}:{text}"


def exhaustive(rows):
    """Every way with at most two insertions in a row, compared as plain pairs of cost and letters."""
    found = []

    def go(i, last, cost, letters, lines, run):
        if i == len(rows) and last in ("", "a"):
            found.append((cost, letters, lines))
        if run < 2:
            new = "assistant" if last == "u" else "user"
            go(i, new[0], cost + 5, letters + "I", (*lines, f"{new}:"), run + 1)
        if i < len(rows):
            for state, extra, letter, line in options(last, rows[i]):
                go(i + 1, state, cost + extra, letters + letter, lines if line is None else (*lines, line), 0)

    go(0, "", 0, "", (), 0)
    return min(found, key=lambda x: x[:2])


def by_layers(rows):
    """The best pair of cost and letters per last initial, row by row."""
    layer = {"": (0, "", ())}

    def gap(layer):
        for _ in range(2):
            new = dict(layer)
            for last, (cost, letters, lines) in layer.items():
                role = "assistant" if last == "u" else "user"
                new[role[0]] = min(new.get(role[0], (10**9,)), (cost + 5, letters + "I", (*lines, f"{role}:")), key=lambda x: x[:2])
            layer = new
        return layer

    for row in rows:
        new = {}
        for last, (cost, letters, lines) in gap(layer).items():
            for state, extra, letter, line in options(last, row):
                way = (cost + extra, letters + letter, lines if line is None else (*lines, line))
                new[state] = min(new.get(state, (10**9,)), way, key=lambda x: x[:2])
        layer = new
    layer = gap(layer)
    return min((layer[s] for s in ("", "a") if s in layer), key=lambda x: x[:2])


def code(row):
    role, _, forced, truncated = row
    initial = role[:1] if role[:1] in ("s", "u", "a") else "?"
    return "x" if forced else initial if not truncated else "!" if initial == "?" else initial.upper()


def random_rows(pick, n):
    roles = ["system", "user", "assistant", "tool", ""]
    return [(pick.choice(roles), f"t{k}", pick.random() < 0.25, pick.random() < 0.25) for k in range(n)]


def test_cheapest_letters_and_lines():
    pick = random.Random(5)
    for _ in range(400):
        rows = random_rows(pick, pick.randint(0, 4))
        cost, letters, lines = exhaustive(rows)
        assert by_layers(rows) == (cost, letters, lines)
        codes = "".join(map(code, rows))
        for size in (1, 2, 9):
            assert turns.join([turns.piece(codes[i : i + size]) for i in range(0, len(rows), size)]) == (cost, letters)
        writer = turns.Writer(letters)
        written = [line for role, text, *_ in rows for line in writer.row(role, text)] + list(writer.inserted())
        assert tuple(written) == lines


def test_blocks_join_to_the_same_letters():
    pick = random.Random(6)
    for _ in range(60):
        rows = random_rows(pick, pick.randint(20, 150))
        codes = "".join(map(code, rows))
        assert turns.join([turns.piece(codes[i : i + 16]) for i in range(0, len(rows), 16)]) == by_layers(rows)[:2]


def plain(rows):
    """The query by hand: ``{conv_id: result}`` of ``(conv_id, turn, role, text)``."""
    groups = defaultdict(list)
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        group = groups[conv]
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        tag = "" if conv is None else f"={conv}"
        digest = hashlib.sha256("".join(f"{len(p)}:{p}" for p in (tag, role, text)).encode()).digest()
        group += [((turn is not None, turn or 0), role, digest, turn, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    out = {}
    for conv, group in groups.items():
        group.sort(key=lambda r: r[:3])
        seen, faults, marked = set(), [], []
        for _, role, _, _, text in group:
            solid = re.sub(r"[\x20\x09-\x0D]", "", text)
            fault = "blank" if not solid else "duplicate" if (role, text) in seen else "truncated" if solid[-1] not in ".!?" else ""
            seen.add((role, text))
            faults.append(fault)
            marked.append((role, text, fault in ("blank", "duplicate"), fault == "truncated"))
        numbers = [r[3] for r in group if r[3] is not None]
        initials = [r[1][:1] for r in group]
        cost, letters, lines = by_layers(marked)
        out[conv] = (
            max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0,
            *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
            sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])),
            cost,
            letters,
            hashlib.sha256("\n".join(lines).encode()).hexdigest(),
        )
    return out


def check(got, rows):
    found = {r.conv_id: tuple(r[c] for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")) for r in got.collect()}
    want = plain(rows)
    assert found == want
    assert got.columns[0] == "conv_id" and len(want) == got.count()


def test_query_on_given_table(spark):
    check(queries.op12_conversation_repair(spark, SF), [tuple(r) for r in table(spark, SF, "conversations").select("conv_id", "turn", "role", "text").collect()])


def test_odd_conversations(spark):
    pick = random.Random(9)
    texts = [None, "", " \n", "yes.", "no", "é 日本!", "why? \t", "word " * 4000, "a.\x00"]
    roles = [None, "", "user", "assistant", "system", "tool", "User", "é"]
    rows = [(conv, pick.choice([None, 1, 2, 2, 5, -7]), pick.choice(roles), pick.choice(texts)) for conv in [None, 1, 2, 3] for _ in range(25)]
    rows += [(50 + i, i, "user", "gone?") for i in range(60)]  # some conversations lose their only row
    rows += [(3, 2, "user", "yes.")] * 9
    frame = spark.createDataFrame(rows, ROWS).withColumns({c: F.lit("x") for c in ("tag", "block", "digest", "copies", "salt", "part")})
    check(turns.repair(turns.damaged(frame)), rows)
    check(turns.repair(turns.damaged(frame), block=3), rows)
    assert turns.repair(turns.damaged(spark.createDataFrame([], ROWS))).count() == 0


def test_one_conversation_spread_over_partitions(spark):
    """A conversation with most rows is cut by range, its blocks are solved on their own."""
    pick = random.Random(3)
    rows = [(7, i // 2, pick.choice(["user", "assistant"]), pick.choice(["yes.", "no", "", f"row {i}."])) for i in range(3000)]
    rows += [(i, 0, "user", "hello.") for i in range(100, 200)]
    frame = turns.damaged(spark.createDataFrame(rows, ROWS).repartition(4))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        check(turns.repair(frame, block=64), rows)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


@pytest.mark.parametrize("n", [1, 2, 700])
def test_equal_rows_are_one_with_copies(spark, n):
    rows = [(1, 1, "user", "same."), *[(1, 2, "assistant", "and.")] * n]
    check(turns.repair(turns.damaged(spark.createDataFrame(rows, ROWS)), block=100), rows)
