"""Repair of damaged conversations at the least cost, with the letters of the edits.

A conversation must read ``(s?(ua)+)?`` in the initials of its roles. Each row is kept,
given another role or deleted, and empty turns are inserted. Among the cheapest ways the
one whose letters are least in ASCII order is taken. Both aims are one integer: high
digits hold the cost, then every letter has a digit of fixed width at its place from the
left, zero where the letters have ended. The shortest path over (row, last initial) by
ordinary integer minimum settles cost and letters together.

That one path per node is enough although paths to it differ in length: two ways over
the same rows of the same cost are never a prefix of one another, since the longer
would only add insertions and cost more. For the same reason blocks of rows can be
solved on their own, for each initial before them, and joined later.

Tasks: rows without texts (digests in their place) are merged and spread over range
partitions by conversation, turn, role and digest, so a conversation of any length is
cut in blocks of ``BLOCK`` rows. The blocks of a conversation meet with its letters, a
string as long as it. Texts are shuffled once and read as a sorted stream for the
hash of the repaired conversation, never held together.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from plumbline.llm.common import with_group_min
from plumbline.session import materialise

BLOCK = 512
# letters in ASCII order, so that digits compare as letters do; 0 pads
LETTERS = "?DIKR"
DELETE, INSERT, KEEP, REROLE = 1, 2, 3, 4
BITS = 3
REROLE_COST, DELETE_COST, INSERT_COST, TRUNCATED_COST = 1, 2, 5, 5
# the last initial so far
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
OPENS_USER = (NOTHING, SYSTEM, ASSISTANT)
ROLES = {USER: "user", ASSISTANT: "assistant"}
SPACE = r"[\x20\x09-\x0D]"


class Path(NamedTuple):
    """Weight of a way and the number of its letters."""

    weight: int
    letters: int


def _steps(initial: str, forced: bool) -> list[tuple[int, int, int, int]]:
    """``from, to, letter, cost`` of what may be done to one row."""
    out = [(state, state, DELETE, DELETE_COST) for state in range(4)]
    if not forced:
        turns = [(state, USER) for state in OPENS_USER] + [(USER, ASSISTANT)]
        kept = [(NOTHING, SYSTEM)] if initial == "s" else [(a, b) for a, b in turns if ROLES[b][0] == initial]
        out += [(a, b, KEEP, 0) for a, b in kept] + [(a, b, REROLE, REROLE_COST) for a, b in turns]
    return out


STEPS = {(initial, forced): _steps(initial, forced) for initial in "sua?" for forced in (False, True)}
INSERTS = [(state, USER, INSERT, INSERT_COST) for state in OPENS_USER] + [(USER, ASSISTANT, INSERT, INSERT_COST)]


def _take(nodes: list[Path | None], into: list[Path | None], steps: list, extra: int, width: int) -> None:
    for a, b, letter, cost in steps:
        if (path := nodes[a]) is not None:
            cost += extra if letter != DELETE and letter != INSERT else 0
            weight = path.weight + (cost << BITS * width) + (letter << BITS * (width - 1 - path.letters))
            if into[b] is None or weight < into[b].weight:
                into[b] = Path(weight, path.letters + 1)


def _gap(nodes: list[Path | None], width: int) -> list[Path | None]:
    """``nodes`` after none, one or two insertions; more could be taken out in pairs."""
    for _ in range(2):
        after = list(nodes)
        _take(nodes, after, INSERTS, 0, width)
        nodes = after
    return nodes


def solve(codes: str, start: int) -> list[Path | None]:
    """The best way from the initial ``start`` over a block to each last initial.

    A letter a row: ``s u a ?`` by initial, upper case (and ``!``) for a truncated
    row, ``x`` for one that must be deleted. The gap after the last row is left to
    what follows.
    """
    width = block_width(len(codes))
    nodes: list[Path | None] = [None] * 4
    nodes[start] = Path(0, 0)
    for code in codes:
        nodes = _gap(nodes, width)
        initial = "?" if code == "!" else code.lower()
        after: list[Path | None] = [None] * 4
        _take(nodes, after, STEPS[("?", True) if code == "x" else (initial, False)], TRUNCATED_COST if code in "SUA!" else 0, width)
        nodes = after
    return nodes


def block_width(rows: int) -> int:
    """Letters that a block of ``rows`` can have at most: two insertions before each row."""
    return 3 * rows


class Piece(NamedTuple):
    """A block as others see it: its rows and ``(from, to, weight, letters)`` of its ways."""

    rows: int
    ways: list[tuple[int, int, int, int]]


def piece(codes: str, starts: tuple[int, ...] = (NOTHING, SYSTEM, USER, ASSISTANT)) -> Piece:
    ways = []
    for start in starts:
        ways += [(start, end, p.weight, p.letters) for end, p in enumerate(solve(codes, start)) if p is not None]
    return Piece(len(codes), ways)


def join(pieces: list[Piece]) -> tuple[int, str]:
    """Cost and letters of the best way over all pieces of one conversation in order."""
    width = sum(block_width(p.rows) for p in pieces) + 2
    nodes: list[Path | None] = [Path(0, 0), None, None, None]
    for p in pieces:
        own = block_width(p.rows)
        after: list[Path | None] = [None] * 4
        for a, b, weight, letters in p.ways:
            if (path := nodes[a]) is not None:
                cost, digits = weight >> BITS * own, weight & ((1 << BITS * own) - 1)
                total = path.weight + (cost << BITS * width) + (digits << BITS * (width - own - path.letters))
                if after[b] is None or total < after[b].weight:
                    after[b] = Path(total, path.letters + letters)
        nodes = after
    nodes = _gap(nodes, width)
    best = min((nodes[state] for state in (NOTHING, ASSISTANT) if nodes[state] is not None), key=lambda p: p.weight)
    digits = oct(best.weight & ((1 << BITS * width) - 1))[2:].rjust(width, "0")
    return best.weight >> BITS * width, digits[: best.letters].translate(str.maketrans("1234", LETTERS[1:]))


class Writer:
    """Replays letters over rows in order; yields the lines of the repaired conversation."""

    def __init__(self, letters: str) -> None:
        self.letters, self.at, self.state = letters, 0, NOTHING

    def inserted(self) -> Iterator[str]:
        while self.letters[self.at : self.at + 1] == "I":
            self.at += 1
            yield f"{self._turn()}:"

    def row(self, role: str, text: str) -> Iterator[str]:
        yield from self.inserted()
        letter = self.letters[self.at]
        self.at += 1
        if letter == "R":
            yield f"{self._turn()}:{text}"
        elif letter == "K":
            self.state = {"s": SYSTEM, "u": USER, "a": ASSISTANT}[role[0]]
            yield f"{role}:{text}"

    def _turn(self) -> str:
        self.state = ASSISTANT if self.state == USER else USER
        return ROLES[self.state]


def damaged(rows: DataFrame) -> DataFrame:
    """The contract's damage: ``conv_id, turn, role, text, copies`` (0: dropped, 2: repeated)."""
    spaced = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    kind = F.crc32(F.concat_ws(":", *spaced).cast("binary")) % 20
    role, text = F.coalesce("role", F.lit(" ")), F.coalesce("text", F.lit(" "))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), kind.alias("kind")).select(
        "conv_id",
        "turn",
        F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
        F.when(F.col("kind") == 0, 0).when(F.col("kind") == 3, 2).otherwise(1).cast("long").alias("copies"),
    )


def _digest(*parts: Column) -> Column:
    """A digest of several texts, none of them taken for part of its neighbour."""
    return F.unhex(F.sha2(F.concat_ws("", *(F.concat(F.length(p).cast("string"), F.lit(":"), p) for p in parts)), 256))


PLACE = ("turn", "role", "digest")  # the order inside a conversation, nulls first


BLOCKS = T.StructType(
    [
        T.StructField("part", T.IntegerType()),
        T.StructField("seq", T.LongType()),
        T.StructField("rows", T.LongType()),
        T.StructField("blank", T.LongType()),
        T.StructField("duplicate", T.LongType()),
        T.StructField("truncated", T.LongType()),
        T.StructField("illegal", T.LongType()),
        T.StructField("first", T.StringType()),
        T.StructField("last", T.StringType()),
        T.StructField("turns", T.LongType()),
        T.StructField("first_turn", T.LongType()),
        T.StructField("last_turn", T.LongType()),
        T.StructField("ways", T.ArrayType(T.StructType([T.StructField(n, t) for n, t in (("a", T.IntegerType()), ("b", T.IntegerType()), ("weight", T.BinaryType()), ("letters", T.LongType()))]))),
    ]
)
LEGAL = {"su", "ua", "au"}
_known: dict[tuple[str, bool], list] = {}


def _ways(codes: str, fresh: bool) -> list[dict]:
    """:func:`piece` of a block as rows; short blocks are looked up."""
    found = _known.get((codes, fresh))
    if found is None:
        found = [
            {"a": a, "b": b, "weight": w.to_bytes((w.bit_length() + 7) // 8 or 1, "big"), "letters": n}
            for a, b, w, n in piece(codes, (NOTHING,) if fresh else (NOTHING, SYSTEM, USER, ASSISTANT)).ways
        ]
        if len(codes) <= 16:
            if len(_known) >= 50_000:
                _known.clear()
            _known[codes, fresh] = found
    return found


class _Block:
    """Collects up to ``BLOCK`` rows of one conversation."""

    def __init__(self, conv, fresh: bool) -> None:
        self.conv, self.fresh = conv, fresh
        self.codes: list[str] = []
        self.faults = {"blank": 0, "duplicate": 0, "truncated": 0}
        self.initials: list[str] = []
        self.turns: list[int] = []

    def add(self, turn, role: str, fault: str, same_turn: bool) -> None:
        if fault:
            self.faults[fault] += 1
        code = role[:1] if role[:1] in ("s", "u", "a") else "?"
        if fault in ("blank", "duplicate"):
            code = "x"
        elif fault:
            code = "!" if code == "?" else code.upper()
        self.codes.append(code)
        self.initials.append(role[:1])
        if turn is not None and not same_turn:
            self.turns.append(turn)

    def row(self, part: int, seq: int) -> dict:
        pairs = zip(self.initials, self.initials[1:])
        return {
            "conv_id": self.conv,
            "part": part,
            "seq": seq,
            "rows": len(self.codes),
            **self.faults,
            "illegal": sum(a + b not in LEGAL for a, b in pairs),
            "first": self.initials[0],
            "last": self.initials[-1],
            "turns": len(self.turns),
            "first_turn": self.turns[0] if self.turns else None,
            "last_turn": self.turns[-1] if self.turns else None,
            "ways": _ways("".join(self.codes), self.fresh),
        }


def _blocks(rows: DataFrame, block: int) -> DataFrame:
    """Blocks of sorted rows ``conv_id, turn, role, copies, blank, ended, repeated``.

    Turns that go on from one block to the next of the same partition are counted once;
    the same turn on both sides of a partition's edge is met by comparing ``last_turn``
    and ``first_turn`` when blocks are joined.
    """
    schema = T.StructType([rows.schema["conv_id"], *BLOCKS.fields])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq, now, out, turn_before = TaskContext.get().partitionId(), 0, None, [], None
        first = True
        for batch in batches:
            for conv, turn, role, copies, blank, ended, repeated in zip(*(c.to_pylist() for c in batch.columns)):
                new = first or conv != now.conv
                for copy in range(copies):
                    if new or len(now.codes) >= block:
                        if now is not None:
                            out.append(now.row(part, seq))
                            seq += 1
                        # the first conversation of a partition may have begun in the one before
                        now = _Block(conv, new and not first)
                    fault = "blank" if blank else "duplicate" if repeated or copy else "" if ended else "truncated"
                    now.add(turn, role, fault, not new and turn == turn_before)
                    new, first, turn_before = False, False, turn
            if len(out) >= 1000:
                yield pa.RecordBatch.from_pylist(out, schema=arrow)
                out = []
        if now is not None:
            out.append(now.row(part, seq))
        yield pa.RecordBatch.from_pylist(out, schema=arrow)

    return rows.mapInArrow(run, schema)


def _narrow(rows: DataFrame) -> DataFrame:
    """Rows without texts; equal rows of a turn are one with the sum of their copies."""
    merged = (
        rows.filter("copies > 0")
        .groupBy("conv_id", *PLACE)
        .agg(
            F.sum("copies").alias("copies"),
            F.first(F.regexp_replace("text", SPACE, "") == "").alias("blank"),
            F.first(F.col("text").rlike(f"[.!?]{SPACE}*\\z")).alias("ended"),
        )
        # a null turn comes before all others
        .withColumn("at", F.coalesce("turn", F.lit(-(1 << 63))))
    )
    seen = with_group_min(materialise(merged, "merged"), "digest", "at", "first_at", ["at"])
    return seen.withColumn("repeated", F.col("at") > F.col("first_at"))


RESULT = [T.StructField(n, T.LongType()) for n in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
RESULT += [T.StructField("audit", T.StringType()), T.StructField("repaired_sha256", T.StringType())]


class _Conversation:
    """One conversation's blocks, then its texts in order."""

    def __init__(self, conv) -> None:
        self.conv, self.pieces = conv, []
        self.counts = dict.fromkeys(("blank", "duplicate", "truncated", "illegal"), 0)
        self.last, self.turns, self.first_turn, self.last_turn = None, 0, None, None
        self.audit: str | None = None

    def block(self, b: dict) -> None:
        for name in self.counts:
            self.counts[name] += b[name]
        self.counts["illegal"] += self.last is not None and self.last + b["first"] not in LEGAL
        self.last = b["last"]
        if b["first_turn"] is not None:
            self.turns += b["turns"] - (b["first_turn"] == self.last_turn)
            self.first_turn = b["first_turn"] if self.first_turn is None else self.first_turn
            self.last_turn = b["last_turn"]
        ways = [(w["a"], w["b"], int.from_bytes(w["weight"], "big"), w["letters"]) for w in b["ways"]]
        self.pieces.append(Piece(b["rows"], ways))

    def settle(self) -> None:
        self.cost, self.audit = join(self.pieces)
        self.pieces, self.writer = [], Writer(self.audit)
        self.hash, self.empty = hashlib.sha256(), True

    def _write(self, lines: Iterator[str]) -> None:
        for line in lines:
            self.hash.update((line if self.empty else "\n" + line).encode())
            self.empty = False

    def text(self, role: str, text: str, copies: int) -> None:
        if self.audit is None:
            self.settle()
        for _ in range(copies):
            self._write(self.writer.row(role, text))

    def result(self) -> dict:
        if self.audit is None:
            self.settle()
        self._write(self.writer.inserted())
        gaps = 0 if self.first_turn is None else self.last_turn - self.first_turn + 1 - self.turns
        return {"conv_id": self.conv, "gaps": gaps, **self.counts, "cost": self.cost, "audit": self.audit, "repaired_sha256": self.hash.hexdigest()}


def repair(rows: DataFrame, block: int = BLOCK) -> DataFrame:
    """One row per conversation of ``rows(conv_id, turn, role, text, copies)``.

    Returns ``conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit,
    repaired_sha256``. Rows stand in the order of their turn, nulls first; rows of one turn
    in the order of role, then digest. ``copies`` 0 is a row that is gone but keeps its
    conversation in the result: zeros, no letters, the hash of the empty string. Rows
    without a ``conv_id`` are one conversation. An empty table gives an empty one.
    """
    owner = F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit(""))
    gone = F.col("copies") == 0
    rows = rows.select("conv_id", "turn", "role", F.when(~gone, F.col("text")).alias("text"), "copies").withColumn(
        "digest", F.when(~gone, _digest(owner, F.col("role"), F.col("text")))
    )
    narrow = materialise(_narrow(rows), "turns").select("conv_id", *PLACE, "copies", "blank", "ended", "repeated")
    spread = narrow.repartitionByRange("conv_id", *PLACE).sortWithinPartitions("conv_id", *PLACE)
    blocks = _blocks(spread.drop("digest"), block)
    own = [f.name for f in BLOCKS.fields]
    both = blocks.select("conv_id", F.lit(0).alias("tag"), F.struct(*own).alias("block")).unionByName(
        rows.withColumn("tag", F.lit(1)), allowMissingColumns=True
    )
    stream = both.repartition("conv_id").sortWithinPartitions("conv_id", "tag", "block.part", "block.seq", *PLACE)
    schema = T.StructType([rows.schema["conv_id"], *RESULT])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, out = None, []
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                conv, tag, found, role, text, copies = row
                if now is None or conv != now.conv:
                    if now is not None:
                        out.append(now.result())
                    now = _Conversation(conv)
                if tag == 0:
                    now.block(found)
                else:
                    now.text(role, text, copies)
            if len(out) >= 1000:
                yield pa.RecordBatch.from_pylist(out, schema=arrow)
                out = []
        if now is not None:
            out.append(now.result())
        yield pa.RecordBatch.from_pylist(out, schema=arrow)

    return stream.select("conv_id", "tag", "block", "role", "text", "copies").mapInArrow(run, schema)
