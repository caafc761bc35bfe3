"""Repair of the turn structure of conversations by a dynamic program with square-root checkpoints.

A conversation is well formed if its roles are an optional system turn and then user and assistant in turn, an even number,
or if it has no turn at all. Edits keep a turn (K), delete it (D), give it the role that is due (R) or insert an empty turn
(I); their cheapest sequence is wanted, the ASCII-least one of those that cost the same ("tight" edits).

What follows a turn costs, for each of the four states in which the turn may be met, a number. These vectors run from the
last turn to the first. They are kept at checkpoints only: turns have consecutive numbers in the order of the whole table,
and a checkpoint lies at every multiple of the square root of the longest conversation's length (``SMALLEST_BLOCK`` at
least). Each block of turns between two checkpoints gives, in parallel, the (min, +) matrix from the vector behind it to
the vector before it; the matrices of one conversation, at most one per checkpoint, are applied from its end to its start.
Then the conversation is walked forward: each block's vectors are computed again from its checkpoint, and the least tight
letter is taken at every turn. At most one block's vectors and one batch of turns are in memory.

What moves: the turns without their texts (equal turns of a conversation as one row with a count) are grouped, sorted and
numbered; the texts are shuffled once, by conversation, to be hashed in order. A checksum over the turns of a conversation
in order is sequential by its definition, so the walk of one conversation is one task; it streams, and nothing but the
audit string (a letter per turn, part of the result) grows with the conversation. Only the length of the longest
conversation comes to the driver.

Order: by turn, nulls first; turns that share a number come in the order of role and of the hash of role and text (the
order of the input has no meaning). Defined results: null roles and texts are one space; null ids are a conversation of
their own; a conversation without turns has zeros, an empty audit and the checksum of the empty string; very long texts are
hashed as they pass; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from lintlake.functions.scale import stage

KEEP, REROLE, DELETE, INSERT, UNFINISHED = 0, 3, 4, 3, 3
SMALLEST_BLOCK = 64
ROW_BITS = 33

# States: no turn yet, after the system turn, after a user turn, after an assistant turn.
_NONE, _SYSTEM, _USER, _ASSISTANT = range(4)
_DUE = {_NONE: _USER, _SYSTEM: _USER, _USER: _ASSISTANT, _ASSISTANT: _USER}
_FAR = 1 << 40
_END = (0, _FAR, _FAR, 0)
_ROLES = {_USER: "user", _ASSISTANT: "assistant"}
_INITIALS = "sua"
_LEGAL = {"su", "ua", "au"}
#: Faults of a turn, the first that holds.
_SOUND, _TRUNCATED, _BLANK, _DUPLICATE = range(4)

WHITE = " \t\n\x0b\x0c\r"


@cache
def _inserted(costs: tuple[int, ...]) -> tuple[int, ...]:
    """Costs with insertions before what the vector stands for."""
    out = list(costs)
    for _ in range(3):
        for state, due in _DUE.items():
            out[state] = min(out[state], INSERT + out[due])
    return tuple(out)


@cache
def _back(code: int, after: tuple[int, ...]) -> tuple[int, tuple[int, ...], tuple[tuple[str, int], ...]]:
    """One turn backwards: (constant, costs before it less the constant, letters and next state for each state).

    ``after`` is the vector behind the turn, with the insertions there, so that it holds least costs. A code is a turn's
    initial and fault; after the constant is taken out there are few vectors, so results are remembered.
    """
    initial, fault = divmod(code, 4)
    extra = UNFINISHED if fault == _TRUNCATED else 0

    def edits(state: int) -> Iterator[tuple[str, int, int]]:
        yield "D", DELETE + after[state], state
        if fault in (_BLANK, _DUPLICATE):
            return
        due = _DUE[state]
        kept = _SYSTEM if initial == 0 and state == _NONE else due if initial == {_USER: 1, _ASSISTANT: 2}[due] else None
        if kept is not None:
            yield "K", KEEP + extra + after[kept], kept
        yield "R", REROLE + extra + after[due], due

    least = _inserted(tuple(min(cost for _, cost, _ in edits(state)) for state in range(4)))
    ways = []
    for start in range(4):
        letters, state = "", start
        while least[start] < _FAR:
            tight = {letter: to for letter, cost, to in edits(state) if cost == least[state]}
            if "D" in tight or least[_DUE[state]] + INSERT != least[state]:
                letter = min(tight)
                letters, state = letters + letter, tight[letter]
                break
            letters, state = letters + "I", _DUE[state]
        ways.append((letters, state))
    constant = min(least)
    return constant, tuple(min(cost - constant, _FAR) for cost in least), tuple(ways)


@cache
def _closing(state: int) -> str:
    """The insertions behind the last turn."""
    return {_NONE: "", _SYSTEM: "II", _USER: "I", _ASSISTANT: ""}[state]


def _vector_before(codes: bytes, after: tuple[int, ...]) -> tuple[int, ...]:
    total = 0
    for code in reversed(codes):
        constant, after, _ = _back(code, after)
        total += constant
    return tuple(min(cost + total, _FAR) for cost in after)


def block_matrix(codes: bytes) -> list[int]:
    """Costs from each state before a block to each state behind it, row by row."""
    columns = [_vector_before(codes, _inserted(tuple(0 if s == to else _FAR for s in range(4)))) for to in range(4)]
    return [columns[to][state] for state in range(4) for to in range(4)]


def checkpoints(matrices: list[list[int]]) -> list[tuple[int, ...]]:
    """The vector behind each block of a conversation, less its smallest cost."""
    vector, out = _inserted(_END), []
    for matrix in reversed(matrices):
        least = min(vector)
        vector = tuple(min(cost - least, _FAR) for cost in vector)
        out.append(vector)
        vector = tuple(min(matrix[4 * s + to] + vector[to] for to in range(4)) for s in range(4))
    return out[::-1]


def walk(codes: bytes, after: tuple[int, ...]) -> list[tuple[tuple[str, int], ...]]:
    """For each turn of a block the letters and the next state from each state, computed from the block's checkpoint."""
    least = min(after)
    after = tuple(min(cost - least, _FAR) for cost in after)
    ways = []
    for code in reversed(codes):
        _, after, way = _back(code, after)
        ways.append(way)
    return ways[::-1]


def damaged(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, copies) of the turns that the damage leaves."""
    blank = F.lit(" ")
    name = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), blank) for c in ("conv_id", "turn")])
    rows = conversations.select(
        "conv_id",
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), blank).alias("role"),
        F.coalesce(F.col("text").cast("string"), blank).alias("text"),
        (F.crc32(F.encode(name, "UTF-8")) % 20).alias("action"),
    )
    action = F.col("action")
    return rows.filter(action != 0).select(
        "conv_id",
        "turn",
        F.when(action == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(action == 1, "").when(action == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        F.when(action == 3, 2).otherwise(1).cast("long").alias("copies"),
    )


def _digest() -> Column:
    """Sixteen bytes of a hash of role and text."""
    text = F.concat_ws(":", F.length("role").cast("string"), "role", "text")
    return F.substring(F.unhex(F.sha2(F.encode(text, "UTF-8"), 256)), 1, 16)


_KEY = ["turn", "role", "digest"]


def _numbered(turns: DataFrame) -> DataFrame:
    """Different turns of each conversation with their numbers of copies, numbered in order over the whole table."""
    last = F.substring(F.rtrim("text", F.lit(WHITE)), -1, 1)
    fault = F.when(last == "", _BLANK).when(last.isin(".", "!", "?"), _SOUND).otherwise(_TRUNCATED)
    keys = turns.select("conv_id", *_KEY, fault.alias("fault"), "copies")
    distinct = keys.groupBy("conv_id", *_KEY, "fault").agg(F.sum("copies").alias("copies"))
    return stage(distinct.orderBy("conv_id", *_KEY).withColumn("seq", F.monotonically_increasing_id()), "dialogue-turns")


def _blocks(numbered: DataFrame) -> DataFrame:
    """(conv_id, seq, turn, role, digest, codes, copies): blocks of turns, named by their first one."""
    longest = numbered.groupBy("conv_id").count().agg(F.max("count")).first()[0] or 0
    size = max(SMALLEST_BLOCK, math.isqrt(longest))
    firsts = numbered.groupBy("conv_id", "role", "digest").agg(F.min("seq").alias("seq")).select("seq", F.lit(True).alias("is_first"))
    fault = F.when((F.col("fault") != _BLANK) & F.col("is_first").isNull(), _DUPLICATE).otherwise(F.col("fault"))
    initial = F.instr(F.lit(_INITIALS), F.substring("role", 1, 1)) - 1
    initial = F.when((F.length("role") == 0) | (initial < 0), 3).otherwise(initial)
    rows = numbered.join(firsts, "seq", "left").withColumn("code", (initial * 4 + fault).cast("int"))
    blocks = rows.groupBy("conv_id", F.expr(f"seq div {size}").alias("block")).agg(
        F.min(F.struct("seq", *_KEY)).alias("head"),
        F.sort_array(F.collect_list(F.struct("seq", "code", "copies"))).alias("turns"),
    )
    return stage(
        blocks.select("conv_id", "head.*", F.col("turns.code").alias("codes"), F.col("turns.copies").alias("copies")),
        "dialogue-blocks",
    )


def _matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [block_matrix(bytes(codes)) for codes in batch.column("codes").to_pylist()]
        yield batch.drop_columns(["codes"]).append_column("matrix", pa.array(found, pa.list_(pa.int64())))


def _vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        seq, after = [], []
        for blocks in batch.column("blocks").to_pylist():
            seq += [b["seq"] for b in blocks]
            after += checkpoints([b["matrix"] for b in blocks])
        yield pa.RecordBatch.from_arrays([pa.array(seq, pa.int64()), pa.array(after, pa.list_(pa.int64()))], ["seq", "after"])


def _checkpointed(blocks: DataFrame) -> DataFrame:
    """With the vector behind each block; null for a conversation's only block, which the end follows."""
    counts = blocks.groupBy("conv_id").agg(F.count("*").alias("n")).filter("n > 1").select(F.col("conv_id").alias("long_conv"))
    several = blocks.join(counts, F.col("conv_id").eqNullSafe(F.col("long_conv")), "left_semi").select("conv_id", "seq", "codes")
    kind = blocks.schema["conv_id"].dataType.simpleString()
    matrices = several.mapInArrow(_matrices, f"conv_id {kind}, seq long, matrix array<long>")
    chains = matrices.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("seq", "matrix"))).alias("blocks"))
    return blocks.join(chains.select("blocks").mapInArrow(_vectors, "seq long, after array<long>"), "seq", "left")


class _Conversation:
    """One conversation's walk: fed its blocks and its turns in order."""

    def __init__(self, conv_id: object) -> None:
        self.conv_id = conv_id
        self.ways: list = []
        self.codes: bytes = b""
        self.copies: list[int] = []
        self.at = 0
        self.state = _NONE
        self.audit: list[str] = []
        self.faults = [0, 0, 0, 0]
        self.illegal = self.cost = 0
        self.initial: str | None = None
        self.turns: tuple[int, int, int] | None = None  # least, most, how many different
        self.hash, self.lines = hashlib.sha256(), 0
        self.key: tuple | None = None

    def block(self, codes: list[int], copies: list[int], after: list[int] | None) -> None:
        self.codes, self.copies, self.at = bytes(codes), copies, 0
        self.ways = walk(self.codes, tuple(after) if after else _inserted(_END))

    def _line(self, role: str, text: str) -> None:
        self.hash.update(f"{chr(10) if self.lines else ''}{role}:{text}".encode())
        self.lines += 1

    def _insert(self, letters: str) -> None:
        for _ in letters:
            self.state = _DUE[self.state]
            self._line(_ROLES[self.state], "")
        self.cost += INSERT * len(letters)

    def turn(self, turn: int | None, role: str, digest: bytes, text: str) -> None:
        if self.key == (turn, role, digest):  # a copy, counted with the first
            return
        self.key = (turn, role, digest)
        fault, copies, way = self.codes[self.at] % 4, self.copies[self.at], self.ways[self.at]
        self.at += 1
        letters, then = way[self.state]
        self._insert(letters[:-1])
        edit, self.state = letters[-1], then
        if edit == "D":
            self.cost += DELETE
        else:
            self.cost += (REROLE if edit == "R" else KEEP) + (UNFINISHED if fault == _TRUNCATED else 0)
            self._line(_ROLES[then] if edit == "R" else role, text)
        self.audit.append(letters + "D" * (copies - 1))
        self.cost += DELETE * (copies - 1)
        self.faults[fault] += 1
        self.faults[_BLANK if fault == _BLANK else _DUPLICATE] += copies - 1
        initial = role[:1]
        self.illegal += copies - 1
        if self.initial is not None:
            self.illegal += self.initial + initial not in _LEGAL
        self.initial = initial
        if turn is not None:
            least, most, different = self.turns or (turn, turn - 1, 0)
            self.turns = (least, turn, different + (turn != most))

    def result(self) -> dict:
        closing = _closing(self.state)
        self._insert(closing)
        least, most, different = self.turns or (0, -1, 0)
        return {
            "conv_id": self.conv_id, "gaps": most - least + 1 - different, "blank": self.faults[_BLANK],
            "duplicate": self.faults[_DUPLICATE], "truncated": self.faults[_TRUNCATED], "illegal": self.illegal,
            "cost": self.cost, "audit": "".join(self.audit) + closing, "repaired_sha256": self.hash.hexdigest(),
        }


_RESULT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


def _walked(schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, out, letters = None, [], 0
        for batch in batches:
            for row in zip(*(batch.column(name).to_pylist() for name in batch.schema.names), strict=True):
                conv_id, turn, role, digest, kind, text, codes, copies, after = row
                if current is None or conv_id != current.conv_id:
                    if current is not None:
                        out.append(current.result())
                        letters += len(out[-1]["audit"])
                    current = _Conversation(conv_id)
                if kind == 2:
                    current.turn(turn, role, digest, text)
                elif kind == 1:
                    current.block(codes, copies, after)
                if len(out) >= 4096 or letters > 1 << 22:
                    yield pa.RecordBatch.from_pylist(out, schema)
                    out, letters = [], 0
        if current is not None:
            out.append(current.result())
        if out:
            yield pa.RecordBatch.from_pylist(out, schema)

    return run


def repair(conversations: DataFrame, turns: DataFrame) -> DataFrame:
    """One row per ``conv_id`` of ``conversations``: faults of its ``turns``, their cheapest repair and its checksum.

    ``turns (conv_id, turn, role, text, copies)``, as ``damaged`` returns them.
    """
    turns = turns.withColumn("digest", _digest())
    blocks = _checkpointed(_blocks(_numbered(turns)))
    none = {"codes": "array<int>", "copies": "array<long>", "after": "array<long>", "turn": "long", "role": "string"}
    none |= {"digest": "binary", "text": "string"}

    names = ["conv_id", *_KEY, "kind", "text", "codes", "copies", "after"]

    def part(df: DataFrame, kind: int) -> DataFrame:
        """Conversations (0), blocks (1) and turns (2) as rows of one table."""
        df = df.withColumn("kind", F.lit(kind))
        return df.select(*[F.col(c) if c in df.columns else F.lit(None).cast(none[c]).alias(c) for c in names])

    everything = (
        part(conversations.select("conv_id").distinct(), 0)
        .unionByName(part(blocks.drop("seq"), 1))
        .unionByName(part(turns.drop("copies"), 2))
    )
    ordered = everything.repartition("conv_id").sortWithinPartitions("conv_id", *_KEY, "kind")
    result = StructType.fromDDL(f"conv_id {conversations.schema['conv_id'].dataType.simpleString()}, {_RESULT}")
    return ordered.mapInArrow(_walked(to_arrow_schema(result)), result)
