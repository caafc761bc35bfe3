from __future__ import annotations

import hashlib
import random
import re
import zlib

import pytest

from lintlake.llm import dialogue, queries

SCHEMA = "conv_id long, turn long, role string, text string, seq string, kind int, n long"
INK = re.compile(r"[^\x20\x09-\x0D]")
NEXT = {"": "u", "s": "u", "u": "a", "a": "u"}


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        key = ":".join(" " if x is None else str(x) for x in (conv, turn))
        action = zlib.crc32(key.encode()) % 20
        role, text = (" " if x is None else x for x in (role, text))
        if action == 1:
            text = ""
        if action == 2:
            text = re.sub("[.!?]", "", text)
        if action == 4:
            role = "user"
        out += [(conv, turn, role, text)] * {0: 0, 3: 2}.get(action, 1)
    return out


def order(row):
    _, turn, role, text = row
    digest = hashlib.sha256(f"{len(role)}:{role}:{text}".encode()).digest()[:16]
    return (turn is not None, turn or 0, role, digest)


def brute(rows):
    """Every suffix's cheapest and least repair by plain recursion from the end, strings compared as strings."""
    rows = sorted(rows, key=order)
    seen, faults = set(), []
    for _, _, role, text in rows:
        ink = INK.findall(text)
        fault = "blank" if not ink else "duplicate" if (role, text) in seen else "truncated" if ink[-1] not in ".!?" else ""
        seen.add((role, text))
        faults.append(fault)
    best = {q: (0, "", ()) if q in ("", "a") else (1 << 30, "", ()) for q in NEXT}

    def inserted(best):
        for _ in range(4):
            for q, due in NEXT.items():
                cost, letters, lines = best[due]
                best[q] = min(best[q], (cost + 3, "I" + letters, ((due, None), *lines)), key=lambda x: x[:2])
        return best

    best = inserted(best)
    for i in range(len(rows) - 1, -1, -1):
        role, text, fault = rows[i][2], rows[i][3], faults[i]
        now = {}
        for q, due in NEXT.items():
            cost, letters, lines = best[q]
            options = [(cost + 4, "D" + letters, lines)]
            if fault not in ("blank", "duplicate"):
                extra = 3 if fault else 0
                first = role[:1]
                if first == due or (first == "s" and q == ""):
                    cost, letters, lines = best[first]
                    options.append((cost + extra, "K" + letters, ((role, text), *lines)))
                cost, letters, lines = best[due]
                options.append((cost + 3 + extra, "R" + letters, ((due, text), *lines)))
            now[q] = min(options, key=lambda x: x[:2])
        best = inserted(now)
    cost, audit, lines = best[""]
    names = {"u": "user", "a": "assistant"}
    written = "\n".join(f"{names.get(r, r)}:{t or ''}" for r, t in lines)
    initials = [r[2][:1] for r in rows]
    turns = {r[1] for r in rows} - {None}
    return {
        "gaps": max(turns) - min(turns) + 1 - len(turns) if turns else 0,
        **{f: faults.count(f) for f in ("blank", "duplicate", "truncated")},
        "illegal": sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])),
        "cost": cost, "audit": audit, "repaired_sha256": hashlib.sha256(written.encode()).hexdigest(),
    }


def conversations(seed: int, n: int = 60, most: int = 12):
    rng = random.Random(seed)
    rows = []
    for conv in [None, *range(n)]:
        for turn in range(rng.randint(1, most)):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", "agent", None, "User"])
            text = rng.choice(["Yes.", "no", " ", None, "", "a b!\n ", " ", "end. ", "x?y", "long word " * 30 + "."])
            text = text if rng.random() < 0.5 else f"{text}{turn} {conv}{rng.choice(['.', '', '?'])}"
            rows.append((conv, None if rng.random() < 0.05 else turn + rng.randint(0, 1), role, text))
    return rows


def check(spark, rows, repaired=None):
    frame = spark.createDataFrame([(*r, "x", 1, 2) for r in rows], SCHEMA).repartition(3)
    found = repaired(frame) if repaired else dialogue.repair(frame, dialogue.damaged(frame))
    got = {r["conv_id"]: r.asDict() for r in found.collect()}
    groups: dict = {r[0]: [] for r in rows}
    assert got.keys() == groups.keys()
    for row in damaged(rows):
        groups[row[0]].append(row)
    for conv, turns in groups.items():
        assert got[conv] == {"conv_id": conv, **brute(turns)}


@pytest.mark.parametrize("block", [1, 3, 64])
def test_repair_is_the_cheapest_and_least(spark, monkeypatch, block):
    monkeypatch.setattr(dialogue, "SMALLEST_BLOCK", block)
    check(spark, conversations(block))


def test_one_long_conversation_and_many_equal_turns(spark, monkeypatch):
    monkeypatch.setattr(dialogue, "SMALLEST_BLOCK", 8)
    rng = random.Random(3)
    rows = [(5, t, rng.choice(["user", "assistant", "system"]), rng.choice([f"{t}.", f"{t}", "again."])) for t in range(700)]
    rows += [(6, 1, "user", "same")] * 300 + [(7, None, "user", "same.")] * 200
    check(spark, rows)


def test_any_types_and_no_rows(spark):
    empty = spark.createDataFrame([], "conv_id string, turn int, role string, text string")
    assert dialogue.repair(empty, dialogue.damaged(empty)).count() == 0
    named = spark.createDataFrame([("c", 1, "user", "Hi.")], "conv_id string, turn int, role string, text string")
    row = dialogue.repair(named, dialogue.damaged(named)).collect()[0].asDict()
    assert row == {"conv_id": "c", **brute(damaged([("c", 1, "user", "Hi.")]))}


def test_a_conversation_whose_turns_are_all_dropped(spark):
    conv = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    check(spark, [(conv, 0, "user", "Hi.")])


def test_checkpoints_equal_vectors_of_the_whole():
    rng = random.Random(1)
    for _ in range(50):
        codes = bytes(rng.randrange(16) for _ in range(rng.randint(2, 60)))
        cut = rng.randint(1, len(codes) - 1)
        parts = [codes[:cut], codes[cut:]]
        behind = dialogue.checkpoints([dialogue.block_matrix(p) for p in parts])
        assert dialogue.walk(parts[0], behind[0]) == dialogue.walk(codes, dialogue._inserted(dialogue._END))[:cut]


def test_the_query(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet")
    plain = [(r["conv_id"], r["turn"], r["role"], r["text"]) for r in rows.collect()]
    check(spark, plain, lambda _: queries.op11_checkpointed_repair(spark, "/root/testdata/sf0.001"))
