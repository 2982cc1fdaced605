"""The conversation repair against a plain search over all edits, on conversations with every odd case."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from verdigris.llm import conversation_repair

BLANK = " \t\n\x0b\x0c\r"
WANTED = {0: "user", 1: "user", 2: "assistant", 3: "user"}
NEXT = {0: 2, 1: 2, 2: 3, 3: 2}
SCHEMA = "conv_id long, turn long, role string, text string, conv string, part long"


def damaged(rows):
    out = {}
    for conv, turn, role, text, *_ in rows:
        kept = out.setdefault(conv, [])
        fate = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if fate == 1 else re.sub("[.!?]", "", text) if fate == 2 else text
        if fate:
            kept += [(turn, "user" if fate == 4 else role, text)] * (2 if fate == 3 else 1)
    for kept in out.values():
        kept.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.sha256(r[2].encode()).digest()))
    return out


def inserted(best):
    """States with up to three rows put in first."""
    for _ in range(3):
        for state, (cost, audit, lines) in list(best.items()):
            offer = (cost + 5, audit + "I", lines + [WANTED[state] + ":"])
            if NEXT[state] not in best or offer[:2] < best[NEXT[state]][:2]:
                best[NEXT[state]] = offer
    return best


def searched(rows):
    """One conversation: every edit of every row from every state, the cheapest and ASCII-least kept."""
    seen, faults = set(), []
    for _, role, text in rows:
        body = text.strip(BLANK)
        faults.append("blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else "")
        seen.add((role, text))
    best = {0: (0, "", [])}
    for (_, role, text), fault in zip(rows, faults):
        offers = []
        for state, (cost, audit, lines) in inserted(best).items():
            offers.append((state, cost + 2, audit + "D", lines))
            if fault in ("blank", "duplicate"):
                continue
            cost += 5 * (fault == "truncated")
            if role[:1] == "s" and state == 0:
                offers.append((1, cost, audit + "K", lines + [f"{role}:{text}"]))
            if role[:1] == WANTED[state][0]:
                offers.append((NEXT[state], cost, audit + "K", lines + [f"{role}:{text}"]))
            offers.append((NEXT[state], cost + 1, audit + "R", lines + [f"{WANTED[state]}:{text}"]))
        best = {}
        for state, *offer in offers:
            if state not in best or tuple(offer[:2]) < best[state][:2]:
                best[state] = tuple(offer)
    cost, audit, lines = min((b for state, b in inserted(best).items() if state in (0, 3)), key=lambda b: b[:2])
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    return (gaps, faults.count("blank"), faults.count("duplicate"), faults.count("truncated"), illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())


def made(seed=5):
    r = random.Random(seed)
    texts = ["Well, yes.", "No!", "Is it?", "cut off", "", " \t\n", "ends in space. \n", "é🙂?", "two\nlines.", None, " ", "a.b"]
    roles = ["system", "user", "assistant", "user", "assistant", "tool", "", None, "sage", "Ute"]
    rows = []
    for conv in [None, *range(60)]:
        for turn in range(r.randint(1, 14)):
            rows.append((conv, r.choice([turn, turn, turn, turn // 2, None, turn * 3]), r.choice(roles[: r.choice([3, 10])]), r.choice(texts) if r.random() < 0.4 else f"text {r.random()}{r.choice('.?!x')}"))
    rows += rows[10:25]
    # one conversation with a third of all rows and more than two segments, one with equal rows only, one long text
    rows += [(1000, turn, ("user", "assistant", "system")[r.randrange(3)], f"long {turn % 900}{r.choice('.x')}") for turn in range(2300)]
    rows += [(1001, 7, "user", "same.")] * 50 + [(1002, 1, "user", "q? " + "word " * 200_000), (1002, 2, "assistant", "done.")]
    return [(*row, "clash", 3) for row in rows]


@pytest.mark.parametrize("parts", [1, 7])
def test_repair_equals_a_plain_search(spark, parts):
    rows = made()
    df = spark.createDataFrame(rows, SCHEMA).repartition(parts)
    found = [tuple(r) for r in conversation_repair.repair(df).collect()]
    want = {conv: searched(kept) for conv, kept in damaged(rows).items()}
    assert len(found) == len(want)
    assert {r[0]: r[1:] for r in found} == want


def test_segments_of_few_rows_join_to_the_same_repair(spark, monkeypatch):
    monkeypatch.setattr(conversation_repair, "SEGMENT_ROWS", 4)
    rows = [r for r in made(9) if r[0] is None or r[0] < 1000]
    found = {r[0]: tuple(r[1:]) for r in conversation_repair.repair(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert found == {conv: searched(kept) for conv, kept in damaged(rows).items()}


def test_no_rows_after_damage_and_no_rows_at_all(spark):
    dropped = next(t for t in range(1000) if zlib.crc32(f"5:{t}".encode()) % 20 == 0)
    df = spark.createDataFrame([(5, dropped, "user", "gone.", "", 0)], SCHEMA)
    assert [tuple(r) for r in conversation_repair.repair(df).collect()] == [(5, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]
    empty = conversation_repair.repair(df.where(F.lit(False)))
    assert empty.collect() == [] and empty.columns[0] == "conv_id"


def test_block_table_equals_single_steps():
    table = conversation_repair.tables()
    r = random.Random(3)
    for _ in range(200):
        symbols = [r.randrange(conversation_repair.SYMBOLS) for _ in range(conversation_repair.BLOCK)]
        start = r.randrange(len(table.vectors))
        vector = table.vectors[start]
        for symbol in reversed(symbols):
            vector = conversation_repair._before(vector, symbol)
        number = 0
        for symbol in symbols:
            number = number * conversation_repair.SYMBOLS + symbol
        cost = table.block_cost[start, number]
        assert tuple(c + cost for c in table.vectors[table.block[start, number]]) == vector
