from __future__ import annotations

import hashlib
import heapq
import random
import re
import zlib
from collections import defaultdict

from cardloom.llm import repair

GOAL = re.compile(r"(s?(ua)+)?")
NAMES = {"u": "user", "a": "assistant"}


def cheapest(rows):
    """(cost, audit, repaired) by search over whole edit strings; ``rows`` are (role, text, must go, truncated)."""
    heap, seen = [(0, "", 0, "", ())], set()
    while heap:
        cost, audit, i, roles, lines = heapq.heappop(heap)
        if (i, roles[-1:], bool(roles)) in seen:
            continue
        # what may follow depends on the last initial alone
        if i == len(rows) and GOAL.fullmatch(roles):
            return cost, audit, "\n".join(lines)
        seen.add((i, roles[-1:], bool(roles)))

        def go(more, edit, at, letter="", line=None):
            new = roles + letter
            if GOAL.fullmatch(new) or GOAL.fullmatch(new + "a") or GOAL.fullmatch(new + "ua"):
                heapq.heappush(heap, (cost + more, audit + edit, at, new, lines + ((line,) if line is not None else ())))

        for letter, name in NAMES.items():
            go(3, "I", i, letter, f"{name}:")
        if i < len(rows):
            role, text, gone, truncated = rows[i]
            go(4, "D", i + 1)
            if not gone:
                if role[:1] in ("s", "u", "a"):
                    go(3 * truncated, "K", i + 1, role[0], f"{role}:{text}")
                for letter, name in NAMES.items():
                    go(3 + 3 * truncated, "R", i + 1, letter, f"{name}:{text}")


def brute(table):
    damaged, ids = defaultdict(list), {row[0] for row in table}
    space = lambda v: " " if v is None else str(v)
    for conv, turn, role, text in table:
        chance = zlib.crc32(f"{space(conv)}:{space(turn)}".encode()) % 20
        role, text = space(role), space(text)
        if chance == 1:
            text = ""
        if chance == 2:
            text = re.sub("[.!?]", "", text)
        if chance == 4:
            role = "user"
        for _ in range((chance > 0) + (chance == 3)):
            key = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()[:16]
            damaged[conv].append((turn is not None, turn or 0, key, turn, role, text))
    want = set()
    for conv in ids:
        rows, seen, marked, faults = sorted(damaged[conv]), set(), [], [0, 0, 0]
        for *_, role, text in rows:
            words = re.findall(r"[^\x20\x09-\x0D]", text)
            fault = 0 if not words else 1 if (role, text) in seen else 2 if words[-1] not in ".!?" else None
            seen.add((role, text))
            if fault is not None:
                faults[fault] += 1
            marked.append((role, text, fault in (0, 1), fault == 2))
        turns = {r[3] for r in rows} - {None}
        initials = [r[4][:1] for r in rows]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        cost, audit, lines = cheapest(marked)
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        want.add((conv, gaps, *faults, illegal, cost, audit, hashlib.sha256(lines.encode()).hexdigest()))
    return want


def test_edits_against_search():
    rng = random.Random(1)
    letters = {"s": "system", "u": "user", "a": "assistant", "?": "tool"}
    for _ in range(3000):
        rows = [(letters[rng.choice("ssuuuaaa?")], "x", rng.random() < 0.15, False) for _ in range(rng.randint(0, 9))]
        rows = [(r, t, gone, not gone and rng.random() < 0.25) for r, t, gone, _ in rows]
        symbols = bytes(repair.GONE if gone else 1 + repair.LETTERS.index(r[0] if r[0] in "sua" else "?") + 4 * cut for r, _, gone, cut in rows)
        assert repair.least_edits(symbols) == cheapest(rows)[:2], rows


def test_blocks_agree_with_single_rows():
    rng = random.Random(2)
    tables = repair.blocks()
    assert len(tables.vectors) < 200 and len(tables.table) == 10**repair.BLOCK
    for _ in range(300):
        symbols = bytes(rng.choices(range(9), k=rng.randint(0, 40)))
        vector = repair.END
        for symbol in reversed(symbols):
            vector = repair.step(symbol, vector)
        cost, edits = repair.least_edits(symbols)
        assert cost == vector[0] and len(edits.replace("I", "")) == len(symbols)
    cost, edits = repair.least_edits(bytes([2, 3]) * 200_000)
    assert cost == 0 and edits == "K" * 400_000


def test_frame_against_brute_force(spark):
    rng = random.Random(5)
    texts = ["Hello there.", "No end", "Why?", "", " \n", None, "Ü!", "so: a", "x.\x0b\x0c", "one\x1c", "." * 3]
    table = []
    for conv in [*range(40), None]:
        for turn in range(rng.randint(1, 9)):
            turn = rng.choice((turn, turn, turn, turn // 2, None)) if conv != 3 else None
            table.append((conv, turn, rng.choice(("system", "user", "assistant", "user", "assistant", "tool", "", None, "ubot")), rng.choice(texts)))
    table += table[:20] * 2 + [(900, 0, "user", "Hi. " * 500_000)]
    frame = spark.createDataFrame(table, "conv_id long, turn long, role string, text string").selectExpr("*", "1 as n", "'k' as key", "2 as what", "3 as part", "4 as copy")
    got = repair.repaired(frame)
    assert got.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    rows = [tuple(r) for r in got.collect()]
    assert len(rows) == len(set(rows)) and set(rows) == brute(table)
    assert repair.repaired(frame.limit(0)).count() == 0


def test_one_long_conversation(spark):
    table = [(1, turn, "assistant" if turn % 2 else "user", f"Text {turn % 700}" + "." * (turn % 3 > 0)) for turn in range(6000)] + [(2, 5, "user", "Hi.")]
    rows = {tuple(r) for r in repair.repaired(spark.createDataFrame(table, "conv_id long, turn long, role string, text string").repartition(7)).collect()}
    assert rows == brute(table)


def test_whole_table(spark, sf):
    frame = spark.read.parquet(f"{sf}/conversations.parquet")
    table = [tuple(r) for r in frame.select("conv_id", "turn", "role", "text").collect()]
    assert {tuple(r) for r in repair.repaired(frame).collect()} == brute(table)
