"""Conversation repair against a search over all repairs, and the whole contract in plain Python."""

import hashlib
import heapq
import random
import re
import zlib
from collections import defaultdict

import pytest

from sedimenta.llm import turns
from sedimenta.llm.common import table
from sedimenta.llm.turns import Turn, align, joined, structure_digest

FOLLOW = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}
SCHEMA = "conv_id bigint, turn bigint, role string, text string, key string, pos int, fault int, audit string, cost int"


def cheapest(given, start=0):
    """(cost, audit) by last letter, by Dijkstra over (turn, letter)."""
    best, heap, seen = {}, [(0, "", 0, start)], set()
    while heap:
        cost, audit, i, state = heapq.heappop(heap)
        if (i, state) in seen:
            continue
        seen.add((i, state))
        if i == len(given):
            best.setdefault(state, (cost, audit))
        else:
            initial, fault = given[i]
            heapq.heappush(heap, (cost + 2, audit + "D", i + 1, state))
            if fault not in (1, 2):
                more = 5 if fault == 3 else 0
                for letter, then in FOLLOW[state].items():
                    if initial == letter:
                        heapq.heappush(heap, (cost + more, audit + "K", i + 1, then))
                    if letter in "ua":
                        heapq.heappush(heap, (cost + 1 + more, audit + "R", i + 1, then))
        for letter, then in FOLLOW[state].items():
            if letter in "ua":
                heapq.heappush(heap, (cost + 5, audit + "I", i, then))
    return best


def some_turns(rng, longest):
    wild = rng.choice([0.1, 0.5, 0.9])
    return [("ua"[i % 2] if rng.random() > wild else rng.choice(["s", "u", "a", " ", ""]),
             rng.choice([0] * 5 + [1, 2, 3, 3]) if rng.random() < wild else 0) for i in range(rng.randrange(longest))]


def test_alignment_finds_the_cheapest_repair():
    rng = random.Random(3)
    for _ in range(1500):
        given = some_turns(rng, 13)
        made = [Turn(*t) for t in given]
        for start in range(4):
            assert align(made, start, False) == cheapest(given, start)
        ends = cheapest(given)
        assert min(align(made, 0, True).values()) == min(ends[q] for q in (0, 3) if q in ends)
        cut = rng.randrange(len(made) + 1)
        parts = [{(a, b): v for a in range(4) for b, v in align(x, a, False).items()} for x in (made[:cut], made[cut:])]
        assert {b: v for (a, b), v in joined(*parts).items() if a == 0} == ends


def expected(rows):
    """The contract, row by row."""
    found, every = defaultdict(list), []
    space = " \t\n\x0b\f\r"
    for conv, turn, role, text, *_ in rows:
        if conv not in every:
            every.append(conv)
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        found[conv] += [(turn, role, text)] * (2 if kind == 3 else 1)
    out = {}
    for conv in every:
        # Like the operator: nulls first, then role, then a hash of both.
        given = sorted(found[conv], key=lambda t: (
            t[0] is not None, t[0] or 0, t[1].encode(), hashlib.sha256(f"{len(t[1])}:{t[1]}{t[2]}".encode()).digest()))
        seen, made = set(), []
        for _, role, text in given:
            fault = (1 if not text.strip(space) else 2 if (role, text) in seen
                     else 3 if text.rstrip(space)[-1] not in ".!?" else 0)
            seen.add((role, text))
            made.append((role[:1], fault))
        numbers = [t for t, _, _ in given if t is not None]
        ends = cheapest(made)
        cost, audit = min(ends[q] for q in (0, 3) if q in ends)
        length, lines, i = len(audit) - audit.count("D"), [], 0
        target = iter((["system"] if length % 2 else []) + ["user", "assistant"] * (length // 2))
        for edit in audit:
            want = None if edit == "D" else next(target)
            if edit in "KR":
                lines.append(f"{given[i][1] if edit == 'K' else want}:{given[i][2]}")
            elif edit == "I":
                lines.append(f"{want}:")
            i += edit != "I"
        faults = [f for _, f in made]
        out[conv] = (
            max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0, faults.count(1), faults.count(2),
            faults.count(3), sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(made, made[1:])), cost, audit,
            hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def found(df):
    rows = df.collect()
    assert len({r["conv_id"] for r in rows}) == len(rows)
    return {r["conv_id"]: tuple(r)[1:] for r in rows}


@pytest.fixture(params=[4, 64])
def block(request, monkeypatch):
    monkeypatch.setattr(turns, "BLOCK", request.param)
    monkeypatch.setattr(turns, "FAN_IN", 2 if request.param == 4 else 64)


def test_test_table(spark):
    rows = [tuple(r) for r in table(spark, "/root/testdata/sf0.01", "conversations").collect()]
    assert found(structure_digest(table(spark, "/root/testdata/sf0.01", "conversations"))) == expected(rows)


def test_long_conversations(spark, block):
    rng = random.Random(4)
    texts = ["Yes.", "No", "Why?  ", "", " \n", "Fine!", "so\x0b", "ends here. \t", "été", "more"]
    rows = []
    for conv, n in ((1, 300), (2, 3), (None, 90), (4, 1), (5, 65)):
        for i in range(n):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", None, "", "Uhr"])
            rows.append((conv, rng.choice([i, i, i, None, i // 2]), role, rng.choice(texts) + (str(i) if i % 3 else ""), "k", 1, 2, "a", 3))
    rng.shuffle(rows)
    assert found(structure_digest(spark.createDataFrame(rows, SCHEMA).repartition(5))) == expected(rows)


def test_awkward_rows(spark, block):
    rows = [
        (1, None, None, None), (1, None, None, None), (2, 5, "user", "x" * 200_000), (2, 9_000_000, "assistant", None),
        (3, 1, "user", "Hi."), (3, 1, "user", "Hi."), (3, 1, "assistant", "Hi."), (4, None, "assistant", "Only one."),
        (None, None, "system", "Be kind."), (None, 2, "user", "Hello?"), (None, 3, "assistant", "Yes."),
        (6, 1, "", ""), (7, -4, "assistant", " "), *((i, 1, "user", "Go.") for i in range(8, 60)),
    ]
    rows = [(*r, "k", 1, 2, "a", 3) for r in rows]
    want = expected(rows)
    assert found(structure_digest(spark.createDataFrame(rows, SCHEMA))) == want
    # Some lose their only row.
    empty = hashlib.sha256(b"").hexdigest()
    assert (0, 0, 0, 0, 0, 0, "", empty) in want.values()


def test_empty_table(spark):
    got = structure_digest(spark.createDataFrame([], SCHEMA))
    assert got.collect() == [] and got.columns[-2:] == ["audit", "repaired_sha256"]


def test_gaps_beyond_a_long(spark):
    rows = [(1, 2**63 - 1, "user", "a."), (1, -(2**63), "user", "b."), (1, 0, "user", "c.")]
    assert found(structure_digest(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")))[1][0] is None


def test_repaired_turns(spark):
    rows = [(1, 1, "system", "Rules."), (1, 2, "user", "Hm."), (1, 3, "user", "What?"), (1, 4, "assistant", "This."),
            (1, 5, "assistant", "This."), (1, 6, "user", "Well.")]
    fixed = turns.repair(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    report = fixed.report.first()
    # Two wrong letters in a row cost less as other roles than as deletions.
    assert (report["cost"], report["duplicate"], report["audit"]) == (5, 1, "KKRRDR")
    edits = sorted((r["index"], r["edit"], r["turn"], r["role"], r["text"]) for r in fixed.edits().collect())
    assert [e[1:] for e in edits] == [("K", 1, "system", "Rules."), ("K", 2, "user", "Hm."), ("R", 3, "assistant", "What?"),
                                      ("R", 4, "user", "This."), ("R", 6, "assistant", "Well.")]
    alone = turns.repair(spark.createDataFrame([(1, 1, "assistant", "x" * 9 + ".")], "conv_id long, turn long, role string, text string"))
    assert alone.report.first()["audit"] == "D" and alone.edits().collect() == []
