"""Conversation repair against a plain dynamic program, block by block and whole."""

import os
import random
import re
from itertools import product

import pytest

import brute
from caseload.llm import conversation as C
from caseload.llm import queries as Q

SF = "/root/testdata/sf0.001"
COLUMNS = ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def _lattices(rng, n):
    return [[(rng.choice(["s", "u", "a", "x", ""]), rng.choice([0, 0, 0, 1, 2, 3])) for _ in range(rng.randrange(0, 9))] for _ in range(n)]


def test_cheapest_against_dynamic_program():
    for rows in _lattices(random.Random(1), 1500):
        assert C.cheapest(rows, C.BEGUN, C.GOALS) == brute.cheapest_edits(rows)


def test_cheapest_against_all_audits():
    """Every audit of a few edits, tried by hand: the roles must match the pattern."""
    rng = random.Random(2)
    for rows in _lattices(rng, 40):
        rows = rows[:4]
        best = None
        for n in range(len(rows), len(rows) + 4):
            for edits in product("KRDI", repeat=n):
                if sum(e != "I" for e in edits) != len(rows):
                    continue
                for fill in product("ua", repeat=sum(e in "RI" for e in edits)):
                    at, cost, said, given, good = 0, 0, "", iter(fill), True
                    for e in edits:
                        if e == "I":
                            cost, said = cost + 3, said + next(given)
                            continue
                        initial, fault = rows[at]
                        at += 1
                        if e == "D":
                            cost += 4
                            continue
                        good &= fault not in (1, 2)
                        cost += 3 * (e == "R") + 3 * (fault == 3)
                        said += initial if e == "K" else next(given)
                    if good and re.fullmatch("(s?(ua)+)?", said):
                        best = min(best or (cost, "".join(edits)), (cost, "".join(edits)))
        got = C.cheapest(rows, C.BEGUN, C.GOALS)
        if best is None or sum(e == "I" for e in got[1]) > 3:
            continue
        assert got == best


def _talk(rng):
    rows = []
    texts = ["Hello.", "Yes!", "no end", "", " \t\n", "What?", "é 漢 🙂.", "a line\nand more.", None]
    for conv in [*range(1, 40), None]:
        for turn in range(rng.randrange(0, 30)):
            rows.append((conv, None if rng.random() < 0.03 else turn * rng.choice([1, 1, 1, 2]), rng.choice(["user", "assistant", "system", "user", "assistant", None, "", "tool"]),
                         f"{rng.choice(texts)}{rng.randrange(40) or ''}." if rng.random() < 0.7 else rng.choice(texts)))
    rows += [(77, t % 40, ("user", "assistant")[t % 2], f"turn {t}." * (1 + 400 * (t == 9))) for t in range(90)] + [(77, 5, "user", "again.")] * 5 + [(78, None, "user", "x")]
    return [(*r, "a", 1, 2, "d") for r in rows + rows[:7]]


SCHEMA = "conv_id long, turn long, role string, text string, audit string, cost int, copies int, digest string"


@pytest.mark.parametrize("block", [4, 512])
def test_against_brute_force(spark, block, monkeypatch):
    monkeypatch.setattr(C, "BLOCK", block)
    rows = _talk(random.Random(block))
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = sorted((tuple(r[c] for c in COLUMNS) for r in C.repaired_digest(*C.repair(C.contract_damage(df))).collect()), key=repr)
    assert got == sorted(brute.conversations([r[:4] for r in rows]), key=repr)


def test_pieces_hold_the_repaired_turns(spark):
    df = spark.createDataFrame([(1, 1, "user", "Hi."), (1, 2, "user", "Hi?"), (2, 1, "assistant", "x")], "conv_id long, turn long, role string, text string")
    report, pieces = C.repair(df.selectExpr("*", "1 AS copies"))
    assert {r.conv_id: (r.cost, r.audit) for r in report.collect()} == {1: (3, "KR"), 2: (4, "D")}
    assert {r.conv_id: [tuple(t) for t in r.repaired] for r in pieces.collect()} == {1: [("K", "user", "Hi."), ("R", "assistant", "Hi?")], 2: []}


def test_no_rows(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert C.repaired_digest(*C.repair(C.contract_damage(df))).count() == 0


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables absent")
def test_registered_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = Q.op11_conversation_repair(spark, SF)
    assert tuple(got.columns) == COLUMNS
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(brute.conversations(rows), key=repr)
