"""Conversation repair against a plain dynamic programme over all edits, and on odd tables."""

from __future__ import annotations

import hashlib
import random
from collections import defaultdict

import pytest

from martkit.llm import turn_repair

SCHEMA = "conv_id bigint, turn bigint, role string, text string, cost string, part int, audit string"


def _table(spark, rows):
    return spark.createDataFrame([(*r, "c", 1, "a") for r in rows], SCHEMA)


def _brute(rows):
    """Per conversation the contract's columns, by trying every edit at every place."""
    given = defaultdict(list)
    for conv_id, turn, role, text in rows:
        given[conv_id].append((turn, " " if role is None else role, " " if text is None else text))
    out = []
    for conv_id, turns in given.items():
        turns.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.md5(r[2].encode()).digest()))
        seen, seq, n = set(), [], dict.fromkeys(("blank", "duplicate", "truncated"), 0)
        for _, role, text in turns:
            tail = text.strip(" \t\n\x0b\x0c\r")
            fault = "blank" if not tail else "duplicate" if (role, text) in seen else "truncated" if tail[-1] not in ".!?" else None
            seen.add((role, text))
            if fault:
                n[fault] += 1
            seq.append((role, text, fault))
        # state: what was given last; value: least (cost, audit) and the turns given
        ways = {"": (0, "", ())}

        def insert_all(ways):
            for _ in range(2):
                for state, (cost, audit, done) in list(ways.items()):
                    to = "a" if state == "u" else "u"
                    new = (cost + 2, audit + "I", (*done, ("user" if to == "u" else "assistant", "")))
                    ways[to] = min(ways.get(to, new), new)
            return ways

        for role, text, fault in seq:
            after = {}
            for state, (cost, audit, done) in insert_all(dict(ways)).items():
                late = 1 if fault == "truncated" else 0
                to = "a" if state == "u" else "u"
                new = [(state, (cost + 3, audit + "D", done))]
                if fault not in ("blank", "duplicate"):
                    name = "user" if to == "u" else "assistant"
                    new.append((to, (cost + 2 + late, audit + "R", (*done, (name, text)))))
                    if role[:1] == to:
                        new.append((to, (cost + late, audit + "K", (*done, (role, text)))))
                    if role[:1] == "s" and state == "":
                        new.append(("s", (cost + late, audit + "K", (*done, (role, text)))))
                for s, way in new:
                    after[s] = min(after.get(s, way), way)
            ways = after
        ways = insert_all(ways)
        cost, audit, done = min(w for s, w in ways.items() if s in ("", "a"))
        known = [t for t, _, _ in turns if t is not None]
        gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
        initials = [r[:1] for _, r, _ in turns]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        told = "\n".join(f"{r}:{t}" for r, t in done)
        out.append((conv_id, gaps, *n.values(), illegal, cost, audit, hashlib.sha256(told.encode()).hexdigest()))
    return sorted(out, key=lambda r: (r[0] is not None, r[0] or 0))


def _result(df):
    return sorted(map(tuple, df.collect()), key=lambda r: (r[0] is not None, r[0] or 0))


def _rows(seed):
    rng = random.Random(seed)
    rows = []
    for conv_id in [None, *range(40)]:
        for _ in range(rng.randint(1, 14)):
            turn = rng.choice([None, *range(9)])
            role = rng.choice(["user", "assistant", "system", "user", "assistant", "tool", None, "", "sys", "agent"])
            text = rng.choice(["Yes.", "No", " ", "", None, "Why?", "cut off\n", "ok! \t", "é…"])
            rows.append((conv_id, turn, role, text))
    return rows


@pytest.mark.parametrize("segment", [1, 3, 4096])
def test_repair_equals_brute_force(spark, segment):
    rows = _rows(segment)
    got = turn_repair.repair_turns(_table(spark, rows), segment)
    assert got.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert _result(got) == _brute(rows)


def test_one_conversation_holds_most_rows(spark):
    """It spreads over tasks and segments; a run of one row is cut as well."""
    rng = random.Random(5)
    rows = [(1, k // 2, rng.choice(["user", "assistant"]), f"t{rng.randint(0, 900)}.") for k in range(600)]
    rows += [(1, 77, "user", "again.")] * 300 + [(2, 0, "user", "Hi."), (2, 1, "assistant", "Hi.")]
    got = turn_repair.repair_turns(_table(spark, rows), segment=50)
    assert _result(got) == _brute(rows)


def test_both_directions_find_the_least_audit():
    """All ties of small lattices, between every pair of states."""
    rng = random.Random(1)
    for _ in range(300):
        rows = [(rng.choice("suax"), rng.random() < 0.2, rng.random() < 0.3) for _ in range(rng.randint(0, 6))]
        for start in range(4):
            ways = {(0, start): (0, "")}
            for i in range(len(rows) + 1):
                for _ in range(3):  # insertions stay at a place
                    for s in range(4):
                        for letter, w, j, p in turn_repair._edges(rows, i, s):
                            if (i, s) in ways:
                                new = (ways[i, s][0] + w, ways[i, s][1] + letter)
                                ways[j, p] = min(ways.get((j, p), new), new)
            for end in range(4):
                assert turn_repair.cheapest(rows, start, (end,)) == ways.get((len(rows), end))


def test_every_conversation_stays(spark):
    """Conversations that the damage empties, and an empty table."""
    rows = [(c, t, "user", "x.") for c in range(60) for t in range(1)]
    got = turn_repair.repair_damaged(_table(spark, rows)).collect()
    assert sorted(r.conv_id for r in got) == list(range(60))
    lost = [r for r in got if r.audit == ""]
    assert lost and all(r.cost == 0 and r.repaired_sha256 == hashlib.sha256(b"").hexdigest() for r in lost)
    assert turn_repair.repair_damaged(_table(spark, [])).collect() == []
    assert turn_repair.repair_turns(_table(spark, [(None, None, None, None)])).collect()[0][1:8] == (0, 1, 0, 0, 0, 3, "D")
