"""Structure repair against a brute-force version that compares (cost, letters) of whole paths."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest

from tillroll.llm import structure_repair as S

SF = "/root/testdata/sf0.001"
EMPTY = hashlib.sha256(b"").hexdigest()


def brute_damage(rows):
    """[(conv, turn, role, text)] after damage."""
    out = []
    for conv, turn, role, text in rows:
        f = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if f == 0:
            continue
        text = "" if f == 1 else re.sub("[.!?]", "", text) if f == 2 else text
        out += [(conv, turn, "user" if f == 4 else role, text)] * (2 if f == 3 else 1)
    return out


def legal(roles: str) -> bool:
    return re.fullmatch("(s?(ua)+)?", roles) is not None


def brute_best(turns):
    """Least (cost, letters) over all edit sequences: sets of paths by (turns taken, roles so far as a state)."""
    after = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}
    best = {"": (0, "")}

    def inserted(level):
        for _ in range(2):
            for s, (c, p) in list(level.items()):
                t = {"": "u", "s": "u", "u": "a", "a": "u"}[s]
                level[t] = min(level.get(t, (10**9, "")), (c + 3, p + "I"))
        return level

    for initial, gone, cut in turns:
        level, new = inserted(dict(best)), {}
        for s, (c, p) in level.items():
            ways = [(s, c + 4, p + "D")]
            if not gone:
                if initial in after[s]:
                    ways.append((after[s][initial], c + 3 * cut, p + "K"))
                ways.append(({"": "u", "s": "u", "u": "a", "a": "u"}[s], c + 3 + 3 * cut, p + "R"))
            for t, cost, letters in ways:
                new[t] = min(new.get(t, (10**9, "")), (cost, letters))
        best = new
    best = inserted(dict(best))
    return min(best[s] for s in ("", "a") if s in best)


def all_sequences(turns, limit=4):
    """Every edit sequence with at most ``limit`` inserts, for tiny conversations."""
    found = []

    def go(i, roles, cost, letters, ins):
        if i == len(turns) and legal(roles):
            found.append((cost, letters))
        if ins < limit:
            for r in "ua":
                go(i, roles + r, cost + 3, letters + "I", ins + 1)
        if i < len(turns):
            initial, gone, cut = turns[i]
            go(i + 1, roles, cost + 4, letters + "D", ins)
            if not gone:
                go(i + 1, roles + (initial or "?"), cost + 3 * cut, letters + "K", ins)
                for r in "ua":
                    go(i + 1, roles + r, cost + 3 + 3 * cut, letters + "R", ins)

    go(0, "", 0, "", 0)
    return min(found)


def brute(rows, damage=True):
    by = defaultdict(list)
    given = brute_damage(rows) if damage else [(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows]
    for r in given:
        by[r[0]].append(r)
    out = {}
    for conv in {r[0] for r in rows}:
        rs = sorted(by[conv], key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), r[3].encode()))
        turns, seen, n = [], set(), [0, 0, 0]
        for _, _, role, text in rs:
            stripped = text.strip(" \t\n\x0b\x0c\r")
            blank, twice = not stripped, (role, text) in seen
            cut = not blank and not twice and stripped[-1] not in ".!?"
            seen.add((role, text))
            n[0] += blank
            n[1] += twice and not blank
            n[2] += cut
            turns.append((role[:1], blank or twice, cut))
        initials = [t[0] for t in turns]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        ts = [r[1] for r in rs if r[1] is not None]
        gaps = max(ts) - min(ts) + 1 - len(set(ts)) if ts else 0
        cost, audit = brute_best(turns)
        state, i, lines = "", 0, []
        for c in audit:
            if c == "D":
                i += 1
                continue
            if c == "K":
                role, text = rs[i][2], rs[i][3]
                state = role[0]
            else:
                state = {"": "u", "s": "u", "u": "a", "a": "u"}[state]
                role, text = {"u": "user", "a": "assistant"}[state], rs[i][3] if c == "R" else ""
            i += c != "I"
            lines.append(f"{role}:{text}")
        out[conv] = (gaps, *n, illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def got(df):
    return {r.conv_id: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, r.repaired_sha256) for r in df.collect()}


SCHEMA = "conv_id bigint, turn bigint, role string, text string, _pos string, cost string"


def table(spark, rows):
    return spark.createDataFrame([(*r, "clash", "x") for r in rows], SCHEMA)


def test_least_integer_is_least_cost_then_least_letters():
    rng = random.Random(3)
    for _ in range(250):
        turns = [(rng.choice(["s", "u", "a", "t", ""]), rng.random() < 0.2, rng.random() < 0.3) for _ in range(rng.randint(0, 4))]
        turns = [(i, g, c and not g) for i, g, c in turns]
        assert S.solve(turns) == all_sequences(turns) == brute_best(turns), turns


def test_composed_blocks_find_the_same_path():
    rng = random.Random(4)
    for _ in range(200):
        turns = [(rng.choice("ssuuuaaat"), rng.random() < 0.2, False) for _ in range(rng.randint(2, 40))]
        size = rng.randint(1, 7)
        blocks = [turns[i : i + size] for i in range(0, len(turns), size)]
        ms = [S.block_matrix(b) for b in blocks]
        half = len(ms) // 2 or 1
        joined = []
        for part in (ms[:half], ms[half:]):
            m = None
            for x in part:
                m = x if m is None else S.compose(m, x)
            joined += [m] if m else []
        total = joined[0] if len(joined) == 1 else S.compose(*joined)
        top = S.path(joined, S.START, S.last_state(total))
        states = [S.START]
        for part, s, e in zip((ms[:half], ms[half:]), top, top[1:]):
            states += S.path(part, s, e)[1:]
        cost, letters = 0, ""
        for i, b in enumerate(blocks):
            c, a = S.solve(b, states[i], None if i + 1 == len(blocks) else states[i + 1])
            cost, letters = cost + c, letters + a
        assert (cost, letters) == brute_best(turns)


def test_registered_table_matches_brute_force(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")
    rows = [tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()]
    from tillroll.llm.queries import op12_structure_repair

    assert got(op12_structure_repair(spark, "/root/testdata/sf0.01")) == brute(rows)


@pytest.mark.parametrize("block", [1024, 5])
def test_edges_and_hot_conversation(spark, monkeypatch, block):
    monkeypatch.setattr(S, "GROUP", 3)  # several levels
    rng = random.Random(block)
    word = lambda: rng.choice(["Yes.", "no", "Fine!", "", " \t", "what?", "a.\n", "é", "ü."])
    rows = [(7, rng.choice([None, *range(90)]), rng.choice(["user", "assistant", "system", "tool", None, ""]), word() + str(rng.randint(0, 40)) + word()) for _ in range(150)]
    rows += [(8, i, ("user", "assistant")[i % 2], f"turn {i}.") for i in range(60)]
    rows += [(9, 1, "user", "same.")] * 30  # repeated rows
    rows += [(None, 1, "user", "hello"), (None, None, None, None), (10, None, "assistant", "x" * 100_000), (11, 0, "user", None)]
    rows += [(c, 0, "user", "lone.") for c in range(100, 160)]  # some are dropped altogether
    want = brute(rows)
    assert any(v == (0, 0, 0, 0, 0, 0, "", EMPTY) for v in want.values())
    assert got(S.repair_conversations(table(spark, rows), block=block)) == want
    assert got(S.repair_conversations(table(spark, rows), damage=False, block=block)) == brute(rows, damage=False)


def test_empty_table(spark):
    assert S.repair_conversations(table(spark, [])).count() == 0
