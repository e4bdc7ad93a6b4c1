import hashlib
import random
import re
import zlib
from itertools import product

import pytest
import xxhash
from pyspark.sql import functions as F

from trendloom.llm import turn_repair
from trendloom.llm.queries import op13_turn_repair
from trendloom.llm.turn_repair import Costs, search

PATTERN = re.compile(r"(s?(ua)+)?\Z")


def best_edits(rows: list, costs=Costs()) -> tuple:
    """(cost, audit, repaired turns) by trying all edits of rows (role, text, fault)."""
    best, most = None, costs.delete * len(rows)  # deleting all of them always does
    inserts = range(most // costs.insert + 1)
    for before in product(inserts, repeat=len(rows) + 1):
        if sum(before) * costs.insert > most:
            continue
        for edits in product("DKR", repeat=len(rows)):
            if any(e != "D" and r[2] in ("blank", "duplicate") for e, r in zip(edits, rows)):
                continue
            cost = sum(before) * costs.insert
            audit = ""
            for n, e, r in zip(before, edits, rows):
                audit += "I" * n + e
                cost += {"D": costs.delete, "K": 0, "R": costs.rerole}[e] + (costs.truncated if e != "D" and r[2] == "truncated" else 0)
            audit += "I" * before[-1]
            if best is not None and (cost, audit) >= best[:2]:
                continue
            free, own, it = [], [], iter(rows)
            for e in audit:
                row = next(it) if e != "I" else ("", "")
                if e != "D":
                    free.append(("", row[1] if e == "R" else "") if e != "K" else row[:2])
                    own.append(e == "K")
            for roles in product(("user", "assistant"), repeat=own.count(False)):
                given = iter(roles)
                turns = [t if k else (next(given), t[1]) for t, k in zip(free, own)]
                if PATTERN.match("".join(t[0][:1] or "?" for t in turns)):
                    best = (cost, audit, turns)
                    break
    return best


def damage(conversations: list) -> dict:
    """conv_id: rows (turn, role, text) after the damage, in order."""
    out = {}
    for conv, turn, role, text in conversations:
        role, text = (" " if x is None else x for x in (role, text))
        lot = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        out.setdefault(conv, [])
        if lot:
            role, text = "user" if lot == 4 else role, "" if lot == 1 else re.sub("[.!?]", "", text) if lot == 2 else text
            out[conv] += [(turn, role, text)] * (2 if lot == 3 else 1)
    signed = lambda h: h - (1 << 64) if h >> 63 else h
    place = lambda r: signed(xxhash.xxh64_intdigest(r[2], xxhash.xxh64_intdigest(r[1], 42)))
    return {c: sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, place(r))) for c, rows in out.items()}


def faults(rows: list) -> list:
    seen, out = set(), []
    for _, role, text in rows:
        left = text.strip(" \t\n\x0b\x0c\r")
        out.append("blank" if not left else "duplicate" if (role, text) in seen else "truncated" if left[-1] not in ".!?" else None)
        seen.add((role, text))
    return out


def plain_report(conversations: list, solve=best_edits) -> dict:
    out = {}
    for conv, rows in damage(conversations).items():
        found, turns = faults(rows), [r[0] for r in rows if r[0] is not None]
        initials = [r[1][:1] for r in rows]
        cost, audit, kept = solve([(r[1], r[2], f) for r, f in zip(rows, found)])
        out[conv] = (
            max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *(found.count(f) for f in ("blank", "duplicate", "truncated")),
            sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), cost, audit,
            hashlib.sha256("\n".join(f"{r}:{t}" for r, t in kept).encode()).hexdigest(),
        )
    return out


def step_by_step(rows: list, costs=Costs()) -> tuple:
    """As best_edits for many turns: best (cost, audit) by initials so far, row after row."""
    ends = {"": (0, "", [])}
    step = lambda last: "u" if last != "u" else "a"
    names = {"u": "user", "a": "assistant"}

    def inserted(ends):
        out = dict(ends)
        for _ in range(2):
            for last, (cost, audit, kept) in list(out.items()):
                way = (cost + costs.insert, audit + "I", [*kept, (names[step(last)], "")])
                out[step(last)] = min(out.get(step(last), way), way)
        return out

    for role, text, fault in rows:
        following, extra = {}, costs.truncated if fault == "truncated" else 0
        for last, (cost, audit, kept) in inserted(ends).items():
            ways = [(last, costs.delete, "D", kept)]
            if fault not in ("blank", "duplicate"):
                ways.append((step(last), costs.rerole + extra, "R", [*kept, (names[step(last)], text)]))
                if role[:1] == step(last) or (role[:1] == "s" and last == ""):
                    ways.append((role[:1], extra, "K", [*kept, (role, text)]))
            for now, price, edit, turns in ways:
                way = (cost + price, audit + edit, turns)
                following[now] = min(following.get(now, way), way)
        ends = following
    return min(way for last, way in inserted(ends).items() if last in ("", "a"))


def given(seed: int, conversations: int, most: int, odd: float = 0.3) -> list:
    rnd, rows = random.Random(seed), []
    for conv in range(conversations):
        for turn in range(rnd.randint(1, most)):
            role = ("user", "assistant")[turn % 2] if rnd.random() > odd else rnd.choice(("system", "user", "assistant", "tool", "", None, "ux", "User"))
            text = rnd.choice(("Yes.", f"t{rnd.randint(0, 99)}!", "no end", " \t", "", None, "Ünd?  \n", "a.　"))
            rows.append((conv, None if rnd.random() < 0.05 else turn + (turn > 3), role, text))
    return rows


SCHEMA = "conv_id long, turn long, role string, text string"


def test_against_all_edits(spark):
    rows = given(3, 120, 4) + [(None, 0, "system", "s."), (None, 1, "user", "u."), (-5, 7, None, None)]
    got = {r.conv_id: tuple(r)[1:] for r in turn_repair.repair_report(spark.createDataFrame(rows, SCHEMA)).collect()}
    want = plain_report(rows)
    assert got == want and len({w[6] for w in want.values()}) > 20
    assert plain_report(rows, step_by_step) == want


def test_search_against_all_edits():
    """Also at prices where turns are inserted."""
    rnd = random.Random(1)
    for costs in (Costs(), Costs(3, 4, 1, 2), Costs(1, 3, 2, 1), Costs(2, 2, 2, 2)):
        for _ in range(60):
            rows = [(rnd.choice(("system", "user", "assistant", "other")), "x", rnd.choice((None, None, "blank", "truncated"))) for _ in range(rnd.randint(0, 3))]
            codes = "".join("x" if f == "blank" else r[0].upper() if f else r[0] for r, _, f in rows)
            want = best_edits(rows, costs)
            assert search(codes, costs=costs)[0] == want[:2]


@pytest.mark.parametrize("piece", [1, 7, 256])
def test_long_conversations_in_pieces(spark, piece):
    """Conversations of many pieces, over many tasks, with texts that come again far later."""
    rows = given(piece, 6, 300) + given(9, 30, 6)
    costs = Costs(3, 4, 1, 2) if piece == 7 else Costs()
    turns = spark.createDataFrame(rows, SCHEMA)
    audited, repaired = turn_repair.repair(turn_repair.damaged(turns), costs, "copies", piece)
    want = plain_report(rows, lambda own: step_by_step(own, costs))
    got = {r.conv_id: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit) for r in audited.collect()}
    assert got == {c: w[:7] for c, w in want.items() if c in got} and set(want) - set(got) == {c for c, w in want.items() if not w[6]}
    texts = {}
    for r in sorted(repaired.collect(), key=lambda r: (r.conv_id, r.place)):
        texts.setdefault(r.conv_id, []).append(f"{r.role}:{r.text}")
    assert {c: hashlib.sha256("\n".join(t).encode()).hexdigest() for c, t in texts.items()} == {c: w[7] for c, w in want.items() if c in texts}


def test_search_stays_small():
    rnd = random.Random(4)
    for letters in ("uaUAsox", "u", "a", "o", "s", "uS", "AaUu"):
        codes = "".join(rnd.choice(letters) for _ in range(256))
        for entry in range(4):
            assert search(codes, entry, False)


def test_given_table(spark, sf_dir):
    table = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = {r.conv_id: tuple(r)[1:] for r in op13_turn_repair(spark, sf_dir).collect()}
    assert got == plain_report(table, step_by_step)


def test_odd_rows(spark):
    rows = [(1, None, None, None)] * 3 + [(1, None, "user", "Hm.")] * 50 + [(2, -3, "system", "x" * 3_000_000 + "."), (2, 5, "", "")] + [(4, None, "user", "a.")]
    df = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("x") for c in ("copies", "edits", "kind", "h1", "place", "initial", "first", "fault", "audit")})
    got = {r.conv_id: tuple(r)[1:] for r in turn_repair.repair_report(df).collect()}
    assert got == plain_report(rows, step_by_step)
    assert turn_repair.repair_report(df.where("false")).count() == 0
    audited, turns = turn_repair.repair(df.where("false"))
    assert audited.count() == 0 and turns.count() == 0


def test_nothing_left(spark):
    """Every turn of this conversation is dropped by the damage."""
    gone = next(c for c in range(10**6) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    got = turn_repair.repair_report(spark.createDataFrame([(gone, 0, "user", "Hi.")], SCHEMA)).collect()
    assert [tuple(r) for r in got] == [(gone, 0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest())]
