"""Conversation repair against a plain search over all edits, and by hand."""

import collections
import hashlib
import random
import re
import zlib

import pytest

from sparkfold.llm.turn_repair import CUT, MUST_GO, Lattice, clean_rows, damage, repair, repair_damaged

SCHEMA = "conv_id long, turn int, role string, text string, audit string, _c int"
EMPTY = hashlib.sha256(b"").hexdigest()


def brute_edits(initials, flags):
    """(cost, letters, roles): forward over all states, keeping the least (cost, letters) of each initials' tail."""
    after = {"": "su", "s": "u", "u": "a", "a": "u"}
    best = {"": (0, "", ())}

    def better(found, key, value):
        if key not in found or value[:2] < found[key][:2]:
            found[key] = value

    def with_inserts(found):
        for _ in range(3):
            for key, (cost, letters, roles) in list(found.items()):
                for to in after[key].replace("s", ""):
                    better(found, to, (cost + 5, letters + "I", (*roles, to)))
        return found
    with_inserts(best)
    for initial, flag in zip(initials, flags):
        found = {}
        for key, (cost, letters, roles) in best.items():
            better(found, key, (cost + 2, letters + "D", roles))
            if not flag & MUST_GO:
                more = 5 if flag & CUT else 0
                if initial and initial in after[key]:
                    better(found, initial, (cost + more, letters + "K", (*roles, initial)))
                for to in after[key].replace("s", ""):
                    better(found, to, (cost + 1 + more, letters + "R", (*roles, to)))
        best = with_inserts(found)
    return min((best[k] for k in ("", "a") if k in best), key=lambda v: v[:2])


@pytest.mark.parametrize("seed", range(6))
def test_auction_against_all_edits(seed):
    rng = random.Random(seed)
    for _ in range(300):
        n = rng.choice([1, 2, 3, 5, 8, 40, 100])
        initials = [rng.choice("ssuuuaaat") for _ in range(n)] if seed % 2 else [rng.choice("uuuuua") for _ in range(n)]
        flags = [rng.choice([0, 0, 0, MUST_GO, CUT]) for _ in range(n)]
        assert Lattice("".join(initials), bytes(flags)).solve() == brute_edits(initials, flags)[:2]


def brute(rows):
    """conv_id -> columns, of rows (conv_id, turn, role, text) that are not null but for turn and conv_id."""
    space = "[\x20\x09-\x0d]"
    convs = collections.defaultdict(list)
    for c, turn, role, text in rows:
        convs[c].append((turn is not None, turn or 0, role, text))
    out = {}
    for c, mine in convs.items():
        mine.sort()
        turns = [t[1] for t in mine if t[0]]
        seen, faults = set(), []
        for _, _, role, text in mine:
            bare = re.sub(f"{space}+", "", text)
            faults.append("b" if not bare else "d" if (role, text) in seen else "t" if bare[-1] not in ".!?" else "")
            seen.add((role, text))
        initials = [t[2][:1] for t in mine]
        cost, letters, roles = brute_edits(initials, [{"b": 1, "d": 1, "t": 2, "": 0}[f] for f in faults])
        it, names, lines = iter(mine), iter(roles), []
        for e in letters:
            row = None if e == "I" else next(it)
            if e != "D":
                name = next(names)
                lines.append((row[2] if e == "K" else {"u": "user", "a": "assistant"}[name]) + ":" + (row[3] if row else ""))
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        out[c] = (gaps, faults.count("b"), faults.count("d"), faults.count("t"), illegal, cost, letters,
                  hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def brute_damage(rows):
    out = []
    for c, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        k = zlib.crc32(f"{' ' if c is None else c}:{' ' if turn is None else turn}".encode()) % 20
        if k:
            row = (c, turn, "user" if k == 4 else role, "" if k == 1 else re.sub("[.!?]", "", text) if k == 2 else text)
            out += [row, row] if k == 3 else [row]
    return out


def result(df):
    return {r.conv_id: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, r.repaired_sha256) for r in df.collect()}


ODD = [(1, 0, "system", "S."), (1, 1, "user", "Q?"), (1, 2, "assistant", "A."), (2, None, "user", "late."), (2, 5, "user", "late."),
       (2, 5, "tool", "x"), (3, 1, None, None), (3, 1, "", "No role."), (3, 2, "assistant", " \t\n"), (4, 7, "assistant", "only!"),
       (5, 1, "user", "same?"), (5, 1, "user", "same?"), (5, 9, "assistant", "cut off "), (6, 0, "user", "é" * 40000 + "."),
       (6, 1, "assistant", "ends. \n"), (None, 0, "user", "of nobody."), (8, 0, "sage", "s-role."), (8, 1, "user", "Q.\x85")]


def test_odd_rows(spark):
    rows = clean_rows(spark.createDataFrame([(*r, "x", 1) for r in ODD], SCHEMA))
    whole = [(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in ODD]
    assert result(repair(rows)) == brute(whole)
    assert {tuple(r) for r in damage(rows).collect()} == set(brute_damage(ODD))


def test_damaged_conversations(spark):
    rng = random.Random(7)
    rows = [(c, t, rng.choice(["user", "assistant", "assistant", "system", None]), rng.choice(["Yes.", "No", "Why?", "", None, "a. b! c?"]))
            for c in range(150) for t in range(rng.randrange(1, 9))]
    rows += [(900, t, "user" if t % 3 else "assistant", f"turn {t}.") for t in range(700)] + rows[:40]
    expected = brute(brute_damage(rows))
    got = result(repair_damaged(spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)))
    assert set(got) == {r[0] for r in rows}
    assert got == {c: expected.get(c, (0, 0, 0, 0, 0, 0, "", EMPTY)) for c in got}


def test_no_rows(spark):
    assert repair_damaged(spark.createDataFrame([], SCHEMA)).count() == 0
