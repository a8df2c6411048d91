"""Conversation repair against an enumeration of all edits, in pieces of any size, on odd rows."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest

from larkspur.llm import conversations

SCHEMA = "conv_id long, turn long, role string, text string, times string, _piece string, key int"
GOOD = re.compile(r"(s?(ua)+)?")


def damaged_rows(rows):
    """The damage rule in plain Python, ordered as the operator takes the rows."""
    out = defaultdict(list)
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        place = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(place.encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        out[conv] += [(turn, role, text)] * (2 if kind == 3 else 1)
    for held in out.values():
        held.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(r[2].encode()).hexdigest()))
    return out


def faults(rows):
    seen, found = set(), []
    for _, role, text in rows:
        bare = text.strip(" \t\n\x0b\f\r")
        if not bare:
            found.append("blank")
        elif (role, text) in seen:
            found.append("duplicate")
        else:
            found.append("" if bare[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return found


def cheapest(rows):
    """(cost, audit, lines) by trying every edit at every place; for short conversations only."""
    marks = faults(rows)
    best = (3 * len(rows), "D" * len(rows), ())

    def go(k, cost, audit, roles, lines, inserted):
        nonlocal best
        if cost > best[0]:
            return
        if k == len(rows) and GOOD.fullmatch(roles):
            best = min(best, (cost, audit, lines))
        if inserted < 2:
            for role in ("user", "assistant"):
                go(k, cost + 2, audit + "I", roles + role[0], (*lines, f"{role}:"), inserted + 1)
        if k == len(rows):
            return
        _, role, text = rows[k]
        go(k + 1, cost + 3, audit + "D", roles, lines, 0)
        if marks[k] in ("blank", "duplicate"):
            return
        late = marks[k] == "truncated"
        go(k + 1, cost + late, audit + "K", roles + (role[:1] or "?"), (*lines, f"{role}:{text}"), 0)
        for new in ("user", "assistant"):
            go(k + 1, cost + late + 2, audit + "R", roles + new[0], (*lines, f"{new}:{text}"), 0)

    go(0, 0, "", "", (), 0)
    return best


def expected(rows):
    out = {}
    damaged = damaged_rows(rows)
    for conv in {r[0] for r in rows}:
        held = damaged.get(conv, [])
        marks = Counter(faults(held))
        turns = {t for t, _, _ in held if t is not None}
        initials = [r[:1] for _, r, _ in held]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        cost, audit, lines = cheapest(held)
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        out[conv] = (gaps, marks["blank"], marks["duplicate"], marks["truncated"], illegal, cost, audit, digest)
    return out


def results(frame):
    names = "gaps blank duplicate truncated illegal cost audit repaired_sha256".split()
    return {r.conv_id: tuple(r[n] for n in names) for r in frame.collect()}


def random_rows(seed, conversations_=60, most=6):
    rng = random.Random(seed)
    roles = ["user", "assistant", "system", "user", "assistant", "unknown", "tool", "", None]
    texts = ["Yes.", "No?", "half", "", " \n", None, "é!", "Yes.", "one\ntwo.", "tail. \t"]
    rows = []
    for conv in range(conversations_):
        for _ in range(rng.randint(1, most)):
            turn = rng.choice([None, *range(5)])
            rows.append((conv if conv else None, turn, rng.choice(roles), rng.choice(texts)))
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", 1) for r in rows], SCHEMA)


@pytest.mark.parametrize("piece_rows", [4096, 2])
def test_cheapest_edits(spark, piece_rows):
    rows = random_rows(1)
    turns = frame(spark, rows)
    made = results(conversations.digested(turns, conversations.damage(turns), piece_rows))
    assert made == expected(rows)


def test_pieces_change_nothing(spark):
    rng = random.Random(3)
    rows = [
        (c, t if rng.random() < 0.9 else None, rng.choice(["user", "assistant", "system"]),
         rng.choice(["Same.", f"turn {t}.", f"cut {t}"]))
        for c in range(4) for t in range(700 if c == 2 else 40)
    ]
    turns = frame(spark, rows)
    whole = results(conversations.digested(turns, conversations.damage(turns)))
    assert results(conversations.digested(turns, conversations.damage(turns), 16)) == whole
    repaired = conversations.repair(conversations.damage(turns))[0].collect()
    for conv, held in damaged_rows(rows).items():
        said = sorted((r for r in repaired if r.conv_id == conv), key=lambda r: (r.piece, r.place))
        assert GOOD.fullmatch("".join(r.role[0] for r in said))
        assert Counter(r.edit for r in said if r.edit != "I") == Counter(
            e for e in whole[conv][6] if e in "KR"
        )
        assert len(held) == sum(e != "I" for e in whole[conv][6])


def test_checkpoints_equal_all_vectors():
    rng = random.Random(7)
    kinds = bytes(rng.choice([0, 1, 2, 3, 4, 5, 6, 7, 8]) for _ in range(500))
    every = conversations.vectors(kinds, conversations.LAST)
    some = conversations.checkpoints(kinds, conversations.LAST, 23)
    assert some[:-1] == every[:-1:23] and some[-1] == every[-1]
    audit = []
    state = conversations.walk(kinds, conversations.LAST, 0, True, lambda k, e, q: audit.append(e))
    late = sum(kind >> 2 & 1 for kind, e in zip(kinds, [e for e in audit if e != "I"]) if e in "KR")
    assert state in (0, 3) and every[0][0] == late + sum({"D": 3, "I": 2, "R": 2, "K": 0}[e] for e in audit)


def test_empty_and_all_dropped(spark):
    assert results(conversations.digested(frame(spark, []), conversations.damage(frame(spark, [])))) == {}
    gone = next(t for t in range(99) if zlib.crc32(f"1:{t}".encode()) % 20 == 0)
    turns = frame(spark, [(1, gone, "user", "Hi.")])
    nothing = hashlib.sha256(b"").hexdigest()
    assert results(conversations.digested(turns, conversations.damage(turns))) == {1: (0, 0, 0, 0, 0, 0, "", nothing)}


def test_one_long_text_and_many_copies(spark):
    rows = [(1, 0, "user", "x" * 500_000 + "."), *[(1, 1, "user", "Same.")] * 3000, (1, 2, "assistant", "Fine.")]
    turns = frame(spark, rows)
    made = results(conversations.digested(turns, conversations.damage(turns), 8))[1]
    held = damaged_rows(rows)[1]
    assert made[2] == Counter(faults(held))["duplicate"]
    assert len(made[6]) - made[6].count("I") == len(held)
