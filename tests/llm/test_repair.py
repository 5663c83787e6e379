"""Conversation repair against an enumeration of edits."""

import hashlib
import itertools
import random
import re
import zlib

import pytest

from thermocline.llm import repair

PATTERN = re.compile(r"(s?(ua)+)?\Z")
SPACE = "\x20\x09\x0a\x0b\x0c\x0d"


def faults(rows):
    """First fault of each (turn, role, text)."""
    found, seen = [], set()
    for _, role, text in rows:
        rest = text.strip(SPACE)
        found.append("blank" if not rest else "duplicate" if (role, text) in seen else "truncated" if rest[-1] not in ".!?" else "")
        seen.add((role, text))
    return found


def cheapest(rows, marks):
    """(cost, audit, repaired rows) by trying every edit of every row, and every insert between."""
    options = []
    for (_, role, text), mark in zip(rows, marks):
        ways = [(4, "D", [])]
        if mark not in ("blank", "duplicate"):
            stays = 3 if mark == "truncated" else 0
            ways += [(stays, "K", [(role, text)])] + [(3 + stays, "R", [(r, text)]) for r in ("user", "assistant")]
        options.append(ways)
    gaps = [(3 * n, "I" * n, [(r, "") for r in roles]) for n in range(3) for roles in itertools.product(("user", "assistant"), repeat=n)]
    best = None
    for ways in itertools.product(*[x for o in options for x in (gaps, o)], gaps):
        out = [r for w in ways for r in w[2]]
        if PATTERN.match("".join(r[0][0] if r[0] else "?" for r in out)):
            key = (sum(w[0] for w in ways), "".join(w[1] for w in ways))
            if best is None or key < best[0]:
                best = (key, out)
    return best[0][0], best[0][1], best[1]


def own(rows, marks, held=repair.HELD_BYTES):
    audit, out = [], []

    def emit(edit, role, text):
        audit.append(edit)
        if edit != "D":
            out.append((role, text))

    r = repair.Repair(emit, held)
    for (_, role, text), mark in zip(rows, marks):
        r.row(role, text, mark in ("blank", "duplicate"), mark == "truncated")
    return r.end(), "".join(audit), out


@pytest.mark.parametrize("seed", range(60))
def test_repair_is_the_least_of_all_edits(seed):
    rng = random.Random(seed)
    roles = ["user", "assistant", "user", "assistant", "system", "tool", ""]
    rows = [(k, rng.choice(roles), rng.choice(["Yes.", "no", " ", "Why?", f"t{k}!"])) for k in range(rng.randint(0, 3))]
    marks = faults(rows)
    assert own(rows, marks) == cheapest(rows, marks)


def whole(rows, marks):
    """The same programme with whole strings in place of pointers, for long conversations."""
    best = {0: (0, "", ())}
    for (_, role, text), mark in zip(rows, marks):
        new = {}
        for s, (cost, audit, out) in best.items():
            for n in range(3):
                ways = [("D", s, 4, ())]
                if mark not in ("blank", "duplicate"):
                    stays = 3 * (mark == "truncated")
                    k = 1 if role[:1] == "s" and s == 0 else 2 if role[:1] == "u" and s != 2 else 3 if role[:1] == "a" and s == 2 else None
                    if k is not None:
                        ways.append(("K", k, stays, ((role, text),)))
                    ways.append(("R", 3 if s == 2 else 2, 3 + stays, (("assistant" if s == 2 else "user", text),)))
                for op, t, price, rest in ways:
                    way = (cost + price, audit + op, out + rest)
                    if t not in new or way < new[t]:
                        new[t] = way
                out += (("assistant" if s == 2 else "user", ""),)
                cost, audit, s = cost + 3, audit + "I", 3 if s == 2 else 2
        best = new
    ends = []
    for s, n in ((0, 0), (1, 2), (2, 1), (3, 0)):
        if s in best:
            cost, audit, out = best[s]
            ends.append((cost + 3 * n, audit + "I" * n, out + (("user", ""), ("assistant", ""))[2 - n :] if n else out))
    cost, audit, out = min(ends)
    return cost, audit, list(out)


@pytest.mark.parametrize("seed", range(8))
def test_long_conversations_settle_and_spill(seed, monkeypatch):
    monkeypatch.setattr(repair, "LOOK", 4)
    monkeypatch.setattr(repair, "_BACK_BLOCK", 3)
    rng = random.Random(seed)
    rows = [(k, rng.choice(["user", "assistant", "system", "x"]), rng.choice([f"Turn {k}.", f"cut {k}", "", f"é😀 {k}!"])) for k in range(300)]
    marks = faults(rows)
    assert own(rows, marks, held=64) == whole(rows, marks)


def plain(rows):
    """Expected report of a conversation's damaged (turn, role, text) rows."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    marks = faults(rows)
    turns = {t for t, _, _ in rows if t is not None}
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    illegal = sum((a[1][:1] + b[1][:1]) not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    cost, audit, out = whole(rows, marks)
    digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in out).encode()).hexdigest()
    return (gaps, *(marks.count(m) for m in ("blank", "duplicate", "truncated")), illegal, cost, audit, digest)


def damaged(rows):
    found = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        lot = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if lot == 1 else re.sub("[.!?]", "", text) if lot == 2 else text
        found += [(conv, turn, "user" if lot == 4 else role, text)] * (0 if lot == 0 else 2 if lot == 3 else 1)
    return found


def test_query_equals_a_plain_version(spark, sf):
    from thermocline.llm.queries import QUERIES

    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    found = {r[0]: tuple(r)[1:] for r in QUERIES["op12_repair"](spark, sf).collect()}
    bad = damaged(rows)
    assert found == {c: plain([r[1:] for r in bad if r[0] == c]) for c in {r[0] for r in rows}}


def test_odd_rows(spark):
    rows = [(None, None, None, None), (None, 3, "user", "Null key."), (2**60 + 1, 1, "user", "big key, cut"), (1, None, "user", "first?"), (1, 5, "assistant", "one."), (1, 5, "assistant", "one."), (1, 9, "", "no role."), (2, 1, "user", " "), (2, 2, "assistant", "x \x0b ")]
    rows += [(3, k, ("user", "assistant")[k % 2], "long " * 20_000 + ".") for k in range(2)]
    frame = spark.createDataFrame([(*r, "z", 1) for r in rows], "conv_id long, turn long, role string, text string, cost string, `a.b` int")
    expected = {c: plain([(t, " " if r is None else r, " " if x is None else x) for k, t, r, x in rows if k == c]) for c in {r[0] for r in rows}}
    assert {r[0]: tuple(r)[1:] for r in repair.reports(frame).collect()} == expected
    assert {r[0]: tuple(r)[1:] for r in repair.reports(frame, held_bytes=1).collect()} == expected
    assert repair.reports(frame.limit(0)).count() == 0
    # the edits as rows tell the same
    audits = {}
    for r in sorted(repair.edits(frame).collect(), key=lambda r: r["place"]):
        audits[r["conv_id"]] = audits.get(r["conv_id"], "") + r["edit"]
    assert audits == {c: e[6] for c, e in expected.items()}


def test_all_rows_dropped(spark):
    frame = spark.createDataFrame([(7, 1, "user", "Hi.", True)], "conv_id long, turn long, role string, text string, dropped boolean")
    assert tuple(repair.reports(frame).first()) == (7, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
