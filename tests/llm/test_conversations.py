import hashlib
import itertools
import random
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from rowsieve.llm import conversation_repair as cr

TURNS = "conv_id long, turn long, role string, text string, task int, block int, start int, seen string, audit string"
GOOD = re.compile("(s?(ua)+)?")


def apply(rows, audit):
    """Cost and result of an audit, or None; roles follow from what stands before."""
    out, cost, i = [], 0, 0
    for edit in audit:
        if edit != "I" and i >= len(rows):
            return None
        state = out[-1][0][:1] if out else ""
        follows = "assistant" if state == "u" else "user"
        if edit == "I":
            cost, out = cost + 3, [*out, (follows, "")]
            continue
        role, text, fault = rows[i]
        i += 1
        if edit == "D":
            cost += 4
            continue
        if fault in ("blank", "duplicate"):
            return None
        cost += 3 * (fault == "truncated") + 3 * (edit == "R")
        out.append((role if edit == "K" else follows, text))
    if i < len(rows) or not GOOD.fullmatch("".join(r[:1] or "-" for r, _ in out)):
        return None
    return cost, audit, out


def faults(rows):
    seen, out = set(), []
    for role, text in rows:
        bare = text.rstrip(" \t\n\x0b\x0c\r")
        if not bare:
            out.append((role, text, "blank"))
        elif (role, text) in seen:
            out.append((role, text, "duplicate"))
        else:
            out.append((role, text, "truncated" if bare[-1] not in ".!?" else ""))
        seen.add((role, text))
    return out


def least(rows):
    """Best of all prefixes that end in the same state, row by row, insertions included."""
    best = {"": (0, "", [])}

    def take(into, key, value):
        if key not in into or value[:2] < into[key][:2]:
            into[key] = value

    def inserted(states):
        for _ in range(3):
            for s, (cost, audit, out) in list(states.items()):
                new = "a" if s == "u" else "u"
                take(states, new, (cost + 3, audit + "I", [*out, ({"a": "assistant", "u": "user"}[new], "")]))
        return states

    for role, text, fault in rows:
        now = {}
        for s, (cost, audit, out) in inserted(best).items():
            take(now, s, (cost + 4, audit + "D", out))
            if fault in ("blank", "duplicate"):
                continue
            more = 3 * (fault == "truncated")
            new = "a" if s == "u" else "u"
            if role[:1] == new or (s == "" and role[:1] == "s"):
                take(now, role[:1], (cost + more, audit + "K", [*out, (role, text)]))
            take(now, new, (cost + more + 3, audit + "R", [*out, ({"a": "assistant", "u": "user"}[new], text)]))
        best = now
    best = inserted(best)
    return min((best[s] for s in ("", "a") if s in best), key=lambda x: x[:2])


def report(turns):
    """Of one conversation's ``(turn, role, text)`` in order."""
    rows = faults([(r, t) for _, r, t in turns])
    known = [t for t, *_ in turns if t is not None]
    cost, audit, out = least(rows)
    kinds = [sum(f == k for *_, f in rows) for k in ("blank", "duplicate", "truncated")]
    pairs = [a[0][:1] + b[0][:1] for a, b in zip(rows, rows[1:], strict=False)]
    gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
    text = "\n".join(f"{r}:{t}" for r, t in out)
    return (gaps, *kinds, sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, hashlib.sha256(text.encode()).hexdigest())


role = st.sampled_from(["system", "user", "assistant", "tool", "", " "])
text = st.sampled_from(["", " \n", "a.", "b!", "c", "d? "])


@given(st.lists(st.tuples(role, text), max_size=3))
@settings(max_examples=150, deadline=None)
def test_search_equals_every_audit_tried(rows):
    judged = faults(rows)
    letters = ("".join(a) for n in range(len(rows) + 4) for a in itertools.product("DIKR", repeat=n))
    every = filter(None, (apply(judged, a) for a in letters))
    assert least(judged) == min(every, key=lambda x: x[:2])


@given(st.lists(st.tuples(role, text), max_size=30))
@settings(max_examples=300, deadline=None)
def test_search_equals_best_prefixes(rows):
    made = cr.Rows([None] * len(rows), [r for r, _ in rows], [t for _, t in rows])
    made.judge()
    cost, audit, out = least(faults(rows))
    assert cr.search(made, cr.NOTHING, cr._FINISH, True)[0] == audit
    assert cr._cost(made, audit) == cost and cr.repaired(made, cr.NOTHING, audit) == out


def talk(r, n, junk=0.3):
    out = []
    for k in range(n):
        role = ["user", "assistant"][k % 2] if r.random() > junk else r.choice(["system", "user", "tool", "assistant", ""])
        text = f"turn {r.randrange(40)}" + r.choice([".", "!", "", "? "]) if r.random() > junk / 3 else r.choice(["", " "])
        out.append((k + r.randrange(2), role, text))
    return sorted(out, key=lambda x: x[0])


def found(spark, rows, **kw):
    frame = spark.createDataFrame([(*x, 1, 2, 3, "s", "a") for x in rows], TURNS)
    return {x[0]: tuple(x[1:]) for x in cr.report(cr.repair(frame, **kw)).collect()}


def in_order(spark, rows):
    """Rows by conversation in the operator's order."""
    from pyspark.sql import functions as F

    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").na.fill(" ", ["role", "text"])
    rows = frame.orderBy("conv_id", F.asc_nulls_first("turn"), "role", F.xxhash64("text")).collect()
    out = {}
    for c, *rest in rows:
        out.setdefault(c, []).append(tuple(rest))
    return out


@pytest.mark.parametrize("block_rows", [1, 3, 10_000])
def test_reports_whatever_the_blocks(spark, block_rows):
    r = random.Random(8)
    rows = [(c, *x) for c in range(25) for x in talk(r, r.randrange(1, 24))]
    rows += [(c, *x) for c in (100, 101) for x in talk(r, 120)] + [(None, *x) for x in talk(r, 9)]
    rows += [(200, None, "user", "a."), (200, None, None, None), (201, None, None, "x"), (202, 5, "system", "alone."), (203, 1, "user", " ")]
    rows += [(204, 3, "user", "same.")] * 12 + [(-1, 2**40, "user", "a."), (-1, -5, "assistant", "b.")]
    r.shuffle(rows)
    assert found(spark, rows, block_rows=block_rows) == {c: report(x) for c, x in in_order(spark, rows).items()}


def test_empty_and_repaired_rows(spark):
    frame = spark.createDataFrame([(1, 0, "user", "a."), (1, 1, "user", "b"), (1, 2, "assistant", "c.")], TURNS.split(", task")[0])
    made = cr.repair(frame)
    assert [tuple(x)[4:] for x in cr.repaired_rows(made).orderBy("place").collect()] == [("user", "a."), ("assistant", "c.")]
    assert [r["audit"] for r in cr.report(made).collect()] == ["KDK"]
    none = cr.repair(frame.limit(0))
    assert none.count() == 0 and cr.report(none).count() == 0


def test_damage(spark):
    import zlib

    rows = [(c, t, "assistant", "A. b! c? d") for c in range(30) for t in range(10)] + [(None, 1, None, None), (1, None, "system", None)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    expected = []
    for c, t, role, text in rows:
        fault = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        role, text = role or " ", text or " "
        made = (c, t, "user" if fault == 4 else role, {1: "", 2: re.sub("[.!?]", "", text)}.get(fault, text))
        expected += [made] * {0: 0, 3: 2}.get(fault, 1)
    assert sorted(map(tuple, cr.damaged(frame).collect()), key=repr) == sorted(expected, key=repr)
    assert cr.damaged(frame).columns == ["conv_id", "turn", "role", "text"]
