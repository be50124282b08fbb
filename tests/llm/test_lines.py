import random

from hypothesis import given, settings
from hypothesis import strategies as st

from rowsieve.llm.line_dedup import dedup_lines, within_one_edit
from tests.llm.texts import awkward, frame, prose


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for k, y in enumerate(b, 1):
            new.append(min(row[k - 1] + (x != y), row[k] + 1, new[-1] + 1))
        row = new
    return row[-1]


@given(st.lists(st.sampled_from([b"a", b"b", b"c"]), max_size=6), st.lists(st.sampled_from([b"a", b"b", b"c"]), max_size=6))
@settings(max_examples=300, deadline=None)
def test_one_edit(a, b):
    assert within_one_edit(a, b) == (distance(a, b) <= 1)


def brute(rows, least):
    """Texts without the lines that an earlier one matches; rows sorted by id."""
    seen, out = [], []
    for doc_id, text in sorted((r for r in rows if None not in r), key=lambda r: r[0]):
        kept = []
        for line in text.split("\n"):
            words = line.lower().encode().split()
            if len(words) >= least:
                if any(abs(len(words) - len(s)) < 2 and within_one_edit(words, s) for s in seen):
                    seen.append(words)
                    continue
                seen.append(words)
            kept.append(line)
        out.append((doc_id, "\n".join(kept)))
    return out + [r for r in rows if None in r]


def found(spark, rows, **kw):
    kept = dedup_lines(frame(spark, rows).repartition(4), **kw)
    assert kept.columns == ["doc_id", "text", "score", "rule", "licence", "line", "path", "removed_lines"]
    return sorted((tuple(r)[:2] for r in kept.collect()), key=repr)


def test_edits_chains_and_templates(spark):
    r = random.Random(8)
    base = [prose(n, 50 + n).split() for n in (10, 11, 12, 25, 40)]
    lines = []
    for words in base:
        for _ in range(14):
            w = list(words)
            for _ in range(r.randrange(3)):
                at, kind = r.randrange(len(w)), r.randrange(3)
                if kind == 0:
                    w[at] = r.choice(["X", "x", "new"])
                elif kind == 1:
                    w.insert(at, r.choice(["X", w[at]]))
                else:
                    del w[at]
            lines.append(" ".join(w))
    lines += [f"one two three four five {k} seven eight nine ten" for k in range(12)]
    lines += ["short line", "", "short line", "a a a a a a a a a a a", "a a a a a a a a a a"] * 3
    r.shuffle(lines)
    rows = [(i, "\n".join(lines[k : k + 5])) for i, k in enumerate(range(0, len(lines), 5))]
    assert found(spark, rows) == sorted(brute(rows, 10), key=repr)
    assert found(spark, rows, least_words=4) == sorted(brute(rows, 4), key=repr)


def test_awkward_rows(spark):
    rows = awkward()
    kept = found(spark, rows)
    # Rows with the same id and text stay alike; later copies of a text lose it.
    texts = {}
    for doc_id, text in kept:
        texts.setdefault(doc_id, set()).add(text)
    assert len(kept) == len(rows)
    assert texts[4] == {rows[5][1]} and texts[5] == {""}
    assert texts[6] == {rows[7][1]} and texts[7] == {""}
    assert texts[None] == {None, rows[1][1]} and texts[1] == {None} and texts[8] == texts[9] == {"one"}
    assert dedup_lines(frame(spark, rows).limit(0)).count() == 0


def test_rows_that_share_an_id_lose_their_own_lines_only(spark):
    a, b, c = (prose(12, s) for s in (1, 2, 3))
    kept = found(spark, [(1, a), (2, f"{b}\n{c}"), (2, f"{a}\nzz\n{c} more")])
    assert sum(c in t for _, t in kept) == 1 and sum(a in t for _, t in kept) == 1
    assert (1, a) in kept


def test_short_lines_that_are_equal_go(spark):
    short = ["Menu", "menu", "Share this page now", "share  this page NOW", "Share this page today", "", "one"]
    r = random.Random(4)
    lines = [r.choice(short) for _ in range(90)] + [prose(12, k % 5) for k in range(10)] + [prose(9, 3)] * 3
    r.shuffle(lines)
    rows = [(i, "\n".join(lines[k : k + 4])) for i, k in enumerate(range(0, len(lines), 4))]
    seen, expected = [], []
    for doc_id, text in rows:
        kept = []
        for line in text.split("\n"):
            words = line.lower().encode().split()
            again = words in seen or (len(words) >= 10 and any(len(s) >= 10 and within_one_edit(words, s) for s in seen))
            if not (words and again):
                kept.append(line)
            seen.append(words)
        expected.append((doc_id, "\n".join(kept)))
    assert found(spark, rows, exact_words=1) == sorted(expected, key=repr)


def test_columns_named_like_temporary_ones(spark):
    names = ["_lines", "_doc", "_tie", "lines", "tie", "row", "removed", "gone_id", "line", "own", "at"]
    rows = [(1, "a b\nc d", *names), (2, "c d\ne", *names), (None, None, *names)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, " + ", ".join(f"{n} string" for n in names))
    kept = dedup_lines(docs, exact_words=1)
    assert kept.columns == [*docs.columns, "removed_lines"]
    out = {r["doc_id"]: r for r in kept.collect()}
    assert [out[2][n] for n in names] == names and out[2]["text"] == "e" and out[2]["removed_lines"] == 1
    assert out[1]["text"] == "a b\nc d" and out[None]["text"] is None and out[None]["removed_lines"] == 0
