import random
import subprocess
import sys
from pathlib import Path

import pytest

from rowsieve.llm import divide_skip as j
from tests.llm.test_words_tokens import plain_words
from tests.llm.texts import awkward, frame, prose


ROOT = Path(__file__).parents[2]


def brute(rows, rule):
    sets = []
    for _, text in rows:
        w = plain_words(text or "")
        n = rule.words
        sets.append({tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} - {()})
    root = {d: d for d, _ in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if None in (rows[a][0], rows[b][0]) or not sets[a] or not sets[b]:
                continue
            if rule.denominator * len(sets[a] & sets[b]) >= rule.numerator * len(sets[a] | sets[b]):
                x, y = sorted((find(rows[a][0]), find(rows[b][0])))
                root[y] = x
    return sorted(((d, len(s), None if d is None else find(d)) for (d, _), s in zip(rows, sets, strict=True)), key=repr)


def found(spark, rows, rule, **kw):
    return sorted(map(tuple, j.jaccard_components(frame(spark, rows), rule, **kw).collect()), key=repr)


def family(seed, copies, edits):
    """Copies of a text, each with some words changed."""
    r = random.Random(seed)
    base = prose(120, seed).split()
    out = []
    for _ in range(copies):
        words = list(base)
        for _ in range(r.randrange(edits + 1)):
            words[r.randrange(len(words))] = f"e{r.randrange(10**6)}"
        out.append(" ".join(words))
    return out


def test_awkward_rows(spark):
    rule = j.Rule(4, 85, 100)
    assert found(spark, awkward(), rule) == brute(awkward(), rule)
    assert j.jaccard_components(frame(spark, awkward()).limit(0), rule).count() == 0


@pytest.mark.parametrize("long_list", [100, 3])
def test_families_at_the_threshold_and_shared_passages(spark, long_list):
    rule = j.Rule(4, 85, 100)
    passage = prose(60, 77)
    texts = [t for s in range(6) for t in family(s, 8, 6)]
    texts += [prose(40 + 9 * s, 100 + s) + " " + passage for s in range(30)]
    texts += [f"{passage} tail{k}" for k in range(6)] + [" ".join(f"a{k}" for k in range(n)) for n in range(3, 14)]
    random.Random(4).shuffle(texts)
    rows = list(enumerate(texts))
    assert found(spark, rows, rule, long_list=long_list) == brute(rows, rule)


def test_near_copies_that_do_not_link_make_few_pairs(spark, monkeypatch):
    rule = j.Rule(4, 85, 100)
    r = random.Random(3)
    base = prose(150, 8).split()
    rows = []
    for d in range(90):
        words = list(base)
        for k in r.sample(range(0, 140, 9), 4):
            words[k] = f"e{d}x{k}"
        rows.append((d, " ".join(words)))
    made = []
    verified = j.verified
    monkeypatch.setattr(j, "verified", lambda docs, pairs, rule: made.append(pairs.count()) or verified(docs, pairs, rule))
    assert found(spark, rows, rule, long_list=20) == brute(rows, rule)
    assert sum(made) < len(rows)


def test_five_words_at_four_fifths(spark):
    rows = list(enumerate(t for s in range(10, 14) for t in family(s, 6, 8)))
    assert found(spark, rows, j.Rule()) == brute(rows, j.Rule())


def test_rule_bounds():
    rule = j.Rule(4, 85, 100)
    for n in range(1, 200):
        assert rule.least_overlap(n) == next(t for t in range(n + 1) if 100 * t >= 85 * n)
        assert rule.pair_overlap(n) == next(t for t in range(n + 1) if 185 * t >= 85 * n)
    with pytest.raises(ValueError):
        j.Rule(0, 1, 2)


def test_workers_of_the_join_need_no_pandas():
    code = "import sys, rowsieve.llm.divide_skip, rowsieve.llm.line_dedup; print('pandas' in sys.modules)"
    assert subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True, cwd=ROOT).stdout.strip() == "False"
