import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from rowsieve.llm import lexical_search as ls
from rowsieve.llm.words import BETWEEN_TERMS, Words, pieces
from tests.llm.texts import awkward, frame, prose

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items, top=20):
    held = [(d, terms(t)) for d, t in docs]
    held = [(d, len(t), Counter(t)) for d, t in held if t]
    count, total = len(held), sum(n for _, n, _ in held)
    df = Counter(t for _, _, c in held for t in c)
    out = []
    for item_id, text in items:
        scores = []
        for d, n, c in held:
            m = 100 - 25 + (25 * n * count) // total
            score = sum(
                math.floor(1000 * math.log((2 * count + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 12 * m))
                for t in terms(text)
                if c[t]
            )
            if score > 0:
                scores.append((-score, d is None, d))
        for k, (score, _, d) in enumerate(sorted(scores, key=lambda x: (x[0], x[1], x[2] or 0))[:top]):
            out.append((item_id, k + 1, d, -score))
    return sorted(out, key=repr)


def found(spark, docs, items, **kw):
    item_rows = spark.createDataFrame([(*i, 1, 2) for i in items], "item_id long, text string, query long, score long")
    return sorted(map(tuple, ls.rank(frame(spark, docs), item_rows, **kw).collect()), key=repr)


def test_awkward_rows_ties_and_repeats(spark):
    docs = [*awkward(), (20, "one one"), (21, "ONE! (one)"), (22, "数字 one"), (None, "one one")]
    items = [(1, "one ONE two"), (2, None), (3, ""), (None, "Éa 数字"), (4, prose(30, 3)), (4, "one"), (5, "absent words")]
    assert found(spark, docs, items) == brute(docs, items)
    assert found(spark, docs, items, top=2) == brute(docs, items, top=2)
    empty = frame(spark, docs).limit(0)
    wanted = spark.createDataFrame(items, "item_id long, text string")
    assert ls.rank(empty, wanted).count() == 0 and ls.rank(frame(spark, docs), wanted.limit(0)).count() == 0


@pytest.mark.parametrize("bands", [(0.01, 0.1), (0.3, 0.6), ()])
def test_equals_brute_force(spark, bands):
    r = random.Random(5)
    docs = [(k, prose(r.randrange(1, 200), k, 150)) for k in range(400)]
    items = [(k, prose(r.randrange(1, 40), 9000 + k, 170)) for k in range(20)]
    docs += [(500 + k, prose(20, 77, 150) + " " + items[k % 20][1]) for k in range(60)]
    assert found(spark, docs, items, bands=bands) == brute(docs, items)


def test_buckets_keep_all_that_reach_a_score():
    r = np.random.default_rng(3)
    for _ in range(30):
        width, rows = 40, 60
        sizes = r.integers(1, 20, rows)
        row_terms = np.concatenate([np.sort(r.choice(width, s, replace=False)) for s in sizes])
        values = r.integers(1, 500_000, len(row_terms))
        ends = np.concatenate([[0], np.cumsum(sizes)])
        length = np.sqrt(np.add.reduceat(values.astype(float) ** 2, ends[:-1]))
        bucket = ls.Bucket(np.arange(rows), sizes, row_terms, values, length, width)
        weights = np.zeros(width, dtype=np.int64)
        mine = r.choice(width, 12, replace=False)
        weights[mine] = r.integers(0, 9000, 12)
        query = ls.Query.of(np.sort(mine), weights[np.sort(mine)])
        scores = np.add.reduceat(weights[row_terms] * values, ends[:-1])
        for least in (1, int(np.median(scores)) or 1, int(scores.max()), int(scores.max()) + 1):
            at, got = bucket.scored(query, least)
            assert sorted(at) == np.flatnonzero(scores >= least).tolist() and (got == scores[at]).all()


def test_pieces_cut_between_terms_only():
    text = ("ab cd-efg " * 500 + "x" * 90 + " tail").encode()
    for limit in (7, 16, 64, 10_000):
        parts = list(pieces(text, limit, BETWEEN_TERMS))
        assert b"".join(parts) == text and (limit < 90 or max(map(len, parts)) <= limit)
        assert np.concatenate([Words([p], BETWEEN_TERMS).hashes for p in parts]).tolist() == Words([text], BETWEEN_TERMS).hashes.tolist()


def test_long_texts_are_counted_in_pieces(monkeypatch):
    texts = [prose(3000, 1).encode(), b"", prose(5, 2).encode(), prose(900, 3).encode()]
    vocabulary = np.unique(Words([prose(50, 4).encode()], BETWEEN_TERMS).hashes)
    whole = ls._counted(texts, vocabulary)
    monkeypatch.setattr(ls, "PIECE_BYTES", 1000)
    for a, b in zip(whole, ls._counted(texts, vocabulary), strict=True):
        assert a.tolist() == b.tolist()
