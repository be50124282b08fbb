import random

import numpy as np
import pytest

from rowsieve.llm import cgk_decontam as c
from tests.llm.test_lines import distance
from tests.llm.test_words_tokens import plain_words
from tests.llm.texts import awkward, frame, prose


def edited(text, edits, seed):
    r = random.Random(seed)
    words = text.split()
    for _ in range(edits):
        at, kind = r.randrange(len(words)), r.randrange(3)
        if kind == 0:
            words[at] = f"e{r.randrange(999)}"
        elif kind == 1:
            words.insert(at, f"e{r.randrange(999)}")
        else:
            del words[at]
    return " ".join(words)


def brute(docs, items, share):
    out = set()
    for doc_id, text in docs:
        words = plain_words(text or "")
        for item_id, item in items:
            want = plain_words(item or "")
            bound = c.most_edits(len(want), share)
            if want and any(
                distance(want, words[p:q]) <= bound
                for p in range(len(words) + 1)
                for q in range(max(p, p + len(want) - bound), min(len(words), p + len(want) + bound) + 1)
            ):
                out.add((doc_id, item_id))
    return out


def items_frame(spark, items):
    return spark.createDataFrame([(*i, 0) for i in items], "item_id long, text string, doc_id int")


def test_finds_what_brute_force_finds(spark):
    items = [(k, prose(n, 500 + k, 5000)) for k, n in enumerate((8, 12, 20, 31, 40))]
    docs = []
    for k, (_, text) in enumerate(items):
        for e in range(6):
            docs.append((len(docs), prose(15, 900 + len(docs)) + " " + edited(text, e, k * 10 + e) + "\n" + prose(10, 40 + e)))
    docs += [(200 + k, prose(60, k)) for k in range(10)]
    truth = brute(docs, items, 0.1)
    found = {(r["doc_id"], r["item_id"]) for r in c.contamination(frame(spark, docs), items_frame(spark, items)).collect()}
    assert found <= truth
    assert len(found) >= 0.95 * len(truth) > 8
    exact = {(d, i) for d, t in docs for i, x in items if f" {x}\n" in t}
    assert exact <= found
    kept = {r["doc_id"] for r in c.decontaminate(frame(spark, docs), items_frame(spark, items)).collect()}
    assert kept == {d for d, _ in docs} - {d for d, _ in found}


def test_awkward_rows(spark):
    items = items_frame(spark, [(1, None), (2, ""), (None, prose(40, 3)), (3, prose(40, 3)), (3, prose(40, 3)), (4, "one")])
    docs = frame(spark, awkward())
    found = sorted({(r["doc_id"], r["item_id"], r["edits"], r["start_word"]) for r in c.contamination(docs, items).collect()})
    assert found == [(6, 3, 0, 0), (7, 3, 0, 0), (8, 4, 0, 0), (9, 4, 0, 0)]
    kept = c.decontaminate(docs, items)
    assert kept.columns == docs.columns and kept.count() == len(awkward()) - 5
    assert c.contamination(docs.limit(0), items).count() == 0
    assert c.contamination(docs, items.limit(0)).count() == 0
    assert c.decontaminate(docs, items.limit(0)).count() == len(awkward())


def test_blocks_of_items_do_not_change_the_result(spark, monkeypatch):
    items = items_frame(spark, [(k, prose(20, 500 + k)) for k in range(5)])
    docs = frame(spark, [(k, prose(9, k) + " " + prose(20, 500 + k)) for k in range(5)])
    whole = sorted(map(tuple, c.contamination(docs, items).collect()))
    monkeypatch.setattr(c, "BLOCK_WORDS", 30)
    assert len(list(c.item_blocks(items))) == 3
    assert sorted(map(tuple, c.contamination(docs, items).collect())) == whole


@pytest.mark.parametrize("bound", [0, 1, 3])
def test_edit_distance_with_a_free_end(bound):
    r = np.random.default_rng(bound)
    for _ in range(200):
        a, b = r.integers(0, 3, r.integers(1, 9)).astype(np.uint64), r.integers(0, 3, r.integers(1, 12)).astype(np.uint64)
        best = min(distance(a.tolist(), b[:q].tolist()) for q in range(len(b) + 1))
        assert c.edit_distance(a, b, bound) == (best if best <= bound else None)


@pytest.mark.parametrize("seed", range(12))
def test_copies_inside_texts_are_found(seed):
    """All exact copies, whatever the seed and length, and nearly all edited ones."""
    r = random.Random(seed)
    items = [prose(r.randrange(4, 61), 10_000 * seed + k, 5000) for k in range(120)]
    index = c.Index(list(range(len(items))), [x.encode() for x in items], seed=seed)
    around = lambda k, x: f"{prose(12, 70_000 + k, 5000)} {x} {prose(80, 90_000 + k, 5000)}".encode()
    exact = {(t, i) for t, i, edits, _ in index.matches([around(k, x) for k, x in enumerate(items)]) if edits == 0}
    assert {(k, k) for k in range(len(items))} <= exact
    near = [(k, edited(x, c.most_edits(len(x.split()), 0.1), k)) for k, x in enumerate(items) if len(x.split()) >= 20]
    found = {(t, i) for t, i, *_ in index.matches([around(k, x) for k, x in near])}
    assert sum((t, k) in found for t, (k, _) in enumerate(near)) >= 0.95 * len(near)
