import numpy as np
from pyspark.sql import functions as F

from rowsieve.llm import quality_mil as q
from tests.llm.texts import awkward, frame, prose


def labelled(n):
    rows = []
    for i in range(n):
        good = i % 3 > 0
        text = prose(150, i) if good else " ".join(f"{w}###" for w in prose(150, i).split())
        rows.append((i, text, int(good)))
    return rows


def test_learns_and_scores_whole_bags(spark):
    rows = labelled(240)
    docs = frame(spark, [r[:2] for r in rows])
    labels = spark.createDataFrame([(i, y) for i, _, y in rows if i % 5], "doc_id long, label int")
    model = q.train(docs, labels)
    scored = q.score(docs.union(frame(spark, awkward())), model)
    assert scored.columns == docs.columns[:2] + docs.columns[3:] + ["score"]
    found = {r["doc_id"]: r["score"] for r in scored.collect() if r["rule"] == "r" and r["doc_id"] in range(20, 240)}
    held = [(found[i], y) for i, _, y in rows if i % 5 == 0 and i >= 20]
    assert all((s >= q.THRESHOLD) == bool(y) for s, y in held)
    assert all(0 <= r["score"] <= 1 for r in scored.collect())


def test_a_damaged_part_lowers_the_score(spark):
    rows = labelled(240)
    model = q.train(
        frame(spark, [r[:2] for r in rows]),
        spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, label int"),
    )
    clean = prose(400, 999)
    mixed = clean + " " + " ".join(f"{w}###" for w in clean.split())
    x, bounds = q.passages([clean.encode(), mixed.encode()])
    a, b = model.score(x, bounds)
    assert b < a


def test_without_both_labels_there_is_no_model(spark):
    docs = frame(spark, awkward())
    labels = spark.createDataFrame([(1, 1), (2, None), (None, 0), (3, 7)], "doc_id long, label int")
    assert q.train(docs, labels) is None
    assert q.train(docs, labels.limit(0)) is None
    assert {r["score"] for r in q.score(docs, None).collect()} == {0.5}


def test_gradients_match_differences():
    r = np.random.default_rng(0)
    x, bounds, y = r.normal(size=(7, 5)), np.array([0, 2, 3, 7]), np.array([1.0, 0.0, 1.0])
    w = {
        "enc": r.normal(size=(5, 4)), "enc0": r.normal(size=4), "att": r.normal(size=(4, 3)),
        "gate": r.normal(size=(4, 3)), "pick": r.normal(size=3), "out": r.normal(size=4), "out0": np.array(0.3),
    }

    def loss(w):
        s = q._forward(w, x, bounds)["score"]
        return -np.mean(y * np.log(s) + (1 - y) * np.log(1 - s))

    for name, grad in q._gradients(w, x, bounds, y).items():
        for at in [(0,) * w[name].ndim, tuple(n - 1 for n in w[name].shape)]:
            up, down = ({**w, name: w[name].copy()} for _ in range(2))
            up[name][at] += 1e-5
            down[name][at] -= 1e-5
            assert np.isclose((loss(up) - loss(down)) / 2e-5, np.asarray(grad)[at], atol=1e-6), name


def test_passage_encoding_does_not_depend_on_neighbours():
    texts = [(t or "").encode() for _, t in awkward()]
    together, bounds = q.passages(texts)
    assert np.isfinite(together).all()
    for i, text in enumerate(texts):
        alone, _ = q.passages([text])
        assert np.allclose(alone, together[bounds[i] : bounds[i + 1]], atol=1e-6)


def test_empty_table(spark):
    docs = frame(spark, awkward()).limit(0)
    assert q.score(docs, None).count() == 0
    assert q.score(docs.where(F.lit(False)), q.Model(np.zeros(q.N_FEATURES), np.ones(q.N_FEATURES), {})).count() == 0
