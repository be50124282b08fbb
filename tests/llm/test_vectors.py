import numpy as np
import pyarrow as pa
import pytest

from rowsieve.llm import rp_forest
from rowsieve.llm.components import components
from rowsieve.llm.rp_forest import near_vectors


def brute(rows, threshold):
    """Links and components from all pairs."""
    good = {}
    for i, (vec_id, v) in enumerate(rows):
        if vec_id is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            x = np.array(v, dtype=np.float64)
            good[i] = x / np.linalg.norm(x)
    links = {i: set() for i in range(len(rows))}
    for i in good:
        for j in good:
            if i != j and len(good[i]) == len(good[j]) and good[i] @ good[j] >= threshold:
                links[i].add(j)
    out = []
    for i, (vec_id, _) in enumerate(rows):
        seen, todo = {i}, [i]
        while todo:
            todo += [k for k in links[todo.pop()] if k not in seen and not seen.add(k)]
        low = None if vec_id is None else min(rows[k][0] for k in seen)
        out.append((vec_id, len(links[i]), low, None if vec_id is None else low == vec_id))
    return sorted(out, key=repr)


def clusters(n, d=16, seed=3):
    r = np.random.default_rng(seed)
    centres = r.normal(size=(n // 4, d))
    return [(int(i), (centres[r.integers(len(centres))] + 0.15 * r.normal(size=d)).astype(np.float32).tolist()) for i in range(n)]


@pytest.mark.parametrize("kind", ["array<float>", "array<double>"])
def test_small_and_awkward_vectors(spark, kind):
    rows = [
        (1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, [1.0, 0.0]), (3, [1.0, 0.0]), (4, [0.0, 1.0]),
        (5, None), (6, [0.0, 0.0]), (7, [None, 1.0]), (8, [float("nan"), 1.0]), (9, [float("inf"), 1.0]),
        (10, []), (11, [1.0, 0.0, 0.0]), (None, [1.0, 0.0]), (-5, [0.9, 0.1]), (12, [1e-30, 0.0]),
    ]
    df = spark.createDataFrame([(*r, 0, 0, 0) for r in rows], f"vec_id long, embedding {kind}, rep int, copies int, node int")
    found = sorted(map(tuple, near_vectors(df, 0.9).collect()), key=repr)
    assert found == brute(rows, 0.9)
    assert near_vectors(df.limit(0), 0.9).count() == 0


def test_many_leaves_find_the_links(spark):
    rows = clusters(1500)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    found = sorted(map(tuple, near_vectors(df, 0.9, leaf=100).collect()), key=repr)
    truth = brute(rows, 0.9)
    assert sum(t[1] for t in truth) > 2000
    assert all(f[1] <= t[1] for f, t in zip(found, truth, strict=True))
    assert sum(f[1] for f in found) >= 0.97 * sum(t[1] for t in truth)


def test_a_close_group_larger_than_a_leaf_is_compared_in_blocks(spark):
    r = np.random.default_rng(1)
    near = r.normal(size=16)
    rows = [(i, (near + 0.01 * r.normal(size=16)).tolist()) for i in range(400)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = near_vectors(df, 0.9, trees=3, leaf=64).collect()
    assert {(x["n_links"], x["component_id"]) for x in found} == {(399, 0)}


def test_a_loose_group_of_many_leaves_keeps_its_links(spark):
    r = np.random.default_rng(6)
    near = r.normal(size=64)
    near /= np.linalg.norm(near)
    # A third of the rows at a mean cosine of about 0.91, the others anywhere.
    group = near + 0.315 / 8 * r.normal(size=(2000, 64))
    x = np.concatenate([group, r.normal(size=(4000, 64))])
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    truth = (unit @ unit.T >= 0.9).sum(axis=1) - 1
    assert 0.9 < (unit[:2000] @ unit[:2000].T).mean() < 0.92
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = {f["vec_id"]: f["n_links"] for f in near_vectors(df, 0.9, leaf=64).collect()}
    assert all(found[i] <= truth[i] for i in found)
    assert sum(found.values()) >= 0.99 * truth.sum() > 1_000_000


@pytest.mark.parametrize("dense", [1, 1 << 40])
@pytest.mark.parametrize("low, high", [(0, 0), (0, 1)])
def test_a_leaf_counts_pairs_that_share_no_earlier_leaf(dense, low, high, monkeypatch):
    monkeypatch.setattr(rp_forest, "DENSE", dense)
    r = np.random.default_rng(8)
    n, node = 700, 50
    x = r.normal(size=(6, 8))[r.integers(6, size=n)] + 0.25 * r.normal(size=(n, 8))
    nodes = [sorted({node, *r.choice([7, 8, 9, 60, *range(100, 140), *range(20, 49)], size=3).tolist()}) for _ in range(n)]
    copies, block, ids = r.integers(1, 4, n), r.integers(low, high + 1, n), r.permutation(n) + 1000
    group = pa.table({"row": ids, "copies": copies, "block": block, "embedding": x.tolist(), "nodes": nodes})
    for name, value in (("node", node), ("low", low), ("high", high)):
        group = group.append_column(name, pa.array([value] * n))
    found = rp_forest._comparer(0.9)(group).to_pylist()
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    links, reach = dict.fromkeys(ids.tolist(), 0), {i: {i} for i in ids.tolist()}
    for i in range(n):
        for j in range(i):
            met = {k for k in nodes[i] if k < node} & set(nodes[j])
            if unit[i] @ unit[j] >= 0.9 and not met and (low == high or block[i] != block[j]):
                links[ids[i]] += copies[j]
                links[ids[j]] += copies[i]
                both = reach[ids[i]] | reach[ids[j]]
                reach.update(dict.fromkeys(both, both))
    assert sum(links.values()) > 5_000
    assert {f["a"]: f["links"] for f in found if f["b"] is None} == {k: v for k, v in links.items() if v}
    ours = {i: {i} for i in ids.tolist()}
    for f in found:
        if f["b"] is not None:
            both = ours[f["a"]] | ours[f["b"]]
            ours.update(dict.fromkeys(both, both))
    assert ours == reach


def test_components_of_chains_stars_and_copies(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, k) for k in range(101, 130)] + [(7, 6), (5, 5), (None, 3), (300, 299)]
    df = spark.createDataFrame(links, "a long, b long")
    found = {r["id"]: r["component"] for r in components(df).collect()}
    expected = {i: 0 for i in range(41)} | {i: 100 for i in range(100, 130)} | {299: 299, 300: 299}
    assert found == expected
    assert components(df.limit(0)).count() == 0
