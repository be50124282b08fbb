"""Near-duplicate vectors by a forest of random-projection trees.

Vectors link when their cosine, in double precision, reaches a threshold. A tree splits
the vectors again and again along random directions near the middle; those within a
margin of a split go to both sides. Vectors are compared within leaves only, and many
trees with other directions make it unlikely that a linked pair never shares one.

* Equal vectors are one representative that counts as often as they occur.
* Splits are fitted on a bounded sample of each node (``SAMPLE`` vectors), several levels
  at a time, and all vectors are routed. Nodes that hold more than ``LEAF`` vectors after
  that are split again in the next round, so leaves stay small at any number of vectors.
* A node that splits do not make smaller (vectors so close that the margins hold them all)
  stays whole and is compared in pairs of blocks, each pair a group of its own.
* So does a node whose split would part too many of its linked pairs, as in a large loose
  group: the share of pairs kept is measured on the sample at every split and carried down
  the tree, and may not fall below what all trees together need for ``RECALL``.
* A pair that shares several leaves counts in the first of them, and vectors that all
  share an earlier leaf are not compared again: a close group costs one tree's work. So links are counted
  within leaves and summed, and no pairs leave a task: only sums and, for the components,
  at most one link a vector and leaf.

Vectors that are null, zero, or hold null or non-finite components link with nothing.
Vectors of unequal length never link: each length has a forest of its own. Rows with a
null id take no part: no links, a null component, ``kept`` null. Rows that repeat an id
are separate vectors that share it. An empty table gives an empty one.
"""

from __future__ import annotations

import functools
import math
import pickle
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowsieve.llm.common import stored
from rowsieve.llm.components import components, joined
from rowsieve.llm.words import mix

TREES = 6
LEAF = 1024
SAMPLE = 16_384
LEVELS = 10
SPILL = 0.35
MODEL_BYTES = 32 << 20
RECALL = 0.995
ANCHORS = 256
LEAST_PAIRS = 30
# Blocks with more than one linked pair in DENSE are counted as matrices, where vectors
# share so few earlier leaves that these fit so many words of bits.
DENSE = 16
DENSE_WORDS = 32

# Seed, threshold by heap number, margin, share of linked pairs kept by heap number, and
# the ends that stay whole.
Model = tuple[int, dict[int, float], float, dict[int, float], set[int]]


def near_vectors(vectors: DataFrame, threshold: float = 0.9, trees: int = TREES, leaf: int = LEAF, spill: float = SPILL) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for each row of ``vec_id, embedding``.

    ``n_links`` counts the other vectors linked directly, ``component_id`` is the smallest
    id reachable by links, ``kept`` says whether that is the vector's own.
    """
    if not 0 < threshold <= 1:
        raise ValueError("the threshold must be above 0, at most 1")
    kind = vectors.schema["embedding"].dataType.simpleString()
    embedding = F.col("embedding") if kind == "array<float>" else F.col("embedding").cast("array<double>")
    rows = vectors.select(F.col("vec_id").cast("long"), embedding)
    good = rows.where(_usable(F.col("embedding"))).where("vec_id IS NOT NULL")
    reps = good.groupBy("embedding").agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies"))
    reps = stored(reps.withColumn("row", F.monotonically_increasing_id()), "representatives")
    points = reps.select("row", "rep", "copies", "embedding", F.size("embedding").alias("width"))
    leaves = _leaves(points, threshold, trees, leaf, spill)
    found = stored(_compared(points, leaves, threshold, leaf), "found")

    sums = found.where("b IS NULL").groupBy(F.col("a").alias("row")).agg(F.sum("links").alias("links"))
    reps = stored(reps.join(sums, "row", "left").select("row", "rep", "copies", "embedding", F.coalesce("links", F.lit(0)).alias("links")), "linked")
    ids = reps.select("row", "rep")
    pairs = found.where("b IS NOT NULL").select("a", "b")
    pairs = pairs.join(ids.select(F.col("row").alias("a"), F.col("rep").alias("rep_a")), "a")
    pairs = pairs.join(ids.select(F.col("row").alias("b"), F.col("rep").alias("rep_b")), "b")
    groups = stored(components(pairs.select(F.col("rep_a").alias("a"), F.col("rep_b").alias("b"))), "groups")

    # Copies share their representative's links and component.
    reps = stored(reps.join(groups, reps.rep == groups.id, "left").select("embedding", "copies", "links", F.coalesce("component", "rep").alias("component")), "results")
    out = good.join(reps, "embedding")
    linked = out.select("vec_id", (F.col("links") + F.col("copies") - 1).alias("n_links"), F.col("component").alias("component_id"))
    alone = rows.where(~_usable(F.col("embedding")) | F.col("vec_id").isNull())
    alone = alone.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.union(alone).withColumn("kept", F.col("vec_id") == F.col("component_id"))


def _usable(vector):
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def _node(*parts) -> int:
    value = np.zeros(1, dtype=np.uint64)
    for p in parts:
        value = mix(value + np.uint64(int(p) % (1 << 64)) + np.uint64(0x9E37))
    return int(value.view(np.int64)[0])


def _unit(column: pa.Array | pa.ChunkedArray, width: int) -> np.ndarray:
    values = (column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column).flatten().to_numpy()
    x = values.reshape(-1, width).astype(np.float64)
    # Scaled first, so that no square overflows or vanishes.
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


@functools.lru_cache(maxsize=20_000)
def _direction(seed: int, number: int, width: int) -> np.ndarray:
    r = np.random.default_rng([seed % (1 << 63), number, width]).normal(size=width)
    return r / np.linalg.norm(r)


def fit_splits(x: np.ndarray, total: int, goal: int, seed: int, margin: float, threshold: float, kept: float, least: float) -> Model:
    """Splits of a node of ``total`` vectors, learned from the sample ``x``.

    ``kept`` is the share of linked pairs that the splits above have left together, and
    ``least`` what must be left at the ends.
    """
    splits: dict[int, float] = {}
    shares = {1: kept}
    whole: set[int] = set()
    todo = [(1, np.arange(len(x)))]
    while todo:
        number, rows = todo.pop()
        if number >= 1 << LEVELS or len(rows) < 16 or total * len(rows) / len(x) <= goal:
            continue
        p = x[rows] @ _direction(seed, number, x.shape[1])
        share = np.random.default_rng([seed % (1 << 63), number]).uniform(0.4, 0.6)
        at = float(np.quantile(p, share))
        low, high = rows[p < at + margin], rows[p >= at - margin]
        if max(len(low), len(high)) > 0.85 * len(rows):
            continue
        left = shares[number] * (1 - _parted(x[rows], p, at, margin, threshold, [seed % (1 << 63), number, 1]))
        if left < least:
            whole.add(number)
            continue
        splits[number] = at
        shares[2 * number] = shares[2 * number + 1] = left
        todo += [(2 * number, low), (2 * number + 1, high)]
    return seed, splits, margin, shares, whole


def _parted(x: np.ndarray, p: np.ndarray, at: float, margin: float, threshold: float, seed: list[int]) -> float:
    """The share of linked pairs, of some vectors with all, that neither side holds; 0
    where too few are linked to tell."""
    some = np.random.default_rng(seed).choice(len(x), size=min(ANCHORS, len(x)), replace=False)
    linked = x[some] @ x.T >= threshold
    linked[np.arange(len(some)), some] = False
    i, j = np.nonzero(linked)
    if len(i) < LEAST_PAIRS:
        return 0.0
    a, b = p[some[i]], p[j]
    return float(((np.maximum(a, b) >= at + margin) & (np.minimum(a, b) < at - margin)).mean())


def route(model: Model, x: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """``(heap number of the end, rows)`` for all ends that rows reach."""
    seed, splits, margin = model[:3]
    todo = [(1, np.arange(len(x)))]
    while todo:
        number, rows = todo.pop()
        if not len(rows):
            continue
        if number not in splits:
            yield number, rows
            continue
        p = x[rows] @ _direction(seed, number, x.shape[1])
        at = splits[number]
        todo += [(2 * number, rows[p < at + margin]), (2 * number + 1, rows[p >= at - margin])]


def _leaves(points: DataFrame, threshold: float, trees: int, leaf: int, spill: float) -> DataFrame:
    """``row, node``: the leaves of each vector."""
    count = points.count()
    trees = trees if count > leaf else 1
    # Linked unit vectors differ by at most this much, spread over all directions.
    reach = math.sqrt(max(0.0, 2 - 2 * threshold))
    least = 1 - (1 - RECALL) ** (1 / trees)
    roots = F.array(*[F.lit(_node(t)) for t in range(trees)])
    node = F.explode(roots).alias("root")
    # Widths never mix.
    at = points.select("row", "width", node)
    rows = at.select("row", F.xxhash64("root", "width").alias("node"), F.lit(count <= leaf).alias("final"), F.lit(1.0).alias("kept"))
    done = None
    while True:
        rows = stored(rows, "nodes")
        big = rows.where("NOT final").groupBy("node").agg(F.count("*").alias("total"), F.first("kept").alias("kept"))
        big = stored(big.where(F.col("total") > leaf), "big")
        rest = rows.join(big, "node", "left_anti").select("row", "node")
        done = rest if done is None else done.union(rest)
        if big.isEmpty():
            return done
        split = rows.where("NOT final").drop("kept").join(big, "node").join(points.select("row", "embedding"), "row")
        split = stored(split.select("row", "node", "total", "kept", "embedding"), "split")
        picked = split.where(F.pmod(F.xxhash64("row", "node"), F.col("total")) < SAMPLE)
        models = picked.groupBy("node").applyInArrow(_fitter(leaf // 2, reach, spill, threshold, least), "node long, model binary")
        models = stored(models, "models")
        rows = None
        for block in _model_blocks(models):
            part = split.where(F.col("node").isin(list(block))) if len(block) <= 1000 else split
            part = part.select("row", "node", "embedding").mapInArrow(_router(block), "row long, node long, final boolean, kept double")
            rows = part if rows is None else rows.union(part)


def _fitter(goal: int, reach: float, spill: float, threshold: float, least: float):
    def fit(group: pa.Table) -> pa.Table:
        width = len(group.column("embedding")[0])
        x = _unit(group.column("embedding"), width)
        node, total = group.column("node")[0].as_py(), group.column("total")[0].as_py()
        kept = group.column("kept")[0].as_py()
        model = fit_splits(x, total, goal, node, spill * reach / math.sqrt(width), threshold, kept, least)
        return pa.table({"node": pa.array([node], pa.int64()), "model": pa.array([pickle.dumps(model)], pa.binary())})

    return fit


def _model_blocks(models: DataFrame) -> Iterator[dict[int, bytes]]:
    block: dict[int, bytes] = {}
    size = 0
    for row in models.toLocalIterator():
        if block and size + len(row["model"]) > MODEL_BYTES:
            yield block
            block, size = {}, 0
        block[row["node"]] = bytes(row["model"])
        size += len(row["model"])
    yield block


def _router(block: dict[int, bytes]):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        models: dict[int, Model] = {}
        for batch in batches:
            nodes, ids = batch.column("node").to_numpy(), batch.column("row").to_numpy()
            for node in np.unique(nodes).tolist():
                if node not in block:
                    continue
                if node not in models:
                    models[node] = pickle.loads(block[node])
                model = models[node]
                here = np.flatnonzero(nodes == node)
                vectors = batch.column("embedding").take(pa.array(here))
                x = _unit(vectors, len(vectors[0]))
                for number, rows in route(model, x):
                    # A node without splits stays as it is.
                    new = node if number == 1 else _node(node, number)
                    final, kept = number == 1 or number in model[4], model[3][number]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(ids[here[rows]]), pa.array(np.full(len(rows), new)), pa.array(np.full(len(rows), final)), pa.array(np.full(len(rows), kept))],
                        names=["row", "node", "final", "kept"],
                    )

    return run


def _compared(points: DataFrame, leaves: DataFrame, threshold: float, leaf: int) -> DataFrame:
    """Sums ``(a, null, links)`` to add up, and links ``(a, b, null)`` that join the same
    vectors as all links do."""
    leaves = stored(leaves, "leaves")
    sizes = stored(leaves.groupBy("node").agg(F.ceil(F.count("*") / leaf).cast("int").alias("blocks")), "sizes")
    members = leaves.join(sizes, "node")
    members = members.groupBy("row").agg(F.sort_array(F.collect_set(F.struct("node", "blocks"))).alias("member"))
    rows = points.join(stored(members, "members"), "row")
    rows = rows.select("row", "copies", "embedding", F.col("member.node").alias("nodes"), F.explode("member").alias("m"))
    own = F.pmod(F.xxhash64("row", "m.node"), F.col("m.blocks")).cast("int")
    # Block i of k meets each block once: as the lower or the upper of the two.
    meets = F.transform(
        F.sequence(F.lit(0), F.col("m.blocks") - 1),
        lambda other: F.struct(F.least(own, other).alias("low"), F.greatest(own, other).alias("high")),
    )
    rows = rows.select("row", "copies", "embedding", "nodes", F.col("m.node").alias("node"), own.alias("block"), F.explode(meets).alias("pair"))
    rows = rows.select("row", "copies", "embedding", "nodes", "block", "node", "pair.*")
    return rows.groupBy("node", "low", "high").applyInArrow(_comparer(threshold), "a long, b long, links long")


def _comparer(threshold: float):
    def compare(group: pa.Table) -> pa.Table:
        width = len(group.column("embedding")[0])
        x = _unit(group.column("embedding"), width)
        ids, copies, block = (group.column(c).to_numpy() for c in ("row", "copies", "block"))
        node, low, high = (group.column(c)[0].as_py() for c in ("node", "low", "high"))
        lists = group.column("nodes").combine_chunks()
        bits, together = _leaf_bits(lists, node)
        # Those of the commonest earlier leaf have met there: they come last, and only
        # the others are compared with all.
        order = np.argsort(together, kind="stable")
        x, ids, copies, block, bits = x[order], ids[order], copies[order], block[order], bits[order]
        earlier = _earlier_leaves(lists, node)[order]
        weight = copies.astype(np.float64)
        links = np.zeros(len(ids), dtype=np.int64)
        root = np.arange(len(ids))
        apart = len(ids) - int(together.sum())
        for lo in range(0, apart, 512):
            hi = min(lo + 512, apart)
            close = x[lo:hi] @ x[lo:].T
            linked = np.triu(close >= threshold - 1e-12, 1)
            if low != high:
                linked &= block[lo:hi, None] != block[None, lo:]
            # Anew in one fixed order, so that it does not depend on the shape of the block.
            i, j = np.nonzero(linked & (close < threshold + 1e-12))
            linked[i, j] = np.einsum("ij,ij->i", x[lo + i], x[lo + j]) >= threshold
            if np.count_nonzero(linked) * DENSE > linked.size and bits.shape[1] <= DENSE_WORDS:
                for word in bits.T:
                    linked &= (word[lo:hi, None] & word[None, lo:]) == 0
                counted = linked.astype(np.float64)
                links[lo:hi] += (counted @ weight[lo:]).astype(np.int64)
                links[lo:] += (weight[lo:hi] @ counted).astype(np.int64)
                root = _joined_rows(root, linked, lo)
            else:
                i, j = np.nonzero(linked)
                first = ~_shared(earlier, node, lo + i, lo + j)
                i, j = lo + i[first], lo + j[first]
                np.add.at(links, i, copies[j])
                np.add.at(links, j, copies[i])
                root = joined(root, i, j)
        some, tied = np.flatnonzero(links), np.flatnonzero(root != np.arange(len(ids)))
        none = np.zeros(0, dtype=np.int64)
        a = np.concatenate([ids[some], ids[root[tied]], none])
        b = pa.concat_arrays([pa.nulls(len(some), pa.int64()), pa.array(ids[tied], pa.int64())])
        n = pa.concat_arrays([pa.array(links[some], pa.int64()), pa.nulls(len(tied), pa.int64())])
        return pa.table({"a": pa.array(a, pa.int64()), "b": b, "links": n})

    return compare


def _joined_rows(root: np.ndarray, linked: np.ndarray, lo: int) -> np.ndarray:
    """``root`` after joining the pairs set in ``linked``, whose rows and columns start at
    ``lo``: one pair of each row and column first, then those that this leaves apart."""
    rows, columns = np.flatnonzero(linked.any(axis=1)), np.flatnonzero(linked.any(axis=0))
    i = np.concatenate([rows, linked[:, columns].argmax(axis=0)])
    j = np.concatenate([linked[rows].argmax(axis=1), columns])
    root = joined(root, lo + i, lo + j)
    i, j = np.nonzero(linked & (root[lo : lo + len(linked), None] != root[None, lo:]))
    return joined(root, lo + i, lo + j)


def _leaf_bits(lists: pa.ListArray, node: int) -> tuple[np.ndarray, np.ndarray]:
    """For each vector a bit for each leaf before ``node`` that it shares with another one
    here, and which vectors are in the commonest of those leaves."""
    sizes = pa.compute.list_value_length(lists).to_numpy()
    owner, leaves = np.repeat(np.arange(len(sizes)), sizes), lists.flatten().to_numpy()
    owner, leaves = owner[leaves < node], leaves[leaves < node]
    _, number, count = np.unique(leaves, return_inverse=True, return_counts=True)
    place = np.cumsum(count > 1) - 1
    kept = count[number] > 1
    owner, number = owner[kept], number[kept]
    words = 1 + int(place[-1]) // 64 if len(count) else 0
    bits = np.zeros((len(sizes), words), dtype=np.uint64)
    at = place[number]
    np.bitwise_or.at(bits, (owner, at >> 6), np.uint64(1) << (at & 63).astype(np.uint64))
    together = np.zeros(len(sizes), dtype=bool)
    if len(number):
        together[owner[number == count.argmax()]] = True
    return bits, together


def _earlier_leaves(lists: pa.ListArray, node: int) -> np.ndarray:
    """For each vector its leaves before ``node``, filled up with ``node``."""
    sizes = pa.compute.list_value_length(lists).to_numpy()
    out = np.full((len(sizes), int(sizes.max())), node, dtype=np.int64)
    out[np.arange(out.shape[1])[None, :] < sizes[:, None]] = lists.flatten().to_numpy()
    out = np.minimum(out, node)
    return out[:, (out < node).any(axis=0)]


def _shared(earlier: np.ndarray, node: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Which pairs share a leaf before ``node``."""
    out = np.zeros(len(i), dtype=bool)
    for lo in range(0, len(i), 50_000):
        a, b = earlier[i[lo : lo + 50_000]], earlier[j[lo : lo + 50_000]]
        for k in range(a.shape[1]):
            column = a[:, k : k + 1]
            out[lo : lo + 50_000] |= ((column == b) & (column != node)).any(axis=1)
    return out
