"""Connected components of a graph given by its links."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowsieve.llm.common import stored


def components(links: DataFrame) -> DataFrame:
    """``(id, component)`` for every id of the links ``(a, b)``: the smallest id it reaches.

    Alternates two steps until only stars are left: every node hands its larger neighbours
    to its smallest one, then its smaller neighbours. Each step keeps at most as many links
    as there were, and their number of rounds is logarithmic, also on chains. Between
    rounds every partition joins its own links, which saves most of the rounds. Minima are
    combined before the shuffle and stored before they are joined, so that Spark can
    split the join at a node with very many links.

    Nulls and links from a node to itself are ignored; an empty table gives an empty one.
    """
    links = (
        links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        .where("a <> b")
        .distinct()
    )
    links = _contracted(stored(links, "links"))
    while not _are_stars(links):
        both = links.union(links.select("b", "a"))
        links = _to_smallest(both, larger_only=True)
        links = _to_smallest(links.select(F.col("b").alias("a"), F.col("a").alias("b")), larger_only=False)
        links = _contracted(links)
    members = links.select(F.col("b").alias("id"), F.col("a").alias("component"))
    return members.union(links.select("a", "a")).distinct()


def _are_stars(links: DataFrame) -> bool:
    """Whether every node is either the smallest of its links or in one link only."""
    ends = links.select(F.col("a").alias("id"), F.lit(True).alias("first"), F.lit(0).alias("n"))
    ends = ends.union(links.select("b", F.lit(False), F.lit(1)))
    nodes = ends.groupBy("id").agg(F.max("first").alias("first"), F.sum("n").alias("n"))
    return nodes.where("n > 1 OR (first AND n > 0)").isEmpty()


def _contracted(links: DataFrame) -> DataFrame:
    """Links from the smallest node of each group within a partition to the others, which
    join the same nodes as before. A partition's links fit a task like any partition."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [(b.column("a").to_numpy(), b.column("b").to_numpy()) for b in batches if b.num_rows]
        if not parts:
            return
        a, b = (np.concatenate(x) for x in zip(*parts, strict=True))
        ids, place = np.unique(np.concatenate([a, b]), return_inverse=True)
        root = joined(np.arange(len(ids)), place[: len(a)], place[len(a) :])
        member = np.flatnonzero(root != np.arange(len(ids)))
        yield pa.RecordBatch.from_arrays([pa.array(ids[root[member]]), pa.array(ids[member])], names=["a", "b"])

    return stored(links.mapInArrow(run, "a long, b long").distinct(), "links")


def _to_smallest(pairs: DataFrame, larger_only: bool) -> DataFrame:
    """Links from the smallest of ``a`` and its neighbours to those neighbours.

    With ``larger_only`` each link is handled at its smaller end; else ``a`` has smaller
    neighbours only and joins them.
    """
    least = stored(pairs.groupBy("a").agg(F.min("b").alias("low")), "least")
    least = least.select("a", F.least("a", "low").alias("low"))
    joined = pairs.where("b > a") if larger_only else pairs
    out = joined.join(least, "a").select("low", "b")
    if not larger_only:
        out = out.union(least.select("low", F.col("a").alias("b")))
    out = out.where("low <> b").select(F.col("low").alias("a"), "b").distinct()
    return stored(out, "links")


def joined(root: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Smallest members of the groups that the pairs join."""
    while len(i):
        low = np.minimum(root[i], root[j])
        new = root.copy()
        np.minimum.at(new, root[i], low)
        np.minimum.at(new, root[j], low)
        new = new[new]
        while not np.array_equal(new, new[new]):
            new = new[new]
        if np.array_equal(new, root):
            break
        root = new
    return root
