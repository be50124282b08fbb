"""Ranked lexical search by norm buckets.

The score of a document for an item is the inner product of two vectors: the document's
impacts and the item's weights, each weight as often as the item repeats the term. For
the best ``top`` documents of each item most documents need not be scored:

* Impact vectors, cut to the terms of the items, are ordered by their length and taken in
  buckets, the longest first. The product is at most the product of the lengths
  (Cauchy-Schwarz), so a bucket whose longest vector cannot reach what the item's last
  kept document scores is passed over.
* In a bucket an item's coordinates are taken by falling weight until the rest, by its
  length or by the largest impact of each term in the bucket, cannot reach that score
  alone. Documents without any of these coordinates go; so do those whose partial product
  and a bound on the rest of both vectors fall short.
* What is left is scored in 64-bit integers.

Bounds are in doubles and a little wide; a document that ties with the last one is always
scored. So the result is exact.

In Spark: one pass over the texts counts the terms that any item has (an item block is
bounded by ``BLOCK_WORDS`` words, more items take more passes); the counts are stored, so
texts are read once and never shuffled. Lengths are cut into bands at quantiles. The bands
run one after the other, each on all tasks, and a band starts from the scores that the ones
before have reached; a task orders its vectors by length. Only the best of each task meet
in the end, per item at most ``top`` from a task.

Null and empty texts have no terms: they count in no number and are never returned. Items
without text return nothing. Rows that repeat an id are documents, or items, of their own.
Equal scores go by ascending document id, null ids last. Very long texts are counted in
pieces of ``PIECE_BYTES``. Other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rowsieve.llm.common import spans, stored, text_bytes
from rowsieve.llm.words import BETWEEN_TERMS, Words, pieces

TOP = 20
BLOCK_WORDS = 1_000_000
PIECE_BYTES = 1 << 22
# Shares of the documents in the bands of longest vectors; the last band has the rest.
BANDS = (0.01, 0.1)
# Vectors that a task orders at once hold about so many terms.
BUCKET_TERMS = 1 << 20
_WIDER = 1 + 1e-9
_NO_ID = np.iinfo(np.int64).max

_COUNTS = "doc_id long, n long, terms array<int>, counts array<int>"
_IMPACTS = "doc_id long, terms array<int>, impacts array<int>, length double"
_FOUND = "query int, item_id long, doc_id long, score long"


class Items:
    """A block of items: their ids, the terms of all, and each item's terms with repeats."""

    def __init__(self, ids: list[int | None], texts: list[bytes]):
        self.ids = ids
        words = Words(texts, BETWEEN_TERMS)
        self.vocabulary, number = np.unique(words.hashes, return_inverse=True)
        self.terms: list[np.ndarray] = []
        self.repeats: list[np.ndarray] = []
        for lo, hi in zip(words.bounds[:-1], words.bounds[1:], strict=True):
            terms, repeats = np.unique(number[lo:hi], return_counts=True)
            self.terms.append(terms)
            self.repeats.append(repeats)


def item_blocks(items: DataFrame) -> Iterator[Items]:
    """The items with text in blocks; the driver holds one block at a time."""
    ids, texts, held = [], [], 0
    rows = items.where("text IS NOT NULL").select(F.col("item_id").cast("long"), "text")
    for item_id, text in rows.orderBy("item_id", "text").toLocalIterator():
        ids.append(item_id)
        texts.append(text.encode())
        held += 1 + len(texts[-1].split())
        if held >= BLOCK_WORDS:
            yield Items(ids, texts)
            ids, texts, held = [], [], 0
    if ids:
        yield Items(ids, texts)


def term_counts(docs: DataFrame, vocabulary: np.ndarray) -> DataFrame:
    """``doc_id, n, terms, counts`` of documents with terms: the number of all terms, and
    how often each of the vocabulary occurs."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in spans(batch.column("text")):
                part = batch.slice(lo, hi - lo)
                sizes, owners, terms, counts = _counted(text_bytes(part.column("text")), vocabulary)
                some = np.flatnonzero(sizes)
                ends = np.searchsorted(owners, some, side="right")
                ends = pa.array(np.concatenate([[0], ends]), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id").take(pa.array(some)),
                        pa.array(sizes[some]),
                        pa.ListArray.from_arrays(ends, pa.array(terms, pa.int32())),
                        pa.ListArray.from_arrays(ends, pa.array(counts, pa.int32())),
                    ],
                    names=["doc_id", "n", "terms", "counts"],
                )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, _COUNTS)


def _counted(texts: list[bytes], vocabulary: np.ndarray) -> tuple[np.ndarray, ...]:
    """All terms of each text; which text holds which term of the vocabulary how often."""
    sizes = np.zeros(len(texts), dtype=np.int64)
    keys, times = [], []
    width = max(1, len(vocabulary))
    for owner, group in _groups(texts):
        words = Words(group, BETWEEN_TERMS)
        np.add.at(sizes, owner, np.diff(words.bounds))
        if not len(vocabulary) or not len(words.hashes):
            continue
        place = np.minimum(np.searchsorted(vocabulary, words.hashes), width - 1)
        known = np.flatnonzero(vocabulary[place] == words.hashes)
        of = owner[np.searchsorted(words.bounds, known, side="right") - 1]
        key, count = np.unique(of * width + place[known], return_counts=True)
        keys.append(key)
        times.append(count)
    if not keys:
        none = np.zeros(0, dtype=np.int64)
        return sizes, none, none, none
    key, place = np.unique(np.concatenate(keys), return_inverse=True)
    count = np.zeros(len(key), dtype=np.int64)
    np.add.at(count, place, np.concatenate(times))
    return sizes, key // width, key % width, count


def _groups(texts: list[bytes]) -> Iterator[tuple[np.ndarray, list[bytes]]]:
    """Pieces of texts and the texts they are of; long texts in pieces alone."""
    short = [k for k, t in enumerate(texts) if len(t) <= PIECE_BYTES]
    if short:
        yield np.array(short), [texts[k] for k in short]
    for k, text in enumerate(texts):
        if len(text) > PIECE_BYTES:
            for piece in pieces(text, PIECE_BYTES, BETWEEN_TERMS):
                yield np.array([k]), [piece]


def document_frequencies(counts: DataFrame, size: int) -> np.ndarray:
    """How many documents hold each term of the vocabulary; a task sends one row a term."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(size, dtype=np.int64)
        for batch in batches:
            held += np.bincount(batch.column("terms").flatten().to_numpy(), minlength=size)
        some = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(held[some])], names=["term", "held"])

    rows = counts.select("terms").mapInArrow(run, "term int, held long")
    found = rows.groupBy("term").agg(F.sum("held").alias("held")).toArrow()
    out = np.zeros(size, dtype=np.int64)
    out[found.column("term").to_numpy()] = found.column("held").to_numpy()
    return out


def impacts(counts: DataFrame, documents: int, words: int) -> DataFrame:
    """Impact vectors with their length, the longest of a partition first. ``documents``
    have terms, ``words`` with repeats."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(pa.compute.greater(pa.compute.list_value_length(batch.column("terms")), 0))
            n = batch.column("n").to_numpy()
            m = 100 - 25 + (25 * n * documents) // words
            lists = batch.column("counts")
            sizes = pa.compute.list_value_length(lists).to_numpy()
            tf = lists.flatten().to_numpy().astype(np.int64)
            impact = (1_000_000_000 * tf) // (1000 * tf + 12 * np.repeat(m, sizes))
            ends = np.concatenate([[0], np.cumsum(sizes)])
            square = np.add.reduceat(impact.astype(float) ** 2, ends[:-1]) if len(n) else np.zeros(0)
            offsets = pa.array(ends, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.ListArray.from_arrays(offsets, batch.column("terms").flatten()),
                    pa.ListArray.from_arrays(offsets, pa.array(impact, pa.int32())),
                    pa.array(np.sqrt(square)),
                ],
                names=["doc_id", "terms", "impacts", "length"],
            )

    return counts.mapInArrow(run, _IMPACTS).sortWithinPartitions(F.desc("length"))


@dataclass
class Query:
    """An item's coordinates by falling weight, its length and that of what follows each."""

    terms: np.ndarray
    weights: np.ndarray
    rest: np.ndarray

    @classmethod
    def of(cls, terms: np.ndarray, weights: np.ndarray) -> Query:
        used = np.flatnonzero(weights)
        order = used[np.argsort(-weights[used], kind="stable")]
        terms, weights = terms[order], weights[order]
        after = np.cumsum((weights.astype(float) ** 2)[::-1])[::-1]
        return cls(terms, weights, np.sqrt(np.concatenate([after, [0.0]])))


class Bucket:
    """Vectors of similar length, by document and by term."""

    def __init__(self, ids: np.ndarray, sizes: np.ndarray, terms: np.ndarray, values: np.ndarray, length: np.ndarray, width: int):
        self.ids, self.length = ids, length
        self.ends = np.concatenate([[0], np.cumsum(sizes)])
        self.terms, self.values = terms, values.astype(np.int64)
        self.longest = float(length.max())
        order = np.argsort(terms, kind="stable")
        self.row = np.repeat(np.arange(len(ids)), sizes)[order]
        self.impact = self.values[order]
        self.bounds = np.searchsorted(terms[order], np.arange(width + 1))
        self.most = np.zeros(width, dtype=np.int64)
        held = np.flatnonzero(np.diff(self.bounds))
        if len(held):
            self.most[held] = np.maximum.reduceat(self.impact, self.bounds[held])
        self.dense = np.zeros(width, dtype=np.int64)

    def scored(self, query: Query, least: int) -> tuple[np.ndarray, np.ndarray]:
        """Rows and exact scores, above 0, of all documents that reach ``least``."""
        none = np.zeros(0, dtype=np.int64)
        if query.rest[0] * self.longest * _WIDER < least:
            return none, none
        # What the coordinates from each on can add at most.
        by_term = np.concatenate([np.cumsum((query.weights * self.most[query.terms])[::-1])[::-1], [0]])
        beyond = np.minimum(query.rest * self.longest, by_term) * _WIDER
        if beyond[0] < least:
            return none, none
        focus = int(np.argmax(beyond < least)) if beyond[-1] < least else len(query.terms)
        lists = [slice(self.bounds[t], self.bounds[t + 1]) for t in query.terms[:focus]]
        if not lists:
            return none, none
        rows = np.concatenate([self.row[x] for x in lists])
        sizes = [x.stop - x.start for x in lists]
        found = np.concatenate([self.impact[x] for x in lists])
        partial = np.bincount(rows, np.repeat(query.weights[:focus], sizes) * found, len(self.ids))
        met = np.flatnonzero(partial)
        if focus < len(query.terms):
            squares = np.bincount(rows, found.astype(float) ** 2, len(self.ids))[met]
            left = np.sqrt(np.maximum(self.length[met] ** 2 * _WIDER - squares, 0))
            most = partial[met] + np.minimum(query.rest[focus] * left, by_term[focus])
            met = met[most * _WIDER >= least]
        score = self._exactly(query, met)
        good = (score >= least) & (score > 0)
        return met[good], score[good]

    def _exactly(self, query: Query, rows: np.ndarray) -> np.ndarray:
        if not len(rows):
            return np.zeros(0, dtype=np.int64)
        self.dense[query.terms] = query.weights
        sizes = self.ends[rows + 1] - self.ends[rows]
        starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        at = np.arange(int(sizes.sum())) + np.repeat(self.ends[rows] - starts, sizes)
        score = np.add.reduceat(self.dense[self.terms[at]] * self.values[at], starts)
        self.dense[query.terms] = 0
        return score


def _best(ids: np.ndarray, scores: np.ndarray, top: int) -> np.ndarray:
    return np.lexsort((ids, -scores))[:top]


def _searcher(ids: list[int | None], queries: list[Query], least: np.ndarray, width: int, top: int):
    """The best documents of a task for each query; ``least`` has what others reached."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = [(np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)) for _ in queries]
        floor = least.copy()
        for bucket in _buckets(batches, width):
            for q, query in enumerate(queries):
                rows, scores = bucket.scored(query, max(1, int(floor[q])))
                if not len(rows):
                    continue
                docs, all_scores = np.concatenate([kept[q][0], bucket.ids[rows]]), np.concatenate([kept[q][1], scores])
                best = _best(docs, all_scores, top)
                kept[q] = docs[best], all_scores[best]
                if len(best) == top:
                    floor[q] = max(floor[q], all_scores[best[-1]])
        sizes = [len(d) for d, _ in kept]
        docs = np.concatenate([d for d, _ in kept])
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.repeat(np.arange(len(queries)), sizes), pa.int32()),
                pa.array([i for i, k in zip(ids, sizes, strict=True) for _ in range(k)], pa.int64()),
                pa.array(docs, pa.int64(), mask=docs == _NO_ID),
                pa.array(np.concatenate([s for _, s in kept]), pa.int64()),
            ],
            names=["query", "item_id", "doc_id", "score"],
        )

    return run


def _buckets(batches: Iterable[pa.RecordBatch], width: int) -> Iterator[Bucket]:
    """Buckets of about ``BUCKET_TERMS`` terms, as the partition gives them: by length."""
    held: list[pa.RecordBatch] = []
    size = 0

    def bucket() -> Bucket:
        table = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
        ids = table.column("doc_id").fill_null(_NO_ID).to_numpy()
        sizes = pa.compute.list_value_length(table.column("terms")).to_numpy()
        terms, values = (table.column(c).flatten().to_numpy() for c in ("terms", "impacts"))
        return Bucket(ids, sizes, terms, values, table.column("length").to_numpy(), width)

    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        size += len(batch.column("terms").flatten())
        if size >= BUCKET_TERMS:
            yield bucket()
            held, size = [], 0
    if held:
        yield bucket()


def rank(docs: DataFrame, items: DataFrame, top: int = TOP, bands: tuple[float, ...] = BANDS) -> DataFrame:
    """``item_id, rank, doc_id, score``: for each row of ``items (item_id, text)`` the
    ``top`` documents of highest score above 0, all if there are fewer."""
    out = None
    for block in item_blocks(items):
        found = _ranked(docs, block, top, bands)
        out = found if out is None else out.union(found)
    if out is None:
        return docs.sparkSession.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    return out


def _ranked(docs: DataFrame, block: Items, top: int, bands: tuple[float, ...]) -> DataFrame:
    width = len(block.vocabulary)
    counts = stored(term_counts(docs, block.vocabulary), "terms")
    documents, words = counts.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    held = document_frequencies(counts, width)
    weights = np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * int(df) + 1))) for df in held], dtype=np.int64)
    queries = [Query.of(t, weights[t] * r) for t, r in zip(block.terms, block.repeats, strict=True)]
    vectors = stored(impacts(counts, documents, max(1, words)), "impacts")

    cuts = vectors.approxQuantile("length", [1 - b for b in bands], 0.005) if bands else []
    edges = [math.inf, *sorted(set(cuts), reverse=True), -1.0]
    order = Window.partitionBy("query", "item_id").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    best, least = None, np.zeros(len(queries), dtype=np.int64)
    for high, low in zip(edges[:-1], edges[1:], strict=True):
        band = vectors.where((F.col("length") <= high) & (F.col("length") > low))
        found = band.mapInArrow(_searcher(block.ids, queries, least, width, top), _FOUND)
        found = found if best is None else found.union(best)
        found = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
        best = stored(found, "ranked")
        last = best.where(F.col("rank") == top).select("query", "score").toArrow()
        least[last.column("query").to_numpy()] = last.column("score").to_numpy()
        best = best.drop("rank")
    ranked = best.withColumn("rank", F.row_number().over(order))
    return ranked.select("item_id", "rank", "doc_id", "score")
