"""Benchmark decontamination by CGK embedding and bit-sampling LSH.

A text is contaminated by an item when some run of its words, from any word on, is within
``floor(share * n)`` word edits of the item's n words (lower-cased A-Z, split at white
space). Finding such runs:

* The CGK embedding walks along a word sequence. At step j it writes the current word and
  moves on or stays, by a random bit that depends on j and the word. Sequences that differ
  in few edits fall back into step after each, so their embeddings differ in few places:
  edit distance becomes Hamming distance.
* Bit sampling then takes a few places of the embedding as a key. Windows and items with
  the same key are candidates. This is repeated with other walks and places until pairs at
  the bound meet with the wanted recall, which is measured on copies of the items, edited
  and followed by other words as in a document, when the index is built. There is no limit
  to the repetitions but that recall.
* Exact copies depend on no sampled place: the hash of a whole run of words meets that of
  an item of as many.
* Windows start at every word. Those that hold too few words of any item for the bound are
  passed over first; that loses no match, and few windows remain to be embedded.
* Candidates are verified by the exact edit distance with a free end.

Items are handled in blocks of bounded size (``BLOCK_WORDS``), each sent to all tasks; a
larger benchmark takes more passes over the documents. Documents are only mapped, never
shuffled. Null and empty texts or items match nothing. Nothing is assumed about ids: each
row is judged for itself, also where rows repeat. Of several runs that match an item the
one with fewest edits counts, the earliest of those. Other columns stay as they are.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowsieve.llm.common import lean, spans, text_bytes
from rowsieve.llm.words import Words, forget_powers, mix, powers

SHARE = 0.1
RECALL = 0.99
BLOCK_WORDS = 1_000_000
SAMPLES = 3
# Texts are taken together up to so many bytes: each slice walks all classes anew.
SLICE_BYTES = 1 << 20
_TRIALS = 300
_BASE = 0xC2B2AE3D27D4EB4F
_INVERSE = pow(_BASE, -1, 1 << 64)
_SIEVE_BITS = 20


def most_edits(n: int, share: float) -> int:
    return int(n * share + 1e-9)


@dataclass
class LengthClass:
    """Items of similar length share walks, places and the size of windows."""

    items: list[int]
    least: int
    window: int
    known: np.ndarray = field(default_factory=lambda: np.zeros(0, bool))
    tables: list[tuple[int, np.ndarray, np.ndarray, np.ndarray]] = field(default_factory=list)
    # By number of words: hashes of whole items, and the items.
    whole: dict[int, tuple[np.ndarray, np.ndarray]] = field(default_factory=dict)


class Index:
    """The items of one block, ready to be met by windows."""

    def __init__(self, ids: list[int], texts: list[bytes], share: float = SHARE, recall: float = RECALL, seed: int = 11):
        words = Words(texts)
        self.share = share
        self.ids = ids
        self.words = [words.of(i) for i in range(len(texts))]
        self.vocabulary = np.unique(words.hashes)
        self.sieve = np.zeros(1 << _SIEVE_BITS, dtype=bool)
        self.sieve[(self.vocabulary >> np.uint64(64 - _SIEVE_BITS)).astype(np.int64)] = True
        self.classes: list[LengthClass] = []
        order = sorted((len(w), i) for i, w in enumerate(self.words) if len(w))
        rng = np.random.default_rng(seed)
        while order:
            n = order[0][0]
            some = [i for m, i in order if m <= 1.25 * n]
            order = order[len(some) :]
            self.classes.append(self._class(some, rng, recall))

    def _class(self, items: list[int], rng: np.random.Generator, recall: float) -> LengthClass:
        lengths = [len(self.words[i]) for i in items]
        n, m = min(lengths), max(lengths)
        made = LengthClass(items, n - most_edits(n, self.share), m + most_edits(m, self.share))
        made.known = np.isin(self.vocabulary, np.concatenate([self.words[i] for i in items]))
        for length in sorted(set(lengths)):
            same = np.array([i for i in items if len(self.words[i]) == length])
            keys = np.array([RunHashes(self.words[i]).whole(length) for i in same])
            order = np.argsort(keys, kind="stable")
            made.whole[length] = keys[order], same[order]
        if not most_edits(m, self.share):
            return made
        pairs = self._edited(items, made.window, rng)
        missed = np.ones(len(pairs), dtype=bool)
        steps = max(SAMPLES, 3 * n // 2)
        while missed.mean() > 1 - recall:
            seed = int(rng.integers(1, 1 << 60))
            places = np.sort(rng.choice(steps, size=min(SAMPLES, steps), replace=False))
            keys = _keys([self.words[i] for i in items], seed, places)
            missed &= _keys([x for x, _ in pairs], seed, places) != _keys([y for _, y in pairs], seed, places)
            order = np.argsort(keys, kind="stable")
            made.tables.append((seed, places, keys[order], np.array(items)[order]))
        return made

    def _edited(self, items: list[int], window: int, rng: np.random.Generator) -> list[tuple[np.ndarray, np.ndarray]]:
        """Items and windows that begin with copies of them at the bound, to measure recall on."""
        out = []
        some = [i for i in items if most_edits(len(self.words[i]), self.share)]
        for i in rng.choice(some, size=_TRIALS):
            word = self.words[i]
            new = list(word)
            for _ in range(most_edits(len(word), self.share)):
                at, kind = int(rng.integers(len(new))), int(rng.integers(3))
                if kind == 0:
                    new[at] = np.uint64(rng.integers(1 << 62))
                elif kind == 1:
                    new.insert(at, np.uint64(rng.integers(1 << 62)))
                elif len(new) > 1:
                    del new[at]
            new += [np.uint64(x) for x in rng.integers(1 << 62, size=max(0, window - len(new)))]
            out.append((word, np.array(new, dtype=np.uint64)))
        return out

    def matches(self, texts: list[bytes]) -> Iterator[tuple[int, int, int, int]]:
        """``(text, item, edits, start word)``, the best for each text and item."""
        words = Words(texts)
        n = len(words.hashes)
        if not n or not self.classes:
            return
        ends = words.bounds[1:][np.searchsorted(words.bounds, np.arange(n), side="right") - 1]
        maybe = np.flatnonzero(self.sieve[(words.hashes >> np.uint64(64 - _SIEVE_BITS)).astype(np.int64)])
        found = np.minimum(np.searchsorted(self.vocabulary, words.hashes[maybe]), len(self.vocabulary) - 1)
        real = self.vocabulary[found] == words.hashes[maybe]
        maybe, found = maybe[real], found[real]
        best: dict[tuple[int, int], tuple[int, int]] = {}
        runs = RunHashes(words.hashes)
        for group in self.classes:
            here = maybe[group.known[found]]
            if len(here) < group.least:
                continue
            # A match may lack its first words, so any known word can begin the window.
            count = np.zeros(n + 1, dtype=np.int32)
            count[here + 1] = 1
            count = np.cumsum(count)
            last = np.minimum(here + group.window, ends[here])
            starts = here[count[last] - count[here] >= group.least]
            starts = np.unique(np.concatenate([starts, *[starts - b for b in range(1, self._slack(group) + 1)]]))
            starts = starts[starts >= 0]
            if not len(starts):
                continue
            self._meet(words, group, starts, ends, runs, best)
        for (text, item), (edits, at) in best.items():
            yield text, item, edits, at

    def _slack(self, group: LengthClass) -> int:
        return most_edits(max(len(self.words[i]) for i in group.items), self.share)

    def _meet(self, words: Words, group: LengthClass, starts: np.ndarray, ends: np.ndarray, runs: RunHashes, best: dict) -> None:
        tried: set[tuple[int, int]] = set()
        for length, (keys, items) in group.whole.items():
            inside = starts[starts + length <= ends[starts]]
            self._try(words, inside, runs.of(inside, length), keys, items, tried, ends, best)
        limits = np.minimum(group.window, ends[starts] - starts)
        for seed, places, keys, items in group.tables:
            got = embed_key(words.hashes, starts, limits, seed, places)
            self._try(words, starts, got, keys, items, tried, ends, best)

    def _try(self, words: Words, starts, got, keys, items, tried: set, ends: np.ndarray, best: dict) -> None:
        """Verify the windows at ``starts`` whose key is one of ``keys``."""
        lo, hi = np.searchsorted(keys, got, "left"), np.searchsorted(keys, got, "right")
        for k in np.flatnonzero(hi > lo):
            for item in items[lo[k] : hi[k]]:
                pair = (int(starts[k]), int(item))
                if pair not in tried:
                    tried.add(pair)
                    self._verify(words, *pair, int(ends[starts[k]]), best)

    def _verify(self, words: Words, start: int, item: int, end: int, best: dict) -> None:
        word = self.words[item]
        bound = most_edits(len(word), self.share)
        edits = edit_distance(word, words.hashes[start : min(end, start + len(word) + bound)], bound)
        if edits is None:
            return
        text = int(np.searchsorted(words.bounds, start, side="right")) - 1
        key, new = (text, item), (edits, start - int(words.bounds[text]))
        if key not in best or new < best[key]:
            best[key] = new


class RunHashes:
    """Hashes of runs of words; the same words give the same hash wherever they stand."""

    def __init__(self, hashes: np.ndarray):
        sums = np.cumsum(hashes * powers(_BASE, len(hashes)), dtype=np.uint64)
        self.sums = np.concatenate([np.zeros(1, np.uint64), sums])

    def of(self, starts: np.ndarray, length: int) -> np.ndarray:
        inverse = powers(_INVERSE, len(self.sums))
        return mix((self.sums[starts + length] - self.sums[starts]) * inverse[starts])

    def whole(self, length: int) -> np.uint64:
        return self.of(np.zeros(1, dtype=np.int64), length)[0]


def embed_key(hashes: np.ndarray, starts: np.ndarray, limits: np.ndarray, seed: int, places: np.ndarray) -> np.ndarray:
    """Keys of the windows of ``limits`` words at ``starts``: the embedding at ``places``."""
    at = np.zeros(len(starts), dtype=np.int64)
    key = np.zeros(len(starts), dtype=np.uint64)
    wanted = set(places.tolist())
    for j in range(int(places[-1]) + 1):
        inside = at < limits
        word = np.where(inside, hashes[np.minimum(starts + at, len(hashes) - 1)], np.uint64(0))
        if j in wanted:
            key = mix(key + word)
        step = mix(word + np.uint64((seed + 0x9E3779B97F4A7C15 * (j + 1)) % (1 << 64)))
        at += (step >> np.uint64(63)).astype(np.int64) & inside
    return key


def _keys(sequences: list[np.ndarray], seed: int, places: np.ndarray) -> np.ndarray:
    lengths = np.array([len(x) for x in sequences])
    return embed_key(np.concatenate(sequences), np.cumsum(lengths) - lengths, lengths, seed, places)


def edit_distance(item: np.ndarray, window: np.ndarray, bound: int) -> int | None:
    """Fewest edits from the item to a beginning of the window; None above the bound."""
    if len(item) - np.isin(item, window).sum() > bound:
        return None
    a, b = item.tolist(), window.tolist()
    far = bound + 1
    row = [j if j <= bound else far for j in range(len(b) + 1)]
    for i, x in enumerate(a, 1):
        lo, hi = max(1, i - bound), min(len(b), i + bound)
        new = [far] * (len(b) + 1)
        if i <= bound:
            new[0] = i
        for j in range(lo, hi + 1):
            new[j] = min(row[j - 1] + (x != b[j - 1]), row[j] + 1, new[j - 1] + 1)
        row = new
        if min(row) > bound:
            return None
    return min(row) if min(row) <= bound else None


def item_blocks(items: DataFrame, share: float = SHARE, recall: float = RECALL) -> Iterator[Index]:
    """Indexes over ``items (item_id, text)`` in blocks that fit a task. The driver holds
    one block at a time."""
    ids: list[int] = []
    texts: list[bytes] = []
    held = 0
    rows = items.where("item_id IS NOT NULL AND text IS NOT NULL").select(F.col("item_id").cast("long"), "text")
    for item_id, text in rows.orderBy("item_id", "text").toLocalIterator():
        ids.append(item_id)
        texts.append(text.encode())
        held += len(texts[-1].split())
        if held >= BLOCK_WORDS:
            yield Index(ids, texts, share, recall)
            ids, texts, held = [], [], 0
    if ids:
        yield Index(ids, texts, share, recall)


def contamination(docs: DataFrame, items: DataFrame, share: float = SHARE, recall: float = RECALL) -> DataFrame:
    """``doc_id, item_id, edits, start_word`` of each document and item found in it."""
    out = None
    for index in item_blocks(items, share, recall):
        found = docs.select("doc_id", "text").mapInArrow(lean(_finder(index), forget_powers), "doc_id long, item_id long, edits int, start_word int")
        out = found if out is None else out.union(found)
    if out is None:
        spark = docs.sparkSession
        return spark.createDataFrame([], "doc_id long, item_id long, edits int, start_word int")
    return out


def _finder(index: Index):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id").cast(pa.int64())
            for lo, hi in spans(batch.column("text"), SLICE_BYTES):
                rows = sorted(index.matches(text_bytes(batch.column("text").slice(lo, hi - lo))))
                if rows:
                    text, item, edits, start = zip(*rows, strict=True)
                    yield pa.RecordBatch.from_arrays(
                        [
                            ids.take(pa.array([lo + t for t in text])),
                            pa.array([index.ids[i] for i in item], pa.int64()),
                            pa.array(edits, pa.int32()),
                            pa.array(start, pa.int32()),
                        ],
                        names=["doc_id", "item_id", "edits", "start_word"],
                    )

    return run


def decontaminate(docs: DataFrame, items: DataFrame, share: float = SHARE, recall: float = RECALL) -> DataFrame:
    """The rows of ``docs`` whose text no item contaminates, unchanged."""
    schema = T.StructType(docs.schema.fields)
    for index in item_blocks(items, share, recall):
        docs = docs.mapInArrow(lean(_keeper(index), forget_powers), schema)
    return docs


def _keeper(index: Index):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = np.ones(batch.num_rows, dtype=bool)
            for lo, hi in spans(batch.column("text"), SLICE_BYTES):
                for text, *_ in index.matches(text_bytes(batch.column("text").slice(lo, hi - lo))):
                    keep[lo + text] = False
            yield batch.filter(pa.array(keep))

    return run
