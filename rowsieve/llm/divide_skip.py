"""Jaccard self-join on word shingles by T-occurrence search.

A text's set holds its distinct runs of ``words`` words. Two sets link when their Jaccard
similarity is at least ``numerator / denominator``. A partner of a set of n shingles has
at least T = ceil(n * numerator / denominator) of them, so its lists may be divided: T - 1
of the inverted lists are skipped at first, and a partner must occur in one or more of the
remaining n - T + 1. Those are merged; the skipped ones are only probed.

Which lists are skipped matters: the long ones should be. Shingles are ordered by a hash,
and those found in more than ``long_list`` of the merged lists' documents come last, so a
passage that very many documents share is probed and not merged. Documents that would merge
long lists again have all their shingles counted, so that near copies, which have most of
theirs together, merge their own ones first. The number of long lists is bounded
(``MAX_LONG``; beyond it the limit rises), so they can be sent to all tasks.

Steps:

1. Sets that are equal become one representative, with its merged lists' shingles.
2. Each list links its documents of similar size to one leader; verified links are joined
   into components. A group of copies of any size costs one link a copy and list. This is
   repeated with other leaders for lists that still hold several components.
3. Such lists are then cut into blocks; each gives every document the others in it that
   are of another component, as one sorted list. A document heap-merges the lists it got
   and keeps those that occur often enough: occurrences plus the number of skipped lists
   must reach the overlap. So a pair is one row at most, however many lists it shares.
4. Pairs from 2 are held against the same bound on the merged lists alone. For those left,
   the skipped lists are probed: by binary search of one text's shingles in the other's
   sorted ones. (The long inverted lists themselves hold up to all documents; a document's
   own shingles say the same and fit a task.)

No link between different components is lost: pairs that step 3 leaves out are already
in one component or cannot reach the overlap.

Null and empty texts have no shingles and link with nothing. Rows with a null id keep
their count and have a null component. Rows that repeat an id are one document whose
texts all count for its links, and each row is returned with its own count.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowsieve.llm.common import discard, lean, maybe_among, spans, stored, text_bytes, with_ids
from rowsieve.llm.components import components
from rowsieve.llm.words import mix, shingle_sets

LONG_LIST = 100
MAX_LONG = 1_000_000
# Times that documents choose other lists when theirs turn out long.
PUT_OFF_ROUNDS = 3
# How each round picks the leader of a list.
LEADERS = (lambda rep: rep, lambda rep: -rep)
# Documents of a list that are held against each other at once.
LIST_BLOCK = 500
# Another leader is tried while lists would give more pairs than so many a posting.
PAIRS_A_POSTING = 10
PARTNERS_TOGETHER = 100_000


@dataclass(frozen=True)
class Rule:
    words: int = 5
    numerator: int = 4
    denominator: int = 5

    def __post_init__(self):
        if not (self.words >= 1 and 0 < self.numerator <= self.denominator):
            raise ValueError("needs words >= 1 and a similarity above 0, at most 1")

    def least_overlap(self, n):
        """Of a set of n with any partner."""
        return -((-n * self.numerator) // self.denominator)

    def pair_overlap(self, both):
        """Of two sets that have ``both`` elements together."""
        return -((-both * self.numerator) // (self.numerator + self.denominator))

    def least_merged(self, n_a: int, n_b: int) -> int:
        """Merged lists that two sets of these sizes must share: the skipped lists can add
        as many as the larger number of them."""
        skipped = max(self.least_overlap(n_a), self.least_overlap(n_b)) - 1
        return max(1, self.pair_overlap(n_a + n_b) - skipped)


def heads(docs: DataFrame, rule: Rule, late: np.ndarray | None = None, whole: bool = False) -> DataFrame:
    """``doc_id, n_shingles, key_a, key_b, head``: the keys tell equal sets, ``head`` has
    the shingles of the lists to merge, or all. ``late`` are shingles to put last."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in spans(batch.column("text")):
                part = batch.slice(lo, hi - lo)
                sizes, keys_a, keys_b, firsts = [], [], [], []
                for found in shingle_sets(text_bytes(part.column("text")), rule.words):
                    n = len(found)
                    sizes.append(n)
                    keys_a.append(int(found.sum(dtype=np.uint64).view(np.int64)))
                    keys_b.append(int(mix(found).sum(dtype=np.uint64).view(np.int64)))
                    merged = n if whole else n - rule.least_overlap(n) + 1 if n else 0
                    if late is not None and n:
                        skip = _among(found, late)
                        found = np.concatenate([found[~skip], found[skip]])
                    firsts.append(found[:merged].view(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        pa.array(sizes, pa.int64()),
                        pa.array(keys_a, pa.int64()),
                        pa.array(keys_b, pa.int64()),
                        _lists(firsts),
                    ],
                    names=["doc_id", "n_shingles", "key_a", "key_b", "head"],
                )

    rows = docs.select(F.col("doc_id").cast("long"), "text")
    return rows.mapInArrow(lean(run), "doc_id long, n_shingles long, key_a long, key_b long, head array<long>")


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    ends = np.concatenate([[0], np.cumsum([len(a) for a in arrays])])
    values = np.concatenate(arrays) if arrays else np.zeros(0, dtype=np.int64)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values, pa.int64()))


def _among(values: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    """Which values are in an ascending array, by binary search."""
    if not len(ordered):
        return np.zeros(len(values), dtype=bool)
    at = np.minimum(np.searchsorted(ordered, values), len(ordered) - 1)
    return ordered[at] == values


def jaccard_components(docs: DataFrame, rule: Rule | None = None, long_list: int = LONG_LIST) -> DataFrame:
    """``doc_id, n_shingles, component_id`` for each row of ``docs (doc_id, text)``.

    ``component_id`` is the smallest id reachable by links, itself included. Columns of
    other names are ignored.
    """
    rule = rule or Rule()
    docs = docs.select(F.col("doc_id").cast("long"), "text")
    sets = stored(heads(docs, rule), "heads")
    firsts = stored(_firsts(sets), "firsts")
    usable = sets.where("doc_id IS NOT NULL AND n_shingles > 0")
    copies = maybe_among(usable, firsts.where("held > 1"), "key_a").select("doc_id", "key_a", "key_b").join(
        firsts.select("key_a", "key_b", "rep"), ["key_a", "key_b"]
    )
    copies = copies.where("doc_id <> rep").select(F.col("rep").alias("a"), F.col("doc_id").alias("b"))

    chosen, lists = _merged_lists(docs, firsts, rule, long_list)
    links = groups = None
    for pick in LEADERS:
        found = _leader_links(docs, chosen, lists, pick, rule)
        links = found if links is None else stored(links.union(found), "links")
        groups = stored(components(links), "groups")
        lists = _mixed(lists, groups)
        held = lists.groupBy("shingle").count()
        postings, pairs = held.agg(*[F.coalesce(F.sum(x), F.lit(0)) for x in ("count", F.col("count") * F.col("count"))]).first()
        if pairs <= PAIRS_A_POSTING * postings:
            break
    links = links.union(_other_links(docs, lists, rule))

    groups = stored(components(links.union(copies)), "groups")
    discard(firsts, chosen, lists)
    found = sets.select("doc_id", "n_shingles").join(groups, F.col("doc_id") == groups.id, "left")
    return found.select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))


def _merged_lists(docs: DataFrame, firsts: DataFrame, rule: Rule, long_list: int) -> tuple[DataFrame, DataFrame]:
    """The documents' lists to merge, ``rep, n, head``, long ones put off, and the postings
    ``rep, n, shingle, grp`` of those that have two documents or more; ``grp`` is ``rep``."""
    late = np.zeros(0, dtype=np.uint64)
    rest = latest = firsts.select("rep", "n", "head")
    for turn in range(PUT_OFF_ROUNDS):
        new = _long(latest.select("head"), latest.select(F.size("head").alias("n")), long_list, late)
        if not len(new):
            break
        if turn:
            # Near copies have so many shingles together that the lists they choose next
            # are long as well, again and again. All their shingles are counted at once.
            touched = _touched(rest, new)
            whole = heads(with_ids(docs, touched), rule, whole=True).where("doc_id IS NOT NULL")
            new = np.union1d(new, _long(whole.select("head"), touched, long_list, late))
            discard(touched)
        late = np.sort(np.concatenate([late, new]))
        # Documents that would merge a list now put off choose anew, with such lists last.
        # The filter lets some others through: theirs come out as they were, so there is
        # nothing to join.
        touched = _touched(rest, new)
        found = heads(with_ids(docs, touched), rule, late).where("doc_id IS NOT NULL AND n_shingles > 0")
        latest = stored(found.select(F.col("doc_id").alias("rep"), F.col("n_shingles").alias("n"), "head"), "latest")
        named = rest.withColumnRenamed("rep", "doc_id")
        rest = with_ids(named, touched, maybe=False).withColumnRenamed("doc_id", "rep").union(latest)
    chosen = stored(rest, "chosen")
    postings = chosen.select("rep", "n", F.explode("head").alias("shingle"))
    shared = stored(postings.groupBy("shingle").count().where("count > 1").select("shingle"), "shared")
    lists = maybe_among(postings, shared, "shingle").join(shared, "shingle", "left_semi")
    lists = stored(lists.select("rep", "n", "shingle", F.col("rep").alias("grp")), "lists")
    discard(shared)
    return chosen, lists


def _firsts(sets: DataFrame) -> DataFrame:
    """One representative of equal sets, the smallest id."""
    usable = sets.where("doc_id IS NOT NULL AND n_shingles > 0")
    return usable.groupBy("key_a", "key_b").agg(
        F.min("doc_id").alias("rep"),
        F.first("n_shingles").alias("n"),
        F.first("head").alias("head"),
        F.count("*").alias("held"),
    )


def _long(lists: DataFrame, sizes: DataFrame, long_list: int, late: np.ndarray) -> np.ndarray:
    """Shingles of ``lists (head)`` whose lists are long and not known to be. The sum of
    ``n`` in ``sizes`` is at least the number of postings."""
    total = sizes.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    # At most MAX_LONG shingles can have more postings than this.
    limit = max(long_list, -(-total // MAX_LONG))
    counts = lists.select(F.explode("head").alias("shingle")).groupBy("shingle").count().where(F.col("count") > limit)
    found = counts.select("shingle").toArrow().column("shingle").to_numpy().view(np.uint64)
    return found[~_among(found, late)]


def _touched(lists: DataFrame, late: np.ndarray) -> DataFrame:
    """``doc_id, n`` of the documents that would merge one of these lists."""
    late = np.sort(late)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = batch.column("head")
            hit = _among(found.flatten().to_numpy().view(np.uint64), late)
            ends = np.cumsum(pa.compute.list_value_length(found).to_numpy())
            sums = np.concatenate([[0], np.cumsum(hit)])
            some = pa.array(np.diff(np.concatenate([[0], sums[ends]])) > 0)
            yield pa.RecordBatch.from_arrays([batch.column(c).filter(some) for c in ("rep", "n")], names=["doc_id", "n"])

    return stored(lists.mapInArrow(run, "doc_id long, n long").distinct(), "touched")


def _similar_size(a: str, b: str, rule: Rule):
    low, high = F.least(a, b), F.greatest(a, b)
    return low * rule.denominator >= high * rule.numerator


def _size_class(n: str, rule: Rule):
    """Sets of one class are rarely too different in size; classes are a similarity wide."""
    if rule.numerator == rule.denominator:
        return F.col(n)
    return F.floor(F.log(F.col(n).cast("double")) / float(np.log(rule.denominator / rule.numerator)))


def _leader_links(docs: DataFrame, chosen: DataFrame, lists: DataFrame, pick, rule: Rule) -> DataFrame:
    """Verified links to one document of each list and class of size."""
    classed = lists.withColumn("size_class", _size_class("n", rule))
    leader = classed.groupBy("shingle", "size_class").agg(
        F.min(F.struct(pick(F.col("rep")).alias("rank"), "rep", "n", "grp")).alias("first"), F.count("*").alias("held")
    )
    leader = leader.where("held > 1").select("shingle", "size_class", "first.rep", "first.n", "first.grp")
    leader = stored(leader.toDF("shingle", "size_class", "a", "n_a", "grp_a"), "leaders")
    pairs = classed.join(leader, ["shingle", "size_class"]).where("grp <> grp_a")
    pairs = pairs.where(_similar_size("n", "n_a", rule)).select("a", F.col("rep").alias("b")).distinct()
    pairs = stored(pairs, "pairs")
    found = verified(docs, _often_enough(pairs, chosen, rule), rule)
    discard(leader, pairs)
    return found


def _often_enough(pairs: DataFrame, chosen: DataFrame, rule: Rule) -> DataFrame:
    """Of the pairs those that occur together in enough merged lists."""
    first = chosen.select(F.col("rep").alias("a"), F.col("n").alias("n_a"), F.col("head").alias("head_a"))
    second = chosen.select(F.col("rep").alias("b"), F.col("n").alias("n_b"), F.col("head").alias("head_b"))
    rows = pairs.join(second, "b").join(first, "a").select("a", "b", "n_a", "n_b", "head_a", "head_b")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_a, n_b = batch.column("n_a").to_numpy(), batch.column("n_b").to_numpy()
            keep = np.zeros(batch.num_rows, dtype=bool)
            for k, (x, y) in enumerate(zip(batch.column("head_a"), batch.column("head_b"), strict=True)):
                few, many = sorted((x.values.to_numpy(), y.values.to_numpy()), key=len)
                common = int(_among(few, np.sort(many)).sum())
                keep[k] = common >= rule.least_merged(int(n_a[k]), int(n_b[k]))
            yield batch.select(["a", "b"]).filter(pa.array(keep))

    return rows.mapInArrow(lean(run), "a long, b long")


def _mixed(lists: DataFrame, groups: DataFrame) -> DataFrame:
    """The postings, with their components, of the lists that hold several of these."""
    known = lists.drop("grp").join(groups, lists.rep == groups.id, "left")
    known = stored(known.select("rep", "n", "shingle", F.coalesce("component", "rep").alias("grp")), "known")
    mixed = known.groupBy("shingle").agg(F.min("grp").alias("low"), F.max("grp").alias("high"))
    mixed = stored(mixed.where("low <> high").select("shingle"), "mixed")
    left = stored(maybe_among(known, mixed, "shingle").join(mixed, "shingle", "left_semi").select("rep", "n", "shingle", "grp"), "lists")
    discard(known, mixed, lists)
    return left


def _other_links(docs: DataFrame, lists: DataFrame, rule: Rule) -> DataFrame:
    """Verified links between documents of different components."""
    sizes = lists.groupBy("shingle").agg(F.ceil(F.count("*") / LIST_BLOCK).cast("int").alias("blocks"))
    rows = lists.join(stored(sizes, "sizes"), "shingle")
    own = F.pmod(F.xxhash64("rep", "shingle"), F.col("blocks")).cast("int")
    meets = F.transform(
        F.sequence(F.lit(0), F.col("blocks") - 1),
        lambda other: F.struct(F.least(own, other).alias("low"), F.greatest(own, other).alias("high")),
    )
    rows = rows.select("shingle", F.struct("rep", "n", "grp", own.alias("block")).alias("doc"), F.explode(meets).alias("pair"))
    held = rows.groupBy("shingle", "pair.low", "pair.high").agg(F.sort_array(F.collect_list("doc")).alias("docs"))
    partners = held.select((F.col("low") == F.col("high")).alias("same"), "docs").mapInArrow(lean(_partners(rule)), _PARTNERS)
    found = partners.groupBy("a", "n_a").agg(F.collect_list("others").alias("lists"), F.collect_list("sizes").alias("sizes"))
    pairs = found.mapInArrow(lean(_merger(rule)), "a long, b long")
    return verified(docs, pairs, rule)


_PARTNERS = "a long, n_a long, others array<long>, sizes array<long>"


def _partners(rule: Rule):
    """For each document of a list the later ones of other components and similar size."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made: list[tuple[np.ndarray, ...]] = []
            size = 0
            lists = batch.column("docs")
            fields = [lists.flatten().field(k).to_numpy() for k in range(4)]
            ends = np.cumsum(pa.compute.list_value_length(lists).to_numpy())
            for same, lo, hi in zip(batch.column("same").to_pylist(), [0, *ends[:-1]], ends, strict=True):
                rep, n, grp, block = (f[lo:hi] for f in fields)
                low, high = np.minimum(n[:, None], n[None, :]), np.maximum(n[:, None], n[None, :])
                meet = (rep[:, None] < rep[None, :]) & (grp[:, None] != grp[None, :])
                meet &= low * rule.denominator >= high * rule.numerator
                if not same:
                    meet &= block[:, None] != block[None, :]
                i, j = np.nonzero(meet)
                if len(i):
                    some, counts = np.unique(i, return_counts=True)
                    made.append((rep[some], n[some], counts, rep[j], n[j]))
                    size += len(j)
                if size >= PARTNERS_TOGETHER:
                    yield _partner_batch(made)
                    made, size = [], 0
            if made:
                yield _partner_batch(made)

    return run


def _partner_batch(made: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
    a, n_a, counts, others, sizes = (np.concatenate(x) for x in zip(*made, strict=True))
    ends = pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32())
    lists = [pa.ListArray.from_arrays(ends, pa.array(x, pa.int64())) for x in (others, sizes)]
    return pa.RecordBatch.from_arrays([pa.array(a), pa.array(n_a), *lists], names=["a", "n_a", "others", "sizes"])


def _merger(rule: Rule):
    """Partners that occur in enough of a document's lists, which a heap merges."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a_out, b_out = [], []
            for k in range(batch.num_rows):
                a, n_a = batch.column("a")[k].as_py(), batch.column("n_a")[k].as_py()
                lists, sizes = batch.column("lists")[k].as_py(), batch.column("sizes")[k].as_py()
                merged = heapq.merge(*[zip(x, n, strict=True) for x, n in zip(lists, sizes, strict=True)])
                for (b, n_b), times in groupby(merged):
                    if sum(1 for _ in times) >= rule.least_merged(n_a, n_b):
                        a_out.append(a)
                        b_out.append(b)
            yield pa.RecordBatch.from_arrays([pa.array(a_out, pa.int64()), pa.array(b_out, pa.int64())], names=["a", "b"])

    return run


def verified(docs: DataFrame, pairs: DataFrame, rule: Rule) -> DataFrame:
    """The pairs ``a, b`` whose texts reach the similarity, tested on whole texts."""
    pairs = stored(pairs, "pairs")
    # Filters of fixed size keep texts without a pair out of the shuffles.
    first, second = (stored(pairs.select(F.col(c).alias("doc_id")).distinct(), "ids") for c in ("a", "b"))
    left = with_ids(docs, first).select(F.col("doc_id").alias("a"), F.col("text").alias("text_a"))
    right = with_ids(docs, second).select(F.col("doc_id").alias("b"), F.col("text").alias("text_b"))
    rows = pairs.join(right, "b").join(left, "a")

    def probe(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = np.zeros(batch.num_rows, dtype=bool)
            for lo, hi in spans(batch.column("text_b")):
                first, second = (text_bytes(batch.column(c).slice(lo, hi - lo)) for c in ("text_a", "text_b"))
                # A first text often meets many others in a row.
                distinct = list(dict.fromkeys(first))
                sets = dict(zip(distinct, shingle_sets(distinct, rule.words), strict=True))
                for k, found in enumerate(shingle_sets(second, rule.words)):
                    other = sets[first[k]]
                    few, many = sorted((found, other), key=len)
                    needed = rule.pair_overlap(len(few) + len(many))
                    if len(few) and len(few) >= needed:
                        keep[lo + k] = int(_among(few, many).sum()) >= needed
            yield pa.RecordBatch.from_arrays(
                [batch.column("a").filter(pa.array(keep)), batch.column("b").filter(pa.array(keep))], names=["a", "b"]
            )

    found = stored(rows.select("a", "b", "text_a", "text_b").mapInArrow(lean(probe), "a long, b long"), "links")
    discard(pairs, first, second)
    return found
