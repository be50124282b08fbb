"""Near-duplicate lines by a deletion-neighbourhood join.

Two lines match when their words (lower-cased A-Z, split at white space) differ by at
most one insertion, deletion or replacement of a word. Both then have a variant in
common: the line itself or the line without one of its words. A line of n words has
n + 1 variants, emitted as hashed keys and joined on equality. A line goes if an earlier
one, by ``(doc_id, line number)``, matches it; the earliest stays.

What keeps this linear:

* Equal lines are one row before anything else, the earliest.
* One edit leaves one half of a line as it is. Of two lines that match, the shorter of m
  words, either the first or the last m // 2 words are equal. Only lines that share such a
  half, for the same m, with another line emit variants; no match is lost.
* A shared first half puts the edit behind it, a shared last half before it, so only words
  there are left out.
* Lines that lack the same word of a shared variant all match each other, so each is
  compared with the earliest of them only, and no pairs within a group are formed. The
  earliest is found by partial aggregation.
* Lines that hold more than one part in ``HOT_PARTS`` of all lines, of which there are
  fewer than that, meet their earliest place without a shuffle.

Every match found by hashed keys is verified on the words themselves.

Lines of fewer than ``least_words`` words match equal lines only, and of those no lines of
fewer than ``exact_words`` words: one edit is a large share of a short line. Lines without
words are kept. Rows with a null id are kept as they are and take no part; null texts
stay null. Rows that repeat both id and text count as one document: their lines stay in each. Rows
that repeat an id with other texts are documents of their own, ordered by a hash of the
text.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowsieve.llm.common import lean, maybe_among, spans, stored, text_bytes, with_ids
from rowsieve.llm.words import Words, mix, powers

LEAST_WORDS = 10
HOT_PARTS = 1000
_PLACE = ["doc_id", "tie", "line"]
_BASES = (0xD6E8FEB86659FD93, 0xA0761D6478BD642F)


class Lines:
    """The lines with words of some texts: bounds in words, text and number of each."""

    def __init__(self, texts: list[bytes]):
        self.words = words = Words(texts)
        feeds = np.concatenate([[0], np.cumsum(words.raw == 10)])
        line = feeds[words.starts]
        n = len(line)
        self.first = np.flatnonzero(np.concatenate([[True], line[1:] != line[:-1]])) if n else np.zeros(0, int)
        self.last = np.concatenate([self.first[1:], [n]]) if n else np.zeros(0, int)
        self.text = np.searchsorted(words.bounds, self.first, side="right") - 1
        self.number = line[self.first] - feeds[words.offsets[self.text]] if n else np.zeros(0, int)
        self.sums = []
        for base in _BASES:
            scaled = words.hashes * powers(base, n)
            self.sums.append(np.concatenate([np.zeros(1, np.uint64), np.cumsum(scaled, dtype=np.uint64)]))

    def run(self, which: int, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """Hashes of runs of words; the same words give the same hash wherever they stand."""
        inverse = powers(pow(_BASES[which], -1, 1 << 64), len(self.words.hashes) + 1)
        return (self.sums[which][hi] - self.sums[which][lo]) * inverse[lo]


def line_keys(docs: DataFrame, least_words: int, exact_words: int) -> DataFrame:
    """``doc_id, tie, line, n, key_a, key_b, halves`` of the lines that take part; those of
    fewer than ``least_words`` words have no halves."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in spans(batch.column("text")):
                part = batch.slice(lo, hi - lo)
                lines = Lines(text_bytes(part.column("text")))
                n = lines.last - lines.first
                pick = np.flatnonzero(n >= min(least_words, exact_words))
                a, b, n = lines.first[pick], lines.last[pick], n[pick]
                keys = [mix(lines.run(k, a, b) + n.astype(np.uint64)) for k in (0, 1)]
                halves = []
                edits = n >= least_words
                for m in (n, n - 1):
                    salt = mix(m.astype(np.uint64))
                    halves += [mix(lines.run(0, a, a + m // 2) + salt), ~mix(lines.run(0, b - m // 2, b) + salt)]
                halves = np.stack(halves, axis=1)[edits].ravel().view(np.int64)
                of = pa.array(lines.text[pick])
                columns = [part.column("doc_id").take(of), part.column("tie").take(of)]
                columns += [pa.array(lines.number[pick].astype(np.int32)), pa.array(n.astype(np.int32))]
                columns += [pa.array(k.view(np.int64)) for k in keys]
                ends = pa.array(np.concatenate([[0], np.cumsum(4 * edits)]), pa.int32())
                columns.append(pa.ListArray.from_arrays(ends, pa.array(halves)))
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "tie", "line", "n", "key_a", "key_b", "halves"])

    return docs.mapInArrow(lean(run), "doc_id long, tie long, line int, n int, key_a long, key_b long, halves array<long>")


def line_variants(docs: DataFrame) -> DataFrame:
    """The lines that ``docs (doc_id, tie, text, lines)`` names: their words as they stand
    and their variants with the place of the word left out, first -1 for none.

    ``lines`` has the number of a line and which of its four halves it shares.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        inverse = np.uint64(pow(_BASES[0], -1, 1 << 64))
        for batch in batches:
            for lo, hi in spans(batch.column("text")):
                part = batch.slice(lo, hi - lo)
                lines = Lines(text_bytes(part.column("text")))
                wanted = [_halves_by_line(x) for x in part.column("lines").to_pylist()]
                ids = part.column("doc_id").to_pylist()
                ties = part.column("tie").to_pylist()
                of = {(int(t), int(k)): i for i, (t, k) in enumerate(zip(lines.text, lines.number, strict=True))}
                out: list[tuple] = []
                for text, numbers in enumerate(wanted):
                    for number, shared in sorted(numbers.items()):
                        i = of.get((text, number))
                        if i is None:
                            continue
                        a, b = int(lines.first[i]), int(lines.last[i])
                        sums = lines.sums[0][a : b + 1] - lines.sums[0][a]
                        without = sums[:-1] + (sums[-1] - sums[1:]) * inverse
                        scale = powers(pow(_BASES[0], -1, 1 << 64), a + 1)[a]
                        places = _places(b - a, shared)
                        keys = mix(np.concatenate([sums[-1:], without[places]]) * scale)
                        places = np.concatenate([[-1], places]).astype(np.int32)
                        raw = lines.words.raw[lines.words.starts[a] : lines.words.ends[b - 1]].tobytes()
                        out.append((ids[text], ties[text], number, b - a, places, keys.view(np.int64), raw.decode()))
                if out:
                    columns = [pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)]
                    yield pa.RecordBatch.from_arrays(columns, names=names)

    names = ["doc_id", "tie", "line", "n", "places", "variants", "words"]
    types = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.list_(pa.int32()), pa.list_(pa.int64()), pa.string()]
    return docs.mapInArrow(lean(run), "doc_id long, tie long, line int, n int, places array<int>, variants array<long>, words string")


def _halves_by_line(lines: list[dict]) -> dict[int, set[int]]:
    out: dict[int, set[int]] = {}
    for x in lines:
        out.setdefault(x["line"], set()).add(x["half"])
    return out


def _places(n: int, shared: set[int]) -> np.ndarray:
    """The words of a line of n that an edit may concern, given the halves it shares: the
    first and last n // 2 words are halves 0 and 1, those of (n - 1) // 2 are 2 and 3."""
    behind = min((m // 2 for half, m in ((0, n), (2, n - 1)) if half in shared), default=n)
    before = max((n - m // 2 for half, m in ((1, n), (3, n - 1)) if half in shared), default=0)
    at = np.arange(n)
    return at[(at >= behind) | (at < before)]


def _rows(docs: DataFrame) -> DataFrame:
    rows = docs.where("doc_id IS NOT NULL AND text IS NOT NULL")
    return rows.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("tie"), "text")


def repeated_lines(docs: DataFrame, least_words: int = LEAST_WORDS, exact_words: int | None = None) -> DataFrame:
    """``doc_id, tie, line``: the lines (from 0) that an earlier line matches. ``tie`` is
    the text's ``xxhash64``. ``exact_words`` is ``least_words`` unless given."""
    if least_words < 4:
        raise ValueError("least_words must be 4 or more")
    exact_words = least_words if exact_words is None else exact_words
    docs = _rows(docs)
    lines = stored(line_keys(docs, least_words, exact_words), "lines")
    distinct = stored(
        lines.groupBy("key_a", "key_b").agg(
            F.min(F.struct(*_PLACE)).alias("at"),
            F.count("*").alias("held"),
            F.first("halves").alias("halves"),
        ),
        "distinct",
    )
    near = _near(docs, distinct)
    again = stored(distinct.where("held > 1").select("key_a", "key_b", "at", "held"), "again")
    later = maybe_among(lines, again, "key_a").select("key_a", "key_b", F.struct(*_PLACE).alias("own"))
    # Fewer than HOT_PARTS rows.
    total = lines.count()
    hot = F.broadcast(again.where(F.col("held") * HOT_PARTS > total).drop("held"))
    often = later.join(hot, ["key_a", "key_b"])
    seldom = later.join(hot, ["key_a", "key_b"], "left_anti")
    seldom = seldom.join(again.where(F.col("held") * HOT_PARTS <= total).drop("held"), ["key_a", "key_b"])
    later = often.union(seldom).where("own <> at").select("own.*")
    # The later places of a line that goes are here, its earliest is in the other part.
    return later.union(near)


def _near(docs: DataFrame, distinct: DataFrame) -> DataFrame:
    """The earliest places of distinct lines that an earlier, different line matches."""
    halves = distinct.select("at", F.posexplode("halves").alias("which", "half"))
    shared = halves.groupBy("half").count().where("count > 1").select("half")
    shared = stored(shared, "halves")
    chosen = maybe_among(halves, shared, "half").join(shared, "half", "left_semi").select("at.*", "which")
    which = F.struct("line", F.col("which").alias("half"))
    chosen = chosen.groupBy("doc_id", "tie").agg(F.collect_set(which).alias("lines"))
    chosen = stored(chosen, "chosen")
    emitted = with_ids(docs, chosen).join(chosen, ["doc_id", "tie"]).select("doc_id", "tie", "text", "lines")
    emitted = stored(line_variants(emitted).distinct(), "variants")
    own = F.struct(*_PLACE).alias("own")
    whole = emitted.select("n", F.col("variants")[0].alias("variant"), own)
    lacking = emitted.select("n", F.explode(F.arrays_zip("places", "variants")).alias("v"), own)
    lacking = lacking.select("n", F.col("v.places").alias("place"), F.col("v.variants").alias("variant"), "own")
    lacking = lacking.where("place >= 0")
    # Lines that lack the same word: the earliest matches all others.
    same = ["variant", "n", "place"]
    first = lacking.groupBy(*same).agg(F.min("own").alias("other"), F.count("*").alias("held"))
    first = stored(first.where("held > 1").drop("held"), "first")
    replaced = maybe_among(lacking, first, *same).join(first, same).select("own", "other")
    # Lines that are another line without one word.
    shorter = whole.select("variant", (F.col("n") + 1).alias("n"), F.col("own").alias("short"))
    longer = maybe_among(lacking, whole, "variant").join(shorter, ["variant", "n"])
    longer = stored(longer.select("own", "short"), "longer")
    cut = longer.groupBy("short").agg(F.min("own").alias("other")).select(F.col("short").alias("own"), "other")
    pairs = replaced.union(longer.select("own", F.col("short").alias("other"))).union(cut)
    pairs = stored(pairs.where("other < own").distinct(), "pairs")
    words = emitted.select(own, "words")
    rows = pairs.join(words.withColumnRenamed("words", "mine"), "own")
    rows = rows.join(words.select(F.col("own").alias("other"), F.col("words").alias("theirs")), "other")
    return _verified(rows.select("own.*", "mine", "theirs")).distinct()


def within_one_edit(mine: list[bytes], theirs: list[bytes]) -> bool:
    """Whether one insertion, deletion or replacement at most turns one into the other."""
    if abs(len(mine) - len(theirs)) > 1:
        return False
    least = min(len(mine), len(theirs))
    i = 0
    while i < least and mine[i] == theirs[i]:
        i += 1
    j = 0
    while j < least - i and mine[-1 - j] == theirs[-1 - j]:
        j += 1
    return max(len(mine), len(theirs)) - i - j <= 1


def _verified(rows: DataFrame) -> DataFrame:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            mine, theirs = (text_bytes(batch.column(c)) for c in ("mine", "theirs"))
            good = [
                within_one_edit(a.lower().split(), b.lower().split()) for a, b in zip(mine, theirs, strict=True)
            ]
            yield batch.select(_PLACE).filter(pa.array(good, pa.bool_()))

    return rows.mapInArrow(lean(run), "doc_id long, tie long, line int")


def dedup_lines(docs: DataFrame, least_words: int = LEAST_WORDS, exact_words: int | None = None) -> DataFrame:
    """``docs`` without repeated lines, and the count ``removed_lines`` of each row.

    The lines left keep their order and spelling. A column named ``removed_lines`` is
    replaced, all others stay.
    """
    docs = docs.drop("removed_lines")
    names = docs.columns
    # The row is one value while other columns are beside it, whatever its names are.
    docs = docs.select(F.struct(*names).alias("row"), "doc_id", "text")
    gone = repeated_lines(docs, least_words, exact_words).groupBy("doc_id", "tie").agg(F.collect_set("line").alias("lines"))
    gone = stored(gone, "gone")
    whole = with_ids(docs, gone, maybe=False)
    gone_ids = gone.select(F.col("doc_id").alias("gone_id"), "tie", "lines")
    same = (F.col("doc_id").cast("long") == F.col("gone_id")) & (F.xxhash64("text") == F.col("tie"))
    rows = with_ids(docs, gone).join(gone_ids, same, "left")
    kept = F.filter(F.split("text", "\n", -1), lambda _, i: ~F.array_contains("lines", i))
    text = F.when(F.col("lines").isNull(), F.col("text")).otherwise(F.array_join(kept, "\n"))
    removed = F.when(F.col("lines").isNull(), 0).otherwise(F.size("lines"))
    rows = whole.select("row", "text", F.lit(0).alias("removed")).union(rows.select("row", text, removed))
    columns = [F.col("text") if c == "text" else F.col("row").getField(c).alias(c) for c in names]
    return rows.select(*columns, F.col("removed").alias("removed_lines"))
