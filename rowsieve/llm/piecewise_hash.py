"""Fingerprints of texts by context-triggered piecewise hashing.

A rolling hash over the last ``WINDOW`` bytes decides where a chunk ends, so chunk ends
depend on nothing but what stands there and come back in an edited copy. Each chunk gives
one of 64 letters. A chunk ends where the rolling hash plus one is a multiple of the block
size, which is ``3 * 2**k``: the smallest with at most ``LETTERS`` chunk ends. The
fingerprint ``size:letters:letters`` has the letters at that size and at twice the size,
where every chunk end is one of the smaller size too.

Two fingerprints are compared at a size that both have letters for. Their likeness is
1 - d / (a + b), where d is the edit distance of the letters (insertions and deletions of
one letter, so a replacement counts 2) and a and b their numbers. Letters of unrelated
texts agree here and there by chance, so likeness is 0 unless ``RUN`` letters in a row are
the same, or all letters of a shorter one if it has ``LEAST_RUN``. Equal fingerprints are 1 alike; fingerprints
without a common size 0.

Rules: null counts as the empty text, whose fingerprint is ``3::``. Texts are hashed as
UTF-8, very long ones in pieces of ``PIECE_BYTES`` with the same result. Equal texts have
equal fingerprints. The order of documents is by descending id, null ids last, rows that
repeat an id by a hash of the text; rows alike in both are interchangeable. The next of
the last document is the first, so that of a single document is itself.

In Spark: one range shuffle of the texts by descending id. A task walks through its sorted
rows and holds two of them. What a task cannot finish, its last row, waits for the first
row of the next task that has any; those are two rows a task, joined by number.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rowsieve.llm.common import stored

WINDOW = 7
LETTERS = 64
RUN = 7
LEAST_RUN = 3
PIECE_BYTES = 1 << 20
_ALPHABET = np.frombuffer(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", dtype=np.uint8)
_SMALLEST = 3
_SIZES = 30


def _scrambled(values: np.ndarray) -> np.ndarray:
    """A fixed scrambling of 32-bit values, one to one."""
    x = values.astype(np.uint32, copy=True)
    x ^= x >> np.uint32(16)
    x *= np.uint32(0x7FEB352D)
    x ^= x >> np.uint32(15)
    x *= np.uint32(0x846CA68B)
    x ^= x >> np.uint32(16)
    return x


# A value for each byte, and what it is multiplied with for each place it lies back.
_BYTE = _scrambled(np.arange(1, 257, dtype=np.uint32))
_PLACE = _scrambled(np.arange(1001, 1001 + WINDOW, dtype=np.uint32)) | np.uint32(1)


def _rolling(raw: bytes, start: int, end: int) -> np.ndarray:
    """The rolling hash after each byte from ``start`` to ``end``, scrambled."""
    before = min(start, WINDOW - 1)
    values = _BYTE[np.frombuffer(raw, np.uint8, end - start + before, start - before)]
    sums = values * _PLACE[0]
    for k in range(1, min(WINDOW, len(values))):
        sums[k:] += values[:-k] * _PLACE[k]
    return _scrambled(sums[before:])


class Chunks:
    """Chunk ends of a text at every size from ``3 * 2**level`` on, and chunk hashes."""

    def __init__(self, raw: bytes, level: int):
        self.length = len(raw)
        low = np.uint32((1 << level) - 1)
        ends, steps, sums = [], [], []
        total = np.uint64(0)
        for start in range(0, len(raw), PIECE_BYTES):
            rolled = _rolling(raw, start, min(len(raw), start + PIECE_BYTES))
            at = np.flatnonzero(((rolled + np.uint32(1)) & low) == 0)
            step = rolled[at].astype(np.int64) + 1
            real = step % _SMALLEST == 0
            at = at[real]
            ends.append(at + start + 1)
            steps.append(step[real])
            # Sums up to each end, of values that hold a byte and those before it.
            cuts = np.concatenate([[0], at + 1])
            values = _scrambled(rolled + np.uint32(0x9E3779B9))
            part = np.add.reduceat(values, cuts[cuts < len(values)], dtype=np.uint64)
            part = np.concatenate([part, np.zeros(len(cuts) - len(part), np.uint64)])
            with np.errstate(over="ignore"):
                runs = total + np.cumsum(part, dtype=np.uint64)
            sums.append(runs[:-1])
            total = runs[-1]
        self.ends = np.concatenate(ends) if ends else np.zeros(0, np.int64)
        self.sums = np.concatenate([*sums, [total]]) if sums else np.zeros(1, np.uint64)
        # The largest power of two in each step: an end counts up to that size.
        self.powers = np.concatenate(steps) if steps else np.zeros(0, np.int64)
        self.powers &= -self.powers

    def count(self, level: int) -> int:
        return int((self.powers >= 1 << level).sum())

    def letters(self, level: int) -> str:
        """A letter for each chunk; text after the last end is a chunk as well."""
        held = np.flatnonzero(self.powers >= 1 << level)
        sums = self.sums[held]
        if self.length and (not len(held) or self.ends[held[-1]] < self.length):
            sums = np.append(sums, self.sums[-1])
        with np.errstate(over="ignore"):
            chunk = np.diff(np.concatenate([np.zeros(1, np.uint64), sums]))
        hashed = _scrambled((chunk ^ (chunk >> np.uint64(32))).astype(np.uint32))
        return _ALPHABET[hashed & np.uint32(63)].tobytes().decode()


def fingerprint(raw: bytes) -> str:
    """``size:letters:letters`` of a text in UTF-8."""
    # From a size that surely has more ends than letters, unless it is the smallest.
    level = max(0, (len(raw) // (_SMALLEST * LETTERS)).bit_length() - 2)
    chunks = Chunks(raw, level)
    while level and chunks.count(level) <= LETTERS:
        level = max(0, level - 3)
        chunks = Chunks(raw, level)
    while chunks.count(level) > LETTERS and level < _SIZES:
        level += 1
    return f"{_SMALLEST << level}:{chunks.letters(level)}:{chunks.letters(level + 1)}"


def common_letters(a: str, b: str) -> int:
    """Length of the longest common subsequence, all of ``a`` at once in the bits of one number."""
    places: dict[str, int] = {}
    for i, letter in enumerate(a):
        places[letter] = places.get(letter, 0) | 1 << i
    full = (1 << len(a)) - 1
    row = full
    for letter in b:
        met = row & places.get(letter, 0)
        row = ((row + met) | (row - met)) & full
    return len(a) - row.bit_count()


def _same_run(a: str, b: str) -> bool:
    run = max(LEAST_RUN, min(RUN, len(a), len(b)))
    runs = {a[i : i + run] for i in range(len(a) - run + 1)}
    return any(b[i : i + run] in runs for i in range(len(b) - run + 1))


def _alike(a: str, b: str) -> float:
    if not _same_run(a, b):
        return 0.0
    distance = len(a) + len(b) - 2 * common_letters(a, b)
    return 1 - distance / (len(a) + len(b))


def likeness(first: str, second: str) -> float:
    """From 0 to 1; 1 only for fingerprints that are equal at a common size."""
    if first == second:
        return 1.0
    (a, a1, a2), (b, b1, b2) = first.split(":"), second.split(":")
    found = 0.0
    for size, letters in ((int(a), a1), (2 * int(a), a2)):
        for other, others in ((int(b), b1), (2 * int(b), b2)):
            if size == other:
                found = max(found, _alike(letters, others))
    return found


def edited(text: str, following: str) -> str:
    """A text whose last third is replaced by as much of the beginning of another."""
    n = len(text) // 3
    return text[: len(text) - n] + following[:n]


_REPORT = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
_NAMES = [x.split()[0] for x in _REPORT.split(", ")]
_WAITING = "task int, is_first boolean, text string"


class _Row:
    """A document, its fingerprint made when it is first asked for."""

    def __init__(self, doc_id: int | None, text: str | None):
        self.doc_id, self.text = doc_id, text or ""
        self._fingerprint: str | None = None

    @property
    def fingerprint(self) -> str:
        if self._fingerprint is None:
            self._fingerprint = fingerprint(self.text.encode())
        return self._fingerprint

    def beside(self, following: _Row, edit: Callable[[str, str], str]) -> tuple:
        raw = edit(self.text, following.text).encode()
        changed = fingerprint(raw)
        return (
            self.doc_id,
            len(self.text),
            hashlib.sha256(raw).hexdigest(),
            self.fingerprint,
            changed,
            likeness(self.fingerprint, changed),
            likeness(self.fingerprint, following.fingerprint),
        )


def compare_in_order(docs: DataFrame, edit: Callable[[str, str], str] = edited) -> DataFrame:
    """For each row of ``docs (doc_id, text)`` its fingerprint and that of its edited text,
    which ``edit`` makes of its own and the next document's, and their likeness."""
    rows = docs.select(F.col("doc_id").cast("long"), "text")
    order = [F.desc_nulls_last("doc_id"), F.xxhash64("text")]
    # A salt last, so that rows which repeat id and text can go to several tasks.
    rows = rows.withColumn("salt", F.xxhash64(F.monotonically_increasing_id()))
    rows = rows.repartitionByRange(*order, "salt").drop("salt")
    rows = rows.sortWithinPartitions(*order).withColumn("task", F.spark_partition_id())
    out = stored(rows.mapInArrow(_walker(edit), f"{_REPORT}, {_WAITING}"), "fingerprints")
    return out.where("task IS NULL").select(*_NAMES).union(_finished(out.where("task IS NOT NULL"), edit))


def _walker(edit: Callable[[str, str], str]):
    """Finished rows, then the first and the last one of the task, which wait for others."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = last = None
        task = None
        for batch in batches:
            if batch.num_rows and task is None:
                task = batch.column("task")[0].as_py()
            done, size = [], 0
            for doc_id, text in zip(batch.column("doc_id"), batch.column("text"), strict=True):
                row = _Row(doc_id.as_py(), text.as_py())
                if last is None:
                    first = row
                else:
                    done.append((*last.beside(row, edit), None, None, None))
                last = row
            if done:
                yield _batch(done)
        if last is not None:
            empty = (None,) * (len(_NAMES) - 1)
            yield _batch([(first.doc_id, *empty, task, True, first.text), (last.doc_id, *empty, task, False, last.text)])

    return run


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    text = pa.string()
    types = [pa.int64(), pa.int64(), text, text, text, pa.float64(), pa.float64(), pa.int32(), pa.bool_(), text]
    columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)]
    return pa.RecordBatch.from_arrays(columns, names=[*_NAMES, "task", "is_first", "text"])


def _finished(waiting: DataFrame, edit: Callable[[str, str], str]) -> DataFrame:
    """The last row of each task beside the first row of the next one, of the last beside
    the first."""
    # One narrow row a task; the texts stay behind.
    tasks = waiting.where("is_first").select("task")
    follows = tasks.select("task", F.lead("task").over(Window.orderBy("task")).alias("then"))
    follows = follows.join(tasks.agg(F.min("task").alias("least")), F.col("then").isNull(), "left")
    follows = follows.select("task", F.coalesce("then", "least").alias("then"))
    first = waiting.where("is_first").select(F.col("task").alias("then"), F.col("doc_id").alias("next_id"), F.col("text").alias("next_text"))
    rows = waiting.where("NOT is_first").join(follows, "task").join(first, "then")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = [
                (*_Row(doc_id, text).beside(_Row(None, other), edit), None, None, None)
                for doc_id, text, other in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "next_text")), strict=True)
            ]
            if done:
                yield _batch(done).select(_NAMES)

    return rows.select("doc_id", "text", "next_text").mapInArrow(run, _REPORT)
