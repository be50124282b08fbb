"""Packing of token sequences by bulk-synchronous best fit.

Pieces of documents (at most ``capacity`` tokens each) go into as few sequences as a best
fit finds. Everything is decided on rows of a few integers:

1. Pieces above half the capacity open a sequence each; no two of them fit together.
2. A round range-sorts the remaining pieces and the gaps of open sequences by size, a
   piece before a gap of the same size. Every partition sweeps upwards and gives each gap
   the largest piece left below it, again and again while one fits.
3. Gaps that found nothing in their own partition fit whatever is left in lower ones.
   Only the two counts of each partition are needed to say which: the gap of rank r takes
   the left-over piece of rank q, and both sides meet in a join on that slot.
4. Gaps shrink, and the next round begins. When gaps take few of the pieces, as many of
   the largest pieces as their total length needs open sequences of their own.

5. The last few pieces (``LAST_STEP``) and as many of the largest gaps go to one task,
   after at least one round, so that tables of every size are swept.

The driver sees one row a partition and one a length, never pieces or gaps. Each round's
state is a table in the shared folder, so a lost executor costs a part of one round.
"""

from __future__ import annotations

import bisect
import math
from collections.abc import Iterable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowsieve.llm.common import lean, scratch, spans, stored
from rowsieve.llm.tokens import crc32, forget, token_ids

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
# Below this share of placed pieces a round is followed by opening sequences.
LEAST_SHARE = 0.05
# Up to so many openers are picked by exact rank, more by a share of the last length.
EXACT_OPENERS = 100_000
# Up to so many pieces are placed by one last task.
LAST_STEP = 5_000

_PIECE, _GAP, _PLACED, _COUNTS = 0, 1, 2, 3
_PLACES = "id long, sequence_id long, offset long"
_STATE = ["kind", "id", "size", "sequence_id", "offset"]
_SLOTS = "of_kind int, of_part int, low long, high long, slot long"
_SWEPT = "kind int, part int, rank long, id long, size long, sequence_id long, offset long"


def token_pieces(docs: DataFrame, tokenizer: str, end_id: int = 0, capacity: int = 2048, with_ids: bool = False) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` and, if asked for, ``ids`` of each piece.

    Only documents longer than the capacity are cut. A null text counts as empty: its
    piece holds the end id. Rows with the same ``doc_id`` are separate documents.
    """

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, doc_ids = batch.column("text"), batch.column("doc_id")
            for lo, hi in spans(texts):
                rows: list[tuple] = []
                parts: list[np.ndarray] = []
                for doc_id, ids in zip(
                    doc_ids.slice(lo, hi - lo).to_pylist(),
                    token_ids(texts.slice(lo, hi - lo), tokenizer, end_id),
                    strict=True,
                ):
                    for k, at in enumerate(range(0, len(ids), capacity)):
                        part = ids[at : at + capacity]
                        rows.append((doc_id, k, at, len(part), crc32(part)))
                        parts.append(part)
                columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)]
                if with_ids:
                    columns.append(pa.array([p.astype(np.int32) for p in parts], pa.list_(pa.int32())))
                yield pa.RecordBatch.from_arrays(columns, names=names)

    types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
    names = ["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids
    rows = docs.select(F.col("doc_id").cast("long"), "text")
    return rows.mapInArrow(lean(cut, partial(forget, tokenizer)), PIECES + ", ids array<int>" * with_ids)


def pack(pieces: DataFrame, capacity: int = 2048, last_step: int = LAST_STEP) -> DataFrame:
    """The pieces and where they go: ``sequence_id``, ``offset``.

    ``pieces`` has a column ``length`` of 1 to ``capacity``; its other columns stay. Rows
    need no key: equal rows are packed each for itself. Lengths that are null or out of
    range give null places. Columns named like the new ones are replaced. An empty table
    gives an empty one.
    """
    kept = [c for c in pieces.columns if c not in ("sequence_id", "offset")]
    rows = pieces.select(F.monotonically_increasing_id().alias("id"), F.struct(*kept).alias("row"))
    rows = stored(rows, "pieces")
    placed = place(rows.select("id", F.col("row.length").cast("long").alias("size")), capacity, last_step)
    return rows.join(placed, "id", "left").select("row.*", "sequence_id", "offset")


def place(items: DataFrame, capacity: int, last_step: int = LAST_STEP) -> DataFrame:
    """``id, sequence_id, offset`` for items ``id, size``; ids are distinct longs.

    At most ``last_step`` pieces are left to one task, which ends the tail of rounds that
    would place a handful each.
    """
    spark = items.sparkSession
    folder = scratch(spark, "packing")
    items = items.where(F.col("size").between(1, capacity))
    done = [_opened(items.where(F.col("size") * 2 > capacity))]
    state = _rows(items.where(F.col("size") * 2 <= capacity), _PIECE).union(
        _gaps(items.where(F.col("size") * 2 > capacity), capacity)
    )
    state = stored(state, "packing", f"{folder}/state-0")
    left = state.where(F.col("kind") == _PIECE).count()
    turn = 0
    while left > last_step or (left and not turn):
        turn += 1
        were = left
        state, left = _round(state, capacity, f"{folder}/swept-{turn}")
        state = stored(state, "packing", f"{folder}/state-{turn}")
        done.append(state.where(F.col("kind") == _PLACED).select("id", "sequence_id", "offset"))
        state = state.where(F.col("kind") != _PLACED)
        if left and were - left < LEAST_SHARE * were:
            pieces = state.where(F.col("kind") == _PIECE)
            total = pieces.agg(F.sum("size")).first()[0]
            opened = stored(_largest(pieces, math.ceil(total / capacity)), "packing", f"{folder}/opened-{turn}")
            done.append(_opened(opened))
            ids = opened.select("id", F.lit(_PIECE).alias("kind"))
            state = state.join(ids, ["id", "kind"], "left_anti").select(*_STATE).union(_gaps(opened, capacity))
            left = state.where(F.col("kind") == _PIECE).count()
    if left:
        # So few pieces need no more gaps than there are of them, the largest.
        pieces = state.where(F.col("kind") == _PIECE)
        gaps = state.where(F.col("kind") == _GAP).orderBy(F.desc("size"), "id").limit(left)
        rows = pieces.union(gaps).select("kind", "id", "size").coalesce(1)
        done.append(stored(rows.mapInArrow(_finisher(capacity), _PLACES), "packing", f"{folder}/last"))
    out = done[0]
    for more in done[1:]:
        out = out.union(more)
    return out


def _finisher(capacity: int):
    """The last pieces in one task: largest first, each to the smallest gap that fits."""

    def finish(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces: list[tuple[int, int]] = []
        free: list[tuple[int, int]] = []
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("kind", "size", "id")), strict=True):
                (pieces if row[0] == _PIECE else free).append(row[1:])
        pieces.sort(reverse=True)
        free.sort()
        out = []
        for size, ident in pieces:
            at = bisect.bisect_left(free, (size,))
            room, sequence = free.pop(at) if at < len(free) else (capacity, ident)
            out.append((ident, sequence, capacity - room))
            if room > size:
                bisect.insort(free, (room - size, sequence))
        if out:
            columns = [pa.array(c, pa.int64()) for c in zip(*out, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "sequence_id", "offset"])

    return finish


def _rows(items: DataFrame, kind: int) -> DataFrame:
    empty = F.lit(None).cast("long")
    return items.select(F.lit(kind).alias("kind"), "id", "size", empty.alias("sequence_id"), empty.alias("offset"))


def _gaps(openers: DataFrame, capacity: int) -> DataFrame:
    free = openers.select("id", (F.lit(capacity).cast("long") - F.col("size")).alias("size"))
    return _rows(free.where("size > 0"), _GAP)


def _opened(openers: DataFrame) -> DataFrame:
    return openers.select("id", F.col("id").alias("sequence_id"), F.lit(0).cast("long").alias("offset"))


def _largest(pieces: DataFrame, wanted: int) -> DataFrame:
    """About ``wanted`` of the largest pieces, at least one."""
    pieces = pieces.select("id", "size")
    if wanted <= EXACT_OPENERS:
        return pieces.orderBy(F.desc("size"), "id").limit(wanted)
    # One row a length, of which there are no more than the capacity.
    counts = sorted(((r["size"], r["count"]) for r in pieces.groupBy("size").count().collect()), reverse=True)
    for size, count in counts:
        if count >= wanted:
            share = math.ceil((1 << 20) * wanted / count)
            picked = F.pmod(F.xxhash64("id"), F.lit(1 << 20)) < share
            return pieces.where((F.col("size") > size) | ((F.col("size") == size) & picked))
        wanted -= count
    return pieces


def _round(state: DataFrame, capacity: int, folder: str) -> tuple[DataFrame, int]:
    """The state after one sweep of all partitions and the matches between partitions,
    and how many pieces are left."""
    live = state.select("kind", "id", "size")
    ordered = live.repartitionByRange("size", "kind", "id").sortWithinPartitions("size", "kind", "id")
    swept = stored(ordered.mapInArrow(_sweeper(capacity), _SWEPT), "swept", folder)
    # Each partition's last row holds its numbers of unused gaps and pieces.
    counts = swept.where(F.col("kind") == _COUNTS).select("part", "id", "size").collect()
    slots = _slots({r["part"]: (r["id"], r["size"]) for r in counts})
    left = sum(r["size"] for r in counts) - sum(high - low + 1 for kind, _, low, high, _ in slots if kind == _PIECE)
    swept = swept.where(F.col("kind") != _COUNTS)
    if not slots:
        return swept.select(*_STATE), left
    rest = swept.where(F.col("rank").isNull()).select(*_STATE)
    ranked = swept.where(F.col("rank").isNotNull())
    # Two rows for each pair of partitions that meet, of which there are fewer than two a
    # partition, so this side is small.
    table = F.broadcast(swept.sparkSession.createDataFrame(slots, _SLOTS))
    ranked = ranked.alias("r")
    inside = (
        (F.col("r.kind") == F.col("of_kind"))
        & (F.col("r.part") == F.col("of_part"))
        & F.col("r.rank").between(F.col("low"), F.col("high"))
    )
    slotted = ranked.join(table, inside, "left").select(
        *[F.col(f"r.{c}").alias(c) for c in _STATE],
        (F.col("slot") + F.col("r.rank") - F.col("low")).alias("at"),
    )
    alone = slotted.where(F.col("at").isNull()).select(*_STATE)
    met = slotted.where(F.col("at").isNotNull())
    pieces = met.where(F.col("kind") == _PIECE).select("at", F.col("id").alias("piece"), F.col("size").alias("length"))
    gaps = met.where(F.col("kind") == _GAP).select("at", F.col("id").alias("gap"), F.col("size").alias("free"))
    none = F.lit(None).cast("long")
    placed = F.struct(
        F.lit(_PLACED), F.col("piece"), F.col("length"), F.col("gap"), F.lit(capacity).cast("long") - F.col("free")
    )
    shrunk = F.struct(F.lit(_GAP), F.col("gap"), F.col("free") - F.col("length"), none, none)
    kind = "struct<kind:int,id:bigint,size:bigint,sequence_id:bigint,offset:bigint>"
    both = pieces.join(gaps, "at").select(F.inline(F.array(placed.cast(kind), shrunk.cast(kind))))
    both = both.where((F.col("kind") == _PLACED) | (F.col("size") > 0))
    return rest.union(alone).union(both), left


def _sweeper(capacity: int):
    """One partition's sweep over pieces and gaps in ascending order of size.

    A piece or gap that found nothing gets a rank: gaps count upwards from the smallest,
    pieces downwards from the largest.
    """

    def sweep(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        waiting: dict[int, list[int]] = {}
        lengths = 0  # bit l is set while a piece of length l waits
        unused = 0
        out: list[tuple] = []
        for batch in batches:
            kinds, ids, sizes = (batch.column(c).to_pylist() for c in ("kind", "id", "size"))
            for kind, ident, size in zip(kinds, ids, sizes, strict=True):
                if kind == _PIECE:
                    waiting.setdefault(size, []).append(ident)
                    lengths |= 1 << size
                    continue
                free = size
                while fitting := lengths & ((2 << free) - 1):
                    length = fitting.bit_length() - 1
                    same = waiting[length]
                    out.append((_PLACED, part, None, same.pop(), length, ident, capacity - free))
                    free -= length
                    if not same:
                        lengths ^= 1 << length
                if free == size:
                    out.append((_GAP, part, unused, ident, free, None, None))
                    unused += 1
                elif free:
                    out.append((_GAP, part, None, ident, free, None, None))
            if len(out) > 50_000:
                yield _swept(out)
                out = []
        rank = 0
        for length in sorted(waiting, reverse=True):
            for ident in reversed(waiting[length]):
                out.append((_PIECE, part, rank, ident, length, None, None))
                rank += 1
        out.append((_COUNTS, part, None, unused, rank, None, None))
        yield _swept(out)

    return sweep


def _swept(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.int32(), pa.int32()] + [pa.int64()] * 5
    columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)]
    return pa.RecordBatch.from_arrays(columns, names=["kind", "part", "rank", "id", "size", "sequence_id", "offset"])


def _slots(counts: dict[int, tuple[int, int]]) -> list[tuple[int, int, int, int, int]]:
    """Which ranks meet, from each partition's unused gaps and pieces: for either side
    ``(kind, part, first rank, last rank, slot)``.

    Partitions ascend by size, so the unused gaps of one take the pieces left in the
    nearest lower ones, largest first.
    """
    out, stack, slot = [], [], 0
    for part, (gaps, pieces) in sorted(counts.items()):
        used = 0
        while used < gaps and stack:
            lower, rank, count = stack.pop()
            n = min(count, gaps - used)
            out.append((_GAP, part, used, used + n - 1, slot))
            out.append((_PIECE, lower, rank, rank + n - 1, slot))
            slot, used = slot + n, used + n
            if n < count:
                stack.append((lower, rank + n, count - n))
        if pieces:
            stack.append((part, 0, pieces))
    return out
