"""Repair of conversations by depth-first branch-and-bound.

A conversation's roles are repaired to an optional system turn and then user and assistant
in turn, ending with the assistant, or to nothing at all. Edits go through the rows in
order: Keep, Rerole (to the one role that may follow), Delete, and Insert of an empty turn
of the role that may follow. Blank rows and repeats must be deleted; a row that is cut off
costs more if it stays. Wanted is the cheapest list of edits and, of those, the one whose
initials (the audit) come first in ASCII.

The search keeps an explicit stack of prefixes. A node is a row and what was last emitted.

* Suffix lower bounds: from the last row back, the least cost to finish from each node.
* Children are pushed so that the smallest initial is taken first. Prefixes therefore come
  up in the order of their audits, and the incumbent, which starts from the lower bound of
  the root, gives way to lower cost only.
* Dominance tables: a prefix ends at a node that an earlier one reached at no higher cost,
  since that one has the smaller audit. Equal costs at a node rule out that one audit
  begins with the other, as the rest would be insertions that cost.
* A prefix whose cost and bound exceed the incumbent ends. The bounds are tight, so
  optimality is proved after a number of steps in proportion to the rows.

In Spark: all rows are range-sorted once by conversation, turn (nulls first), role and a
hash of the text, and stored as blocks of at most ``BLOCK_ROWS`` rows and about
``BLOCK_BYTES``. A conversation in one block is repaired there. One in several, however
many rows it has, is never held at once: its blocks first agree on which rows are repeats;
each then gives its least cost from any last emitted role to any other, which makes the
suffix bounds at the block ends, first among blocks of one sorted partition, then among
partitions; with those every block is searched for each role it may begin with, and the
roles at the block ends follow. Only such small tables are grouped by conversation.

Nulls: a null role or text counts as one space, so the role fits nothing and the text is
blank. Null turns come first. Null conversation ids are one conversation. Rows that repeat
a turn are taken by role and text hash. Empty tables give an empty result; extra columns
are ignored. The digest of a conversation in several blocks is of all its text in order,
so one task reads those texts through, holding one block.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowsieve.llm.common import stored

BLOCK_ROWS = 10_000
BLOCK_BYTES = 4 << 20
# What edits cost, and what a row that is cut off costs more if it stays.
DELETE, INSERT, REROLE, CUT_OFF = 4, 3, 3, 3
_NEVER = 1 << 60

# What was last emitted: nothing, system, user, assistant. The role that an insertion or a
# new role must have then, and the initials that may stand next, with what they lead to.
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
_NEXT = {NOTHING: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
_ROLE = {USER: "user", ASSISTANT: "assistant"}
_STEP = {
    (NOTHING, "s"): SYSTEM,
    (NOTHING, "u"): USER,
    (SYSTEM, "u"): USER,
    (USER, "a"): ASSISTANT,
    (ASSISTANT, "u"): USER,
}
_GOOD_PAIRS = {"su", "ua", "au"}
# Least cost to finish after the last row.
_FINISH = [0, 2 * INSERT, INSERT, 0]


@dataclass
class Rows:
    """Rows of one conversation, or a block of it, and the faults of each."""

    turns: list[int | None]
    roles: list[str]
    texts: list[str]
    blank: list[bool] = field(default_factory=list)
    repeat: list[bool] = field(default_factory=list)
    cut_off: list[bool] = field(default_factory=list)

    def keys(self) -> list[bytes]:
        return [_key(r, t) for r, t in zip(self.roles, self.texts, strict=True)]

    def judge(self, seen: set[bytes] = frozenset()) -> None:
        """Find each row's first fault; ``seen`` has keys of rows in earlier blocks."""
        known = set(seen)
        for key, text in zip(self.keys(), self.texts, strict=True):
            last = text.rstrip(" \t\n\x0b\x0c\r")[-1:]
            self.blank.append(not last)
            self.repeat.append(bool(last) and key in known)
            self.cut_off.append(bool(last) and key not in known and last not in ".!?")
            known.add(key)

    def __len__(self) -> int:
        return len(self.roles)


def _key(role: str, text: str) -> bytes:
    made = hashlib.blake2b(role.encode(), digest_size=16)
    made.update(b"\0")
    made.update(text.encode())
    return made.digest()


def _moves(rows: Rows, i: int, state: int) -> list[tuple[str, int, int, int]]:
    """Edits at row i by their initials: ``(initial, cost, next row, next state)``."""
    moves = [("D", DELETE, i + 1, state), ("I", INSERT, i, _NEXT[state])]
    if not (rows.blank[i] or rows.repeat[i]):
        more = CUT_OFF if rows.cut_off[i] else 0
        to = _STEP.get((state, rows.roles[i][:1]))
        if to is not None:
            moves.append(("K", more, i + 1, to))
        moves.append(("R", REROLE + more, i + 1, _NEXT[state]))
    return moves


def suffix_bounds(rows: Rows, after: list[int]) -> list[list[int]]:
    """Least cost from before each row, for each state, to the end; ``after`` has the cost
    of what follows the rows."""
    bounds = [after]
    for i in reversed(range(len(rows))):
        behind = bounds[-1]
        here = [min(c + behind[to] for _, c, j, to in _moves(rows, i, q) if j > i) for q in range(4)]
        for _ in range(2):  # two insertions in a row lead through all roles
            here = [min(here[q], INSERT + here[_NEXT[q]]) for q in range(4)]
        bounds.append(here)
    return bounds[::-1]


def search(rows: Rows, start: int, after: list[int], last: bool) -> tuple[str, int]:
    """The audit of the cheapest edits and the state they end in; ``last`` if no rows
    follow, so that insertions may."""
    bounds = suffix_bounds(rows, after)
    limit = bounds[0][start]
    if limit >= _NEVER:
        return "", NOTHING
    incumbent: tuple[int, tuple | None] = (limit + 1, None)
    reached: list[dict[int, int]] = [{} for _ in range(len(rows) + 1)]
    stack: list[tuple] = [(0, 0, start, "", None)]
    while stack:
        node = stack.pop()
        cost, i, state, _, _ = node
        if cost + bounds[i][state] >= incumbent[0] or reached[i].get(state, _NEVER) <= cost:
            continue
        reached[i][state] = cost
        if i < len(rows):
            moves = sorted(_moves(rows, i, state), reverse=True)
        elif last and state in (SYSTEM, USER):
            moves = [("I", INSERT, i, _NEXT[state])]
        else:
            incumbent = (cost + after[state], node)
            continue
        for initial, more, j, to in moves:
            if cost + more + bounds[j][to] < incumbent[0]:
                stack.append((cost + more, j, to, initial, node))
    node, audit = incumbent[1], []
    end = node[2]
    while node[4] is not None:
        audit.append(node[3])
        node = node[4]
    return "".join(reversed(audit)), end


def repaired(rows: Rows, start: int, audit: str) -> list[tuple[str, str]]:
    """Role and text of the rows that the edits make."""
    out, i, state = [], 0, start
    for edit in audit:
        if edit == "K":
            state = _STEP[state, rows.roles[i][:1]]
            out.append((rows.roles[i], rows.texts[i]))
        elif edit != "D":
            state = _NEXT[state]
            out.append((_ROLE[state], "" if edit == "I" else rows.texts[i]))
        i += edit != "I"
    return out


def _joined(made: list[tuple[str, str]]) -> bytes:
    return "\n".join(f"{role}:{text}" for role, text in made).encode()


_PLACE = "conv_id long, task int, block int"
_BLOCKS = f"{_PLACE}, turns array<long>, roles array<string>, texts array<string>"
_TYPES = [
    pa.int64(), pa.int32(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.string()), pa.list_(pa.string()),
]
_NAMES = ["conv_id", "task", "block", "turns", "roles", "texts"]


def blocks(rows: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``rows (conv_id, turn, role, text)`` in order, as blocks of one conversation each.

    ``task, block`` order the blocks of a conversation.
    """
    rows = rows.select(
        F.col("conv_id").cast("long"),
        F.col("turn").cast("long"),
        F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("text"),
    )
    order = [F.asc_nulls_first("conv_id"), F.asc_nulls_first("turn"), F.col("role"), F.xxhash64("text")]
    rows = rows.withColumn("salt", F.xxhash64(F.monotonically_increasing_id()))
    rows = rows.repartitionByRange(*order, "salt").drop("salt").sortWithinPartitions(*order)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list = []
        size = number = 0
        ready: list[tuple] = []
        for batch in batches:
            for conv, turn, role, text, task in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if held and (conv != held[0] or len(held[3]) >= block_rows or size + len(text) > BLOCK_BYTES):
                    ready.append(tuple(held))
                    number = number + 1 if conv == held[0] else 0
                    held = []
                if not held:
                    held, size = [conv, task, number, [], [], []], 0
                for values, value in zip(held[3:], (turn, role, text), strict=True):
                    values.append(value)
                size += len(text)
            if ready:
                yield _to_batch(ready, _TYPES, _NAMES)
                ready = []
        if held:
            yield _to_batch([tuple(held)], _TYPES, _NAMES)

    return stored(rows.withColumn("task", F.spark_partition_id()).mapInArrow(run, _BLOCKS), "turns")


def _to_batch(rows: list[tuple], types: list[pa.DataType], names: list[str]) -> pa.RecordBatch:
    columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)]
    return pa.RecordBatch.from_arrays(columns, names=names)


def _several(made: DataFrame) -> DataFrame:
    """The places of blocks of conversations that have more than one."""
    places = made.select("conv_id", "task", "block")
    held = places.groupBy("conv_id").count().where("count > 1").select("conv_id")
    same = F.col("a.conv_id").eqNullSafe(F.col("b.conv_id"))
    return stored(places.alias("a").join(held.alias("b"), same, "left_semi"), "places")


_SAME_BLOCK = ["conv_id", "task", "block"]


def _beside(left: DataFrame, right: DataFrame, names: list[str], how: str) -> DataFrame:
    """Joined on equal names, nulls equal to each other."""
    other = right.select(*[F.col(c).alias(f"_{c}" if c in names else c) for c in right.columns])
    same = [left[c].eqNullSafe(other[f"_{c}"]) for c in names]
    joined = left.join(other, same[0] if len(same) == 1 else same[0] & same[1] & same[2], how)
    return joined.drop(*[f"_{c}" for c in names])


def _seen_before(made: DataFrame) -> DataFrame:
    """``conv_id, task, block, seen``: keys of a block that an earlier block holds too."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                conv, task, block, turns, roles, texts = (c[k].as_py() for c in batch.columns)
                keys = sorted(set(Rows(turns, roles, texts).keys()))
                n = len(keys)
                yield _to_batch(
                    list(zip([conv] * n, [task] * n, [block] * n, keys, strict=True)),
                    [*_TYPES[:3], pa.binary()],
                    [*_NAMES[:3], "key"],
                )

    held = stored(made.select(*_NAMES).mapInArrow(run, f"{_PLACE}, key binary"), "keys")
    first = held.groupBy("conv_id", "key").agg(F.min(F.struct("task", "block")).alias("first"), F.count("*").alias("n"))
    first = first.where("n > 1").select(F.col("conv_id").alias("c"), F.col("key").alias("k"), "first")
    again = held.join(first, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("key") == F.col("k")))
    again = again.where(F.struct("task", "block") != F.col("first"))
    return stored(again.groupBy(*_SAME_BLOCK).agg(F.collect_set("key").alias("seen")), "seen")


def _costs(made: DataFrame) -> DataFrame:
    """``costs`` of each block from any state before it to any after it, 16 numbers."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                conv, task, block, turns, roles, texts, seen = (c[k].as_py() for c in batch.columns)
                rows = Rows(turns, roles, texts)
                rows.judge(set(seen or ()))
                to = [suffix_bounds(rows, [0 if q == end else _NEVER for q in range(4)])[0] for end in range(4)]
                costs = [min(to[end][q], _NEVER) for q in range(4) for end in range(4)]
                yield _to_batch([(conv, task, block, costs)], [*_TYPES[:3], pa.list_(pa.int64())], [*_NAMES[:3], "costs"])

    rows = made.select(*_NAMES, "seen").mapInArrow(run, f"{_PLACE}, costs array<long>")
    return stored(rows, "costs")


def _after(costs: list[np.ndarray], end: np.ndarray) -> list[np.ndarray]:
    """Least costs to the end after each of some blocks in order."""
    out = [end]
    for c in costs[:0:-1]:
        out.append(np.minimum((c + out[-1][None, :]).min(axis=1), _NEVER))
    return out[::-1]


def _square(values: pd.Series) -> list[np.ndarray]:
    return [np.array(v, dtype=np.int64).reshape(4, 4) for v in values]


def _bounds(costs: DataFrame) -> DataFrame:
    """``conv_id, task, block, after, is_last``: the suffix bounds at each block's end."""

    def product(group: pd.DataFrame) -> pd.DataFrame:
        parts = _square(group.sort_values("block")["costs"])
        whole = parts[0]
        for part in parts[1:]:
            whole = np.minimum((whole[:, :, None] + part[None, :, :]).min(axis=1), _NEVER)
        top = group.iloc[:1]
        return pd.DataFrame({"conv_id": top["conv_id"], "task": top["task"], "whole": [whole.ravel().tolist()]})

    def by_task(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("task").reset_index(drop=True)
        after = _after(_square(group["whole"]), np.array(_FINISH))
        return group[["conv_id", "task"]].assign(end=[a.tolist() for a in after], final=group.index == len(group) - 1)

    def by_block(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("block").reset_index(drop=True)
        after = _after(_square(group["costs"]), np.array(group["end"][0]))
        last = (group.index == len(group) - 1) & group["final"]
        return group[_SAME_BLOCK].assign(after=[a.tolist() for a in after], is_last=last)

    tasks = costs.groupBy("conv_id", "task").applyInPandas(product, "conv_id long, task int, whole array<long>")
    ends = tasks.groupBy("conv_id").applyInPandas(by_task, "conv_id long, task int, end array<long>, final boolean")
    ends = ends.select(F.col("conv_id").alias("c"), F.col("task").alias("t"), "end", "final")
    rows = costs.join(ends, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("task") == F.col("t"))).drop("c", "t")
    rows = rows.groupBy("conv_id", "task").applyInPandas(by_block, f"{_PLACE}, after array<long>, is_last boolean")
    return stored(rows, "bounds")


_SEARCHED = (
    f"{_PLACE}, start int, stop int, audit string, first_role string, last_role string, first_turn long, last_turn long, "
    "turns long, blank long, duplicate long, truncated long, illegal long, cost long, repaired array<struct<role:string,text:string>>"
)
_SEARCHED_NAMES = [
    "conv_id", "task", "block", "start", "stop", "audit", "first_role", "last_role", "first_turn", "last_turn",
    "turns", "blank", "duplicate", "truncated", "illegal", "cost", "repaired",
]
_TEXT = pa.struct([("role", pa.string()), ("text", pa.string())])
_SEARCHED_TYPES = [
    *_TYPES[:3], pa.int32(), pa.int32(), *[pa.string()] * 3, pa.int64(), pa.int64(), *[pa.int64()] * 6, pa.list_(_TEXT),
]
_SEARCH_ROWS = 500


def _cost(rows: Rows, audit: str) -> int:
    total = i = 0
    for edit in audit:
        total += {"K": 0, "R": REROLE, "D": DELETE, "I": INSERT}[edit]
        total += CUT_OFF if edit in "KR" and rows.cut_off[i] else 0
        i += edit != "I"
    return total


def _searched(made: DataFrame, all_starts: bool) -> DataFrame:
    """Blocks repaired: from nothing, or from each state that a block may begin in."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            held = 0
            for k in range(batch.num_rows):
                conv, task, block, turns, roles, texts, seen, after, is_last = (c[k].as_py() for c in batch.columns)
                rows = Rows(turns, roles, texts)
                rows.judge(set(seen or ()))
                first = [r[:1] for r in roles]
                known = [t for t in turns if t is not None]
                faults = [sum(rows.blank), sum(rows.repeat), sum(rows.cut_off)]
                illegal = sum(a + b not in _GOOD_PAIRS for a, b in zip(first, first[1:], strict=False))
                ends = (min(known, default=None), max(known, default=None), len(set(known)))
                for start in range(4) if all_starts else (NOTHING,):
                    audit, stop = search(rows, start, after or _FINISH, is_last is not False)
                    made = [{"role": r, "text": t} for r, t in repaired(rows, start, audit)]
                    out.append((conv, task, block, start, stop, audit, first[0], first[-1], *ends, *faults, illegal, _cost(rows, audit), made))
                held += len(roles)
                if held >= _SEARCH_ROWS:
                    yield _to_batch(out, _SEARCHED_TYPES, _SEARCHED_NAMES)
                    out, held = [], 0
            if out:
                yield _to_batch(out, _SEARCHED_TYPES, _SEARCHED_NAMES)

    return made.select(*_NAMES, "seen", "after", "is_last").mapInArrow(run, _SEARCHED)


def _chosen(found: DataFrame) -> DataFrame:
    """Of the searches of each block the one that begins where the block before ends."""
    steps = found.select(*_SAME_BLOCK, "start", "stop")

    def walk(state: int, group: pd.DataFrame) -> tuple[int, list[int]]:
        starts = []
        for stops in group.pivot(index="block", columns="start", values="stop").sort_index().to_numpy():
            starts.append(state)
            state = int(stops[state])
        return state, starts

    def by_task(group: pd.DataFrame) -> pd.DataFrame:
        stops = [walk(q, group)[0] for q in range(4)]
        top = group.iloc[:1]
        return pd.DataFrame({"conv_id": top["conv_id"], "task": top["task"], "stops": [stops]})

    def by_conversation(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("task").reset_index(drop=True)
        state, begins = NOTHING, []
        for stops in group["stops"]:
            begins.append(state)
            state = int(stops[state])
        return group[["conv_id", "task"]].assign(begin=begins)

    def by_block(group: pd.DataFrame) -> pd.DataFrame:
        starts = walk(int(group["begin"].iloc[0]), group)[1]
        numbers = sorted(group["block"].unique())
        top = group.iloc[0]
        return pd.DataFrame({"conv_id": [top["conv_id"]] * len(starts), "task": top["task"], "block": numbers, "begin": starts})

    tasks = steps.groupBy("conv_id", "task").applyInPandas(by_task, "conv_id long, task int, stops array<int>")
    begins = tasks.groupBy("conv_id").applyInPandas(by_conversation, "conv_id long, task int, begin int")
    begins = begins.select(F.col("conv_id").alias("c"), F.col("task").alias("t"), "begin")
    steps = steps.join(begins, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("task") == F.col("t"))).drop("c", "t")
    begins = steps.groupBy("conv_id", "task").applyInPandas(by_block, f"{_PLACE}, begin int")
    return _beside(found, stored(begins, "begins"), _SAME_BLOCK, "inner").where("start = begin").drop("begin")


def repair(rows: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """The blocks of all conversations with their edits, counts and repaired rows.

    One row for each block of a conversation, in the order ``task, block``; nearly all
    conversations have one.
    """
    made = blocks(rows, block_rows)
    places = _several(made)
    none = {"seen": "array<binary>", "after": "array<bigint>", "is_last": "boolean"}
    single = _beside(made, places, _SAME_BLOCK, "left_anti")
    single = single.select(*_NAMES, *[F.lit(None).cast(t).alias(c) for c, t in none.items()])
    found = _searched(single, all_starts=False)
    if not places.isEmpty():
        long = _beside(made, places, _SAME_BLOCK, "left_semi")
        long = stored(_beside(long, _seen_before(long), _SAME_BLOCK, "left"), "long")
        long = _beside(long, _bounds(_costs(long)), _SAME_BLOCK, "inner")
        found = found.union(_chosen(stored(_searched(long, all_starts=True), "searched")))
    return stored(found.select(*_SEARCHED_NAMES), "repaired")


def repaired_rows(found: DataFrame) -> DataFrame:
    """``conv_id, task, block, place, role, text``: the repaired rows of ``repair``."""
    return found.select(*_SAME_BLOCK, F.posexplode("repaired").alias("place", "row")).select(
        *_SAME_BLOCK, "place", "row.role", "row.text"
    )


_COUNTED = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
_REPORT = "conv_id long, " + ", ".join(f"{c} long" for c in _COUNTED) + ", audit string, repaired_sha256 string"


def report(found: DataFrame) -> DataFrame:
    """One row for each conversation of ``repair``: gaps in its turns, faults by kind,
    pairs of neighbours whose roles do not fit, cost and audit, digest of the repaired text."""
    rows = found.select(*_SEARCHED_NAMES)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made: _Report | None = None
        out: list[tuple] = []
        for batch in batches:
            for k in range(batch.num_rows):
                block = dict(zip(batch.schema.names, (c[k].as_py() for c in batch.columns), strict=True))
                if made is None or made.conv_id != block["conv_id"]:
                    if made is not None:
                        out.append(made.row())
                    made = _Report(block["conv_id"])
                made.add(block)
            if out:
                yield _to_batch(out, _REPORT_TYPES, _REPORT_NAMES)
                out = []
        if made is not None:
            yield _to_batch([made.row()], _REPORT_TYPES, _REPORT_NAMES)

    return rows.repartition("conv_id").sortWithinPartitions(*_SAME_BLOCK).mapInArrow(run, _REPORT)


_REPORT_NAMES = ["conv_id", *_COUNTED, "audit", "repaired_sha256"]
_REPORT_TYPES = [pa.int64(), *[pa.int64()] * len(_COUNTED), pa.string(), pa.string()]


class _Report:
    """A conversation's report, from its blocks in order."""

    def __init__(self, conv_id: int | None):
        self.conv_id = conv_id
        self.sums = dict.fromkeys(_COUNTED[1:], 0)
        self.turns = 0
        self.first: int | None = None
        self.last: int | None = None
        self.role: str | None = None
        self.audit: list[str] = []
        self.digest = hashlib.sha256()
        self.begun = False

    def add(self, block: dict) -> None:
        for name in self.sums:
            self.sums[name] += block[name]
        if self.role is not None:
            self.sums["illegal"] += self.role + block["first_role"] not in _GOOD_PAIRS
        self.role = block["last_role"]
        if block["first_turn"] is not None:
            self.turns += block["turns"] - (self.last == block["first_turn"])
            self.first = block["first_turn"] if self.first is None else self.first
            self.last = block["last_turn"]
        self.audit.append(block["audit"])
        made = [(r["role"], r["text"]) for r in block["repaired"]]
        if made:
            self.digest.update(b"\n" * self.begun + _joined(made))
            self.begun = True

    def row(self) -> tuple:
        gaps = 0 if self.first is None else self.last - self.first + 1 - self.turns
        return (self.conv_id, gaps, *self.sums.values(), "".join(self.audit), self.digest.hexdigest())


def damaged(rows: DataFrame) -> DataFrame:
    """``rows (conv_id, turn, role, text)`` with faults put in by a checksum of the place:
    a twentieth of the rows each is dropped, emptied, stripped of its sentence ends,
    doubled, or given to the user. Nulls count as one space."""
    space = F.lit(" ")
    place = [F.coalesce(F.col(c).cast("string"), space) for c in ("conv_id", "turn")]
    rows = rows.select(
        "conv_id",
        "turn",
        *[F.coalesce(F.col(c).cast("string"), space).alias(c) for c in ("role", "text")],
        (F.crc32(F.concat(place[0], F.lit(":"), place[1]).cast("binary")) % 20).alias("fault"),
    ).where("fault <> 0")
    text = F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("fault") == 4, "user").otherwise(F.col("role"))
    times = F.explode(F.when(F.col("fault") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), times.alias("copy")).drop("copy")
