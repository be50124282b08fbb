"""URL filters by Bloom filter cascades.

A cascade answers exactly whether a key of a known universe is listed, without a join.
Its first Bloom filter holds the listed keys, the second those other keys of the universe
that the first lets through by mistake, the third the listed keys that the second lets
through, and so on until no mistake is left. A key is listed if the first level it fails
has an even number, or if it passes all of an odd number of levels.

Keys are dealt to shards by their hash, so each shard's cascade is built by one task from
a bounded number of distinct keys, however often a key occurs. Cascades are sent to all
tasks in blocks of at most ``MOST_BYTES``; larger lists take one pass over the rows for
each block. Keys outside the universe may get a wrong answer, so the universe has to hold
every key that will be asked for.
"""

from __future__ import annotations

import math
import pickle
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowsieve.llm.common import stored
from rowsieve.llm.words import mix

SHARD_KEYS = 500_000
MOST_BYTES = 32 << 20

Level = tuple[int, int, np.ndarray]  # number of bits, of probes, the bits in bytes


def _places(a: np.ndarray, b: np.ndarray, level: int, bits: int, probes: int) -> np.ndarray:
    first = mix(a + np.uint64(level * 2 + 1))
    step = mix(b + np.uint64(level * 2 + 2)) | np.uint64(1)
    turns = np.arange(probes, dtype=np.uint64)[:, None]
    return (mix(first[None, :] + turns * step[None, :]) % np.uint64(bits)).astype(np.int64)


def _passes(level: int, filt: Level, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    bits, probes, data = filt
    at = _places(a, b, level, bits, probes)
    return ((data[at >> 3] >> (at & 7).astype(np.uint8)) & 1).all(axis=0)


def _filter(level: int, a: np.ndarray, b: np.ndarray, mistakes: float) -> Level:
    probes = max(1, round(-math.log2(mistakes)))
    bits = max(8, math.ceil(len(a) * probes / math.log(2)))
    data = np.zeros((bits + 7) // 8, dtype=np.uint8)
    at = _places(a, b, level, bits, probes).ravel()
    np.bitwise_or.at(data, at >> 3, (1 << (at & 7)).astype(np.uint8))
    return bits, probes, data


def make_levels(a: np.ndarray, b: np.ndarray, listed: np.ndarray) -> list[Level]:
    """The cascade of distinct keys given by two hashes each."""
    inside, outside = np.flatnonzero(listed), np.flatnonzero(~listed)
    first = len(inside) / max(1, len(outside)) * math.sqrt(0.5)
    levels: list[Level] = []
    while len(inside):
        mistakes = 0.5 if levels else min(0.5, max(1e-6, first))
        filt = _filter(len(levels), a[inside], b[inside], mistakes)
        through = outside[_passes(len(levels), filt, a[outside], b[outside])]
        levels.append(filt)
        inside, outside = through, inside
    return levels


def ask_levels(levels: list[Level], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    answer = np.zeros(len(a), dtype=bool)
    left = np.arange(len(a))
    for level, filt in enumerate(levels):
        passed = _passes(level, filt, a[left], b[left])
        answer[left[~passed]] = level % 2 == 1
        left = left[passed]
    answer[left] = len(levels) % 2 == 1
    return answer


def build(listed: DataFrame, universe: DataFrame, shard_keys: int = SHARD_KEYS) -> DataFrame:
    """``shard, shards, levels`` for string keys in the first column of both tables.

    Repeated keys count once; null is a key like any other. Listed keys belong to the
    universe without being repeated there.
    """
    keys = universe.select(F.col(universe.columns[0]).alias("key"), F.lit(False).alias("listed"))
    keys = keys.union(listed.select(F.col(listed.columns[0]), F.lit(True)))
    keys = keys.groupBy("key").agg(F.max("listed").alias("listed"))
    keys = stored(keys.select(*_hashes(F.col("key")), "listed"), "keys")
    shards = max(1, -(-keys.count() // shard_keys))

    def one(frame: pd.DataFrame) -> pd.DataFrame:
        a, b = (frame[c].to_numpy(np.int64).view(np.uint64) for c in ("a", "b"))
        levels = make_levels(a, b, frame["listed"].to_numpy(bool))
        shard = int(frame["shard"].iloc[0])
        return pd.DataFrame({"shard": [shard], "shards": [shards], "levels": [pickle.dumps(levels)]})

    dealt = keys.withColumn("shard", F.pmod("a", F.lit(shards)))
    made = dealt.groupBy("shard").applyInPandas(one, "shard long, shards long, levels binary")
    return stored(made, "cascade")


def _hashes(key: Column) -> list[Column]:
    known = F.coalesce(key, F.lit("\u0000null"))
    return [F.xxhash64(known).alias("a"), F.xxhash64(known, F.lit(1)).alias("b")]


def _blocks(cascade: DataFrame) -> Iterator[tuple[int, dict[int, bytes]]]:
    held: dict[int, bytes] = {}
    shards = size = 0
    for row in cascade.orderBy("shard").toLocalIterator():
        if held and size + len(row["levels"]) > MOST_BYTES:
            yield shards, held
            held, size = {}, 0
        shards = row["shards"]
        held[row["shard"]] = bytes(row["levels"])
        size += len(row["levels"])
    yield max(1, shards), held


def ask(rows: DataFrame, cascade: DataFrame, keys: Column, out: str) -> DataFrame:
    """``rows`` and a column ``out``: for each of an array of keys whether it is listed.

    A null array gives null. A column named ``out`` is replaced.
    """
    fields = [f for f in rows.schema.fields if f.name != out]
    names = [f.name for f in fields]
    rows = rows.withColumn("_a", F.transform(keys, lambda k: _hashes(k)[0]))
    rows = rows.withColumn("_b", F.transform(keys, lambda k: _hashes(k)[1])).drop(out)
    flags = T.ArrayType(T.BooleanType())
    rows = rows.withColumn(out, F.when(F.col("_a").isNotNull(), F.transform("_a", lambda _: F.lit(False))).cast(flags))
    schema = T.StructType([*fields, T.StructField("_a", T.ArrayType(T.LongType())), T.StructField("_b", T.ArrayType(T.LongType())), T.StructField(out, flags)])
    for turn, (shards, block) in enumerate(_blocks(cascade)):
        if turn:
            rows = stored(rows, "asked")
        rows = rows.select(*names, "_a", "_b", out).mapInArrow(_asker(shards, block), schema)
    return rows.select(*names, out)


def _asker(shards: int, block: dict[int, bytes]):
    sent = [(shard, data) for shard, data in sorted(block.items())]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cascades = {shard: pickle.loads(data) for shard, data in sent}
        for batch in batches:
            at = batch.num_columns - 3
            keys, flags = batch.column(at), batch.column(at + 2)
            a = keys.flatten().to_numpy().view(np.uint64)
            b = batch.column(at + 1).flatten().to_numpy().view(np.uint64)
            answer = flags.flatten().to_numpy(zero_copy_only=False).astype(bool)
            shard = np.mod(a.view(np.int64), shards)
            for number, levels in cascades.items():
                mine = np.flatnonzero(shard == number)
                answer[mine] = ask_levels(levels, a[mine], b[mine])
            sizes = pa.compute.fill_null(pa.compute.list_value_length(keys), 0).to_numpy()
            ends = pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32())
            mask = pa.compute.is_null(keys)
            new = pa.ListArray.from_arrays(ends, pa.array(answer), mask=mask if mask.true_count else None)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], new], names=batch.schema.names)

    return run


# URLs and rules.


def host_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL; both empty without ``://`` or URL."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), "^[^?#]*", 0)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), path


def rule_keys(host: Column, path: Column, rules: Sequence[str]) -> Column:
    """All keys, longest first, that a rule ``host/path`` fitting this URL could have: the
    host or a domain above it, and a beginning of the path as long as some rule's."""
    if not rules:
        return F.array().cast("array<string>")
    split = [r.partition("/") for r in rules]
    labels = range(1, 1 + max((h.count(".") + 1 for h, _, _ in split), default=0))
    lengths = sorted({len(p) + 1 for _, _, p in split})
    parts = F.split(host, "\\.", -1)
    keys = []
    for n in labels:
        domain = F.array_join(F.slice(parts, -n, n), ".")
        for length in lengths:
            fits = (F.size(parts) >= n) & (F.length(path) >= length)
            keys.append(F.when(fits, F.concat(domain, F.substring(path, 1, length))))
    found = F.filter(F.array(*keys), lambda k: k.isNotNull())
    ordered = F.array_sort(F.transform(found, lambda k: F.struct((-F.length(k)).alias("n"), k.alias("key"))))
    return F.transform(ordered, lambda s: s["key"])


def judge(pages: DataFrame, rules: dict[str, str], blocked_hosts: DataFrame) -> DataFrame:
    """``pages`` (with ``url``) and ``host, path, rule, verdict``.

    ``rules`` maps ``host/path`` to ``allow`` or ``block``. A rule fits its host and all
    hosts below it, if the URL's path starts with the rule's; the longest wins. Without a
    rule, a page is blocked if its host is among ``blocked_hosts``. Both questions are put
    to cascades over all keys of these pages. Columns named like the new ones are
    replaced. Null and malformed URLs have an empty host and path.
    """
    host, path = host_path(F.col("url"))
    kept = [c for c in pages.columns if c not in ("host", "path", "rule", "verdict")]
    rows = pages.select(*kept, host.alias("host"), path.alias("path"))
    rows = rows.withColumn("_keys", rule_keys(F.col("host"), F.col("path"), list(rules)))
    asked = rows.select(F.explode("_keys").alias("key"))
    listed = pages.sparkSession.createDataFrame([(r,) for r in rules], "key string")
    rows = ask(rows, build(listed, asked), F.col("_keys"), "_fits")
    rows = ask(rows, build(blocked_hosts, rows.select("host")), F.array("host"), "_blocked")
    fitting = F.filter(F.col("_keys"), lambda k, i: F.get("_fits", i))
    rule = F.get(fitting, F.lit(0))
    known = F.create_map(*[F.lit(x) for pair in rules.items() for x in pair]) if rules else None
    by_list = F.when(F.get("_blocked", F.lit(0)), "block").otherwise("allow")
    verdict = F.coalesce(F.try_element_at(known, rule), by_list) if rules else by_list
    return rows.select(*kept, "host", "path", rule.alias("rule"), verdict.alias("verdict"))
