from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from rowsieve.llm.best_fit import pack, token_pieces
from rowsieve.llm.tokens import crc32
from tests.llm.texts import awkward, frame


def filled(rows, capacity):
    """Sequences without gaps or overlaps; returns their number."""
    places = defaultdict(list)
    for r in rows:
        places[r["sequence_id"]].append((r["offset"], r["length"]))
    for found in places.values():
        at = 0
        for offset, length in sorted(found):
            assert offset == at
            at += length
        assert at <= capacity
    return len(places)


def best_fit_count(lengths, capacity):
    free = []
    for n in sorted(lengths, reverse=True):
        fitting = [f for f in free if f >= n]
        if fitting:
            free.remove(min(fitting))
            free.append(min(fitting) - n)
        else:
            free.append(capacity - n)
    return len(free)


@pytest.mark.parametrize("last_step", [0, 5_000])
@pytest.mark.parametrize("kind", ["mixed", "equal", "small", "large"])
def test_nearly_as_few_sequences_as_one_best_fit(spark, kind, last_step):
    r = np.random.default_rng(5)
    lengths = {
        "mixed": r.integers(1, 101, 600),
        "equal": np.full(500, 30),
        "small": r.integers(1, 4, 900),
        "large": r.integers(45, 60, 300),
    }[kind]
    pieces = spark.createDataFrame([(int(x), "a") for x in lengths], "length long, other string")
    rows = pack(pieces.repartition(7), 100, last_step=last_step).collect()
    assert sorted(x["length"] for x in rows) == sorted(lengths.tolist())
    assert filled(rows, 100) <= 1.03 * best_fit_count(lengths.tolist(), 100) + 1


def test_pieces_of_awkward_texts(spark, tokenizer):
    found = token_pieces(frame(spark, awkward()), tokenizer, end_id=0, capacity=64, with_ids=True).collect()
    whole = Tokenizer.from_file(tokenizer)
    expected = []
    for doc_id, text in awkward():
        ids = np.array([*whole.encode(text or "", add_special_tokens=False).ids, 0], dtype="<u4")
        for k, at in enumerate(range(0, len(ids), 64)):
            part = ids[at : at + 64]
            expected.append((doc_id, k, at, len(part), crc32(part), part.tolist()))
    assert sorted(map(repr, map(tuple, found))) == sorted(map(repr, expected))


def test_pack_keeps_rows_and_defines_odd_lengths(spark):
    pieces = spark.createDataFrame([(1, 5), (1, 5), (2, None), (3, 0), (4, 11), (5, 10)], "doc_id long, length long")
    rows = pack(pieces, 10).collect()
    assert len(rows) == 6
    placed = [r for r in rows if r["length"] in (5, 10)]
    assert filled(placed, 10) == 2
    assert all(r["sequence_id"] is None for r in rows if r["length"] not in (5, 10))
    assert pack(pieces.limit(0), 10).count() == 0
    names = ["id", "row", "_uid", "size", "kind"]
    clashing = pieces.select("*", *[F.lit("mine").alias(c) for c in names], F.lit(1).alias("offset"))
    found = pack(clashing, 10)
    assert found.columns == [*pieces.columns, *names, "sequence_id", "offset"]
    found = found.collect()
    assert {r[c] for r in found for c in names} == {"mine"}
    assert sorted(r["offset"] for r in found if r["length"] in (5, 10)) == [0, 0, 5]
