import numpy as np
from tokenizers import Tokenizer

from rowsieve.llm.common import scratch
from rowsieve.llm.token_orc import OFFSETS, SCHEMA, checksums, lookup_tokens, read_tokens, write_tokens
from rowsieve.llm.tokens import crc32
from tests.llm.texts import awkward, frame


def test_round_trip_in_order(spark, tokenizer):
    folder = scratch(spark, "test")
    write_tokens(frame(spark, awkward()).repartition(5), folder, tokenizer, end_id=1, row_stride=1000)
    rows = sorted(read_tokens(spark, folder).collect(), key=lambda r: r["start"])
    whole = Tokenizer.from_file(tokenizer)
    ids = {}
    for doc_id, text in awkward():
        ids.setdefault(doc_id, []).append([*whole.encode(text or "", add_special_tokens=False).ids, 1])
    order = [r["doc_id"] for r in rows]
    assert order == sorted(order, key=lambda x: (x is not None, x))
    at = 0
    for r in rows:
        assert r["start"] == at and r["ids"] in ids[r["doc_id"]]
        at += len(r["ids"])
    assert sum(len(x) for xs in ids.values() for x in xs) == at
    sums = {(r["doc_id"], r["start"]): (r["n_tokens"], r["ids_crc32"]) for r in checksums(read_tokens(spark, folder)).collect()}
    assert sums == {(r["doc_id"], r["start"]): (len(r["ids"]), crc32(np.array(r["ids"]))) for r in rows}
    assert [r["ids"] for r in lookup_tokens(spark, folder, [8, 99]).collect()] == ids[8]


def test_lookup_pushes_the_ids_to_the_files(spark, tokenizer):
    folder = scratch(spark, "test")
    write_tokens(frame(spark, awkward()), folder, tokenizer)
    plan = lookup_tokens(spark, folder, [8])._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(doc_id,8)" in plan or "In(doc_id" in plan


def test_empty_table(spark, tokenizer):
    folder = scratch(spark, "test")
    write_tokens(frame(spark, awkward()).limit(0), folder, tokenizer)
    assert read_tokens(spark, folder).count() == 0


def test_offsets_are_summed_without_reading_ids(spark, tokenizer):
    folder = scratch(spark, "test")
    write_tokens(frame(spark, awkward()).repartition(3), folder, tokenizer)
    data = spark.read.schema(SCHEMA).orc(f"{folder}/data")
    assert data.where("n_ids <> size(ids) OR n_ids IS NULL").count() == 0
    n_ids = spark.read.schema(OFFSETS).parquet(f"{folder}/offsets").selectExpr("sum(n_ids)").first()[0]
    assert n_ids == data.selectExpr("sum(size(ids))").first()[0]
