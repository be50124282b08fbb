import pyarrow as pa
from pyspark.sql import functions as F

from rowsieve.llm import cgk_decontam, tokens, words
from rowsieve.llm.common import lean, maybe_among, with_ids


def test_filter_keeps_every_partner_whatever_the_width_of_ids(spark):
    docs = spark.range(2000).select(F.col("id").cast("int").alias("doc_id"), F.lit("t").alias("text"))
    docs = docs.union(spark.createDataFrame([(None, "n")], "doc_id int, text string"))
    ids = spark.range(0, 2000, 7).withColumnRenamed("id", "doc_id").union(spark.createDataFrame([(None,)], "doc_id long"))
    some, rest = with_ids(docs, ids), with_ids(docs, ids, maybe=False)
    wanted = {None, *range(0, 2000, 7)}
    assert wanted <= {r["doc_id"] for r in some.collect()}
    assert not wanted & {r["doc_id"] for r in rest.collect()}
    assert some.count() + rest.count() == 2001 and some.count() < 300
    assert maybe_among(docs, ids.limit(0), "doc_id").count() == 0


def test_a_task_that_ends_leaves_no_tables_behind(spark, tokenizer):
    texts = [pa.RecordBatch.from_pydict({"text": [f"w{k} and more"]}) for k in range(3)]

    def encode(batches):
        for batch in batches:
            for ids in tokens.token_ids(batch.column("text"), tokenizer, 1):
                words.powers(cgk_decontam._BASE, len(ids))
                yield len(ids)

    run = lean(encode, lambda: tokens.forget(tokenizer), words.forget_powers)(texts)
    assert next(run) > 0 and tokens.encoder(tokenizer).pieces and words._powers
    assert len(list(run)) == 2 and not tokens.encoder(tokenizer).pieces and not words._powers


def test_workers_keep_little_memory_that_they_freed(spark):
    assert int(spark.sparkContext.environment["MALLOC_TRIM_THRESHOLD_"]) <= 16 << 20
