"""From raw documents to packed training sequences, in five stages.

1. Documents that the quality classifier rejects go.
2. Lines that an earlier line matches go, and documents that have no other text.
3. Of each group of near-duplicate documents the one with the smallest id stays.
4. Documents that contain a benchmark item go.
5. What is left is cut into token pieces and packed into sequences.

Every stage takes all rows that the one before it kept; its result is written as Parquet
in the shared folder and read again. All but the last return the columns they were given.

Null texts pass stages 1 to 4 like empty ones, rows with a null id stay where ids would
decide, rows that repeat an id stay or go together in stage 3. Empty tables pass through.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowsieve.llm import best_fit, cgk_decontam, divide_skip, line_dedup, quality_mil
from rowsieve.llm.common import read, scratch, ship, stored, with_ids


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored at the threshold or above by a model learned from the labels."""
    ship(spark)
    labels = read(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label"))
    # Under another name while it is a column, as the table may have a score of its own.
    texts = docs.select(F.struct(*docs.columns).alias("row"), "text")
    scored = quality_mil.score(texts, quality_mil.train(docs, labels))
    return scored.where(F.col("score") >= quality_mil.THRESHOLD).select("row.*")


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that an earlier one holds; none that is left empty."""
    ship(spark)
    rows = docs.select(F.struct(*docs.columns).alias("row"), "doc_id", "text")
    kept = line_dedup.dedup_lines(rows, exact_words=1)
    changed = F.col("removed_lines") > 0
    kept = kept.where(~changed | F.col("text").rlike(r"\S"))
    row = F.col("row").withField("text", F.when(changed, F.col("text")).otherwise(F.col("row.text")))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        length = F.length("text").cast(kind)
        row = row.withField("n_chars", F.when(changed, length).otherwise(F.col("row.n_chars")))
    return kept.select(row.alias("row")).select("row.*")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the smallest id, of each group linked at 0.8 or more on five words."""
    ship(spark)
    groups = divide_skip.jaccard_components(docs, divide_skip.Rule(words=5, numerator=4, denominator=5))
    gone = stored(groups.where("component_id <> doc_id").select("doc_id").distinct(), "gone")
    maybe = with_ids(docs, gone).join(gone, "doc_id", "left_anti").select(*docs.columns)
    return with_ids(docs, gone, maybe=False).union(maybe)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item is found."""
    ship(spark)
    return cgk_decontam.decontaminate(docs, read(spark, sf_dir, "benchmark"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of at most 2048 ids and their places in sequences."""
    ship(spark)
    tokenizer = public_tokenizers.path("word_bpe_49k.json")
    return best_fit.pack(best_fit.token_pieces(docs, tokenizer, end_id=0, capacity=2048), 2048)


STAGES = [
    ("quality_classifier", keep_good),
    ("line_dedup", drop_repeated_lines),
    ("ngram_jaccard_join", drop_near_duplicates),
    ("benchmark_decontamination", drop_contaminated),
    ("best_fit_packing", pack_sequences),
]

# Learned scores, tokenizers and packing have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name, scratch(spark, name))
    return docs
