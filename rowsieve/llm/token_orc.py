"""Token ids in ORC files: sorted by document, pruned by metadata, read stripe by stripe.

Layout of a folder:

* ``data/`` – ORC files in ascending ``doc_id`` order, within and between files, with each
  document's ids and their number, so that offsets are summed without reading ids. Integer
  columns are run-length encoded by the format; row indexes hold the range of ``doc_id``
  for every ``row_stride`` rows, and a Bloom filter on it lets a lookup skip the others.
* ``offsets/`` – one row a file: its number, its ids and the ids of all files before it.

A document's place in the whole sequence of ids is the offset of its file plus its place
in that file, so nothing is encoded twice and only texts are shuffled, not ids.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rowsieve.llm.common import lean, spans
from rowsieve.llm.tokens import crc32, forget, token_ids

SCHEMA = "part int, doc_id long, place long, n_ids long, ids array<int>"
OFFSETS = "part int, first_doc long, last_doc long, documents long, n_ids long, base long"


def write_tokens(
    docs: DataFrame,
    path: str,
    tokenizer: str,
    end_id: int = 1,
    *,
    stripe_bytes: int = 16 << 20,
    row_stride: int = 2_000,
    false_positives: float = 0.01,
) -> None:
    """Encode ``doc_id, text`` and write them in ascending order of ``doc_id``.

    A null text counts as empty and gives the end id alone. Rows with a null id come
    first; rows with the same id stay apart, ordered by a hash of their text. Further
    columns are ignored. An empty table gives an empty data set that reads back empty.
    """
    spark = docs.sparkSession
    order = ["doc_id", "tie"]
    rows = docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("tie"), "text")
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)

    def encode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, place = TaskContext.get().partitionId(), 0
        for batch in batches:
            texts, doc_ids = batch.column("text"), batch.column("doc_id")
            for lo, hi in spans(texts):
                found = list(token_ids(texts.slice(lo, hi - lo), tokenizer, end_id))
                ends = np.cumsum([len(x) for x in found])
                starts = np.concatenate([[0], ends[:-1]])
                lists = pa.ListArray.from_arrays(
                    pa.array(np.concatenate([[0], ends]), pa.int32()),
                    pa.array(np.concatenate(found).astype(np.int32)),
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([part] * len(found), pa.int32()),
                        doc_ids.slice(lo, hi - lo),
                        pa.array(place + starts),
                        pa.array(ends - starts),
                        lists,
                    ],
                    names=["part", "doc_id", "place", "n_ids", "ids"],
                )
                place += int(ends[-1])

    (
        rows.mapInArrow(lean(encode, partial(forget, tokenizer)), SCHEMA)
        .write.mode("overwrite")
        .option("compression", "zstd")
        .option("orc.stripe.size", stripe_bytes)
        .option("orc.row.index.stride", row_stride)
        .option("orc.create.index", "true")
        .option("orc.bloom.filter.columns", "doc_id")
        .option("orc.bloom.filter.fpp", false_positives)
        .orc(f"{path}/data")
    )
    _write_offsets(spark, path)


def _write_offsets(spark: SparkSession, path: str) -> None:
    data = spark.read.schema(SCHEMA).orc(f"{path}/data")
    parts = data.groupBy("part").agg(
        F.min("doc_id").alias("first_doc"),
        F.max("doc_id").alias("last_doc"),
        F.count("*").alias("documents"),
        F.sum("n_ids").alias("n_ids"),
    )
    # One row a file, so this window is small however many documents there are.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("base", F.coalesce(F.sum("n_ids").over(before), F.lit(0).cast("long")))
    parts.select("part", "first_doc", "last_doc", "documents", "n_ids", "base").write.mode("overwrite").parquet(f"{path}/offsets")


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, ids`` of all documents, a task for each run of stripes."""
    data = spark.read.schema(SCHEMA).orc(f"{path}/data").drop("n_ids")
    offsets = spark.read.schema(OFFSETS).parquet(f"{path}/offsets").select("part", "base")
    rows = data.join(offsets, "part")
    return rows.select("doc_id", (F.col("base") + F.col("place")).alias("start"), "ids")


def lookup_tokens(spark: SparkSession, path: str, doc_ids: list[int]) -> DataFrame:
    """The rows of some documents: files are chosen by their range of ids, row groups by
    index and Bloom filter."""
    return read_tokens(spark, path).where(F.col("doc_id").isin(doc_ids))


def checksums(rows: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of what ``read_tokens`` gives."""

    def digest(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("ids")
            values = lists.flatten().to_numpy()
            ends = np.cumsum(pa.compute.list_value_length(lists).to_numpy())
            starts = np.concatenate([[0], ends[:-1]]) if len(ends) else ends
            crcs = [crc32(values[a:b]) for a, b in zip(starts, ends, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("start"), pa.array(ends - starts, pa.int64()), pa.array(crcs, pa.int64())],
                names=["doc_id", "start", "n_tokens", "ids_crc32"],
            )

    return rows.mapInArrow(digest, "doc_id long, start long, n_tokens long, ids_crc32 long")
