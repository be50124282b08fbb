"""What the operators of this subpackage share: tables, stored results, Arrow batches."""

from __future__ import annotations

import ctypes
import functools
import os
import tempfile
import zipfile
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

import rowsieve
from rowsieve.queries.common import scratch

__all__ = ["read", "scratch", "ship", "lean", "stored", "discard", "spans", "text_bytes", "maybe_among", "with_ids", "WORK_BYTES"]

# Texts are taken together until they hold so many bytes; one longer text stands alone.
WORK_BYTES = 1 << 18


@functools.lru_cache(maxsize=1)
def _package() -> str | None:
    """A zip file of this package's code, unless it is not in a plain folder."""
    root = os.path.dirname(os.path.abspath(rowsieve.__file__))
    if not os.path.isdir(root):
        return None
    path = os.path.join(tempfile.mkdtemp(), "rowsieve.zip")
    with zipfile.ZipFile(path, "w") as out:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    out.write(full, os.path.relpath(full, os.path.dirname(root)))
    return path


# Bytes of a batch of rows that goes to or from Python at once, where the session names
# no number: several batches are held at a time, on both sides.
BATCH_BYTES = 4 << 20
_BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


# Python workers live on between tasks. So they give memory back that they have freed,
# beyond 16 MB of it, rather than keep what their largest task took.
_WORKERS = {
    "MALLOC_TRIM_THRESHOLD_": str(16 << 20),
    "MALLOC_MMAP_THRESHOLD_": str(16 << 20),
    "MALLOC_ARENA_MAX": "2",
    "ARROW_DEFAULT_MEMORY_POOL": "system",
}


def ship(spark: SparkSession) -> None:
    """Have Spark send this package's code to the workers, which may not have it, and
    bound the batches they get and the memory they keep; what the session has set stays."""
    for name, value in _WORKERS.items():
        spark.sparkContext.environment.setdefault(name, value)
    if spark.conf.get(_BATCH_BYTES, None) is None:
        spark.conf.set(_BATCH_BYTES, str(BATCH_BYTES))
    path = _package()
    if path and not any(f.endswith("/rowsieve.zip") for f in spark.sparkContext.listFiles):
        spark.sparkContext.addPyFile(path)


def lean(run: Callable, *forget: Callable[[], None]) -> Callable:
    """``run`` for ``mapInArrow``, at whose end the worker calls ``forget`` and gives back
    the memory it has freed: it lives on, and others of its executor need some as well."""

    def leaving(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        for each in forget:
            each()
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
        if trim:
            trim(0)

    return leaving


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the given folder; the workers get this package's code as well."""
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, purpose: str, folder: str | None = None) -> DataFrame:
    """The rows of ``df`` from a table written in the shared folder.

    This cuts the lineage: a lost executor makes Spark read the files again, not redo
    what led to them.
    """
    spark = df.sparkSession
    path = folder or scratch(spark, purpose)
    df.write.mode("overwrite").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.stored_at = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete tables made by ``stored`` that nothing reads any more."""
    for table in tables:
        spark = table.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(table.stored_at)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


# Bits of the filter that ``maybe_among`` sends to all tasks: so many for each key, 8 MB
# however many keys.
_BITS_A_KEY = 64
_FILTER_BITS = 1 << 26


def maybe_among(rows: DataFrame, keys: DataFrame, *names: str, keep: bool = True) -> DataFrame:
    """The rows whose values in ``names`` may be among those of ``keys``, or the others,
    which surely are not.

    A filter of one hash goes to all tasks, so that rows without a partner are not shuffled
    for the join that follows. Its size follows the number of keys up to ``_FILTER_BITS``;
    with more keys it lets more rows through, no other ones. Only the bit's number goes to
    Python; the rows stay where they are.
    """
    bit = _bit(rows, names)
    places = keys.select(_bit(keys, names).alias("bit")).select(
        F.shiftright("bit", 5).alias("word"), F.expr("shiftleft(1L, cast(bit % 32 as int))").alias("bits")
    )
    found = places.groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()
    held = np.zeros(_FILTER_BITS // 32, dtype=np.uint32)
    held[found.column("word").to_numpy()] = found.column("bits").to_numpy()
    held = _folded(held)
    mask = 32 * len(held) - 1
    sent = rows.sparkSession.sparkContext.broadcast(held)

    @F.arrow_udf("boolean")
    def among(bits: pa.Array) -> pa.Array:
        at = bits.to_numpy() & mask
        return pa.array((sent.value[at >> 5] >> (at & 31).astype(np.uint32)) & 1 == 1)

    inside = among(bit)
    return rows.where(inside if keep else ~inside)


def _folded(held: np.ndarray) -> np.ndarray:
    """The filter with its bits taken modulo a smaller size, where its keys are few."""
    wanted = _BITS_A_KEY * max(1024, int(np.bitwise_count(held).sum(dtype=np.int64)))
    words = min(len(held), 1 << ((wanted - 1).bit_length() - 5))
    return np.bitwise_or.reduce(held.reshape(-1, words), axis=0)


def _bit(rows: DataFrame, names: tuple[str, ...]) -> Column:
    """Whole numbers of every width hash alike."""
    whole = {f.name for f in rows.schema.fields if isinstance(f.dataType, IntegralType)}
    values = [F.col(n).cast("long") if n in whole else F.col(n) for n in names]
    return F.pmod(F.xxhash64(*values), F.lit(_FILTER_BITS))


def with_ids(docs: DataFrame, ids: DataFrame, maybe: bool = True) -> DataFrame:
    """The rows of ``docs`` whose ``doc_id`` may be among ``ids (doc_id)``, or the others."""
    return maybe_among(docs, ids, "doc_id", keep=maybe)


def text_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of each text; null counts as empty."""
    return [b"" if v is None else v for v in column.cast(pa.large_binary()).to_pylist()]


def spans(texts: pa.Array, limit: int = WORK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive texts of about ``limit`` bytes."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    start = held = 0
    for i, size in enumerate(sizes):
        if held and held + size > limit:
            yield start, i
            start, held = i, 0
        held += int(size)
    if start < len(sizes):
        yield start, len(sizes)
