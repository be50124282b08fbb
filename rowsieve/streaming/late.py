"""Stream deduplication that remembers every key, however late its copies come.

A watermark forgets. Here the keys of all batches stay in a table, bucketed by key and
partitioned by batch, and each micro-batch is compared with it by a join that leaves the
history where it is: only the batch is shuffled, into the table's buckets, and the history
is streamed past it without a sort. A batch costs a scan of one column of the history, so
take few large batches; where late rows may go, :func:`~rowsieve.operators.dedup_stream`
costs less.

Replay: a batch is compared with the keys of earlier batches only, and what an attempt
wrote, rows and keys, is replaced by the next.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from rowsieve.functions.naming import column, require_columns
from rowsieve.operators.dedup import comparable_columns, dedup, without_keys
from rowsieve.session import tune_session
from rowsieve.sinks.tables import BATCH_ID, RouteSink
from rowsieve.streaming.triggers import trigger_options

KEY = "_key_digest"
# Text forms that keep every digit, whatever the session's zone.
_EXACT = {
    "timeZone": "UTC",
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


@dataclass(frozen=True)
class SeenKeys:
    """The table of keys: its name, the folder of its files and its number of buckets.

    The number of buckets is that of the tasks which compare a batch; it cannot change
    while the table lasts.
    """

    table: str
    path: str
    buckets: int = 64

    def create(self, spark: SparkSession) -> None:
        """Define the table, over files of an earlier session where there are any."""
        location = self.path.replace("\\", "\\\\").replace("'", "\\'")
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.table} ({KEY} BINARY, {BATCH_ID} BIGINT) USING parquet "
            f"PARTITIONED BY ({BATCH_ID}) CLUSTERED BY ({KEY}) INTO {self.buckets} BUCKETS LOCATION '{location}'"
        )
        if self._files(spark, self.path)[0]:
            spark.catalog.recoverPartitions(self.table)

    def before(self, spark: SparkSession, batch_id: int) -> DataFrame:
        """The keys of all earlier batches; some may be there twice."""
        return spark.table(self.table).filter(F.col(BATCH_ID) < batch_id).select(KEY)

    def replace(self, keys: DataFrame, batch_id: int) -> None:
        """Store the keys of a batch instead of those of an earlier attempt at it."""
        self._drop(keys.sparkSession, batch_id)
        # One task a bucket, so that a batch adds one file to each.
        rows = keys.repartition(self.buckets, KEY).select(KEY, F.lit(batch_id).cast("long").alias(BATCH_ID))
        rows.write.insertInto(self.table)

    def compact(self, spark: SparkSession, up_to_batch: int) -> None:
        """Put the keys of settled batches into one partition, one file a bucket.

        Run it while no stream uses the table. Should it be interrupted, keys are there
        twice, which does no harm, and the next run ends the work.
        """
        target = -1 - up_to_batch  # lower than every batch
        held = [n for n in self._partitions(spark) if n <= up_to_batch and n != target]
        if not held:
            return
        old = spark.table(self.table).filter((F.col(BATCH_ID) <= up_to_batch) & (F.col(BATCH_ID) != target))
        if target in self._partitions(spark):
            # Left by a run that was interrupted while it deleted: part of the old may be gone.
            target_rows = spark.table(self.table).filter(F.col(BATCH_ID) == target).select(KEY)
            old = old.join(target_rows, KEY, "left_anti")
        rows = old.select(KEY).distinct().repartition(self.buckets, KEY)
        rows.select(KEY, F.lit(target).cast("long").alias(BATCH_ID)).write.insertInto(self.table)
        for batch in held:
            self._drop(spark, batch)

    def _partitions(self, spark: SparkSession) -> list[int]:
        return [int(r[0].partition("=")[2]) for r in spark.sql(f"SHOW PARTITIONS {self.table}").collect()]

    def _drop(self, spark: SparkSession, batch_id: int) -> None:
        spark.sql(f"ALTER TABLE {self.table} DROP IF EXISTS PARTITION ({BATCH_ID} = {batch_id})")
        exists, files, path = self._files(spark, f"{self.path}/{BATCH_ID}={batch_id}")
        if exists:
            files.delete(path, True)

    @staticmethod
    def _files(spark: SparkSession, folder: str):
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        files = path.getFileSystem(spark._jsc.hadoopConfiguration())
        return files.exists(path), files, path


def key_digest(df: DataFrame, keys: Sequence[str]) -> Column:
    """A digest of the key columns; of the whole row where all of them are NULL."""
    forms = comparable_columns(df)
    named = [forms[k].alias(f"k{i}") for i, k in enumerate(keys)]
    whole = F.when(without_keys(keys), F.struct(*[c.alias(f"c{i}") for i, c in enumerate(forms.values())]))
    return F.unhex(F.sha2(F.to_json(F.struct(*named, whole.alias("row")), _EXACT), 256))


def seen_copies(rows: DataFrame, seen: SeenKeys, batch_id: int) -> DataFrame:
    """The keys of ``rows`` that earlier batches had; the batch is the side that is built."""
    mine = rows.select(KEY).distinct().hint("shuffle_hash")
    return seen.before(rows.sparkSession, batch_id).join(mine, KEY, "left_semi")


def write_unseen(batch: DataFrame, keys: Sequence[str], sink: RouteSink, seen: SeenKeys, batch_id: int) -> None:
    """Write one row for each key of a batch that no earlier batch had, and its key."""
    keys = require_columns(batch, keys, "write_unseen")
    rows = batch.withColumn(KEY, key_digest(batch, keys))
    copies = seen_copies(rows, seen, batch_id)
    new = dedup(rows, [KEY]).join(copies, KEY, "left_anti").persist(StorageLevel.MEMORY_AND_DISK)
    try:
        sink.write_batch(new.select(*[column(c) for c in batch.columns]), batch_id)
        seen.replace(new.select(KEY), batch_id)
    finally:
        new.unpersist()


def start_dedup_late(
    stream: DataFrame,
    keys: Sequence[str],
    sink: RouteSink,
    seen: SeenKeys,
    checkpoint: str,
    trigger: Mapping[str, object] | None = None,
) -> StreamingQuery:
    """Start keeping the first row of every key of a stream, with no bound on lateness."""
    tune_session(stream.sparkSession)
    keys = require_columns(stream, keys, "start_dedup_late")
    seen.create(stream.sparkSession)

    def process(batch: DataFrame, batch_id: int) -> None:
        write_unseen(batch, keys, sink, seen, batch_id)

    writer = stream.writeStream.foreachBatch(process).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or trigger_options())).start()
