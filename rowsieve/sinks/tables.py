"""Table sinks.

Without a transactional format a micro-batch that is replayed after a failure must not
be appended twice. :class:`RouteSink` therefore gives each batch a directory of its own
and replaces it whole:

    <path>/_stream_id=<stream>/_batch_id=<n>/<partition key>=<value>/...

A replay with fewer rows, other partitions or no rows at all leaves nothing behind.
Readers see the two bookkeeping levels as partition columns and drop them.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, replace
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, NumericType, StringType, StructField, StructType

from rowsieve.functions.naming import quote
from rowsieve.plans.evolution import widest, widest_schema

STREAM_ID = "_stream_id"
BATCH_ID = "_batch_id"
# A folder of a batch that readers of its rows do not see.
SCHEMA = "_schema"


@dataclass(frozen=True)
class RouteSink:
    """Where one route of the batches of a stream is written.

    ``layout="rebalance"`` groups rows by partition key before a write, in files of even
    size; Spark splits a key that holds too much. It costs a shuffle and pays when a
    batch spans many partition values. ``"as_is"`` writes from the tasks as they stand.

    With ``format="delta"`` (needs that package) batches are appended to ``table``, or
    to ``path``, as idempotent transactions instead.

    ``keep_schema`` writes each batch's schema beside its rows, for batches whose types
    differ; see :mod:`rowsieve.sinks.generations`.
    """

    path: str
    partition_keys: tuple[str, ...] = ("eventDate",)
    stream_id: str = "main"
    format: str = "parquet"
    layout: str = "as_is"
    table: str | None = None
    options: Mapping[str, str] = field(default_factory=dict)
    keep_schema: bool = False

    def __post_init__(self):
        if self.layout not in ("as_is", "rebalance"):
            raise ValueError(f"layout is 'as_is' or 'rebalance', not {self.layout!r}")

    def batch_path(self, batch_id: int) -> str:
        return f"{self.path}/{STREAM_ID}={self.stream_id}/{BATCH_ID}={batch_id}"

    def write_batch(self, df: DataFrame, batch_id: int) -> None:
        """Write one batch; writing the same batch again replaces it."""
        if self.layout == "rebalance" and _adaptive(df.sparkSession):
            df = df.hint("rebalance", *[quote(k) for k in self.partition_keys])
        writer = df.write.format(self.format).partitionBy(*self.partition_keys).options(**self.options)
        if self.format == "delta":
            writer = writer.mode("append").options(
                mergeSchema="true", txnAppId=self.stream_id, txnVersion=str(batch_id)
            )
            if self.table:
                writer.option("path", self.path).saveAsTable(self.table)
            else:
                writer.save(self.path)
        else:
            # The directory is this batch's alone, so all of it is replaced, also in a
            # session that prefers to replace single partitions.
            writer.mode("overwrite").option("partitionOverwriteMode", "static").save(
                self.batch_path(batch_id)
            )
            if self.keep_schema:
                schema = df.sparkSession.createDataFrame([(df.schema.json(),)], "value string")
                schema.coalesce(1).write.mode("overwrite").text(f"{self.batch_path(batch_id)}/{SCHEMA}")

    def has_batch(self, spark: SparkSession, schema: StructType, batch_id: int) -> bool:
        """Whether an earlier attempt at this batch has written to this route."""
        if self.format == "delta":
            return False
        return _exists(spark, self.format, schema, self.batch_path(batch_id))

    def count_batch(self, spark: SparkSession, schema: StructType, batch_id: int) -> int:
        """How many rows of a batch are committed; no column is read for it."""
        if not self.has_batch(spark, schema, batch_id):
            return 0
        return spark.read.format(self.format).options(**self.options).schema(schema).load(self.batch_path(batch_id)).count()

    def read(
        self, spark: SparkSession, schema: StructType | None = None, after_batch: int | None = None
    ) -> DataFrame:
        """The rows of the route, from all its streams.

        Pass the schema where it is known: it is needed while the route is empty, and it
        spares reading every file's footer to merge schemas that grew over time.
        ``after_batch`` leaves out the batches up to that number, those compacted away.
        """
        reader = spark.read.format(self.format).options(**self.options)
        if self.format == "delta":
            return reader.load(self.path)
        reader = reader.schema(_with_batch_columns(schema)) if schema else reader.option("mergeSchema", True)
        try:
            rows = reader.load(self.path)
        except AnalysisException as e:
            if schema is None or e.getCondition() != "PATH_NOT_FOUND":
                raise
            return spark.createDataFrame([], schema)
        if after_batch is not None:
            rows = rows.filter(F.col(BATCH_ID) > after_batch)
        return rows.select(*[quote(f.name) for f in schema]) if schema else rows.drop(STREAM_ID, BATCH_ID)


def compact_batches(
    spark: SparkSession,
    source: RouteSink,
    target: RouteSink,
    schema: StructType,
    up_to_batch: int,
    after_batch: int | None = None,
) -> None:
    """Rewrite the next batches of a stream up to a settled one as fewer, larger files.

    Takes the batches ``after_batch < n <= up_to_batch``; without a lower bound, those
    after what the target holds for this stream. The target is another path, in which the
    result counts as batch ``up_to_batch`` and replaces an earlier attempt at the same
    bound. Readers then take the target and, from the source, what comes
    ``after_batch=up_to_batch``; the source's old directories can be removed when none is
    left that reads them.
    """
    if target.path.rstrip("/") == source.path.rstrip("/"):
        raise ValueError("compaction writes to another path than it reads")
    for sink in (source, target):
        _require_batches(sink)
    held = _batches(spark, target, source.stream_id)
    if held and max(held) > up_to_batch:
        raise ValueError(f"the target already holds batches up to {max(held)}")
    if after_batch is None:
        after_batch = max((n for n in held if n < up_to_batch), default=-1)
    rows = spark.read.format(source.format).schema(_with_batch_columns(schema)).load(source.path)
    settled = rows.filter(
        (F.col(STREAM_ID) == source.stream_id)
        & (F.col(BATCH_ID) > after_batch)
        & (F.col(BATCH_ID) <= up_to_batch)
    )
    replace(target, layout="rebalance", stream_id=source.stream_id).write_batch(
        settled.select(*[quote(f.name) for f in schema]), up_to_batch
    )


def _batches(spark: SparkSession, sink: RouteSink, stream_id: str) -> list[int]:
    """Numbers of the batches a sink holds for a stream."""
    return [batch for stream, batch in batch_directories(spark, sink.path) if stream == stream_id]


def batch_directories(spark: SparkSession, path: str, below: str = "") -> list[tuple[str, int]]:
    """Stream and number of each batch under a path that has a folder ``below``, from
    directory names alone."""
    pattern = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{STREAM_ID}=*/{BATCH_ID}=*{below and '/' + below}")
    found = pattern.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(pattern) or []
    name = re.compile(f"/{STREAM_ID}=([^/]*)/{BATCH_ID}=([0-9]+)")
    matches = [name.search(status.getPath().toString()) for status in found]
    return sorted((unquote(m[1]), int(m[2])) for m in matches if m)


def _require_batches(sink: RouteSink) -> None:
    """Formats with transactions of their own have no directory for each batch."""
    if sink.format == "delta":
        raise ValueError("format 'delta' keeps no batch directories")


def register_route(spark: SparkSession, table: str, sink: RouteSink, schema: StructType) -> None:
    """Make a route a catalog table, or bring that table up to date.

    New columns are added to the table and new batches to its partitions. Listing the
    partitions of a long history takes time, so do this on a schedule, not per batch.
    """
    _require_batches(sink)
    keys = [STREAM_ID, BATCH_ID, *sink.partition_keys]
    full = _with_batch_columns(schema)
    if not spark.catalog.tableExists(table):
        names = ", ".join(quote(k) for k in keys)
        location = sink.path.replace("\\", "\\\\").replace("'", "\\'")
        spark.sql(
            f"CREATE TABLE {table} ({full.toDDL()}) USING {sink.format} "
            f"PARTITIONED BY ({names}) LOCATION '{location}'"
        )
    else:
        _add_columns(spark, table, schema)
    if _exists(spark, sink.format, full, sink.path):
        spark.catalog.recoverPartitions(table)
    spark.catalog.refreshTable(table)


def _add_columns(spark: SparkSession, table: str, schema: StructType) -> None:
    """Give a table the columns of a schema that it lacks."""
    have = {f.name.lower() for f in spark.table(table).schema}
    added = StructType([StructField(f.name, f.dataType) for f in schema if f.name.lower() not in have])
    if added.fields:
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({added.toDDL()})")


def follow_schema(
    spark: SparkSession, table: str, schema: StructType, path: str, partition_keys: Sequence[str], format: str
) -> None:
    """Bring an external table's definition up to a schema that followed from its own.

    New columns are added. Where numbers became wider, which Parquet's reader converts, the
    table is defined anew over the same files. Other changes raise: rows of both types
    need :func:`~rowsieve.sinks.generations.read_widened`.
    """
    if not spark.catalog.tableExists(table):
        return
    have = spark.table(table).schema
    known = {f.name.lower(): f.dataType for f in have}
    changed = [f for f in schema if known.get(f.name.lower(), f.dataType) != f.dataType]
    for f in changed:
        old = known[f.name.lower()]
        if not (isinstance(old, NumericType) and isinstance(f.dataType, NumericType) and widest(old, f.dataType) == f.dataType):
            raise ValueError(f"table {table}: column {f.name!r} cannot turn from {old.simpleString()} into {f.dataType.simpleString()}")
    if not changed:
        _add_columns(spark, table, schema)
        return
    if spark.catalog.getTable(table).tableType != "EXTERNAL":
        raise ValueError(f"table {table} is not external, so it cannot be defined anew")
    full = widest_schema([have, schema])
    keys = ", ".join(quote(k) for k in partition_keys)
    location = path.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"DROP TABLE {table}")
    # Over files that a stream has written Spark would ignore the schema, so the table is
    # defined over no files and then moved.
    spark.sql(
        f"CREATE TABLE {table} ({full.toDDL()}) USING {format} "
        f"{keys and f'PARTITIONED BY ({keys})'} LOCATION '{location}/_definition'"
    )
    spark.sql(f"ALTER TABLE {table} SET LOCATION '{location}'")
    if keys:
        spark.catalog.recoverPartitions(table)
    spark.catalog.refreshTable(table)


def append_table(
    df: DataFrame,
    table: str,
    path: str,
    partition_keys: Sequence[str] = ("eventDate",),
    format: str = "parquet",
) -> None:
    """Append rows to an external table, creating it on first use.

    Columns that are new are added to the table first; those that the rows lack become
    NULL.
    """
    spark = df.sparkSession
    if spark.catalog.tableExists(table):
        _add_columns(spark, table, df.schema)
        have = {name.lower() for name in df.columns}
        lacking = [f for f in spark.table(table).schema if f.name.lower() not in have]
        df = df.withColumns({f.name: F.lit(None).cast(f.dataType) for f in lacking})
    writer = df.write.format(format).mode("append").partitionBy(*partition_keys)
    writer.option("path", path).saveAsTable(table)


def overwrite_table(df: DataFrame, table: str, path: str, format: str = "parquet") -> None:
    """Replace an external table, as for the metadata tables."""
    df.write.format(format).mode("overwrite").option("path", path).saveAsTable(table)


def ensure_database(spark: SparkSession, name: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {quote(name)}")


def _with_batch_columns(schema: StructType) -> StructType:
    """The table schema as the directory layout presents it."""
    return StructType(
        [*schema.fields, StructField(STREAM_ID, StringType()), StructField(BATCH_ID, LongType())]
    )


def _exists(spark: SparkSession, format: str, schema: StructType, path: str) -> bool:
    try:
        spark.read.format(format).schema(schema).load(path)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return False
        raise
    return True


def _adaptive(spark: SparkSession) -> bool:
    return str(spark.conf.get("spark.sql.adaptive.enabled")).lower() == "true"

