"""The bronze table to the valid and error tables."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from rowsieve.config import PipelineConfig
from rowsieve.operators.route import BatchMetrics, write_once, write_routes
from rowsieve.operators.standardize import enrich_ingestion, standardize
from rowsieve.plans.rules import Rule
from rowsieve.plans.schema import CORRUPT_RECORD, source_schema
from rowsieve.plans.verdict import SCOPE_COLUMN, apply_rules, with_verdict
from rowsieve.session import tune_session
from rowsieve.sinks.tables import RouteSink, ensure_database, register_route
from rowsieve.sources.tables import stream_table
from rowsieve.streaming.triggers import trigger_options

RuleSource = Iterable[Rule] | Callable[[SparkSession], Iterable[Rule]]
# Files of one micro-batch where the source sets no bound of its own.
FILES_PER_TRIGGER = 1_000
_BOUNDS = {"maxfilespertrigger", "maxbytespertrigger"}
OnBatch = Callable[[int, BatchMetrics], None]


def start_routing(
    stream: DataFrame,
    rules: RuleSource,
    valid: RouteSink,
    error: RouteSink,
    checkpoint: str,
    trigger: Mapping[str, object] | None = None,
    scope_column: str = SCOPE_COLUMN,
    storage: StorageLevel | None = StorageLevel.MEMORY_AND_DISK,
    on_batch: OnBatch | None = None,
    committed_counts: bool = False,
) -> StreamingQuery:
    """Route every micro-batch of a stream, safely under replay.

    Rules are fixed at the start of the stream. Pass a function of the session instead
    to have them fetched anew for each batch. ``on_batch`` gets the row counts, with
    ``committed_counts`` those of the committed files.
    """

    def write(verdicts: DataFrame, batch_id: int) -> BatchMetrics:
        return write_routes(verdicts, valid, error, batch_id, storage, committed_counts)

    return _start(stream, rules, write, checkpoint, trigger, scope_column, on_batch)


def start_routing_once(
    stream: DataFrame,
    rules: RuleSource,
    sink: RouteSink,
    checkpoint: str,
    trigger: Mapping[str, object] | None = None,
    scope_column: str = SCOPE_COLUMN,
    on_batch: OnBatch | None = None,
) -> StreamingQuery:
    """As :func:`start_routing`, with both routes in one dataset.

    Each micro-batch is one job and nothing is cached; see :func:`~rowsieve.operators.route_once`.
    """

    def write(verdicts: DataFrame, batch_id: int) -> BatchMetrics:
        return write_once(verdicts, sink, batch_id)

    return _start(stream, rules, write, checkpoint, trigger, scope_column, on_batch)


def _start(
    stream: DataFrame,
    rules: RuleSource,
    write: Callable[[DataFrame, int], BatchMetrics],
    checkpoint: str,
    trigger: Mapping[str, object] | None,
    scope_column: str,
    on_batch: OnBatch | None,
) -> StreamingQuery:
    tune_session(stream.sparkSession)
    if not callable(rules):
        # Planned once for the whole stream instead of once per batch.
        stream = apply_rules(stream, rules, scope_column)

    def process(batch: DataFrame, batch_id: int) -> None:
        if callable(rules):
            batch = apply_rules(batch, rules(batch.sparkSession), scope_column)
        metrics = write(batch, batch_id)
        if on_batch is not None:
            on_batch(batch_id, metrics)

    return (
        stream.writeStream.foreachBatch(process)
        .trigger(**(trigger or trigger_options()))
        .option("checkpointLocation", checkpoint)
        .start()
    )


def start_silver(
    spark: SparkSession,
    config: PipelineConfig,
    rules: RuleSource,
    transform: Callable[[DataFrame], DataFrame] | None = None,
    stream_id: str = "main",
    layout: str = "rebalance",
    source_options: Mapping[str, str] | None = None,
    **routing,
) -> StreamingQuery:
    """Start the silver job: read the bronze table, standardise, check and route.

    ``transform`` replaces the standardising step, for instance by one that also drops
    duplicates, or by the identity.

    A micro-batch is persisted around its two writes, so its size is bounded: by
    ``maxBytesPerTrigger`` or ``maxFilesPerTrigger`` in ``source_options``, else by
    :data:`FILES_PER_TRIGGER`. With ``storage=None`` nothing is persisted or bounded.
    """
    ensure_database(spark, config.database)
    options = dict(source_options or {})
    if routing.get("storage", True) is not None and not _BOUNDS & {k.lower() for k in options}:
        options["maxFilesPerTrigger"] = str(FILES_PER_TRIGGER)
    bronze = stream_table(spark, config.bronze_name, options)
    if transform is None:
        silver = standardize(bronze, config.columns, time_zone=config.time_zone)
    else:
        silver = transform(bronze)
    return start_routing(
        silver,
        rules,
        config.valid_sink(stream_id, layout),
        config.error_sink(stream_id, layout),
        config.silver_checkpoint,
        trigger_options(config.trigger),
        **routing,
    )


def silver_schema(spark: SparkSession, config: PipelineConfig, corrupt_column: str | None = CORRUPT_RECORD) -> StructType:
    """The schema of the valid rows that the bronze and silver jobs write for a
    configuration, from its columns alone."""
    raw = spark.createDataFrame([], source_schema(config.columns, corrupt_column))
    bronze = enrich_ingestion(raw, source_file=F.lit(None).cast("string"))
    return standardize(bronze, config.columns, time_zone=config.time_zone).schema


def register_silver(
    spark: SparkSession, config: PipelineConfig, schema: StructType | None = None
) -> None:
    """Make the valid and error routes catalog tables, or bring those up to date.

    ``schema`` is that of the valid rows, where a ``transform`` of its own makes them
    differ from :func:`silver_schema`. Nothing is inferred from files, so it does not
    matter whether any row has been valid yet.
    """
    ensure_database(spark, config.database)
    schema = schema or silver_schema(spark, config)
    register_route(spark, config.silver_name, config.valid_sink(), schema)
    register_route(spark, config.error_name, config.error_sink(), with_verdict(schema))


def await_end(query: StreamingQuery, timeout: float | None = None) -> bool:
    """Wait until a query ends, or for ``timeout`` seconds; True when it has ended."""
    if timeout is not None:
        return bool(query.awaitTermination(timeout))
    query.awaitTermination()
    return True
