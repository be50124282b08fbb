"""Landing files to the bronze table."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from rowsieve.config import PipelineConfig
from rowsieve.operators.standardize import enrich_ingestion
from rowsieve.plans.schema import CORRUPT_RECORD, source_schema
from rowsieve.session import tune_session
from rowsieve.sinks.files import start_append
from rowsieve.sinks.tables import RouteSink, ensure_database, follow_schema, register_route
from rowsieve.sources.landing import stream_landing
from rowsieve.sources.objects import FILE, cut_objects, parse_objects, stream_lines
from rowsieve.streaming.triggers import trigger_options


def bronze_stream(
    spark: SparkSession,
    config: PipelineConfig,
    corrupt_column: str | None = CORRUPT_RECORD,
    ingestion_time: Column | None = None,
    **landing,
) -> DataFrame:
    """The landing zone as a stream with ingestion columns.

    Input that is not JSON of the declared shape arrives in ``corrupt_column``; a
    ``well_formed`` rule on that column sends it to the error route.
    """
    raw = stream_landing(
        spark,
        config.landing_path,
        source_schema(config.columns, corrupt_column),
        name_pattern=config.file_pattern,
        archive_path=config.archive_path,
        corrupt_column=corrupt_column,
        **landing,
    )
    return enrich_ingestion(raw, ingestion_time)


def start_bronze(
    spark: SparkSession,
    config: PipelineConfig,
    trigger: Mapping[str, object] | None = None,
    **source,
) -> StreamingQuery:
    """Start the bronze job; its output is registered as the bronze table, which takes up
    columns that the configuration has gained."""
    ensure_database(spark, config.database)
    stream = bronze_stream(spark, config, **source)
    if config.format != "delta":
        follow_schema(spark, config.bronze_name, stream.schema, config.bronze_path, config.bronze_keys, config.format)
    return start_append(
        stream,
        config.bronze_path,
        config.bronze_checkpoint,
        config.bronze_keys,
        config.bronze_name,
        config.format,
        config.bronze_mode,
        trigger,
    )


def start_bronze_split(
    spark: SparkSession,
    config: PipelineConfig,
    trigger: Mapping[str, object] | None = None,
    corrupt_column: str | None = CORRUPT_RECORD,
    ingestion_time: Column | None = None,
    stream_id: str = "main",
    **source,
) -> StreamingQuery:
    """The bronze job for large files whose objects span lines: tasks share a file.

    As :func:`start_bronze`, but objects are cut in each micro-batch, which is written as a
    batch of :class:`~rowsieve.sinks.RouteSink`, so that a replay replaces it. A malformed
    object costs itself only, not its file. ``source`` takes the bounds of
    :func:`~rowsieve.sources.objects.stream_lines`.
    """
    ensure_database(spark, config.database)
    tune_session(spark)
    schema = source_schema(config.columns, corrupt_column)
    sink = bronze_sink(config, stream_id)

    def rows(lines: DataFrame) -> DataFrame:
        parsed = parse_objects(cut_objects(lines), schema, corrupt_column)
        return enrich_ingestion(parsed, ingestion_time, F.col(FILE)).drop(FILE)

    def write(lines: DataFrame, batch_id: int) -> None:
        made = rows(lines)
        sink.write_batch(made, batch_id)
        register_route(lines.sparkSession, config.bronze_name, sink, made.schema)

    lines = stream_lines(spark, config.landing_path, config.file_pattern, archive_path=config.archive_path, **source)
    writer = lines.writeStream.foreachBatch(write).option("checkpointLocation", config.bronze_checkpoint)
    return writer.trigger(**(trigger or trigger_options())).start()


def bronze_sink(config: PipelineConfig, stream_id: str = "main") -> RouteSink:
    """Where :func:`start_bronze_split` writes its batches."""
    return RouteSink(config.bronze_path, config.bronze_keys, stream_id, config.format)
