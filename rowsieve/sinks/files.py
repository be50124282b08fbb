"""Streaming file and table sinks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from rowsieve.session import tune_session


def start_append(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    partition_keys: Sequence[str] = ("ingestion_date",),
    table: str | None = None,
    format: str = "parquet",
    output_mode: str = "append",
    trigger: Mapping[str, object] | None = None,
    options: Mapping[str, str] | None = None,
) -> StreamingQuery:
    """Start writing a stream to partitioned files.

    With ``table`` the files are an external catalog table that later streams can read
    by name. Without ``trigger`` each micro-batch starts when the previous one is done.
    """
    tune_session(stream.sparkSession)
    writer = (
        stream.writeStream.format(format)
        .outputMode(output_mode)
        .option("checkpointLocation", checkpoint)
        .options(**(options or {}))
    )
    if partition_keys:
        writer = writer.partitionBy(*partition_keys)
    if trigger:
        writer = writer.trigger(**trigger)
    if table:
        return writer.option("path", path).toTable(table)
    return writer.start(path)
