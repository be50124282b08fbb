"""Catalog tables as streaming sources."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession


def stream_table(
    spark: SparkSession, table: str, options: Mapping[str, str] | None = None
) -> DataFrame:
    """Stream an append-only table.

    Changed files of formats that report them are taken as new ones instead of
    stopping the stream.
    """
    reader = spark.readStream.option("ignoreChanges", "true").options(**(options or {}))
    return reader.table(table)
