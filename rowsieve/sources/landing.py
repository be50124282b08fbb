"""The landing zone: JSON files that arrive in a folder tree."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

# Fixed value: how landing files are named.
FILE_PATTERN = "data_stream_*.json"


def landing_options(
    name_pattern: str | None = FILE_PATTERN,
    recursive: bool = True,
    multi_line: bool = True,
    corrupt_column: str | None = None,
) -> dict[str, str]:
    options = {
        "multiLine": str(multi_line).lower(),
        "recursiveFileLookup": str(recursive).lower(),
    }
    if name_pattern:
        options["pathGlobFilter"] = name_pattern
    if corrupt_column:
        options["columnNameOfCorruptRecord"] = corrupt_column
    return options


def stream_landing(
    spark: SparkSession,
    path: str,
    schema: StructType,
    archive_path: str | None = None,
    max_files_per_trigger: int | None = None,
    max_bytes_per_trigger: str | None = None,
    options: Mapping[str, str] | None = None,
    **layout,
) -> DataFrame:
    """Stream the landing zone under an explicit schema.

    ``layout`` takes the arguments of :func:`landing_options`. A multi-line file is one
    task's work; producers of large files should write one object per line and readers
    then set ``multi_line=False``, which lets Spark split files. The two ``max_`` bounds
    keep one micro-batch of a backlog within what the cluster can hold. With
    ``archive_path`` files move there after the batch that read them is committed.
    """
    reader = spark.readStream.format("json").schema(schema).options(**landing_options(**layout))
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if max_bytes_per_trigger is not None:
        reader = reader.option("maxBytesPerTrigger", max_bytes_per_trigger)
    if archive_path is not None:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive_path)
    return reader.options(**(options or {})).load(path)


def read_landing(
    spark: SparkSession, path: str, schema: StructType, options: Mapping[str, str] | None = None, **layout
) -> DataFrame:
    """The landing zone as a batch, with the same options."""
    reader = spark.read.format("json").schema(schema).options(**landing_options(**layout))
    return reader.options(**(options or {})).load(path)
