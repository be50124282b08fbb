"""From source names and text to the curated columns."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowsieve.functions.convert import leading_token, to_event_timestamp
from rowsieve.functions.naming import Names, column, find_column
from rowsieve.plans.schema import ColumnSpec

EVENT_TIME = "eventTimestamp"
EVENT_DATE = "eventDate"
APPLICATION = "applicationCode"
PLATFORM = "platform_type"


def rename_present(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Rename the columns that exist; absent names are ignored."""
    return df.withColumnsRenamed(dict(names))


def map_columns(
    df: DataFrame, columns: Iterable[ColumnSpec], keep_time_text: bool = True
) -> DataFrame:
    """Rename declared columns and parse declared timestamps, in one projection.

    A timestamp whose name changes is added at the end and its text stays beside it,
    unless ``keep_time_text`` is off; under the same name it is replaced in place.
    """
    fold = Names(df.sparkSession).fold
    specs = list(columns)
    renames = {fold(c.source): c.target for c in specs if not c.is_time}
    time_texts = {fold(c.source) for c in specs if c.is_time}
    times = {fold(c.target): c for c in specs if c.is_time}

    projection = []
    for name in df.columns:
        spec = times.pop(fold(name), None)
        if spec is not None:
            projection.append(to_event_timestamp(column(spec.source)).alias(spec.target))
        elif keep_time_text or fold(name) not in time_texts:
            projection.append(column(name).alias(renames.get(fold(name), name)))
    projection += [to_event_timestamp(column(c.source)).alias(c.target) for c in times.values()]
    return df.select(*projection)


def parse_timestamp(df: DataFrame, name: str = EVENT_TIME) -> DataFrame:
    """Parse a text column in place; nothing happens when it is absent."""
    have = find_column(df, name)
    return df if have is None else df.withColumn(have, to_event_timestamp(column(have)))


def add_event_date(
    df: DataFrame, source: str = EVENT_TIME, target: str = EVENT_DATE, time_zone: str | None = None
) -> DataFrame:
    """The date of an event in a time zone, or in the session's."""
    have = find_column(df, source)
    if have is None:
        return df
    time = column(have)
    if time_zone is not None:
        time = F.convert_timezone(F.lit(time_zone), time.cast("timestamp"))
    return df.withColumn(target, time.cast("date"))


def add_platform(df: DataFrame, source: str = APPLICATION, target: str = PLATFORM) -> DataFrame:
    """The part of the application code before its first dash."""
    have = find_column(df, source)
    return df if have is None else df.withColumn(target, leading_token(column(have)))


def standardize(
    df: DataFrame,
    columns: Iterable[ColumnSpec],
    keep_time_text: bool = True,
    time_zone: str | None = None,
) -> DataFrame:
    """Mapping, event date and platform: what the curated table is made of."""
    mapped = map_columns(df, columns, keep_time_text)
    return add_platform(add_event_date(mapped, time_zone=time_zone))


def enrich_ingestion(
    df: DataFrame, ingestion_time=None, source_file=None
) -> DataFrame:
    """Add ingestion time, source file and ingestion date to file input.

    ``ingestion_time`` and ``source_file`` default to the current time and to the path
    of the file a row was read from; pass Columns to fix them.
    """
    now = F.current_timestamp() if ingestion_time is None else ingestion_time
    path = F.col("_metadata.file_path") if source_file is None else source_file
    return df.select(
        "*",
        now.alias("ingestion_timestamp"),
        path.alias("source_filename"),
        now.cast("date").alias("ingestion_date"),
    )
