"""Pipeline parameters, from a plain dictionary."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, replace
from typing import Any

from pyspark.sql.types import StructType

from rowsieve.plans.schema import ColumnSpec, column_specs, key_columns
from rowsieve.sinks.tables import RouteSink
from rowsieve.sources.landing import FILE_PATTERN


@dataclass(frozen=True)
class PipelineConfig:
    """Names, paths and columns of one pipeline.

    Paths are absolute; :meth:`from_dict` joins relative ones to the storage base path.
    ``time_zone`` decides to which date an event belongs; without it the session does, and
    a replay from a session in another zone would move rows to other partitions.
    ``keep_schemas`` writes the schema of each silver batch beside its rows, for tables whose
    types change over time.
    """

    columns: tuple[ColumnSpec, ...]
    landing_path: str
    bronze_path: str
    bronze_checkpoint: str
    silver_path: str
    error_path: str
    silver_checkpoint: str
    database: str = "default"
    bronze_table: str = "bronze"
    silver_table: str = "silver"
    file_pattern: str | None = FILE_PATTERN
    archive_path: str | None = None
    bronze_mode: str = "append"
    bronze_keys: tuple[str, ...] = ("ingestion_date",)
    silver_keys: tuple[str, ...] = ("eventDate",)
    trigger: str = "availableNow"
    format: str = "parquet"
    time_zone: str | None = None
    keep_schemas: bool = False

    @classmethod
    def from_dict(cls, document: Mapping[str, Any], **overrides: Any) -> PipelineConfig:
        """Parameters from the nested dictionary that pipelines are configured with."""
        base = document.get("storage", {}).get("basePath", "")
        files = document["fileDetails"]
        bronze = document["rawZoneDeltaTableInformation"]
        silver = document["curatedDeltaTableInformation"]
        if silver.get("writeMode", "append") != "append":
            raise ValueError("curated tables are written in append mode only")
        archive = files.get("archivePath")
        values = {
            "columns": tuple(column_specs(document["columns"])),
            "landing_path": base + files["landingZonePath"],
            "bronze_path": base + bronze["path"],
            "bronze_checkpoint": base + bronze["checkpoint"],
            "silver_path": base + silver["path"],
            "error_path": base + silver["errorPath"],
            "silver_checkpoint": base + silver["checkpoint"],
            "database": document.get("database", {}).get("name", "default"),
            "bronze_table": bronze["tableName"],
            "silver_table": silver["tableName"],
            "file_pattern": files.get("fileNamePattern", FILE_PATTERN),
            "archive_path": base + archive if archive else None,
            "bronze_mode": bronze.get("writeMode", "append"),
            "bronze_keys": tuple(bronze.get("partitionKeys", ("ingestion_date",))),
            "silver_keys": tuple(silver.get("partitionKeys", ("eventDate",))),
            "trigger": document.get("trigger", {}).get("type", "availableNow"),
            "time_zone": document.get("timeZone"),
        }
        return cls(**{**values, **overrides})

    def with_schema(self, schema: StructType) -> PipelineConfig:
        """The same pipeline with the types and columns of a registered schema.

        Fields are the curated names. Declared columns keep their source names and keys and
        take the registered type, timestamps stay text until silver; fields that are not
        declared are read under their own names.
        """
        known = {c.target.lower(): c for c in self.columns}
        columns = []
        for field in schema:
            spec = known.pop(field.name.lower(), ColumnSpec(field.name, field.name))
            columns.append(replace(spec, target=field.name, type=field.dataType.simpleString()))
        return replace(self, columns=(*columns, *known.values()))

    @property
    def keys(self) -> list[str]:
        return key_columns(self.columns)

    @property
    def bronze_name(self) -> str:
        return f"{self.database}.{self.bronze_table}"

    @property
    def silver_name(self) -> str:
        return f"{self.database}.{self.silver_table}"

    @property
    def error_name(self) -> str:
        return f"{self.silver_name}_error"

    def valid_sink(self, stream_id: str = "main", layout: str = "rebalance") -> RouteSink:
        return RouteSink(
            self.silver_path, self.silver_keys, stream_id, self.format, layout, self.silver_name,
            keep_schema=self.keep_schemas,
        )

    def error_sink(self, stream_id: str = "main", layout: str = "rebalance") -> RouteSink:
        return RouteSink(
            self.error_path, self.silver_keys, stream_id, self.format, layout, self.error_name,
            keep_schema=self.keep_schemas,
        )
