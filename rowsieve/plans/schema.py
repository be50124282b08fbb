"""Column declarations and the schemas built from them."""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping
from dataclasses import dataclass
from typing import Any

from pyspark.sql.types import StringType, StructField, StructType

CORRUPT_RECORD = "_corrupt_record"


@dataclass(frozen=True)
class ColumnSpec:
    """A declared column: its name in the source, its name in the table, its type."""

    target: str
    source: str
    type: str = "string"
    is_key: bool = False

    @classmethod
    def from_dict(cls, entry: Mapping[str, Any]) -> ColumnSpec:
        target = entry["targetName"]
        return cls(target, entry.get("sourceName") or target, entry["type"], bool(entry.get("isPk")))

    @property
    def is_time(self) -> bool:
        return self.type.strip().lower() == "timestamp"


def column_specs(entries: Iterable[Mapping[str, Any]]) -> list[ColumnSpec]:
    return [ColumnSpec.from_dict(e) for e in entries]


def key_columns(columns: Iterable[ColumnSpec]) -> list[str]:
    return [c.target for c in columns if c.is_key]


def source_schema(columns: Iterable[ColumnSpec], corrupt_column: str | None = None) -> StructType:
    """The schema of the source: source names, all nullable, timestamps still text.

    Types are Spark DDL type names; an unknown one raises. ``corrupt_column`` adds
    the text column in which Spark keeps input it cannot parse.
    """
    fields = [StructField(c.source, _source_type(c), True) for c in columns]
    if corrupt_column:
        fields.append(StructField(corrupt_column, StringType(), True))
    return StructType(fields)


def _source_type(spec: ColumnSpec):
    if spec.is_time:
        return StringType()
    try:
        return StructType.fromDDL(f"value {spec.type}")[0].dataType
    except Exception as e:
        raise ValueError(f"column {spec.source!r}: unknown type {spec.type!r}") from e


def schema_from_json(text: str) -> StructType:
    """A StructType from registry JSON, which may leave out the optional parts."""
    return StructType.fromJson(_complete(json.loads(text)))


def _complete(node: Any) -> Any:
    """Fill in what a hand-written schema omits: everything nullable, no metadata."""
    if not isinstance(node, dict):
        return node
    if "fields" in node:
        return {"type": "struct", "fields": [_complete_field(f) for f in node["fields"]]}
    if node.get("type") == "array":
        return {
            "type": "array",
            "elementType": _complete(node["elementType"]),
            "containsNull": node.get("containsNull", True),
        }
    if node.get("type") == "map":
        return {
            "type": "map",
            "keyType": _complete(node["keyType"]),
            "valueType": _complete(node["valueType"]),
            "valueContainsNull": node.get("valueContainsNull", True),
        }
    return node


def _complete_field(field: Mapping[str, Any]) -> dict[str, Any]:
    return {
        "name": field["name"],
        "type": _complete(field["type"]),
        "nullable": field.get("nullable", True),
        "metadata": field.get("metadata", {}),
    }
