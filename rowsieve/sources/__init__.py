from rowsieve.sources.landing import read_landing, stream_landing
from rowsieve.sources.metadata import (
    active_schema,
    dq_policies,
    load_policies,
    load_rules,
    registered_schema,
    schema_registry,
    schema_versions,
)
from rowsieve.sources.objects import cut_objects, object_lines, parse_objects, read_objects, stream_lines
from rowsieve.sources.tables import stream_table

__all__ = [
    "active_schema",
    "cut_objects",
    "dq_policies",
    "load_policies",
    "load_rules",
    "object_lines",
    "parse_objects",
    "read_landing",
    "read_objects",
    "registered_schema",
    "schema_registry",
    "schema_versions",
    "stream_landing",
    "stream_lines",
    "stream_table",
]
